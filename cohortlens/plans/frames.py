"""Standard frames every query starts from (FIXTURES.md §2-§4).

``campaign_features`` = raw campaign table -> cleaning (C7) -> derived
features (F1-F6, C11) -> label (C9), keyed by ``customer_id``.
``scored`` = rule clusters, a deterministic score with ties and soft
memberships; it needs no model and feeds the metric operators.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import md5_unit
from ..operators.clean import add_label, clean_campaign
from ..operators.features import derive_features
from ..shared import dealt, written
from ..sources.campaign import CUTOFF, REFERENCE_YEAR, campaign_raw

# Fixed values of the scored fixture (FIXTURES.md §3).
Q_CENTERS = [-3.0, -2.5, -2.0, -1.0]
#: Share of the rows that the curve job holds out.
TWO_WAY_HOLD_OUT = 0.2


def campaign_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_campaign(campaign_raw(spark, sf_dir), reference_date=CUTOFF, reference_year=REFERENCE_YEAR)


def campaign_features(spark: SparkSession, sf_dir: str, label_mode: str = "recent") -> DataFrame:
    df = derive_features(campaign_clean(spark, sf_dir), reference_date=CUTOFF, reference_year=REFERENCE_YEAR)
    return add_label(df, mode=label_mode)


def z_score(df: DataFrame):
    freq = F.col("Frequency").cast("double")
    rec = F.coalesce(F.col("Recency"), F.lit(2000)).cast("double")
    return (
        F.lit(-2.0)
        + F.lit(0.1) * (freq - F.lit(10.0))
        + F.lit(0.3) * F.col("PastAcceptCnt").cast("double")
        - F.lit(0.0005) * (rec - F.lit(250.0))
    )


def rule_segment():
    """The rule segment of the scored fixture, from a feature row."""
    rec = F.coalesce(F.col("Recency"), F.lit(9999))
    return 2 * (rec <= 180).cast("int") + (F.col("Frequency") >= 10).cast("int")


def with_segment(feat: DataFrame) -> DataFrame:
    """All feature columns and the rule segment as ``cluster``: no second derivation, no join."""
    return feat.withColumn("cluster", rule_segment())


def scored_from_features(feat: DataFrame) -> DataFrame:
    out = feat.select(
        "customer_id", "label", rule_segment().alias("cluster"), z_score(feat).alias("z")
    )
    prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z")))
    qe = F.array(*[F.exp(-F.abs(F.col("z") - F.lit(c))) for c in Q_CENTERS])
    out = out.withColumns(
        {
            "score": F.floor(prob * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0),
            "qe": qe,
        }
    )
    total = F.aggregate("qe", F.lit(0.0), lambda acc, x: acc + x)
    return out.withColumn("q", F.transform("qe", lambda x: x / total)).drop("qe")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, label, cluster, z, score, q."""
    return scored_from_features(campaign_features(spark, sf_dir))


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature frame with ``planted_label`` carrying signal (FIXTURES.md §4)."""
    feat = campaign_features(spark, sf_dir)
    z = z_score(feat)
    stats = feat.select(F.avg(z).alias("m"), F.stddev_pop(z).alias("s")).first()
    z_std = (z - F.lit(stats["m"])) / F.lit(stats["s"] if stats["s"] else 1.0)
    u = md5_unit(F.lit("plant"), F.col("customer_id"))
    return feat.withColumn("planted_label", (u < F.lit(1.0) / (F.lit(1.0) + F.exp(-3.0 * z_std))).cast("int"))


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def split_features(spark: SparkSession, sf_dir: str, two_way: bool = False, seed: int = 42) -> DataFrame:
    """Feature frame with the stratified ``split`` column (P2, or P1 with ``two_way``)."""
    from ..operators.split import assign_splits

    share = TWO_WAY_HOLD_OUT if two_way else 0.1
    return assign_splits(campaign_features(spark, sf_dir), stratify_col="label", two_way=two_way, val_size=share, seed=seed)


def transformed(spark: SparkSession, sf_dir: str, exact: bool = True, two_way: bool = False):
    """(feature table over all rows with train-fitted parameters, fitted parameters)."""
    from ..operators.transform import feature_table

    # read by every pass of the fit: written once instead of derived or cached anew
    sp = written(split_features(spark, sf_dir, two_way=two_way), "split-features")
    return feature_table(sp, F.col("split") == "train", exact=exact)


def long_format(df: DataFrame, names, keep=("customer_id", "split", "label")) -> DataFrame:
    """One row per (row, feature): keeps queries schema-stable when feature names depend on data."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    return df.select(*[k for k in keep if k in df.columns], F.explode(pairs).alias("_kv")).select(
        *[k for k in keep if k in df.columns], "_kv.feature", "_kv.value"
    )


def model_frame(spark: SparkSession, sf_dir: str, exact: bool = True, two_way: bool = False):
    """Transformed rows with ``xb`` (behaviour) and ``xf`` (full) arrays, persisted.

    Returns (frame, fitted transform). The frame is the one cached input every
    model iterates over, dealt over all cores; iterations only ship small parameters to it.
    """
    table, ft = transformed(spark, sf_dir, exact=exact, two_way=two_way)
    q = lambda n: F.col(f"`{n}`")
    frame = table.select(
        "customer_id", "split", F.col("label").cast("int").alias("label"),
        F.array(*[q(n) for n in ft.behavior_feature_names]).alias("xb"),
        F.array(*[q(n) for n in ft.all_feature_names]).alias("xf"),
        F.array(*[q(n) for n in ("recency", "frequency", "monetary")]).alias("xrfm"),
    )
    return dealt(frame).persist(), ft
