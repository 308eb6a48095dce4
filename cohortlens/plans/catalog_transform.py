"""Registered queries: splits and train-fitted transforms (P, T rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import split as splitops
from ..operators.features import AMOUNT_COLUMNS, FeatureConfig
from ..operators.quantile import exact_quantiles
from ..operators.transform import fit_transform_params
from ..shared import written
from .catalog import register, sd, si, ss, tidy
from .frames import long_format, split_features, transformed
from .sql_base import split_ctes, transform_ctes, with_base

CFG = FeatureConfig()
NUMERIC = CFG.behavior_numeric + CFG.response_numeric
CATS = CFG.categorical
_TF = split_ctes() + ", " + transform_ctes(NUMERIC, CATS, AMOUNT_COLUMNS)


@register("split_three_way", with_base(f"SELECT {si('customer_id', 'customer_id')}, {si('label', 'label')}, split FROM sp", split_ctes()))
def q_split_three_way(spark, sf_dir):
    return tidy(split_features(spark, sf_dir).select("customer_id", "label", "split"))


@register(
    "split_two_way",
    with_base(f"SELECT {si('customer_id', 'customer_id')}, {si('label', 'label')}, split FROM sp", split_ctes(val_size=0.2, two_way=True)),
)
def q_split_two_way(spark, sf_dir):
    from .frames import campaign_features

    df = splitops.assign_splits(campaign_features(spark, sf_dir), val_size=0.2, two_way=True)
    return tidy(df.select("customer_id", "label", "split"))


@register(
    "split_summary",
    with_base(f"SELECT split, {si('count(*)', 'n_rows')}, {si('sum(label)', 'n_positive')} FROM sp GROUP BY split", split_ctes()),
)
def q_split_summary(spark, sf_dir):
    return tidy(splitops.split_summary(split_features(spark, sf_dir)))


def _train(spark, sf_dir):
    from ..operators.transform import prepare_for_fit

    return prepare_for_fit(split_features(spark, sf_dir)).filter(F.col("split") == "train")


def _param_rows(df, pairs):
    """Aggregate one row, then one output row per feature (no driver round trip)."""
    return df.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


@register(
    "impute_median",
    with_base(" UNION ALL ".join(f"SELECT '{c.lower()}' AS feature, {sd(f'm_{c}', 'median')} FROM prm1" for c in NUMERIC), _TF),
)
def q_impute_median(spark, sf_dir):
    found = exact_quantiles(_train(spark, sf_dir), {c: F.col(c) for c in NUMERIC}, [0.5])
    return tidy(spark.createDataFrame([(c.lower(), q[0] if q else None) for c, q in found.items()], "feature string, median double"))


@register(
    "impute_mode",
    with_base(" UNION ALL ".join(f"SELECT '{c.lower()}' AS feature, {ss('v', 'mode')} FROM mode_{c}" for c in CATS), _TF),
)
def q_impute_mode(spark, sf_dir):
    tr = _train(spark, sf_dir)
    agg = tr.agg(*[F.mode(F.col(c), True).alias(f"o{i}") for i, c in enumerate(CATS)])
    return tidy(_param_rows(agg, [F.struct(F.lit(c.lower()).alias("feature"), F.col(f"o{i}").alias("mode")) for i, c in enumerate(CATS)]))


def _fitted(spark, sf_dir):
    tr = written(_train(spark, sf_dir), "train")
    return tr, fit_transform_params(tr, CFG)


@register(
    "winsorize",
    with_base(" UNION ALL ".join(
        f"SELECT '{c.lower()}' AS feature, {sd(f'q_{c}[1]', 'lower')}, {sd(f'q_{c}[2]', 'upper')} FROM prm2" for c in NUMERIC), _TF),
)
def q_winsorize(spark, sf_dir):
    _, ft = _fitted(spark, sf_dir)
    return tidy(spark.createDataFrame([(c.lower(), ft.lower[c], ft.upper[c]) for c in NUMERIC], "feature string, lower double, upper double"))


@register(
    "standardize",
    with_base(" UNION ALL ".join(
        f"SELECT '{c.lower()}' AS feature, {sd(f'a_{c}', 'mean')}, {sd(f's_{c}', 'std')} FROM prm3" for c in NUMERIC), _TF),
)
def q_standardize(spark, sf_dir):
    from ..operators.transform import _clip, _impute

    tr, ft = _fitted(spark, sf_dir)
    aggs = []
    for i, c in enumerate(NUMERIC):
        x = _clip(_impute(c, ft), c, ft)
        aggs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"s{i}")]
    agg = tr.agg(*aggs)
    return tidy(_param_rows(agg, [
        F.struct(F.lit(c.lower()).alias("feature"), F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"))
        for i, c in enumerate(NUMERIC)
    ]))


_ONEHOT_SQL = (
    "SELECT " + si("customer_id", "customer_id") + ", lower(cats.col || '_' || cats.v) AS feature, "
    + sd("CASE " + " ".join(f"WHEN cats.col = '{c}' THEN CAST(tf.{c} = cats.v AS DOUBLE)" for c in CATS) + " END", "value")
    + " FROM tf, cats"
)


@register("one_hot", with_base(_ONEHOT_SQL, _TF))
def q_one_hot(spark, sf_dir):
    table, ft = transformed(spark, sf_dir)
    return tidy(long_format(table, ft.onehot_names(), keep=("customer_id",)))


def _long_numeric_sql(where: str = "", names=None) -> str:
    names = names or NUMERIC
    num = " UNION ALL ".join(
        f"SELECT customer_id, split, label, '{c.lower()}' AS feature, {c} AS value FROM tf {where}" for c in names
    )
    cat = (
        "SELECT customer_id, split, label, lower(cats.col || '_' || cats.v) AS feature, "
        "CASE " + " ".join(f"WHEN cats.col = '{c}' THEN CAST(tf.{c} = cats.v AS DOUBLE)" for c in CATS) + " END AS value "
        f"FROM tf, cats {where}"
    )
    return (
        f"SELECT {si('customer_id', 'customer_id')}, split, {si('label', 'label')}, feature, {sd('value', 'value')} "
        f"FROM ({num} UNION ALL {cat}) u"
    )


@register("feature_table", with_base(_long_numeric_sql(), _TF))
def q_feature_table(spark, sf_dir):
    table, ft = transformed(spark, sf_dir)
    return tidy(long_format(table, ft.all_feature_names))


@register("leakage_free_features", with_base(_long_numeric_sql("WHERE split <> 'train'"), _TF))
def q_leakage_free_features(spark, sf_dir):
    table, ft = transformed(spark, sf_dir)
    return tidy(long_format(table.filter(F.col("split") != "train"), ft.all_feature_names))


@register("behaviour_features", with_base(_long_numeric_sql("", CFG.behavior_numeric), _TF))
def q_behaviour_features(spark, sf_dir):
    table, ft = transformed(spark, sf_dir)
    return tidy(long_format(table, ft.behavior_feature_names))
