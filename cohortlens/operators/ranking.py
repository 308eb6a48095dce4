"""Ranking under a budget.

One global rank pass (score descending, ties by the smaller key) through
:func:`rank.with_global_rank`, then one aggregate with a conditional sum per
budget fraction; ``k = ceil(n * f)`` is computed in the plan from a one-row
total, so nothing but the final metric rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite
from .rank import with_global_rank

DEFAULT_FRACTIONS = (0.05, 0.1, 0.2, 0.3, 0.5)


def _check_frac(f: float) -> float:
    f = float(f)
    if not (0.0 < f <= 1.0):
        raise ValueError(f"top_frac is {f}; it must be above 0 and at most 1")
    return f


def ranked(df: DataFrame, label: str = "label", score: str = "score", key: str = "customer_id", use_label: bool = True) -> DataFrame:
    s = F.col(score).cast("double")
    cond = finite(s)
    if use_label:
        cond = cond & finite(F.col(label).cast("double"))
    cols = [F.col(key), s.alias("s")]
    if use_label:
        cols.append(F.col(label).cast("double").alias("y"))
    v = df.filter(cond).select(*cols)
    return with_global_rank(v, [("s", False), (key, True)])


def ranking_summary(
    df: DataFrame, label: str = "label", score: str = "score", fractions=DEFAULT_FRACTIONS, key: str = "customer_id"
) -> DataFrame:
    """Frac, k, base_rate, precision, recall, lift, positives_in_top, expected_score_sum_in_top."""
    fr = [_check_frac(f) for f in fractions]
    r = ranked(df, label, score, key)
    ybin = (F.col("y") > 0).cast("int")
    n_expr = F.count(F.lit(1))
    aggs = [n_expr.alias("n"), F.sum(ybin).alias("P")]
    for i, f in enumerate(fr):
        k = F.ceil(F.col("_n") * F.lit(f))
        inside = F.col("rank") <= k
        aggs += [
            F.sum(F.when(inside, F.col("y"))).alias(f"ys_{i}"),
            F.sum(F.when(inside, ybin)).alias(f"pos_{i}"),
            F.sum(F.when(inside, F.col("s"))).alias(f"ss_{i}"),
        ]
    total = r.agg(F.count(F.lit(1)).alias("_n"))
    a = r.crossJoin(F.broadcast(total)).agg(*aggs)  # one-row total
    structs = []
    for i, f in enumerate(fr):
        k = F.ceil(F.col("n") * F.lit(f)).cast("bigint")
        base = F.col("P") / F.col("n")
        prec = F.when(k > 0, F.col(f"ys_{i}") / k)
        structs.append(
            F.struct(
                F.lit(f).alias("frac"),
                k.alias("k"),
                base.alias("base_rate"),
                prec.alias("precision"),
                F.when(F.col("P") > 0, F.col(f"pos_{i}") / F.col("P")).alias("recall"),
                F.when(base > 0, prec / base).alias("lift"),
                F.col(f"pos_{i}").cast("double").alias("positives_in_top"),
                F.col(f"ss_{i}").alias("expected_score_sum_in_top"),
            )
        )
    # one aggregate row -> one output row per fraction (no re-computation per fraction)
    return a.filter(F.col("n") > 0).select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def precision_at_frac(df, label="label", score="score", top_frac=0.2, key="customer_id") -> DataFrame:
    """R2."""
    return ranking_summary(df, label, score, [top_frac], key).select(F.col("precision").alias("precision_at_frac"))


def recall_at_frac(df, label="label", score="score", top_frac=0.2, key="customer_id") -> DataFrame:
    """R3."""
    return ranking_summary(df, label, score, [top_frac], key).select(F.col("recall").alias("recall_at_frac"))


def positives_in_top(df, label="label", score="score", top_frac=0.2, key="customer_id") -> DataFrame:
    """R4."""
    return ranking_summary(df, label, score, [top_frac], key).select("positives_in_top")


def expected_score_sum(df, score="score", top_frac=0.2, key="customer_id") -> DataFrame:
    """Sum of the top-k scores; only the score has to be present."""
    f = _check_frac(top_frac)
    r = ranked(df, score=score, key=key, use_label=False)
    total = r.agg(F.count(F.lit(1)).alias("_n"))
    return (
        r.crossJoin(F.broadcast(total))  # one-row total
        .agg(F.sum(F.when(F.col("rank") <= F.ceil(F.col("_n") * F.lit(f)), F.col("s"))).alias("expected_score_sum"))
    )


def lift_at_frac(df, label="label", score="score", top_frac=0.2, key="customer_id") -> DataFrame:
    """R6."""
    return ranking_summary(df, label, score, [top_frac], key).select(F.col("lift").alias("lift_at_frac"))


def lift_curve(df, label="label", score="score", fractions=DEFAULT_FRACTIONS, key="customer_id") -> DataFrame:
    """Lift at several fractions (fractions outside (0, 1] are skipped)."""
    fr = [float(f) for f in fractions if 0.0 < float(f) <= 1.0]
    return ranking_summary(df, label, score, fr, key).select("frac", "lift")


def ranking_metrics(df, label="label", score="score", top_frac=0.2, key="customer_id") -> DataFrame:
    """One-row record at one budget."""
    return ranking_summary(df, label, score, [top_frac], key).select(
        "base_rate",
        F.col("precision").alias("precision_top"),
        F.col("recall").alias("recall_top"),
        F.col("lift").alias("lift_top"),
        "positives_in_top",
        F.col("expected_score_sum_in_top"),
    )
