"""Exact-count, seeded, stratified row splits.

Rows are ordered inside each stratum by ``md5(seed || '|' || key)`` (ties by the
key), which is independent of partitioning and of row order. Split sizes follow
the reference: ``n_test = ceil(test_size * n)``, then ``n_val =
ceil(val_size / (1 - test_size) * (n - n_test))`` on the rest. Each stratum gets
``floor(n_s * k / n)`` rows plus one for the strata with the largest remainders
(ties by stratum value), so totals are exact and shares follow the strata.

The strata table has one row per stratum (a label: two rows), so the windows on
it are tiny; the per-row rank uses the range-partitioned rank of :mod:`rank`.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rank import with_global_rank


def _validate(test_size: float, val_size: float) -> None:
    if not (0.0 < test_size < 1.0) or not (0.0 < val_size < 1.0):
        raise ValueError(f"test_size is {test_size} and val_size {val_size}; each must lie between 0 and 1")
    if test_size + val_size >= 1.0:
        raise ValueError(f"test_size and val_size take {test_size + val_size} of the rows; something must be left to train on")


def _allocate(counts: DataFrame, need_col: str, size_col: str, total_col: str, out_col: str) -> DataFrame:
    """Largest-remainder allocation of ``need`` rows over strata of ``size`` rows."""
    # exact integer arithmetic in decimal(38,0): n_s * k overflows bigint on very large tables
    prod = F.col(size_col).cast("decimal(38,0)") * F.col(need_col).cast("decimal(38,0)")
    total = F.col(total_col).cast("decimal(38,0)")
    base = F.when(total > 0, F.floor(prod / total)).otherwise(0).cast("bigint")
    rem = F.when(total > 0, prod % total).otherwise(0)
    w_all = Window.partitionBy(F.lit(1))  # strata table: one row per stratum
    c = counts.withColumns({"_base": base, "_rem": rem})
    c = c.withColumn("_deficit", F.col(need_col) - F.sum("_base").over(w_all))
    w = Window.partitionBy(F.lit(1)).orderBy(F.col("_rem").desc(), F.col("_stratum").asc())
    c = c.withColumn("_extra", (F.row_number().over(w) <= F.col("_deficit")).cast("bigint"))
    return c.withColumn(out_col, F.col("_base") + F.col("_extra")).drop("_base", "_rem", "_deficit", "_extra")


def assign_splits(
    df: DataFrame,
    key: str = "customer_id",
    stratify_col: str | None = "label",
    test_size: float = 0.2,
    val_size: float = 0.1,
    seed: int = 42,
    two_way: bool = False,
) -> DataFrame:
    """Add ``split`` in {train, val, test} (``two_way``: {train, val} with ``val_size``)."""
    if two_way:
        if not (0.0 < val_size < 1.0):
            raise ValueError(f"val_size is {val_size}; it must lie between 0 and 1")
    else:
        _validate(test_size, val_size)
    stratum = F.col(stratify_col).cast("string") if stratify_col else F.lit("all")
    h = F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(key).cast("string")))
    base = df.withColumns({"_stratum": F.coalesce(stratum, F.lit("~null")), "_h": h})

    ranked = with_global_rank(base, [("_stratum", True), ("_h", True), (key, True)], rank_col="_grank")

    # counted in the written table of the ranks, so ``df`` is not derived a second time
    counts = ranked.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_ns"))
    w_all = Window.partitionBy(F.lit(1))  # one row per stratum
    counts = counts.withColumn("_n", F.sum("_ns").over(w_all))
    if two_way:
        counts = counts.withColumn("_need_a", F.ceil(F.lit(float(val_size)) * F.col("_n")).cast("bigint"))
        counts = _allocate(counts, "_need_a", "_ns", "_n", "_a")
        counts = counts.withColumn("_b", F.lit(0).cast("bigint"))
        first, second = "val", None
    else:
        rel = float(val_size) / (1.0 - float(test_size))
        counts = counts.withColumn("_need_a", F.ceil(F.lit(float(test_size)) * F.col("_n")).cast("bigint"))
        counts = _allocate(counts, "_need_a", "_ns", "_n", "_a")
        counts = counts.withColumns(
            {"_rest_s": F.col("_ns") - F.col("_a"), "_rest": F.col("_n") - F.col("_need_a")}
        ).withColumn("_need_b", F.ceil(F.lit(rel) * F.col("_rest")).cast("bigint"))
        counts = _allocate(counts, "_need_b", "_rest_s", "_rest", "_b")
        first, second = "test", "val"
    w_off = Window.partitionBy(F.lit(1)).orderBy("_stratum").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_ns").over(w_off), F.lit(0))).select(
        "_stratum", "_off", "_a", "_b"
    )
    # one row per stratum, which Spark cannot know beforehand: a shuffle by stratum would send a class to one task
    out = ranked.join(F.broadcast(counts), "_stratum")
    r = F.col("_grank") - F.col("_off")
    split = F.when(r <= F.col("_a"), F.lit(first))
    if second:
        split = split.when(r <= F.col("_a") + F.col("_b"), F.lit(second))
    split = split.otherwise(F.lit("train"))
    return out.withColumn("split", split).drop("_stratum", "_h", "_grank", "_off", "_a", "_b")


def split_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and positives per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(label)).alias("n_positive"))


def expected_sizes(n: int, test_size: float = 0.2, val_size: float = 0.1) -> tuple[int, int, int]:
    n_test = math.ceil(test_size * n)
    n_val = math.ceil(val_size / (1.0 - test_size) * (n - n_test))
    return n - n_test - n_val, n_val, n_test
