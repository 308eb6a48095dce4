"""Global ranks and running sums without an unpartitioned window.

``row_number().over(Window.orderBy(...))`` moves every row into one task. Here the rows are dealt by
ranges of the full sort key (Spark samples the ranges; rows that tie in the first key are parted by
the next ones, so a hot score spreads), sorted inside each range and written to the shared folder. In
that table ``monotonically_increasing_id`` holds the partition and the row's place in it, so a rank is
that place plus the rows of the partitions before: one number a partition, prefix-summed and broadcast.
The written table makes every later read see the same ranges, also after a lost executor. The number
of ranges follows ``spark.sql.shuffle.partitions`` and adaptive coalescing. NULL keys are kept (first
in ascending, last in descending order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written

_PLACE_BITS = 33  # of monotonically_increasing_id: the lower ones count rows, the upper ones are the partition


def _norm_keys(keys) -> list[tuple[str, bool]]:
    return [(k[0], bool(k[1])) if isinstance(k, tuple) else (k, True) for k in keys]


def _sort_cols(keys) -> list[Column]:
    return [F.col(n).asc() if asc else F.col(n).desc() for n, asc in keys]


def _ordered(df: DataFrame, keys, n_parts: int | None) -> DataFrame:
    """``df`` written in the order of ``keys``, with ``_part`` and ``_place`` (0-based, inside the part)."""
    order = _sort_cols(_norm_keys(keys))
    dealt = df.repartitionByRange(n_parts, *order) if n_parts else df.repartitionByRange(*order)
    number = F.monotonically_increasing_id()
    return written(
        dealt.sortWithinPartitions(*order).withColumn("_number", number).withColumns(
            {"_part": F.shiftright("_number", _PLACE_BITS), "_place": F.col("_number").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))}
        ).drop("_number"),
        "ordered",
    )


def _offsets(ordered: DataFrame, sum_cols=()) -> DataFrame:
    """Totals of the parts before each part (one row a part, so the window and the broadcast are small)."""
    per = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"), *[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off_cnt")]
    cols += [F.coalesce(F.sum(f"_tot_{c}").over(w), F.lit(0)).alias(f"_off_{c}") for c in sum_cols]
    return F.broadcast(per.select("_part", *cols))


def with_global_rank(df: DataFrame, keys, rank_col: str = "rank", n_parts: int | None = None) -> DataFrame:
    """1-based position in the total order ``keys`` (must be unique, e.g. end with the id)."""
    ordered = _ordered(df, keys, n_parts)
    out = ordered.join(_offsets(ordered), "_part").withColumn(rank_col, F.col("_off_cnt") + F.col("_place") + 1)
    return out.drop("_part", "_place", "_off_cnt")


def with_running_sums(df: DataFrame, keys, sum_cols, n_parts: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` along the unique order ``keys``."""
    ordered = _ordered(df, keys, n_parts)
    w = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    out = ordered.join(_offsets(ordered, sum_cols), "_part")
    out = out.withColumns({f"{prefix}{c}": F.sum(c).over(w) + F.col(f"_off_{c}") for c in sum_cols})
    return out.drop("_part", "_place", "_off_cnt", *[f"_off_{c}" for c in sum_cols])


def rank_within(df: DataFrame, group: str, keys, rank_col: str = "rank_in_group", n_parts: int | None = None) -> DataFrame:
    """1-based rank inside ``group`` along ``keys`` without putting a group into one task.

    Global rank over (group, keys...) minus the rank before the group's first row; rows without a
    group are one group.
    """
    ranked = with_global_rank(df, [(group, True)] + _norm_keys(keys), rank_col="_grank", n_parts=n_parts)
    firsts = ranked.groupBy(F.col(group).alias("_group")).agg((F.min("_grank") - 1).alias("_goff"))
    out = ranked.join(firsts, ranked[group].eqNullSafe(firsts["_group"]))
    return out.withColumn(rank_col, F.col("_grank") - F.col("_goff")).drop("_grank", "_goff", "_group")
