"""Helpers shared by the training-data operators: shared tables, bounded bitmaps, row filters."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_folder, written  # noqa: F401  (used by the operators)

#: Bits of the broadcast membership bitmap: 2**23 bits are 256 rows of 4 KB, 1 MB whatever the input.
BITMAP_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def membership_bitmap(hashes: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """A bitmap of fixed size with the bit of every hash in ``column`` (a long) set.

    One row of 4 KB per 32,768 bits, so its size is at most ``bits / 8`` bytes for any input;
    that bound is what allows ``may_contain`` to broadcast it.
    """
    place = F.pmod(F.col(column), F.lit(bits)) + 1
    return hashes.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap")
    )


def may_contain(df: DataFrame, column: str, bitmap: DataFrame, out: str, bits: int = BITMAP_BITS) -> DataFrame:
    """Adds boolean ``out``: False only if the hash in ``column`` is surely not in ``bitmap``."""
    place = F.pmod(F.col(column), F.lit(bits)) + 1
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (at % 8).cast("int")) == 1
    return (
        df.withColumn("_bucket", F.bitmap_bucket_number(place))
        .join(F.broadcast(bitmap), "_bucket", "left")
        .withColumn(out, F.coalesce(hit, F.lit(False)))
        .drop("_bucket", "_bitmap")
    )


def without_ids(docs: DataFrame, losers: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``losers`` (one column, the key); NULL keys compare equal.

    The bounded bitmap lets rows that surely stay pass without a shuffle of their texts; only rows
    that may be losers go through the exact anti-join.
    """
    columns = docs.columns
    losers = losers.select(F.col(key).alias("_loser"), F.xxhash64(key).alias("_hash"))
    marked = may_contain(docs.withColumn("_hash", F.xxhash64(key)), "_hash", membership_bitmap(losers, "_hash"), "_maybe")
    stay = marked.filter(~F.col("_maybe")).select(*columns)
    doubt = marked.filter("_maybe").select(*columns)
    return stay.unionByName(doubt.join(losers.select("_loser").distinct(), doubt[key].eqNullSafe(F.col("_loser")), "left_anti"))


def sheltered(docs: DataFrame, *read: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` for inner work, and the columns that turn a result of it back.

    Inside, only the columns in ``read`` keep their names; the others are called after their place, so
    that no helper column can have the name of one of them.
    """
    inner = {c: c if c in read else f"given_{i}" for i, c in enumerate(docs.columns)}
    outer = lambda c: F.col(f"`{c.replace('`', '``')}`")
    return docs.select(*[outer(c).alias(n) for c, n in inner.items()]), [F.col(n).alias(c) for c, n in inner.items()]


#: Rows whose texts are Python objects at the same time.
ROWS_AT_ONCE = 256


def sliced(batches):
    """Arrow batches in slices of few rows, which bounds the Python objects of a worker, however large
    the batches are; memory that Arrow has freed goes back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)
        pa.default_memory_pool().release_unused()


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit(""))
