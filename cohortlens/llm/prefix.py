"""Running sums of an ordered table within keys, in two passes and without a task per key.

The rows are dealt by ranges of (keys, order), so a hot key spans several partitions. Each partition
adds up as it streams and the result is written; only the first key of a partition can have begun
earlier, so one number a partition (the sum of that key in the partitions before) completes the sums.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written


def sums_before(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``df`` and ``out``: the sum of ``value`` (a long) over the rows of the same keys that come earlier.

    Rows that agree in all of ``keys`` and ``order`` must have been made one row before; NULL keys are
    keys, NULLs sort first. The result is read from the shared folder.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(c) for c in (*keys, *order)]
    dealt = df.repartitionByRange(n, *columns).sortWithinPartitions(*columns)
    at = [df.columns.index(c) for c in (*keys, value)]

    def run(batches):
        part, current, total, number = TaskContext.get().partitionId(), None, 0, -1
        for batch in batches:
            sums, numbers = [], []
            *key_columns, values = (batch.column(i).to_pylist() for i in at)
            for v, *key in zip(values, *key_columns):
                if key != current:
                    current, total, number = key, 0, number + 1
                sums.append(total)
                numbers.append(number)
                total += v
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.int64()), pa.array(numbers, pa.int64()), pa.array([part] * len(sums), pa.int64())],
                [*batch.schema.names, out, "_key", "_part"],
            )

    extra = [T.StructField(c, T.LongType()) for c in (out, "_key", "_part")]
    local = written(dealt.mapInArrow(run, T.StructType([*df.schema.fields, *extra])), "running-sums")
    ends = local.groupBy("_part").agg(F.max("_key").alias("last"))
    edge = F.struct(*[F.col(k) for k in keys])
    # one row a partition: its first key with that key's total, and its last key with its total
    firsts = local.filter("_key = 0").groupBy("_part").agg(F.first(edge).alias("first_key"), F.sum(value).alias("first_total"))
    lasts = local.join(F.broadcast(ends), "_part").filter("_key = last").groupBy("_part").agg(F.first(edge).alias("last_key"), F.sum(value).alias("last_total"))
    parts = firsts.join(lasts, "_part").join(ends, "_part").orderBy("_part").collect()
    carry, open_key, carried = {}, None, 0
    for r in parts:
        base = carried if open_key is not None and tuple(open_key) == tuple(r["first_key"]) else 0
        carry[r["_part"]] = base
        carried = r["last_total"] + (base if r["last"] == 0 else 0)
        open_key = r["last_key"]
    offsets = df.sparkSession.createDataFrame(list(carry.items()), "_part long, _base long")
    done = local.join(F.broadcast(offsets), "_part", "left")  # one row a partition
    return done.withColumn(out, F.col(out) + F.when(F.col("_key") == 0, F.coalesce("_base", F.lit(0))).otherwise(0)).drop("_part", "_key", "_base")
