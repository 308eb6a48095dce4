"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and,
where one exists, an equivalent DuckDB SQL oracle over the same parquet tables.

Outputs are normalised the same way on both sides: integral columns become
``bigint``, floating columns are rounded to 6 decimals with the identical IEEE
formula ``floor(x * 1e6 + 0.5) / 1e6`` (so both engines produce the same bits).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCALE = 1000000.0
_S = "CAST(1000000.0 AS DOUBLE)"
_H = "CAST(0.5 AS DOUBLE)"


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def r6(c):
    y = c.cast("double") * F.lit(SCALE) + F.lit(0.5)
    # doubles at or above 2**53 are integers already; below that floor() via bigint is exact
    fl = F.when(F.abs(y) < F.lit(9.0e15), F.floor(y).cast("double")).otherwise(y)
    return fl / F.lit(SCALE)


def tidy(df: DataFrame) -> DataFrame:
    """Normalise output types: ints -> bigint, floats -> rounded double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType)):
            cols.append(c.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(r6(c).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            cols.append(F.transform(c, lambda x: r6(x)).alias(f.name))
        else:
            cols.append(c.alias(f.name))
    return df.select(*cols)


def sd(expr: str, name: str) -> str:
    """SQL: rounded double column."""
    return f"floor(CAST({expr} AS DOUBLE) * {_S} + {_H}) / {_S} AS {name}"


def si(expr: str, name: str) -> str:
    """SQL: bigint column."""
    return f"CAST({expr} AS BIGINT) AS {name}"


def ss(expr: str, name: str) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name}"


def sa(expr: str, name: str) -> str:
    """SQL: list of rounded doubles."""
    return f"list_transform({expr}, lambda x: floor(CAST(x AS DOUBLE) * {_S} + {_H}) / {_S}) AS {name}"
