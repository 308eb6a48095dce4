"""Metric-table sink, assignment sink and assignment source with alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: write a metric table; map/array columns become JSON text for CSV."""
    if fmt == "csv":
        cols = [
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)) else F.col(f.name)
            for f in df.schema.fields
        ]
        df.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_assignments(df: DataFrame, path: str, key: str = "customer_id", cluster: str = "cluster", split: str | None = "split") -> None:
    """One row per customer with its cluster (and split), partitioned by split."""
    cols = [key] + ([split] if split and split in df.columns else []) + [cluster]
    writer = df.select(*cols).write.mode("overwrite")
    if split and split in df.columns:
        writer = writer.partitionBy(split)
    writer.parquet(path)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def align_assignments(features: DataFrame, assignments: DataFrame, key: str = "customer_id", cluster: str = "cluster") -> DataFrame:
    """Left-join assignments onto the feature rows; rows without one are flagged.

    Returns the feature rows with ``cluster`` (int) and ``has_assignment``; callers
    filter on it (the reference counts the missing ones and drops them).
    """
    a = assignments.select(F.col(key), F.col(cluster).cast("int").alias("_cl"))
    return (
        features.join(a, key, "left")
        .withColumn("has_assignment", F.col("_cl").isNotNull())
        .withColumnRenamed("_cl", cluster)
    )
