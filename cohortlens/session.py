"""Spark session helpers and small schema utilities shared by every operator."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


#: Settings of this library; each is applied only where the session has no value of its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app_name: str = "cohortlens", shuffle_partitions: int | None = None) -> SparkSession:
    """The running session as it is, or a new local one.

    A running session is not changed: what it does not set keeps Spark's defaults. A new session is
    local (``master``, or all cores), without a web page, and has the settings in ``DEFAULTS``.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        return running
    builder = SparkSession.builder.appName(app_name).master(master or os.environ.get("SPARK_MASTER", "local[*]"))
    options = {**DEFAULTS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = builder.config(map=options).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_columns(df: DataFrame, columns, what: str = "operation") -> None:
    """Raise ``KeyError`` naming every missing column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing columns required for {what}: {missing}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the test tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
