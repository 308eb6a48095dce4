"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows of a part of a frame that models read again and again: at most, and at least where there are cores to spare.
PART_ROWS = (1_000, 50_000)


def dealt(df: DataFrame) -> DataFrame:
    """The rows of ``df`` in parts of equal size, for a frame that many passes read: a part for every core, more
    where a part would exceed ``PART_ROWS``.

    Files and adaptive shuffles make parts of so many bytes; packed columns or a few large files leave most
    cores idle, and the task of a part reads most of the table.
    """
    fewest, most = PART_ROWS
    n = df.count()
    parts = min(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // most)), max(1, -(-n // fewest)))
    return df.repartition(parts)


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting (tests) gets a temporary folder; on a cluster an unset
    folder is an error, since a machine-local one would lose files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="cohortlens-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, fixes row ids, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cohortlens/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)
