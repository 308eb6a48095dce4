"""Stateless scoring of arriving customer rows with train-fitted parameters.

The reference is batch only; its row-local steps (cleaning, derived features,
the train-fitted transform, segment assignment and response scoring) are pure
projections, so the same column expressions run unchanged on a streaming
DataFrame. No state, watermark or aggregation is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import clean_campaign
from ..operators.joint import JointConfig, JointParams, predict_clusters, predict_response
from ..operators.transform import FittedTransform, prepare_for_fit, transform_columns


def score_rows(raw: DataFrame, ft: FittedTransform, prm: JointParams, cfg: JointConfig,
               reference_date: str, reference_year: int) -> DataFrame:
    """Raw campaign rows -> customer_id, cluster, score (works for batch and streaming frames).

    Duplicate removal (C1) is a batch step and is not applied here: a stream
    would need state for it, which the reference never uses.
    """
    cleaned = clean_campaign(raw, reference_date, reference_year, dedup=not raw.isStreaming)
    prepared = prepare_for_fit(cleaned, reference_date=reference_date, reference_year=reference_year)
    cols = transform_columns(ft)
    feats = prepared.select("customer_id", *[e.alias(n) for n, e in cols.items()])
    q = lambda n: F.col(f"`{n}`")
    arr = feats.select(
        "customer_id",
        F.array(*[q(n) for n in ft.behavior_feature_names]).alias("xb"),
        F.array(*[q(n) for n in ft.all_feature_names]).alias("xf"),
    )
    return arr.select(
        "customer_id",
        predict_clusters(F.col("xb"), prm, cfg).alias("cluster"),
        predict_response(F.col("xb"), F.col("xf"), prm, cfg).alias("score"),
    )


def start_scoring(spark, source_dir: str, schema, ft, prm, cfg, reference_date, reference_year, out_dir: str, checkpoint_dir: str):
    """readStream (parquet files) -> score_rows -> parquet files in ``out_dir``; returns the running query."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    scored = score_rows(stream, ft, prm, cfg, reference_date, reference_year)
    return scored.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint_dir).start(out_dir)
