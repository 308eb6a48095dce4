"""Segment-level business tables.

Inputs are one frame with a cluster column and a response column (align two
keyed frames first with :func:`with_labels`). Everything is one partial aggregation
per cluster; the per-cluster tables have K rows, so windows and cross joins
below run over K rows only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_labels(df: DataFrame, labels: DataFrame, key: str = "customer_id", cluster: str = "cluster") -> DataFrame:
    """Every row of ``df`` with its cluster from ``labels``; an error where a row would have none or two."""
    of = labels.select(key, cluster).filter(F.col(cluster).isNotNull())
    bad = of.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).limit(1).count()
    if bad or df.join(of, key, "left_anti").limit(1).count():
        raise ValueError(f"{cluster} cannot be aligned: a row has no label or {key} is repeated among the labels")
    return df.drop(cluster).join(of, key)


def _valid(df: DataFrame, cluster: str, response: str) -> DataFrame:
    r = F.col(response).cast("double")
    return df.filter(F.col(cluster).isNotNull() & r.isNotNull() & ~F.isnan(r)).select(
        F.col(cluster).alias("cluster"), r.alias("response")
    )


def segmentation_table(df: DataFrame, cluster: str = "cluster", response: str = "label") -> DataFrame:
    """Cluster, size, positives, negatives, response_rate."""
    v = _valid(df, cluster, response)
    return (
        v.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("size"), F.sum("response").alias("positives"))
        .withColumns(
            {
                "negatives": F.col("size") - F.col("positives"),
                "response_rate": F.col("positives") / F.col("size"),
            }
        )
        .select("cluster", "size", "positives", "negatives", "response_rate")
    )


cluster_response_summary = segmentation_table


def cluster_response_rates(df: DataFrame, cluster: str = "cluster", response: str = "label") -> DataFrame:
    """B1: mean response per cluster."""
    v = _valid(df, cluster, response)
    return v.groupBy("cluster").agg(F.avg("response").alias("response_rate"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """B2: rows per (non-NULL) cluster."""
    return df.filter(F.col(cluster).isNotNull()).groupBy(F.col(cluster).alias("cluster")).agg(
        F.count(F.lit(1)).alias("cluster_size")
    )


def response_rate_dispersion(rates: DataFrame, rate: str = "response_rate", ddof: int = 0) -> DataFrame:
    """Unweighted variance (population), std (``ddof``) and range of the cluster rates."""
    r = F.col(rate)
    std = F.stddev_pop(r) if ddof == 0 else F.stddev_samp(r)
    return rates.filter(r.isNotNull() & ~F.isnan(r)).agg(
        F.var_pop(r).alias("response_rate_variance"),
        std.alias("response_rate_std"),
        (F.max(r) - F.min(r)).alias("response_rate_range"),
    )


def weighted_rate_variance(df: DataFrame, cluster: str = "cluster", response: str = "label") -> DataFrame:
    """Cluster-size-weighted variance of the cluster rates (one row)."""
    t = segmentation_table(df, cluster, response)
    total = t.agg(F.sum("size").alias("n"), F.sum("positives").alias("p"))
    mean = F.col("p") / F.col("n")
    return (
        t.crossJoin(F.broadcast(total))  # one-row total
        .agg(
            F.sum(F.col("size") / F.col("n") * F.pow(F.col("response_rate") - mean, 2)).alias(
                "weighted_rate_variance"
            )
        )
    )


def cluster_lift_table(df: DataFrame, cluster: str = "cluster", response: str = "label") -> DataFrame:
    """Size, share, response_rate and lift over the global rate (NULL when it is 0)."""
    t = segmentation_table(df, cluster, response)
    total = t.agg(F.sum("size").alias("_n"), F.sum("positives").alias("_p"))
    g = F.col("_p") / F.col("_n")
    return (
        t.crossJoin(F.broadcast(total))  # one-row total
        .select(
            "cluster",
            "size",
            (F.col("size") / F.col("_n")).alias("share"),
            "response_rate",
            F.when(g > 0, F.col("response_rate") / g).alias("lift_vs_global"),
        )
        .orderBy(F.col("response_rate").desc(), F.col("cluster").asc())
    )


def allocation_table(t: DataFrame, budget: F.Column) -> DataFrame:
    """Takes per cluster: best rate first (ties by cluster id), last one partial."""
    w = Window.orderBy(F.col("response_rate").desc(), F.col("cluster").asc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    prev = F.coalesce(F.sum("size").over(w), F.lit(0))
    return t.withColumn("take", F.least(F.col("size"), F.greatest(F.lit(0), budget - prev)))


def campaign_allocation(
    df: DataFrame, budget_frac: float = 0.2, cluster: str = "cluster", response: str = "label"
) -> DataFrame:
    """Cluster-level budgeted targeting vs random (one row, per-cluster takes as a map)."""
    if not (0.0 < float(budget_frac) <= 1.0):
        raise ValueError(f"budget_frac must be in (0,1], got {budget_frac}")
    t = segmentation_table(df, cluster, response)
    total = t.agg(F.sum("size").alias("n_total"), F.sum("positives").alias("_p"))
    n_sel = F.ceil(F.col("n_total") * F.lit(float(budget_frac))).cast("bigint")
    t2 = t.crossJoin(F.broadcast(total)).withColumn("n_selected", n_sel)
    alloc = allocation_table(t2, F.col("n_selected"))
    g = F.col("_p") / F.col("n_total")
    return alloc.groupBy("n_total", "n_selected", "_p").agg(
        F.sum(F.col("take") * F.col("response_rate")).alias("expected_responders_targeted"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.when(F.col("take") > 0, F.struct("cluster", "take"))))
        ).alias("selected_from_clusters"),
    ).select(
        F.lit(float(budget_frac)).alias("budget_frac"),
        "n_total",
        "n_selected",
        g.alias("global_response_rate"),
        "expected_responders_targeted",
        (g * F.col("n_selected")).alias("expected_responders_random"),
        F.when(g * F.col("n_selected") > 0, F.col("expected_responders_targeted") / (g * F.col("n_selected"))).alias(
            "lift"
        ),
        "selected_from_clusters",
    )


def budget_to_k(n: int, frac: float) -> int:
    """R1 on the driver: ``ceil(n * f)``; 0 for n <= 0; f must be in (0, 1]."""
    if n <= 0:
        return 0
    f = float(frac)
    if not (0.0 < f <= 1.0):
        raise ValueError(f"top_frac must be in (0, 1], got {frac}.")
    return int(math.ceil(n * f))
