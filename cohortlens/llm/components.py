"""Connected components of a link table, distributed: minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``; the component is its smallest node.

    A round gives each node the smallest label among its neighbours and then the label of its label,
    so chains shrink by halves. Each round is written to the shared folder, which cuts the lineage;
    only the question "did anything change" reaches the driver. Hot nodes are met by map-side
    minima and by joins that adaptive execution can split.
    """
    both = written(
        edges.select(F.col(left).alias("u"), F.col(right).alias("v"))
        .unionByName(edges.select(F.col(right).alias("u"), F.col(left).alias("v")))
        .filter("u <> v").distinct(),
        "links",
    )
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("heard"))
        hooked = labels.join(heard, "node").select("node", F.least("label", "heard").alias("hooked"), F.col("label").alias("before"))
        jump = hooked.select(F.col("node").alias("hooked"), F.col("hooked").alias("jumped"))
        after = written(
            hooked.join(jump, "hooked").select("node", F.least("hooked", "jumped").alias("label"), "before"), "labels"
        )
        labels = after.select("node", "label")
        if after.filter("label <> before").isEmpty():
            return labels.withColumnRenamed("label", "component")
