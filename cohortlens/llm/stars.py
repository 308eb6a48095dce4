"""Connected components by alternating large-star and small-star.

Every round turns the links of a component into links to smaller nodes: large-star moves the larger
neighbours of a node to the smallest node around it, small-star does so for the smaller neighbours and
the node itself. Both keep what is connected connected. When each node has one parent that is no node's
child, every component is a star around its smallest node.

A round is two minima with map-side combining and two joins that adaptive execution can split, and is
written to the shared folder, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def large_star(edges: DataFrame) -> DataFrame:
    """``edges`` (child, parent; child > parent): larger neighbours move to the smallest node around."""
    around = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionByName(edges.select(F.col("parent").alias("u"), F.col("child").alias("v")))
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("child"), F.col("m").alias("parent")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its parents move to the smallest of them."""
    least = edges.groupBy("child").agg(F.min("parent").alias("m"))
    moved = edges.join(least, "child").filter("parent <> m").select(F.col("parent").alias("child"), F.col("m").alias("parent"))
    return moved.unionByName(least.withColumnRenamed("m", "parent")).distinct()


def is_star_forest(edges: DataFrame) -> bool:
    inner = edges.join(edges.select(F.col("child").alias("parent")), "parent", "left_semi")
    return inner.isEmpty() and edges.groupBy("child").count().filter("count > 1").isEmpty()


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` of every node of ``links``; the component is its smallest node.

    Repeated links and both directions are one link, a node linked to itself is a component.
    """
    a, b = F.col(left), F.col(right)
    alone = links.filter(a == b).select(a.alias("node"), b.alias("component"))
    edges = written(links.filter(a != b).select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).distinct(), "stars")
    while not is_star_forest(edges):
        edges = written(small_star(large_star(edges)), "stars")
    found = edges.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(
        edges.select(F.col("parent").alias("node"), F.col("parent").alias("component"))
    )
    return found.unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
