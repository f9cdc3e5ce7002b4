"""Connected components of an edge table, wholly in Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import compact


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(turned)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    near = _both_ways(edges)
    low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return near.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Edges lead downwards."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    tied = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return tied.unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge down, to a node that has none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
    return nodes.where("down > 1 or (down = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edge table ``(a, b)``; the
    component is its smallest node.

    Alternates two rewirings until every node is tied to the smallest of its
    component; the number of rounds grows with the logarithm of the longest
    path. Each round is a written table, so a lost executor costs one round.
    Self-loops and repeated edges are harmless; no edges give no rows.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = compact(down, "edges")
    while not _settled(edges):
        edges = compact(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    ).distinct()
