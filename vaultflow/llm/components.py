"""Connected components of a graph of longs by alternating large-star and small-star steps.

Every step is a few grouped minima and joins, whose hot nodes Spark's adaptive plans split; nothing
but counts comes to the driver, and each step is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultflow.llm._common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether all edges lead to roots: no node has two, and none that is led to has one."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a", "n")
    led_to = edges.select(F.col("b").alias("a")).distinct()
    return several.join(led_to.withColumn("inner", F.lit(1)), "a", "left").filter("n > 1 OR inner = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of edges (a, b: longs, in any
    order, repeated or not) that is not a root itself."""
    a, b = F.col("a"), F.col("b")
    now = edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = materialise(now, "edges")
    while not _is_done(now):
        now = materialise(_small_star(materialise(_large_star(now), "edges")), "edges")
    return now.select(a.alias("node"), b.alias("root"))
