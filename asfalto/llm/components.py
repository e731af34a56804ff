"""Connected components of links, by alternating large-star and small-star steps.

Each step is an aggregation and a join; a centre with very many links is added up before the
shuffle, and joins on it can be split by adaptive execution. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.operators.layout import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the least of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
    return (
        around.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return (
        smaller.unionByName(least.select("a", F.col("_m").alias("b"))).where("a <> b").distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (a, b); the component is its least node.

    No edges give no rows; an edge from a node to itself is left out.
    """
    directed = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(directed.where("a <> b").distinct(), "links")
    seen = _state(current)
    while seen[0]:
        following = stage(_small_star(_large_star(current)), "links")
        now = _state(following)
        current = following
        if now == seen:
            break
        seen = now
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
