"""Connected components by alternating large-star and small-star, over edges kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithic.sources.shared import stable


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them, which tell whether a step has changed any."""
    seen = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), seen).first())


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest node around it. Edges are (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_lowest(both), "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = _lowest(edges)
    others = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that has an edge, but the smallest of its component, with that smallest node.

    ``edges`` are (u, v) of two long columns, in any direction; loops, repeated edges and edges with a null end say
    nothing. Nodes without an edge are not listed. A hot node costs no more than its edges: the minimum is taken before
    the shuffle, and a skewed join is split by Spark. Every step is written to the shared folder, so neither the lineage
    nor a lost executor grows with the number of steps.
    """
    ordered = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stable(ordered.where("u > v").distinct())
    before, state = None, _state(now)
    while state[0] and state != before:
        now = stable(small_star(large_star(now)))
        before, state = state, _state(now)
    return now
