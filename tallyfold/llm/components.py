"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.store import forget, settle


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of those; every edge has u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the least node it reaches) for every node of ``links`` (a, b: long).

    Nodes are spread by key and a node's edges are joined with one least neighbour, which is summed up in each task
    first. Every round is written to the shared folder. Links from a node to itself and repeats are allowed.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        large = settle(_large_star(edges))
        small = settle(_small_star(large))
        forget(edges, large)
        edges = small
        before, state = state, edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.max("u")).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
