"""Connected components of an edge table by alternating large-star and small-star steps.

Each step hangs neighbours under the least node known, by an aggregate with map-side combine and an equi-join, so a
node with very many neighbours is a skewed join that adaptive execution splits. Rounds are stored in the shared
folder and end when only stars are left, which one aggregate tells; the driver reads one answer per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, least): the least of a node and its neighbours."""
    return edges.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.where("v > u").join(_least_neighbour(both), "u")
        .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the greater node u to the lesser v."""
    below = _least_neighbour(edges)
    return (
        edges.join(below, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        .unionAll(below.where("u <> least").select("u", F.col("least").alias("v"))).distinct()
    )


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node hangs under one other at most, and none of those hangs itself: then nothing is left to do."""
    nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(
        edges.select("v", F.lit(0), F.lit(1)))
    return nodes.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where(
        "hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: bigint); component is the least node reachable.

    Self links, repeated links and links with a null are ignored; an empty table gives an empty table.
    """
    edges = scratch.keep(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _only_stars(edges):
        stepped = scratch.keep(_small_star(_large_star(edges)), "edges")
        scratch.drop(edges)
        edges = stepped
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v"), F.col("v").alias("component")).distinct())
