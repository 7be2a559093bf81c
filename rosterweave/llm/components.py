"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterweave.plans.staging import Stage


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = _mirrored(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number and hash sum of the edges; equal marks of two rounds mean that nothing moved."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """``node, root`` for every node of ``edges (a long, b long)``; the root is its least node.

    A round is two joins on grouped minima; the minima are combined before the shuffle, and a
    node with very many neighbours is split by the skew join. Rounds grow with the logarithm of
    the longest path. Each round is a stored table, so lineage stays short.
    """
    edges = stage(edges.where("a <> b").distinct(), "edges_0")
    mark, turn = _mark(edges), 0
    while mark[0]:
        turn += 1
        edges = stage(_small_star(_large_star(edges)), f"edges_{turn}")
        mark, last = _mark(edges), mark
        if mark == last:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
