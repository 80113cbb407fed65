"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either the lower end of its edges or the upper end of one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up + down > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node that has an edge; `component` is its smallest node.

    `edges` holds a, b in any direction; loops and repeated edges change nothing. Neighbours are
    attached to the smallest of them, first those above a node, then those below it, until only
    stars around smallest nodes are left: a number of rounds in the order of the square of log n.
    The minima of all neighbours are settled before they are joined, so that the partition of a
    node with very many neighbours can be split.
    """
    big, small = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = shared.settle(edges.where("a <> b").select(big, small).distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = shared.settle(both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")), "lowest")
        large = shared.settle(both.where("b > a").join(low, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        below = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = shared.settle(below.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
