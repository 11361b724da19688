"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.operators.durable import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(
        F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for every node of an edge other than the root itself.

    ``edges`` has columns a and b of one type; loops, nulls and repeated edges do no harm. Rounds
    end when a large-star and a small-star step change nothing; their number grows with the
    logarithm of the longest path. Each round is written to the shared folder. Nothing is gathered
    on the driver but two numbers a round.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = durable(edges, "components")
    state = _state(edges)
    while True:
        edges = durable(_small_star(_large_star(edges)), "components")
        then = _state(edges)
        if then == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = then
