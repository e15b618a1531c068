"""Connected components of an edge table, without holding one in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the node's smallest neighbour (itself included)."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
    return tied.select("e.*").where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has an edge a - b, by alternating large and small stars.

    Each round is written to the shared folder: the edge table never grows, and a lost executor repeats one round at most.
    """
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        state = now
        edges = materialise(_small_star(_large_star(edges)), "edges")
