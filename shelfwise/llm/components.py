"""Connected components of an edge table, by large-star and small-star steps.

Each step regroups edges around the smallest node of a neighbourhood; the components' stars
are reached in a number of rounds that is logarithmic in their diameter. Edges stay as many
as they were or become fewer, each round ends in a reliable checkpoint, and nothing is
collected but one row to see whether a round changed anything. Nodes with very many edges
only meet aggregations with a map side and joins whose skewed side Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import pinned


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges from `a` to smaller `b`."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Rows (`node`, `root`) for every node of the edges (`a`, `b`) that is not the root,
    the smallest node of its component."""
    ordered = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = pinned(ordered.distinct()), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
        now = pinned(_small_star(_large_star(now).distinct()).filter("a != b").distinct())
