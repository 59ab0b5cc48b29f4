"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import discard, stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.join(least, "a").where("b > a").select(F.col("least").alias("a"), "b").where("a < b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them. Edges have a < b."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    tied = edges.join(least, "b").where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return tied.union(least.select(F.col("least").alias("a"), "b")).distinct()


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(edges: DataFrame) -> DataFrame:
    """a, b: for each node b that is not the least of its component, the least one a.

    ``edges`` has the longs a and b. Loops and repeated edges count for nothing. The number of
    rounds grows with the logarithm of the longest path; each ends in a stored table.
    """
    now = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    before = None
    while (mark := signature(now)) != before:
        after = stored(small_star(large_star(now)), "edges")
        discard(now)
        now, before = after, mark
    return now
