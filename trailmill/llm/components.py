"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmill.llm.storage import stored


def star_round(edges: DataFrame) -> DataFrame:
    """One large and one small star over edges ``a > b``; the number of edges does not grow."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(small, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.select("a", F.col("m").alias("b")).union(moved).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (columns a and b); the root is the smallest node reachable.

    Every round is written to the shared folder. The loop ends when a round changes no edge.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    known = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known or not state[0]:
            break
        known = state
        current = stored(star_round(current), "edges")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
