"""Connected components by alternating large-star and small-star steps, with a stored table after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm import _plan


def _digest(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum((F.xxhash64("a", "b") % 1_000_003))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in edges (a, b: long): the least node that can be reached. Rounds grow as the logarithm of a component's length."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, folder = _plan.stored_at(e, "edges")
    before = None
    while (now := _digest(e)) != before:
        before = now
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        e, new = _plan.stored_at(small, "edges")
        _plan.drop_stored(folder)  # nothing reads the round before any more
        folder = new
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
