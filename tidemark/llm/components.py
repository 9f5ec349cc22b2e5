"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import discard, save


def _large_star(e: DataFrame, used: list[DataFrame]) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    used.append(least := save(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame, used: list[DataFrame]) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    used.append(least := save(down.groupBy("a").agg(F.min("b").alias("m")), "least"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _digest(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (a, b); component is its smallest node.

    Loops, repeated edges and either direction are allowed.
    """
    e = save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _digest(e)
    while before[0]:
        used = [e]
        e = save(_small_star(_large_star(e, used), used).where("a <> b").distinct(), "edges")
        for u in used:
            discard(u)
        after = _digest(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
