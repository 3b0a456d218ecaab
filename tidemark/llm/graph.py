"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    joined = down.join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b")
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the (a, b) edges; the root is the smallest node of the component.

    Works on edges of comparable keys without nulls.  Every round is written below the shared folder, so a lost
    executor costs one round at most; the number of rounds grows with the logarithm of the longest chain.
    """
    now = stage(edges.where("a != b").select("a", "b"), "edges").frame
    before = None
    while True:
        now = stage(_small_star(_large_star(now)), "edges").frame
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    # Now every edge leads to its component's root.
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
