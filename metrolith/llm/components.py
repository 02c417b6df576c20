"""Connected components of a large edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolith.session import checkpoint_root

MAX_ROUNDS = 60


def _settled(edges: DataFrame) -> tuple[int, int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("s")).first()
    return row["n"], row["x"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    low = low.select(F.col("a").alias("hub"), "m")
    return both.join(low, both["a"] == low["hub"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("hub"), "m")
    joined = down.join(low, down["a"] == low["hub"])
    linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return linked.unionByName(low.select(F.col("hub").alias("a"), F.col("m").alias("b"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge (a, b), both long; root is the least node it reaches.

    Each round is cut off by checkpoint() in the shared folder, so a lost executor costs one round at most.
    """
    checkpoint_root(spark)
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = _settled(edges)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        edges = _small_star(_large_star(edges)).checkpoint()
        after = _settled(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
