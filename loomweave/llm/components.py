"""Connected components of a link table, in rounds of joins (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.llm.io import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v: bigint, u <> v); label is the component's least node.

    Every round halves the height of the trees or better; rounds end when the
    links no longer change, and each is cut by a checkpoint in the shared
    folder.  Only a count and a hash sum reach the driver.  A node with very
    many links is a hot join key, which adaptive execution splits.
    """
    now = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while True:
        now = saved(_small_star(_large_star(now)))
        was, state = state, _state(now)
        if was == state:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
