"""Hot-key helpers agree with plain windows on skewed data (one key = a third of the rows)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomweave.operators.common import blocked_running_count, distributed_rank, first_wins


def skewed(spark, n=3000):
    # key 0 holds a third of all rows; ties on the order column are broken by id
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17 + 1).alias("k"),
        (F.col("id") * 7919 % 1000).alias("o"),
        F.array((F.col("id") % 5).cast("int"), (F.col("id") % 11).cast("int")).alias("path"))


def test_blocked_running_count_matches_row_number(spark):
    df = skewed(spark)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o", "id")))
    got = blocked_running_count(df, ["k"], F.col("o"), ["id"], block=37, out="rn")
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


def test_distributed_rank_matches_row_number_on_arrays(spark):
    df = skewed(spark)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("path", "id")))
    got = distributed_rank(df, ["k"], [F.col("path"), F.col("id")], "r", partitions=7)
    assert sorted(got.select("id", "r").collect()) == sorted(want.select("id", "r").collect())


def test_first_wins_keeps_earliest(spark):
    df = skewed(spark).select(F.col("k"), F.col("o").alias("page"), F.col("id").alias("pos"),
                              (F.col("id") * 2).alias("payload"))
    got = {r["k"]: (r["page"], r["pos"], r["payload"]) for r in first_wins(df, ["k"], ["page", "pos"]).collect()}
    w = Window.partitionBy("k").orderBy("page", "pos")
    want = {r["k"]: (r["page"], r["pos"], r["payload"]) for r in
            df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").collect()}
    assert got == want
