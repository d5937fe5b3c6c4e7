"""Search over written postings: equal to a scan, whatever the blocks, and reading only the query's terms."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loomweave.operators import postings as PO
from loomweave.operators import search as SR
from loomweave.session import shuffles_removed


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(5)
    words = ["alpha"] * 30 + ["beta"] * 10 + ["gamma"] * 3 + ["delta"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 8, 8, 40, 200])))
        rows.append((f"t3_{i:04d}", f"s{i % 3}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i % 50), i % 7, i % 5,
                     None if i % 9 == 0 else "Title beta" if i % 11 == 0 else "", None if i % 13 == 0 else text))
    return spark.createDataFrame(rows, "fullname string, subreddit string, created_at timestamp, score long, "
                                       "num_comments long, title string, text string")


@pytest.mark.parametrize("block", [1, 1024])
def test_equal_to_a_scan(spark, posts, tmp_path, block):
    path = str(tmp_path / f"b{block}")
    PO.write_index(posts, path, block)
    for query in ("delta", "alpha w1 gamma", "nowhere gamma"):
        for limit in (1, 10):
            cols = ["rank", "fullname", "matched", "relevance"]
            want = SR.search_posts(posts, query, limit=limit).select(*cols).collect()
            got = PO.search_index(spark, path, query, limit=limit).select(*cols).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, want)), (query, limit)


def test_narrowed_and_sorted(spark, posts, tmp_path):
    path = str(tmp_path / "n")
    PO.write_index(posts, path, 16)
    since = dt.datetime(2024, 1, 1, 0, 20, tzinfo=dt.UTC)
    for more in ({"sort": "new"}, {"sort": "top", "community": "S1"}, {"since": since}):
        want = SR.search_posts(posts, "gamma beta", limit=12, **more).select("rank", "fullname", "matched").collect()
        got = PO.search_index(spark, path, "gamma beta", limit=12, **more).select("rank", "fullname", "matched").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)), more
    assert PO.search_index(spark, path, "alpha", limit=0).count() == 0
    with pytest.raises(ValueError):
        PO.search_index(spark, path, " ")


def test_reads_only_the_terms(spark, posts, tmp_path):
    path = str(tmp_path / "p")
    PO.write_index(posts, path)
    plan = PO._of_terms(spark.read.parquet(f"{path}/postings"), ["gamma", "delta"])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(term, [delta,gamma])]" in plan or "PushedFilters: [In(term, [gamma,delta])]" in plan


def test_empty_table(spark, posts, tmp_path):
    path = str(tmp_path / "e")
    PO.write_index(posts.limit(0), path)
    assert PO.search_index(spark, path, "alpha").count() == 0


def test_terms_are_counted_in_their_row(spark, posts):
    text = F.coalesce("text", F.lit(""))
    rows = posts.select(F.lit(7).cast("bigint").alias("block"), "fullname", F.size(SR.tokens(text)).alias("dl"), text.alias("text"))
    rows = rows.unionByName(spark.createDataFrame([(7, "x", 3, "B b, É\n"), (7, "y", 0, None), (7, "y", 0, " ")], "block bigint, fullname string, dl int, text string"))
    counted = PO._counted(rows)
    assert "Exchange" not in counted._jdf.queryExecution().toString()
    want = rows.select("fullname", F.explode(SR.tokens(F.col("text"))).alias("term")).groupBy("fullname", "term").agg(F.count("*").cast("int").alias("tf"))
    assert sorted(map(tuple, counted.select("fullname", "term", "tf").collect())) == sorted(map(tuple, want.collect()))


def test_shuffle_files_go_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
        1 / 0
    assert spark.conf.get(key) == usual
