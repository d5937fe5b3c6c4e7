"""Responses are taken apart at once; only those that may break a rule are walked level by level."""

import json

from pyspark.sql import functions as F

from loomweave.operators import forest as FR
from loomweave.sources import standins as S
from tests.test_forest import c, listing, more, response

SF_SMALL = "/root/testdata/sf0.001"


def _responses(spark, bodies):
    return spark.createDataFrame([(f"r{i}", b) for i, b in enumerate(bodies)], "response_id string, body string").withColumn(
        "captured_at", F.lit("2024-06-01 00:00:00").cast("timestamp"))


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _same(spark, bodies, subtree=False):
    df = _responses(spark, bodies)
    (fast, seen), (slow, drift) = FR.flatten_post_responses(df, subtree), FR.flatten_by_level(df, subtree)
    assert fast.dtypes == slow.dtypes and seen.dtypes == drift.dtypes
    assert _rows(fast) == _rows(slow) and _rows(seen) == _rows(drift)
    return fast


def _chain(depth):
    below = ""
    for i in range(depth, 0, -1):
        below = listing(c(f"n{i}", below, depth=i - 1))
    return json.dumps([listing({"kind": "t3", "data": {"id": "p"}}), below])


def test_same_nodes_and_drift_as_by_level(spark):
    odd = [c("t1_a", listing(c("b", depth=None, score=" 7 ", edited=17.5), more("t1_a", 4, 1)), depth=" 3\n", ups=True, created_utc=1e9),
           c("d", listing(c("e", listing(c("f", listing(), depth="x")), depth=2 ** 70)), depth=2.0, author="\ud800", body="é\n\"}]"),
           c("g", listing(c("h", listing(c("i"), more("t1_h", 1)), depth="9" * 30)), depth=1, collapsed="true")]
    no_name = {"kind": "t1", "data": {"id": "k", "replies": listing(c("m"))}}
    nodes = _same(spark, [response("p", *odd), response("t3_q", no_name, more("t3_q", 2, 0)), response("r"), _chain(9)])
    assert nodes.count() == 22


def test_broken_responses_are_named_and_give_no_nodes(spark):
    bad = [None, "", "{", "[]", "<html>", "[1, NaN]", response("p", c("a", None)), response("p", c("a", [])),
           response("p", c("a", {"kind": "Listing", "data": {"after": 7, "children": []}})),
           response("p", c("a", listing({"kind": "t9", "data": {}}, {"kind": "t1"}))), response("p", more("x", 1)), response("p", more("t1_a", 1.0)),
           response("p", more("t1_a", 2 ** 63)), response("p", {"kind": "t1", "data": {"id": "z"}}), json.dumps([listing(), listing(c("a"))]),
           response("p", c("a", listing(c("b", listing(c("d", 5))), c("e", ""))))]
    assert {r[0] for r in _same(spark, [*bad, response("good", c("a"))]).select("thread_id").collect()} == {"t3_good"}
    assert _same(spark, [response("p", c("a"), c("b")), response("p", more("t1_a", 1)), response("q", c("a", listing(c("b"))))], subtree=True).count() == 2


def test_no_job_a_level(spark):
    def jobs(depth):
        group = f"flatten-{depth}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert FR.flatten_post_responses(_responses(spark, [_chain(depth)]))[0].count() == depth
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs(14) == jobs(2)


def test_threads_are_nested_as_level_by_level(spark):
    S.clear_shared()
    forest = S._forest_ranked(spark, SF_SMALL)
    for nodes in (S._comment_nodes(forest), S._capture_nodes(forest)):
        levels = FR.nest(nodes, F.col("head"), F.col("tail"), FR.listing_wrap, '""').groupBy("thread_id").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sib_pos", "json"))), lambda x: x["json"]), ",").alias("kids"))
        assert _rows(S._nested_threads(nodes)) == _rows(levels)
