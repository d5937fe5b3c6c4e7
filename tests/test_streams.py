"""S2, S3 and related discussions: results do not depend on how files fall into batches."""

import datetime as dt

from pyspark.sql import functions as F

from loomweave.operators import search as SR
from loomweave.streaming import jobs as ST


def test_dedup_over_many_batches(spark):
    src, out = ST.work_dir(spark, "in"), ST.work_dir(spark, "out")
    for i in range(6):
        rows = [("same", dt.datetime(2024, 1, 1, 2 * i), i), (f"own{i}", dt.datetime(2024, 1, 1, 2 * i), i)]
        spark.createDataFrame(rows, "k string, ts timestamp, n int").coalesce(1).write.mode("append").parquet(src)
    ST.dedup_stream(spark, src, "*.parquet", "k string, ts timestamp, n int", ["k"], "ts", out,
                    ST.work_dir(spark, "ckpt"), files_per_batch=1)
    got = sorted(r["k"] for r in spark.read.parquet(out).collect())
    assert got == sorted(["same"] + [f"own{i}" for i in range(6)])


def test_repeated_batch_leaves_no_second_copy(spark):
    out = ST.work_dir(spark, "batches")
    write = ST._batch_to(out)
    for _ in range(2):
        write(spark.createDataFrame([(1, 5)], "client long, n long"), 0)
    write(spark.createDataFrame([(1, 7)], "client long, n long"), 1)
    assert spark.read.parquet(out).count() == 2
    assert ST.latest(spark, out, ["client"]).collect()[0]["n"] == 7


def test_crossposts_of_a_link_in_many_communities(spark):
    rows = [(f"t3_{c}_{i}", f"sub{c}", 100 * c + i, dt.datetime(2024, 1, 1, c, i), "u") for c in range(9) for i in range(4)]
    posts = spark.createDataFrame(rows, "fullname string, subreddit string, num_comments long, created_at timestamp, link string")
    got = SR.related(posts, F.col("link"), "num_comments", 3, other_community_only=True).collect()
    want = {}
    for name, sub, *_ in rows:
        others = sorted((r for r in rows if r[1] != sub), key=lambda r: -r[2])[:3]
        want[name] = [r[0] for r in others]
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r["fullname"], []).append(r["r_fullname"])
    assert found == want


def test_query_and_documents_share_one_tokeniser(spark):
    users = spark.createDataFrame([("user_77",), ("other",)], "name string")
    assert [r["name"] for r in SR.search_named(users, "user_77", ["name"], [F.col("name").asc()], 5).collect()] == ["user_77"]


def test_quarantine_keeps_what_ingest_drops_and_batches_may_repeat(spark, tmp_path):
    import json

    def listing(*things):
        return json.dumps({"kind": "Listing", "data": {"after": None, "children": list(things)}})

    def post(i):
        return {"kind": "t3", "data": {"id": i, "name": f"t3_{i}", "title": i, "created_utc": 1.7e9}}
    staging, silver, bad, ckpt = (str(tmp_path / x) for x in ("in", "silver", "bad", "ckpt"))
    ts = "2024-01-01T00:00:00Z"
    rows = [("a", listing(post("1"), post("2")), 200), ("b", listing(post("2"), post("3")), 200), ("c", '{"kind":"Listing","data":[]}', 200), ("d", listing(post("4")), 429),
            ("e", "<html>", 200), ("f", listing({"kind": "t1", "data": {}}), 200)]
    for k, half in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame([(i, "r", 1, ts, s, "application/json", b) for i, b, s in half], "response_id string, run_id string, page_no long, captured_at string, status int, content_type string, body string"
                              ).coalesce(1).write.mode("append").json(staging)
        ST.ingest_with_quarantine(spark, staging, silver, bad, ckpt, files_per_batch=1)
        posts = sorted(r["fullname"] for r in spark.read.parquet(silver).collect())
        assert posts == ["t3_1", "t3_2", "t3_3"]
    got = {r["response_id"]: (r["reason"], r["path"]) for r in spark.read.parquet(bad).collect()}
    assert got["c"] == ("drift", "response.data") and got["d"] == ("rate_limited", None) and got["f"][0] == "drift" and got["e"][0] in ("challenge", "drift") and len(got) == 4


def test_typed_search_refuses_dates_of_communities_and_users(spark):
    import pytest

    day = dt.date(2024, 1, 1)
    for kind in ("sr", "user"):
        with pytest.raises(ValueError, match="date bounds"):
            SR.search({}, "words", kind, since=day)
    with pytest.raises(ValueError, match="search type"):
        SR.search({}, "words", "comment")
    users = spark.createDataFrame([("t2_1", "some_user", dt.datetime(2024, 1, 1)), ("t2_2", "else", dt.datetime(2024, 1, 2))], "fullname string, name string, created_at timestamp")
    assert [tuple(r) for r in SR.search({"user": users}, "some user", "user").collect()] == [(1, "t2", "t2_1", 2)]


def test_quarantine_reads_its_source_once(spark, monkeypatch):
    staging, silver, bad = (ST.work_dir(spark, x) for x in ("once-in", "once-silver", "once-bad"))
    thing = lambda i, kind="t3": '{"kind":"%s","data":{"id":"a%d","name":"%s_a%d"}}' % (kind, i, kind, i)
    page = lambda *x: '{"kind":"Listing","data":{"after":null,"children":[%s]}}' % ",".join(x)
    more = '{"kind":"more","data":{"count":3,"parent_id":"t3_x"}}'
    bodies = {"two": page(thing(1), more, thing(2)), "none": page(), "again": page(thing(2)), "odd": page(thing(3), thing(4, "t1")), "text": "<html>", "null": None}
    rows = [(k, dt.datetime(2024, 1, 1), 404 if k == "null" else 200, "application/json", b) for k, b in bodies.items()]
    spark.createDataFrame(rows, "response_id string, captured_at timestamp, status int, content_type string, body string").write.json(staging)
    plans, first_only = [], ST._first_only
    monkeypatch.setattr(ST, "_first_only", lambda df, *a: plans.append(df._jdf.queryExecution().analyzed().toString()) or first_only(df, *a))
    ST.ingest_with_quarantine(spark, staging, silver, bad, ST.work_dir(spark, "ckpt"))
    assert [p.count("StreamingRelation") for p in plans] == [1]
    assert sorted(r["fullname"] for r in spark.read.parquet(silver).collect()) == ["t3_a1", "t3_a2"]
    found = {r["response_id"]: (r["reason"], r["path"], r["body"]) for r in spark.read.parquet(bad).collect()}
    assert found == {"odd": ("drift", "response.data.children[1].kind", bodies["odd"]), "text": ("challenge", None, "<html>"), "null": ("challenge", None, None)}
