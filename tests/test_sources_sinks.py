"""A1-A9 sources and sinks, B10-B12 cursor and bound rules."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from loomweave.operators import envelope as E
from loomweave.operators import listing as L
from loomweave.sources import capture as CAP
from loomweave.streaming.jobs import work_dir


def test_stem_check():
    assert CAP.valid_stem("listing_01.page-2")
    assert not CAP.valid_stem("../escape") and not CAP.valid_stem(".hidden") and not CAP.valid_stem("a" * 101)


def test_capture_directory_and_quarantine(spark):
    d = work_dir(spark, "raw")
    local = d[len("file:"):] if d.startswith("file:") else d
    os.makedirs(local)
    for name, body in [("b.json", '{"kind":"Listing","data":{"children":[]}}'), ("a.json", "<html>"),
                       ("c.json", "   "), ("skip.txt", "{}")]:
        with open(os.path.join(local, name), "w") as fh:
            fh.write(body)
    got = {r["file_name"]: r["valid"] for r in CAP.read_captures(spark, d).collect()}
    assert got == {"a.json": False, "b.json": True, "c.json": False}


def test_sinks_and_serialiser(spark):
    df = spark.createDataFrame([(1, "x", dt.datetime(2024, 1, 1, 0, 0, 0, 500000), None)],
                               "id int, s string, at timestamp, raw string")
    ser = json.loads(CAP.serialise(df).first()["json"])
    assert list(ser) == ["id", "s", "at"] and ser["at"] == "2024-01-01T00:00:00.500000Z"
    assert json.loads(CAP.to_json_array(df.select("id", "s"), max_rows=5).first()["json"]) == [{"id": 1, "s": "x"}]
    with pytest.raises(ValueError):
        CAP.to_json_array(df, max_rows=0)
    out = work_dir(spark, "ndjson")
    CAP.write_ndjson(df.select("id", "s", "raw"), out)
    with pytest.raises(Exception):
        CAP.write_ndjson(df.select("id"), out)          # never overwrites a published result
    assert spark.read.json(out).count() == 1


def test_related_envelope_selects_second_element(spark):
    body = json.dumps([{"kind": "Listing", "data": {"children": []}},
                       {"kind": "Listing", "data": {"after": None, "children": [
                           {"kind": "t3", "data": {"id": "dup1"}}]}}])
    df = spark.createDataFrame([("r", body), ("s", '{"kind":"Listing"}')], "response_id string, body string")
    items, bad = E.decode_listing_pages(df, ("t3",), ["response_id"], select_element=1)
    assert [r["response_id"] for r in items.collect()] == ["r"]
    assert [(r["path"], r["expected"]) for r in bad.collect()] == [("response", "a two-element array")]


def _page(run, n, items, after):
    return (f"{run}:{n}", run, n, dt.datetime(2024, 6, 1), 200, "application/json",
            json.dumps({"kind": "Listing", "data": {"after": after, "children": items}}))


def test_repeated_cursor_and_undated_rows_are_drift(spark):
    t = lambda i, m: {"kind": "t3", "data": {"id": f"q{i}", "created_utc": m}}
    rows = [_page("loop", 1, [t(1, 1704067300)], "t3_q1"), _page("loop", 2, [t(2, 1704067200)], "t3_q1"),
            _page("loop", 3, [t(3, 1704067100)], None),
            _page("nodate", 1, [{"kind": "t3", "data": {"id": "z"}}], None)]
    pages = spark.createDataFrame(rows, "response_id string, run_id string, page_no bigint, "
                                        "captured_at timestamp, status int, content_type string, body string")
    params = spark.createDataFrame([("loop", None, None, None, None),
                                    ("nodate", None, dt.datetime(2024, 1, 1), None, None)],
                                   "run_id string, lim bigint, since timestamp, until timestamp, max_requests bigint")
    _, audit = L.paged_run(pages, params)
    got = {r["run_id"]: (r["stop_reason"], r["status"]) for r in audit.collect()}
    assert got == {"loop": ("drift", 4), "nodate": ("drift", 4)}


def test_response_classification_order(spark):
    rows = [("ok", 200, "application/json", '{"kind":"Listing"}', {}),
            ("limited", 429, "application/json", '{}', {}),
            ("zero", 200, "application/json", '{}', {"x-ratelimit-remaining": "0", "x-ratelimit-reset": "9",
                                                     "x-ratelimit-used": "100"}),
            ("html", 200, "text/html", "<html>", {}),
            ("broken", 200, "application/json", "{nope", {}),
            ("missing", 404, "application/json", "{}", {}),
            ("private", 200, "application/json", '{"reason": "private"}', {}),
            ("scalar", 200, "application/json", "42", {})]
    df = spark.createDataFrame(rows, "name string, status int, content_type string, body string, "
                                     "headers map<string,string>")
    got = {r["name"]: r["outcome"] for r in CAP.classify_responses(df).collect()}
    assert got == {"ok": "ok", "limited": "rate_limited", "zero": "rate_limited", "html": "challenge",
                   "broken": "challenge", "missing": "not_found", "private": "unavailable",
                   "scalar": "challenge"}
    waited = {r["name"]: r["outcome"] for r in CAP.classify_responses(df, wait_on_limit=True, max_wait=60).collect()}
    assert waited["zero"] == "ok"


def test_run_summary_text(spark):
    audit = spark.createDataFrame(
        [("r", 2, "since_crossed", dt.datetime(2024, 1, 1, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 5)),
         ("e", 0, "no_matches", None, None)],
        "run_id string, items bigint, stop_reason string, oldest timestamp, newest timestamp")
    got = {r["run_id"]: r["summary"] for r in L.run_summary(audit).collect()}
    assert got["r"] == ("2 posts, range 2024-01-01T00:00:01Z..2024-01-01T00:05:00Z, stop reason: "
                        "since_crossed, budget unknown/unknown")
    assert got["e"].startswith("0 posts, range none..none")


def test_json_array_of_any_size_is_one_array(spark, tmp_path):
    df = spark.range(500).selectExpr("id", "concat('x]}', id % 7) AS s", "CASE WHEN id % 3 = 0 THEN id END AS a")
    out = str(tmp_path / "array")
    CAP.write_json_array(df.repartition(5), out, [F.col("s").desc(), F.col("id").asc()])
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    assert "_SUCCESS" in os.listdir(out)
    whole = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in parts)
    want = sorted(({"id": i, "s": f"x]}}{i % 7}", "a": i if i % 3 == 0 else None} for i in range(500)), key=lambda r: (-(r["id"] % 7), r["id"]))
    assert json.loads(whole) == want
    back = CAP.read_json_array(spark, out).orderBy("n").collect()
    assert [r["n"] for r in back] == list(range(1, 501)) and [json.loads(r["json"]) for r in back] == want
    with pytest.raises(Exception):
        CAP.write_json_array(df, out, [F.col("id")])
    empty = str(tmp_path / "empty")
    CAP.write_json_array(df.limit(0), empty, [F.col("id")])
    assert CAP.read_json_array(spark, empty).count() == 0


def test_bundle_refuses_unsafe_names(spark, tmp_path):
    rows = [("b.json", "{}"), ("a", " "), ("c-1", "<html>"), ("../d", "{}"), (".e", "{}"), ("f..g", "{}"), ("h\n", "{}"), (None, "{}"),
            ("", "{}"), ("k" * 101, "{}"), ("k" * 100, None), ("a", "[1]")]
    out = str(tmp_path / "bundle")
    refused = CAP.write_bundle(spark.createDataFrame(rows, "name string, body string"), out)
    assert sorted(map(str, (r["name"] for r in refused.collect()))) == sorted(map(str, ("../d", ".e", "f..g", "h\n", None, "", "k" * 101)))
    got = [(r["name"], r["body"], r["valid"]) for r in CAP.read_bundle(spark, out).orderBy("seq").collect()]
    assert got == [("a", " ", False), ("a", "[1]", True), ("b.json", "{}", True), ("c-1", "<html>", False), ("k" * 100, None, False)]


def test_captures_are_listed_a_round_at_a_time(spark):
    bodies = [(str(i), "{not json" if i % 5 == 0 else '{"n":%d}' % i) for i in range(40)] + [("40", None), (None, "{}"), ("41", "{}"), ("41", "{}"), ("42", '{"two":\n"lines"}')]
    staging = work_dir(spark, "rounds")
    df = spark.createDataFrame(bodies, "name string, body string")
    got = CAP.read_in_rounds(df, staging, work_dir(spark, "rounds-read"), files=10).collect()
    want = {str(i): i % 5 != 0 for i in range(40)} | {"40": False, None: True, "41": True, "42": True}
    assert len(got) == len(bodies) and {r["name"]: r["valid"] for r in got} == want
    local = staging[len("file:"):] if staging.startswith("file:") else staging
    assert len([x for x in os.listdir(local) if x.startswith("name=")]) < len(want) / 2


def test_landed_files_lie_where_spark_would_write_them(spark):
    names = ["plain", "a b", "x=y/z%", "dot.json", "é中", "q?*:'\"#[]{^\\", "", None, "plain"]
    df = spark.createDataFrame([(n, f'{{"k":{i}}}' if i % 2 else None) for i, n in enumerate(names)], "name string, body string")
    own, usual = work_dir(spark, "landed"), work_dir(spark, "usual")
    CAP._land(df.limit(3), own)              # what a folder held is replaced
    CAP._land(df, own)
    df.write.partitionBy("name").option("maxRecordsPerFile", 1).text(usual)

    def held(path):
        path = path.removeprefix("file:")
        return sorted((d, open(f"{path}/{d}/{f}", "rb").read()) for d in os.listdir(path) if d.startswith("name=") for f in os.listdir(f"{path}/{d}") if f[0] not in "._")
    assert held(own) == held(usual) and len(held(own)) == len(names)
    back = spark.read.schema("value string, name string").text(own, wholetext=True)
    assert sorted(map(str, (r["name"] for r in back.collect()))) == sorted(str(n or None) for n in names)
