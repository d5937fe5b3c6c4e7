"""Fail-closed envelope decode."""

from pyspark.sql import functions as F

from loomweave.operators import envelope as E

T3 = '{"kind":"t3","data":{"id":"q1"}}'


def first_drift(spark, body, allowed=("t3",)):
    df = spark.createDataFrame([("r1", body)], "response_id string, body string")
    out = E.listing_pages_checked(df, allowed).select("drift.path", "drift.expected", "after").first()
    return out["path"], out["expected"], out["after"]


def test_valid_listing_and_cursor(spark):
    assert first_drift(spark, '{"kind":"Listing","data":{"after":"t3_q1","children":[%s]}}' % T3) == (
        None, None, "t3_q1")


def test_envelope_violations_in_order(spark):
    cases = {
        "<html>": ("response", "a JSON body"),
        "[1]": ("response", "a Listing object"),
        '{"kind":"listing","data":{}}': ("response.kind", "Listing"),
        '{"kind":"Listing","data":[]}': ("response.data", "an object"),
        '{"kind":"Listing","data":{"children":{}}}': ("response.data.children", "a list"),
        '{"kind":"Listing","data":{"children":[],"after":5}}': ("response.data.after", "a string or null"),
        '{"kind":"Listing","data":{"children":["x"]}}': ("response.data.children[0]", "a thing object"),
        '{"kind":"Listing","data":{"children":[{"kind":"t7","data":{}}]}}':
            ("response.data.children[0].kind", "t1, t2, t3, t5, or more"),
        '{"kind":"Listing","data":{"children":[%s,{"kind":"t1","data":[]}]}}' % T3:
            ("response.data.children[1].data", "an object"),
        '{"kind":"Listing","data":{"children":[{"kind":"t1","data":{}}]}}':
            ("response.data.children[0].kind", "an allowed kind for this query"),
    }
    for body, want in cases.items():
        assert first_drift(spark, body)[:2] == want, body


def test_more_is_skipped_not_drift(spark):
    body = '{"kind":"Listing","data":{"children":[%s,{"kind":"more","data":{"count":2}}]}}' % T3
    df = spark.createDataFrame([("r1", body)], "response_id string, body string")
    items, bad = E.decode_listing_pages(df, ("t3",), ["response_id"])
    assert items.count() == 1 and bad.count() == 0


def test_about_verdicts(spark):
    df = spark.createDataFrame([("a", '{"kind":"t5","data":{"id":"x"}}'),
                                ("b", '{"kind":"Listing","data":{"children":[]}}'),
                                ("c", '{"kind":"t3","data":{}}')], "request string, body string")
    v = {r["request"]: r["verdict"] for r in E.about_verdict(df, "t5", ["request"], True).collect()}
    assert v == {"a": "found", "b": "not_found", "c": "drift"}
    v2 = {r["request"]: r["verdict"] for r in E.about_verdict(df, "t5", ["request"], False).collect()}
    assert v2["b"] == "drift"
