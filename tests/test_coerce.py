"""The strict coercion grid (values invented for these tests)."""

from pyspark.sql import functions as F

from loomweave.functions import coerce as C

GRID = ['{"x": 1}', '{"x": 1.0}', '{"x": true}', '{"x": "1"}', '{"x": " -1 "}', '{"x": "--1"}',
        '{"x": "yes"}', '{"x": null}', '{}', '{"x": 123456789012345678901}', '{"x": 2.5}']


def grid(spark, expr):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(GRID)], "i int, s string")
    out = df.select("i", expr(F.parse_json("s")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


def test_integer_rejects_bool_float_and_junk(spark):
    assert grid(spark, lambda v: C.integer(v, "x")) == [1, None, None, 1, -1, None, None, None, None,
                                                        None, None]


def test_number_accepts_int_and_float_only(spark):
    assert grid(spark, lambda v: C.number(v, "x")) == [1.0, 1.0, None, None, None, None, None, None,
                                                       None, 1.2345678901234568e20, 2.5]


def test_booleans_two_and_three_state(spark):
    assert grid(spark, lambda v: C.boolean(v, "x")) == [False, False, True] + [False] * 8
    assert grid(spark, lambda v: C.opt_boolean(v, "x")) == [None, None, True] + [None] * 8


def test_text_defaults_and_nullable(spark):
    assert grid(spark, lambda v: C.text(v, "x"))[3:8] == ["1", " -1 ", "--1", "yes", ""]
    assert grid(spark, lambda v: C.opt_text(v, "x"))[7:9] == [None, None]


def test_timestamp_range_and_types(spark):
    df = spark.createDataFrame([('{"t": 1704067200}',), ('{"t": 1704067200.5}',), ('{"t": true}',),
                                ('{"t": "1704067200"}',), ('{"t": 1e20}',), ('{"t": -5}',)], "s string")
    out = [r[0] for r in df.select(C.iso(C.timestamp(F.parse_json("s"), "t"))).collect()]
    assert out == ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.500000Z", None, None, None,
                   "1969-12-31T23:59:55Z"]


def test_ids_urls_and_entities(spark):
    df = spark.createDataFrame([("t3_abc", "/r/x/", "https://a.example.org/p?a=1&amp;b=2")],
                               "i string, p string, u string")
    r = df.select(C.strip_prefix(F.col("i"), "t3_").alias("id"), C.site_url(F.col("p")).alias("url"),
                  C.html_unescape(F.col("u")).alias("dec"),
                  C.safe_external_url(F.lit("ftp://x.example.org/")).alias("bad"),
                  C.safe_external_url(F.col("u")).alias("good")).first()
    assert r["id"] == "abc"
    assert r["url"] == "https://www.reddit.com/r/x/"
    assert r["dec"] == "https://a.example.org/p?a=1&b=2"
    assert r["bad"] == ""
    assert r["good"] == "https://a.example.org/p?a=1&b=2"


def test_truthy_fallthrough_zero_width(spark):
    df = spark.createDataFrame([('{"x": 0, "width": 320}',), ('{"x": 640, "width": 1}',), ('{"width": 0}',)],
                               "s string")
    out = [r[0] for r in df.select(C.truthy_integer(F.parse_json("s"), "x", "width")).collect()]
    assert out == [320, 640, 0]


def test_character_references(spark):
    df = spark.createDataFrame([("a&#39;b &#x2F;c &#233;t&eacute; &amp;lt; &#x4E2D;",)], "s string")
    out = df.select(C.html_unescape(F.col("s")).alias("o")).first()["o"]
    assert out == "a'b /c été &lt; 中"


def test_character_references_as_the_standard_library(spark):
    import html

    texts = ["&#128512; &#x1F600; &eacute; &#60", "&#38;amp; &#0; &#x110000; &#99999999999999999999; &#xD800;",
             "&notit; &ampfoo &amp &AMP; &nosuch; & &; &#; &#x; ?a=1&b=2&copy=3", "&#128;&#x81;&#13;&#1;&#xFDD0;&#x1FFFF;",
             "&NotEqualTilde;&bne;&frac12&Aacute", "", "no reference", "&lt&gt;&&amp;amp;"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i int, s string")
    out = [r["o"] for r in df.select("i", C.html_unescape(F.col("s")).alias("o")).orderBy("i").collect()]
    assert out == [html.unescape(t) for t in texts] + [None]


def test_json_schema_shape():
    from loomweave.operators.schema import json_schema

    js = json_schema()
    assert js["$schema"].endswith("2020-12/schema")
    assert [x["$ref"] for x in js["oneOf"]] == ["#/$defs/Post", "#/$defs/Comment", "#/$defs/Subreddit",
                                                  "#/$defs/User"]
    post = js["$defs"]["Post"]
    assert post["additionalProperties"] is False and "raw" not in post["required"]
    assert post["properties"]["over_18"]["type"] == ["boolean", "null"]
    assert post["properties"]["created_at"]["format"] == "date-time"
    assert js["$defs"]["Comment"]["properties"]["replies"]["items"] == {"$ref": "#/$defs/Comment"}
