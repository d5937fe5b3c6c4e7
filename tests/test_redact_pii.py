"""Redaction and value-free PII categories (invented values)."""

import json

from pyspark.sql import functions as F

from loomweave.functions import pii as PII
from loomweave.functions import redact as R
from loomweave.operators import json_tree as JT


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first()["o"]


def test_key_tests(spark):
    df = spark.createDataFrame([(k,) for k in ["Authorization", "X-CSRF-Token", "myApiKey", "api_key",
                                                "client-secret", "profile_dir", "chromeProfilePath",
                                                "browser-root", "title"]], "k string")
    out = {r["k"]: (r["s"], r["p"]) for r in df.select(
        "k", R.is_sensitive_key(F.col("k")).alias("s"), R.is_path_key(F.col("k")).alias("p")).collect()}
    assert out["Authorization"][0] and out["X-CSRF-Token"][0] and out["myApiKey"][0]
    assert out["client-secret"][0] and not out["title"][0]
    assert out["profile_dir"][1] and out["browser-root"][1] and not out["title"][1]


def test_truncation_boundaries(spark):
    assert one(spark, R.redact_text, "a" * 40) == "a" * 40
    assert one(spark, R.redact_text, "a" * 41) == "a" * 40 + "...[redacted 1 more chars]"


def test_scrub_and_bound(spark):
    text = "Authorization: Bearer zz9 at /home/someone/x and C:\\Temp\\f"
    out = one(spark, R.scrub_usage_error, text)
    assert out == "Authorization: Bearer [REDACTED] at [REDACTED] and [REDACTED]"
    url = one(spark, R.scrub_usage_error, "see https://x.example.org/cb?token=q&ok=1")
    assert url == "see https://x.example.org/cb?token=[REDACTED]&ok=1"
    assert one(spark, R.scrub_diagnostic, "x" * 80) == "x" * 80
    assert one(spark, R.scrub_diagnostic, "x" * 81) == "[REDACTED diagnostic text: 81 chars]"
    assert one(spark, R.scrub_usage_error, "word~ stays") == "word~ stays"


def redacted(spark, *docs, raw_only=True):
    df = spark.createDataFrame([(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i long, d string")
    out = {r["id"]: r["doc"] for r in JT.redact(df, "i", "d", raw_only).collect()}
    return [None if out[i] is None else json.loads(out[i]) for i in range(len(docs))]


def test_nested_redaction_is_idempotent_and_raw_only(spark):
    doc = {"raw": {"Session-Id": "s", "selftext": "b" * 45, "deep": [{"user_data_dir": "/x"}, [], {}, None, 7, "q\"uote"]},
           "title": "kept", "password": "outside raw", "list": [{"raw": {"token": {"a": 1}, "raw": "plain", "body": ["x" * 50]}}]}
    got, empty, text, broken, none = redacted(spark, doc, {}, "\"only text\"", "{broken", None)
    want = json.loads(json.dumps(doc))
    want["raw"]["Session-Id"], want["raw"]["deep"][0]["user_data_dir"] = "[REDACTED]", "[REDACTED]"
    want["raw"]["selftext"], want["list"][0]["raw"]["token"] = "b" * 40 + "...[redacted 5 more chars]", "[REDACTED]"
    assert got == want and empty == {} and text == "only text" and broken is None and none is None
    again = redacted(spark, got)[0]
    # Idempotent for key redaction (free text is cut again, as in the model).
    assert {**again, "raw": {**again["raw"], "selftext": ""}} == {**got, "raw": {**got["raw"], "selftext": ""}}


def test_whole_document_redaction(spark):
    assert redacted(spark, {"a": {"api_key": [1, 2], "ok": 1}, "body": "z" * 41}, raw_only=False) == [
        {"a": {"api_key": "[REDACTED]", "ok": 1}, "body": "z" * 40 + "...[redacted 1 more chars]"}]


def test_repeated_and_null_ids_keep_documents_apart(spark):
    docs = [(1, {"raw": {"a": "x", "b": ["y"]}}), (1, {"raw": {"a": "z", "token": ["w"]}}), (None, {"raw": {"token": 1}}), (None, None), (1, {"raw": {"a": "x", "b": ["y"]}})]
    df = spark.createDataFrame([(i, None if d is None else json.dumps(d)) for i, d in docs], "i long, d string")
    got = sorted(((r["id"], r["doc"]) for r in JT.redact(df, "i", "d").collect()), key=repr)
    want = [(1, '{"raw":{"a":"x","b":["y"]}}'), (1, '{"raw":{"a":"z","token":"[REDACTED]"}}'), (None, '{"raw":{"token":"[REDACTED]"}}'), (None, None), (1, '{"raw":{"a":"x","b":["y"]}}')]
    assert got == sorted(want, key=repr)


def test_structural_scan(spark):
    docs = [None, "{broken", {"clean": ["words", 1, None, {}]}, {"deep": [[{"accessToken": 1}]]}, {"author": "realname"}, {"author": "[deleted]"},
            {"author": "test_user"}, {"kind": "t2", "data": {"name": "someone", "subreddit": {"url": "/user/someone/"}}}, {"kind": "t3", "data": {"name": "someone"}},
            {"fullname": "t2_x", "a": [{"name": "someone"}]}, {"author": "fixture_a", "author_fullname": "t2_abc"}, {"author_fullname": "t2_abc"},
            {"x": ["mail me at someone.odd@mail.example.org now"], "secret": "call +1 555 123 4567"}, {"profile_url": "https://www.reddit.com/u/someone"},
            {"profile_url": "https://example.org/u/someone"}, "\"tok Zk3q9XvB2mLw8RtY6pHs1DnC4fGj7KeA here\""]
    df = spark.createDataFrame([(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i long, d string")
    got = {i: [] for i in range(len(docs))}
    for r in JT.scan(df, "i", "d").orderBy("id", "ord").collect():
        got[r["id"]].append(r["category"])
    user = ["non-synthetic-username"]
    assert list(got.values()) == [["unsafe-file"], ["invalid-json"], [], ["credential-key"], user, [], [], user, [], user, [], user,
                                  ["credential-key", "email", "phone"], user, [], ["high-entropy-secret"]]


def test_pii_categories(spark):
    vals = ["mail me at someone.odd@mail.example.org now", "call +1 555 123 4567",
            "tok Zk3q9XvB2mLw8RtY6pHs1DnC4fGj7KeA here", "sample_token_AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA",
            "plain words only"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = [r["c"] for r in df.select(PII.text_categories(F.col("v")).alias("c"), "i").orderBy("i").collect()]
    assert out == [["email"], ["phone"], ["high-entropy-secret"], [], []]


def test_entropy_and_key_words(spark):
    assert abs(one(spark, PII.shannon_entropy, "aabb") - 1.0) < 1e-12
    assert one(spark, PII.shannon_entropy, "") == 0.0
    assert one(spark, PII.credential_shaped_key, "clientSecret")
    assert one(spark, PII.credential_shaped_key, "session")
    assert not one(spark, PII.credential_shaped_key, "sessions_count")
    assert one(spark, PII.profile_username, "https://www.reddit.com/user/someone") == "someone"
    assert one(spark, PII.profile_username, "https://example.org/user/someone") is None


def test_scan_goes_down_in_passes(spark):
    deep = {"a": "x"}
    for i in range(9):
        deep = {"accessToken" if i == 4 else "k": [{}, deep, []]}
    docs = [json.dumps(deep), json.dumps({"password": {}}), json.dumps({"password": [], "b": ["call +1 555 123 4567", {"author": "realname"}]}), "{}", "[]", "7", None, "{", "{}", None]
    df = spark.createDataFrame(list(enumerate(docs[:-2])) + [(None, d) for d in docs[-2:]], "i long, d string")
    want = [(0, 0, "credential-key"), (1, 0, "credential-key"), (2, 0, "credential-key"), (2, 1, "phone"), (2, 2, "non-synthetic-username"),
            (6, 0, "unsafe-file"), (7, 0, "invalid-json"), (None, 0, "unsafe-file")]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for levels in (2, 12):
        got = [(r["id"], 0, r["category"]) for r in JT.scan(df, "i", "d", levels=levels).collect()]
        assert sorted(got, key=key) == sorted(((i, 0, c) for i, _, c in want), key=key), levels
