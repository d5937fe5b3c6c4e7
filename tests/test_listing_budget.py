"""F, I, K, M: listing bounds, the paged-run engine and budget arithmetic."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loomweave.operators import budget as B
from loomweave.operators import listing as L


def thing(i, minutes):
    return {"kind": "t3", "data": {"id": f"p{i}", "name": f"t3_p{i}", "created_utc": 1704067200 + 60 * minutes}}


def pages_df(spark, run_pages, status=None):
    rows = []
    for run, pages in run_pages.items():
        for n, (items, after) in enumerate(pages, start=1):
            body = json.dumps({"kind": "Listing", "data": {"after": after, "children": items}})
            st = (status or {}).get((run, n), 200)
            rows.append((f"{run}:{n}", run, n, dt.datetime(2024, 6, 1), st, "application/json", body))
    return spark.createDataFrame(rows, "response_id string, run_id string, page_no bigint, "
                                       "captured_at timestamp, status int, content_type string, body string")


def params_df(spark, rows):
    return spark.createDataFrame(rows, "run_id string, lim bigint, since timestamp, until timestamp, "
                                       "max_requests bigint")


def audit_of(spark, run_pages, params, status=None):
    items, audit = L.paged_run(pages_df(spark, run_pages, status), params_df(spark, params))
    a = {r["run_id"]: r.asDict() for r in audit.collect()}
    it = {}
    for r in items.orderBy("seq").collect():
        it.setdefault(r["run_id"], []).append(r["fullname"])
    return a, it


def test_dedup_limit_and_reasons(spark):
    p1 = [thing(1, 50), thing(2, 40), thing(3, 30)]
    p2 = [thing(3, 30), thing(4, 20), thing(5, 10)]
    runs = {"a": [(p1, "t3_p3"), (p2, None)], "b": [(p1, "t3_p3"), (p2, None)],
            "c": [(p1, "t3_p3"), (p2, None)], "d": [(p1, "t3_p3"), (p2, None)]}
    params = [("a", 4, None, None, None), ("b", 5, None, None, None), ("c", None, None, None, None),
              ("d", 0, None, None, None)]
    a, it = audit_of(spark, runs, params)
    assert it["a"] == ["t3_p1", "t3_p2", "t3_p3", "t3_p4"]
    assert a["a"]["stop_reason"] == "limit_reached"          # an unseen row follows in the page
    assert a["b"]["stop_reason"] == "listing_exhausted"      # limit met on the last row, no cursor
    assert a["c"]["stop_reason"] == "listing_exhausted" and a["c"]["items"] == 5
    assert a["d"]["stop_reason"] == "limit_reached" and a["d"]["requests_made"] == 0
    assert "d" not in it


def test_since_budget_and_rate_limit(spark):
    p1 = [thing(1, 50), thing(2, 40)]
    p2 = [thing(3, 30), thing(4, 5)]
    p3 = [thing(5, 1)]
    since = dt.datetime(2024, 1, 1, 0, 20)
    runs = {r: [(p1, "t3_p2"), (p2, "t3_p4"), (p3, None)] for r in "wxyz"}
    params = [("w", None, since, None, None), ("x", None, None, None, 2), ("y", None, None, None, None),
              ("z", 1, since, None, None)]
    a, it = audit_of(spark, runs, params, status={("y", 2): 429})
    assert a["w"]["stop_reason"] == "since_crossed" and a["w"]["since_target_crossed"]
    assert it["w"] == ["t3_p1", "t3_p2", "t3_p3"] and a["w"]["requests_made"] == 2
    assert a["x"]["stop_reason"] == "max_requests" and a["x"]["requests_made"] == 2
    assert a["y"]["stop_reason"] == "rate_limited" and a["y"]["status"] == 3 and it["y"] == ["t3_p1", "t3_p2"]
    assert a["z"]["stop_reason"] == "limit_reached" and a["z"]["status"] == 7   # since left unconfirmed


def test_bounds_and_choices():
    with pytest.raises(ValueError):
        L.bounds(dt.date(2024, 2, 1), dt.date(2024, 1, 1))
    lo, hi = L.bounds(dt.date(2024, 1, 1), dt.date(2024, 1, 1), day_granularity=True)
    assert hi - lo == dt.timedelta(days=1) - dt.timedelta(microseconds=1)
    with pytest.raises(ValueError):
        L.choice("sideways", L.SUBREDDIT_SORTS, "sort")
    with pytest.raises(ValueError):
        L.validate_limit(-1)


def test_budget_advice(spark):
    rows = [(1, 1, dt.datetime(2024, 1, 1, 0, 0, 0), 200, {"x-ratelimit-remaining": "10",
                                                            "X-Ratelimit-Reset": "100", "x-ratelimit-used": "90"}),
            (1, 2, dt.datetime(2024, 1, 1, 0, 0, 6), 200, {"x-ratelimit-remaining": "0",
                                                            "x-ratelimit-reset": "50", "x-ratelimit-used": "100"}),
            (1, 3, dt.datetime(2024, 1, 1, 0, 1, 0), 200, {"x-ratelimit-remaining": "inf",
                                                            "x-ratelimit-reset": "1", "x-ratelimit-used": "1"}),
            (1, 4, dt.datetime(2024, 1, 1, 0, 2, 0), 429, {})]
    log = spark.createDataFrame(rows, "client bigint, seq bigint, ts timestamp, status int, "
                                      "headers map<string,string>")
    out = {r["seq"]: r for r in B.advise(log).collect()}
    assert out[1]["advised_delay"] == 1.0 and out[1]["decision"] == "continue"
    assert out[2]["advised_delay"] == 10.0 and out[2]["decision"] == "stop"
    assert out[3]["blocked"] and out[3]["remaining"] is None and out[3]["budget_text"] == "unknown/unknown"
    assert out[4]["decision"] == "stop"
    waited = {r["seq"]: r for r in B.advise(log, wait_on_limit=True, max_wait=60).collect()}
    assert waited[2]["decision"] == "wait" and not waited[3]["blocked"]


def test_older_row_first_in_page_and_mid_page_limit(spark):
    # The page holding the first older row is finished; rows after it still count.
    p1 = [thing(1, 50), thing(2, 5), thing(3, 45)]
    p2 = [thing(4, 40)]
    since = dt.datetime(2024, 1, 1, 0, 20)
    runs = {"m": [(p1, "t3_p3"), (p2, None)], "n": [(p1, "t3_p3"), (p2, None)]}
    params = [("m", None, since, None, None), ("n", 1, None, None, None)]
    a, it = audit_of(spark, runs, params)
    assert it["m"] == ["t3_p1", "t3_p3"] and a["m"]["stop_reason"] == "since_crossed"
    assert a["m"]["requests_made"] == 1 and a["m"]["since_target_crossed"]
    assert it["n"] == ["t3_p1"] and a["n"]["stop_reason"] == "limit_reached" and a["n"]["requests_made"] == 1


def test_budget_windows(spark):
    rows = [(7, i, dt.datetime(2024, 1, 1, 0, m), 429 if i == 3 else 200,
             {"x-ratelimit-remaining": str(10 - i), "x-ratelimit-reset": "60", "x-ratelimit-used": str(i)})
            for i, m in enumerate([0, 4, 9, 12, 19], start=1)]
    log = spark.createDataFrame(rows, "client bigint, seq bigint, ts timestamp, status int, "
                                      "headers map<string,string>")
    got = {r["window_start"]: (r["requests"], r["limited"], r["min_remaining"])
           for r in B.windows(B.advise(log)).collect()}
    assert got == {"2024-01-01T00:00:00Z": (3, 1, 7.0), "2024-01-01T00:10:00Z": (2, 0, 5.0)}


def test_pages_chain_by_their_cursors(spark):
    """Against a plain walk: rho-shaped chains, pages out of reach, copies of a page, no order of storage."""
    import json
    import random

    def body(after):
        return json.dumps({"kind": "Listing", "data": {"after": after, "children": []}})
    rng, rows, want = random.Random(3), [], set()
    for run in range(14):
        n = rng.randrange(1, 30)
        cursors = [None] + [f"t3_{run}_{i}" for i in range(1, n)]
        nxt = cursors[1:] + [rng.choice([None, *cursors[1:]])] if n > 1 else [None]
        for i in range(n):
            rows.append((f"{run}:{i}", f"run{run}", cursors[i], "2024-01-01 00:00:00", body(nxt[i])))
            want.add((f"run{run}", f"{run}:{i}", i + 1))
        rows.append((f"{run}:copy", f"run{run}", cursors[0], "2024-01-02 00:00:00", body(None)))
        rows += [(f"{run}:x{k}", f"run{run}", f"t3_lost{k}", "2024-01-01 00:00:00", body(f"t3_lost{(k + 1) % 3}")) for k in range(3)]       # a cycle out of reach
        rows.append((f"{run}:y", f"run{run}", "t3_none", "2024-01-01 00:00:00", body(cursors[-1])))                                       # leads into the chain
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "response_id string, run_id string, cursor string, captured_at string, body string").withColumn("captured_at", F.col("captured_at").cast("timestamp"))
    got = {(r["run_id"], r["response_id"], r["page_no"]) for r in L.chain_pages(df).collect()}
    assert got == want
