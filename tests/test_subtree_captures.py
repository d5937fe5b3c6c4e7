"""Subtree captures are written from their own nodes, each gathered once; no reply is nested again for each level above it."""

import json

from loomweave.operators import forest as FR
from loomweave.sources import standins as S


def _tables(spark, path):
    events = [(u * 1000 + k, u) for u, n in ((5, 14), (1, 130), (10, 2), (7, 40)) for k in range(1, n + 1)] + [(None, 5), (77, None)]
    (spark.createDataFrame(events, "event_id long, user_id long")
     .selectExpr("event_id", "timestamp'2024-01-01 00:00:00' as ts", "user_id", "'view' as event_type", "1.5D as value", "concat('{\"p\":', event_id, '}') as props")
     .write.parquet(f"{path}/events.parquet"))
    (spark.createDataFrame([(i,) for i in range(12)], "doc_id long").selectExpr("doc_id", "'a text' as text", "'en' as lang", "'src1' as source", "6L as n_chars")
     .write.parquet(f"{path}/documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def _shape(thing):
    """[name, replies] of a comment, ["more", count] of a pointer."""
    d = thing["data"]
    if thing["kind"] == "more":
        return ["more", d["count"]]
    return [d["id"], [_shape(x) for x in d["replies"]["data"]["children"]] if d["replies"] else []]


def test_subtrees_hold_what_their_root_has_below(spark, tmp_path, monkeypatch):
    def no_levels(*a, **b):
        raise AssertionError("nested level by level")

    _tables(spark, str(tmp_path))
    monkeypatch.setattr(FR, "nest", no_levels)
    got = {r["response_id"]: json.loads(r["body"])[1]["data"]["children"] for r in S.subtree_responses(spark, str(tmp_path)).collect()}
    S.clear_shared()
    want = {}
    for user, first, last, cut in ((5, 2, 15, 2), (1, 1, 130, 40)):       # the null event of user 5 takes the first place
        name = lambda k: f"e{user * 1000 + k + 1 - first}"

        def below(k, shown):
            kids = [c for c in range(max(3 * k + 1, first), min(3 * k + 3, last) + 1) if not shown or c <= cut]
            return [[name(c), below(c, shown)] for c in kids] + ([["more", hidden(k)]] if shown and hidden(k) else [])

        def size(k):
            return 1 + sum(size(c) for c in range(3 * k + 1, min(3 * k + 3, last) + 1))

        def hidden(k):
            return sum(size(c) for c in range(3 * k + 1, min(3 * k + 3, last) + 1) if c > cut)

        for k in range(first, cut + 1):
            if hidden(k):
                dead = (user * 1000 + k + 1 - first) % S.DEAD_END_RULE == 3
                want[f"subtree:t1_{name(k)}"] = [[name(k), below(k, dead)]]
    assert {k: [_shape(x) for x in v] for k, v in got.items()} == want
    assert any("more" in str(v) for v in want.values()) and len(want) > 20
