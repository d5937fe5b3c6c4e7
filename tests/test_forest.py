"""Comment forests on hand-written captures and invariants on the stand-in."""

import json

from pyspark.sql import functions as F

from loomweave.operators import expand as X
from loomweave.operators import forest as FR

SF_SMALL = "/root/testdata/sf0.001"


def c(ident, replies="", **extra):
    data = {"id": ident, "name": f"t1_{ident}", "author": "someone", "created_utc": 1700000000,
            "replies": replies, **extra}
    return {"kind": "t1", "data": data}


def listing(*children):
    return {"kind": "Listing", "data": {"after": None, "children": list(children)}}


def more(parent, count, depth=None):
    d = {"parent_id": parent, "count": count, "children": []}
    if depth is not None:
        d["depth"] = depth
    return {"kind": "more", "data": d}


def response(post_id, *roots):
    return json.dumps([listing({"kind": "t3", "data": {"id": post_id}}), listing(*roots)])


def flatten(spark, bodies, subtree=False):
    df = spark.createDataFrame([(f"r{i}", b) for i, b in enumerate(bodies)],
                               "response_id string, body string").withColumn("captured_at", F.current_timestamp())
    return FR.flatten_post_responses(df, subtree=subtree)


def test_flatten_paths_depths_and_more_count(spark):
    body = response("px", c("a", listing(c("b", listing(c("c"))), more("t1_a", 7, 1)), depth=0), c("d"),
                    more("t3_px", 3, 0))
    nodes, drift = flatten(spark, [body])
    got = {(r["kind"], tuple(r["path"])): r for r in nodes.collect()}
    assert drift.count() == 0
    assert set(got) == {("t1", (0,)), ("t1", (0, 0)), ("t1", (0, 0, 0)), ("more", (0, 1)), ("t1", (1,)),
                        ("more", (2,))}
    assert got[("t1", (0, 0, 0))]["depth"] == 2
    view = {r["fullname"]: r["more_count"] for r in FR.comments_view(nodes).collect()}
    assert view == {"t1_a": 7, "t1_b": None, "t1_c": None, "t1_d": None}
    order = [r["fullname"] for r in FR.preorder(nodes).orderBy("display_rank").collect()]
    assert order == ["t1_a", "t1_b", "t1_c", "t1_d"]


def test_fail_closed_on_drift(spark):
    bad = json.dumps([listing({"kind": "t3", "data": {"id": "p"}}),
                      listing({"kind": "t1", "data": {"id": "z"}})])      # replies key missing
    bad_count = response("q", c("y", listing(more("t1_y", True))))       # boolean count
    good = response("r", c("x"))
    nodes, drift = flatten(spark, [bad, bad_count, good])
    assert {r["thread_id"] for r in nodes.collect()} == {"t3_r"}
    assert {r["expected"] for r in drift.collect()} == {"an empty string or a Listing", "an integer"}


def test_cap_keeps_prefix_and_honest_remainder(spark):
    body = response("p", c("a", listing(c("b"), c("e"), more("t1_a", 4, 1))), c("f"), c("g"))
    nodes, _ = flatten(spark, [body])
    capped = FR.cap(nodes, 2).collect()
    kept = sorted(r["fullname"] for r in capped if r["kind"] == "t1")
    assert kept == ["t1_a", "t1_b"]
    synth = {r["ptr_parent_id"]: r["ptr_count"] for r in capped if r["synthetic"]}
    # under a: e (1) and the pointer after it (4); at top level: f and g
    assert synth == {"t1_a": 5, "t3_p": 2}


def test_cap_invariant_on_standin(spark):
    from loomweave.sources import standins as S

    nodes, _ = FR.flatten_post_responses(S.post_responses(spark, SF_SMALL))
    total = nodes.select(F.sum(F.when(F.col("kind") == "t1", 1).otherwise(F.col("ptr_count")))).first()[0]
    capped = FR.cap(nodes, 5)
    after = capped.select(F.sum(F.when(F.col("kind") == "t1", 1).otherwise(F.col("ptr_count")))).first()[0]
    assert total == after                                 # kept + remainder = total, nothing lost


def test_nested_output_reflattens(spark):
    body = response("p", c("a", listing(c("b", listing(c("c"))), c("d"))), c("e"))
    nodes, _ = flatten(spark, [body])
    docs = [json.loads(r["json"]) for r in FR.nested_comments(nodes).collect()]

    def count(d):
        return 1 + sum(count(x) for x in d["replies"])
    assert sorted(count(d) for d in docs) == [1, 4]
    assert all(list(d)[:3] == ["id", "fullname", "permalink"] and "more_count" in d for d in docs)


def test_splice_replaces_pointer_and_detects_dead_ends(spark):
    base = response("p", c("a", listing(c("b"), more("t1_a", 2, 1))), c("z", listing(c("y"), more("t1_z", 1, 1))))
    snap_a = response("p", c("a", listing(c("b"), c("n1"), c("n2"))))
    snap_z = response("p", c("z", listing(c("y"), more("t1_z", 1, 1))))   # nothing new: dead end
    nodes, _ = flatten(spark, [base])
    snaps, _ = flatten(spark, [snap_a, snap_z], subtree=True)
    merged, done, dead = X.expand(nodes, snaps)
    order = [(r["kind"], r["fullname"]) for r in FR.preorder(merged, kinds=("t1", "more"))
             .orderBy("display_rank").collect()]
    assert order == [("t1", "t1_a"), ("t1", "t1_b"), ("t1", "t1_n1"), ("t1", "t1_n2"),
                     ("t1", "t1_z"), ("t1", "t1_y"), ("more", None)]
    assert [r["root"] for r in dead.collect()] == ["t1_z"]
    assert [r["root"] for r in done.collect()] == ["t1_a"]
    v = FR.verdict(merged, None, 500, dead=dead).first()
    assert v["verdict"] == "depth_capped"


def test_leaf_that_gains_children_is_appended(spark):
    # base: a -> [b (leaf), pointer]; the snapshot of a shows b with a new reply.
    base = response("p", c("a", listing(c("b"), more("t1_a", 1, 1))))
    snap = response("p", c("a", listing(c("b", listing(c("n"))), c("m"))))
    nodes, _ = flatten(spark, [base])
    snaps, _ = flatten(spark, [snap], subtree=True)
    merged, done, dead = X.expand(nodes, snaps)
    order = [r["fullname"] for r in FR.preorder(merged, kinds=("t1", "more")).orderBy("display_rank").collect()]
    assert order == ["t1_a", "t1_b", "t1_n", "t1_m"]          # n appended under b, m takes a's pointer slot
    parents = {r["fullname"]: r["parent_fullname"] for r in merged.collect() if r["kind"] == "t1"}
    assert parents["t1_n"] == "t1_b" and parents["t1_m"] == "t1_a"


def test_request_budget_limits_expansion(spark):
    # Two expandable pointers, budget for one subtree request (the first GET is the post).
    base = response("p", c("a", listing(c("b"), more("t1_a", 1, 1))), c("z", listing(c("y"), more("t1_z", 1, 1))))
    snap_a = response("p", c("a", listing(c("b"), c("n1"))))
    snap_z = response("p", c("z", listing(c("y"), c("n2"))))
    nodes, _ = flatten(spark, [base])
    snaps, _ = flatten(spark, [snap_a, snap_z], subtree=True)
    merged, done, dead = X.expand(nodes, snaps, max_requests=2)
    assert [r["root"] for r in done.collect()] == ["t1_a"]      # display order decides
    v = FR.verdict(merged, None, 500, dead=dead).first()
    assert v["verdict"] == "max_requests"
