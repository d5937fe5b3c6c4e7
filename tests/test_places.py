"""A response's nodes are numbered while it is taken apart; the numbers are those of the interval numbering."""

from pyspark.sql import functions as F

from loomweave.operators import forest as FR
from loomweave.operators import intervals as I
from loomweave.session import stored
from tests.test_flatten_apart import _responses
from tests.test_forest import c, listing, more, response

TREE = [c("a", listing(c("b", listing(c("d"), more("t1_b", 4))), more("t1_a", 2), c("e"))), more("t3_p", 7), c("f", listing(c("g")))]


def _by_path(df, *cols):
    return {tuple(r["path"]): tuple(r[x] for x in cols) for r in df.collect()}


def test_places_are_the_interval_numbers(spark):
    nodes = FR.flatten_post_responses(_responses(spark, [response("p", *TREE)]))[0]
    spans = I.numbered(nodes.drop(*FR.PLACES), weight=FR._own_weight())
    assert _by_path(nodes, "entry", "exit", "weight") == _by_path(spans, "entry", "exit", "weight")
    t1 = nodes.filter("kind = 't1'")
    own = _by_path(I.numbered(t1.drop(*FR.PLACES)), "entry", "exit")
    assert _by_path(t1, "t1_entry", "t1_exit") == own
    assert _by_path(t1, "t1_up") == {p: (own[p[:-1]][0] if p[1:] else None,) for p in own}
    assert nodes.filter("kind = 'more' and coalesce(t1_entry, t1_exit, t1_up) is not null").count() == 0


def test_nothing_is_sorted_again_for_numbers(spark, monkeypatch):
    nodes = FR.flatten_post_responses(_responses(spark, [response("p", *TREE)]))[0]
    plain = nodes.drop(*FR.PLACES)
    anchors = spark.createDataFrame([("t3_p", "D"), ("t3_p", "f"), ("t3_p", "no")], "thread_id string, comment_id string")
    view = lambda n, *also: FR.comments_view(n, also=also).withColumn("kind", F.lit("t1"))
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    numbered = view(nodes, *[F.col(f"t1_{x}").alias(x) for x in ("entry", "exit", "up")]).withColumns({"ups": F.lit(1), "downs": F.lit(0)})
    bare = view(plain).withColumns({"ups": F.lit(1), "downs": F.lit(0)})
    was = [rows(FR.subtree_weight(plain)), rows(FR.cap(plain, 2)), rows(FR.cap(plain, None, max_depth=0)),
           rows(FR.anchor(plain, anchors, context=1)[0]), rows(FR.sibling_sort(bare, "old"))]
    monkeypatch.setattr(FR.I, "numbered", None)
    assert was == [rows(FR.subtree_weight(nodes)), rows(FR.cap(nodes, 2)), rows(FR.cap(nodes, None, max_depth=0)),
                   rows(FR.anchor(nodes, anchors, context=1)[0]), rows(FR.sibling_sort(numbered, "old"))]


def test_threads_of_several_responses_are_numbered_as_one(spark):
    bodies = [response("p", c("a", listing(c("b")))), response("p", c("a", listing(c("b"), c("d"))), c("e")), response("q", c("f"))]
    nodes = FR.flatten_post_responses(_responses(spark, bodies))[0]
    spans = I.numbered(nodes.drop(*FR.PLACES), weight=FR._own_weight())
    joined = nodes.select("thread_id", "path", *[F.col(x).alias(f"_{x}") for x in ("entry", "exit", "weight")]).join(spans, ["thread_id", "path"])
    assert joined.count() == nodes.count() == 7
    assert joined.filter("_entry = entry and _exit = exit and _weight = weight").count() == 7


def test_stored_reads_only_what_is_asked(spark):
    df = stored(spark.createDataFrame([(1, "a", [1]), (2, None, None)], "k long, s string, p array<int>"), "test")
    assert sorted(map(tuple, df.collect())) == [(1, "a", [1]), (2, None, None)]
    assert "ReadSchema: struct<k:bigint>" in df.select("k")._jdf.queryExecution().toString()
