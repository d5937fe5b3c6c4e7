"""A node's values leave the task that takes its response apart by JSON type, not as text to be read again."""

from pyspark.sql import functions as F

from loomweave.operators import forest as FR
from loomweave.sources import standins as S
from tests.test_flatten_apart import _same
from tests.test_forest import c, listing, more, response


def _values(*nodes):
    found = FR.taken_apart(response("p", *nodes).encode(), False)
    return [dict(zip([name for name, _ in FR.NODE_VALUES], n)) for n in found]


def test_values_by_type():
    n = _values(c("a", score=" 7 ", depth=1.0, edited=17, ups=True, downs=2 ** 63, collapsed="true", stickied=True, created_utc=1e9))[0]
    assert (n["s_score"], n["i_score"]) == (" 7 ", None)
    assert [n[k] for k in ("i_depth", "i_ups", "i_downs", "b_collapsed")] == [None] * 4
    assert (n["f_edited"], n["f_created_utc"], n["b_stickied"]) == (17.0, 1e9, True)
    assert type(n["f_edited"]) is float


def test_depths_above():
    n = _values(c("a", listing(c("b", listing(c("d", listing(c("e")), depth="x")), depth=" 4")), depth=3))
    by_id = {x["s_id"]: (x["top"], x["up_id"], x["up_depth"], x["up_depths"]) for x in n}
    assert by_id == {"a": (True, None, None, None), "b": (False, "a", 3, None), "d": (False, "b", 3, [" 4"]), "e": (False, "d", 3, ["x", " 4"])}


def test_same_as_by_level(spark):
    _same(spark, [response("p", c("a", listing(c("b", listing(c("d", listing(more("t1_d", 2, "5")), depth="x")), depth="\t4 ")), depth=3)),
                  response("q", c("a", author="😀", body="😀 \u0000"), c("b", listing(c("d")), name="t1_\ude00")),
                  response("s", c("a", created_utc=10 ** 30, edited=True, score=-1, ups="-12", downs=1e300), c("b", created_utc=-5, edited="9"))])


def test_heap_depths(spark):
    ks = [k for d in range(12) for k in ((3 ** (d + 1) - 3) // 2 + 1, (3 ** (d + 2) - 3) // 2)]
    got = spark.createDataFrame([(k,) for k in ks], "k long").select("k", F.expr(S.heap_depth_sql("k")).alias("d")).collect()
    assert {r.k: r.d for r in got} == {k: i // 2 for i, k in enumerate(ks)}
