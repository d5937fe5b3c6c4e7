"""Interval numbering, containment join, pointer doubling and running sums against plain recursion."""

import random

from pyspark.sql import functions as F

from loomweave.operators import forest as FR
from loomweave.operators import intervals as I


def forest(rng, threads, n):
    """(thread, path) of random trees; the first thread holds a third of all nodes."""
    rows = []
    for t, size in enumerate([n // 3, *[2 * n // 3 // threads] * threads]):
        kids, paths = {(): 0}, [()]
        for _ in range(size):
            up = rng.choice(paths[-30:])
            path = (*up, kids[up])
            kids[up] += 1
            kids[path] = 0
            paths.append(path)
            rows.append((f"t{t}", list(path)))
    return rows


def under(rows, thread, path):
    return [p for t, p in rows if t == thread and tuple(p[:len(path)]) == tuple(path)]


def frame(spark, rows):
    return spark.createDataFrame([(t, p, sum(p) + 1) for t, p in rows], "thread_id string, path array<int>, w long").repartition(7)


def test_intervals_equal_prefix_tests(spark):
    rows = forest(random.Random(1), 8, 600)
    spans = {(r["thread_id"], tuple(r["path"])): r for r in I.numbered(frame(spark, rows), w=F.col("w")).collect()}
    assert len(spans) == len(rows)
    order = {t: sorted(tuple(p) for u, p in rows if u == t) for t, _ in rows}
    for t, p in rows:
        r, below = spans[t, tuple(p)], under(rows, t, p)
        assert r["entry"] == order[t].index(tuple(p)) and r["exit"] - r["entry"] == len(below)
        assert r["w"] == sum(sum(x) + 1 for x in below)


def test_containment_join_equals_prefix_tests(spark):
    rows = forest(random.Random(2), 5, 400)
    df = frame(spark, rows)
    spans = I.numbered(df)
    asks = spans.select("thread_id", F.col("path").alias("root"), F.col("entry").alias("lo"), F.col("exit").alias("hi")).filter("size(path) % 2 = 1")
    for span in (3, 1024):
        got = I.contained(spans.select("thread_id", "path", "entry"), asks, "entry", "lo", "hi", span=span)
        got = sorted((r["thread_id"], tuple(r["root"]), tuple(r["path"])) for r in got.collect())
        assert got == sorted((t, tuple(p), tuple(x)) for t, p in rows if len(p) % 2 for x in under(rows, t, p))
    plan = got and I.contained(spans.select("thread_id", "path", "entry"), asks, "entry", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    assert "_stretch" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_deep_chain_costs_rows_not_rows_times_depth(spark):
    depth = 1500
    rows = [("t", [0] * k) for k in range(1, depth + 1)]
    df = frame(spark, rows).withColumn("kind", F.lit("t1")).withColumn("ptr_count", F.lit(None).cast("long"))
    weights = FR.subtree_weight(df)
    assert "Generate" not in weights._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["weight"] for r in weights.collect()) == list(range(1, depth + 1))
    links = spark.createDataFrame([("t", k, k - 1 if k else None, 1) for k in range(depth)], "thread_id string, node long, up long, value long")
    ranks = I.fold_up(links, lambda above, below: above + below, depth).collect()
    assert sorted((r["node"], r["value"]) for r in ranks) == [(k, k + 1) for k in range(depth)]


def test_doubling_keeps_the_order_of_what_it_joins(spark):
    rows = forest(random.Random(3), 3, 120)
    links = spark.createDataFrame([(t, ".".join(map(str, p)), ".".join(map(str, p[:-1])) or None, [p[-1]]) for t, p in rows],
                                  "thread_id string, node string, up string, value array<int>")
    got = {(r["thread_id"], r["node"]): r["value"] for r in I.fold_up(links, F.concat, max(len(p) for _, p in rows)).collect()}
    assert all(got[t, ".".join(map(str, p))] == p for t, p in rows) and len(got) == len(rows)


def test_running_sums_with_null_groups_and_ties(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", None, "b"]), rng.randrange(9), i, rng.randrange(5)) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, o int, i long, v int").repartition(6)
    got = {r["i"]: (r["s"], r["n"]) for r in I.running_sums(df, ["g"], [F.col("o"), F.col("i")], {"s": F.col("v"), "n": F.lit(1)}).collect()}
    for g in ("a", None, "b"):
        s = n = 0
        for _, _, i, v in sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2])):
            assert got[i] == (s, n)
            s, n = s + v, n + 1
    assert I.running_sums(df.limit(0), ["g"], [F.col("o")], {"s": F.col("v")}).collect() == []
