"""Forest search: recall against brute force, exact scores, copies, hot vectors, odd vectors."""

import math

import numpy as np
from pyspark.sql import functions as F

from loomweave.llm import ann_forest as A


def test_search(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    x = (centres[rng.integers(12, size=1500)] + 0.3 * rng.standard_normal((1500, 24))).astype(np.float32)
    x[100:600] = x[100]                 # a third are one vector
    x[700:704] = x[700]
    x[704] = 2 * x[700]
    data = [(i, [float(v) for v in row], 1) for i, row in enumerate(x)]
    odd = [(2000, None), (2050, []), (2100, [0.0] * 24), (2150, [float("nan")] + [1.0] * 23), (2200, [None] + [1.0] * 23), (2250, [float("inf")] * 24), (2300, [1.0] * 3)]
    df = spark.createDataFrame(data + [(i, v, 1) for i, v in odd] + [(None, data[3][1], 1), data[50]], "vec_id long, embedding array<float>, id int")
    for shard in (200, 1 << 14):
        rows = A.nearest(df, F.col("vec_id") % 50 == 0, k=5, shard=shard).collect()
        assert len(rows) == 30 * 5 and {r.query_id for r in rows} == set(range(0, 1500, 50))
        u = x.astype(np.float64)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        hit = 0
        for q in range(0, 1500, 50):
            own = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
            assert [r.rank for r in own] == [1, 2, 3, 4, 5] and q not in {r.vec_id for r in own} and len({r.vec_id for r in own}) == 5
            assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
            for r in own:
                a, b = [float(v) for v in x[q]], [float(v) for v in x[r.vec_id]]
                assert abs(r.score - sum(p * s for p, s in zip(a, b, strict=True)) / math.sqrt(sum(p * p for p in a)) / math.sqrt(sum(p * p for p in b))) < 1e-12
            s = u @ u[q]
            s[q] = -9
            worst = np.sort(s)[-5]
            hit += sum(s[r.vec_id] >= worst - 1e-9 for r in own)
            if 100 <= q < 600:
                assert [r.vec_id for r in own] == [i for i in range(100, 107) if i != q][:5]
        assert hit / 150 >= 0.9


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id) for r in A.nearest(df, F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert A.nearest(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert A.nearest(df.filter("vec_id = 7"), F.col("vec_id") % 50 == 0).collect() == []


def test_budget_share_is_small_where_neighbours_are_close():
    rng = np.random.default_rng(0)
    close = np.repeat(rng.standard_normal((100, 32)), 20, axis=0) + 0.01 * rng.standard_normal((2000, 32))
    loose = rng.standard_normal((2000, 32))
    assert A.budget_share(A.Forest(close), close, 5) <= 0.2 < A.budget_share(A.Forest(loose), loose, 5)


def test_extreme_components_and_dense_clusters(spark):
    x = [(0, [1e200, 1e200]), (1, [1e-170, 2e-170]), (2, [3e200, -1e200]), (50, [5e-324, 0.0])]
    got = {(r.query_id, r.vec_id): r.score for r in A.nearest(spark.createDataFrame(x, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()}
    want = {(0, 1): 3 / math.sqrt(10), (0, 2): 1 / math.sqrt(5), (0, 50): 1 / math.sqrt(2), (50, 0): 1 / math.sqrt(2), (50, 1): 1 / math.sqrt(5), (50, 2): 3 / math.sqrt(10)}
    assert set(got) == set(want) and all(abs(got[k] - v) < 1e-12 for k, v in want.items())
    # the strings are whole: a dense cluster is entered below the counted levels
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 32, 4000) >> 22 | (5 << 24))
    for key in keys[::500]:
        level = A._descent(keys, int(key), 8, 40)
        match = (keys >> (32 - level)) == (int(key) >> (32 - level))
        assert level > 8 and match.sum() >= 40 and (level == 32 or ((keys >> (31 - level)) == (int(key) >> (31 - level))).sum() < 40)
