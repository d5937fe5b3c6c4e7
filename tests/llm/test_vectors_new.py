"""Exact top-k, whitening and clustering against plain versions; odd vectors, repeats, ties, empty tables."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomweave.llm import lloyd_shards as L
from loomweave.llm import qdwh_whiten as W
from loomweave.llm import topk_blocks as T

NAN, INF = float("nan"), float("inf")
ODD = [(2000, None), (2050, [NAN] + [1.0] * 7), (2100, [None] + [1.0] * 7), (2150, [INF] * 8), (2250, [-INF] + [0.0] * 7)]


def frame(spark, rows):
    """Extra columns have names that the operators use themselves."""
    data = [(i, v, 1, "x", 2) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, id int, leaf string, row int").repartition(5)


def clustered(n=900, d=8, seed=3):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((9, d))[rng.integers(9, size=n)] + 0.2 * rng.standard_normal((n, d))).astype(np.float32)
    x[100:400] = x[100]                     # a third are one vector
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


# ------------------------------------------------------------------ exact top-k
def plain_top_k(rows, k=5, scale=256):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    best = {}
    for q, a in good:
        if q % 50 == 0:
            for c, b in good:
                if c != q:
                    s = sum(x * y for x, y in zip(a, b, strict=False))
                    s = max(-(1 << 63), min((1 << 63) - 1, s))
                    best[q, c] = max(s, best.get((q, c), s))
    for q in {q for q, _ in best}:
        mine = sorted((-s, c) for (a, c), s in best.items() if a == q)[:k]
        out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(mine)}
    return out


@pytest.mark.parametrize("part,block,crowd", [(1 << 20, 128, 4096), (800, 16, 7)])
def test_top_k_equals_plain(spark, part, block, crowd):
    base = clustered()
    rows = base + ODD + [(2200, []), (2300, [1.0] * 3), (2350, [9.0] * 11), (None, base[0][1]), base[50], (50, base[7][1]), (3, base[8][1]), (2400, [0.0] * 8)]
    got = T.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, part=part, block=block, crowd=crowd)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_top_k([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])


def test_top_k_of_large_values_few_and_no_rows(spark):
    big = [(0, [3e38, 1.0]), (50, [-3e38, 1.0]), (7, [1e20, 5.0]), (8, [1e9, 2.0]), (9, [2.0, 3e6])]
    big = [(i, [float(np.float32(x)) for x in v]) for i, v in big]
    got = {tuple(r) for r in T.top_k(frame(spark, big), F.col("vec_id") % 50 == 0).collect()}
    assert got == plain_top_k(big) and len(got) == 8
    assert T.top_k(frame(spark, big).limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert T.top_k(frame(spark, [(0, [1.0])]), F.col("vec_id") % 50 == 0).collect() == []
    assert T.top_k(frame(spark, ODD), F.col("vec_id") % 50 == 0).collect() == []
    empty = T.top_k(frame(spark, [(0, []), (1, []), (2, [])]), F.col("vec_id") % 50 == 0).collect()
    assert {tuple(r) for r in empty} == {(0, 1, 1, 0), (0, 2, 2, 0)}


def test_blocks_below_the_kth_score_are_not_scored(monkeypatch):
    w = np.repeat(np.eye(8) * 100, 40, axis=0) + np.random.default_rng(1).integers(0, 5, (320, 8))
    ranges = T.order(w, 40)
    assert sorted(np.concatenate(ranges)) == list(range(320)) and all(len(r) <= 40 for r in ranges)
    blocks = [(r, w[r]) for r in ranges]
    high, low = (np.stack([f(w[r], axis=0) for r in ranges]) for f in (np.max, np.min))
    seen = []
    real = T.scores
    monkeypatch.setattr(T, "scores", lambda q, x: seen.append(len(q) * len(x)) or real(q, x))
    q = w[::40].copy()
    found = T.search(q, np.arange(0, 320, 40), np.full(8, -np.inf), blocks, high, low, 5)
    true = (q @ w.T).astype(int)
    for i, own in enumerate(range(0, 320, 40)):
        assert found[i] == sorted((-int(s), j) for j, s in enumerate(true[i]) if j != own)[:5]
    assert sum(seen) < 0.5 * 8 * 320


def test_bounds_are_never_too_small():
    rng = np.random.default_rng(5)
    for size in (1, 1e4, 1e9, 1e30):
        w, q = np.floor(rng.standard_normal((50, 6)) * size), np.floor(rng.standard_normal((9, 6)) * size)
        b = T.bounds(q, w.max(axis=0)[None], w.min(axis=0)[None])[:, 0]
        for i in range(9):
            assert b[i] >= max(float(sum(int(x) * int(y) for x, y in zip(q[i], r, strict=True))) for r in w)


# ------------------------------------------------------------------ whitening
def test_spectral_split_equals_library():
    rng = np.random.default_rng(2)
    cases = [np.cov(rng.standard_normal((64, 300))), np.diag([3.0, 1, 1, 1, 0, 0]), np.ones((5, 5)), np.zeros((4, 4)), np.array([[2.0]]),
             np.eye(6) + 1e-9 * np.ones((6, 6)), np.array([[0.0, 1], [1, 0]]), np.diag(2.0 ** np.arange(0, -40, -1))]
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    cases += [turn @ np.diag([5.0] * 4 + [2.0] * 4 + [1e-8] * 4) @ turn.T, turn @ np.diag(np.linspace(1, 2, 12)) @ turn.T * 1e12]
    for v in cases:
        e, q = W.spectral(v)
        size = max(1e-300, float(np.abs(v).max()))
        assert np.abs(e - np.linalg.eigvalsh(v)[::-1]).max() < 1e-13 * size * len(v)
        assert np.abs(q.T @ q - np.eye(len(v))).max() < 1e-13
        assert np.abs(v @ q - q * e).max() < 2e-13 * size * len(v)


def test_polar_factor():
    a = np.cov(np.random.default_rng(4).standard_normal((20, 90))) - np.eye(20)
    u = W.polar(a)
    e, q = np.linalg.eigh(a)
    assert np.abs(u - q * np.sign(e) @ q.T).max() < 1e-12 and np.abs(u @ u - np.eye(20)).max() < 1e-13


def test_whitening_equals_plain(spark):
    base = clustered(700, 8)
    rows = base + ODD + [(2200, []), (2300, [1.0] * 3), (None, base[0][1]), base[5], (5, base[6][1])]
    got = W.whiten(frame(spark, rows), components=6).collect()
    kept = [(i, v) for i, v in base + [(None, base[0][1]), base[5], (5, base[6][1])]]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept])
    n, s = len(x), x.sum(axis=0)
    mid = x - s / n
    cov = mid.T @ mid / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == n * 6 and {r["n"] for r in got} == {n}
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    want = {}
    for (i, _), y, m in zip(kept, x, mid, strict=True):
        dev = int(((n * y - s).astype(object) ** 2).sum())
        for c in range(6):
            want.setdefault((i, c + 1, dev), []).append(abs(m @ q[:, c]) / math.sqrt(e[c]))
    mine = {}
    for r in got:
        assert abs(r["explained"] - e[r["component"] - 1] / e.sum()) < 1e-10
        mine.setdefault((r["vec_id"], r["component"], r["deviation"]), []).append(abs(r["whitened"]))
    assert set(mine) == set(want)
    for key, values in want.items():
        assert np.allclose(sorted(values), sorted(mine[key]), atol=1e-7), key
    signs = {}
    for r in got:       # one sign for all rows
        m = dict(zip([i for i, _ in kept[:-3]], mid, strict=False)).get(r["vec_id"])
        if r["vec_id"] not in (None, 5) and abs(r["whitened"]) > 1e-3:
            signs.setdefault(r["component"], set()).add(np.sign(r["whitened"]) * np.sign(m @ q[:, r["component"] - 1]))
    assert all(len(x) == 1 for x in signs.values())


def test_whitening_of_flat_large_and_no_vectors(spark):
    assert W.whiten(frame(spark, ODD)).collect() == [] and W.whiten(frame(spark, ODD).limit(0)).collect() == []
    assert W.whiten(frame(spark, [(1, []), (2, [])])).collect() == []
    one = W.whiten(frame(spark, [(1, [0.5, -0.5])])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 1, 0, 0.0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0, 0.0)]
    flat = W.whiten(frame(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(40)])).collect()       # one direction varies
    assert len(flat) == 120 and all(abs(r["explained"] - (r["component"] == 1)) < 1e-12 for r in flat)
    assert all(r["whitened"] == 0.0 for r in flat if r["component"] > 1) and flat[0]["identity_error"] < 1e-9
    far = W.whiten(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(far) == 6 and all(r["deviation"] is None or r["deviation"] >= 0 for r in far) and all(math.isfinite(r["whitened"]) for r in far)


# ------------------------------------------------------------------ clustering
def plain_lloyd(rows, k, rounds, d, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for c in range(len(cents)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == c]
            if own:
                cents[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    final = [near(v) for _, v in kept]
    whole = sum(x for x, _ in final)
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((-1 if i is None else i, c, min(x, (1 << 63) - 1), min(sum(y for y, b in final if b == c), (1 << 63) - 1), min(whole, (1 << 63) - 1), name[c])
                  for (i, _), (x, c) in zip(kept, final, strict=True))


@pytest.mark.parametrize("columns,rows_", [(16, 4096), (3, 17)])
def test_lloyd_equals_plain(spark, columns, rows_):
    base = clustered(500, 8)
    rows = base + ODD + [(2200, []), (2300, [1.0] * 3), (None, base[0][1]), base[5], (5, base[6][1])]
    got = L.clusters(frame(spark, rows), k=4, rounds=10, dimensions=8, columns=columns, rows=rows_)
    got = sorted((-1 if r["vec_id"] is None else r["vec_id"], *tuple(r)[1:]) for r in got.collect())
    assert got == plain_lloyd(rows, 4, 10, 8)


def test_lloyd_of_few_equal_large_and_no_vectors(spark):
    assert L.clusters(frame(spark, ODD), dimensions=8).collect() == [] and L.clusters(frame(spark, ODD).limit(0), dimensions=8).collect() == []
    for rows in ([(1, [0.5] * 8), (2, [0.25] * 8)], [(i, [0.5] * 8) for i in range(30)],
                 [(i, [float(np.float32(3e37 * (i % 3))), -1e6] + [0.1] * 6) for i in range(9)]):
        rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
        got = sorted(tuple(r) for r in L.clusters(frame(spark, rows), k=8, rounds=10, dimensions=8, columns=3).collect())
        assert got == plain_lloyd(rows, 8, 10, 8)
