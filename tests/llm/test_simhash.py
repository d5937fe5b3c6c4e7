"""Fingerprints and links against brute force."""

import itertools
import random

import numpy as np
import xxhash

from loomweave.llm import components, simhash_gph


def brute_fp(text, n=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints_and_spark_hash(spark):
    rng = random.Random(2)
    texts = [None, "", " \n", "One", "two Words", "a b c", " x y z"] + [" ".join(rng.choice("Ab cd é ß Ω 日 x1".split()) for _ in range(k)) for k in (4, 9, 300)]
    assert [simhash_gph.fingerprint(t) for t in texts] == [brute_fp(t) for t in texts]
    h = spark.sql("SELECT xxhash64('a b c') h").first().h
    assert h % (1 << 64) == simhash_gph.fingerprint("A b\tc")


def test_links_are_exact(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 7, 15}
    for _ in range(400):       # a dense group: a hot key in every part
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(20), rng.randrange(5))))
    for f in list(fps)[:100]:
        fps.add(f ^ sum(1 << b for b in rng.sample(range(64), 3)))
    fps = np.array(sorted(fps), dtype=np.uint64)
    signed = [int(x) for x in fps.view(np.int64)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = brute_components([(signed[i], signed[j]) for i, j in zip(*np.nonzero(near), strict=True) if i < j], signed)
    for block in (16, 4096):
        got = {r.node: r.label for r in components.labels(simhash_gph.links(df, 3, block=block)).collect()}
        groups = {}
        for n in signed:
            groups.setdefault(want[n], set()).add(got.get(n, n))
        assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_plans_cover_every_distance():
    rng = np.random.default_rng(0)
    sample = rng.integers(-2**62, 2**62, size=200)
    for total in (100, 10**6, 10**10):
        parts = simhash_gph.plan(sample, total, 3)
        for flips in itertools.combinations(range(0, 64, 5), 3):
            assert any(sum(b in p for b in flips) <= t for p, t in parts)
        assert sum(t + 1 for _, t in parts) == 4


def test_allocate_is_best():
    rng = random.Random(4)
    for _ in range(20):
        costs = [[0.0] + [rng.random() for _ in range(4)] for _ in range(4)]
        best = min(sum(c[t + 1] for c, t in zip(costs, ts, strict=True)) for ts in itertools.product(range(-1, 4), repeat=4) if sum(t + 1 for t in ts) == 4)
        assert abs(simhash_gph.allocate(costs, 3)[0] - best) < 1e-12


def test_near_groups(spark):
    rng = random.Random(7)
    base = " ".join(str(rng.randrange(1000)) for _ in range(400))
    texts = [None, "", "one"] + [base] * 50 + [base.replace("7", "8", k) for k in range(30)] + [" ".join(str(rng.randrange(9999)) for _ in range(50)) for _ in range(20)]
    df = spark.createDataFrame([(i + 10, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, fp int, label int")
    got = {r.doc_id: r for r in simhash_gph.near_groups(df).collect()}
    fps = {i + 10: brute_fp(t) for i, t in enumerate(texts)}
    want = brute_components([(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3], list(fps))
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == fps
    kept = simhash_gph.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert simhash_gph.near_groups(df.limit(0)).collect() == []


def test_components_chain(spark):
    e = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 300)] + [(1000, 1000 + k) for k in range(1, 400)]
    got = {r.node: r.label for r in components.labels(spark.createDataFrame(e, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100, **{1000 + k: 1000 for k in range(400)}}
    assert components.labels(spark.createDataFrame([], "u long, v long")).collect() == []


def test_keep_one_with_repeated_ids(spark):
    rng = random.Random(3)
    a, b, c = (" ".join(str(rng.randrange(9999)) for _ in range(60)) for _ in range(3))
    # id 5 has two unrelated texts, b is also under 4, and c stands under 6 only as a copy of 5's row
    rows = [(5, a, "x"), (5, b, "y"), (4, b, "z"), (5, c, "u"), (6, c, "v"), (7, a, "w"), (5, a, "x"), (None, a, "n"), (9, None, "o"), (9, "", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.text or "", r.source) for r in simhash_gph.keep_one(df).collect() if r.doc_id is not None)
    assert [(i, s) for i, t, s in got if t] == sorted([(4, "z"), (5, "x"), (5, "u")], key=lambda x: (x[0], next(t for i, t, s in rows if (i, s) == x)))
    assert [i for i, t, _ in got if not t] == [9]
    assert simhash_gph.keep_one(df).filter("doc_id IS NULL").count() == 1
