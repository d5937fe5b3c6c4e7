"""Exact dedup and mixing against brute force, with nulls, ties, repeats, hot keys and clashing columns."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomweave.llm import chunk_dedup, pareto_mix

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, chunk string, h int, keep_id string"


def fixture(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[i], 1, "x", 1, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SHAPE)


def words(rng, n):
    return " ".join(rng.choice(["Word.", "stir", "anger,", "Étude", "ÄRGER", "red ", "İx", "z9\n", "日本", "𝒳y"]) + str(rng.randrange(50)) for _ in range(n))


def corpus():
    rng = random.Random(5)
    base = [words(rng, n) for n in (1, 5, 80, 600, 5000)]
    texts = [None, "", "", " "] + base + [b.upper().translate(AZ) for b in base] + [b.swapcase() for b in base] + base
    texts += ["copy of a hot text " * 40] * 60 + ["x" * 30000, "x" * 30000, "x" * 30001, "X" * 30000]
    return texts


@pytest.mark.parametrize("hasher", [chunk_dedup.chunk_hash, lambda c: F.pmod(F.xxhash64(c), F.lit(5)).cast("bigint")])
def test_exact_groups(spark, hasher):
    texts = corpus()
    got = {r.doc_id: r for r in chunk_dedup.exact_groups(fixture(spark, texts), hasher=hasher).collect()}
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[(t or "").translate(AZ)].append(i)
    assert len(got) == len(texts)
    for norm, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_chunks_are_the_text(spark):
    texts = [t for t in corpus() if t]
    df = fixture(spark, texts).select("text", chunk_dedup.chunks(F.col("text"), 16, 64).alias("c")).collect()
    for r in df:
        assert "".join(r.c) == r.text and all(len(c) <= 64 for c in r.c)


def test_a_change_leaves_most_chunks(spark):
    rng = random.Random(1)
    text = words(rng, 3000)
    df = fixture(spark, [text, "new head " + text]).select(chunk_dedup.chunks(F.col("text"), 64, 512).alias("c")).collect()
    a, b = set(df[0].c), set(df[1].c)
    assert len(a & b) > 0.9 * len(a)


def test_keep_one_repeats_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "A"), (None, "a"), (None, "b"), (2, "c"), (2, "d"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("extra", F.lit(1))
    got = sorted(((r.doc_id, (r.text or "").lower()) for r in chunk_dedup.keep_one(df).collect()), key=str)
    assert got == sorted([(1, "a"), (None, "b"), (2, "c"), (2, "d"), (3, "")], key=str)
    assert chunk_dedup.keep_one(df).columns == df.columns


def test_empty_tables(spark):
    e = fixture(spark, [])
    assert chunk_dedup.exact_groups(e).collect() == []
    assert pareto_mix.mix(e).collect() == []
    assert pareto_mix.mixed_documents(e).collect() == []


def level(sizes, weights, goal, most):
    """Targets by resharing the excess until none is above."""
    target, capped = {}, set()
    while True:
        free = [s for s in sizes if s not in capped]
        rest = goal - sum(most * sizes[s] for s in capped)
        total = sum(weights[s] for s in free)
        target = {s: most * sizes[s] for s in capped} | {s: rest * weights[s] / total for s in free}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_mix(spark):
    rng = random.Random(3)
    sources = [rng.choice(["hot"] * 8 + ["b", "c", None, "é"]) for _ in range(900)]
    texts = [rng.choice([None, "", " \t"]) if rng.random() < 0.03 else "w " * rng.randrange(1, 400) for _ in range(900)]
    df = fixture(spark, texts, sources)
    rows = pareto_mix.mix(df).collect()
    assert len(rows) == 900
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in pareto_mix.mix(df.repartition(7)).collect())
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").split()) and r.taken == r.copies * r.size <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = sorted([s for s in sizes if s is not None]) + [None]
    want = level(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(sizes.values()), 2)
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= max(5, 0.01 * target[s])
    copies = {r.doc_id: r.copies for r in rows}
    many = pareto_mix.mixed_documents(df)
    assert many.columns == df.columns
    seen = defaultdict(int)
    for r in many.collect():
        seen[r.doc_id] += 1
    assert {k: v for k, v in copies.items() if v} == dict(seen)


def test_inclusion_follows_size(spark):
    df = spark.createDataFrame([(i, "w " * (10 if i % 2 else 300), "a" if i < 4000 else "b") for i in range(4400)], "doc_id long, text string, source string")
    got = pareto_mix.mix(df, weights=(1.0, 9.0)).filter("source = 'a'").groupBy("size").agg(F.avg(F.col("copies"))).collect()
    share = {r[0]: r[1] for r in got}
    assert share[300] > share[10]
