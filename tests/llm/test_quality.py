"""Weak labels: EM recovers planted accuracies; the scorer agrees with given labels on data it has not seen."""

import random

import numpy as np

from loomweave.llm import weak_quality as W

TABLES = "/root/testdata/sf0.01"


def test_em_finds_the_classes():
    rng = random.Random(1)
    patterns, truth = {}, {}
    for _ in range(20_000):
        good = rng.random() < 0.8
        p = "".join("+" if good and rng.random() < 0.9 else "-" if not good and rng.random() < 0.4 else "0" for _ in W.LABELLERS)
        patterns[p] = patterns.get(p, 0) + 1
        truth.setdefault(p, []).append(good)
    share, table, post = W.estimate(patterns)
    right = sum(sum(g == (post[p] > 0.5) for g in gs) for p, gs in truth.items()) / 20_000
    assert right > 0.98 and abs(share - 0.8) < 0.03
    assert np.allclose(table.sum(axis=2), 1) and (table[:, 1, 0] > table[:, 0, 0]).all()
    assert W.estimate({})[2] == {}


def test_against_given_labels(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    rows = [r for r in W.quality(docs).collect() if r.doc_id in truth]
    good = [r.keep for r in rows if truth[r.doc_id]]
    bad = [r.keep for r in rows if not truth[r.doc_id]]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15


def test_odd_inputs(spark):
    prose = "The water runs over the stones, and the other boats lie still. " * 3
    texts = [None, "", " \n ", prose, prose + "Again.", "BUY!! NOW!! THIS!! " * 50, "x" * 200_000, "one"] + [prose + f"Word{i}." for i in range(30)] + ["% & % $$ " * 40] * 10
    df = spark.createDataFrame([(i, t, 0.5, True) for i, t in enumerate(texts)] + [(3, prose, 0.5, True), (None, prose, 0.5, True)], "doc_id long, text string, score double, keep boolean")
    rows = W.quality(df).collect()
    assert len(rows) == len(texts) + 2 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[0].score == by[1].score == by[2].score == 0 and not by[0].keep and by[3].keep and not by[5].keep
    assert W.quality(df.limit(0)).collect() == []


def test_null_and_equal_ids_give_the_scores_of_distinct_ids(spark):
    """The sample goes by id and text: what the ids are makes no difference to what is kept."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    true = {r.doc_id: r.quality for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    old, W.SAMPLE = W.SAMPLE, 400
    try:
        for ids in (lambda i: None, lambda i: 7):
            df = spark.createDataFrame([(ids(i), t) for i, t in texts] + [(7, "the same text")] * 500, "doc_id long, text string")
            model = W.train(df)
            assert np.abs(model.weights).max() > 0 and (W.train(df.repartition(3)).weights == model.weights).all()
            rows = [r for r in W.quality(docs, model).collect() if r.doc_id in true]
            assert np.mean([r.keep for r in rows if true[r.doc_id]]) > 0.95 and np.mean([r.keep for r in rows if not true[r.doc_id]]) < 0.2
    finally:
        W.SAMPLE = old


def test_em_equals_plain_loops():
    """The vectorised EM against one written out over single documents."""
    rng = random.Random(4)
    patterns = {}
    for _ in range(300):
        p = "".join(rng.choice("+-00") for _ in W.LABELLERS)
        patterns[p] = patterns.get(p, 0) + 1
    share, table, post = W.estimate(patterns, rounds=3)
    rows = [p for p, k in sorted(patterns.items()) for _ in range(k)]
    belief = {p: 0.05 if "-" in p else 0.95 for p in rows}
    weight = max(1.0, 0.02 * len(rows))
    prior = [[0.1, 0.3, 0.6], [0.6, 0.01, 0.39]]
    for _ in range(3):
        good = (sum(belief[p] for p in rows) + 1) / (len(rows) + 2)
        votes = [[[prior[c][v] * weight + sum((belief[p] if c else 1 - belief[p]) for p in rows if p[j] == "+-0"[v]) for v in range(3)]
                  for c in range(2)] for j in range(len(W.LABELLERS))]
        votes = [[[x / sum(vs) for x in vs] for vs in cs] for cs in votes]
        new = {}
        for p in set(rows):
            like = [1 - good, good]
            for j, x in enumerate(p):
                for c in range(2):
                    like[c] *= votes[j][c]["+-0".index(x)]
            new[p] = like[1] / sum(like)
        belief = new
    assert abs(share - good) < 1e-9 and np.allclose(table, votes) and all(abs(post[p] - belief[p]) < 1e-9 for p in belief)
