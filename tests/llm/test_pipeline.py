"""All stages of the pipeline over one small table, each held against a plain version."""

import random

import pytest
from test_simhash import brute_components, brute_fp

import corpus_pipeline
from loomweave.llm import io

VOICES = {"aa": "the of and house ship water then other boat stone river hill".split(), "bb": "der und schiff wasser anders haus fluss berg stein boot".split()}
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(240):
        lang = rng.choice(list(VOICES))
        rows.append((i, " ".join(rng.choice(VOICES[lang]) for _ in range(rng.randrange(20, 90))), lang, rng.choice(["s1", "s2", None])))
    rows += [(300 + i, rows[3][1], "aa", "s1") for i in range(60)]                 # one text, many ids
    rows += [(400 + i, rows[4][1].upper(), None, "s2") for i in range(3)]
    rows += [(5, rows[6][1], "aa", "s1"), rows[7], rows[7], (None, rows[8][1] + " ship water", None, "s1"), (None, None, None, None)]
    rows += [(500, None, "aa", "s1"), (501, "", "bb", "s1"), (502, "12 % 34", "aa", "s2"), (503, " ".join(["the water"] * 30000), "aa", "s1")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("broadcast_keys", [io.BROADCAST_KEYS, 0])
def test_stages(spark, monkeypatch, broadcast_keys):
    monkeypatch.setattr(io.rows_that_stay, "__defaults__", (broadcast_keys,))
    rows = corpus()
    docs = spark.createDataFrame(rows, SHAPE).repartition(5)
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language_id", "exact_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]

    known = spark.createDataFrame(stage["language_id"](spark, docs, None).collect(), SHAPE)
    got = tuples(known)
    assert all(r in rows for r in got) and not any(r[0] in (500, 501, 502) for r in got)
    assert sum(r[0] is not None and r[0] < 300 for r in got) >= 240

    exact = spark.createDataFrame(stage["exact_dedup"](spark, known.repartition(4), None).collect(), SHAPE)
    left = tuples(exact)
    groups = {}
    for r in got:
        groups.setdefault(lower(r[1]), []).append(r)
    assert len(left) == len(groups)
    for r in left:
        own = groups[lower(r[1])]
        assert r in own and (r[0] if r[0] is not None else -1) == max(x[0] if x[0] is not None else -1 for x in own)

    near = spark.createDataFrame(stage["simhash_near_dedup"](spark, exact.repartition(3), None).collect(), SHAPE)
    stay = tuples(near)
    fps = {r[1]: brute_fp(r[1]) for r in left}
    kinds = sorted(set(fps.values()))
    of = brute_components([(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1:] if (a ^ b).bit_count() <= 3], kinds)
    least = {}
    for r in left:
        if r[0] is not None:
            least[of[fps[r[1]]]] = min(r[0], least.get(of[fps[r[1]]], r[0]))
    assert sorted(r[0] for r in stay if r[0] is not None) == sorted(least.values()) and all(r in left for r in stay)
    assert [r for r in stay if r[0] is None] == [r for r in left if r[0] is None]

    mixed = spark.createDataFrame(stage["mix_sources"](spark, near, None).collect(), SHAPE)
    copies = tuples(mixed)
    assert all(copies.count(r) <= 2 for r in stay) and all(r in stay for r in copies) and copies

    packed = stage["best_fit_packing"](spark, mixed, None).collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in copies}
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SHAPE)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == corpus_pipeline.COLUMNS and docs.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, None).collect() == []
