"""Language models: Kneser-Ney sums to one, held-out accuracy, rejection, odd inputs."""

import random
import zlib

import numpy as np

from loomweave.llm import lang_kn

VOICES = {"aa": "the of and house ship water then other".split(), "bb": "der und schiff wasser anders haus über".split(), "cc": "el agua otro casa barco ñandú y la".split()}


def corpus(n=400):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOICES))
        rows.append((i, " ".join(rng.choice(VOICES[lang]) for _ in range(rng.randrange(3, 60))), lang if i % 50 else None, 1, 0.5))
    return rows


SHAPE = "doc_id long, text string, lang string, h int, score double"


def test_predictions(spark):
    rows = corpus()
    truth = dict((r[0], r[2]) for r in rows)
    odd = [(900, None, "aa"), (901, "", "bb"), (902, " 12 %% ", "cc"), (903, "the ship " * 20000, "aa"), (None, "the water", None), (901, "der wasser", "bb"), (904, "qx zzkj 𝒳𝒳 ҖҖҖ " * 300, None)]
    df = spark.createDataFrame(rows + [(*r, 1, 0.5) for r in odd], SHAPE)
    model = lang_kn.train(df)
    got = lang_kn.predict(df, model).collect()
    assert len(got) == len(rows) + len(odd)
    right = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and truth.get(r.doc_id)]
    assert len(right) > 80 and np.mean(right) > 0.99
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    by = {(r.doc_id, r.lang_pred): r for r in got}
    assert by[900, "und"].score == by[902, "und"].score == 0.0 and (901, "und") in by and (901, "bb") in by and (None, "aa") in by
    assert (903, "aa") in by and all(0 <= r.score <= 1 for r in got)
    keep = lang_kn.accepted(df, model)
    kept = sorted(str(r.doc_id) for r in keep.collect())
    assert keep.columns == df.columns and kept == sorted(str(r.doc_id) for r in got if r.accepted)
    assert "900" not in kept and "902" not in kept and "904" not in kept and len(kept) >= len(rows)


def test_never_learns_from_held_out_rows(spark):
    rows = [(i, "x" if zlib.crc32(str(i).encode()) % 3 == 1 else "y", "held" if zlib.crc32(str(i).encode()) % 3 == 1 else "seen", 1, 0.0) for i in range(60)]
    assert lang_kn.train(spark.createDataFrame(rows, SHAPE)).langs == ["seen"]


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "text", None, 1, 0.0)], SHAPE)
    got = lang_kn.predict(df, lang_kn.train(df)).collect()
    assert [(r.lang_pred, r.score, r.accepted) for r in got] == [("und", 0.0, False)]
    assert lang_kn.predict(df.limit(0), lang_kn.train(df.limit(0))).collect() == []
    assert lang_kn.accepted(df.limit(0)).collect() == []


def test_probabilities_sum_to_one(spark):
    """Over every character seen and the floor's share for others, each context's probabilities sum to 1."""
    df = spark.createDataFrame([("aa", "ab abc abd abd b ba", False), ("bb", "cd c", False)], "lang string, text string, calibrate boolean")
    model = lang_kn.kneser_ney(lang_kn.count_grams(df))
    letters = "abcd" + lang_kn._END
    for context in ("", "a", "ab", "abd", "zz"):
        total = 0.0
        for c in letters + "q":
            m = lang_kn._START + context + c
            p = float(model.floor[0])
            for n in range(1, min(lang_kn.ORDER, len(m)) + 1):
                codes = np.array([[ord(x) for x in m[-n:]]], dtype=np.uint32)
                if n > 1:
                    i, ok = lang_kn._find(model.contexts[n], lang_kn.gram_hash(codes[:, :-1]))
                    p *= model.weight[n][i[0]][0] if ok[0] else 1.0
                i, ok = lang_kn._find(model.grams[n], lang_kn.gram_hash(codes))
                p += model.prob[n][i[0]][0] if ok[0] else 0.0
            total += p * (256 - len(letters) if c == "q" else 1)
        assert abs(total - 1.0) < 1e-6, (context, total)


def plain_kneser_ney(texts, alphabet=256):
    """log2 probability of a word, straight from the counts of every text."""
    count, order = {}, lang_kn.ORDER
    for t in texts:
        for w in t.lower().split():
            m = lang_kn._START + w + lang_kn._END
            for i in range(1, len(m)):
                for n in range(1, min(order, i + 1) + 1):
                    g = m[i - n + 1:i + 1]
                    count[g] = count.get(g, 0) + 1

    def use(g):
        if len(g) == order or g[0] == lang_kn._START:
            return count[g]
        return max(1, len({h for h in count if len(h) == len(g) + 1 and h[1:] == g}))
    used = {g: use(g) for g in count}
    discount = {}
    for n in range(1, order + 1):
        f1, f2 = (sum(len(g) == n and k == v for g, k in used.items()) for v in (1, 2))
        discount[n] = f1 / (f1 + 2 * f2) if f1 and f2 else 0.5
    own = {g[:-1]: [k for h, k in used.items() if len(h) == len(g) and h[:-1] == g[:-1]] for g in used}

    def prob(context, c):
        n, ks = len(context) + 1, own.get(context)
        if n == 1:
            lower = discount[1] * len(ks) / sum(ks) / max(alphabet, 2 * len(ks))
        else:
            lower = prob(context[1:], c)
        if not ks:
            return lower
        return (max(0.0, used[context + c] - discount[n]) / sum(ks) if context + c in used else 0.0) + (lower if n == 1 else lower * discount[n] * len(ks) / sum(ks))

    def word(w):
        m = lang_kn._START + w + lang_kn._END
        return sum(np.log2(prob(m[max(0, i - order + 1):i], m[i])) for i in range(1, len(m)))
    return word


def test_equals_plain_kneser_ney(spark):
    rng = random.Random(8)
    texts = {lang: [" ".join(rng.choice(v) for _ in range(9)) for _ in range(4)] for lang, v in VOICES.items()}
    df = spark.createDataFrame([(lang, t, False) for lang, ts in texts.items() for t in ts], "lang string, text string, calibrate boolean").repartition(3)
    model = lang_kn.kneser_ney(lang_kn.count_grams(df))
    words = ["the", "ship", "thother", "wasser", "ñandú", "qqq", "a", "schiffwasser"]
    got = model.words(words)
    for j, lang in enumerate(model.langs):
        plain = plain_kneser_ney(texts[lang])
        assert np.allclose(got[:, j], [plain(w) for w in words], atol=1e-9), lang


def test_sample_with_null_equal_and_repeated_ids(spark):
    """Over PER_LANG rows a language: whatever the ids, the bound holds and the texts are a sample of all."""
    rng = random.Random(5)
    texts = [(rng.choice(list(VOICES)), i) for i in range(5000)]
    texts = [(lang, " ".join(rng.choice(VOICES[lang]) for _ in range(12)) + f" n{i}") for lang, i in texts]
    for ids in (lambda i: i, lambda i: None, lambda i: 7, lambda i: 7 + i % 2):
        rows = [(ids(i), t, lang, 1, 0.0) for i, (lang, t) in enumerate(texts)] + [(7, "the same words", "aa", 1, 0.0)] * 2000
        some = lang_kn.sample(spark.createDataFrame(rows, SHAPE).repartition(6), per_lang=300).collect()
        for lang in VOICES:
            own = [r for r in some if r.lang == lang]
            assert len(own) == 300 and len({r.text for r in own}) == 300 and 25 <= sum(r.calibrate for r in own) <= 95
        assert sorted(some) == sorted(lang_kn.sample(spark.createDataFrame(rows, SHAPE).repartition(3), per_lang=300).collect())


def test_no_text_moves_before_the_sample_is_chosen(spark):
    df = spark.createDataFrame(corpus(), SHAPE)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lang_kn.sample(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(lang" in plan and "Window" not in plan


def test_letters():
    assert lang_kn.letter_runs("½²Ⅷ12_%") == [] and lang_kn.letter_runs("कि-ab1ñ") == ["कि", "ab", "ñ"]


def test_cache_start_over(spark):
    rng = random.Random(1)
    model = lang_kn.kneser_ney(spark.createDataFrame([("aa", 1, "a", 3), ("aa", 1, lang_kn._END, 2), ("aa", 2, lang_kn._START + "a", 2)], "lang string, n int, gram string, k long"))
    texts = [" ".join("a" * rng.randrange(1, 30) for _ in range(40)) for _ in range(20)]
    whole = lang_kn.entropies(texts, model, "one")[0]
    old, lang_kn.CACHE = lang_kn.CACHE, 10
    try:
        again = np.concatenate([lang_kn.entropies([t], model, "two")[0] for t in texts])
    finally:
        lang_kn.CACHE = old
    assert np.allclose(whole, again)


def test_each_gram_is_looked_up_once(monkeypatch):
    gen = np.random.default_rng(5)
    words = ["".join(gen.choice(list("abcé"), size=k)) for k in (1, 2, 3, 5, 9, 9, 40)] * 30
    grams = sorted({m[i - n + 1:i + 1] for w in words[:5] for m in ["\x02" + w + "\x03"] for n in range(1, 6) for i in range(max(1, n - 1), len(m))})

    def tables(texts, n, least):
        own = [t for t in texts if len(t) == n]
        h = np.array([lang_kn.gram_hash(np.array([[ord(c) for c in t]]))[0] for t in own], dtype=np.uint64)
        order = np.argsort(h)
        return h[order], gen.uniform(least, 1, (len(own), 2))[order]

    by_gram, by_context = [tables(grams, n, 0.1) for n in range(6)], [tables(grams, n - 1, 0.5) for n in range(6)]
    model = lang_kn.Model(["x", "y"], [t[0] for t in by_gram], [t[1] for t in by_gram], [t[0] for t in by_context], [t[1] for t in by_context], np.array([1e-4, 1e-5]))

    def plainly(word):
        m, total = "\x02" + word + "\x03", np.zeros(2)
        for i in range(1, len(m)):
            p = model.floor.copy()
            for n in range(1, min(5, i + 1) + 1):
                for text, hashes, values, times in ((m[i - n + 1:i], model.contexts, model.weight, True), (m[i - n + 1:i + 1], model.grams, model.prob, False)):
                    h = lang_kn.gram_hash(np.array([[ord(c) for c in text]]))[0] if text else np.uint64(0)
                    k = np.flatnonzero(hashes[n] == h) if n > 1 or not times else []
                    if len(k):
                        p = p * values[n][k[0]] if times else p + values[n][k[0]]
            total += np.log2(np.maximum(p, 1e-12))
        return total

    looked, find = [], lang_kn._find
    monkeypatch.setattr(lang_kn, "_find", lambda table, h: looked.append(len(h)) or find(table, h))
    got = model.words(words)
    assert np.allclose(got, [plainly(w) for w in words], rtol=1e-12, atol=0)
    assert max(looked) <= len({("\x02" + w + "\x03")[max(0, i - 4):i + 1] for w in words for i in range(1, len(w) + 2)})


def test_runs_of_tokens():
    runs, owner = lang_kn.runs_of(["a1b", "--", "naïve,", "3"])
    assert (runs, owner.tolist()) == (["a", "b", "naïve"], [0, 0, 2]) and lang_kn.runs_of([])[0] == []
