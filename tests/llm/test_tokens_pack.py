"""Token counts, word ids and packing against the libraries and against their own rules."""

import random
import zlib
from array import array
from collections import defaultdict

import pytest

from loomweave.llm import pack_gga, token_counts, word_ids
from loomweave.llm.queries import tokenizer_path

rng = random.Random(11)
ALPHABET = ["the", "Water", "naïve", "ÉTÉ", "ét", "Σας", "İst", "日本語", "😀", "don't", "we'll", "3.14", "a1b2", "%%%", "¼", "ª", "<|endoftext|>", "<s>", "▁x", "x▁y", "</w>", "tab\tsep", "\x1c", "nb sp", " ", "ﬁ", "ǅ"]


def texts():
    out = [None, "", " ", "   ", "\n", " lead", "trail ", "two  gaps", "▁", "a   b", "<|endoftext|>", "<|STARTOFTEXT|> x", "x" * 5000]
    for n in (1, 3, 20, 200, 4000):
        out.append(" ".join(rng.choice(ALPHABET) for _ in range(n)))
        out.append("".join(rng.choice([*ALPHABET, " ", "  ", "\n"]) for _ in range(n)))
    return out


def test_counts_equal_the_library(spark):
    import sentencepiece

    path, data = tokenizer_path("piece_bpe_32k.model"), texts() + ["hot words here"] * 50
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(data)], "doc_id long, text string, n long, w long")
    got = {r.doc_id: r for r in token_counts.token_counts(df, path).collect()}
    for i, t in enumerate(data):
        n = len(sp.encode(t or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 4096), repr(t)[:60]
    assert token_counts.token_counts(df.limit(0), path).collect() == []
    old, token_counts.CACHE = token_counts.CACHE, 3
    try:
        raw = [(t or "").encode() for t in data]
        assert token_counts.count_tokens(raw, path, {}) == [len(sp.encode(t or "")) for t in data]
    finally:
        token_counts.CACHE = old


def test_frequent_words_cover_the_corpus(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    df = spark.createDataFrame([("common rare%d" % i,) for i in range(300)], "text string")
    assert set(token_counts.frequent(df, path, share=0.01)) == {b"common"}


def test_word_ids_equal_the_library():
    path = tokenizer_path("word_bpe_49k.json")
    enc = word_ids.WordIds(path)
    for t in texts():
        t = t or ""
        assert enc.encode(t) == array("I", enc.library.encode(t, add_special_tokens=False).ids).tobytes(), repr(t)[:80]


def test_texts_are_encoded_together(monkeypatch):
    import pyarrow as pa

    enc, cases, calls = word_ids.WordIds(tokenizer_path("word_bpe_49k.json")), [t or "" for t in texts()] + ["a\x01b c", "ΑΣ ΑΣ'S", "new words"], []
    merge = enc._words
    monkeypatch.setattr(enc, "_words", lambda words: calls.append(len(words)) or merge(words))
    want = [array("I", enc.library.encode(t, add_special_tokens=False).ids).tobytes() for t in cases]
    assert enc.encode_all(pa.array(cases)[1:]) == want[1:] and len(calls) == 2       # once for ASCII words, once for the others
    monkeypatch.setattr(word_ids, "CACHE", 3)
    assert enc.encode_all(pa.array([*cases, "more new words than it keeps"]))[:-1] == want
    assert enc.encode_all(pa.array([], pa.string())) == [] and enc.encode_all(pa.array([""])) == [b""]


def test_runs_of_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pack_gga, "RUN", 10)
    batch = pa.record_batch({"doc_id": list(range(7)), "text": ["a" * 4, None, "b" * 30, "", "c", "d" * 9, "e"]})
    runs = [r.column(0).to_pylist() for r in pack_gga._runs(batch)]
    assert [i for r in runs for i in r] == list(range(7)) and len(runs) > 1
    assert list(pack_gga._runs(batch.slice(0, 0))) == []


@pytest.mark.parametrize("block", [64, 4096])
def test_pack(spark, block):
    path, data = tokenizer_path("word_bpe_49k.json"), texts() + ["tok " * rng.randrange(1, 1500) for _ in range(200)] + ["same"] * 150 + ["w " * 9000]
    enc = word_ids.WordIds(path)
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(data)], "doc_id long, text string, item int")
    rows = pack_gga.pack(df, path, block=block).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    total = 0
    for i, t in enumerate(data):
        ids = array("I", enc.library.encode(t or "", add_special_tokens=False).ids + [0])
        total += len(ids)
        want = [(k, a, min(2048, len(ids) - a), zlib.crc32(ids[a:a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == want
    for members in by_seq.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    least = -(-total // 2048)
    assert len(by_seq) <= least + max(2, 0.02 * least)
    assert pack_gga.pack(df.limit(0), path).collect() == []


def test_crossover_keeps_every_item():
    import numpy as np

    gen = np.random.default_rng(1)
    sizes = [int(x) for x in gen.integers(1, 900, 400)]
    a = pack_gga.best_fit(range(400), sizes, 1000, [])
    b = pack_gga.best_fit(sorted(range(400), key=lambda i: -sizes[i]), sizes, 1000, [])
    for _ in range(20):
        c = pack_gga.crossover(a, b, sizes, 1000, gen)
        assert sorted(i for x in c for i in x) == list(range(400)) and all(sum(sizes[i] for i in x) <= 1000 for x in c)
    best = pack_gga.evolve(sizes, 1000, 3, [])
    assert len(best) <= len(b) and pack_gga.fitness(best, sizes, 1000) >= pack_gga.fitness(b, sizes, 1000)
