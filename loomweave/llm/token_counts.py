"""Token counts by a map-side two-tier lookup of pre-token lengths.

The vocabulary's pieces never join a word to the white space after it, so a
text's token count is the sum over its pre-tokens: a run of spaces and the
word behind it.  Tier one is a compact table, broadcast to every worker, of
the corpus' frequent pre-tokens with their token counts.  Tier two is each
worker's own bounded cache: misses are encoded together, once, and remembered
until the cache is full, when it starts afresh.  Pre-tokens are never shuffled: only
the summary of each task, words that make up at least ``SHARE`` of its words,
is merged to choose tier one, and that choice affects speed, never counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of the broadcast table, at most.
FREQUENT = 32_768
#: A task reports words that are at least this share of its words: at most 1 / SHARE rows a task.
SHARE = 1 / 20_000
#: Entries of a worker's cache before it starts afresh.
CACHE = 400_000
#: Longest pre-token (bytes) that is cached; longer ones are encoded each time.
LONGEST = 64

_SPACE, _MARK = b" ", "▁".encode()
_RUNS = re.compile(rb" *[^ ]+| +\Z")
_loaded: dict = {}
_caches: dict = {}


def processor(path: str):
    """The tokenizer of a model file, loaded once per worker."""
    import sentencepiece

    if path not in _loaded:
        _loaded[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _loaded[path]


def splits_at_spaces(path: str) -> bool:
    """Whether counts add up over pre-tokens: no piece but runs of spaces has a space behind its first character."""
    sp = processor(path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    return all("▁" not in p[1:] or not p.strip("▁") for p in pieces)


def pretokens(text: bytes) -> list[bytes]:
    """Pre-tokens of a non-empty text, less the one space that each has in front.

    The tokenizer puts a space before the text, writes spaces as a mark and
    reads the mark in a text as a space.
    """
    if _MARK in text:
        text = text.replace(_MARK, _SPACE)
    if b"  " not in text and text[:1] != _SPACE and text[-1:] != _SPACE:
        return text.split(_SPACE)
    return [p[1:] for p in _RUNS.findall(_SPACE + text)]


def _encode(sp, words: list[bytes]) -> list[int]:
    return [len(x) if w else 1 for w, x in zip(words, sp.encode([w.decode("utf-8", "replace") for w in words], num_threads=1), strict=True)]


def count_tokens(texts: list[bytes], path: str, tier_one: dict[bytes, int]) -> list[int]:
    """Token counts of texts by the two tiers."""
    sp, cache, out = processor(path), _caches.setdefault(path, {}), []
    for text in texts:
        if not text:
            out.append(0)
            continue
        words = pretokens(text)
        found = list(map(tier_one.get, words))
        if None in found:
            rest = [w for w, n in zip(words, found, strict=True) if n is None]
            new = [w for w in dict.fromkeys(rest) if w not in cache]
            if new:
                if len(cache) + len(new) > CACHE:
                    cache.clear()
                    new = list(dict.fromkeys(rest))
                got = dict(zip(new, _encode(sp, new), strict=True))
                cache.update((w, n) for w, n in got.items() if len(w) <= LONGEST)
            else:
                got = cache
            total = 0
            for w in rest:
                n = got.get(w)
                total += cache[w] if n is None else n
            out.append(total + sum(n for n in found if n is not None))
        else:
            out.append(sum(found))
    return out


def frequent(docs: DataFrame, path: str, text_col: str = "text", most: int = FREQUENT, share: float = SHARE) -> dict[bytes, int]:
    """Token counts of the corpus' frequent pre-tokens, over all documents.

    Every task counts all its pre-tokens and reports the frequent ones, so the
    merge sees at most 1 / share rows a task; at most ``most`` short words reach the driver.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total, limit = Counter(), 0, 2 * CACHE
        for b in batches:
            for t in b.column(0):
                words = (t.as_py() or "").encode("utf-8", "replace").split(_SPACE)
                total += len(words)
                seen.update(words)
                if len(seen) > limit:
                    # rare words go; what goes had at most this count, and a frequent word comes back at once
                    seen = Counter({w: n for w, n in seen.items() if n > 1 and n >= total * share / 4})
        rows = [(w, n) for w, n in seen.items() if n >= max(2, total * share) and len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], names=["w", "n"])

    best = (docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(tally, "w binary, n bigint")
            .groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(most).select("w"))
    words = [bytes(r["w"]) for r in best.collect()]
    words = [w for w in words if _MARK not in w]
    return dict(zip(words, _encode(processor(path), words), strict=True)) if words else {}


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the library on the whole text (no begin or end tokens,
    special strings as its default treats them).  Null text counts as empty: 0
    bytes, 0 tokens.  Rows that repeat are counted each.  Other columns are not
    read.  An empty table gives no rows.
    """
    if not splits_at_spaces(path):
        raise ValueError(f"{path}: pieces cross word starts, so counts do not add up over pre-tokens")
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent(docs, path, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                texts = [(t.as_py() or "").encode("utf-8", "replace") for t in part.column(1)]
                n = count_tokens(texts, path, known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n])], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
