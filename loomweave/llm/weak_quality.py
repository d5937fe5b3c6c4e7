"""Quality by weak labels.

Overlapping heuristic labellers each call a text good, bad or abstain.  The
table of vote patterns over all documents (at most 3^labellers rows, counted
in Spark) is all that expectation-maximisation needs: it estimates each
labeller's accuracy and the share of good texts, and gives each pattern's
posterior.  Posterior labels of a bounded sample of documents then train
a linear scorer on hashed words and word shapes, which scores all documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.llm.io import OWN, least_hashed

#: Documents that train the scorer: those of the least hashes of id and text; numbers that a training vector keeps, its greatest.
SAMPLE = 4000
MOST_FEATURES = 4096
BUCKETS = 1 << 16
CACHE = 300_000
KEEP = 0.4
GOOD, BAD, NONE = "+", "-", "0"

_DOUBLED = re.compile(r"([!?%#$&*=~^_])\1")


_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _count(data: bytes, which: bytes) -> int:
    return len(data) - len(data.translate(None, which))


def votes(text: str) -> str:
    """One character per labeller: + good, - bad, 0 abstains."""
    words = text.split()
    n = len(words)
    if not n:
        return BAD * len(LABELLERS)
    data = text.encode("utf-8", "replace")
    upper, lower = _count(data, _UPPER), _count(data, _LOWER)
    shout = upper / max(1, upper + lower)
    marks = _count(data, _MARKS) / len(data)
    doubled = len(_DOUBLED.findall(text)) / n
    often = Counter(words)
    distinct, top = len(often) / n, max(often.values()) / n
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
    lines = [x for x in text.split("\n") if x.strip()]
    repeated = 1 - len(set(lines)) / len(lines)
    ends = sum(w[-1] in ".!?" for w in words) / n
    prose = (marks < 0.05 or len(data) < 120) and doubled < 0.01 and shout < 0.2
    varied = top < 0.15 and distinct > 0.4 and pairs > 0.75

    def say(bad: bool, good: bool) -> str:
        return BAD if bad else GOOD if good else NONE

    return "".join([
        say(shout > 0.5, False), say(len(data) >= 120 and marks > 0.07, False), say(doubled > 0.08, False), say(words.count("|") / n > 0.1, False),
        say(n >= 20 and top > 0.25, False), say(n >= 40 and distinct < 0.35, False), say(n >= 40 and pairs < 0.6, False),
        say(len(lines) >= 4 and repeated > 0.3, False),
        say(False, prose), say(False, n < 40 or varied), say(n >= 40 and ends > 0.5, prose and (n < 40 or 0.01 < ends < 0.35))])


LABELLERS = ("shouting", "marks", "doubled marks", "table bars", "one word", "repeated words", "repeated pairs", "repeated lines", "prose", "varied", "sentences")


def estimate(patterns: dict[str, int], rounds: int = 200) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over vote patterns: share of good texts, P(vote | class) as (labeller, class, vote), posterior per pattern.

    Abstaining counts as an outcome, as most labellers know one fault and speak
    only then.  Weak Dirichlet priors (2 % of the documents) say that a call of
    bad is rare for good texts and a call of good rare for bad ones, which also
    names the classes.
    """
    names = sorted(patterns)
    if not names:
        return 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3), {}
    count = np.array([patterns[p] for p in names], dtype=np.float64)
    v = np.array([["+-0".index(c) for c in p] for p in names])
    one = np.eye(3)[v]                                              # pattern, labeller, vote
    prior = np.array([[0.1, 0.3, 0.6], [0.6, 0.01, 0.39]]) * max(1.0, 0.02 * count.sum())
    post = np.where((v == 1).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        w = np.stack([count * (1 - post), count * post], axis=1)    # pattern, class
        share = (w[:, 1].sum() + 1) / (w.sum() + 2)
        table = np.einsum("pc,plv->lcv", w, one) + prior[None]
        table /= table.sum(axis=2, keepdims=True)
        like = np.einsum("plv,lcv->pc", one, np.log(table)) + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -50, 50)))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-9:
            break
    return float(share), table, dict(zip(names, post.tolist(), strict=True))


# ------------------------------------------------------------------ hashed linear scorer
def shape(word: str) -> str:
    """Letters as a or A, digits as 0, runs shortened, marks kept."""
    s = "".join("0" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in word[:64])
    return re.sub(r"(.)\1+", r"\1\1", s)


def buckets(word: str) -> tuple[int, int]:
    return zlib.crc32(word.lower().encode("utf-8", "replace")) % BUCKETS, zlib.crc32(b"\x00" + shape(word).encode("utf-8", "replace")) % BUCKETS


def _named(name: str) -> int:
    return zlib.crc32(b"\x01" + name.encode()) % BUCKETS


_AGAIN = _named("again")


def whole(words: list[str], distinct: int) -> list[tuple[int, float]]:
    """Features of a text as a whole: words that repeat the one before, and how many are distinct."""
    n = len(words)
    if n < 2:
        return []
    again = sum(map(eq, words, islice(words, 1, None))) / (n - 1)
    return [(_AGAIN, again), (_named(f"distinct {int(10 * distinct / n)} {min(9, n.bit_length())}"), 1.0)]


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and values of a text: word and shape shares, each a unit of mass, and whole-text features."""
    words = text.split()
    tally: dict[int, float] = {}
    often = Counter(words)
    for w, k in often.items():
        for b in buckets(w):
            tally[b] = tally.get(b, 0.0) + k / len(words)
    for b, x in whole(words, len(often)):
        tally[b] = tally.get(b, 0.0) + x
    return np.fromiter(tally, dtype=np.int32, count=len(tally)), np.fromiter(tally.values(), dtype=np.float32, count=len(tally))


@dataclass
class Scorer:
    bias: float
    weights: np.ndarray
    share: float
    accuracy: np.ndarray
    posterior: dict[str, float]


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 12, rate: float = 0.5, seed: int = 5) -> tuple[float, np.ndarray]:
    """Logistic regression on soft labels by adaptive gradient steps."""
    w, g2, bias, gb = np.zeros(BUCKETS), np.full(BUCKETS, 1e-3), 0.0, 1e-3
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            at, x, y = rows[i]
            e = 1 / (1 + np.exp(-np.clip(bias + (w[at] * x).sum(), -30, 30))) - y
            g = e * x + 1e-6 * w[at]
            g2[at] += g * g
            w[at] -= rate * g / np.sqrt(g2[at])
            gb += e * e
            bias -= rate * e / np.sqrt(gb)
    return bias, w


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scorer:
    """Votes of all documents, EM, and the scorer fitted on a bounded sample by the least hashes of id and text."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([votes(t.as_py() or "") for t in b.column(0)], pa.string())], names=["pattern"])

    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = src.select("text").mapInArrow(vote, "pattern string").groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    patterns = {r["pattern"]: r["n"] for r in counted.collect()}
    share, table, posterior = estimate(patterns)
    total = sum(patterns.values())
    if not total:
        return Scorer(0.0, np.zeros(BUCKETS), share, table, posterior)
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x, v = [], [], []
            for t in b.column(0):
                text = t.as_py() or ""
                a, y = vector(text)
                if len(a) > MOST_FEATURES:
                    top = np.argpartition(-y, MOST_FEATURES)[:MOST_FEATURES]
                    a, y = a[top], y[top]
                at.append(a.tobytes())
                x.append(y.tobytes())
                v.append(votes(text))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(x, pa.binary()), pa.array(v, pa.string())], names=["at", "x", "v"])

    key = F.xxhash64(F.lit("wq"), F.coalesce("id", F.lit("None")), F.coalesce("text", F.lit("")))
    chosen = least_hashed(src, key, SAMPLE).groupBy(f"{OWN}h").agg(F.min("text").alias("text"))       # rows that repeat count once
    some = chosen.select("text").mapInArrow(describe, "at binary, x binary, v string").toArrow().to_pylist()
    rows = [(np.frombuffer(r["at"], dtype=np.int32), np.frombuffer(r["x"], dtype=np.float32), posterior.get(r["v"], share))
            for r in sorted(some, key=lambda r: (r["v"], r["at"], r["x"]))]
    if not rows:
        raise ValueError("no document was chosen to train the scorer")
    bias, weights = fit(rows)
    return Scorer(float(bias), weights, share, table, posterior)


_state: dict = {}


def _word_sums(texts: list[str], weights: np.ndarray, key: str) -> np.ndarray:
    """Mean weight of each text's words, each looked up once per worker, and the weight of its whole-text features."""
    if _state.get("key") != key:
        _state.update(key=key, known={})
    known, out = _state["known"], np.zeros(len(texts))
    for i, text in enumerate(texts):
        words = text.split()
        if not words:
            continue
        own = set(words)
        new = [w for w in own if w not in known]
        if len(known) + len(new) > CACHE:
            known.clear()
            new = own
        for w in new:
            a, b = buckets(w)
            known[w] = float(weights[a] + weights[b])
        out[i] = sum(map(known.__getitem__, words)) / len(words) + sum(weights[b] * x for b, x in whole(words, len(own)))
    return out


def quality(docs: DataFrame, model: Scorer | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, votes, posterior (weak label), score (0 to 1, the scorer's), keep.

    Null and blank texts: every labeller calls them bad, score 0, not kept.
    Rows that repeat are scored each.  Other columns are not read.  An empty
    table gives no rows.
    """
    import uuid

    model = model or train(docs, id_col, text_col)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                texts = [t.as_py() or "" for t in part.column(1)]
                blank = np.array([not t or t.isspace() for t in texts])
                score = 1 / (1 + np.exp(-np.clip(m.bias + _word_sums(texts, m.weights, key), -30, 30)))
                score = np.where(blank, 0.0, score)
                v = [votes(t) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(v, pa.string()), pa.array([m.posterior.get(x, m.share) for x in v]), pa.array(score), pa.array(score >= KEEP)],
                                                 names=["doc_id", "votes", "posterior", "score", "keep"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, votes string, posterior double, score double, keep boolean")
