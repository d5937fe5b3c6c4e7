"""Language identification by interpolated Kneser-Ney character models.

One model of order ``ORDER`` per language predicts the letters of lower-cased
words and each word's end, from up to four characters before and the word's
start.  All languages' n-grams share one sorted hash array per order; beside a
hash stand, per language, the discounted probability of its last character
and, for contexts, the weight of the shorter context.  A text takes the
language with the least cross-entropy per character.

Calibration (on training documents that the counts did not see): one factor
turns cross-entropies into probabilities, and a limit per language on how far
a text's cross-entropy may lie above that language's usual one.  Texts beyond
the limit, without letters, or with no language above ``LEAST_SCORE`` are
rejected.

Only word-level sums are needed, so each worker scores a word once and keeps
the result in a bounded cache.  Training takes a bounded sample of labelled
rows: at most ``PER_LANG`` documents of each language, by the hash of doc_id
and text; all their n-grams are counted and smoothed in Spark.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomweave.llm.io import saved

ORDER = 5
#: Labelled training documents per language, and the share of them kept for calibration.
PER_LANG = 3000
CALIBRATION = 5
#: Languages that are learned, the most frequent ones; probabilities that a language keeps of each order once all are smoothed.
MOST_LANGS = 512
MOST_GRAMS = 1_000_000
LEAST_SCORE = 0.5
CACHE = 300_000
UNKNOWN = "und"

_START, _END = "\x02", "\x03"
#: Letters, with the marks that belong to them.
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_LETTERS_OR_END = regex.compile(_LETTERS.pattern + r"|\n")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def letter_runs(token: str) -> list[str]:
    return _LETTERS.findall(token)


def runs_of(tokens: list[str]) -> tuple[list[str], np.ndarray]:
    """The letter runs of all tokens (without line ends) in their order, and the number of each one's token."""
    found = _LETTERS_OR_END.findall("\n".join(tokens))
    end = np.fromiter((x == "\n" for x in found), dtype=bool, count=len(found))
    return [x for x in found if x != "\n"], np.cumsum(end)[~end]


def gram_hash(codes: np.ndarray) -> np.ndarray:
    """Hashes of rows of character codes."""
    h = np.zeros(len(codes), dtype=np.uint64)
    for j in range(codes.shape[1]):
        h = _longer(h, codes[:, j])
    return h


def _longer(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of grams with one more character code each."""
    with np.errstate(over="ignore"):
        h = (h ^ codes.astype(np.uint64)) * _PRIME
    return h ^ (h >> np.uint64(29))


def _sums(owner: np.ndarray, values: np.ndarray, n: int, rows: np.ndarray | None = None) -> np.ndarray:
    """Sums of the rows of ``values`` (those that ``rows`` names, in that order) per owner, added up in their order."""
    out = np.zeros((n, values.shape[1]))
    for k in range(values.shape[1]):
        column = np.ascontiguousarray(values[:, k])
        out[:, k] = np.bincount(owner, weights=column if rows is None else column[rows], minlength=n)
    return out


@dataclass
class Model:
    """Sorted hash arrays: grams[n] with prob[n] (row, language), contexts[n] with weight[n]."""

    langs: list[str]
    grams: list[np.ndarray]
    prob: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    floor: np.ndarray
    factor: float = 1.0
    usual: np.ndarray | None = None
    limit: np.ndarray | None = None

    def words(self, words: list[str]) -> np.ndarray:
        """Log2-probability of every word (row) in every language."""
        out = np.zeros((len(words), len(self.langs)))
        if not words or not self.langs:
            return out
        marked = [_START + w + _END for w in words]
        lengths = np.array([len(m) for m in marked])
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = np.arange(len(codes)) - first            # place in the word, 0 at the start mark
        at = np.flatnonzero(place > 0)
        # hashes of the grams that end at each place, by order; a place's context is the gram that ends before it
        ends = [np.zeros(len(codes), dtype=np.uint64)]
        for _ in range(ORDER):
            ends.append(_longer(np.r_[np.uint64(0), ends[-1][:-1]], codes))
        # the longest gram of a place, back to the start mark at most, gives its probabilities: each is worked out once
        longest = np.stack(ends)[np.minimum(place[at] + 1, ORDER), at]
        _, one, same = np.unique(longest, return_index=True, return_inverse=True)
        at = at[one]
        p = np.repeat(self.floor[None, :], len(at), axis=0)
        for n in range(1, ORDER + 1):
            ok = np.flatnonzero(place[at] >= n - 1)
            if not len(ok):
                break
            if n > 1:
                c, known = _find(self.contexts[n], ends[n - 1][at[ok] - 1])
                p[ok[known]] *= self.weight[n][c[known]]
            g, known = _find(self.grams[n], ends[n][at[ok]])
            p[ok[known]] += self.prob[n][g[known]]
        return _sums(np.repeat(np.arange(len(words)), lengths - 1), np.log2(np.maximum(p, 1e-12)), len(words), same)

    def decide(self, entropy: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its calibrated probability, and whether it is accepted."""
        z = -entropy * self.factor * np.sqrt(n)[:, None]
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        best = entropy.argmin(axis=1)
        score = (e / e.sum(axis=1, keepdims=True))[np.arange(len(best)), best]
        over = (entropy[np.arange(len(best)), best] - self.usual[best]) * np.sqrt(np.minimum(n, 400))
        return best, score, (score >= LEAST_SCORE) & (over <= self.limit[best])


def _find(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(h), dtype=np.int64), np.zeros(len(h), dtype=bool)
    i = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return i, table[i] == h


# ------------------------------------------------------------------ training
def sample(docs: DataFrame, per_lang: int = PER_LANG, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, text, calibrate: of each language the ``per_lang`` training rows of the least hashes of (id, text).

    Rows equal in id and text count once.  No text moves before the rows are chosen: the number of
    distinct hashes per language gives a first limit, the hashes below it the exact one, and both
    (a row a language, ``MOST_LANGS`` at most) go back to the rows as a broadcast table.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    crc = F.crc32(F.coalesce("id", F.lit("None")).cast("binary"))
    d = d.filter(F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & (F.pmod(crc, F.lit(3)) != 1))
    d = d.withColumn("h", F.shiftrightunsigned(F.xxhash64(F.lit("kn"), F.coalesce("id", F.lit("None")), F.coalesce("text", F.lit(""))), 2))

    def below(rows: DataFrame, limits: list[tuple[str, int]]) -> DataFrame:
        of = spark.createDataFrame(limits, "of string, most bigint")
        return rows.join(F.broadcast(of), (F.col("lang") == F.col("of")) & (F.col("h") <= F.col("most"))).drop("of", "most")

    kinds = d.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"), F.count(F.lit(1)).alias("rows"))
    kinds = kinds.orderBy(F.desc("rows"), "lang").limit(MOST_LANGS).collect()
    first = [(r["lang"], int(min(1.0, (1.3 * per_lang + 64) / max(1, r["n"])) * ((1 << 62) - 1))) for r in kinds]
    hashes = below(d.select("lang", "h"), first).distinct().groupBy("lang").agg(F.array_sort(F.collect_set("h")).alias("hs"))
    last = [(r["lang"], r["most"]) for r in hashes.select("lang", F.col("hs")[F.least(F.size("hs"), F.lit(per_lang)) - 1].alias("most")).collect()]
    # equal rows are combined in their own task first
    best = below(d.select("lang", "h", "text"), last).groupBy("lang", "h").agg(F.min("text").alias("text"))
    return best.select("lang", "text", (F.pmod("h", F.lit(CALIBRATION)) == 0).alias("calibrate"))


def count_grams(labelled: DataFrame) -> DataFrame:
    """lang, n, gram, k of all n-grams of the labelled texts: counted per task, merged by a shuffle of distinct grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words.update((lang, w) for t in (text.as_py() or "").lower().split() for w in letter_runs(t))
        grams: Counter = Counter()
        for (lang, word), k in words.items():
            m = _START + word + _END
            for i in range(1, len(m)):
                for n in range(1, min(ORDER, i + 1) + 1):
                    grams[lang, n, m[i - n + 1:i + 1]] += k
        rows = list(grams.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
                                          pa.array([k[2] for k, _ in rows], pa.string()), pa.array([v for _, v in rows], pa.int64())],
                                         names=["lang", "n", "gram", "k"])

    return labelled.select("lang", "text").mapInArrow(run, "lang string, n int, gram string, k bigint").groupBy("lang", "n", "gram").agg(F.sum("k").alias("k"))


def smoothed(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, n, gram, prob) and (lang, n, context, weight), from all counts.

    Lower orders count distinct left neighbours, but for grams at a word's start, which have none.
    Each order has one absolute discount per language, from its counts of 1 and 2.
    """
    left = (counts.filter("n > 1").groupBy("lang", (F.col("n") - 1).alias("n"), F.expr("substring(gram, 2)").alias("gram"))
            .agg(F.count(F.lit(1)).alias("kinds")))
    own = (F.col("n") == ORDER) | F.col("gram").startswith(_START)
    use = counts.join(left, ["lang", "n", "gram"], "left").select(
        "lang", "n", "gram", F.expr("substring(gram, 1, n - 1)").alias("context"), F.when(own, F.col("k")).otherwise(F.coalesce("kinds", F.lit(1))).alias("k"))
    use = saved(use)
    f1, f2 = F.sum(F.when(F.col("k") == 1, 1).otherwise(0)), F.sum(F.when(F.col("k") == 2, 1).otherwise(0))
    # a row per language and order
    cut = F.broadcast(use.groupBy("lang", "n").agg(F.when((f1 > 0) & (f2 > 0), f1 / (f1 + 2 * f2)).otherwise(F.lit(0.5)).alias("d")))
    contexts = use.groupBy("lang", "n", "context").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("kinds")).join(cut, ["lang", "n"])
    prob = use.join(contexts, ["lang", "n", "context"]).select("lang", "n", "gram", "k", ((F.col("k") - F.col("d")) / F.col("total")).alias("prob"))
    return prob, contexts.select("lang", "n", "context", "kinds", (F.col("d") * F.col("kinds") / F.col("total")).alias("weight"))


def kneser_ney(counts: DataFrame, most: int = MOST_GRAMS) -> Model:
    """The model from all n-gram counts, smoothed in Spark; hashes and values of the finished tables reach the driver.

    A language keeps of each order the ``most`` probabilities (and of contexts as many) of its most
    frequent grams, a bound on the model's size that leaves counts, discounts and weights as they are.
    """
    prob, weight = smoothed(saved(counts))

    def kept(df: DataFrame, text: str, order: str, value: str) -> pa.Table:
        def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                n, texts, h = b.column(1).to_numpy(), b.column(2).to_pylist(), np.zeros(b.num_rows, dtype=np.uint64)
                lengths = np.array([len(t) for t in texts])
                for m in np.unique(lengths):
                    at = np.flatnonzero(lengths == m)
                    codes = np.frombuffer("".join(texts[i] for i in at).encode("utf-32-le"), dtype=np.uint32).reshape(len(at), m)
                    h[at] = gram_hash(codes)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(h.view(np.int64)), b.column(3)], names=["lang", "n", "h", "x"])

        top = df.withColumn("r", F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc(order), text))).filter(F.col("r") <= most)
        return top.select("lang", "n", text, value).mapInArrow(hashed, "lang string, n int, h bigint, x double").toArrow()

    p, w = kept(prob, "gram", "k", "prob"), kept(weight, "context", "kinds", "weight")
    langs = sorted(set(p["lang"].unique().to_pylist()))
    code = {x: i for i, x in enumerate(langs)}
    # the floor: what unseen characters share, from the unigrams' discount
    floor = np.full(len(langs), 1e-9)
    for r in weight.filter("n = 1").collect():
        floor[code[r["lang"]]] = max(1e-9, r["weight"] / max(256, 2 * r["kinds"]))

    def arrays(t: pa.Table, missing: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
        n, h, x = t["n"].to_numpy(), t["h"].to_numpy().view(np.uint64), t["x"].to_numpy()
        lang = np.array([code[v] for v in t["lang"].to_pylist()], dtype=np.int64)
        hashes, values = [np.empty(0, dtype=np.uint64)], [np.empty((0, len(langs)))]
        for m in range(1, ORDER + 1):
            own = n == m
            keys, at = np.unique(h[own], return_inverse=True)
            table = np.full((len(keys), len(langs)), missing)
            table[at, lang[own]] = x[own]
            hashes.append(keys)
            values.append(table)
        return hashes, values

    grams, gp = arrays(p, 0.0)
    contexts, cw = arrays(w, 1.0)
    return Model(langs, grams, gp, contexts, cw, floor, 1.0, np.zeros(len(langs)), np.full(len(langs), np.inf))


_state: dict = {}


def entropies(texts: list[str], model: Model, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy (bits a character) of each text in each language, and the characters predicted."""
    if _state.get("key") != key:
        _state.update(key=key, index={}, logp=np.zeros((0, len(model.langs))), n=np.zeros(0))
    index = _state["index"]
    tokens = [t.lower().split() for t in texts]
    words = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(tokens)))}
    new = [w for w in words if w not in index]
    if new:
        if len(index) + len(new) > CACHE:
            index.clear()
            _state.update(logp=np.zeros((0, len(model.langs))), n=np.zeros(0))
            new = list(words)
        flat, owner = runs_of(new)
        logp, n = np.zeros((len(new), len(model.langs))), np.zeros(len(new))
        scores = [model.words(flat[i:i + 4096]) for i in range(0, len(flat), 4096)]
        if scores:
            logp = _sums(owner, np.concatenate(scores), len(new))
            n = np.bincount(owner, weights=np.array([len(r) + 1 for r in flat]), minlength=len(new))
        base = len(index)
        index.update((w, base + i) for i, w in enumerate(new))
        _state.update(logp=np.concatenate([_state["logp"], logp]), n=np.concatenate([_state["n"], n]))
    rows = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
    logp, n = _state["logp"][rows], _state["n"][rows]
    sums, lengths = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts))
    for i, ts in enumerate(tokens):
        if ts:
            at = np.fromiter(map(words.__getitem__, ts), dtype=np.int64, count=len(ts))
            sums[i], lengths[i] = logp[at].sum(axis=0), n[at].sum()
    return -sums / np.maximum(lengths, 1)[:, None], lengths


def train(docs: DataFrame, **columns) -> Model:
    """A calibrated model; only its finished tables and the calibration texts' cross-entropies reach the driver."""
    labelled = saved(sample(docs, **columns))
    model = kneser_ney(count_grams(labelled.filter(~F.col("calibrate"))))
    if not model.langs:
        return model
    # whole texts, but only their cross-entropies leave the workers
    held = labelled.filter("calibrate").select("text", "lang")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            h, n = entropies([t.as_py() or "" for t in b.column(0)], m, "training")
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(h), pa.list_(pa.float64())), pa.array(n)], names=["lang", "h", "n"])

    rows = held.mapInArrow(run, "lang string, h array<double>, n double").toPandas()
    if not len(rows):
        return model
    return calibrated(model, np.stack(rows["h"].to_list()), rows["n"].to_numpy(), rows["lang"].tolist())


def calibrated(model: Model, h: np.ndarray, n: np.ndarray, langs: list[str]) -> Model:
    """Factor by log-loss over a grid; per language the usual cross-entropy and the limit above it."""
    code = {x: i for i, x in enumerate(model.langs)}
    use = np.array([x in code for x in langs], dtype=bool) & (n > 0)
    if not use.any():
        return model
    h, n, y = h[use], n[use], np.array([code[x] for x, u in zip(langs, use, strict=True) if u])
    best = (np.inf, 1.0)
    for factor in 2.0 ** np.arange(-4, 4.5, 0.5):
        z = -h * factor * np.sqrt(n)[:, None]
        z -= z.max(axis=1, keepdims=True)
        loss = -(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(axis=1))).clip(min=-30).mean()
        best = min(best, (loss, factor))
    model.factor = best[1]
    for i in range(len(model.langs)):
        own = y == i
        if own.any():
            e = h[own, i]
            model.usual[i] = np.median(e)
            # three times as far as the farthest calibration text; twelve bits at one character, at least
            model.limit[i] = max(12.0, 3.0 * ((e - model.usual[i]) * np.sqrt(np.minimum(n[own], 400))).max())
    return model


# ------------------------------------------------------------------ prediction
def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, accepted.

    ``lang_pred`` is ``und`` with score 0 for null texts and texts without
    letters (and for all if nothing was learned); they are not accepted.  Ties
    go to the first language by name.  Only the id (for held_out) and the text
    are read.  Rows that repeat are predicted each; an empty table gives no rows.
    """
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                pred, score, ok = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows), np.zeros(part.num_rows, dtype=bool)
                if m.langs:
                    h, n = entropies([t.as_py() or "" for t in part.column(1)], m, key)
                    best, s, accepted = m.decide(h, np.maximum(n, 1))
                    score, ok = np.where(n > 0, s, 0.0), (n > 0) & accepted
                    pred = [m.langs[k] if c else UNKNOWN for k, c in zip(best, n > 0, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([held_out(x) for x in part.column(0).to_pylist()]),
                                                  pa.array(pred, pa.string()), pa.array(score), pa.array(ok)],
                                                 names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, model: Model | None = None, text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` whose text the model accepts, all columns kept, in one pass without a shuffle."""
    model = model or train(docs, text_col=text_col, **columns)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    import uuid

    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                if not m.langs:
                    continue
                h, n = entropies([t.as_py() or "" for t in part.column(part.schema.get_field_index(text_col))], m, key)
                keep = m.decide(h, np.maximum(n, 1))[2] & (n > 0)
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
