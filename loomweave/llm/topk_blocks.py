"""Exact top-k by integer inner product: block-at-a-time pruning.

Components are terms, their integer values weights (a shorter vector has weight
0 in the terms it lacks).  Documents are put in an order in which near ones are
neighbours (a median tree fitted on a bounded sample steers the order, never
the result) and cut into ranges: leaves of the tree, parts of a leaf that one
task holds, and blocks of ``BLOCK`` documents.  A block keeps its forward index
(ids and whole weight rows) and, per term, the greatest and least weight.  For
a query, the sum over its terms of weight times the greatest (for a negative
weight: the least) is a bound on every score in the block.

A query takes the ranges in falling order of this sum and stops when the sum is
below its k-th score so far; a sum that equals it is still scored, as ties go
to smaller ids.  Leaves are taken in rounds of 1, 4, 16 ... ranks: a round's
visits are dealt to the tasks that hold the parts, each task goes through its
blocks in falling order of the bound, and the k-th score reached is known to
all tasks of the next round.  Where bounds do not part the ranges (vectors
without structure) every block is scored once: the result is exact either way.

Only the sample, the leaves' term bounds (``BOXES`` numbers at most) and the
leaves' sizes reach the driver.  A part that many queries visit is dealt out
once per ``CROWD`` visits; a leaf that holds many rows has many parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.llm.io import sampled, saved
from loomweave.llm.vectors import finite, matrix

BLOCK = 128
#: Weights (rows x components) of a part, and of a block.
PART = 1 << 20
BLOCK_WEIGHTS = 1 << 20
#: Visits of a part that one task takes.
CROWD = 4096
#: Rows that the tree is fitted on, levels of the tree, and numbers in the leaves' term bounds.
SAMPLE = 8192
LEVELS = 10
BOXES = 1 << 20
LONG = (-(1 << 63), (1 << 63) - 1)
_EXACT = float(1 << 53)


def weights(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as integral doubles; beyond the doubles the largest double."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(vectors * scale))


class Tree:
    """Median splits by the widest component of a bounded sample: 2^levels leaves, near vectors in near leaves."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels, self.width = levels, sample.shape[1]
        self.axis, self.cut = np.zeros((1 << levels) - 1, dtype=np.int64), np.zeros((1 << levels) - 1)
        at = np.zeros(len(sample), dtype=np.int64)
        for level in range(levels if self.width else 0):
            first = (1 << level) - 1
            for node in range(1 << level):
                own = sample[at == node]
                if len(own):
                    self.axis[first + node] = axis = int(own.var(axis=0).argmax())
                    self.cut[first + node] = np.median(own[:, axis])
            at = 2 * at + (sample[np.arange(len(sample)), self.axis[first + at]] > self.cut[first + at])

    def leaf(self, w: np.ndarray) -> np.ndarray:
        at = np.zeros(len(w), dtype=np.int64)
        for level in range(self.levels if self.width else 0):
            node = (1 << level) - 1 + at
            at = 2 * at + (w[np.arange(len(w)), self.axis[node]] > self.cut[node])
        return at


def order(w: np.ndarray, block: int) -> list[np.ndarray]:
    """Row numbers of consecutive ranges of at most ``block`` rows, near rows together.

    Rows are parted by the widest component, at its widest gap if that is a tenth of its
    spread and leaves an eighth of the rows on either side, else in the middle.
    """
    ranges, todo = [], [np.arange(len(w))]
    while todo:
        rows = todo.pop()
        n = len(rows)
        if n <= block:
            ranges.append(rows)
            continue
        cut = min(max(block, (n // block + 1) // 2 * block), n - 1)        # all ranges but the last are full
        if w.shape[1]:
            axis = int(w[rows].var(axis=0).argmax())
            rows = rows[np.argsort(w[rows, axis], kind="stable")]
            gaps, first = np.diff(w[rows, axis]), max(1, n // 8)
            widest = first - 1 + int(gaps[first - 1:n - first].argmax())
            if gaps[widest] > 0.1 * (w[rows[-1], axis] - w[rows[0], axis]):
                cut = widest + 1
        todo += [rows[cut:], rows[:cut]]
    return ranges


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The greatest inner product (query, range) that the term bounds allow, never too small."""
    width = min(q.shape[1], high.shape[1])
    q, high, low = q[:, :width], high[:, :width], low[:, :width]
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        size = np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T
        slack = np.where(size < _EXACT, 0.0, size * (width + 2) * 2.0 ** -51)
        return np.nan_to_num(out + slack, nan=np.inf, posinf=np.inf, neginf=np.inf)


def scores(q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Inner products of integral rows, exact; Python integers where doubles would round."""
    width = min(q.shape[1], w.shape[1])
    q, w = q[:, :width], w[:, :width]
    if not width or not len(q) or not len(w):
        return np.zeros((len(q), len(w)), dtype=np.int64)
    if float(np.abs(q).max()) * float(np.abs(w).max()) * width < _EXACT:
        return (q @ w.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(q) @ whole(w).T
    return np.clip(exact, *LONG).astype(np.int64)


def search(q: np.ndarray, own: np.ndarray, kth: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], high: np.ndarray,
           low: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """Per query the (-score, id) of its best in ``blocks`` that can be among its k, by block bounds in falling order.

    ``kth``: the k-th score that the query has already (-inf: fewer).
    """
    best: list[dict[int, int]] = [{} for _ in q]
    kth = kth.astype(np.float64)
    bound = bounds(q, high, low)
    turn = np.argsort(-bound, axis=1, kind="stable")
    lo, width = 0, 1
    while lo < len(blocks):
        now = turn[:, lo:lo + width]
        live = np.take_along_axis(bound, now, axis=1) >= kth[:, None]
        if not live.any():
            break       # later blocks have smaller sums
        for b in np.unique(now[live]):
            asks = np.flatnonzero((live & (now == b)).any(axis=1) & (bound[:, b] >= kth))
            ids, w = blocks[b]
            got = scores(q[asks], w)
            for i in np.flatnonzero(got.max(axis=1, initial=LONG[0]) >= kth[asks]):
                a, mine = asks[i], best[asks[i]]
                for j in np.flatnonzero((got[i] >= kth[a]) & (ids != own[a])):
                    if got[i, j] > mine.get(key := int(ids[j]), LONG[0] - 1):
                        mine[key] = int(got[i, j])
                if len(mine) >= k:
                    kept = sorted((-s, x) for x, s in mine.items())[:k]
                    best[a] = {x: -s for s, x in kept}
                    kth[a] = max(kth[a], float(-kept[-1][0]))
        lo, width = lo + width, 4 * width
    return [sorted((-s, x) for x, s in b.items()) for b in best]


def _packed(w: np.ndarray) -> tuple[str, bytes]:
    """Weights in the least type that holds them."""
    top = np.abs(w).max(initial=0.0)
    kind = "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "f8"
    return kind, w.astype(f"<{kind}").tobytes()


def _unpacked(ids: bytes, kind: str, data: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, dtype="<i8")
    return names, np.frombuffer(data, dtype=f"<{kind}").astype(np.float64).reshape(len(names), width)


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.table({name: pa.array(values, kind) for name, (values, kind) in columns.items()})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", emb_col: str = "embedding",
          part: int = PART, block: int = BLOCK, crowd: int = CROWD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of floor(scale * vector), ties to smaller ids.

    Candidates of a query are all rows of other ids.  Null vectors, vectors
    with a null or non-finite component and null ids take no part; an empty
    vector has score 0 with every other, and of vectors of different lengths
    the common components count.  Rows that repeat id and vector count once;
    where an id has several vectors, the best score of (query id, id) counts.
    A score beyond a long is given as the nearest long.  A query without
    candidates gives no rows, nor does an empty table.  Other columns are not
    read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(emb_col).cast("array<double>").alias("emb"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("id").isNotNull() & finite(F.col("emb")))
    base = saved(rows.groupBy("id", "emb").agg(F.max("asks").alias("asks")))
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    facts = base.agg(F.count(F.lit(1)), F.sum(F.size("emb")), F.max(F.size("emb")), F.min(F.size("emb"))).first()
    if not facts[0]:
        return spark.createDataFrame([], schema)
    total, elements, longest, even = facts[0], facts[1], facts[2], facts[2] == facts[3]
    levels = max(0, min(LEVELS, int(np.ceil(np.log2(max(1.0, elements / part)))), int(np.log2(max(1, BOXES // (2 * max(1, longest)))))))
    width = min(longest, BOXES // SAMPLE * 8)        # components that steer the order
    some = sampled(base.select(F.slice("emb", 1, max(1, width)).alias("emb"), "id"), F.xxhash64(F.lit(3), "id", "emb"), SAMPLE, total).select("emb").toArrow()
    tree = Tree(weights(matrix(some["emb"], width), scale), levels)
    shared = spark.sparkContext.broadcast(tree)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = shared.value.leaf(weights(matrix(b.column(1), shared.value.width), scale))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf)], names=["id", "emb", "leaf"])

    keyed = base.select("id", "emb").mapInArrow(leaves, "id bigint, emb array<double>, leaf bigint")
    sizes = {r[0]: r[1] for r in keyed.groupBy("leaf").agg(F.sum(F.size("emb") + 1)).collect()}      # a row a leaf
    salts = np.array([max(1, -(-sizes.get(x, 0) // part)) for x in range(1 << levels)], dtype=np.int64)
    of_leaf = F.element_at(F.array(*[F.lit(int(s)) for s in salts]), (F.col("leaf") + 1).cast("int"))
    dealt = keyed.withColumn("salt", F.pmod(F.xxhash64("id", "emb"), of_leaf))

    def index(table: pa.Table) -> pa.Table:
        """The blocks of one part, each with its forward index and term bounds."""
        n = table["emb"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        by_length = np.argsort(n, kind="stable")
        out = {"leaf": ([], pa.int64()), "salt": ([], pa.int64()), "ids": ([], pa.binary()), "width": ([], pa.int32()), "kind": ([], pa.string()),
               "data": ([], pa.binary()), "high": ([], pa.list_(pa.float64())), "low": ([], pa.list_(pa.float64()))}
        leaf, salt = table["leaf"][0].as_py(), table["salt"][0].as_py()
        lo = 0
        while lo < len(n):
            wide = int(n[by_length[lo]])
            hi = int(np.searchsorted(n[by_length], max(2 * wide, 64), side="right"))        # rows of about one length share blocks
            own = table.take(pa.array(by_length[lo:hi]))
            ids = own["id"].to_numpy()
            w = weights(matrix(own["emb"]), scale)
            for at in order(w, max(1, min(block, BLOCK_WEIGHTS // max(1, w.shape[1])))):
                kind, data = _packed(w[at])
                values = (leaf, salt, ids[at].astype("<i8").tobytes(), w.shape[1], kind, data, w[at].max(axis=0), w[at].min(axis=0))
                for (column, _), v in zip(out.values(), values, strict=True):
                    column.append(v)
            lo = hi
        return _rows(out)

    blocks = saved(dealt.groupBy("leaf", "salt").applyInArrow(
        index, "leaf bigint, salt bigint, ids binary, width int, kind string, data binary, high array<double>, low array<double>"))
    # term bounds of the leaves; where lengths differ, a missing weight is 0
    terms = blocks.select("leaf", F.posexplode(F.arrays_zip("high", "low")).alias("at", "x")).groupBy("leaf", "at").agg(
        F.max("x.high").alias("high"), F.min("x.low").alias("low"))
    high, low = np.zeros((1 << levels, longest)), np.zeros((1 << levels, longest))
    for r in terms.groupBy("leaf").agg(F.collect_list(F.struct("at", "high", "low")).alias("t")).toLocalIterator():
        for t in r["t"]:
            high[r["leaf"], t["at"]] = t["high"] if even else max(0.0, t["high"])
            low[r["leaf"], t["at"]] = t["low"] if even else min(0.0, t["low"])
    there = np.array([x in sizes for x in range(1 << levels)])
    boxes = spark.sparkContext.broadcast((high[there], low[there], np.flatnonzero(there), salts))

    asks = saved(base.filter("asks").select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("own"), "emb"))
    best = None
    lo, width = 0, 1
    while lo < int(there.sum()):
        kths = asks.withColumn("kth", F.lit(None).cast("double"))
        if best is not None:
            full = best.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).filter(F.col("n") == k)
            kths = asks.join(full.select("row", F.col("kth").cast("double").alias("kth")), "row", "left")

        def visit(batches: Iterator[pa.RecordBatch], lo=lo, hi=lo + width) -> Iterator[pa.RecordBatch]:
            high, low, names, salts = boxes.value
            for b in batches:
                for first in range(0, b.num_rows, 256):
                    some = b.slice(first, 256)
                    q = weights(matrix(some.column(2)), scale)
                    kth = np.nan_to_num(some.column(3).to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf)
                    bound = bounds(q, high, low)
                    turn = np.argsort(-bound, axis=1, kind="stable")[:, lo:hi]
                    ask, rank = np.nonzero(np.take_along_axis(bound, turn, axis=1) >= kth[:, None])
                    leaf = names[turn[ask, rank]]
                    times = salts[leaf]
                    ask, leaf = np.repeat(ask, times), np.repeat(leaf, times)
                    salt = np.arange(len(leaf)) - np.repeat(np.cumsum(times) - times, times)
                    pick = pa.array(ask)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(salt), some.column(0).take(pick), some.column(1).take(pick),
                                                      some.column(2).take(pick), pa.array(kth[ask])], names=["leaf", "salt", "row", "own", "emb", "kth"])

        visits = saved(kths.select("row", "own", "emb", "kth").mapInArrow(visit, "leaf bigint, salt bigint, row bigint, own bigint, emb array<double>, kth double"))
        if visits.isEmpty():
            break
        crowds = visits.groupBy("leaf", "salt").agg(F.ceil(F.count(F.lit(1)) / crowd).cast("int").alias("crowds"))
        left = blocks.join(crowds, ["leaf", "salt"]).withColumn("crowd", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1))).drop("crowds")
        right = visits.join(crowds, ["leaf", "salt"]).withColumn("crowd", F.pmod(F.xxhash64("row"), F.col("crowds")).cast("int")).drop("crowds")

        def score(held: pa.Table, asked: pa.Table) -> pa.Table:
            out = {"row": ([], pa.int64()), "vec_id": ([], pa.int64()), "score": ([], pa.int64())}
            if held.num_rows and asked.num_rows:
                parts = [_unpacked(*x) for x in zip(*(held[x].to_pylist() for x in ("ids", "kind", "data", "width")), strict=True)]
                longest = max(w.shape[1] for _, w in parts)
                high, low = matrix(held["high"], longest), matrix(held["low"], longest)
                found = search(weights(matrix(asked["emb"]), scale), asked["own"].to_numpy(), asked["kth"].to_numpy(), parts, high, low, k)
                for row, pairs in zip(asked["row"].to_pylist(), found, strict=True):
                    for s, x in pairs:
                        out["row"][0].append(row)
                        out["vec_id"][0].append(x)
                        out["score"][0].append(-s)
            return _rows(out)

        by = ["leaf", "salt", "crowd"]
        # new column identities: both sides come from the same rows
        left = left.select(*by, "ids", "width", "kind", "data", "high", "low").toDF(*by, "ids", "width", "kind", "data", "high", "low")
        right = right.select(*by, "row", "own", "emb", "kth").toDF(*by, "row", "own", "emb", "kth")
        found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(score, "row bigint, vec_id bigint, score bigint")
        if best is not None:
            found = found.unionByName(best)
        one = found.groupBy("row", "vec_id").agg(F.max("score").alias("score"))
        ranked = one.withColumn("r", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")))
        best = saved(ranked.filter(F.col("r") <= k).drop("r"))
        lo, width = lo + width, 4 * width
    if best is None:
        return spark.createDataFrame([], schema)
    named = best.join(asks.select("row", F.col("own").alias("query_id")), "row").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
