"""Whitening by QDWH spectral divide and conquer.

The covariance is exact: vectors become integers floor(64 * c) + 1,000,000,
sums and products are added as integers around the integer pivot nearest to
each mean (centred before multiplying), and the remaining fraction of the mean
is taken off exactly.  Only these sums, whose number depends on the dimensions
alone, reach the driver.

Components come from polar decompositions: the orthogonal polar factor of
V - s*I, found by the dynamically weighted Halley iteration (QR form while its
weight is large, Cholesky form after), is +1 on the eigenvectors above s and -1
below, so (U + I) / 2 projects on an invariant subspace.  An orthonormal basis
of it and of its complement splits V into two smaller matrices, which are split
again until they are single numbers.

The component table (components x dimensions) is broadcast; every task whitens
its rows, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomweave.llm.vectors import finite, matrix

COMPONENTS = 32
SCALE, SHIFT = 64.0, 1_000_000
#: Integers are held within this distance of the shift, so that sums of squares of 10^8 rows and more stay exact.
FAR = 10 ** 15
#: Dimensions for which the driver holds and splits a covariance.
MOST_DIMENSIONS = 4096
EPS = float(np.finfo(np.float64).eps)
_EXACT = 1 << 53


# ------------------------------------------------------------------ spectral divide and conquer
def polar(a: np.ndarray, rounds: int = 12) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by the QDWH iteration."""
    n = len(a)
    x = a / max(float(np.linalg.norm(a)), 1e-300)
    r = np.linalg.qr(x, mode="r")
    small = float(np.abs(np.diag(r)).min())
    low = 1e-16
    if small > 1e-14:       # a lower bound of the least singular value
        low = min(0.9, max(low, 0.5 / float(np.linalg.norm(np.linalg.inv(r)))))
    eye = np.eye(n)
    for _ in range(rounds):
        l2 = low * low
        g = (4 * (1 - l2) / (l2 * l2)) ** (1 / 3)
        h = math.sqrt(1 + g) + 0.5 * math.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - l2) / (l2 * math.sqrt(1 + g))))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([math.sqrt(c) * x, eye]))[0]
            new = b / c * x + (h - b / c) / math.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            w = np.linalg.cholesky(eye + c * (x.T @ x))
            new = b / c * x + (h - b / c) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * l2) / (1 + c * l2))
        moved, x = float(np.linalg.norm(new - x)), new
        if moved < EPS ** (1 / 3) and 1 - low < 10 * EPS:
            break
    return x


def split(a: np.ndarray, s: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below ``s``; none if s does not part the spectrum cleanly."""
    n = len(a)
    p = (polar(a - s * np.eye(n)) + np.eye(n)) / 2
    r = int(round(float(np.trace(p))))
    if not 0 < r < n or float(np.linalg.norm(p @ p - p)) > 1e-8 * n:
        return None
    q = np.linalg.qr(p @ rng.standard_normal((n, r)), mode="complete")[0]
    q = np.linalg.qr(p @ q[:, :r], mode="complete")[0]      # once more: the first basis may be badly conditioned
    up, down = q[:, :r], q[:, r:]
    return (up, down) if float(np.linalg.norm(up.T @ a @ down)) <= 1e-10 * float(np.linalg.norm(a)) else None


def spectral(v: np.ndarray, seed: int = 29) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric matrix, by recursive splits."""
    rng = np.random.default_rng(seed)
    whole = max(float(np.linalg.norm(v)), 1e-300)

    def divide(a: np.ndarray) -> np.ndarray:
        n = len(a)
        off = a - np.diag(np.diag(a))
        if n <= 1 or float(np.linalg.norm(off)) <= EPS * whole / 8:
            return np.eye(n)
        diagonal = np.diag(a)
        tries = [float(np.median(diagonal)), float(diagonal.mean())]
        # by Gershgorin no eigenvalue lies outside; a random place inside parts any two that differ, sooner or later
        reach = np.abs(off).sum(axis=1)
        lo, hi = float((diagonal - reach).min()), float((diagonal + reach).max())
        tries += [float(x) for x in rng.uniform(lo, hi, 30)]
        for s in tries:
            parts = split(a, s, rng)
            if parts:
                out = []
                for q in parts:
                    small = q.T @ a @ q
                    out.append(q @ divide((small + small.T) / 2))
                return np.hstack(out)
        if float(np.linalg.norm(off)) <= 1e-10 * whole:      # equal eigenvalues: any basis does
            return np.eye(n)
        raise ArithmeticError("the spectrum cannot be split")

    q = divide((v + v.T) / 2) if len(v) else np.zeros((0, 0))
    if len(v):
        for _ in range(2):
            q = q @ (3 * np.eye(len(q)) - q.T @ q) / 2       # back to orthonormal columns, to rounding
    e = np.einsum("ij,ij->j", q, v @ q) if len(v) else np.zeros(0)
    turn = np.argsort(-e, kind="stable")
    return e[turn], q[:, turn]


# ------------------------------------------------------------------ exact sums
def integers(vectors: np.ndarray, scale: float, shift: int) -> np.ndarray:
    """floor(scale * c) + shift as long; values beyond ``FAR`` are held there."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * vectors), -FAR, FAR).astype(np.int64) + shift


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y.T @ y as Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top >= _EXACT:
        whole = y.astype(object)
        return whole.T @ whole
    step = max(1, (_EXACT - 1) // max(1, top * top))
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for i in range(0, len(y), step):
        block = y[i:i + step].astype(np.float64)
        out += (block.T @ block).astype(np.int64).astype(object)
    return out


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(x)) for x in values], pa.decimal128(38, 0))


def _added(rows: DataFrame, keys: list[str]) -> list:
    return rows.groupBy(*keys).agg(F.sum("x").cast("decimal(38,0)").alias("x")).collect()


def _kept(vectors: DataFrame, emb_col: str) -> tuple[Column, Column, int, int]:
    """The column, the rule of rows that take part, their length and number."""
    emb = F.col(emb_col).cast("array<double>")
    counts = vectors.filter(finite(emb)).groupBy(F.size(emb).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = counts.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d, n = (most[0]["d"], most[0]["n"]) if most else (0, 0)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} components; a covariance of {MOST_DIMENSIONS} at most is split")
    return emb, finite(emb) & (F.size(emb) == d), d, n


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", emb_col: str = "embedding",
           scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per kept vector and component.

    Null vectors and vectors with a null or non-finite component take no part,
    nor do vectors of another length than the most frequent one (ties: the
    longer).  Integers are held within 10^15 of the shift.  ``deviation`` is
    null where it does not fit a long.  Rows that repeat or have a null id are
    kept each.  A component whose variance is zero to rounding (equal vectors,
    fewer rows than dimensions) has whitened 0 and is left out of
    ``identity_error``.  ``explained`` is 0 if nothing varies.  Other columns
    are not read.  An empty table, or one of empty vectors, gives no rows.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    emb, part, d, n = _kept(vectors, emb_col)
    if not n or not d:
        return spark.createDataFrame([], schema)
    rows = vectors.filter(part).select(F.col(id_col).cast("bigint").alias("id"), emb.alias("emb"))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.zeros(d, dtype=object)
        for b in batches:
            x = integers(matrix(b.column(0), d), scale, shift)
            step = max(1, ((1 << 62) // max(1, int(np.abs(x).max(initial=0)))))
            for i in range(0, len(x), step):
                s += x[i:i + step].sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), _decimals(s)], names=["i", "x"])

    sums = [0] * d
    for r in _added(rows.select("emb").mapInArrow(totals, "i int, x decimal(38,0)"), ["i"]):
        sums[r["i"]] = int(r["x"])
    pivot = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    rest = [s - n * int(p) for s, p in zip(sums, pivot, strict=True)]        # n times the mean around the pivot
    upper = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((d, d), dtype=object)
        for b in batches:
            g += exact_gram(integers(matrix(b.column(0), d), scale, shift) - pivot)
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), _decimals(g[upper])], names=["i", "j", "x"])

    v = np.zeros((d, d))
    for r in _added(rows.select("emb").mapInArrow(products, "i int, j int, x decimal(38,0)"), ["i", "j"]):
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = float(Fraction(n * int(r["x"]) - rest[i] * rest[j], n * n))
    values, vecs = spectral(v)
    trace = float(np.trace(v))
    k = min(components, d)
    real = values[:k] > max(0.0, float(values[0])) * d * EPS * 8
    weight = np.where(real, 1 / np.sqrt(np.where(real, values[:k], 1.0)), 0.0)
    table = (vecs[:, :k] * weight).T                                        # component, dimension
    mean = np.array([r / n for r in rest])
    shared = spark.sparkContext.broadcast((table, pivot, mean, np.array(rest, dtype=object)))

    def projected(y: np.ndarray) -> np.ndarray:
        table, _, mean, _ = shared.value
        return (y - mean) @ table.T

    above = np.triu_indices(k)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of products, and in row -1 the sums, of this task's whitened rows."""
        z1, z2 = np.zeros(k), np.zeros((k, k))
        for b in batches:
            z = projected(integers(matrix(b.column(0), d), scale, shift) - shared.value[1])
            z1 += z.sum(axis=0)
            z2 += z.T @ z
        i, j = np.concatenate([above[0], np.full(k, -1)]), np.concatenate([above[1], np.arange(k)])
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(np.concatenate([z2[above], z1]))], names=["i", "j", "x"])

    z1, z2 = np.zeros(k), np.zeros((k, k))
    for r in rows.select("emb").mapInArrow(spread, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        if r["i"] < 0:
            z1[r["j"]] = r["x"]
        else:
            z2[r["i"], r["j"]] = z2[r["j"], r["i"]] = r["x"]
    off = np.abs(z2 / n - np.outer(z1 / n, z1 / n) - np.eye(k))[np.ix_(real, real)]
    identity_error = float(off.max(initial=0.0))
    explained = np.where(trace > 0, values[:k] / (trace or 1.0), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, pivot, _, rest = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                some = b.slice(lo, 1024)
                y = integers(matrix(some.column(1), d), scale, shift) - pivot
                m = len(y)
                yield pa.RecordBatch.from_arrays([
                    some.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)), deviations(y, n, rest).take(pa.array(np.repeat(np.arange(m), k))), pa.array(projected(y).ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)


def deviations(y: np.ndarray, n: int, rest: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n * y - rest)^2, exact; null beyond a long."""
    far = n * int(np.abs(y).max(initial=0)) + max((abs(int(r)) for r in rest), default=0)
    if far * far * max(1, y.shape[1]) < 1 << 63:
        e = n * y - rest.astype(np.int64)
        return pa.array((e * e).sum(axis=1))
    e = n * y.astype(object) - rest
    return pa.array([int(x) if x < 1 << 63 else None for x in (e * e).sum(axis=1)], pa.int64())
