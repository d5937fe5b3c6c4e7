"""SimHash near-dedup with a generalised pigeonhole index.

Fingerprints: whole text, A-Z lower-cased, words split at ASCII white space,
shingles of n words (repeats included) hashed with XXH64 (seed 42); a bit is 1
if set in over half of the hashes.

Links: two fingerprints at ``distance`` or fewer differing bits.  Copies share
a fingerprint, so only distinct fingerprints are indexed.  Bits are grouped so
that correlated ones lie in one part; part i gets a threshold T_i >= -1 with

    sum(T_i + 1) = distance + 1,

so any two linked fingerprints differ in at most T_i bits of some part i.  The
thresholds (and the number of parts) come from a dynamic programme over the
candidates that each part and threshold is estimated to give, counted on a
bounded sample; the sample only steers cost, every choice gives all links.

Probe and verify: a fingerprint is filed under its value in each part and, for
T_i >= 1, also looked up under every value within T_i bits.  Keys are dealt to
tasks by hash and read in sorted runs; a run is compared as a matrix and all
64 bits are verified.  A task gives the links of a run as a star to the least
member of each linked set, never as all pairs.  A key with more than ``BLOCK``
members is split: its members are cut into blocks by hash, and every pair of
blocks is a run of its own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomweave.llm import components
from loomweave.llm.io import OWN, rows_that_stay, sampled, saved

SEED = 42
BITS = 64
#: Most members of a run that one task compares as a matrix.
BLOCK = 512
#: Distinct fingerprints that steer the choice of parts and thresholds.
SAMPLE = 4096
#: Cost of filing or looking up one key, in candidate comparisons (a matrix cell).
PROBE_COST = 200.0


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: str | None, n: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text; 0 for no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= n:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    count, ones = len(words) - n + 1, np.zeros(BITS, dtype=np.int64)
    shingles = map(join, zip(*[itertools.islice(words, i, None) for i in range(n)], strict=False))
    while part := [digest(s, SEED) for s in itertools.islice(shingles, 1 << 15)]:
        ones += np.unpackbits(np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > count).astype(np.uint8), bitorder="little").view("<u8")[0])


def _text_key(text_col: str) -> Column:
    """SHA-256 of the text; empty for null."""
    return F.coalesce(F.unhex(F.sha2(F.col(text_col).cast("string").cast("binary"), 256)), F.lit(b""))


def fingerprints(docs: DataFrame, n: int = 3, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed bigint; ``keyed``: and the text's key), one row per input row; null text has no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), n) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *["key"] * keyed])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[_text_key(text_col).alias("key")] * keyed)
    return src.mapInArrow(run, "doc_id bigint, fp bigint" + ", key binary" * keyed)


# ------------------------------------------------------------------ parts and thresholds
def _bits(fps: np.ndarray) -> np.ndarray:
    return ((fps.astype(np.int64).view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)


def correlated_parts(bits: np.ndarray, m: int) -> list[list[int]]:
    """m parts of nearly equal width; each grows by the free bit most correlated with it."""
    if len(bits) < 2:
        corr = np.eye(BITS)
    else:
        centred = bits - bits.mean(axis=0)
        sd = np.sqrt((centred ** 2).mean(axis=0))
        sd[sd == 0] = 1.0
        corr = np.abs((centred / sd).T @ (centred / sd)) / len(bits)
    free, parts = set(range(BITS)), []
    for i in range(m):
        width = BITS // m + (i < BITS % m)
        first = max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())
        part = [first]
        free.remove(first)
        while len(part) < width:
            best = max(sorted(free), key=lambda b: corr[b, part].sum())
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def _values(fps: np.ndarray, part: list[int]) -> np.ndarray:
    v = np.zeros(len(fps), dtype=np.uint64)
    u = fps.astype(np.int64).view(np.uint64)
    for j, b in enumerate(part):
        v |= ((u >> np.uint64(b)) & np.uint64(1)) << np.uint64(j)
    return v


def _keys(width: int, t: int) -> int:
    """Values within t bits of a value."""
    total, term = 1, 1
    for k in range(1, t + 1):
        term = term * (width - k + 1) // k
        total += term
    return total


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds T_i >= -1 with sum(T_i + 1) = distance + 1 and the least sum of costs[i][T_i + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, picks) in best.items():
            for share, c in enumerate(row[: distance + 2 - used]):
                if used + share not in after or cost + c < after[used + share][0]:
                    after[used + share] = (cost + c, [*picks, share - 1])
        best = after
    return best[distance + 1]


def plan(sample: np.ndarray, total: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) per part, the cheapest over 1 <= m <= distance + 3 parts."""
    bits, best = _bits(sample), None
    scale = (total / max(1, len(sample))) ** 2
    pairs = max(1, len(sample) * (len(sample) - 1) / 2)
    for m in range(2, distance + 4):
        parts = correlated_parts(bits, m)
        costs = []
        for part in parts:
            near = np.zeros(len(part) + 1, dtype=np.int64)
            v = _values(sample, part)
            for i in range(0, len(v), 512):
                d = np.bitwise_count(v[i:i + 512, None] ^ v[None, :])
                near += np.bincount(d.ravel(), minlength=len(part) + 1)[: len(part) + 1]
            near[0] -= len(v)
            row = [0.0]
            for t in range(min(distance, 2) + 1):
                # half a pair is added: a sample that shows no pair does not prove there is none
                seen = near[: t + 1].sum() / 2 + 0.5 * min(1.0, _keys(len(part), t) * pairs / 2.0 ** len(part))
                row.append(seen * scale + PROBE_COST * total * _keys(len(part), t))
            costs.append(row + [float("inf")] * (distance + 2 - len(row)))
        cost, picks = allocate(costs, distance)
        if best is None or cost < best[0]:
            best = (cost, [(p, t) for p, t in zip(parts, picks, strict=True) if t >= 0])
    return best[1]


# ------------------------------------------------------------------ probe and verify
def _masks(part: list[int], t: int) -> np.ndarray:
    out = [0]
    for k in range(1, t + 1):
        out += [sum(1 << b for b in c) for c in itertools.combinations(range(len(part)), k)]
    return np.array(out, dtype=np.uint64)


def keys(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """part, key, fp, home: where a fingerprint is filed (home) and where it is looked up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fp), 4096):
                f = fp[lo:lo + 4096]
                for i, (part, t) in enumerate(parts):
                    masks = _masks(part, t)
                    key = (_values(f, part)[:, None] ^ masks[None, :]).ravel()
                    home = np.tile(np.arange(len(masks)) == 0, len(f))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), i, dtype=np.int32)), pa.array(key.view(np.int64)),
                                                      pa.array(np.repeat(f, len(masks))), pa.array(home)], names=["part", "key", "fp", "home"])

    return fps.select("fp").mapInArrow(run, "part int, key bigint, fp bigint, home boolean")


def _star(fp: np.ndarray, home: np.ndarray, block: np.ndarray, cross: bool, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one run: each member with the least member of its linked set (all 64 bits verified)."""
    u = fp.view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= distance
    near &= home[:, None] | home[None, :]
    if cross:
        near &= block[:, None] != block[None, :]
    np.fill_diagonal(near, True)
    busy = near.sum(axis=1) > 1
    if not busy.any():
        return fp[:0], fp[:0]
    near, fp = near[np.ix_(busy, busy)], fp[busy]
    label = np.arange(len(fp))
    while True:
        low = np.where(near, label[None, :], len(fp)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    off = label != np.arange(len(fp))
    return fp[off], fp[label[off]]


def links(fps: DataFrame, distance: int = 3, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(u, v) links that connect exactly the distinct fingerprints ``fps`` (column fp) within ``distance`` bits."""
    total = fps.count()
    some = sampled(fps, F.xxhash64(F.lit(7), "fp"), sample, total).toPandas()["fp"].to_numpy(dtype=np.int64)
    filed = keys(fps, plan(some, total, distance))
    filed_under = filed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = filed_under.filter(F.col("n") > block).select(F.col("part").alias("p"), F.col("key").alias("k"),
                                                  F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(11), "fp"), F.col("blocks")).cast("int")
    dealt = (filed.join(hot, (F.col("part") == F.col("p")) & (F.col("key") == F.col("k")), "left").drop("p", "k")
             .withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("part", "key", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), "own", "fp", "home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        names = ["part", "key", "b1", "b2", "own", "fp", "home"]

        def runs(cols: dict[str, np.ndarray], upto: int) -> pa.RecordBatch:
            us, vs = [fp0], [fp0]
            k = [cols[x][:upto] for x in names[:4]]
            new = np.ones(upto, dtype=bool)
            if upto:
                new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in k])
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], upto)
            for a, z in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
                u, v = _star(cols["fp"][a:z], cols["home"][a:z], cols["own"][a:z], bool(cols["b1"][a] != cols["b2"][a]), distance)
                us.append(u)
                vs.append(v)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

        fp0 = np.empty(0, dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            cols = {x: b.column(i).to_numpy(zero_copy_only=False) for i, x in enumerate(names)}
            if held is not None:
                cols = {x: np.concatenate([held[x], cols[x]]) for x in names}
            last = np.logical_and.reduce([cols[x] == cols[x][-1] for x in names[:4]])
            upto = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
            yield runs(cols, upto)
            held = {x: cols[x][upto:] for x in names}
        if held is not None:
            yield runs(held, len(held["fp"]))

    run_keys = ["part", "key", "b1", "b2"]
    return dealt.repartition(*run_keys).sortWithinPartitions(*run_keys).mapInArrow(run, "u bigint, v bigint").distinct()


def _labelled(fps: DataFrame, distance: int, block: int) -> DataFrame:
    """fp, low, label: each fingerprint with its smallest id and its component."""
    nodes = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    near = components.labels(links(nodes.select("fp"), distance, block))
    labelled = nodes.join(near, nodes["fp"] == near["node"], "left").select("fp", "low", F.coalesce("label", "fp").alias("label"))
    return saved(labelled)


def near_groups(docs: DataFrame, n: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text",
                block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, fp, component_id.

    ``component_id`` is the smallest id reachable over fingerprint links (null
    ids are ignored unless all are null).  Null, empty and blank texts have
    fingerprint 0 and are linked like any other.  Rows that repeat stay, each
    with the same component.  Other columns are not read.  An empty table gives
    no rows.
    """
    fps = saved(fingerprints(docs, n, id_col, text_col))
    labelled = _labelled(fps, distance, block)
    least = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    comp = labelled.join(least, "label").select(F.col("fp").alias(f"{OWN}fp"), "component_id")
    return fps.join(comp, F.col("fp") == F.col(f"{OWN}fp")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, n: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns kept; rows with a null id stay.

    It is the row of the component's smallest id; if that id has several texts
    in the component, the one whose SHA-256 is least.  An id that other
    components hold too stays once in each of them whose row it is.  Of rows
    equal in id and text one stays.
    """
    fps = saved(fingerprints(docs, n, id_col, text_col, keyed=True))
    label = _labelled(fps, distance, BLOCK).select(F.col("fp").alias(f"{OWN}fp"), "label")
    first = fps.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min(F.struct("doc_id", "key")).alias("row"))
    first = first.join(label, F.col("fp") == F.col(f"{OWN}fp")).groupBy("label").agg(F.min("row").alias("row"))
    stay = first.select(F.col("row.doc_id").alias(f"{OWN}i"), F.col("row.key").alias(f"{OWN}k"), F.lit(True).alias("stays"))
    every = fps.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id"), "key").agg(F.count(F.lit(1)).alias("n"))
    keys = every.join(stay, (F.col("id") == F.col(f"{OWN}i")) & (F.col("key") == F.col(f"{OWN}k")), "left").select(
        "id", "key", "n", F.coalesce("stays", F.lit(False)).alias("stays"))
    return rows_that_stay(docs, saved(keys), F.col(id_col).cast("bigint"), _text_key(text_col))
