"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

Tokenize: whole texts become ids, an end id is added, and only documents
longer than a sequence are cut into full pieces and a last shorter one.

Pack: pieces are dealt into blocks of about ``BLOCK`` pieces by hash, so no
task holds more than a block, however the rows are distributed.  Every block
is evolved on several islands.  An individual is a list of bins; crossover
copies whole well-filled bins of one parent into the other, removes the bins
that hold the same pieces (the duplicates), and best-fits the pieces that are
displaced, longest first.  After an epoch each island's best individual
migrates to the next island; the best individual of a block's islands wins.

Bins that stay badly filled are broken up and their pieces packed again in
blocks of their own until one block is left or nothing is gained, so blocks
cost no more than their part of one last bin.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.llm.io import OWN, saved
from loomweave.llm.word_ids import encoder

CAPACITY = 2048
END_ID = 0
BLOCK = 4096
ISLANDS = 3
EPOCHS = 2
POPULATION = 5
CROSSOVERS = 10
#: Bytes of the texts that are encoded together.
RUN = 8_000_000
#: Bins filled to less than this share are broken up between rounds.
WELL_FILLED = 0.995

PIECES = "item bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# ------------------------------------------------------------------ tokenize
def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of, but for the last text, ``RUN`` bytes of text at most."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64))
    turn = np.r_[-1, 0, size[:-1] // RUN, -1] if len(size) else np.empty(0)
    bounds = np.flatnonzero(turn[1:] != turn[:-1])
    for lo, hi in itertools.pairwise(bounds.tolist()):
        yield batch.slice(lo, hi - lo)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``item`` numbers the pieces of a run (task and place in it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, end = encoder(path), array("I", [END_ID]).tobytes()
        item = TaskContext.get().partitionId() << 40
        for b in batches:
            for part in _runs(b):
                rows = []
                for doc, own in zip(part.column(0).to_pylist(), enc.encode_all(pc.fill_null(part.column(1), "")), strict=True):
                    ids = memoryview(own + end)
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append((item, doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                        item += 1
                cols = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                                                 names=["item", "doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, PIECES)


# ------------------------------------------------------------------ one block
class _Open:
    """Open bins by free space; the tightest fit is found in a bit set of the free spaces in use."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.by_room = capacity, 0, {}

    def add(self, members: list[int], room: int) -> None:
        if room:
            self.by_room.setdefault(room, []).append(members)
            self.mask |= 1 << room

    def best_fit(self, item: int, size: int, bins: list) -> None:
        above = self.mask >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            stack = self.by_room[room]
            members = stack.pop()
            if not stack:
                self.mask &= ~(1 << room)
            members.append(item)
            self.add(members, room - size)
        else:
            members = [item]
            bins.append(members)
            self.add(members, self.capacity - size)


def best_fit(items, sizes: list[int], capacity: int, bins: list[list[int]]) -> list[list[int]]:
    """``bins`` with ``items`` added in the given order, each to the bin it fills best."""
    out = [list(b) for b in bins]
    rooms = _Open(capacity)
    for b in out:
        rooms.add(b, capacity - sum([sizes[i] for i in b]))
    for i in items:
        rooms.best_fit(i, sizes[i], out)
    return out


def fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> float:
    """Mean squared fill: fewer bins, and fuller ones for the same number."""
    return sum((sum([sizes[i] for i in b]) / capacity) ** 2 for b in bins) / len(bins)


def crossover(giver: list[list[int]], taker: list[list[int]], sizes: list[int], capacity: int, rng) -> list[list[int]]:
    """Whole well-filled bins of ``giver`` injected into ``taker``.

    Bins of the taker that hold an injected item go; their other items are
    displaced and best-fitted, longest first.
    """
    fill = [sum([sizes[i] for i in b]) for b in giver]
    ranked = sorted(range(len(giver)), key=lambda k: -fill[k])
    top = ranked[: max(1, len(ranked) // 2)]
    n = max(1, int(len(top) * rng.uniform(0.2, 0.8)))
    injected = [giver[top[k]] for k in rng.choice(len(top), size=n, replace=False)]
    inside = {i for b in injected for i in b}
    keep, displaced = [], []
    for b in taker:
        if inside.isdisjoint(b):
            keep.append(b)
        else:
            displaced.extend(i for i in b if i not in inside)
    # the worst bins of what is kept are opened too, or a good taker could only be repeated
    if len(keep) > 4:
        keep.sort(key=lambda b: sum([sizes[i] for i in b]))
        weak = max(1, len(keep) // 50)
        displaced.extend(i for b in keep[:weak] for i in b)
        keep = keep[weak:]
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, capacity, [*injected, *keep])


def evolve(sizes: list[int], capacity: int, seed: int, guests: list[list[list[int]]], population: int = POPULATION,
           crossovers: int = CROSSOVERS) -> list[list[int]]:
    """The best individual of one island after one epoch; ``guests`` are migrated elites."""
    rng = np.random.default_rng(seed)
    down = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    bound = -(-sum(sizes) // capacity)
    pool = [*guests]
    if not pool:
        pool.append(best_fit(down, sizes, capacity, []))
    while len(pool) < population and len(pool[0]) > bound:
        jitter = rng.uniform(0.6, 1.4, size=len(sizes))
        pool.append(best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i] * jitter[i]), sizes, capacity, []))
    scored = sorted(((fitness(p, sizes, capacity), k, p) for k, p in enumerate(pool)), key=lambda s: (-s[0], s[1]))
    made = len(scored)
    for _ in range(crossovers):
        if len(scored) < 2 or len(scored[0][2]) <= bound:
            break
        a, b = rng.choice(len(scored), size=2, replace=False)
        child = crossover(scored[a][2], scored[b][2], sizes, capacity, rng)
        made += 1
        scored.append((fitness(child, sizes, capacity), made, child))
        scored = sorted(scored, key=lambda s: (-s[0], s[1]))[:population]
    return scored[0][2]


# ------------------------------------------------------------------ blocks, islands, rounds
def _flat(bins: list[list[int]], n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _bins(flat) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(max(flat) + 1)] if len(flat) else []
    for i, k in enumerate(flat):
        out[k].append(i)
    return out


def pack_round(items: DataFrame, blocks: int, turn: int, capacity: int = CAPACITY) -> DataFrame:
    """item, length, seq, offset, used of ``items`` (item, length): every block packed by its islands."""
    block = F.pmod(F.xxhash64(F.lit(turn), "item"), F.lit(blocks))

    def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        return pd.DataFrame({"block": [key[0]], "items": [pdf["item"].to_numpy()], "sizes": [pdf["length"].to_numpy()]})

    shape = "block bigint, items array<bigint>, sizes array<bigint>"
    whole = items.withColumn("block", block).groupBy("block").applyInPandas(gather, shape)
    state = whole.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)]))).withColumn("elites", F.array().cast("array<array<int>>"))

    def epoch(number: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                best, fit = [], []
                for r in f.itertuples():
                    sizes = [int(x) for x in r.sizes]
                    seed = (int(r.block) * 1_000_003 + int(r.island) * 101 + number * 11 + turn) & 0x7FFFFFFF
                    bins = evolve(sizes, capacity, seed, [_bins(e) for e in r.elites])
                    best.append(_flat(bins, len(sizes)))
                    fit.append(fitness(bins, sizes, capacity))
                yield pd.DataFrame({"block": f["block"], "items": f["items"], "sizes": f["sizes"], "island": f["island"], "elite": best, "fit": fit})
        return run

    evolved = shape + ", island int, elite array<int>, fit double"
    for number in range(EPOCHS):
        done = state.repartition("block", "island").mapInPandas(epoch(number), evolved)
        if number + 1 < EPOCHS:
            # migration: an island goes on with its own best and that of the one before it
            ring = done.select("block", F.explode(F.array(F.struct(F.col("island").alias("to"), F.lit(0).alias("o")),
                                                          F.struct(((F.col("island") + 1) % ISLANDS).alias("to"), F.lit(1).alias("o")))).alias("m"),
                               "items", "sizes", "elite")
            state = (ring.groupBy("block", F.col("m.to").alias("island"))
                     .agg(F.first("items").alias("items"), F.first("sizes").alias("sizes"),
                          F.transform(F.sort_array(F.collect_list(F.struct(F.col("m.o").alias("o"), "elite"))), lambda x: x["elite"]).alias("elites"))
                     .select("block", "items", "sizes", "island", "elites"))
    won = done.groupBy("block").agg(F.max_by(F.struct("items", "sizes", "elite"), F.struct("fit", -F.col("island"))).alias("w"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                items, sizes, bins = np.asarray(r.items), np.asarray(r.sizes), np.asarray(r.elite)
                order = np.lexsort((items, bins))
                b, s, i = bins[order], sizes[order], items[order]
                ends = np.cumsum(s)
                first = np.r_[True, b[1:] != b[:-1]]
                base = (ends - s)[first]
                which = np.cumsum(first) - 1
                used = np.add.reduceat(s, np.flatnonzero(first))
                yield pd.DataFrame({"item": i, "length": s, "seq": i[first][which], "offset": ends - s - base[which], "used": used[which]})

    return won.select("block", "w.items", "w.sizes", "w.elite").mapInPandas(place, "item bigint, length bigint, seq bigint, offset bigint, used bigint")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: one piece of one id, the end id.  Rows that
    repeat are documents of their own.  Null ids are kept.  Other columns are
    not read.  An empty table gives no rows.  ``sequence_id`` is the least item
    number in the sequence; full pieces are sequences of their own.
    """
    cut = saved(pieces(docs, path, capacity, id_col, text_col))
    placed = [cut.filter(F.col("length") == capacity).select("item", F.col("item").alias("seq"), F.lit(0).cast("bigint").alias("offset"))]
    rest, turn = cut.filter(F.col("length") < capacity).select("item", "length"), 0
    n = rest.count()
    while n:
        blocks = max(1, -(-n // block))
        done = saved(pack_round(rest, blocks, turn, capacity))
        weak = F.col("used") < int(capacity * WELL_FILLED)
        left = done.filter(weak).select("item", "length")
        m = left.count()
        if blocks == 1 or m == 0 or m > 0.9 * n:
            placed.append(done.select("item", "seq", "offset"))
            break
        placed.append(done.filter(~weak).select("item", "seq", "offset"))
        rest, n, turn = left, m, turn + 1
    spots = placed[0]
    for p in placed[1:]:
        spots = spots.unionByName(p)
    spots = spots.withColumnRenamed("item", f"{OWN}item")
    return (cut.join(spots, F.col("item") == F.col(f"{OWN}item"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset"))
