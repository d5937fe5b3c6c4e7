"""Centroid clustering: dimension-sharded Lloyd.

Vectors are cut into column blocks (shards of ``COLUMNS`` components), each
kept as row blocks of ``ROWS`` vectors.  A round: tasks of one shard compute
the exact partial squared distances of a row block against that shard's slice
of the centroids; a reduction by key adds the shards' blocks and an argmin gives
the assignments (one number a row); these go back to the shards, where each shard
sums its own columns per cluster and updates its own slice.  No task ever holds
whole vectors.  (The reduction is a grouping by row block, as many rows a key as
there are shards; reduceByKey itself, measured, takes 20 ms a task and more.)

The slices are written once, dealt by (shard, row block), and stay where they
are: per round only distances (rows x clusters) and assignments move.  A round
depends on nothing but the slices and the last centroids, so a lost executor
costs no more than its part of one round.  Only centroids (clusters x
components) reach the driver.

All is integer arithmetic: long where squares and sums fit, else Python's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.llm.io import saved
from loomweave.llm.vectors import finite, matrix

COLUMNS = 16
ROWS = 4096
#: Components below this have squared distances of 2^20 components and sums of 2^36 rows within a long.
SMALL = 1 << 20
LONG_MAX = (1 << 63) - 1
#: Larger integers are summed in two parts, and held below the square of it over 10^5.
HALF = 10 ** 25


def integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): long, or Python integers if one is not small."""
    with np.errstate(over="ignore"):
        x = np.nan_to_num(np.floor(vectors * scale))
    if np.abs(x).max(initial=0.0) < SMALL:
        return x.astype(np.int64)
    return np.vectorize(int, otypes=[object])(np.clip(x, -1e45, 1e45))


def packed(x: np.ndarray) -> bytes:
    """Long blocks as bytes of the least type; blocks of Python integers as decimal text."""
    if x.dtype == object:
        return b"t" + ",".join(map(str, x.ravel())).encode()
    return (b"s" if np.abs(x).max(initial=0) < 1 << 15 else b"l") + x.astype("<i2" if np.abs(x).max(initial=0) < 1 << 15 else "<i8").tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    kind, body = data[:1], data[1:]
    if kind == b"t":
        return np.array([int(t) for t in body.decode().split(",")], dtype=object).reshape(n, -1)
    return np.frombuffer(body, dtype="<i2" if kind == b"s" else "<i8").astype(np.int64).reshape(n, -1)


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances (row, cluster) over these columns, exact."""
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def cluster_sums(x: np.ndarray, assigned: np.ndarray, k: int) -> np.ndarray:
    """Per cluster the column sums and, in a last column, the number of rows."""
    out = np.zeros((k, x.shape[1] + 1), dtype=x.dtype)
    for c in range(k):
        own = assigned == c
        out[c, :-1], out[c, -1] = x[own].sum(axis=0), int(own.sum())
    return out


def updated(slice_: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The shard's next slice: floor(sum / count), the old one where a cluster is empty."""
    out = slice_.astype(object)
    for c in range(len(out)):
        count = int(sums[c, -1])
        if count:
            out[c] = [int(s) // count for s in sums[c, :-1]]
    return out


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: float = 1024.0, salt: str = "3:",
             id_col: str = "vec_id", emb_col: str = "embedding", columns: int = COLUMNS, rows: int = ROWS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row per kept vector.

    Kept are vectors of exactly ``dimensions`` components, none null or
    non-finite.  Centroids start as the ``k`` vectors with the least sha256 of
    salt and id, in that order (equal hashes, that is repeated ids: by vector;
    null ids last); with fewer vectors there are fewer centroids.  Ties go to
    the smaller cluster; empty clusters keep their centroid.  Rows that repeat
    are kept each.  Integers are held within 10^45 of zero.  Distances and inertia beyond a long are given as the
    largest long.  Other columns are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    sc = spark.sparkContext
    emb = F.col(emb_col).cast("array<double>")
    kept = vectors.filter(finite(emb) & (F.size(emb) == dimensions)).select(F.col(id_col).cast("bigint").alias("id"), emb.alias("emb"))
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    hashed = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = kept.orderBy(hashed.asc_nulls_last(), "emb").limit(k).select("emb").collect()
    if not first:
        return spark.createDataFrame([], schema)
    start = integers(np.array([r["emb"] for r in first], dtype=np.float64).reshape(len(first), dimensions), scale).astype(object)
    k = len(first)
    cut = list(range(0, max(1, dimensions), columns))

    def cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Row blocks of a task, one row per shard; the ids stand in shard -1."""
        from pyspark import TaskContext

        at = 0
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                some = b.slice(lo, rows)
                name = (TaskContext.get().partitionId() << 33) + at
                at += 1
                x = integers(matrix(some.column(1), dimensions), scale)
                ids = some.column(0)
                sink = pa.BufferOutputStream()      # ids may be null
                with pa.ipc.new_stream(sink, pa.schema([("id", pa.int64())])) as out:
                    out.write_batch(pa.RecordBatch.from_arrays([ids], names=["id"]))
                shards = [(-1, sink.getvalue().to_pybytes()), *((s, packed(x[:, c:c + columns])) for s, c in enumerate(cut))]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(shards)), pa.array([s for s, _ in shards], pa.int32()),
                                                  pa.array([len(x)] * len(shards)), pa.array([v for _, v in shards], pa.binary())], names=["block", "shard", "n", "data"])

    # few, full row blocks from tables of many small files; written first, as the block names hang on the tasks that made them
    fewer = kept.coalesce(max(sc.defaultParallelism, -(-kept.count() // (16 * rows))))
    made = saved(fewer.mapInArrow(cuts, "block bigint, shard int, n bigint, data binary"))
    total = made.count()
    parts = max(1, min(total, max(sc.defaultParallelism, -(-total // 16))))
    # dealt once by (shard, row block); a round's groups and joins on these two columns move no slice
    slices = made.filter("shard >= 0").repartition(parts, "shard", "block").persist(StorageLevel.MEMORY_AND_DISK)
    slices.count()      # Spark knows how a cached table is dealt once it is there
    shards = range(len(cut))

    def added(centroids: list[np.ndarray], give, schema: str) -> DataFrame:
        """``give`` of the distances (row, centroid) of every row block: the shards' partial blocks, added by row block."""
        shared = sc.broadcast(centroids)

        def partial(table: pa.Table) -> pa.Table:
            out = []
            for shard, n, data in zip(*(table[c].to_pylist() for c in ("shard", "n", "data")), strict=True):
                x, c = unpacked(data, n), shared.value[shard]
                if x.dtype != object and np.abs(c).max(initial=0) < SMALL:
                    c = c.astype(np.int64)
                out.append(packed(partial_distances(x, c)))
            return pa.table({"block": table["block"], "n": table["n"], "data": pa.array(out, pa.binary())})

        def add(table: pa.Table) -> pa.Table:
            d = sum(unpacked(v, n) for v, n in zip(table["data"].to_pylist(), table["n"].to_pylist(), strict=True))
            return pa.table({"block": table["block"][:1], **give(d)})

        apart = slices.groupBy("shard", "block").applyInArrow(partial, "block bigint, n bigint, data binary")
        return apart.groupBy("block").applyInArrow(add, f"block bigint, {schema}")

    def assigned(d: np.ndarray) -> dict[str, pa.Array]:
        return {"at": pa.array([d.argmin(axis=1).astype("<i4").tobytes()], pa.binary())}

    def sums(held: pa.Table, given: pa.Table) -> pa.Table:
        """A shard's column sums and rows per cluster, one row per cluster and column; of large ones, the multiples of HALF as further columns."""
        out = {"shard": [], "cluster": [], "col": [], "x": []}
        for shard, n, data in zip(*(held[c].to_pylist() for c in ("shard", "n", "data")), strict=True):
            for c, row in enumerate(cluster_sums(unpacked(data, n), np.frombuffer(given["at"][0].as_py(), dtype="<i4"), k)):
                for part in (0, 1) if row.dtype == object else (0,):
                    out["shard"] += [shard] * len(row)
                    out["cluster"] += [c] * len(row)
                    out["col"] += range(part * len(row), (1 + part) * len(row))
                    out["x"] += [str(divmod(int(v), HALF)[1 - part] if row.dtype == object else int(v)) for v in row]
        return pa.table({"shard": pa.array(out["shard"], pa.int32()), "cluster": pa.array(out["cluster"], pa.int32()),
                         "col": pa.array(out["col"], pa.int32()), "x": pa.array(out["x"], pa.string())})

    def update(shared):
        def new_slice(table: pa.Table) -> pa.Table:
            shard = table["shard"][0].as_py()
            old = shared.value[shard]
            total, wide = np.zeros((len(old), old.shape[1] + 1), dtype=object), old.shape[1] + 1
            for c, j, x in zip(*(table[v].to_pylist() for v in ("cluster", "col", "x")), strict=True):
                total[c, j % wide] += int(x) * (HALF if j >= wide else 1)
            return pa.table({"shard": table["shard"][:1], "slice": pa.array([[str(int(v)) for v in updated(old, total).ravel()]])})

        return new_slice

    now = [start[:, c:c + columns] for c in cut]
    for _ in range(rounds):
        back = added(now, assigned, "at binary").withColumn("shard", F.explode(F.array(*[F.lit(s) for s in shards])))
        mine = (slices.groupBy("shard", "block").cogroup(back.groupBy("shard", "block"))
                .applyInArrow(sums, "shard int, cluster int, col int, x string"))
        whole = mine.groupBy("shard", "cluster", "col").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))

        new = {r["shard"]: np.array([int(v) for v in r["slice"]], dtype=object).reshape(k, -1)
               for r in whole.groupBy("shard").applyInArrow(update(sc.broadcast(now)), "shard int, slice array<string>").collect()}
        same = all((new[s] == now[s]).all() for s in shards)
        now = [new[s] for s in shards]
        if same:        # a fixed point: further rounds change nothing
            break

    def closest(d: np.ndarray) -> dict[str, pa.Array]:
        at = d.argmin(axis=1)
        near = [min(int(x), LONG_MAX) for x in d[np.arange(len(d)), at]]
        return {"cluster": pa.array([at.astype("<i4").tobytes()], pa.binary()), "distance": pa.array([np.array(near, dtype="<i8").tobytes()], pa.binary())}

    final = saved(added(now, closest, "cluster binary, distance binary"))
    slices.unpersist()

    def inertias(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [0] * k
        for b in batches:
            for c, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                at, near = np.frombuffer(c, dtype="<i4"), np.frombuffer(d, dtype="<i8").astype(object)
                for i in range(k):
                    out[i] += int(near[at == i].sum()) if (at == i).any() else 0
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array([str(x) for x in out])], names=["cluster", "x"])

    own = [0] * k
    for r in (final.select("cluster", "distance").mapInArrow(inertias, "cluster int, x string")
              .groupBy("cluster").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()):
        own[r["cluster"]] = int(r["x"])
    whole = min(sum(own), LONG_MAX)
    own = [min(x, LONG_MAX) for x in own]
    centroid = np.hstack(now)
    digest = [hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest() for row in centroid]

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, c, d in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                at = np.frombuffer(c, dtype="<i4")
                names = pa.ipc.open_stream(ids).read_all()["id"].combine_chunks()
                yield pa.RecordBatch.from_arrays([names, pa.array(at), pa.array(np.frombuffer(d, dtype="<i8")), pa.array(np.array(own, dtype=np.int64)[at]),
                                                  pa.array(np.full(len(at), whole)), pa.array([digest[i] for i in at], pa.string())],
                                                 names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    named = made.filter("shard = -1").select(F.col("block").alias("of"), F.col("data").alias("ids"))
    return final.join(named, F.col("block") == F.col("of")).select("ids", "cluster", "distance").mapInArrow(give, schema)
