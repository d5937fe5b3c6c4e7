"""Approximate nearest neighbours: a hash-prefix forest.

Each tree hashes a vector to a long bit string (one random hyperplane per bit,
cut at the median of a bounded sample) and keeps its rows as sorted arrays of
these strings.  A query descends to its longest prefix matches and ascends in
all trees at once: the prefix length is shortened, the same in every tree,
until the matching rows of all trees together reach the candidate budget.
Candidates are verified by their exact cosine.

In Spark: a tree is cut into shards by the first bits; a shard larger than
``SHARD`` rows (a hot prefix) is split by hash.  Prefix lengths follow from a
table of row counts per (tree, level, prefix) over the first levels, so choosing them is a join and
a sum; where all of these leave more than the budget (a dense cluster), the descent goes on in
the shard's sorted strings, bit by bit to their end, while its share of the budget is met.  Queries then visit the shards below their prefix, and each visit gives
only its nearest few.  Equal vectors are indexed once with their smallest ids.

The budget is a share of the rows, calibrated on a bounded sample: the
least share that reaches ``RECALL`` against brute force there.  On vectors
without structure no prefix says much and the share is large; it is small
where neighbours are close.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.llm.io import sampled, saved

TREES = 8
BITS = 32
#: Rows of a shard, and queries visiting it, that one task holds.
SHARD = 16_384
#: Vectors that the hyperplanes' medians and the budget are fitted on; queries of the calibration.
SAMPLE = 8192
CALIBRATION_QUERIES = 256
RECALL = 0.95
#: Levels below the shards' own prefix that the count table has.
DEEPER = 8
SHARES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0, 1.4, 1.8, 2.2, 2.6, 3.0, 3.5, 4.0, 5.0, 6.0, 7.0)


def usable(emb: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not all zero."""
    ok = F.forall(emb, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return emb.isNotNull() & (F.size(emb) > 0) & ok & F.exists(emb, lambda x: x != 0)


class Forest:
    """Hyperplanes and medians of all trees; the same seed and sample give the same forest."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.trees, self.bits, self.dim = trees, bits, sample.shape[1]
        self.planes = rng.standard_normal((trees * bits, self.dim))
        self.cut = np.median(unit(sample) @ self.planes.T, axis=0) if len(sample) else np.zeros(trees * bits)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """The bit strings (row, tree) as integers, first bit highest."""
        up = (unit(vectors) @ self.planes.T > self.cut).reshape(len(vectors), self.trees, self.bits)
        return up @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _scaled(a: np.ndarray) -> np.ndarray:
    a = a.astype(np.float64)
    return np.ldexp(a, -np.frexp(np.abs(a).max(axis=1, keepdims=True))[1])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows in double precision, the same for a pair wherever it is computed.

    Rows are scaled by a power of two first, which changes no digit, so that squares stay within the doubles.
    """
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _descent(keys: np.ndarray, key: int, level: int, need: int) -> int:
    """The longest prefix length, ``level`` at least, at which ``need`` of the sorted ``keys`` match ``key``."""
    while level < BITS:
        low = key >> (BITS - level - 1)
        lo, hi = np.searchsorted(keys, [low << (BITS - level - 1), (low + 1) << (BITS - level - 1)])
        if hi - lo < max(need, 2):
            break
        level += 1
    return level


def budget_share(forest: Forest, sample: np.ndarray, k: int, recall: float = RECALL) -> float:
    """The least share of SHARES that reaches ``recall`` on the sample; all rows of all trees, else."""
    n = len(sample)
    if n <= 4 * k:
        return float(forest.trees)
    u, keys = unit(sample), forest.keys(sample)
    ask = np.arange(0, n, max(1, n // CALIBRATION_QUERIES))
    near = u[ask] @ u.T
    near[np.arange(len(ask)), ask] = -np.inf
    true = np.argpartition(-near, k, axis=1)[:, :k]
    common = np.full((len(ask), k, forest.trees), forest.bits)      # prefix lengths that a true neighbour shares
    counts = np.zeros((len(ask), forest.bits + 1))
    sorted_keys = np.sort(keys, axis=0)
    for t in range(forest.trees):
        diff = keys[ask, t][:, None] ^ keys[true, t]
        common[:, :, t] = forest.bits - np.ceil(np.log2(diff + 1)).astype(int)
        for level in range(forest.bits + 1):
            low = keys[ask, t] >> (forest.bits - level) << (forest.bits - level)
            counts[:, level] += np.searchsorted(sorted_keys[:, t], low + (1 << (forest.bits - level))) - np.searchsorted(sorted_keys[:, t], low)
    best = common.max(axis=2)
    for share in SHARES:
        enough = counts >= share * n
        level = np.where(enough.any(axis=1), forest.bits - np.argmax(enough[:, ::-1], axis=1), 0)
        if (best >= level[:, None]).mean() >= recall:
            return share
    return float(forest.trees)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", emb_col: str = "embedding",
            recall: float = RECALL, trees: int = TREES, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every query row by cosine, ties to smaller ids.

    Candidates are all rows but the query's own.  Unusable vectors, null ids
    and vectors of another length than most of the sample take no part, as
    query or candidate.  Rows that repeat an id: they count once if equal, else
    each is a candidate, and none is found for its own id.  Other columns
    are not read.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vid"), F.col(emb_col).cast("array<double>").alias("emb"), is_query.alias("asks"))
    rows = rows.filter(usable(F.col("emb")) & F.col("vid").isNotNull())
    # equal vectors: the k + 1 smallest ids are all that a result can name
    few = rows.select("vid", "emb").withColumn("r", F.row_number().over(Window.partitionBy("emb").orderBy("vid"))).filter(F.col("r") <= k + 1)
    base = saved(few.groupBy("emb").agg(F.array_sort(F.collect_set("vid")).alias("ids")))
    some = sampled(base.select("emb"), F.xxhash64(F.lit(5), "emb"), SAMPLE, base.count()).toPandas()["emb"]
    if not len(some):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = int(some.map(len).mode()[0])
    sample = np.stack([x for x in some if len(x) == dim])
    forest = Forest(sample, trees)
    base = base.filter(F.size("emb") == dim)
    asks = rows.filter(F.col("asks") & (F.size("emb") == dim))
    total = base.count()
    budget = budget_share(forest, sample, k, recall) * total
    s = max(0, int(np.ceil(np.log2(max(1, total / shard)))))
    deepest = min(BITS, s + DEEPER)

    def hashed(frames):
        for f in frames:
            if len(f):
                keys = forest.keys(np.stack(f["emb"]))
                yield pd.DataFrame({"id": f["id"], "key": list(keys)})

    def keyed(df: DataFrame) -> DataFrame:
        """id, tree, key: each tree's whole string."""
        return df.mapInPandas(hashed, "id bigint, key array<bigint>").select("id", F.posexplode("key").alias("tree", "key"))

    def prefix(key: Column, level) -> Column:
        return F.floor(key / F.pow(F.lit(2.0), F.lit(BITS) - level)).cast("bigint")

    index = saved(keyed(base.select(F.col("ids")[0].alias("id"), "emb")))
    distinct = saved(asks.groupBy("emb").agg(F.min("vid").alias("id")))
    wants = saved(keyed(distinct))

    # counts per (tree, level, prefix): the finest level first, the others from it
    finest = index.groupBy("tree", (prefix(F.col("key"), F.lit(deepest)) * (1 << (BITS - deepest))).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("level")
    sums = saved(finest.select("tree", "key", "n", levels).groupBy("tree", "level", prefix(F.col("key"), F.col("level")).alias("p")).agg(F.sum("n").alias("n")))
    # the ascent: the longest prefix length at which all trees together hold the budget
    asked = wants.select("id", "tree", "key", levels).select("id", "tree", "level", prefix(F.col("key"), F.col("level")).alias("p"))
    level = (asked.join(sums, ["tree", "level", "p"], "left").groupBy("id", "level").agg(F.sum("n").alias("n"))
             .groupBy("id").agg(F.coalesce(F.max(F.when(F.col("n") >= budget, F.col("level"))), F.lit(0)).alias("level")))

    # visits: the shards below the prefix
    width = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.lit(s) - F.col("level"))).cast("bigint")
    first = F.when(F.col("level") >= s, prefix(F.col("key"), F.lit(s))).otherwise(prefix(F.col("key"), F.col("level")) * width)
    visits = wants.join(level, "id").select("id", "tree", "level", "key", prefix(F.col("key"), F.col("level")).alias("p"),
                                            F.explode(F.sequence(first, first + width - 1)).alias("shard"))
    sizes = sums.filter(F.col("level") == s).select("tree", F.col("p").alias("shard"), F.ceil(F.col("n") / shard).cast("int").alias("salts"))
    crowd = visits.groupBy("tree", "shard").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("crowds"))
    deal = saved(sizes.join(crowd, ["tree", "shard"]))
    rows_in = (index.withColumn("shard", prefix(F.col("key"), F.lit(s))).join(deal, ["tree", "shard"])
               .join(base.select(F.col("ids")[0].alias("id"), "emb", "ids"), "id")
               .withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
               .withColumn("crowd", F.explode(F.sequence(F.lit(0), F.col("crowds") - 1))))
    asks_in = (visits.join(deal, ["tree", "shard"]).join(distinct, "id")
               .withColumn("need", F.ceil(F.lit(float(budget)) / (trees * F.col("salts"))))
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
               .withColumn("crowd", F.pmod(F.xxhash64("id"), F.col("crowds")).cast("int")))
    by = ["tree", "shard", "salt", "crowd"]

    def verify(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = {"qid": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            left = left.sort_values("key", kind="stable")
            keys, emb = left["key"].to_numpy(), np.stack(left["emb"])
            near, ids = unit(emb), left["ids"].to_numpy()
            deep = right["level"] == deepest
            if deep.any():
                at = [_descent(keys, key, deepest, int(need)) for key, need in zip(right.loc[deep, "key"], right.loc[deep, "need"], strict=True)]
                right = right.copy()
                right.loc[deep, "level"] = at
                right.loc[deep, "p"] = [key >> (BITS - x) for key, x in zip(right.loc[deep, "key"], at, strict=True)]
            for (at, p), group in right.groupby(["level", "p"], sort=False):
                lo, hi = np.searchsorted(keys, [p << (BITS - at), (p + 1) << (BITS - at)])
                if lo == hi:
                    continue
                for i in range(0, len(group), 256):
                    part = group.iloc[i:i + 256]
                    q = np.stack(part["emb"])
                    score = unit(q) @ near[lo:hi].T
                    few = min(k + 2, hi - lo)
                    top = np.argpartition(-score, few - 1, axis=1)[:, :few] + lo
                    # whatever ties with the last of them comes along
                    for qid, vec, best, row in zip(part["id"], q, top, score, strict=True):
                        edge = row[best - lo].min() - 1e-12
                        best = np.flatnonzero(row >= edge) + lo if (row >= edge).sum() > len(best) else best
                        exact = cosine(emb[best], np.broadcast_to(vec, (len(best), dim)))
                        pairs = sorted((-x, int(v)) for x, b in zip(exact, best, strict=True) for v in ids[b])[:k + 1]
                        out["qid"] += [qid] * len(pairs)
                        out["vec_id"] += [v for _, v in pairs]
                        out["score"] += [-x for x, _ in pairs]
        return pd.DataFrame(out).astype({"qid": "int64", "vec_id": "int64", "score": "float64"})

    def fresh(df: DataFrame, *names: str) -> DataFrame:
        return df.select(*names).toDF(*names)      # new column identities: both sides come from the same rows

    found = (fresh(rows_in, *by, "key", "emb", "ids").groupBy(*by)
             .cogroup(fresh(asks_in, *by, "id", "level", "p", "key", "need", "emb").groupBy(*by))
             .applyInPandas(verify, "qid bigint, vec_id bigint, score double"))
    best = found.groupBy("qid", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))).filter(F.col("r") <= k + 1).drop("r")
    query_ids = asks.select(F.col("vid").alias("query_id"), "emb").join(distinct.withColumnRenamed("id", "qid"), "emb").select("query_id", "qid").distinct()
    result = query_ids.join(best, "qid").filter("query_id <> vec_id")
    ranked = result.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
