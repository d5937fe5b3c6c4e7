"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.session import checkpoint_dir

#: Names of columns that the operators add; all start with this, so a column of the caller's table is not hit.
OWN = "_lw_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark from any file system that Spark knows."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, keep: bool = False) -> DataFrame:
    """Cut the lineage with one reliable checkpoint in the shared folder.

    The rows are persisted while the checkpoint is written, else Spark would
    compute the whole lineage twice.  With ``keep`` the caller unpersists.
    """
    checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.DISK_ONLY)
    out = held.checkpoint(eager=True)
    if not keep:
        held.unpersist()
    return out


def whole_text(name: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def sampled(df: DataFrame, key: Column, most: int, total: int) -> DataFrame:
    """At most ``most`` rows by the least hashes ``key``, the same on every run.

    A limit on the hash, from the row count, drops nearly all other rows in their own
    task, so tasks do not each send ``most`` rows to the driver.
    """
    part = min(1.0, 1.5 * most / max(1, total) + 64 / max(1, total))
    near = df.filter(F.pmod(key, F.lit(1 << 30)) <= int(part * (1 << 30)))
    return near.orderBy(F.pmod(key, F.lit(1 << 30)), key).limit(most)


#: Keys of rows to drop that are broadcast, at most (under 100 bytes each).
BROADCAST_KEYS = 1_000_000


def rows_that_stay(docs: DataFrame, keys: DataFrame, row_id: Column, row_key: Column, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of ``docs`` whose (id, key) stays, one of each; rows whose key is not in ``keys`` stay.

    ``keys``: one row per (``id``, ``key``) with ``stays`` and ``n``, the rows that have it.  The documents
    are not moved if the keys to drop are few enough to broadcast, and once if they are not; only rows
    whose key repeats are grouped.
    """
    gone = keys.filter(~F.col("stays")).select(F.col("id").alias(f"{OWN}i"), F.col("key").alias(f"{OWN}k"))
    again = keys.filter(F.col("stays") & (F.col("n") > 1)).select(F.col("id").alias(f"{OWN}i"), F.col("key").alias(f"{OWN}k"))
    n_gone, n_again = gone.count(), again.count()
    own = docs.withColumn(f"{OWN}id", row_id).withColumn(f"{OWN}key", row_key)
    same = F.col(f"{OWN}id").eqNullSafe(F.col(f"{OWN}i")) & (F.col(f"{OWN}key") == F.col(f"{OWN}k"))

    def side(of: DataFrame, n: int) -> DataFrame:
        return F.broadcast(of) if n <= broadcast_keys else of

    if n_gone:
        own = own.join(side(gone, n_gone), same, "left_anti")
    if n_again:
        one = own.join(side(again, n_again), same, "left_semi").dropDuplicates([f"{OWN}id", f"{OWN}key"])
        own = own.join(side(again, n_again), same, "left_anti").unionByName(one)
    return own.select(*docs.columns)


def least_hashed(df: DataFrame, key: Column, most: int, out: str = f"{OWN}h") -> DataFrame:
    """The rows of the ``most`` least distinct hashes ``key`` (a non-negative long in ``out``), the same on every run.

    Null and repeated ids do no harm where the hash holds the text too: rows of one hash all come
    along, for the caller to combine.  Two limits, a number each, are found first (from the number of
    distinct hashes, then the exact one), so no other column moves before the rows are chosen.
    """
    own = df.withColumn(out, F.shiftrightunsigned(key, 2))
    kinds = own.agg(F.approx_count_distinct(out, 0.02)).first()[0]
    near = own.filter(F.col(out) <= int(min(1.0, (1.3 * most + 64) / max(1, kinds)) * ((1 << 62) - 1)))
    last = near.select(out).distinct().orderBy(out).limit(most).agg(F.max(out)).first()[0]
    return own.filter(F.col(out) <= F.lit(-1 if last is None else last))


#: [^\x20\x09-\x0D]+ : maximal runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def running_sum(df: DataFrame, group: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the group before this one, in ``order``.

    One group may hold any share of the rows: rows are range partitioned on
    (group, order), so a large group spans many tasks.  Each task sums its own
    slice in order; the totals of (group, task), a table of at most tasks +
    groups rows, give every slice its start.  The slices are checkpointed once,
    as range bounds are sampled and both branches must see the same ones.
    """
    from pyspark.sql import Window

    keys = [F.col(c) for c in group] + list(order)
    pid, local, start = f"{OWN}pid", f"{OWN}local", f"{OWN}start"
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(pid, F.spark_partition_id())
    # The range shuffle already clusters (pid, group): a window over both would shuffle again, so the sum runs
    # over rows as sorted, in a window whose partition is this task's slice.
    w = Window.partitionBy(pid, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = saved(ranged.withColumn(local, F.coalesce(F.sum(value).over(w), F.lit(0).cast("bigint"))))
    totals = ranged.groupBy(*group, pid).agg(F.sum(value).alias(start))
    before = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"{OWN}g_{c}") for c in group], F.col(pid).alias(f"{OWN}p"),
                           F.coalesce(F.sum(start).over(before), F.lit(0).cast("bigint")).alias(start))
    same = F.col(pid) == F.col(f"{OWN}p")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"{OWN}g_{c}"))
    return (ranged.join(totals, same, "inner").withColumn(out, F.col(start) + F.col(local))
            .drop(pid, local, start, f"{OWN}p", *[f"{OWN}g_{c}" for c in group]))
