"""Session helpers: one place for the Spark settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs assume.  UTC is required: every timestamp rule is UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Level loops run many small jobs; keep the driver's job history short.
    "spark.ui.retainedJobs": "200",
    "spark.ui.retainedStages": "200",
    "spark.ui.retainedTasks": "10000",
    "spark.sql.ui.retainedExecutions": "50",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "loomweave") -> SparkSession:
    """Return the active session or build a local one with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


RUNTIME_KEYS = ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.ansi.enabled")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for key in RUNTIME_KEYS:
        spark.conf.set(key, DEFAULT_CONF[key])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment to a shared filesystem and is
    only read here.  When it is unset in a local session (tests) a private
    folder is registered on the context instead; on a cluster an unset folder
    is an error, as executors would not share one made here.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    registered = sc._jsc.sc().getCheckpointDir()  # noqa: SLF001 - no public getter
    if registered.isDefined():
        return registered.get()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="loomweave-ckpt-")
    sc.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local one.

    The frame is persisted first: writing a reliable checkpoint otherwise
    recomputes the whole lineage a second time after the eager count.
    """
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet beside the checkpoints; a reader takes only the columns that it needs."""
    path = os.path.join(checkpoint_dir(df.sparkSession), "stored", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Within, the session's setting ``key`` has this value; what is planned or run there takes it."""
    usual = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, usual) if usual is not None else spark.conf.unset(key)


def shuffles_removed(spark: SparkSession):
    """Within, a query's shuffle files go when it ends, not when the driver next collects garbage: for writes in several steps."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
