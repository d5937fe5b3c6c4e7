"""Incremental forms of the capture, dedup and budget jobs.

All four are Structured Streaming queries over a file source, run with the
``availableNow`` trigger (process everything present, in micro-batches,
then stop) and a checkpoint in the shared folder named by
``spark.checkpoint.dir``, so a restarted job resumes where it stopped.  File
sinks are exactly-once; update-mode batches overwrite their own folder, so a
repeated batch leaves no second copy.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.operators import budget as B
from loomweave.session import checkpoint_dir
from loomweave.sources.capture import classify_responses

BRONZE_SCHEMA = ("response_id string, run_id string, page_no bigint, captured_at timestamp, "
                 "status int, content_type string, body string")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex}")


def _run(writer, wait: bool = True):
    q = writer.trigger(availableNow=True).start()
    if wait:
        q.awaitTermination()
    return q


def _files(spark: SparkSession, schema: str, files_per_batch: int | None):
    """A file-stream reader; without ``files_per_batch`` a batch takes every file present."""
    reader = spark.readStream.schema(schema)
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)


def _first_only(df: DataFrame, key: list[str], ts_col: str, delay: str | None) -> DataFrame:
    """One row per key: of the whole stream, or, with ``delay``, of those at most that far apart (bounded state)."""
    if delay is None:
        return df.dropDuplicates(key)
    return df.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(key)


def _batch_to(out: str):
    """A ``foreachBatch`` function that writes each batch to its own folder, the same one on a retry."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


# ---------------------------------------------------------------- S1 ingest
def ingest_captures(spark: SparkSession, staging: str, silver: str, checkpoint: str,
                    files_per_batch: int | None = None, dedup_delay: str | None = None) -> None:
    """Captured pages (JSON lines) -> classified, decoded, deduplicated posts.

    Classification (A4), envelope checks (B1-B7) and the post projection (D1)
    are row-local, so the whole decode runs inside the streaming plan.  First-
    wins dedup on ``fullname`` (I1) covers the whole stream: its state holds one
    key per post.  ``dedup_delay`` bounds the state by a watermark on the capture
    time where repeats are known to come that close together.
    """
    from loomweave.operators import envelope as E
    from loomweave.operators import normalize as N

    stream = _files(spark, BRONZE_SCHEMA, files_per_batch).json(staging)
    ok = classify_responses(stream).filter(F.col("outcome") == "ok").drop("outcome")
    checked = E.listing_pages_checked(ok, ("t3",)).filter(F.col("drift").isNull())
    items = E.explode_things(checked, "v", ["captured_at"]).filter(F.col("kind") == "t3")
    posts = items.select(*N.post_columns(F.col("data"), F.col("captured_at"), with_media=False))
    deduped = _first_only(posts, ["fullname"], "captured_at", dedup_delay)
    _run(deduped.writeStream.format("parquet").option("path", silver)
         .option("checkpointLocation", checkpoint).outputMode("append"))


def ingest_with_quarantine(spark: SparkSession, staging: str, silver: str, quarantine: str, checkpoint: str,
                           files_per_batch: int | None = None, dedup_delay: str | None = None) -> None:
    """S1 with B7: one stream, two outputs; nothing that came in is lost.

    Posts go to ``silver`` as in ``ingest_captures``.  A response that is not ok, or that drifts from its
    envelope, goes to ``quarantine`` as (response_id, captured_at, reason, path, expected, body): the reason
    is the outcome of its classification, or ``drift``.  Both parts of a batch are written to the batch's own
    folders, so a batch that is run again replaces what it wrote, whichever of the two it had reached.
    """
    from loomweave.functions import coerce as C
    from loomweave.operators import envelope as E
    from loomweave.operators import normalize as N

    c = F.col
    stream = classify_responses(_files(spark, BRONZE_SCHEMA, files_per_batch).json(staging))
    checked = E.listing_pages_checked(stream, ("t3",))
    off = F.when(c("outcome") == "ok", F.lit("drift")).otherwise(c("outcome"))
    path, expected = (F.when(c("outcome") == "ok", c(f"drift.{x}")) for x in ("path", "expected"))
    bad = F.struct("response_id", "captured_at", off.alias("reason"), path.alias("path"), expected.alias("expected"), "body")
    parts = "array<struct<thing:variant,bad:struct<response_id:string,captured_at:timestamp,reason:string,path:string,expected:string,body:string>>>"
    # one pass: a response is read and judged once, and leaves as its things or as itself
    things = F.transform(E.listing_children(c("v")), lambda x: F.struct(x.alias("thing"), F.lit(None).alias("bad"))).cast(parts)
    refused = F.array(F.struct(F.lit(None).cast("variant").alias("thing"), bad.alias("bad"))).cast(parts)
    sound = F.coalesce((c("outcome") == "ok") & c("drift").isNull(), F.lit(False))
    each = checked.select("captured_at", F.explode(F.when(sound, things).otherwise(refused)).alias("_x")).select("captured_at", "_x.thing", "_x.bad")
    each = each.filter(c("bad").isNotNull() | (E.kind_of(c("thing")) == "t3"))
    post = F.struct(*N.post_columns(C.get(c("thing"), "data"), c("captured_at"), with_media=False))
    both = each.select("captured_at", F.when(c("bad").isNull(), post).alias("post"), "bad").select(
        "captured_at", F.when(c("bad").isNull(), c("post.fullname")).otherwise(F.concat(F.lit("!"), F.coalesce("bad.response_id", F.lit("")))).alias("key"),
        "post", "bad")
    both = _first_only(both, ["key"], "captured_at", dedup_delay)

    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        df.filter("post IS NOT NULL").select("post.*").write.mode("overwrite").parquet(f"{silver}/batch_id={batch_id}")
        df.filter("bad IS NOT NULL").select("bad.*").write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
        df.unpersist()

    _run(both.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint))


# ---------------------------------------------------------------- S2 dedup
def dedup_stream(spark: SparkSession, source_dir: str, glob: str, schema: str, key: list[str],
                 ts_col: str, out: str, checkpoint: str, delay: str | None = None,
                 files_per_batch: int | None = None) -> None:
    """One row per key however the input falls into batches; ``delay`` bounds the state by a watermark."""
    stream = (_files(spark, schema, files_per_batch).option("pathGlobFilter", glob).parquet(source_dir)
              .withColumn(ts_col, F.col(ts_col).cast("timestamp")))
    deduped = _first_only(stream, key, ts_col, delay)
    _run(deduped.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).outputMode("append"))


# ---------------------------------------------------------------- S3 rate state
def rate_window_stream(spark: SparkSession, log_dir: str, out: str, checkpoint: str,
                       width: str = "10 minutes", delay: str = "30 minutes",
                       files_per_batch: int | None = None) -> None:
    """S3: per-client budget windows kept as streaming state, emitted in update mode.

    Each micro-batch writes the windows it changed, tagged with its batch id;
    the current state is the latest version of every window (see ``latest``).
    """
    schema = ("client bigint, seq bigint, ts timestamp, event_id bigint, status int, "
              "headers map<string,string>")
    stream = _files(spark, schema, files_per_batch).parquet(log_dir)
    parsed = B.advise_stream_columns(stream)
    agg = (parsed.withWatermark("ts", delay)
           .groupBy("client", F.window("ts", width).alias("w"))
           .agg(F.count("*").alias("requests"),
                F.sum(F.when((F.col("status") == 429) | (F.col("remaining") == 0), 1).otherwise(0))
                .alias("limited"),
                F.min("remaining").alias("min_remaining")))

    _run(agg.writeStream.outputMode("update").foreachBatch(_batch_to(out)).option("checkpointLocation", checkpoint))


def latest(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Current state of an update-mode sink: the newest batch's row per key."""
    df = spark.read.parquet(out)
    values = [c for c in df.columns if c not in keys and c != "batch_id"]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v"))
            .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values]))


# ---------------------------------------------------------------- S3 alerts
def budget_alert_stream(spark: SparkSession, log_dir: str, out: str, checkpoint: str,
                        low_water: float = 0.0, files_per_batch: int | None = None) -> None:
    """S3: per client, how often the budget was low, first and last time, as stream state.

    M1 parses the headers row-locally; responses whose remaining budget is at or
    below ``low_water`` (0 = exhausted) update count, minimum and maximum per
    client, which combine before the shuffle, so a busy client is a few rows a
    task.  Every micro-batch emits the clients it changed (update mode).
    """
    schema = ("client bigint, seq bigint, ts timestamp, event_id bigint, status int, "
              "headers map<string,string>")
    stream = _files(spark, schema, files_per_batch).parquet(log_dir)
    alerts = (B.advise_stream_columns(stream).filter(F.col("remaining") <= F.lit(float(low_water)))
              .groupBy("client").agg(F.count("*").alias("low_responses"), F.min("seq").alias("first_low_seq"),
                                     F.max("seq").alias("last_low_seq")))
    _run(alerts.writeStream.outputMode("update").foreachBatch(_batch_to(out)).option("checkpointLocation", checkpoint))
