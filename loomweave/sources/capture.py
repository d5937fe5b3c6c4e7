"""Capture sources, response classification and sinks.

Bronze row contract (one per captured response)::

    response_id STRING, run_id STRING, page_no BIGINT, captured_at TIMESTAMP,
    status INT, content_type STRING, body STRING [, headers MAP<STRING,STRING>]
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.functions import coerce as C

# Fixed values that must equal the reference's.
UNAVAILABLE_WORDS = ("forbidden", "private", "banned", "quarantined", "suspended", "deleted")
SHAPE_KEYS = ("reason", "message", "error", "explanation")
RATE_HEADERS = ("x-ratelimit-remaining", "x-ratelimit-reset", "x-ratelimit-used")
CAPTURE_STEM = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,99}")


# ---------------------------------------------------------------- A1/A3: sources
def read_captures(spark: SparkSession, directory: str, glob: str = "*.json") -> DataFrame:
    """A1/A3: one JSON body per file, in file-name order; invalid JSON is flagged.

    ``wholetext`` keeps each file as one row; ``_metadata.file_name`` gives the
    deterministic order.  Invalid or empty bodies get ``valid = false`` and go to
    quarantine instead of failing the job.
    """
    df = (spark.read.option("wholetext", True).option("pathGlobFilter", glob)
          .text(directory)
          .select(F.col("_metadata.file_name").alias("file_name"),
                  F.col("_metadata.file_modification_time").alias("captured_at"),
                  F.col("value").alias("body")))
    v = F.try_parse_json(F.col("body"))
    return df.withColumn("valid", v.isNotNull() & (F.trim(F.col("body")) != ""))


#: What Spark escapes in a partition folder's name, and its name for no value.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path as it takes it."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - no Python API for file systems
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return fs, fs.makeQualified(at)


def _landed(folder: str):
    """Arrow batches of (name, body) -> one file each under ``folder/name=.../``, as Spark's text writer would; gives their number.

    A file is written elsewhere and renamed, and a task's rows are sorted, so another attempt of the task replaces a file by its like.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, tmp = task.partitionId(), os.path.join(folder, "_temporary", str(task.taskAttemptId()))
        os.makedirs(tmp, exist_ok=True)
        at = 0
        for batch in batches:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body").to_pylist()):
                to = os.path.join(folder, "name=" + (_ESCAPED.sub(lambda m: f"%{ord(m.group()):02X}", name) if name else _NO_VALUE))
                held = os.path.join(tmp, str(at))
                with open(held, "wb") as f:
                    f.write((body or b"") + b"\n")
                os.makedirs(to, exist_ok=True)
                os.replace(held, os.path.join(to, f"part-{part:05d}-{at}.txt"))
                at += 1
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64())], names=["files"])
    return run


def _land(captures: DataFrame, staging: str) -> None:
    """``captures(name, body)`` as one file each in a folder of its name, in place of what ``staging`` held.

    Hadoop starts a process for every file and folder that it makes in a local (shared) folder, so there tasks write the files
    themselves; any other store gets them from Spark's writer.
    """
    spark = captures.sparkSession
    fs, at = _file_system(spark, staging)
    dealt = captures.select("name", "body").repartition(spark.sparkContext.defaultParallelism)
    if fs.getUri().getScheme() != "file":
        (dealt.write.mode("overwrite").partitionBy("name").option("maxRecordsPerFile", 1)
         .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(staging))
        return
    fs.delete(at, True)
    fs.mkdirs(at)
    rows = dealt.select("name", F.col("body").cast("binary").alias("body")).sortWithinPartitions("name", "body")
    rows.mapInArrow(_landed(at.toUri().getPath()), "files bigint").write.format("noop").mode("overwrite").save()


def read_in_rounds(captures: DataFrame, staging: str, out: str, files: int = 32768) -> DataFrame:
    """A1: ``captures(name, body)`` landed as one file each in a folder of its name, read back whole: ``(name, valid)``, null names included.

    Whoever lists a folder holds all its file names, on the driver, so the captures are dealt by hash
    to rounds of about ``files``: a round's files are written under ``staging``, read, judged
    and written over by the next round's, and only the verdicts stay, under ``out``.  The driver holds the
    names of one round at any number of captures.
    """
    spark = captures.sparkSession
    rounds = max(1, -(-captures.count() // files))
    (captures.select("name", "body", F.pmod(F.xxhash64("name", "body"), F.lit(rounds)).alias("round")).repartition("round")
     .write.partitionBy("round").parquet(f"{out}/landed"))
    listing = "spark.sql.sources.parallelPartitionDiscovery.parallelism"       # else a task for each folder
    usual = spark.conf.get(listing, None)
    spark.conf.set(listing, str(max(8, spark.sparkContext.defaultParallelism)))
    try:
        for k in range(rounds):
            part = spark.read.schema("name string, body string, round bigint").parquet(f"{out}/landed").filter(F.col("round") == k)
            _land(part, staging)
            read = spark.read.schema("value string, name string").text(staging, wholetext=True)
            valid = F.try_parse_json("value").isNotNull() & (F.trim("value") != "")
            read.select("name", valid.alias("valid")).coalesce(spark.sparkContext.defaultParallelism).write.mode("append").parquet(f"{out}/verdicts")
    finally:
        spark.conf.set(listing, usual) if usual is not None else spark.conf.unset(listing)
    return spark.read.schema("name string, valid boolean").parquet(f"{out}/verdicts")


def valid_stem(name: str) -> bool:
    """A2: checked capture stem (no path parts, no ``..``)."""
    return bool(CAPTURE_STEM.fullmatch(name)) and ".." not in name


def stem_ok(name: Column) -> Column:
    """A2 as a column: the same check for names that come as data."""
    return name.rlike(f"^{CAPTURE_STEM.pattern}\\z") & ~F.contains(name, F.lit(".."))


# ---------------------------------------------------------------- M1: rate headers
def rate_headers(headers: Column) -> Column:
    """M1: ``struct<remaining, reset, used>`` when all three are finite and >= 0, else NULL."""
    lowered = F.map_from_entries(F.transform(F.map_entries(headers), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    vals = [F.element_at(lowered, F.lit(h)).try_cast("double") for h in RATE_HEADERS]
    ok = None
    for x in vals:
        cond = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")) & (x >= 0)
        ok = cond if ok is None else ok & cond
    return F.when(ok, F.struct(vals[0].alias("remaining"), vals[1].alias("reset"),
                               vals[2].alias("used")))


# ---------------------------------------------------------------- A4: classification
def _shape_text(v: Column) -> Column:
    parts = []
    for key in SHAPE_KEYS:
        x = C.get(v, key)
        parts.append(F.coalesce(F.when(C.vtype(x) == "STRING", F.try_variant_get(x, "$", "string"))
                                .otherwise(F.to_json(x)), F.lit("")))
    return F.lower(F.concat_ws(" ", *parts))


def classify_column(status: Column, content_type: Column, body: Column,
                    headers: Column | None = None, wait_on_limit: bool = False,
                    max_wait: float | None = None, v: Column | None = None, text: Column | None = None) -> Column:
    """A4: ok / rate_limited / challenge / not_found / unavailable, in the client's order.

    ``v`` and ``text``: columns that hold the parsed body and its shape text already.

    A good body that arrives with zero remaining budget is discarded (the budget
    check runs first) unless waiting is allowed and the reset fits ``max_wait``.
    """
    v = F.try_parse_json(body) if v is None else v
    rh = rate_headers(headers) if headers is not None else F.lit(None)
    zero_left = rh.isNotNull() & (rh["remaining"] == 0) if headers is not None else F.lit(False)
    if wait_on_limit and headers is not None:
        can_wait = rh["reset"] >= 0
        if max_wait is not None:
            can_wait = can_wait & (rh["reset"] <= F.lit(max_wait))
        zero_left = zero_left & ~can_wait
    text = _shape_text(v) if text is None else text
    is_obj = C.is_object(v)
    is_container = is_obj | C.as_array(v).isNotNull()
    return (F.when(status.isNull(), F.lit("challenge"))
            .when((status == 429) | zero_left, F.lit("rate_limited"))
            .when(content_type.isNull() | ~F.lower(content_type).contains("json"), F.lit("challenge"))
            .when(body.isNull(), F.lit("challenge"))
            .when(v.isNull(), F.lit("challenge"))
            .when((status == 404) | (is_obj & text.contains("not found")), F.lit("not_found"))
            .when((status == 403) | (is_obj & F.exists(
                F.array(*[F.lit(w) for w in UNAVAILABLE_WORDS]), lambda w: F.instr(text, w) > 0)),
                F.lit("unavailable"))
            .when(~is_container, F.lit("challenge"))
            .otherwise(F.lit("ok")))


def classify_responses(bronze: DataFrame, wait_on_limit: bool = False,
                       max_wait: float | None = None) -> DataFrame:
    headers = F.col("headers") if "headers" in bronze.columns else None
    # parsed once a row: the rules below read the body many times
    staged = bronze.withColumn("_v", F.try_parse_json("body")).withColumn("_text", _shape_text(F.col("_v")))
    return staged.withColumn("outcome", classify_column(
        F.col("status"), F.col("content_type"), F.col("body"), headers, wait_on_limit, max_wait, F.col("_v"), F.col("_text"))).drop("_v", "_text")


# ---------------------------------------------------------------- A5-A9: sinks
def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """NDJSON, UTF-8 unescaped; the commit protocol publishes atomically."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def to_json_array(df: DataFrame, max_rows: int) -> DataFrame:
    """A bounded result as one JSON-array text row; refuses above ``max_rows``.

    The check is an explicit count before anything is gathered into one value.
    """
    n = df.count()
    if n > max_rows:
        raise ValueError(f"JSON-array sink is for bounded results: {n} rows > {max_rows}")
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns)),
                            {"ignoreNullFields": "false"}).alias("json"))


def serialise(df: DataFrame, include_raw: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Fixed field order, timestamps as ISO text, ``raw`` only when asked; columns in ``keep`` stay beside the text."""
    cols = []
    for field in df.schema.fields:
        if (field.name == "raw" and not include_raw) or field.name in (keep or ()):
            continue
        c = F.col(field.name)
        if field.dataType.typeName() == "timestamp":
            c = C.iso(c)
        cols.append(c.alias(field.name))
    return df.select(*(keep or ()), F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


def write_json_array(df: DataFrame, path: str, order: list[Column]) -> None:
    """All rows as one JSON array in the given order, of any number of rows, written by many tasks.

    ``path`` is a folder whose part files, put together in the order of their names, are the array: the
    first line opens it, every later one starts with its comma, the last closes it.  Spark's commit
    publishes all parts together, with ``_SUCCESS``, or none; a published folder is never written again.
    No row gives ``[]``.  Rows are range partitioned by their number, so none gathers more than its share.
    """
    from loomweave.operators.common import distributed_rank

    ranked = distributed_rank(df, [], order, "_n")
    total = ranked.count()
    if not total:
        df.sparkSession.range(1, numPartitions=1).select(F.lit("[]").alias("value")).write.text(path)
        return
    lines = serialise(ranked, keep=["_n"])
    line = F.concat(F.when(F.col("_n") == 1, "[").otherwise(","), "json", F.when(F.col("_n") == total, "]").otherwise(""))
    lines.repartitionByRange("_n").sortWithinPartitions("_n").select(line.alias("value")).write.text(path)


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """``(n, json)`` of a folder that ``write_json_array`` published, in the order of the array."""
    from loomweave.operators.common import distributed_rank

    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                                         F.monotonically_increasing_id().alias("_i")).filter("value <> '[]'")
    inner = F.regexp_replace(F.regexp_replace("value", r"^[\[,]", ""), r"\}\]$", "}")
    ranked = distributed_rank(lines.select(inner.alias("json"), "_f", "_b", "_i"), [], [F.col("_f"), F.col("_b"), F.col("_i")], "n")
    return ranked.select("n", "json")


# ---------------------------------------------------------------- A2/A3: many captures a file
def write_bundle(captures: DataFrame, path: str) -> DataFrame:
    """A2: ``captures(name, body)`` as NDJSON lines in name order, many captures a file; returns the refused rows.

    A name must be a capture stem (no path parts, no ``..``); rows with another name, or none, are not
    written and come back with their name.
    """
    good = F.coalesce(stem_ok(F.col("name")), F.lit(False))
    (captures.filter(good).select("name", "body").repartitionByRange("name").sortWithinPartitions("name")
     .write.option("ignoreNullFields", "false").json(path))
    return captures.filter(~good).select("name")


def read_bundle(spark: SparkSession, path: str) -> DataFrame:
    """A1/A3: ``(seq, name, body, valid)`` in name order; names are checked again, as files may come from elsewhere."""
    from loomweave.operators.common import distributed_rank

    rows = spark.read.schema("name string, body string").json(path).filter(stem_ok(F.col("name")))
    valid = F.try_parse_json("body").isNotNull() & (F.trim("body") != "")
    ranked = distributed_rank(rows.withColumn("valid", F.coalesce(valid, F.lit(False))), [],
                              [F.col("name"), F.substring("body", 1, 32), F.md5("body")], "seq")  # short keys: their samples reach the driver
    return ranked.select("seq", "name", "body", "valid")


def staging_path(base: str, name: str) -> str:
    if not valid_stem(name):
        raise ValueError("invalid capture name")
    return os.path.join(base, name)


def write_posts_silver(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Silver layout for listings: one folder per creation day, files sorted by community.

    Listing filters then reach the scan: the date window prunes day folders and
    ``community_key = ...`` / ``created_at`` ranges prune row groups by their
    min/max statistics.  ``community_key`` is the case-folded community name, so
    the case-insensitive match stays a plain column predicate.  Rows are range
    partitioned, so a busy day is written by many tasks.
    """
    (posts.withColumn("community_key", F.lower("subreddit"))
     .withColumn("created_date", F.to_date("created_at"))
     .repartitionByRange("created_date", "community_key", "created_at")
     .sortWithinPartitions("community_key", "created_at")
     .write.mode(mode).partitionBy("created_date").parquet(path))
