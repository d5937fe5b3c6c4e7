"""Benchmark: wall time per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed through the ``noop`` sink (every row produced,
nothing collected to the driver).  An untimed warm-up first starts the JVM
code paths (one parquet read, JSON parse and shuffle on a few rows), so the
first timed query does not carry process start-up.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    # one query per operator family; BENCH_ALL=1 runs every registered query
    "flagship",                 # posts + comment forests joined (entry query)
    "normalize_posts",          # envelope decode + strict coercions + dedup
    "community_listing_hot",    # filter + score + distributed top-k
    "paged_run_audit",          # paging engine, stop reasons
    "normalize_comments",       # level-wise flatten of nested captures
    "comment_sort_confidence",  # sibling sort + range-partitioned display rank
    "forest_expand",            # snapshot merge rounds
    "related_posts",            # group top-k, no all-pairs
    "search_posts_relevance",   # BM25
    "resolve_identifiers",
    "scrub_text",
    "pii_findings",
    "pii_capture_scan",         # structural scan, one variant_explode a level
    "budget_advice",
    "schema_conformance",
    "stream_ingest",            # Structured Streaming, availableNow
]


def _warm_up(spark, sf_dir: str) -> None:
    from pyspark.sql import functions as F

    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).limit(200)
    (docs.withColumn("j", F.to_json(F.struct("doc_id", "source")))
     .withColumn("v", F.parse_json("j"))
     .groupBy("source").agg(F.count("*")).write.format("noop").mode("overwrite").save())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession

    from loomweave.plans.catalog import QUERIES, flagship
    from loomweave.session import DEFAULT_CONF, checkpoint_dir, configure

    builder = SparkSession.builder.master(f"local[{cpus}]").appName("loomweave-bench")
    conf = dict(DEFAULT_CONF)
    conf.update({"spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus))),
                 "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)   # reads spark.checkpoint.dir; a private folder only when unset

    registry = dict(QUERIES)
    registry["flagship"] = flagship
    names = sorted(registry) if os.environ.get("BENCH_ALL") else [n for n in HEADLINE if n in registry]
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = [n for n in only.split(",") if n in registry]
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    from loomweave.plans.catalog import clear_memo

    _warm_up(spark, sf_dir)

    for name in names:
        clear_memo()
        start = time.perf_counter()
        try:
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - start, 3)
            print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
        except Exception as exc:  # record and keep measuring the others
            errors[name] = str(exc).splitlines()[0][:300]
    out = {
        "metric": "total_wall_time_headline_queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
        "spark": spark.version,
        "conf": {k: conf[k] for k in sorted(conf) if k.startswith("spark.sql.")},
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
