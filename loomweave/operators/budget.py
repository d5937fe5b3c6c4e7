"""M1-M5: rate-budget audit over a request log (the client's pacing arithmetic).

Log contract: ``(client, seq, ts, status, headers MAP<STRING,STRING>)``, one row
per response, ``seq`` 1-based per client.  The previous response of the same
client is found with an equi-join on ``(client, seq - 1)`` rather than a
``lag`` window, so a client holding a third of all requests is never sorted
in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.functions import coerce as C
from loomweave.sources.capture import rate_headers

# Fixed values that must equal the reference's.
MIN_REQUEST_PAUSE_SECONDS = 1.0


def advise(log: DataFrame, request_pause: float = MIN_REQUEST_PAUSE_SECONDS,
           wait_on_limit: bool = False, max_wait: float | None = None) -> DataFrame:
    """M1-M3 + M5 per response: parsed budget, advised delay, stop/wait decision."""
    pause = max(float(request_pause), MIN_REQUEST_PAUSE_SECONDS)  # non-bypassable floor
    parsed = log.withColumn("rh", rate_headers(F.col("headers")))
    zero = F.col("rh").isNotNull() & (F.col("rh.remaining") == 0)
    can_wait = F.lit(False)
    if wait_on_limit:
        can_wait = F.col("rh.reset") >= 0
        if max_wait is not None:
            can_wait = can_wait & (F.col("rh.reset") <= F.lit(float(max_wait)))
    decision = (F.when(F.col("status") == 429, F.lit("stop"))
                .when(F.col("rh").isNull(), F.lit("continue"))
                .when(~zero, F.lit("continue"))
                .when(can_wait, F.lit("wait"))
                .otherwise(F.lit("stop")))
    parsed = parsed.withColumn("decision", decision)
    # Governor state seen by the next request: the parsed headers, cleared after a wait.
    prev = parsed.select("client", (F.col("seq") + 1).alias("seq"),
                         F.when(F.col("decision") != "wait", F.col("rh")).alias("prev_rh"))
    joined = parsed.join(prev, ["client", "seq"], "left")
    p = F.col("prev_rh")
    blocked = F.coalesce(p.isNotNull() & (p["remaining"] == 0) & p["reset"].isNotNull(), F.lit(False))
    pace = (p.isNotNull() & (p["remaining"] > 0) & p["reset"].isNotNull() & p["used"].isNotNull()
            & (p["remaining"] <= p["used"]))
    delay = F.when(pace, F.greatest(F.lit(pause), p["reset"] / p["remaining"])).otherwise(F.lit(pause))
    reset_at = F.when(F.col("rh").isNotNull(), F.timestamp_micros(
        (F.unix_micros(F.col("ts")) + F.greatest(F.lit(0.0), F.col("rh.reset")) * 1_000_000)
        .cast("bigint")))
    budget_text = F.when(F.col("rh").isNotNull(), F.concat(
        F.col("rh.remaining").cast("string"), F.lit("/"), F.col("rh.used").cast("string"))
    ).otherwise(F.lit("unknown/unknown"))
    return joined.select(
        "client", "seq", "ts", "status",
        F.col("rh.remaining").alias("remaining"), F.col("rh.reset").alias("reset"),
        F.col("rh.used").alias("used"),
        F.round(delay, 6).alias("advised_delay"), blocked.alias("blocked"), "decision",
        reset_at.alias("reset_at"), budget_text.alias("budget_text"))


def windows(advice: DataFrame, width: str = "10 minutes") -> DataFrame:
    """M4: requests, limited responses and the lowest remaining budget per window."""
    return (advice.groupBy("client", F.window(F.col("ts"), width).alias("w"))
            .agg(F.count("*").alias("requests"),
                 F.sum(F.when((F.col("status") == 429) | (F.col("remaining") == 0), 1).otherwise(0))
                 .alias("limited"),
                 F.min("remaining").alias("min_remaining"))
            .select("client", C.iso(F.col("w.start")).alias("window_start"), "requests", "limited",
                    "min_remaining"))


def advise_stream_columns(log: DataFrame) -> DataFrame:
    """M1 only (row-local, so it runs inside a streaming query): the parsed budget."""
    rh = rate_headers(F.col("headers"))
    return log.select("client", "seq", "ts", "status", rh["remaining"].alias("remaining"),
                      rh["reset"].alias("reset"), rh["used"].alias("used"))
