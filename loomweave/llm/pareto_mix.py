"""Mixing sources to target weights by Pareto order sampling.

Each source has a target number of words.  Where the target is at least the
source's size, every document first gets floor(target / size) whole copies for
certain.  The rest is a fixed-size sample with unequal probabilities: document
i has inclusion probability

    pi_i = f * (1 + (1 - f) * t_i),   f = fractional part of target / size,

where t_i in [-1, 1] is the size class of the document, centred so that the
expected words are exactly the target, and documents are ranked by

    [u_i / (1 - u_i)] / [pi_i / (1 - pi_i)],   u_i uniform from a hash of the id.

The smallest ranks are taken until the sample holds the target's words (size
is measured in words).  Two top-up passes go on down the ranking with
documents that still fit in what is missing, so a long document at the edge
does not leave a gap.

A source may hold any share of the rows: ranks are never needed, only running
sums in rank order, which are range partitioned (``io.running_sum``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.llm.io import OWN, WORD, running_sum, saved, whole_text

TOP_UPS = 2


def n_words(text_col: str = "text") -> Column:
    return F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[float, ...], total_share: float, most_copies: int) -> DataFrame:
    """Source, size, target per source: words shared by weight, none above ``most_copies`` times its size.

    The excess over the cap is shared again by weight until none is above;
    that fixpoint is a water level: target = min(cap, level * weight).  Sources
    are sorted by cap / weight; the level after capping the first k is the
    first that leaves the next one below its cap.  The table has a row per
    source, not per document.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("w", pick).withColumn("cap", (F.col("source_size") * most_copies).cast("double"))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before, rest, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    goal = F.sum("source_size").over(everything) * total_share
    s = s.withColumn("level", (goal - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    s = s.withColumn("at", F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))).over(everything))
    return s.select("source", "source_size",
                    F.when(F.col("source_size") == 0, 0.0).when(F.col("at").isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("at") * F.col("w"))).alias("target"), F.col("z_sum"), F.col("z_min"), F.col("z_max"))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5, the same on every run and engine."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def size_class(size: Column) -> Column:
    """floor(log2(size + 1)) without floating point: the length of the binary form, less one."""
    return (F.length(F.bin(size + 1)) - 1).cast("bigint")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), total_share: float = 1.5, most_copies: int = 2,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix:") -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, copies, taken.

    ``size`` counts words (null text: 0).  Sources are ordered by code point,
    null last and a source of its own, and take ``weights`` in turn.  Documents
    of size 0 are never taken (they add no words).  Rows that repeat an id are
    documents of their own with the same random number; equal rows are taken in
    any order.  Other columns are not read.  An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       n_words(text_col).alias("size"))
    base = saved(base.withColumn("z", size_class(F.col("size"))))
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("z")).alias("z_sum"),
                                       F.min(F.when(F.col("size") > 0, F.col("z"))).alias("z_min"), F.max("z").alias("z_max"))
    plan = targets(sizes, weights, total_share, most_copies)
    ratio = F.try_divide(F.col("target"), F.col("source_size"))
    plan = (plan.withColumn("sure", F.when(F.col("source_size") == 0, 0).otherwise(F.floor(ratio)).cast("bigint"))
            .withColumn("f", F.when(F.col("source_size") == 0, 0.0).otherwise(ratio - F.col("sure")))
            .withColumn("left", F.when(F.col("source_size") == 0, 0.0).otherwise(F.col("target") - F.col("sure") * F.col("source_size")))
            .withColumn("mid", F.try_divide(F.col("z_sum"), F.col("source_size")))
            .withColumn("reach", F.greatest(F.col("z_max") - F.col("mid"), F.col("mid") - F.col("z_min"))))
    plan = saved(plan.withColumnRenamed("source", f"{OWN}source"))
    d = base.join(plan, F.col("source").eqNullSafe(F.col(f"{OWN}source"))).drop(f"{OWN}source")
    t = F.when(F.col("reach") > 0, (F.col("z") - F.col("mid")) / F.col("reach")).otherwise(0.0)
    pi = F.col("f") * (1 + (1 - F.col("f")) * t)
    u = uniform(F.col("doc_id"), seed)
    d = d.withColumn("pi", pi).withColumn("odds", F.when((F.col("pi") > 0) & (F.col("pi") < 1) & (F.col("size") > 0),
                                                         F.try_divide(u / (1 - u), F.try_divide(F.col("pi"), 1 - F.col("pi")))))
    keep = ["doc_id", "source", "size", "source_size", "target", "sure", "left", "odds"]
    rows = d.select(*keep, F.lit(0).cast("bigint").alias("extra"))
    missing = F.col("left")
    for turn in range(1 + TOP_UPS):
        open_ = F.col("odds").isNotNull() & (F.col("extra") == 0)
        if turn:
            got = (rows.groupBy("source").agg(F.sum(F.col("extra") * F.col("size")).alias("got")).withColumnRenamed("source", f"{OWN}s"))
            rows = rows.join(got, F.col("source").eqNullSafe(F.col(f"{OWN}s"))).drop(f"{OWN}s")
            missing = F.col("left") - F.col("got")
            open_ = open_ & (F.col("size") <= missing)
        rows = rows.withColumn("need", missing).withColumn("step", F.when(open_, F.col("size")).otherwise(F.lit(0).cast("bigint")))
        rows = rows.withColumn("closed", (~open_).cast("int"))
        rows = running_sum(rows, ["source"], [F.col("closed"), F.col("odds"), F.col("doc_id")], "step", "ahead")
        take = (F.col("closed") == 0) & (2 * F.col("ahead") + F.col("size") <= 2 * F.col("need"))
        rows = saved(rows.withColumn("extra", F.col("extra") + F.when(take, 1).otherwise(0)).select(*keep, "extra"))
    copies = F.when(F.col("size") > 0, F.col("sure") + F.col("extra")).otherwise(F.lit(0).cast("bigint"))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document as often as the mix takes it, all columns kept.

    Documents are matched by id: rows that repeat an id stand or fall together,
    with the copies of the first in rank order.
    """
    id_col = options.get("id_col", "doc_id")
    copies = (mix(docs, **options).groupBy("doc_id").agg(F.max("copies").alias(f"{OWN}n"))
              .withColumnRenamed("doc_id", f"{OWN}id").filter(F.col(f"{OWN}n") > 0))
    hit = docs.join(copies, F.col(id_col).cast("bigint").eqNullSafe(F.col(f"{OWN}id")))
    return hit.withColumn(f"{OWN}k", F.explode(F.sequence(F.lit(1), F.col(f"{OWN}n")))).select(*docs.columns)
