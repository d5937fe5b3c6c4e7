"""Shared DataFrame building blocks that stay scalable under hot keys.

A plain ``row_number() over (partition by run order by x)`` sorts a whole
partition in one task; if one key holds a third of all rows that task holds a
third of the data.  ``blocked_running_count`` splits each key into fixed-width
blocks of the (numeric) order column: per-block counts are a map-side
combined aggregate, block offsets are a prefix sum over the much smaller
block table, and the in-block rank is a window over at most one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def blocked_running_count(df: DataFrame, part_cols: list[str], order_col: Column,
                          tie_cols: list[str], block: int, out: str = "rn",
                          weight: Column | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` (default 1) per ``part_cols``.

    Rows are ordered by ``order_col`` ascending (numeric), then ``tie_cols``.
    With the default weight this is ``row_number()``.
    """
    w_col = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    staged = (df.withColumn("_ord", order_col)
              .withColumn("_blk", F.floor(F.col("_ord") / F.lit(block)).cast("bigint"))
              .withColumn("_w", w_col))
    per_block = staged.groupBy(*part_cols, "_blk").agg(F.sum("_w").alias("_blk_sum"))
    before = Window.partitionBy(*part_cols).orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = per_block.select(*part_cols, "_blk",
                               F.coalesce(F.sum("_blk_sum").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*part_cols, "_blk").orderBy("_ord", *tie_cols).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = staged.withColumn("_local", F.sum("_w").over(inner))
    return (ranked.join(offsets, on=[*part_cols, "_blk"], how="inner")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_ord", "_blk", "_w", "_local", "_off"))


def first_wins(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """Keep the first row per key in ``order_cols`` order.

    A ``min(struct(order..., row...))`` aggregate combines map-side before the
    shuffle, unlike a window, so duplicated hot keys do not pile up in one task.
    """
    value_cols = [c for c in df.columns if c not in key_cols]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c) for c in value_cols])
    return (df.groupBy(*key_cols).agg(F.min(packed).alias("_first"))
            .select(*key_cols, *[F.col("_first")[c].alias(c) for c in value_cols])
            .select(*df.columns))


def distributed_rank(df: DataFrame, group_cols: list[str], order_cols: list[Column], out: str = "rank",
                     partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by group order by ...)`` that splits hot groups.

    A plain window puts a whole group in one task.  Here the rows are range
    partitioned on ``(group, order)`` (sampled bounds, so one big group spans
    many tasks) and sorted there once; a row's number within its (task, group)
    slice is its position in the task minus the slice's first, so no window
    shuffles the rows again.  Row counts of the same group in earlier tasks, a
    small ``(group, task) -> count`` table with a prefix sum, shift the numbers.
    Works for any orderable key (arrays included), unlike ``blocked_running_count``.
    """
    keys = [F.col(c) for c in group_cols] + list(order_cols)
    # Without an explicit count the range shuffle stays eligible for AQE
    # coalescing, so small inputs do not fan out into hundreds of tasks.
    ranged = (df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys))
    ranged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_row", F.monotonically_increasing_id()))
    # Task ids are only stable within one materialisation (range bounds are
    # sampled and AQE may coalesce differently per branch): number once, then
    # derive counts and offsets from the same checkpointed rows.
    from loomweave.session import cut_lineage

    ranged = cut_lineage(ranged)
    counts = ranged.groupBy(*group_cols, "_pid").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "_pid", "_first",
                             F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(offsets, [*group_cols, "_pid"])
            .withColumn(out, (F.col("_off") + F.col("_row") - F.col("_first") + 1).cast("bigint"))
            .drop("_pid", "_row", "_first", "_off"))
