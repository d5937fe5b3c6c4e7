"""Interval numbering of comment trees and pointer doubling over parent links.

A node's subtree is the run of nodes in depth-first order from the node itself
up to the first node that sorts at or after its *end mark*: its path with the
last position raised by one.  One distributed sort of nodes and end marks with
running sums gives every node ``entry`` and ``exit`` (numbers of nodes before
either), and the sum of any weight over a subtree is the difference of two
prefix sums.  Work grows with the rows, not with rows times depth, and a thread
that holds a third of all rows is sorted by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.session import cut_lineage


def running_sums(df: DataFrame, group_cols: list[str], order_cols: list[Column], values: dict[str, Column]) -> DataFrame:
    """Adds, for each name in ``values``, the sum of that column over the group's rows before this one in the order.

    Rows are range partitioned on (group, order), so one group spans many tasks; each task sums its own
    slices, and a table of (group, task) totals gives every slice its start.
    """
    keys = [F.col(c) for c in group_cols] + list(order_cols)
    staged = df.select("*", *[v.cast("bigint").alias(f"_v_{n}") for n, v in values.items()])
    # task numbers hold within one materialisation only: number once, read back twice
    ranged = cut_lineage(staged.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_pid", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    before = Window.partitionBy("_pid", *group_cols).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(f"_v_{n}").over(before), F.lit(0)).alias(f"_l_{n}") for n in values])
    totals = ranged.groupBy(*group_cols, "_pid").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    earlier = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("_pid").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in group_cols],
                           *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in values])
    same = F.col("_pid") == F.col("_p")
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return local.join(starts, same).select(*df.columns, *[(F.col(f"_s_{n}") + F.col(f"_l_{n}")).cast("bigint").alias(n) for n in values])


def numbered(nodes: DataFrame, **weights: Column) -> DataFrame:
    """thread_id, path, entry, exit and, per name in ``weights``, the sum of that column over the node's subtree.

    ``entry`` counts the nodes displayed before this one; the subtree is the nodes with
    ``entry <= theirs < exit``.
    """
    names = ["_n", *weights]
    own = nodes.select("thread_id", "path", F.lit(1).alias("_side"), F.col("path").alias("_own"), F.lit(1).alias("_n"),
                       *[w.alias(n) for n, w in weights.items()])
    last = F.element_at("path", -1) + 1
    ends = nodes.select("thread_id", F.concat(F.slice("path", 1, F.size("path") - 1), F.array(last)).alias("path"), F.lit(0).alias("_side"),
                        F.col("path").alias("_own"), *[F.lit(0).alias(n) for n in names])
    summed = running_sums(own.unionByName(ends), ["thread_id"], [F.col("path"), F.col("_side")], {f"_b_{n}": F.col(n) for n in names})
    at = [F.max(F.when(F.col("_side") == side, F.col(f"_b_{n}"))).alias(f"_{side}_{n}") for n in names for side in (0, 1)]
    spans = summed.groupBy("thread_id", F.col("_own").alias("path")).agg(*at)
    return spans.select("thread_id", "path", F.col("_1__n").alias("entry"), F.col("_0__n").alias("exit"),
                        *[(F.col(f"_0_{n}") - F.col(f"_1_{n}")).alias(n) for n in weights])


def fold_up(links: DataFrame, plus: Callable[[Column, Column], Column], levels: int) -> DataFrame:
    """Each node's value combined with those of all its ancestors, by pointer doubling.

    ``links``: (thread_id, node, up, value), ``up`` null at the top; ``plus(above, below)`` is associative.
    ``levels`` is the number of nodes on the longest chain: log2 of it joins are made.
    """
    now = links.select("thread_id", "node", "up", "value")
    for _ in range(math.ceil(math.log2(max(1, levels)))):
        above = now.select(F.col("thread_id").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("value").alias("_value"))
        met = now.join(above, (F.col("thread_id") == F.col("_t")) & (F.col("up") == F.col("_n")), "left")
        value = F.when(F.col("_n").isNull(), F.col("value")).otherwise(plus(F.col("_value"), F.col("value")))
        now = cut_lineage(met.select("thread_id", "node", F.col("_up").alias("up"), value.alias("value")))
    return now.select("thread_id", "node", "value")


def contained(points: DataFrame, spans: DataFrame, at: str, lo: str, hi: str, group: str = "thread_id", span: int = 1024) -> DataFrame:
    """Interval containment join: rows of ``points`` with each row of ``spans`` of the group where lo <= at < hi.

    The number line of a group is cut into stretches of ``span``; an interval goes to the stretches that it
    meets, a point to its own, so a large group or interval is dealt to many tasks and no point meets an
    interval that lies elsewhere.
    """
    left = points.withColumn("_stretch", F.floor(F.col(at) / span))
    right = (spans.filter(F.col(lo) < F.col(hi)).withColumn("_g", F.col(group)).drop(group)
             .withColumn("_s", F.explode(F.sequence(F.floor(F.col(lo) / span), F.floor((F.col(hi) - 1) / span)))))
    met = left.join(right, (F.col(group) == F.col("_g")) & (F.col("_stretch") == F.col("_s")) & (F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi)))
    return met.drop("_stretch", "_s", "_g")
