"""Two snapshots of comment forests compared branch by branch.

Every node gets a hash of its whole subtree.  A node's own hash covers what it is, whose
child it is and at which place, so the set of a subtree's own hashes determines the subtree, and
the subtree's hash is their sum: the difference of two prefix sums of the interval numbering
(:mod:`loomweave.operators.intervals`), one sort however deep a tree is.  Branches whose hashes agree in
both snapshots are left out before any node is compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.operators import intervals as I
from loomweave.session import cut_lineage

PARTS = 3       # 31 bits each: their sums hold for 2^32 nodes a thread


def hashed(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """thread_id, branch (place of the top-level ancestor), node, parent, place, depth, own and tree hashes, size.

    ``nodes``: flattened forests with ``thread_id, path, kind, fullname, parent_fullname, ptr_count`` and
    the columns in ``payload``.  A pointer is named after the parent whose replies it hides.
    """
    c = F.col
    node = F.when(c("kind") == "t1", c("fullname")).otherwise(F.concat(F.lit("more:"), "parent_fullname"))
    body = F.to_json(F.struct(*payload, "ptr_count"), {"ignoreNullFields": "false"})
    staged = nodes.select("thread_id", "path", node.alias("node"), c("parent_fullname").alias("parent"),
                          F.element_at("path", -1).alias("place"), (F.size("path") - 1).alias("depth"), F.md5(body).alias("body"))
    parts = [F.xxhash64(F.lit(i), "node", "parent", "place", "body").bitwiseAND(F.lit((1 << 31) - 1)) for i in range(PARTS)]
    staged = cut_lineage(staged)
    spans = I.numbered(staged, **{f"h{i}": p for i, p in enumerate(parts)})
    return staged.join(spans, ["thread_id", "path"]).select(
        "thread_id", F.element_at("path", 1).alias("branch"), "node", "parent", "place", "depth", "body",
        F.concat_ws(".", *[c(f"h{i}").cast("string") for i in range(PARTS)]).alias("tree"), (c("exit") - c("entry")).alias("size"))


def snapshot_diff(old: DataFrame, new: DataFrame, payload: list[str]) -> DataFrame:
    """``(thread_id, node, depth, change, size_before, size_after)`` of every node that is not as it was.

    ``change``: ``added`` or ``removed`` (in one snapshot only), ``moved`` (another parent or place among its
    siblings), ``edited`` (another payload), or ``below`` when only its replies changed; the first that
    holds counts.  ``size`` counts the nodes of the subtree.  Threads in one snapshot only count whole.
    Of nodes that repeat in a thread (a client never stores one twice) every pair is compared.
    """
    a, b = cut_lineage(hashed(old, payload)), cut_lineage(hashed(new, payload))
    tops = lambda df: df.filter("depth = 0").select("thread_id", "branch", "tree", "size")
    same = cut_lineage(tops(a).join(tops(b), ["thread_id", "branch", "tree", "size"]).select("thread_id", "branch").distinct())
    a = a.join(same, ["thread_id", "branch"], "left_anti")
    b = b.join(same, ["thread_id", "branch"], "left_anti")
    keys = ["thread_id", "node"]
    was = a.select(*keys, *[F.col(x).alias(f"_{x}") for x in ("parent", "place", "depth", "body", "tree", "size")])
    both = was.join(b.drop("branch"), keys, "full_outer")
    change = (F.when(F.col("_tree").isNull(), "added").when(F.col("tree").isNull(), "removed")
              .when((F.col("parent") != F.col("_parent")) | (F.col("place") != F.col("_place")), "moved")
              .when(F.col("body") != F.col("_body"), "edited").when(F.col("tree") != F.col("_tree"), "below"))
    return both.select(*keys, F.coalesce("depth", "_depth").alias("depth"), change.alias("change"),
                       F.col("_size").alias("size_before"), F.col("size").alias("size_after")).filter(F.col("change").isNotNull())
