"""Adaptive pointer expansion from captured subtree snapshots.

The reference expands one pointer per request, always the first one in display
order, so what an expansion reveals goes before older pointers that stand
later, dead ends cost a request, and the first cap reached stops the thread.
Here every thread advances in the same round: rounds = pointer nesting depth, not
pointer count, and each round is a handful of equi-joins keyed by
``(thread_id, fullname)``.  Snapshots that overlap are merged in the order of
their requests; the others commute.

Budgets are allocated afterwards: every expansion has a sort key that puts the
thread's expansions in the order of their requests, running sums over that order
give the requests and comments before each, and the expansions beyond a cap are
taken back (their rows go, the pointers they replaced return).

Ordering without renumbering: the working path ``opath`` is an array of int
arrays.  An existing sibling keeps ``[pos]``; comments added at a pointer take
``pointer_element ++ [round, snapshot_pos]`` (lexicographically between the
pointer's neighbours); additions to a list without a pointer go after its last
sibling.  Integer paths are rebuilt once at the end, by pointer doubling.
"""

from __future__ import annotations

import itertools

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.operators import intervals as I
from loomweave.session import cut_lineage


def _work(nodes: DataFrame) -> DataFrame:
    extra = [c for c in nodes.columns if c.startswith("c_")]
    return nodes.select(
        "thread_id", F.transform("path", lambda p: F.array(p)).alias("opath"), "kind", "fullname",
        "parent_fullname", "ptr_parent_id", "ptr_count", "ptr_depth", "cap_depth", *extra,
        F.lit(None).cast("string").alias("added_by"), F.lit(None).cast("string").alias("removed_by"))


def _parent_opath(col: str = "opath") -> Column:
    return F.slice(col, 1, F.size(col) - 1)


TRIED = "thread_id string, root string, key array<array<array<int>>>, added bigint, dead boolean"


def expand(nodes: DataFrame, snapshots: DataFrame, max_depth: int | None = None, max_requests: int | None = None,
           limit: int | None = None, answered: DataFrame | None = None, renumber: bool = True
           ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge subtree snapshots into the forest until no pointer can advance or a cap stops the thread.

    ``nodes``: flattened base capture (J1).  ``snapshots``: flattened subtree
    captures (J1 with ``subtree=True``); the snapshot root is the comment whose
    pointer was expanded.  Caps, all per thread: ``max_requests`` counts the
    post's own request and dead ends; ``limit`` is the number of comments at
    which no further request is made; ``answered`` (thread_id, answered) is how
    many requests were answered before the site refused one.  Returns ``(merged
    nodes with integer paths, expanded, dead_ends)``: the (thread, parent) pairs
    that advanced, and those whose snapshot brought nothing new (J17), which are
    never retried.
    """
    cur = _work(nodes)
    snap = snapshots.select(
        "response_id", "thread_id", F.col("path").alias("rpath"), "kind", "fullname", "ptr_parent_id",
        "ptr_count", "ptr_depth", "cap_depth", *[c for c in snapshots.columns if c.startswith("c_")])
    # One snapshot per (thread, root): the first captured wins.
    root_of = (snap.filter(F.size("rpath") == 1)
               .groupBy("thread_id", F.col("fullname").alias("root"))
               .agg(F.min("response_id").alias("response_id")))
    roots = root_of.select("thread_id", "root")
    snap = snap.join(root_of, ["thread_id", "response_id"]).drop("response_id")
    tried = nodes.sparkSession.createDataFrame([], TRIED)
    for rnd in itertools.count(1):      # a pointer is expanded or dead after its round, so rounds end
        ptrs = cur.filter((F.col("kind") == "more") & F.col("removed_by").isNull() & F.col("ptr_parent_id").startswith("t1_"))
        if max_depth is not None:
            ptrs = ptrs.filter(F.col("ptr_depth").isNull() | (F.col("ptr_depth") < max_depth))
        asked = (ptrs.select("thread_id", F.col("ptr_parent_id").alias("root"), "opath", "added_by")
                 .join(tried, ["thread_id", "root"], "left_anti").join(roots, ["thread_id", "root"], "left_semi")
                 .groupBy("thread_id", "root").agg(F.min(F.struct("opath", "added_by")).alias("p")))
        frontier = _keyed(asked, tried).persist()
        if frontier.isEmpty():
            frontier.unpersist()
            break
        merged, new_rows, now, held = _merge_round(cur, snap.join(frontier, ["thread_id", "root"]), frontier, rnd)
        cur = cut_lineage(merged)                       # computes the round's new rows once
        counts = new_rows.groupBy("thread_id", F.col("added_by").alias("root")).agg(
            F.sum(F.when(F.col("kind") == "t1", 1).otherwise(0)).alias("added"))
        tried = cut_lineage(tried.unionByName(now.join(counts, ["thread_id", "root"], "left").select(
            "thread_id", "root", "key", F.coalesce("added", F.lit(0)).alias("added"), F.col("added").isNull().alias("dead"))))
        for f in (new_rows, frontier, *held):
            f.unpersist()
    if max_requests is not None or limit is not None or answered is not None:
        cur, tried = _taken_back(cur, tried, nodes, max_requests, limit, answered)
    merged = cur.filter(F.col("removed_by").isNull()).drop("added_by", "removed_by")
    done, dead = (tried.filter(F.col("dead") == is_dead).select("thread_id", "root") for is_dead in (False, True))
    # ``renumber=False`` keeps the sortable ``opath``: enough for display order.
    return (_renumber(merged) if renumber else merged), done, dead


def _keyed(asked: DataFrame, tried: DataFrame) -> DataFrame:
    """(thread_id, root, key): ``key`` sorts a thread's expansions in the order of their requests.

    The next request goes to the first pointer shown.  A pointer revealed by another one is asked for
    after it, and before all that stand later than both; so its key is the pointers of its chain of
    revelations that stand later than all after them in the chain, and itself.
    """
    above = tried.select("thread_id", F.col("root").alias("_by"), F.col("key").alias("_key"))
    chained = asked.select("thread_id", "root", F.col("p.opath").alias("opath"), F.col("p.added_by").alias("_by")).join(
        above, ["thread_id", "_by"], "left")
    later = F.filter(F.coalesce("_key", F.array().cast("array<array<array<int>>>")), lambda x: x > F.col("opath"))
    return chained.select("thread_id", "root", F.concat(later, F.array("opath")).alias("key"))


def _taken_back(cur: DataFrame, tried: DataFrame, nodes: DataFrame, max_requests: int | None, limit: int | None,
                answered: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The state at the first cap: rows added later go, pointers removed later return."""
    shown = nodes.groupBy("thread_id").agg(F.sum(F.when(F.col("kind") == "t1", 1).otherwise(0)).alias("_shown"))
    turn = I.running_sums(tried, ["thread_id"], [F.col("key"), F.col("root")], {"_before": F.col("added"), "_k": F.lit(1)})
    turn = turn.join(shown, "thread_id")
    ok = F.lit(True)
    if max_requests is not None:
        ok = ok & (F.col("_k") + 2 <= max_requests)         # the post's own request is the first
    if limit is not None:
        ok = ok & (F.col("_shown") + F.col("_before") < limit)
    if answered is not None:
        turn = turn.join(answered.select("thread_id", "answered"), "thread_id", "left")
        ok = ok & (F.col("answered").isNull() | (F.col("_k") + 2 <= F.col("answered")))
    made = cut_lineage(turn.filter(ok).select("thread_id", "root", "key", "added", "dead"))
    added = made.select("thread_id", F.col("root").alias("added_by"), F.lit(True).alias("_a"))
    removed = made.select("thread_id", F.col("root").alias("removed_by"), F.lit(True).alias("_r"))
    back = (cur.join(added, ["thread_id", "added_by"], "left").filter(F.col("added_by").isNull() | F.col("_a"))
            .join(removed, ["thread_id", "removed_by"], "left")
            .withColumn("removed_by", F.when(F.col("_r"), F.col("removed_by"))).drop("_a", "_r"))
    return back, made


def _merge_round(cur: DataFrame, snap: DataFrame, frontier: DataFrame, rnd: int) -> tuple[DataFrame, DataFrame, DataFrame, tuple]:
    """One round of J10/J11/J12: (state, new rows, the part of ``frontier`` that was merged, other cached frames)."""
    live = cur.filter(F.col("removed_by").isNull())
    t1 = cur.filter(F.col("kind") == "t1").select("thread_id", "fullname", F.col("opath").alias("e_opath"))
    # Which snapshot comments already exist (first snapshot wins: existing fields kept).
    s = snap.join(t1, ["thread_id", "fullname"], "left")
    # Pointer identity among the existing pointers of the same thread.
    ptr_ids = (live.filter(F.col("kind") == "more")
               .select("thread_id", "ptr_parent_id", "ptr_count",
                       F.coalesce(F.col("ptr_depth"), F.lit(-1)).alias("_pd"))
               .distinct().withColumn("_ptr_exists", F.lit(True)))
    s = (s.withColumn("_pd", F.coalesce(F.col("ptr_depth"), F.lit(-1)))
         .join(ptr_ids, ["thread_id", "ptr_parent_id", "ptr_count", "_pd"], "left")
         .withColumn("exists", F.when(F.col("kind") == "t1", F.col("e_opath").isNotNull())
                     .otherwise(F.coalesce("_ptr_exists", F.lit(False))))
         .drop("_pd", "_ptr_exists").withColumn("_prp", F.slice("rpath", 1, F.size("rpath") - 1)))
    # The snapshot parent of every new node; where it exists already, the node is the top of an addition.
    parents = s.filter(F.col("kind") == "t1").select(
        "thread_id", "root", F.col("rpath").alias("_prp"), F.col("fullname").alias("parent_fullname"), F.col("exists").alias("_pe"),
        F.col("e_opath").alias("_po"))
    new = s.filter(~F.col("exists")).join(parents, ["thread_id", "root", "_prp"], "left")
    top = F.when(F.col("_pe"), F.struct(F.col("rpath").alias("top_rpath"), F.col("parent_fullname").alias("anc_name"), F.col("_po").alias("anc_opath")))
    # What exists is closed upwards, so an addition is the run of new nodes from its top to the next top in
    # depth-first order.  A window holds one snapshot, one response of the site.
    shown = Window.partitionBy("thread_id", "root").orderBy("rpath").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = new.withColumn("_top", F.last(top, ignorenulls=True).over(shown)).filter(F.col("_top").isNotNull())
    # Slot in the existing parent's list: its first pointer to that parent, else after the last child.
    kids = live.select("thread_id", _parent_opath().alias("anc_opath"),
                       F.element_at("opath", -1).alias("elem"), "kind", "ptr_parent_id")
    slot = (kids.groupBy("thread_id", "anc_opath").agg(
        F.min(F.when(F.col("kind") == "more", F.struct(F.col("elem").alias("e"),
                                                      F.col("ptr_parent_id").alias("p")))).alias("_first_ptr"),
        F.max(F.element_at("elem", 1)).alias("_last")))
    new = new.select("*", "_top.*").join(slot, ["thread_id", "anc_opath"], "left").persist(StorageLevel.MEMORY_AND_DISK)
    # Snapshots of one round that bring the same comment: the first in order is merged, the others wait a round.
    claims = (new.filter(F.col("kind") == "t1").groupBy("thread_id", "fullname")
              .agg(F.min(F.struct("key", "root")).alias("w"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
    late = (new.join(claims, ["thread_id", "fullname"]).filter(F.col("root") != F.col("w.root"))
            .select("thread_id", "root").distinct().persist())
    merging, now = new, frontier
    if not late.isEmpty():
        merging = new.join(late, ["thread_id", "root"], "left_anti")
        now = frontier.join(late, ["thread_id", "root"], "left_anti")
    ptr_slot = F.when(F.col("_first_ptr.p") == F.col("anc_name"), F.col("_first_ptr.e"))
    top_elem = F.concat(F.coalesce(ptr_slot, F.array(F.coalesce(F.col("_last") + 1, F.lit(0)))),
                        F.array(F.lit(rnd), F.element_at("top_rpath", -1)))
    # opath of a new node: anchor ++ [its top's element] ++ [[pos] ...] below it.
    tail = F.transform(F.slice("rpath", F.size("top_rpath") + 1, F.size("rpath")), lambda p: F.array(p))
    new_rows = merging.select(
        "thread_id", F.concat("anc_opath", F.array(top_elem), tail).alias("opath"), "kind", "fullname", "parent_fullname",
        "ptr_parent_id", "ptr_count", "ptr_depth", "cap_depth", *[c for c in snap.columns if c.startswith("c_")],
        F.col("root").alias("added_by"), F.lit(None).cast("string").alias("removed_by")).persist(StorageLevel.MEMORY_AND_DISK)
    # Lists that received additions lose the pointer whose slot was taken.
    used = (merging.filter((F.col("rpath") == F.col("top_rpath")) & ptr_slot.isNotNull())
            .groupBy("thread_id", F.concat("anc_opath", F.array(ptr_slot)).alias("opath"))
            .agg(F.min(F.struct("key", "root")).alias("_by")).select("thread_id", "opath", F.col("_by.root").alias("_by")))
    kept = cur.join(used, ["thread_id", "opath"], "left").withColumn("removed_by", F.coalesce("removed_by", "_by")).drop("_by")
    return kept.unionByName(new_rows, allowMissingColumns=True), new_rows, now, (new, late)


def _renumber(cur: DataFrame) -> DataFrame:
    """Integer sibling positions and paths from the sortable ``opath`` (once, at the end)."""
    from loomweave.operators.common import distributed_rank

    staged = cur.withColumn("_parent", _parent_opath()).withColumn("_elem", F.element_at("opath", -1))
    ranked = (distributed_rank(staged, ["thread_id", "_parent"], [F.col("_elem")], "_r")
              .withColumn("sib_pos", (F.col("_r") - 1).cast("int")).drop("_r"))
    links = ranked.select("thread_id", F.col("opath").alias("node"), F.when(F.size("_parent") > 0, F.col("_parent")).alias("up"),
                          F.array("sib_pos").alias("value"))
    levels = ranked.agg(F.max(F.size("opath"))).first()[0] or 1
    paths = I.fold_up(links, F.concat, levels).select("thread_id", F.col("node").alias("opath"), F.col("value").alias("path"))
    out = ranked.join(paths, ["thread_id", "opath"]).drop("_parent", "_elem")
    return (out.withColumn("depth", (F.size("path") - 1).cast("int"))
            .withColumn("parent_path", F.slice("path", 1, F.size("path") - 1)))
