"""Comment forests as adjacency tables with a materialised path.

Every node is one row keyed by ``(thread_id, path)`` where ``path`` is the
array of sibling positions from the thread root.  Arrays compare
lexicographically, so depth-first display order is a plain sort on ``path``
and "is in the subtree of" is a prefix test: no recursion is needed after
the flatten.

The flatten (J1) takes apart each response once, in the task that holds it; every
node leaves with its own fields only, so no reply is read or copied again for
each level above it.  Responses that may break a rule, and only these, are walked
level by level, where every violation is named.  Two operators loop on the
driver, one iteration per tree *level* (not per node or pointer): that walk and
the bottom-up nesting for output (J19).  Each level is a narrow explode or one
grouped join; levels are persisted and the lineage is cut with a reliable
checkpoint every few levels.
"""

from __future__ import annotations

import itertools
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.functions import coerce as C
from loomweave.operators import envelope as E
from loomweave.operators import intervals as I
from loomweave.operators import normalize as N
from loomweave.session import cut_lineage, setting, shuffles_removed, stored

CHECKPOINT_EVERY = 4

NODE_KEEP = ["response_id", "thread_id", "captured_at"]


# ---------------------------------------------------------------- J1 flatten
_LEVEL_EXPRS: dict = {}


def _level_exprs() -> tuple[list[Column], Column, Column]:
    """Column expressions of one flatten level, built once per JVM and reused.

    They depend only on column names, and building them costs hundreds of
    py4j calls, so every level (and every flatten) shares the same objects.
    """
    from pyspark import SparkContext

    key = SparkContext._active_spark_context.applicationId
    if key in _LEVEL_EXPRS:
        return _LEVEL_EXPRS[key]
    d = F.col("data")
    kind = F.col("kind")
    replies = F.col("_rep")          # extracted once per level (see _level_nodes)
    kids = F.col("_kids")
    path_txt = F.concat(F.lit("forest"), F.array_join(F.col("path").cast("array<string>"), "."))
    ptr_parent = C.string_or_null(d, "parent_id")
    count_t = C.vtype(C.get(d, "count"))
    # Objects are recognised with an O(1) struct cast; the type name is only
    # computed for scalars (schema_of_variant walks the whole nested value).
    replies_obj = C.is_object(replies)
    empty_string = (C.vtype(replies) == "STRING") & (F.try_variant_get(replies, "$", "string") == "")
    node_drift = (
        F.when(~kind.isin("t1", "more"), E.drift(F.concat(path_txt, F.lit(".kind")), "t1 or more"))
        .when((kind == "t1") & replies.isNull(),
              E.drift(F.concat(path_txt, F.lit(".data.replies")), "an empty string or a Listing"))
        .when((kind == "t1") & replies_obj,
              E.listing_violation(replies, "replies", child_kinds=("t1", "more"), children=kids))
        .when((kind == "t1") & ~empty_string,
              E.drift(F.concat(path_txt, F.lit(".data.replies")), "an empty string or a Listing"))
        .when((kind == "more") & ~(F.coalesce(ptr_parent.startswith("t1_")
                                               | ptr_parent.startswith("t3_"), F.lit(False))),
              E.drift(F.concat(path_txt, F.lit(".data.parent_id")), "a t1_ or t3_ fullname"))
        .when((kind == "more") & (F.coalesce(count_t, F.lit("")) != "BIGINT"),
              E.drift(F.concat(path_txt, F.lit(".data.count")), "an integer")))
    select = [*_node_cols(d, kind), F.when((kind == "t1") & replies_obj, kids).alias("_replies"), node_drift.alias("_drift")]
    thing = F.col("thing")
    child = (E.kind_of(thing).alias("kind"), C.get(thing, "data").alias("data"))
    pre = [F.col("*"), C.get(d, "replies").alias("_rep"),
           E.listing_children(C.get(d, "replies")).alias("_kids")]
    _LEVEL_EXPRS[key] = (pre, select, child, F.col("_replies"))
    return _LEVEL_EXPRS[key]


#: What a node's columns read, by the JSON types that count for each (see ``coerce.Sorted``).
TEXTS = ("id", "name", "permalink", "link_id", "subreddit", "parent_id", "author", "author_fullname", "body", "distinguished")
INTEGERS = ("score", "depth", "controversiality", "total_awards_received", "ups", "downs", "count")
NUMBERS = ("created_utc", "edited")
FLAGS = ("is_submitter", "stickied", "collapsed", "score_hidden")
_TEXT_KEYS = TEXTS + INTEGERS        # an integer may be written as a string


def _comment_name(d: Column | C.Sorted) -> Column:
    return C.fullname(C.text(d, "name"), "t1_", C.strip_prefix(C.text(d, "id"), "t1_"))


def _node_cols(d: Column | C.Sorted, kind: Column) -> list[Column]:
    """A node's columns, beside those given: path, parent_fullname, parent_cap_depth."""
    rec_depth = C.integer(d, "depth")
    cap_depth = F.coalesce(F.when(kind == "t1", rec_depth), F.col("parent_cap_depth"))
    return [
        *[F.col(c) for c in NODE_KEEP], kind, F.col("path"),
        (F.size("path") - 1).alias("depth"),
        F.slice("path", 1, F.size("path") - 1).alias("parent_path"),
        F.element_at("path", -1).alias("sib_pos"),
        F.col("parent_fullname"), F.when(kind == "t1", _comment_name(d)).alias("fullname"), cap_depth.alias("cap_depth"),
        F.when(kind == "more", C.string_or_null(d, "parent_id")).alias("ptr_parent_id"),
        F.when(kind == "more", C.integer(d, "count")).alias("ptr_count"),
        F.when(kind == "more", rec_depth).alias("ptr_depth"),
        *_comment_cols(d, kind)]


def _level_nodes(frontier: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One level: (normalised node rows, drift rows, next frontier, persisted stage).

    One projection per level, persisted: drift, node columns and the next
    level's replies are all evaluated once from the same rows.
    """
    pre, select, child, children = _level_exprs()
    staged = frontier.select(*pre).select(*select).persist(StorageLevel.MEMORY_AND_DISK)
    drift = staged.filter(F.col("_drift").isNotNull()).select(
        "response_id", F.col("_drift.path").alias("path"), F.col("_drift.expected").alias("expected"))
    ok = staged.filter(F.col("_drift").isNull())
    nxt = (ok.filter(F.col("_replies").isNotNull())
           .select(*NODE_KEEP, "path", F.col("fullname").alias("parent_fullname"),
                   F.col("cap_depth").alias("parent_cap_depth"),
                   F.posexplode(children).alias("pos", "thing"))
           .select(*NODE_KEEP, F.array_append("path", F.col("pos")).alias("path"),
                   "parent_fullname", "parent_cap_depth", *child))
    return ok.drop("_replies", "_drift"), drift, nxt, staged


def _comment_cols(d: Column | C.Sorted, kind: Column) -> list[Column]:
    """D2 fields (prefixed ``c_``) plus the raw vote counts the comment sorts use."""
    fields = [(n, c) for n, c in N.comment_fields(d) if n != "captured_at"]
    fields += [("ups", C.integer(d, "ups")), ("downs", C.integer(d, "downs"))]
    return [F.when(kind == "t1", c).alias(f"c_{n}") for n, c in fields]


def _children(v, kinds: tuple[str, ...]) -> list | None:
    """The children of a Listing of things of these kinds; None where anything is not as it must be."""
    d = v.get("data") if isinstance(v, dict) and v.get("kind") == "Listing" else None
    kids = d.get("children") if isinstance(d, dict) and isinstance(d.get("after"), str | None) else None
    if not isinstance(kids, list) or not all(isinstance(k, dict) and k.get("kind") in kinds and isinstance(k.get("data"), dict) for k in kids):
        return None
    return kids


def _is_long(x) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and -1 << 63 <= x < 1 << 63


#: Escaped surrogates: only a text that has them can hold one without its other half.
SURROGATE = re.compile(rb"\\u[dD][89a-fA-F]")


def _encodes(text: str | None) -> bool:
    try:
        return text is None or text.encode() is not None
    except UnicodeEncodeError:
        return False


def _sorted_values(d: dict) -> list | None:
    """A node's values in the order of ``NODE_VALUES``; None where a number is beyond double, as Python reads it."""
    get = d.get
    texts = [x if type(x := get(k)) is str else None for k in _TEXT_KEYS]
    whole = [x if type(x := get(k)) is int and -1 << 63 <= x < 1 << 63 else None for k in INTEGERS]
    numbers = []
    for k in NUMBERS:
        x = get(k)
        if type(x) is int:
            try:
                x = float(x)
            except OverflowError:
                return None
        elif type(x) is not float:
            x = None
        if x is not None and not math.isfinite(x):
            return None
        numbers.append(x)
    return [*texts, *whole, *numbers, *[x if type(x := get(k)) is bool else None for k in FLAGS]]


#: A node's interval among its thread's nodes and its subtree's weight; a comment's interval among the comments, and its parent's start there.
PLACES = ("entry", "exit", "weight", "t1_entry", "t1_exit", "t1_up")

#: What leaves a task for a node, with its type: place, kind, the parent's names and depths (see :func:`taken_apart`), own values by type.
NODE_VALUES = [("path", "array<int>"), ("kind", "string"), ("top", "boolean"), ("up_id", "string"), ("up_name", "string"), ("up_depth", "bigint"),
               ("up_depths", "array<string>"), *[(f"s_{k}", "string") for k in _TEXT_KEYS], *[(f"i_{k}", "bigint") for k in INTEGERS],
               *[(f"f_{k}", "double") for k in NUMBERS], *[(f"b_{k}", "boolean") for k in FLAGS],
               *[(k, "bigint") for k in PLACES]]
_ARROW = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def taken_apart(body: bytes, subtree: bool) -> list[list] | None:
    """The values of ``NODE_VALUES`` per node; None where a rule may be broken.

    ``up_depth`` is the nearest depth recorded above the node as a whole number, ``up_depths`` are those recorded
    nearer as strings, nearest first: each may be one, too.
    """
    try:
        response = json.loads(body.decode())
    except (ValueError, RecursionError):
        return None
    if not isinstance(response, list) or len(response) != 2:
        return None
    post, roots = _children(response[0], ("t3",)), _children(response[1], ("t1", "more"))
    if post is None or roots is None or len(post) != 1 or subtree and [k["kind"] for k in roots] != ["t1"]:
        return None
    halves = SURROGATE.search(body) is not None
    found, todo = [], [([], -1, roots, [True, None, None, None, None])]      # path, place in found, children, what they have from above
    ups = []
    while todo:
        above, at, kids, shared = todo.pop()
        for i, thing in enumerate(kids):
            d, path, kind = thing["data"], [*above, i], thing["kind"]
            replies = d.get("replies")
            if kind == "more":
                if not isinstance(d.get("parent_id"), str) or not d["parent_id"].startswith(("t1_", "t3_")) or not _is_long(d.get("count")):
                    return None
            elif replies != "":
                below = _children(replies, ("t1", "more"))
                if below is None:
                    return None
                ident, name, depth, near, strings = d.get("id"), d.get("name"), d.get("depth"), shared[3], shared[4]
                if _is_long(depth):
                    near, strings = depth, None
                elif isinstance(depth, str):
                    strings = [depth, *(strings or [])]
                todo.append((path, len(found), below, [False, ident if isinstance(ident, str) else None, name if isinstance(name, str) else None, near, strings]))
            own = _sorted_values(d)
            if own is None or halves and not all(map(_encodes, own[:len(_TEXT_KEYS)])):
                return None
            ups.append(at)
            found.append([path, kind, *shared, *own])
    return found if _add_places(found, ups) else None


_KIND, _COUNT = [[name for name, _ in NODE_VALUES].index(k) for k in ("kind", "i_count")]


def _add_places(found: list[list], ups: list[int]) -> bool:
    """Appends the values of ``PLACES``; ``ups`` are the parents' indexes (-1: none), which stand before their children's, siblings in order.

    False where a weight is beyond BIGINT.
    """
    n = len(found)
    comment = [x[_KIND] == "t1" for x in found]
    size, comments = [1] * n, [int(c) for c in comment]
    weight = [1 if c else x[_COUNT] for c, x in zip(comment, found)]
    for i in range(n - 1, -1, -1):
        up = ups[i]
        if up >= 0:
            size[up] += size[i]
            comments[up] += comments[i]
            weight[up] += weight[i]
    # where the next child of each node starts, among the nodes and among the comments; the last place stands for the post
    free, free_t1 = [0] * (n + 1), [0] * (n + 1)
    starts = [None] * (n + 1)
    for i, up in enumerate(ups):
        if not _is_long(weight[i]):
            return False
        entry, t1 = free[up], free_t1[up]
        free[up] = entry + size[i]
        free_t1[up] = t1 + comments[i]
        free[i] = entry + 1
        if comment[i]:
            starts[i], free_t1[i] = t1, t1 + 1
            found[i] += [entry, entry + size[i], weight[i], t1, t1 + comments[i], starts[up]]
        else:
            found[i] += [entry, entry + 1, weight[i], None, None, None]
    return True


def _placed(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``PLACES`` from the interval numbering of whole threads."""
    c = F.col
    comments = I.numbered(nodes.filter(c("kind") == "t1"))
    own = comments.select("thread_id", "path", c("entry").alias("t1_entry"), c("exit").alias("t1_exit"))
    up = comments.select("thread_id", c("path").alias("parent_path"), c("entry").alias("t1_up"))
    each = nodes.join(I.numbered(nodes, weight=_own_weight()), ["thread_id", "path"]).join(own, ["thread_id", "path"], "left")
    return each.join(up, ["thread_id", "parent_path"], "left").select(
        *nodes.columns, "entry", "exit", "weight",
        *[F.when(c("kind") == "t1", c(k)).alias(k) for k in ("t1_entry", "t1_exit", "t1_up")])


def _threads_numbered(nodes: DataFrame) -> DataFrame:
    """Threads that several responses hold are numbered as one; the numbers of the others hold as they are."""
    first = (F.size("path") == 1) & (F.element_at("path", 1) == 0)
    again = nodes.filter(first).groupBy("thread_id").agg(F.count("*").alias("_n")).filter("_n > 1").select("thread_id")
    if again.isEmpty():
        return nodes
    again = cut_lineage(again)
    return stored(nodes.join(again, "thread_id", "left_anti").unionByName(
        _placed(nodes.join(again, "thread_id", "left_semi").drop(*PLACES))).select(*nodes.columns), "forest")


APART_ROWS = 8192            # rows of an Arrow batch that leaves a task
APART_BODIES = 64            # responses of one that enters it: each is a whole thread


def _apart(subtree: bool):
    """Arrow batches of (kept columns, ok, body) -> a row per node, or one row with the body where a rule may be broken."""
    fields = [*NODE_VALUES, ("body", "binary")]
    names = [*NODE_KEEP, *[name for name, _ in fields]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.select(NODE_KEEP)
            ok, bodies = batch.column("ok"), batch.column("body")
            rows, nodes = [], []
            for i in range(batch.num_rows):
                body = bodies[i].as_py()
                found = taken_apart(body, subtree) if ok[i].as_py() else None
                if found is None:
                    found = [[None] * (len(fields) - 1) + [body]]
                else:
                    for n in found:
                        n.append(None)
                rows += [i] * len(found)
                nodes += found
                if len(rows) >= APART_ROWS or i + 1 == batch.num_rows:
                    for at in range(0, len(rows), APART_ROWS):
                        new = [pa.array(values, _ARROW[t]) for values, (_, t) in zip(zip(*nodes[at:at + APART_ROWS]), fields)]
                        yield pa.RecordBatch.from_arrays([*kept.take(pa.array(rows[at:at + APART_ROWS], pa.int64())).columns, *new], names=names)
                    rows, nodes = [], []
    return run


def flatten_post_responses(responses: DataFrame, subtree: bool = False
                           ) -> tuple[DataFrame, DataFrame]:
    """J1 + B4/B5/B6: post (or subtree) responses -> (nodes, drift).

    ``responses``: ``(response_id, captured_at, body)``.  A response with any
    violation contributes no nodes (fail closed) and one or more drift rows.
    A response that Spark reads as JSON and that follows every rule is taken apart at once, its nodes' values by
    their JSON types, and the record rules read those; the others, which may break one, go through
    :func:`flatten_by_level`, which decides and names the violations.
    """
    post = "$[0].data.children[0].data"
    v = F.col("v")
    ident = C.strip_prefix(C.text(v, f"{post}.id"), "t3_")
    read = E.parse_body(responses).select(
        "response_id", C.fullname(C.text(v, f"{post}.name"), "t3_", ident).alias("thread_id"), "captured_at",
        v.isNotNull().alias("ok"), F.col("body").cast("binary").alias("body"))
    kept = [(c, read.schema[c].dataType.simpleString()) for c in NODE_KEEP]
    apart = read.mapInArrow(_apart(subtree), ", ".join(f"{name} {t}" for name, t in [*kept, *NODE_VALUES, ("body", "binary")]))
    d, kind = C.Sorted(), F.col("kind")
    up_name = C.fullname(F.coalesce("up_name", F.lit("")), "t1_", C.strip_prefix(F.coalesce("up_id", F.lit("")), "t1_"))
    written = F.when(F.col("up_depths").isNotNull(), F.get(F.filter(F.transform("up_depths", C.digits), lambda x: x.isNotNull()), F.lit(0)))
    placed = apart.withColumns({
        "parent_fullname": F.when(F.col("top"), F.col("thread_id")).otherwise(up_name),
        "parent_cap_depth": F.coalesce(written, F.col("up_depth"), F.lit(0)).cast("bigint")})
    with setting(responses.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(APART_BODIES)), shuffles_removed(responses.sparkSession):
        rows = stored(placed.select(*_node_cols(d, kind), *PLACES, "body"), "apart")
    nodes = rows.filter(kind.isNotNull()).drop("body")
    doubtful = rows.filter(kind.isNull()).select("response_id", "captured_at", F.col("body").cast("string").alias("body"))
    if doubtful.isEmpty():
        return _threads_numbered(nodes), nodes.sparkSession.createDataFrame([], f"response_id {rows.schema['response_id'].dataType.simpleString()}, path string, expected string")
    walked, drift = flatten_by_level(doubtful, subtree)
    bad = drift.select("response_id").distinct()
    return _threads_numbered(stored(nodes.unionByName(walked).join(bad, "response_id", "left_anti"), "forest")), drift


def flatten_by_level(responses: DataFrame, subtree: bool = False) -> tuple[DataFrame, DataFrame]:
    """The same (nodes, drift), one level of all responses at a time."""
    df = E.parse_body(responses)
    arr = C.as_array(F.col("v"))
    first, second = F.element_at(arr, 1), F.element_at(arr, 2)
    post_kids = E.listing_children(first)
    root_kids = E.listing_children(second)
    post_data = C.get(F.element_at(post_kids, 1), "data")
    post_ident = C.strip_prefix(C.text(post_data, "id"), "t3_")
    thread_id = C.fullname(C.text(post_data, "name"), "t3_", post_ident)
    checks = [
        F.when(arr.isNull() | (F.size(arr) != 2), E.drift("response", "a two-element array")),
        E.listing_violation(first, "response[0]"),
        F.when((F.size(post_kids) != 1)
               | (F.coalesce(E.kind_of(F.element_at(post_kids, 1)), F.lit("")) != "t3"),
               E.drift("response[0].data.children", "exactly one t3 thing")),
        E.listing_violation(second, "response[1]", child_kinds=("t1", "more")),
    ]
    if subtree:
        checks.append(F.when((F.size(root_kids) != 1)
                             | (E.kind_of(F.element_at(root_kids, 1)) != "t1"),
                             E.drift("response[1].data.children", "exactly one t1 thing")))
    df = df.withColumn("_drift", F.coalesce(*checks)).withColumn("thread_id", thread_id)
    drift0 = df.filter(F.col("_drift").isNotNull()).select(
        "response_id", F.col("_drift.path").alias("path"), F.col("_drift.expected").alias("expected"))
    frontier = (df.filter(F.col("_drift").isNull())
                .select(*NODE_KEEP, F.col("thread_id").alias("parent_fullname"),
                        F.lit(0).cast("bigint").alias("parent_cap_depth"),
                        F.posexplode(root_kids).alias("pos", "thing"))
                .select(*NODE_KEEP, F.array(F.col("pos")).alias("path"), "parent_fullname",
                        "parent_cap_depth", E.kind_of(F.col("thing")).alias("kind"),
                        C.get(F.col("thing"), "data").alias("data")))
    levels, drifts, cached = [], [drift0], []
    for level in itertools.count():      # ends with the deepest comment
        frontier = frontier.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(frontier)
        if level and frontier.isEmpty():
            break
        nodes, drift, nxt, staged = _level_nodes(frontier)
        cached.append(staged)
        levels.append(nodes)
        drifts.append(drift)
        frontier = nxt
        if (level + 1) % CHECKPOINT_EVERY == 0:
            frontier = cut_lineage(frontier)
    nodes = levels[0]
    for extra in levels[1:]:
        nodes = nodes.unionByName(extra)
    drift = drifts[0]
    for extra in drifts[1:]:
        drift = drift.unionByName(extra)
    drift = cut_lineage(drift)
    bad = drift.select("response_id").distinct()
    nodes = stored(_placed(cut_lineage(nodes.join(bad, "response_id", "left_anti"))), "walked")
    for c in cached:
        c.unpersist()
    return nodes, drift


# ---------------------------------------------------------------- derived views
def comments_view(nodes: DataFrame, also: tuple[Column, ...] = ()) -> DataFrame:
    """D2 + D11: normalised comment rows with ``more_count`` of direct pointers, and the columns ``also`` of the nodes."""
    ptr = (nodes.filter(F.col("kind") == "more")
           .groupBy("thread_id", F.col("parent_path").alias("path"))
           .agg(F.sum("ptr_count").alias("more_count")))
    t1 = nodes.filter(F.col("kind") == "t1")
    out = t1.join(ptr, ["thread_id", "path"], "left")
    rename = [F.col(c).alias(c[2:]) for c in t1.columns if c.startswith("c_")]
    keep = [c for c in ("thread_id", "path", "parent_path", "sib_pos", "cap_depth",
                        "captured_at", "more_count", "response_id") if c in out.columns]
    return out.select(*keep, F.col("depth").alias("tree_depth"), *rename, *also)


def preorder(nodes: DataFrame, kinds=("t1",)) -> DataFrame:
    """Depth-first display rank per thread (sort by path).

    Range-partitioned rank: a thread holding a third of all comments is
    numbered by many tasks, not sorted in one.
    """
    from loomweave.operators.common import distributed_rank

    return distributed_rank(nodes.filter(F.col("kind").isin(*kinds)), ["thread_id"],
                            [F.col("path")], "display_rank")


def _own_weight() -> Column:
    """What a node stands for: a comment one, a pointer its hidden count."""
    return F.when(F.col("kind") == "t1", F.lit(1)).otherwise(F.coalesce("ptr_count", F.lit(0)))


def weighed(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their ``weight`` and ``comments_below``, which the flatten (J1) has already numbered."""
    if "weight" in nodes.columns:
        return nodes.withColumn("comments_below", F.coalesce(F.col("t1_exit") - F.col("t1_entry"), F.lit(0)))
    return nodes.join(subtree_weight(nodes), ["thread_id", "path"])


def subtree_weight(nodes: DataFrame) -> DataFrame:
    """J15 + J4: per node, t1 descendants (itself included) and hidden counts below: differences of prefix sums."""
    if "weight" in nodes.columns:
        return weighed(nodes).select("thread_id", "path", "weight", "comments_below").dropDuplicates(["thread_id", "path"])
    spans = I.numbered(nodes, weight=_own_weight(), comments_below=F.when(F.col("kind") == "t1", 1).otherwise(0))
    return spans.select("thread_id", "path", "weight", "comments_below")


# ---------------------------------------------------------------- J5-J7 anchor
def anchor(nodes: DataFrame, anchors: DataFrame, context: int = 0) -> tuple[DataFrame, DataFrame]:
    """The anchored comment's subtree, re-rooted ``context`` ancestors up.

    ``anchors``: ``(thread_id, comment_id)``; the id is case-folded (J5).  Rows
    with ``found = false`` carry the not-found verdict.  The subtrees come from
    an interval containment join: every node meets only the anchors above it.
    """
    if "entry" in nodes.columns:
        placed = nodes
        spans = nodes.select("thread_id", "path", "entry", "exit").dropDuplicates(["thread_id", "path"])
    else:
        spans = cut_lineage(I.numbered(nodes))
        placed = nodes.join(spans.select("thread_id", "path", "entry"), ["thread_id", "path"])
    t1 = nodes.filter(F.col("kind") == "t1").select(
        "thread_id", "path", F.lower(F.col("c_id")).alias("_cid"))
    a = anchors.select("thread_id", F.lower(F.col("comment_id")).alias("_cid"), "comment_id")
    found = a.join(t1, ["thread_id", "_cid"], "left")
    root_len = F.greatest(F.lit(1), F.size("path") - F.lit(context))
    roots = found.select("thread_id", "comment_id", F.col("path").isNotNull().alias("found"),
                         F.when(F.col("path").isNotNull(), F.slice("path", 1, root_len))
                         .alias("root_path"))
    places = spans.select("thread_id", F.col("path").alias("root_path"), F.col("entry").alias("_lo"), F.col("exit").alias("_hi"))
    wanted = roots.filter("found").join(places, ["thread_id", "root_path"])
    sub = I.contained(placed, wanted, "entry", "_lo", "_hi").drop("_lo", "_hi", *PLACES)
    missing = roots.filter(~F.col("found"))
    return sub, missing


# ---------------------------------------------------------------- J13/J14 cap
def cap(nodes: DataFrame, limit: int | None, max_depth: int | None = None) -> DataFrame:
    """Keep the first ``limit`` comments in preorder (and ``depth <= max_depth``).

    Returns kept nodes plus remainder pointers (``kind = 'more'``, ``synthetic = true``),
    one per parent whose list was cut, with the omitted weight: an omitted comment
    counts 1 plus everything below it, a pointer after the first cut sibling
    counts its own hidden count.  ``row_number() <= limit`` is planned with a
    group-limit before the shuffle, so a hot thread ships at most ``limit`` rows
    per map task to the ranking stage.
    """
    t1 = nodes.filter(F.col("kind") == "t1")
    if max_depth is not None:
        t1_ok = t1.filter(F.col("depth") <= max_depth)
    else:
        t1_ok = t1
    if limit is None:
        kept_t1 = t1_ok.select("thread_id", "path")
    else:
        w = Window.partitionBy("thread_id").orderBy("path")
        kept_t1 = (t1_ok.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= limit)
                   .select("thread_id", "path"))
    # A comment is kept only if its parent is kept too (depth cap cuts whole branches).
    kept_t1 = kept_t1.withColumn("_kept", F.lit(True))
    marked = weighed(nodes).join(kept_t1, ["thread_id", "path"], "left").withColumn(
        "_kept", F.coalesce("_kept", F.lit(False)))
    parents = kept_t1.select("thread_id", F.col("path").alias("parent_path"),
                             F.lit(True).alias("_parent_kept"))
    marked = marked.join(parents, ["thread_id", "parent_path"], "left").withColumn(
        "_parent_kept", F.coalesce("_parent_kept", F.size("parent_path") == 0))
    # First omitted comment position in each kept list.
    first_cut = (marked.filter((F.col("kind") == "t1") & ~F.col("_kept") & F.col("_parent_kept"))
                 .groupBy("thread_id", "parent_path").agg(F.min("sib_pos").alias("_cut_pos")))
    marked = marked.join(first_cut, ["thread_id", "parent_path"], "left")
    ptr_kept = ((F.col("kind") == "more") & F.col("_parent_kept")
                & (F.col("_cut_pos").isNull() | (F.col("sib_pos") < F.col("_cut_pos"))))
    keep_flag = F.col("_kept") | ptr_kept
    marked = marked.withColumn("_keep", keep_flag)
    # What is kept is closed upwards, so everything omitted below a kept list hangs under the list's own
    # omitted children: a comment counts with its whole subtree, a pointer with its hidden count.
    cut = marked.filter(~F.col("_keep") & F.col("_parent_kept"))
    remainder = cut.groupBy("thread_id", F.col("parent_path").alias("anc")).agg(F.sum("weight").alias("omitted"))
    # Remainder pointer: parent fullname, depth = the list depth of that parent.
    kept_nodes = marked.filter("_keep").drop("_kept", "_parent_kept", "_cut_pos", "_keep", "comments_below", *PLACES)
    parent_info = (kept_nodes.filter(F.col("kind") == "t1")
                   .select("thread_id", F.col("path").alias("anc"),
                           F.col("fullname").alias("_pf"), F.col("cap_depth").alias("_pd")))
    last_pos = (kept_nodes.groupBy("thread_id", F.col("parent_path").alias("anc"))
                .agg(F.max("sib_pos").alias("_last")))
    synth = (remainder.join(parent_info, ["thread_id", "anc"], "left")
             .join(last_pos, ["thread_id", "anc"], "left")
             .select("thread_id", F.col("anc").alias("parent_path"),
                     F.array_append("anc", F.coalesce(F.col("_last") + 1, F.lit(0))).alias("path"),
                     F.coalesce("_pf", "thread_id").alias("ptr_parent_id"),
                     F.col("omitted").cast("bigint").alias("ptr_count"),
                     F.when(F.size("anc") == 0, F.lit(0)).otherwise(F.col("_pd")).cast("bigint")
                     .alias("ptr_depth")))
    synth = synth.withColumn("kind", F.lit("more")).withColumn("synthetic", F.lit(True))
    return kept_nodes.withColumn("synthetic", F.lit(False)).unionByName(
        synth, allowMissingColumns=True)


def cap_truncated(capped: DataFrame) -> DataFrame:
    return capped.groupBy("thread_id").agg(F.max(F.col("synthetic").cast("int")).alias("truncated"))


# ---------------------------------------------------------------- J16 signature
def signature(nodes: DataFrame) -> DataFrame:
    """Order-sensitive tree signature without gathering a thread in one place.

    Each node contributes a 60-bit number from ``md5(path | identity)``: the
    path encodes the display position, the identity is the comment fullname or
    the pointer's (parent, count, depth).  The per-thread sum is an ordinary
    aggregate (combined map-side), so a hot thread is never one value.
    """
    item = F.when(F.col("kind") == "t1", F.col("fullname")).otherwise(F.concat_ws(
        "|", F.lit("more"), "ptr_parent_id", F.col("ptr_count").cast("string"),
        F.coalesce(F.col("ptr_depth").cast("string"), F.lit("null"))))
    key = F.concat_ws("|", F.array_join(F.col("path").cast("array<string>"), "."), item)
    h = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("decimal(38,0)")
    return nodes.groupBy("thread_id").agg(F.sum(h).cast("string").alias("signature"),
                                          F.count("*").alias("nodes"))


# ---------------------------------------------------------------- J18 verdict
def verdict(nodes_after: DataFrame, capped: DataFrame | None, limit: int | None,
            max_depth: int | None = None, dead: DataFrame | None = None, refused: DataFrame | None = None) -> DataFrame:
    """tree_complete / depth_capped / comment_limit / rate_limited / max_requests per thread, in the client's order.

    ``dead``: (thread_id, root) parents whose expansion brought nothing (J17);
    their pointers no longer count as expandable.  ``refused``: (thread_id) threads
    whose next request the site refused.
    """
    threads = nodes_after.select("thread_id").distinct()
    if dead is not None:
        nodes_after = nodes_after.join(
            dead.select("thread_id", F.col("root").alias("ptr_parent_id"), F.lit(True).alias("_dead")),
            ["thread_id", "ptr_parent_id"], "left")
    else:
        nodes_after = nodes_after.withColumn("_dead", F.lit(None).cast("boolean"))
    p = (nodes_after.groupBy("thread_id").agg(
        F.sum(F.when(F.col("kind") == "t1", 1).otherwise(0)).alias("comments"),
        F.sum(F.when(F.col("kind") == "more", 1).otherwise(0)).alias("pointers"),
        F.max(F.when((F.col("kind") == "more") & F.col("ptr_parent_id").startswith("t3_"), 1)
              .otherwise(0)).alias("t3_ptr"),
        F.max(F.when((F.col("kind") == "more") & F.col("ptr_parent_id").startswith("t1_")
                     & F.col("_dead").isNull()
                     & (F.lit(max_depth is None) | F.col("ptr_depth").isNull()
                        | (F.col("ptr_depth") < F.lit(max_depth if max_depth is not None else 0))),
                     1).otherwise(0)).alias("expandable")))
    out = threads.join(p, "thread_id", "left")
    if capped is not None:
        out = out.join(cap_truncated(capped), "thread_id", "left")
    else:
        out = out.withColumn("truncated", F.lit(0))
    if refused is not None:
        out = out.join(refused.select("thread_id").distinct().withColumn("_refused", F.lit(True)), "thread_id", "left")
    else:
        out = out.withColumn("_refused", F.lit(None).cast("boolean"))
    lim = F.lit(limit).cast("bigint")
    v = (F.when(F.lit(limit == 0), F.lit("comment_limit"))
         .when(F.col("truncated") == 1, F.lit("comment_limit"))
         .when(F.col("pointers") == 0, F.lit("tree_complete"))
         .when((F.col("expandable") == 0) & (F.col("t3_ptr") == 1), F.lit("comment_limit"))
         .when(F.col("expandable") == 0, F.lit("depth_capped"))
         .when(lim.isNotNull() & (F.col("comments") >= lim), F.lit("comment_limit"))
         .when(F.col("_refused"), F.lit("rate_limited"))
         .otherwise(F.lit("max_requests")))
    return out.withColumn("verdict", v).drop("_refused")


# ---------------------------------------------------------------- H: sibling order
def sibling_sort(nodes: DataFrame, sort: str) -> DataFrame:
    """H1-H8: ``new_pos`` among the siblings by the sort key, and the ``display_rank`` that follows from it.

    Pointers stay after their comment siblings.  The display order is rebuilt from
    subtree sizes: a node's rank is the sum, over itself and its ancestors, of one
    plus the sizes of the siblings sorted before.  ``entry``, ``exit`` and ``up`` (the
    parent's entry), where the nodes have them, must be their numbers among these nodes.
    """
    from loomweave.operators import listing as L

    c = F.col
    up = c("ups").cast("double")
    down = c("downs").cast("double")
    key = {
        "new": [c("created_at").desc_nulls_last()],
        "old": [c("created_at").asc_nulls_last()],
        "top": [c("score").desc_nulls_last()],
        "controversial": [L.controversy(up, down).desc()],
        "confidence": [L.wilson_lower(up, down).desc()],
        "best": [L.wilson_lower(up, down).desc()],
        "qa": [c("is_submitter").desc(), L.wilson_lower(up, down).desc()],
    }[sort]
    order = [F.when(c("kind") == "t1", 0).otherwise(1).alias("_k0"), *key,
             c("created_at").desc_nulls_last(), c("fullname").asc_nulls_last(), c("sib_pos")]
    if "up" in nodes.columns:
        sized, siblings = nodes, ["thread_id", "up"]
    else:
        spans = cut_lineage(I.numbered(nodes))
        parents = spans.select("thread_id", c("path").alias("parent_path"), c("entry").alias("up"))
        sized, siblings = nodes.join(spans, ["thread_id", "path"]).join(parents, ["thread_id", "parent_path"], "left"), ["thread_id", "parent_path"]
    # siblings in their new order: position, and how many nodes the earlier ones bring
    placed = stored(I.running_sums(sized, siblings, order, {"new_pos": F.lit(1), "_skip": c("exit") - c("entry")}), "siblings")
    links = placed.select("thread_id", c("entry").alias("node"), "up", (c("_skip") + 1).alias("value"))
    # a node is displayed so many places after its parent: the steps of all ancestors added up are its rank
    levels = placed.agg(F.max(F.size("path"))).first()[0] or 1
    ranks = I.fold_up(links, lambda above, below: above + below, levels)
    return (placed.join(ranks.select("thread_id", c("node").alias("entry"), c("value").alias("display_rank")), ["thread_id", "entry"])
            .withColumn("new_pos", c("new_pos").cast("int")).drop("entry", "exit", "up", "_skip"))


# ---------------------------------------------------------------- J19 nesting
def nest(nodes: DataFrame, head: Column, tail: Column, wrap_children, empty_children: str,
         keep_levels: bool = False, depth_col: str = "depth") -> DataFrame:
    """Bottom-up nesting, one grouped join per tree level.

    ``nodes`` needs ``thread_id, path, parent_path, sib_pos, depth, kind``.  A node's
    text is ``head || children || tail`` for t1 and ``head || tail`` otherwise,
    where ``children`` is ``wrap_children(joined child texts)`` or
    ``empty_children``.  Returns ``(thread_id, path, parent_path, sib_pos, depth,
    json)`` for top-level nodes, or for every node when ``keep_levels``.
    Groups are one parent's direct replies, never a whole thread.
    """
    staged = nodes.select("thread_id", "path", "parent_path", "sib_pos",
                          F.col(depth_col).alias("depth"), "kind",
                          head.alias("_head"), tail.alias("_tail"))
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    max_depth = staged.agg(F.max("depth")).first()[0]
    if max_depth is None:
        staged.unpersist()
        return staged.select("thread_id", "path", "parent_path", "sib_pos", "depth",
                             F.lit(None).cast("string").alias("json"))
    below = None
    done, cached = [], [staged]
    for i, d in enumerate(range(max_depth, -1, -1)):
        cur = staged.filter(F.col("depth") == d)
        if below is not None:
            kids = (below.groupBy("thread_id", F.col("parent_path").alias("path"))
                    .agg(F.array_sort(F.collect_list(F.struct("sib_pos", "json"))).alias("_kids")))
            cur = cur.join(kids, ["thread_id", "path"], "left")
            children = F.when(F.col("_kids").isNull(), F.lit(empty_children)).otherwise(
                wrap_children(F.array_join(F.transform("_kids", lambda x: x["json"]), ",")))
        else:
            children = F.lit(empty_children)
        text = F.when(F.col("kind") == "t1", F.concat("_head", children, "_tail")).otherwise(
            F.concat("_head", "_tail"))
        below = cur.select("thread_id", "path", "parent_path", "sib_pos", "depth", text.alias("json"))
        if (i + 1) % CHECKPOINT_EVERY == 0:
            below = cut_lineage(below)
        else:
            below = below.persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(below)
        if keep_levels:
            done.append(below)
    out = below
    if keep_levels:
        out = done[0]
        for extra in done[1:]:
            out = out.unionByName(extra)
    out = cut_lineage(out)
    for c in cached:
        c.unpersist()
    return out


LISTING_HEAD = '{"kind":"Listing","data":{"after":null,"children":['
LISTING_TAIL = "]}}"


def listing_wrap(joined: Column) -> Column:
    return F.concat(F.lit(LISTING_HEAD), joined, F.lit(LISTING_TAIL))


def json_without_close(obj: Column) -> Column:
    """``{...}`` -> ``{...`` so more keys can be appended."""
    return F.regexp_replace(obj, r"\}$", "")


def json_value(col: Column) -> Column:
    """JSON text of one scalar (``null`` for NULL)."""
    return F.coalesce(F.regexp_extract(F.to_json(F.array(col)), r"^\[(.*)\]$", 1), F.lit("null"))


def nested_comments(nodes: DataFrame) -> DataFrame:
    """J19 + A9: normalised comments as nested JSON, one row per top-level comment."""
    view = comments_view(nodes)
    cols = [n for n, _ in N.comment_fields(F.lit(None))]
    head_struct = []
    for n in cols:
        col = F.col(n)
        if n in ("created_at", "edited_at"):
            col = C.iso(col)
        head_struct.append(col.alias(n))
    head = F.concat(json_without_close(F.to_json(F.struct(*head_struct), {"ignoreNullFields": "false"})),
                    F.lit(',"replies":'))
    tail = F.concat(F.lit(',"more_count":'), F.coalesce(F.col("more_count").cast("string"), F.lit("null")),
                    F.lit(',"captured_at":'), json_value(C.iso(F.col("captured_at"))), F.lit("}"))
    staged = view.withColumn("kind", F.lit("t1"))
    return nest(staged, head, tail, lambda j: F.concat(F.lit("["), j, F.lit("]")), "[]",
                depth_col="tree_depth")
