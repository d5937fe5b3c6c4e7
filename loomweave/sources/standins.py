"""Capture stand-ins derived from the given tables.

The test tables hold no forum JSON, so each builder *encodes* base columns
into the raw envelope shapes (bronze rows with a JSON ``body``).  The real
decode/normalise operators then run on those bodies, and the DuckDB oracle
computes the expected answer straight from the base columns, so the decode
is genuinely exercised.  Every builder reads whole tables; work grows with
them.  Field types are varied by residue to exercise the strict coercions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.operators.common import blocked_running_count
from loomweave.session import cut_lineage, stored, table_path

# Fixed stand-in constants (shared with the oracle SQL).
EPOCH0 = 1704067200          # 2024-01-01T00:00:00Z
CAPTURED_AT = "2024-06-01 00:00:00"
PAGE_STEP = 9                # page p holds ranks 9(p-1)+1 .. 9(p-1)+10: one row overlaps
RANK_BLOCK = 4096            # block width for hot-run ranking


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def captured_at() -> F.Column:
    return F.to_timestamp(F.lit(CAPTURED_AT))


# t3 data object: per-residue type variation (see oracle for the expected values).
POST_DATA_SQL = f"""
named_struct(
  'id', CASE WHEN doc_id % 8 = 0 THEN cast(concat('t3_d', doc_id) as variant)
             ELSE cast(concat('d', doc_id) as variant) END,
  'name', CASE WHEN doc_id % 10 = 0 THEN NULL ELSE cast(concat('t3_d', doc_id) as variant) END,
  'permalink', concat('/r/', source, '/comments/d', doc_id, '/p/'),
  'url', CASE WHEN doc_id % 4 = 0 THEN concat('https://www.reddit.com/r/', source, '/comments/d', doc_id, '/p/')
              WHEN doc_id % 4 = 1 AND doc_id % 3 = 0 THEN NULL
              ELSE concat('https://ext.example.com/a/', md5(text)) END,
  'subreddit', source,
  'subreddit_name_prefixed', concat('r/', source),
  'author', concat('u', doc_id % 150),
  'author_fullname', CASE WHEN doc_id % 9 = 0 THEN NULL ELSE concat('t2_u', doc_id % 150) END,
  'title', substring(text, 1, 40),
  'selftext', text,
  'created_utc', {EPOCH0} + 60 * doc_id,
  'edited', CASE WHEN doc_id % 3 = 0 THEN parse_json('false')
                 WHEN doc_id % 3 = 1 THEN parse_json(cast({EPOCH0} + 60 * doc_id + 3600 as string) || '.5')
                 ELSE NULL END,
  'score', CASE WHEN doc_id % 11 = 0 THEN parse_json(cast(n_chars % 1000 - 200 as string) || '.5')
                WHEN doc_id % 5 = 0 THEN cast(concat(' ', cast(n_chars % 1000 - 200 as string), ' ') as variant)
                ELSE parse_json(cast(n_chars % 1000 - 200 as string)) END,
  'upvote_ratio', 0.5 + (doc_id % 10) * 0.05D,
  'num_comments', n_chars % 50,
  'num_crossposts', CASE WHEN doc_id % 7 = 0 THEN parse_json('true') ELSE parse_json(cast(doc_id % 3 as string)) END,
  'over_18', CASE WHEN toxic IS NULL THEN NULL
                  WHEN doc_id % 4 = 3 THEN parse_json('"yes"')
                  WHEN toxic = 1 THEN parse_json('true') ELSE parse_json('false') END,
  'spoiler', CASE WHEN doc_id % 6 = 0 THEN parse_json('"true"')
                  WHEN doc_id % 5 = 1 THEN parse_json('true') ELSE parse_json('false') END,
  'is_self', doc_id % 4 = 0,
  'is_video', false,
  'is_original_content', CASE WHEN quality IS NULL THEN NULL ELSE quality = 1 END,
  'stickied', doc_id % 17 = 0,
  'locked', coalesce(toxic = 1, false),
  'distinguished', CASE WHEN doc_id % 13 = 0 THEN parse_json('"moderator"') ELSE parse_json('null') END,
  'link_flair_text', lang,
  'domain', CASE WHEN doc_id % 4 = 0 THEN concat('self.', source) ELSE 'ext.example.com' END,
  'thumbnail', CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'default' END,
  'total_awards_received', doc_id % 4,
  'removed_by_category', CASE WHEN doc_id % 19 = 0 THEN 'moderator' ELSE NULL END,
  'post_hint', CASE WHEN doc_id % 5 = 2 THEN 'image' ELSE NULL END
)
"""


def post_things(spark: SparkSession, sf_dir: str, threads: DataFrame | None = None) -> DataFrame:
    """One t3 thing JSON per document: (run_id, doc_id, fullname, thing); with ``threads``, of their posts only."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    if threads is not None:
        docs = (docs.withColumn("thread_id", F.concat(F.lit("t3_d"), F.col("doc_id")))
                .join(threads.select("thread_id").distinct(), "thread_id", "left_semi").drop("thread_id"))
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("source").alias("run_id"), "doc_id",
                    F.concat(F.lit("t3_d"), F.col("doc_id")).alias("fullname"),
                    F.to_json(F.struct(F.lit("t3").alias("kind"),
                                       F.expr(POST_DATA_SQL).alias("data"))).alias("thing")))


def listing_pages(things: DataFrame, order_col: F.Column, size: int = 10) -> DataFrame:
    """Encode ranked things of each run as overlapping Listing pages (bronze).

    Page p holds ranks (size-1)(p-1)+1 .. (size-1)(p-1)+size, so the last row of a
    page repeats as the first row of the next one (exercises first-wins dedup).
    ``after`` is the last fullname when another page follows, else null.
    """
    step = size - 1
    ranked = blocked_running_count(things, ["run_id"], order_col, ["fullname"], RANK_BLOCK, "r")
    primary = ranked.select("run_id", "fullname", "thing",
                            (F.floor((F.col("r") - 1) / step) + 1).cast("bigint").alias("page_no"),
                            ((F.col("r") - 1) % step).cast("int").alias("pos"))
    repeat = (ranked.filter(((F.col("r") - 1) % step == 0) & (F.col("r") > 1))
              .select("run_id", "fullname", "thing",
                      ((F.col("r") - 1) / step).cast("bigint").alias("page_no"),
                      F.lit(step).cast("int").alias("pos")))
    entries = primary.unionByName(repeat)
    pages = entries.groupBy("run_id", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("pos", "thing", "fullname"))).alias("rows"),
        F.max("pos").alias("last_pos"))
    after = F.when(F.col("last_pos") == step, F.element_at("rows", -1)["fullname"])
    after_json = F.when(after.isNull(), F.lit("null")).otherwise(
        F.regexp_extract(F.to_json(F.array(after)), r"^\[(.*)\]$", 1))
    body = F.concat(F.lit('{"kind":"Listing","data":{"after":'), after_json,
                    F.lit(',"children":['),
                    F.array_join(F.transform("rows", lambda x: x["thing"]), ","),
                    F.lit("]}}"))
    return pages.select(
        F.concat_ws(":", "run_id", F.col("page_no").cast("string")).alias("response_id"),
        "run_id", "page_no", captured_at().alias("captured_at"),
        F.lit(200).alias("status"), F.lit("application/json; charset=UTF-8").alias("content_type"),
        body.alias("body"))


def post_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community listings sorted new (created desc = doc_id desc), 10 per page."""
    return listing_pages(post_things(spark, sf_dir), -F.col("doc_id"))


# ---------------------------------------------------------------- comment forests
# Thread of post t3_d<user_id>: the user's events in event_id order, k = 1, 2, ...
# Node k's parent is k' = floor((k-1)/3) (0 = the post), its sibling position is
# (k-1) % 3: a ternary heap, so depth and path are closed forms of k.
MAX_HEAP_DEPTH = 38
# Pointer captures only (expansion): threads with user_id % 5 = 0 show two comments,
# others 40; the rest hides behind pointers.
POINTER_CUT_SMALL = 2
POINTER_CUT = 40


def heap_depth_sql(k: str) -> str:
    return "(" + " + ".join(f"IF({k} > {(3 ** (d + 2) - 3) // 2}L, 1, 0)" for d in range(MAX_HEAP_DEPTH + 1)) + ")"


def heap_ancestor_sql(k: str, j: str) -> str:
    """j-th ancestor of heap node k (0 = the post)."""
    return f"CAST(floor(({k} - (pow(3, {j}) - 1) / 2) / pow(3, {j})) AS BIGINT)"


def heap_path_sql(k: str, depth: str) -> str:
    return (f"transform(sequence({depth}, 0, -1), j -> "
            f"CAST(pmod({heap_ancestor_sql(k, 'j')} - 1, 3) AS INT))")


COMMENT_DATA_SQL = """
named_struct(
  'id', concat('e', event_id),
  'name', CASE WHEN event_id % 10 = 0 THEN NULL ELSE concat('t1_e', event_id) END,
  'permalink', concat('/r/src', user_id % 20, '/comments/d', user_id, '/p/e', event_id, '/'),
  'link_id', concat('t3_d', user_id),
  'parent_id', CASE WHEN parent_k = 0 THEN concat('t3_d', user_id) ELSE concat('t1_e', parent_event_id) END,
  'subreddit', concat('src', user_id % 20),
  'author', concat('u', event_id % 150),
  'author_fullname', concat('t2_u', event_id % 150),
  'body', concat(event_type, ' ', props),
  'created_utc', unix_micros(cast(ts as timestamp)) / 1000000.0D,
  'edited', false,
  'score', CASE WHEN event_id % 6 = 0 THEN cast(cast(floor(value) - 5 as string) as variant)
                ELSE cast(cast(floor(value) - 5 as bigint) as variant) END,
  'ups', cast(floor(value) as bigint),
  'downs', event_id % 7,
  'depth', CASE WHEN event_id % 10 = 3 THEN NULL ELSE depth END,
  'is_submitter', event_id % 150 = user_id % 150,
  'stickied', event_type = 'signup',
  'distinguished', CASE WHEN event_type = 'purchase' THEN 'moderator' ELSE NULL END,
  'controversiality', event_id % 2,
  'collapsed', value > 45,
  'score_hidden', false,
  'total_awards_received', event_id % 3
)
"""


def event_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full adjacency of every thread (no JSON): one row per event."""
    ev = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value",
                                              "props")
    # ranked once: the sizes and the parents below read a few columns of it back
    ranked = stored(blocked_running_count(ev, ["user_id"], F.col("event_id"), [], RANK_BLOCK, "k"), "ranked")
    sizes = ranked.groupBy("user_id").agg(F.count("*").alias("n"))
    nodes = (ranked.join(sizes, "user_id")
             .withColumn("depth", F.expr(heap_depth_sql("k")).cast("int"))
             .withColumn("parent_k", F.floor((F.col("k") - 1) / 3).cast("bigint"))
             .withColumn("path", F.expr(heap_path_sql("k", "depth")))
             .withColumn("cut", F.when(F.col("user_id") % 5 == 0, F.lit(POINTER_CUT_SMALL))
                         .otherwise(F.lit(POINTER_CUT))))
    parents = ranked.select("user_id", F.col("k").alias("parent_k"),
                            F.col("event_id").alias("parent_event_id"))
    return (nodes.join(parents, ["user_id", "parent_k"], "left")
            .withColumn("thread_id", F.concat(F.lit("t3_d"), F.col("user_id")))
            .withColumn("fullname", F.concat(F.lit("t1_e"), F.col("event_id")))
            .withColumn("parent_path", F.slice("path", 1, F.col("depth")))
            .withColumn("sib_pos", F.element_at("path", -1))
            .withColumn("visible", F.col("k") <= F.col("cut")))


def forest_pointers(forest: DataFrame) -> DataFrame:
    """Pointer rows of the base capture: hidden nodes grouped by nearest visible ancestor."""
    anc = F.expr(f"element_at(filter(transform(sequence(1, depth + 1), j -> "
                 f"{heap_ancestor_sql('k', 'j')}), a -> a <= cut), 1)")
    hidden = forest.filter(~F.col("visible")).select("user_id", "thread_id", "cut", "n",
                                                     anc.alias("anc_k"))
    ptr = hidden.groupBy("user_id", "thread_id", "anc_k", "cut", "n").agg(
        F.count("*").alias("ptr_count"))
    anc_nodes = forest.select("user_id", F.col("k").alias("anc_k"), F.col("path").alias("anc_path"),
                              F.col("depth").alias("anc_depth"), F.col("fullname").alias("anc_name"))
    visible_kids = F.when(F.col("anc_k") == 0, F.least(F.lit(3), F.least("cut", "n"))).otherwise(
        F.greatest(F.lit(0), F.least(F.lit(3), F.least("cut", "n") - 3 * F.col("anc_k"))))
    return (ptr.join(anc_nodes, ["user_id", "anc_k"], "left")
            .select("user_id", "thread_id", "anc_k", "cut", "ptr_count",
                    F.coalesce("anc_path", F.array().cast("array<int>")).alias("parent_path"),
                    visible_kids.cast("int").alias("sib_pos"),
                    F.when(F.col("anc_k") == 0, F.col("thread_id")).otherwise(F.col("anc_name"))
                    .alias("ptr_parent_id"),
                    F.when(F.col("anc_k") == 0, F.lit(0)).otherwise(F.col("anc_depth") + 1)
                    .cast("bigint").alias("ptr_depth"))
            .withColumn("path", F.array_append("parent_path", F.col("sib_pos")))
            .withColumn("depth", (F.size("path") - 1).cast("int")))


def _comment_head() -> F.Column:
    data = F.to_json(F.expr(COMMENT_DATA_SQL))
    return F.concat(F.lit('{"kind":"t1","data":'), F.regexp_replace(data, r"\}$", ""),
                    F.lit(',"replies":'))


def _pointer_json() -> F.Column:
    return F.to_json(F.struct(F.lit("more").alias("kind"), F.struct(
        F.col("ptr_count").alias("count"), F.col("ptr_parent_id").alias("parent_id"),
        F.col("ptr_depth").alias("depth"), F.array().cast("array<string>").alias("children"))
        .alias("data")))


def _responses(spark, sf_dir, top: DataFrame, threads: DataFrame, id_prefix: str) -> DataFrame:
    """Wrap the text ``kids`` of all top-level children into ``[Listing[t3], Listing[children]]`` per key."""
    posts = post_things(spark, sf_dir, threads).select(F.col("fullname").alias("thread_id"), F.col("thing").alias("post_thing"))
    body = F.concat(F.lit('[{"kind":"Listing","data":{"after":null,"children":['),
                    F.col("post_thing"), F.lit(']}},{"kind":"Listing","data":{"after":null,"children":['),
                    F.col("kids"), F.lit("]}}]"))
    return (top.join(posts, "thread_id")
            .select(F.concat(F.lit(id_prefix), F.col("resp_key")).alias("response_id"),
                    captured_at().alias("captured_at"), body.alias("body"), "thread_id"))


def _nested_threads(nodes: DataFrame, keys: tuple[str, ...] = ("thread_id",)) -> DataFrame:
    """(keys, kids): the nested JSON of all of a key's comments and pointers, written in display order; ``depth`` counts from the top.

    A node is followed by its first reply, its next sibling or an ancestor's: the difference of depth tells which
    brackets open or close between the two.  So a thread, one value of its response anyway, is gathered once, and no
    reply's text is shuffled again for each level above it.
    """
    from loomweave.operators.forest import LISTING_HEAD, LISTING_TAIL

    order = F.array_sort(F.collect_list(F.struct("path", "depth", "kind", "head")))
    grouped = nodes.groupBy(*keys).agg(order.alias("_n"))

    def text(x, i):
        after = F.get("_n", i + 1)["depth"]
        open_ = F.when(x["kind"] != "t1", "").when(after > x["depth"], LISTING_HEAD).otherwise('""}}')
        close = F.when(after > x["depth"], "").otherwise(F.concat(
            F.repeat(F.lit(LISTING_TAIL + "}}"), x["depth"] - F.coalesce(after, F.lit(0))), F.when(after.isNull(), "").otherwise(",")))
        return F.concat(x["head"], open_, close)

    return grouped.select(*keys, F.array_join(F.transform("_n", text), "").alias("kids"))


def _capture_nodes(forest: DataFrame) -> DataFrame:
    vis = forest.filter("visible").select(
        "thread_id", "path", "parent_path", "sib_pos", "depth", F.lit("t1").alias("kind"),
        _comment_head().alias("head"), F.lit("}}").alias("tail"))
    ptr = forest_pointers(forest).select(
        "thread_id", "path", "parent_path", "sib_pos", "depth", F.lit("more").alias("kind"),
        _pointer_json().alias("head"), F.lit("").alias("tail"))
    return vis.unionByName(ptr)


_SHARED: dict = {}


def _shared(spark: SparkSession, sf_dir: str, name: str, build):
    """One checkpointed build per session and folder (both capture sets start from it)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def clear_shared() -> None:
    _SHARED.clear()


def _forest_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shared(spark, sf_dir, "event_forest", lambda: stored(event_forest(spark, sf_dir), "event-forest"))


def _comment_nodes(forest: DataFrame) -> DataFrame:
    return forest.select("thread_id", "path", "parent_path", "sib_pos", "depth", F.lit("t1").alias("kind"),
                         _comment_head().alias("head"), F.lit("}}").alias("tail"))


def full_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture per thread with every event of the table nested, no pointers."""
    forest = _forest_ranked(spark, sf_dir)
    top = _nested_threads(_comment_nodes(forest)).withColumn("resp_key", F.col("thread_id"))
    return _responses(spark, sf_dir, top, forest, "post:")


def post_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture per thread for expansion: visible comments nested, hidden ones behind pointers.

    Only the expansion queries and the pointer listing read it; subtree
    captures hold what it hides.
    """
    forest = _forest_ranked(spark, sf_dir)
    top = _nested_threads(_capture_nodes(forest)).withColumn("resp_key", F.col("thread_id"))
    return _responses(spark, sf_dir, top, forest, "post:")


def _subtree_roots(k: str, depth: str) -> F.Column:
    """``root_k``, a row each: of a node or its ancestors those that may have a pointer, shown with a child that is not (two at most)."""
    roots = f"filter(transform(sequence(0, greatest({depth}, 0)), j -> {heap_ancestor_sql(k, 'j')}), a -> a > 0 AND a <= cut AND 3 * a + 3 > cut)"
    return F.explode(F.expr(roots)).alias("root_k")


DEAD_END_RULE = 7            # parents whose event_id % 7 == 3 answer with nothing new


def subtree_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subtree capture per comment that has a pointer: its full replies.

    Parents with ``event_id % 7 == 3`` answer with exactly what is already
    visible (their pointer included): a dead end the expansion must detect.
    """
    forest = _forest_ranked(spark, sf_dir)
    pointers = forest_pointers(forest)
    targets = (pointers.filter(F.col("anc_k") > 0)
               .join(forest.select("user_id", F.col("k").alias("anc_k"), "event_id"), ["user_id", "anc_k"])
               .select("user_id", F.col("anc_k").alias("root_k"), "ptr_parent_id", (F.size("parent_path") - 1).alias("root_depth"),
                       (F.col("event_id") % DEAD_END_RULE == 3).alias("dead")))
    own = ["user_id", "thread_id", "path", "depth"]
    comments = forest.select(*own, F.lit("t1").alias("kind"), _comment_head().alias("head"), "visible", _subtree_roots("k", "depth"))
    hidden = pointers.select(*own, F.lit("more").alias("kind"), _pointer_json().alias("head"), F.lit(None).cast("boolean").alias("visible"),
                             _subtree_roots("anc_k", "depth - 1"))
    # a live answer holds every comment below its root, a stale one what the base capture shows there
    held = comments.unionByName(hidden).join(targets, ["user_id", "root_k"]).filter(
        F.when(F.col("dead"), F.coalesce("visible", F.lit(True))).otherwise(F.col("visible").isNotNull()))
    subtrees = _nested_threads(held.withColumn("depth", F.col("depth") - F.col("root_depth")), ("user_id", "root_k", "thread_id", "ptr_parent_id"))
    roots = subtrees.groupBy("thread_id", F.col("ptr_parent_id").alias("resp_key")).agg(
        F.array_join(F.array_sort(F.collect_list("kids")), ",").alias("kids"))
    return _responses(spark, sf_dir, roots, forest, "subtree:")


# ---------------------------------------------------------------- request log, identifiers, raw docs
TS_BLOCK_MICROS = 3_600_000_000   # one hour of events per ranking block


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response log per client (= user): the budget header model of the site.

    used = (n-1) % 100 + 1, remaining = 100 - used, reset = 600 - 6n % 600;
    header names vary in case; some rows lose a header or carry ``nan``.
    """
    ev = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ranked = blocked_running_count(ev, ["user_id"], F.unix_micros("ts"), ["event_id"],
                                   TS_BLOCK_MICROS, "seq")
    used = (F.col("seq") - 1) % 100 + 1
    remaining = F.when(F.col("event_id") % 17 == 0, F.lit("nan")).otherwise(
        (F.lit(100) - used).cast("string"))
    reset = (F.lit(600) - (F.col("seq") * 6) % 600).cast("string")
    entries = F.filter(F.array(
        F.struct(F.lit("X-Ratelimit-Remaining").alias("k"), remaining.alias("v")),
        F.struct(F.lit("x-ratelimit-reset").alias("k"), reset.alias("v")),
        F.struct(F.lit("X-RATELIMIT-USED").alias("k"),
                 F.when(F.col("event_id") % 13 != 0, used.cast("string")).alias("v"))),
        lambda e: e["v"].isNotNull())
    return ranked.select(
        F.col("user_id").alias("client"), "seq", "ts", "event_id",
        F.when((F.col("event_type") == "error") & (F.col("value") > 45), F.lit(429))
        .otherwise(F.lit(200)).alias("status"),
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], e["v"]))).alias("headers"))


IDENTIFIER_SQL = """
CASE page_id % 8
  WHEN 0 THEN url
  WHEN 1 THEN concat('https://', host, '/r/', lang, '_', page_id, '/')
  WHEN 2 THEN concat(lang, 'x+grp', page_id, CASE WHEN page_id % 3 = 0 THEN '+' ELSE '' END)
  WHEN 3 THEN concat('https://', host, '/user/u_', page_id)
  WHEN 4 THEN concat('https://', host, '/r/', lang, 'x/comments/K', hex(page_id), '/some_slug/')
  WHEN 5 THEN concat('https://', host, '/r/', lang, 'x/comments/K', hex(page_id), '/s/C', hex(page_id))
  WHEN 6 THEN concat('https://u:p@', host, '/r/abc')
  ELSE concat('  T3_K', hex(page_id), ' ')
END
"""
IDENTIFIER_KIND_SQL = """
CASE page_id % 8 WHEN 0 THEN 'subreddit' WHEN 1 THEN 'subreddit' WHEN 2 THEN 'subreddit_group'
  WHEN 3 THEN 'user' WHEN 4 THEN 'post' WHEN 5 THEN 'comment' WHEN 6 THEN 'subreddit' ELSE 'post' END
"""


def identifier_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]+)/", 1).alias("lang"))
    return pages.select("page_id", F.expr(IDENTIFIER_SQL).alias("raw"),
                        F.expr(IDENTIFIER_KIND_SQL).alias("resolver"))


RAW_DOC_SQL = """
to_json(named_struct(
  'id', event_id,
  'raw', named_struct(
     'Api-Key', concat('k', event_id),
     'selftext', repeat(concat(event_type, ' '), 1 + event_id % 9),
     'profile_dir', concat('/home/u', user_id),
     'title', event_type,
     'nested', named_struct('sessionId', concat('s', event_id),
                            'items', array(named_struct('accessToken', concat('t', event_id),
                                                        'note', props)))),
  'body', repeat('b', 50),
  'props', props))
"""


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select("event_id", F.expr(RAW_DOC_SQL).alias("doc"))


# ---------------------------------------------------------------- communities and users
def _num(col: str) -> F.Column:
    return F.coalesce(F.regexp_extract(col, r"([0-9]+)$", 1).try_cast("bigint"), F.lit(0))


COMMUNITY_DATA_SQL = f"""
named_struct(
  'id', concat('s', n),
  'name', concat('t5_s', n),
  'display_name', source,
  'display_name_prefixed', concat('r/', source),
  'title', concat('Community ', source, ' about ', lang),
  'public_description', concat('Posts in ', lang, ' and more'),
  'description', concat('A ', lang, ' board with ', n_docs, ' posts'),
  'subreddit_type', CASE WHEN n % 4 = 1 THEN 'restricted' ELSE 'public' END,
  'url', concat('/r/', source, '/'),
  'lang', lang,
  'community_icon', CASE WHEN n % 2 = 0 THEN concat('https://img.example.com/', source, '.png') ELSE '' END,
  'icon_img', concat('https://icon.example.com/', source, '.png'),
  'subscribers', CASE WHEN n % 5 = 2 THEN cast(cast(n_docs as string) as variant) ELSE cast(n_docs as variant) END,
  'created_utc', {EPOCH0} - 86400 * (n + 1),
  'over18', CASE WHEN n % 3 = 0 THEN true WHEN n % 3 = 1 THEN false ELSE NULL END,
  'quarantine', n % 7 = 6
)
"""

USER_DATA_SQL = f"""
named_struct(
  'id', CASE WHEN c_custkey % 8 = 0 THEN concat('t2_c', c_custkey) ELSE concat('c', c_custkey) END,
  'name', CASE WHEN c_custkey % 7 = 0 THEN concat('t2_c', c_custkey) ELSE concat('user_', c_custkey) END,
  'subreddit', named_struct('display_name', concat('u_user_', c_custkey)),
  'icon_img', CASE WHEN c_custkey % 2 = 0 THEN '' ELSE concat('https://icon.example.com/u', c_custkey, '.png') END,
  'snoovatar_img', concat('https://snoo.example.com/', c_custkey, '.png'),
  'created_utc', {EPOCH0} - 3600 * c_custkey,
  'link_karma', cast(floor(c_acctbal) as bigint),
  'comment_karma', CASE WHEN c_custkey % 4 = 0 THEN cast(cast(c_nationkey * 10 as string) as variant)
                        ELSE cast(c_nationkey * 10 as variant) END,
  'total_karma', cast(floor(c_acctbal) as bigint) + c_nationkey * 10,
  'is_gold', c_mktsegment = 'AUTOMOBILE',
  'is_mod', c_mktsegment = 'BUILDING',
  'is_employee', false,
  'verified', c_custkey % 3 = 0,
  'has_verified_email', c_custkey % 2 = 0,
  'accept_followers', true
)
"""


def community_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return (docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.min("lang").alias("lang"))
            .withColumn("n", _num("source")))


def community_things(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = community_rows(spark, sf_dir)
    return rows.select(F.lit("search:sr").alias("run_id"), "source", "n_docs",
                       F.concat(F.lit("t5_s"), F.col("n")).alias("fullname"),
                       F.to_json(F.struct(F.lit("t5").alias("kind"),
                                          F.expr(COMMUNITY_DATA_SQL).alias("data"))).alias("thing"))


def community_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community search captured as Listing pages (subscribers desc)."""
    return listing_pages(community_things(spark, sf_dir), -F.col("n_docs") * 100000 + _num("source"))


def user_things(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read(spark, sf_dir, "customer")
    return cust.select(F.lit("search:user").alias("run_id"), "c_custkey",
                       F.concat(F.lit("t2_c"), F.col("c_custkey")).alias("fullname"),
                       F.to_json(F.struct(F.lit("t2").alias("kind"),
                                          F.expr(USER_DATA_SQL).alias("data"))).alias("thing"))


def user_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_pages(user_things(spark, sf_dir), F.col("c_custkey"))


def community_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One "about" response per requested name: real ones, ``<name>_gone`` ghosts, drift."""
    things = community_things(spark, sf_dir).withColumn("n", _num("source"))
    real = things.select(F.col("source").alias("request"), "n",
                         F.when(F.col("n") % 6 == 5, F.lit('{"kind":"t3","data":{}}'))
                         .otherwise(F.col("thing")).alias("body"))
    ghosts = things.select(F.concat(F.col("source"), F.lit("_gone")).alias("request"), "n",
                           F.lit('{"kind":"Listing","data":{"after":null,"children":[]}}').alias("body"))
    return real.unionByName(ghosts).select(
        "request", F.concat(F.lit("about:"), F.col("request")).alias("response_id"),
        captured_at().alias("captured_at"), F.lit(200).alias("status"),
        F.lit("application/json").alias("content_type"), "body")


def user_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    things = user_things(spark, sf_dir)
    real = things.select(F.concat(F.lit("user_"), F.col("c_custkey")).alias("request"),
                         F.lit(200).alias("status"),
                         F.when(F.col("c_custkey") % 25 == 24, F.lit('{"kind":"Listing","data":{}}'))
                         .otherwise(F.col("thing")).alias("body"))
    ghosts = (things
              .select(F.concat(F.lit("ghost_"), F.col("c_custkey")).alias("request"),
                      F.lit(404).alias("status"), F.lit('{"message":"Not Found","error":404}').alias("body")))
    return real.unionByName(ghosts).select(
        "request", F.concat(F.lit("user-about:"), F.col("request")).alias("response_id"),
        captured_at().alias("captured_at"), "status", F.lit("application/json").alias("content_type"),
        "body")


# ---------------------------------------------------------------- media, drift, responses
MEDIA_POST_SQL = """
to_json(named_struct(
  'id', concat('m', page_id),
  'name', concat('t3_m', page_id),
  'url', CASE WHEN page_id % 10 = 9 THEN concat('ftp://files.example.com/', page_id) ELSE url END,
  'post_hint', CASE WHEN page_id % 5 IN (3, 4) THEN 'image' ELSE NULL END,
  'gallery_data', CASE WHEN page_id % 5 = 0 THEN named_struct('items', array(
      named_struct('media_id', 'gone'), named_struct('media_id', 'a'), named_struct('media_id', 'b'),
      named_struct('media_id', 'c'))) END,
  'media_metadata', CASE WHEN page_id % 5 = 0 THEN named_struct(
      'a', named_struct('s', named_struct('u', concat(url, '?x=1&amp;y=2'), 'x', 640, 'y', 480)),
      'b', named_struct('s', named_struct('u', '', 'x', 1, 'y', 1)),
      'c', named_struct('s', named_struct('u', concat(url, '#c'), 'x', 0, 'width', 320, 'y', 200))) END,
  'secure_media', CASE WHEN page_id % 5 = 1 THEN named_struct('reddit_video',
      named_struct('fallback_url', concat(url, '/video.mp4'), 'width', 0, 'height', 720)) END,
  'media', CASE WHEN page_id % 5 = 2 THEN named_struct('oembed', named_struct('width', 400, 'height', 300)) END,
  'media_embed', CASE WHEN page_id % 5 = 3 THEN parse_json('{}') END,
  'preview', CASE WHEN page_id % 5 IN (3, 4) THEN named_struct('images', array(named_struct('source',
      named_struct('url', url, 'width', 1024, 'height', 768)))) END
))
"""


def media_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return pages.select("page_id", F.expr(MEDIA_POST_SQL).alias("post"))


def drift_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-item listing response per document, broken by ``doc_id % 12``."""
    things = post_things(spark, sf_dir)
    ok = F.concat(F.lit('{"kind":"Listing","data":{"after":null,"children":['), F.col("thing"),
                  F.lit("]}}"))
    r = F.col("doc_id") % 12
    body = (F.when(r == 1, F.lit("<html><body>blocked</body></html>"))
            .when(r == 2, F.concat(F.lit("["), ok, F.lit("]")))
            .when(r == 3, F.regexp_replace(ok, '^\\{"kind":"Listing"', '{"kind":"listing"'))
            .when(r == 4, F.lit('{"kind":"Listing","data":[]}'))
            .when(r == 5, F.lit('{"kind":"Listing","data":{"children":{}}}'))
            .when(r == 6, F.regexp_replace(ok, '"after":null', '"after":7'))
            .when(r == 7, F.lit('{"kind":"Listing","data":{"children":["t3"]}}'))
            .when(r == 8, F.regexp_replace(ok, '"children":\\[\\{"kind":"t3"', '"children":[{"kind":"t9"'))
            .when(r == 9, F.lit('{"kind":"Listing","data":{"children":[{"kind":"t3","data":"x"}]}}'))
            .when(r == 10, F.regexp_replace(ok, '"children":\\[\\{"kind":"t3"', '"children":[{"kind":"t1"'))
            .when(r == 11, F.regexp_replace(ok, '\\]\\}\\}$',
                                            ',{"kind":"more","data":{"count":3,"parent_id":"t3_x"}}]}}'))
            .otherwise(ok))
    return things.select(F.col("doc_id"), F.concat(F.lit("drift:"), F.col("doc_id")).alias("response_id"),
                         F.col("run_id"), F.lit(1).cast("bigint").alias("page_no"),
                         captured_at().alias("captured_at"), body.alias("body"))


def event_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses for the classifier: status, content type, body and budget headers by rule."""
    ev = read(spark, sf_dir, "events")
    t = F.col("event_type")
    odd = F.col("event_id") % 2 == 1
    status = (F.when(t == "click", F.lit(429)).when((t == "error") & odd, F.lit(404))
              .when((t == "error") & ~odd, F.lit(403)).otherwise(F.lit(200)))
    ctype = F.when(t == "purchase", F.lit("text/html; charset=utf-8")).otherwise(
        F.lit("application/json; charset=UTF-8"))
    body = (F.when(t == "purchase", F.lit("<html>challenge</html>"))
            .when(t == "signup", F.when(odd, F.lit('"just a string"'))
                  .otherwise(F.lit('{"reason": "banned", "message": "Community is Banned"}')))
            .when((t == "view") & (F.col("event_id") % 5 == 0), F.lit("{not json"))
            .when((t == "view") & (F.col("event_id") % 5 == 1),
                  F.lit('{"error": 404, "message": "Page Not Found"}'))
            .otherwise(F.lit('{"kind":"Listing","data":{"after":null,"children":[]}}')))
    remaining = F.when(F.col("event_id") % 11 == 0, F.lit("0")).otherwise(F.lit("57"))
    headers = F.create_map(F.lit("X-Ratelimit-Remaining"), remaining,
                           F.lit("X-Ratelimit-Reset"), F.lit("120"), F.lit("X-Ratelimit-Used"), F.lit("43"))
    return ev.select("event_id", status.alias("status"), ctype.alias("content_type"),
                     body.alias("body"), headers.alias("headers"))
