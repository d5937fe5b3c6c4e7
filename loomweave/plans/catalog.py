"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or captures Spark derives from them), runs
the operators end to end, and returns flat, typed, aliased columns so the
DuckDB oracle in :mod:`loomweave.plans.oracle` can compare value hashes:
timestamps are ISO-8601 text, doubles are rounded to 6 places, counts BIGINT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomweave.functions import coerce as C
from loomweave.operators import listing as L
from loomweave.sources import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = dt.datetime(2024, 1, 2, tzinfo=dt.UTC)
RISING_AS_OF = dt.datetime(2024, 1, 1, 12, tzinfo=dt.UTC)


def query(fn=None, *, name: str | None = None):
    def register(f):
        QUERIES[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


def _posts(spark: SparkSession, sf_dir: str, with_media: bool = True) -> DataFrame:
    return L.posts_from_pages(S.post_pages(spark, sf_dir), with_media)


def _listing_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("rank").cast("bigint").alias("rank"), "fullname", "subreddit",
                     C.iso(F.col("created_at")).alias("created_at"),
                     F.col("score").cast("bigint").alias("score"))


# ---------------------------------------------------------------- normalise
@query
def normalize_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured listing pages -> typed posts."""
    p = _posts(spark, sf_dir)
    out = []
    for name in p.columns:
        c = F.col(name)
        if name in ("created_at", "edited_at", "captured_at"):
            c = C.iso(c)
        elif name == "upvote_ratio":
            c = F.round(c, 6)
        elif name == "media":
            out.append(F.size(c).cast("bigint").alias("media_count"))
            continue
        out.append(c.alias(name))
    return p.select(*out)


# ---------------------------------------------------------------- listings
@query
def community_listing_new(spark, sf_dir):
    """G1 + H1 + F5: newest 20 of one community."""
    return _listing_out(L.community_listing(_posts(spark, sf_dir, False), ["src3"], "new", limit=20))


@query
def community_listing_top(spark, sf_dir):
    """G1 + H2 + F4: top of the day ending at AS_OF."""
    return _listing_out(L.community_listing(_posts(spark, sf_dir, False), ["src5"], "top", "day",
                                            limit=15, as_of=AS_OF))


@query
def community_listing_hot(spark, sf_dir):
    """G1 + H4."""
    return _listing_out(L.community_listing(_posts(spark, sf_dir, False), ["SRC7"], "hot", limit=15))


@query
def community_listing_rising(spark, sf_dir):
    """G1 + H5: last 24 h before an explicit as-of."""
    return _listing_out(L.community_listing(_posts(spark, sf_dir, False), ["src9"], "rising",
                                            limit=15, as_of=RISING_AS_OF))


@query
def community_listing_controversial(spark, sf_dir):
    """G1 + H6 over all time."""
    return _listing_out(L.community_listing(_posts(spark, sf_dir, False), ["src11"],
                                            "controversial", "all", limit=15))


@query
def combined_listing(spark, sf_dir):
    """G2 + F1 + F2: three communities, a date window forces ``new``."""
    since = dt.datetime(2024, 1, 1, 2, tzinfo=dt.UTC)
    until = dt.datetime(2024, 1, 1, 9, 30, tzinfo=dt.UTC)
    return _listing_out(L.community_listing(_posts(spark, sf_dir, False), ["src1", "src2", "src4"],
                                            "top", limit=30, since=since, until=until))


# ---------------------------------------------------------------- paged runs
def run_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter row per community run, derived from the run name's number."""
    n = F.coalesce(F.regexp_extract("run_id", r"([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    ts = lambda minutes: F.timestamp_seconds(F.lit(S.EPOCH0 + 60 * minutes))
    runs = S.read(spark, sf_dir, "documents").select(F.col("source").alias("run_id")).distinct()
    return runs.select(
        "run_id",
        F.when(n == 13, F.lit(0)).when(n % 4 == 0, 5).when(n % 4 == 1, 15).when(n % 4 == 2, 40)
        .cast("bigint").alias("lim"),
        F.when(n % 3 == 1, ts(600)).when(n % 3 == 2, ts(300)).alias("since"),
        F.when(n % 5 == 3, ts(900)).alias("until"),
        F.when(n % 6 == 5, F.lit(2)).cast("bigint").alias("max_requests"),
        n.alias("n"))


def _run_pages(spark, sf_dir):
    pages = S.post_pages(spark, sf_dir)
    n = F.coalesce(F.regexp_extract("run_id", r"([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    return pages.withColumn("status", F.when((n % 7 == 4) & (F.col("page_no") == 3), F.lit(429))
                            .otherwise(F.col("status")))


@query
def paged_run_items(spark, sf_dir):
    """Items each run keeps, in listing order."""
    items, _ = L.paged_run(_run_pages(spark, sf_dir), run_params(spark, sf_dir))
    return items.select("run_id", F.col("seq").cast("bigint").alias("seq"), "fullname",
                        C.iso(F.col("created_at")).alias("created_at"))


@query
def paged_run_audit(spark, sf_dir):
    """Stop reason, requests, since confirmation, exit status per run."""
    _, audit = L.paged_run(_run_pages(spark, sf_dir), run_params(spark, sf_dir))
    return L.run_summary(audit).select(
        "run_id", "items", "stop_reason", "requests_made", "since_target_crossed", "status",
        C.iso(F.col("oldest")).alias("oldest"), C.iso(F.col("newest")).alias("newest"), "summary")


def _mixed_runs(spark, sf_dir):
    """Posts and, after them, comments of each community as listing pages with budget headers, and the runs over them."""
    posts = S.post_things(spark, sf_dir).select("run_id", "fullname", "thing", (-F.col("doc_id")).alias("_o"))
    ev = S.read(spark, sf_dir, "events")
    name = F.concat(F.lit("t1_e"), F.col("event_id"))
    data = F.struct(F.concat(F.lit("e"), F.col("event_id")).alias("id"), name.alias("name"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_utc"))
    comments = ev.select(F.concat(F.lit("src"), F.col("user_id") % 20).alias("run_id"), name.alias("fullname"),
                         F.to_json(F.struct(F.lit("t1").alias("kind"), data.alias("data"))).alias("thing"), (F.col("event_id") + 1).alias("_o"))
    pages = S.listing_pages(posts.unionByName(comments), F.col("_o"))
    n = F.coalesce(F.regexp_extract("run_id", r"([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    head = F.create_map(F.lit("X-Ratelimit-Remaining"), (600 - F.col("page_no")).cast("string"), F.lit("x-ratelimit-used"), F.col("page_no").cast("string"),
                        F.lit("x-ratelimit-reset"), F.when(F.col("page_no") % 4 == 3, "soon").otherwise("30"))
    pages = pages.withColumn("headers", F.when(n % 5 != 2, head))
    params = pages.select("run_id").distinct().select(
        "run_id", F.when(n % 4 == 0, 5).when(n % 4 == 1, 15).when(n % 4 == 2, 40).cast("bigint").alias("lim"),
        F.lit(None).cast("timestamp").alias("since"), F.lit(None).cast("timestamp").alias("until"),
        F.when(n % 6 == 5, 2).otherwise(30).cast("bigint").alias("max_requests"))
    return pages, params


@query
def run_summaries(spark, sf_dir):
    """K1, K4, M5: runs over posts and comments; counts per kind, the budget that the last response left, one line a run."""
    pages, params = _mixed_runs(spark, sf_dir)
    items, audit = L.paged_run(pages, params, ("t3", "t1"))
    return L.run_summary_by_kind(items, audit, pages).select("run_id", "counts", "budget", "requests_made", "summary")


@query
def paged_run_counts(spark, sf_dir):
    """Rows seen before each request of these runs."""
    return L.paged_run(*_mixed_runs(spark, sf_dir), ("t3", "t1"), with_counts=True)[2]


@query
def paged_run_chain(spark, sf_dir):
    """Pages without numbers are chained by their cursors; in half of the runs page 4 points back to page 3."""
    pages = S.post_pages(spark, sf_dir)
    before = E.parse_body(pages).select("run_id", (F.col("page_no") + 1).alias("page_no"), E.listing_after(F.col("v")).alias("cursor"))
    shuffled = pages.join(before, ["run_id", "page_no"], "left")
    back = shuffled.filter("page_no = 3").select("run_id", F.col("cursor").alias("_back"))
    again = (F.substring(F.md5("run_id"), 1, 1) < "8") & (F.col("page_no") == 4)
    pointed = F.regexp_replace("body", r'^(\{"kind":"Listing","data":\{"after":)("[^"]*"|null)', F.concat(F.lit('$1"'), F.col("_back"), F.lit('"')))
    shuffled = shuffled.join(back, "run_id", "left").withColumn("body", F.when(again, pointed).otherwise(F.col("body")))
    shuffled = shuffled.drop("page_no", "_back").repartition("response_id")
    params = S.read(spark, sf_dir, "documents").select(F.col("source").alias("run_id")).distinct().select(
        "run_id", *[F.lit(None).cast(t).alias(n) for n, t in (("lim", "bigint"), ("since", "timestamp"), ("until", "timestamp"), ("max_requests", "bigint"))])
    _, audit = L.paged_run(L.chain_pages(shuffled), params)
    return audit.select("run_id", "items", "stop_reason", "requests_made", "status")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry query: thread summary per community.

    Posts decoded from listing captures joined to their flattened comment
    forests: threads, comments, deepest level and the hidden remainder still
    behind pointers.
    """
    from loomweave.operators import forest as FR

    posts = _posts(spark, sf_dir, False).select("fullname", "subreddit", "score")
    nodes, _ = FR.flatten_post_responses(S.full_responses(spark, sf_dir))
    per_thread = nodes.groupBy(F.col("thread_id").alias("fullname")).agg(
        F.sum(F.when(F.col("kind") == "t1", 1).otherwise(0)).alias("comments"),
        F.max("depth").alias("max_depth"),
        F.sum(F.coalesce("ptr_count", F.lit(0))).alias("hidden"))
    joined = posts.join(per_thread, "fullname", "left")
    return joined.groupBy("subreddit").agg(
        F.count("*").cast("bigint").alias("posts"),
        F.count("comments").cast("bigint").alias("threads"),
        F.sum(F.coalesce("comments", F.lit(0))).cast("bigint").alias("comments"),
        F.max("max_depth").cast("bigint").alias("max_depth"),
        F.sum(F.coalesce("hidden", F.lit(0))).cast("bigint").alias("hidden"),
        F.sum(F.coalesce("score", F.lit(0))).cast("bigint").alias("score_sum"))


# ---------------------------------------------------------------- comment forests
from loomweave.operators import forest as FR  # noqa: E402


_MEMO: dict = {}


def memo(spark, sf_dir, name, build):
    """Reuse a checkpointed intermediate within one session and table folder.

    The stand-in captures and their flattened forests are reliable checkpoints
    (files in the shared checkpoint folder); several queries start from them,
    so they are built once per session.  ``clear_memo`` forces a rebuild (the
    benchmark clears it before every query so each timing includes the build).
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def clear_memo() -> None:
    _MEMO.clear()
    S.clear_shared()


def _forest(spark, sf_dir):
    """Flattened captures that hold every comment."""
    return memo(spark, sf_dir, "forest", lambda: FR.flatten_post_responses(S.full_responses(spark, sf_dir))[0])


def _pointed(spark, sf_dir):
    """Flattened captures that hide comments behind pointers, for expansion."""
    return memo(spark, sf_dir, "pointed", lambda: FR.flatten_post_responses(S.post_responses(spark, sf_dir))[0])


def _path_txt(col: str = "path"):
    return F.array_join(F.col(col).cast("array<string>"), ".")


@query
def normalize_comments(spark, sf_dir):
    """J1 + D2 + D11: nested captures -> flat typed comments with ``more_count``."""
    v = FR.comments_view(_forest(spark, sf_dir))
    cols = []
    for name, _ in FR.N.comment_fields(F.lit(None)):
        c = F.col(name)
        if name in ("created_at", "edited_at"):
            c = C.iso(c)
        elif name in ("score", "depth", "controversiality", "total_awards"):
            c = c.cast("bigint")
        cols.append(c.alias(name))
    return v.select("thread_id", *cols, F.col("tree_depth").cast("bigint").alias("tree_depth"),
                    F.col("more_count").cast("bigint").alias("more_count"),
                    C.iso(F.col("captured_at")).alias("captured_at"))


@query
def forest_flatten(spark, sf_dir):
    """Every node and pointer with its materialised path."""
    n = _forest(spark, sf_dir)
    return n.select("thread_id", "kind", _path_txt().alias("path"),
                    F.col("depth").cast("bigint").alias("depth"),
                    "parent_fullname", "fullname", F.col("ptr_count").cast("bigint").alias("ptr_count"),
                    F.col("ptr_depth").cast("bigint").alias("ptr_depth"))


@query
def forest_preorder(spark, sf_dir):
    """Depth-first display rank of every comment per thread."""
    n = FR.preorder(_forest(spark, sf_dir).select("thread_id", "path", "kind", "fullname"))
    return n.select("thread_id", "fullname", F.col("display_rank").cast("bigint").alias("display_rank"))


@query
def forest_depth_counts(spark, sf_dir):
    """Comments, pointers and hidden counts per thread and depth."""
    n = _forest(spark, sf_dir)
    return n.groupBy("thread_id", F.col("depth").cast("bigint").alias("depth")).agg(
        F.sum(F.when(F.col("kind") == "t1", 1).otherwise(0)).cast("bigint").alias("comments"),
        F.sum(F.when(F.col("kind") == "more", 1).otherwise(0)).cast("bigint").alias("pointers"),
        F.sum(F.coalesce("ptr_count", F.lit(0))).cast("bigint").alias("hidden"))


@query
def forest_subtree_weight(spark, sf_dir):
    """Per comment, comments in its subtree and its remainder weight."""
    n = _forest(spark, sf_dir)
    return FR.weighed(n).filter(F.col("kind") == "t1").select(
        "thread_id", "fullname", F.col("comments_below").cast("bigint").alias("comments_below"),
        F.col("weight").cast("bigint").alias("weight"))


@query
def forest_pointers(spark, sf_dir):
    """Pointers in display order (top-level pointers kept visible)."""
    n = _pointed(spark, sf_dir).select("thread_id", "path", "kind", "ptr_parent_id", "ptr_count", "ptr_depth")
    ranked = FR.preorder(n, kinds=("t1", "more"))
    return ranked.filter(F.col("kind") == "more").select(
        "thread_id", _path_txt().alias("path"), "ptr_parent_id",
        F.col("ptr_count").cast("bigint").alias("ptr_count"),
        F.col("ptr_depth").cast("bigint").alias("ptr_depth"),
        F.col("display_rank").cast("bigint").alias("display_rank"))


@query
def forest_cap(spark, sf_dir):
    """First 20 comments per thread plus honest remainder pointers."""
    capped = FR.cap(_forest(spark, sf_dir), 20)
    return capped.select("thread_id", "kind", _path_txt().alias("path"), "fullname",
                         "ptr_parent_id", F.col("ptr_count").cast("bigint").alias("ptr_count"),
                         F.col("ptr_depth").cast("bigint").alias("ptr_depth"), "synthetic")


@query
def forest_depth_cap(spark, sf_dir):
    """Depth cap 1 (comments at depth 0 and 1) with remainder pointers."""
    capped = FR.cap(_forest(spark, sf_dir), None, max_depth=1)
    return capped.select("thread_id", "kind", _path_txt().alias("path"), "fullname",
                         "ptr_parent_id", F.col("ptr_count").cast("bigint").alias("ptr_count"),
                         F.col("ptr_depth").cast("bigint").alias("ptr_depth"), "synthetic")


@query
def forest_anchor(spark, sf_dir):
    """Anchored subtrees with one ancestor of context, plus not-found anchors."""
    n = _forest(spark, sf_dir)
    ev = S.read(spark, sf_dir, "events")
    # Request list: every purchase event's comment id (upper-cased: matching is case-folded).
    anchors = ev.filter(F.col("event_type") == "purchase").select(
        F.concat(F.lit("t3_d"), F.col("user_id")).alias("thread_id"),
        F.upper(F.concat(F.lit("e"), F.col("event_id"))).alias("comment_id"))
    sub, missing = FR.anchor(n, anchors, context=1)
    found = sub.select("comment_id", F.lit(True).alias("found"), "thread_id",
                       F.col("kind"), _path_txt().alias("path"), "fullname")
    lost = missing.select("comment_id", F.lit(False).alias("found"), "thread_id",
                          F.lit(None).cast("string").alias("kind"),
                          F.lit(None).cast("string").alias("path"),
                          F.lit(None).cast("string").alias("fullname"))
    return found.unionByName(lost)


def _sorted_comments(spark, sf_dir, sort):
    n = FR.comments_view(_forest(spark, sf_dir), also=(F.col("t1_entry").alias("entry"), F.col("t1_exit").alias("exit"), F.col("t1_up").alias("up")))
    n = n.select("thread_id", "path", "sib_pos", F.lit("t1").alias("kind"), "created_at", "score", "ups", "downs", "is_submitter", "fullname",
                 "entry", "exit", "up")
    return FR.sibling_sort(n, sort).select(
        "thread_id", "fullname", F.col("new_pos").cast("bigint").alias("sibling_rank"),
        F.col("display_rank").cast("bigint").alias("display_rank"))


for _sort in ("confidence", "top", "new", "old", "controversial", "qa"):
    def _make(sort):
        def fn(spark, sf_dir):
            return _sorted_comments(spark, sf_dir, sort)
        fn.__name__ = f"comment_sort_{sort}"
        fn.__doc__ = f"H1-H8: siblings ordered by ``{sort}``, display order rebuilt."
        return fn
    query(_make(_sort))


@query
def thread_nested_json(spark, sf_dir):
    """One nested JSON document per top-level comment (rows-only check)."""
    nested = FR.nested_comments(_forest(spark, sf_dir))
    return nested.select("thread_id", F.col("sib_pos").cast("bigint").alias("position"), "json")


# ---------------------------------------------------------------- identifiers
from loomweave.functions import identifiers as ID  # noqa: E402
from loomweave.functions import pii as PII  # noqa: E402
from loomweave.functions import redact as R  # noqa: E402
from loomweave.operators import json_tree as JT  # noqa: E402
from loomweave.operators import budget as B  # noqa: E402

TEST_HOSTS = ID.Hosts(suffixes=("example.com", "example.net", "example.org"))


@query
def resolve_identifiers(spark, sf_dir):
    """Raw identifiers (URLs, paths, names, ids) -> typed keys or an error."""
    inp = ID.resolve_df(S.identifier_inputs(spark, sf_dir), "resolver", "raw", TEST_HOSTS)
    r = F.col("resolved")
    return inp.select("page_id", "resolver", r["kind"].alias("kind"),
                      r["community"].alias("community"), r["post_id"].alias("post_id"),
                      r["comment_id"].alias("comment_id"), r["error"].alias("error"))


@query
def resolve_permalinks(spark, sf_dir):
    """Permalinks of posts and comments told apart, every refusal present."""
    d, r = S.read(spark, sf_dir, "documents"), F.col("doc_id") % 8
    host, sub, pid = F.lit("https://www.example.com/r/"), F.coalesce("source", F.lit("none")), F.hex("doc_id")
    post = F.concat(host, sub, F.lit("/comments/K"), pid)
    raw = (F.when(r == 1, F.concat(post, F.lit("/some_title/C"), pid, F.lit("/"))).when(r == 2, F.replace(post, F.lit("www."), F.lit("user:pw@www.")))
           .when(r == 3, F.replace(post, F.lit("www.example.com"), F.lit("other.invalid"))).when(r == 4, F.concat(host, sub))
           .when(r == 5, F.concat(post, F.lit("!/"))).when(r == 6, F.concat(post, F.lit("/t/c/d"))).when(r == 7, F.concat(F.lit("K"), pid)).otherwise(F.concat(post, F.lit("/t/"))))
    out = ID.resolve_df(d.select("doc_id", raw.alias("raw"), F.lit("permalink").alias("resolver")), "resolver", "raw", TEST_HOSTS)
    got = F.col("resolved")
    return out.select("doc_id", got["kind"].alias("kind"), got["community"].alias("community"), got["post_id"].alias("post_id"),
                      got["comment_id"].alias("comment_id"), got["error"].alias("error"))


# ---------------------------------------------------------------- redaction
@query
def scrub_values(spark, sf_dir):
    """Strings that the caller names are cut, the longest first, beside credentials and paths."""
    d = S.read(spark, sf_dir, "documents").select("doc_id", F.concat(
        F.lit("run "), F.coalesce("source", F.lit("none")), F.lit(" in /home/u"), "doc_id", F.lit("/x with token=t"), "doc_id").alias("text"))
    return d.select("doc_id", R.substitute(F.col("text"), ["src1", "src12", "src1", "", None]).alias("scrubbed"))


@query
def redact_all(spark, sf_dir):
    """L4: whole records redacted, ids that repeat kept apart."""
    docs = S.raw_documents(spark, sf_dir).select((F.col("event_id") % 7).alias("id"), "doc")
    docs = JT.redact(docs, "id", "doc", raw_only=False)
    g = lambda p: F.get_json_object("doc", p)
    return docs.select(F.col("id").cast("bigint").alias("id"), g("$.raw.Api-Key").alias("api_key"),
                       g("$.raw.selftext").alias("selftext"), g("$.raw.title").alias("title"),
                       g("$.raw.nested.items[0].accessToken").alias("item_token"),
                       g("$.raw.nested.items[0].note").alias("item_note"), g("$.body").alias("body"))


@query
def redact_raw(spark, sf_dir):
    """Redact only ``raw`` attachments of JSON records, at any depth."""
    docs = JT.redact(S.raw_documents(spark, sf_dir), "event_id", "doc").withColumnRenamed("id", "event_id")
    g = lambda p: F.get_json_object("doc", p)
    return docs.select("event_id", g("$.raw.Api-Key").alias("api_key"),
                       g("$.raw.selftext").alias("selftext"), g("$.raw.profile_dir").alias("profile_dir"),
                       g("$.raw.title").alias("title"), g("$.raw.nested.sessionId").alias("session"),
                       g("$.raw.nested.items[0].accessToken").alias("item_token"),
                       g("$.raw.nested.items[0].note").alias("item_note"), g("$.body").alias("body"))


@query
def scrub_text(spark, sf_dir):
    """credential/path scrub of whole documents and planted conversation turns."""
    docs = S.read(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id")).alias("key"), F.col("text"))
    conv = S.read(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv:"), F.col("conv_id"), F.lit(":"), F.col("turn")).alias("key"),
        F.concat(F.col("text"), F.lit(" token="), F.col("conv_id"), F.lit("abc path /home/u"),
                 F.col("turn"), F.lit("/x and C:\\Users\\u"), F.col("turn"),
                 F.lit(" Bearer t"), F.col("conv_id"), F.lit(" ?session_id=q"), F.col("turn"),
                 F.lit("&x=1")).alias("text"))
    both = docs.unionByName(conv)
    return both.select("key", R.scrub_usage_error(F.col("text")).alias("scrubbed"),
                       R.scrub_diagnostic(F.col("text")).alias("bounded"))


# ---------------------------------------------------------------- PII scan
@query
def pii_findings(spark, sf_dir):
    """Value-free categories per document, in the fixed order."""
    docs = S.read(spark, sf_dir, "documents")
    cats = docs.select("doc_id", F.posexplode(PII.text_categories(F.col("text"))).alias("ord", "category"))
    return cats.select("doc_id", "category", F.col("ord").cast("bigint").alias("ord"))


@query
def pii_entropy(spark, sf_dir):
    """32+ character tokens per document and their highest entropy."""
    docs = S.read(spark, sf_dir, "documents")
    toks = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(PII.TOKEN_RE), 0))
                       .alias("token"))
    return toks.groupBy("doc_id").agg(
        F.count("*").cast("bigint").alias("tokens"),
        F.round(F.max(PII.shannon_entropy(F.col("token"))), 6).alias("max_entropy"),
        F.sum(F.when(PII.has_synthetic_marker(F.col("token")), 1).otherwise(0)).cast("bigint")
        .alias("synthetic"))


# ---------------------------------------------------------------- budget audit
@query
def budget_advice(spark, sf_dir):
    """M1-M3, M5: parsed budget, advised delay, stop/wait decision per response."""
    adv = B.advise(S.request_log(spark, sf_dir), wait_on_limit=True, max_wait=300.0)
    return adv.select(F.col("client").cast("bigint").alias("client"),
                      F.col("seq").cast("bigint").alias("seq"), "status",
                      "remaining", "reset", "used", "advised_delay", "blocked", "decision",
                      C.iso(F.col("reset_at")).alias("reset_at"), "budget_text")


@query
def budget_windows(spark, sf_dir):
    """M4: requests and limited responses per client per 10-minute window."""
    adv = B.advise(S.request_log(spark, sf_dir), wait_on_limit=True, max_wait=300.0)
    w = B.windows(adv)
    return w.select(F.col("client").cast("bigint").alias("client"), "window_start",
                    F.col("requests").cast("bigint").alias("requests"),
                    F.col("limited").cast("bigint").alias("limited"), "min_remaining")


# ---------------------------------------------------------------- communities, users, lookups
from loomweave.operators import envelope as E  # noqa: E402
from loomweave.operators import normalize as N  # noqa: E402
from loomweave.operators import postings as PO  # noqa: E402
from loomweave.operators import search as SR  # noqa: E402
from loomweave.operators.common import first_wins  # noqa: E402
from loomweave.sources.capture import classify_responses  # noqa: E402


def _communities(spark, sf_dir):
    items, _ = L.decode_pages(S.community_pages(spark, sf_dir), allowed_kinds=("t5",))
    rows = items.select("page_no", "pos", *N.community_columns(F.col("data"), F.col("captured_at")))
    return first_wins(rows, ["fullname"], ["page_no", "pos"]).drop("page_no", "pos")


def _users(spark, sf_dir):
    items, _ = L.decode_pages(S.user_pages(spark, sf_dir), allowed_kinds=("t2",))
    rows = items.select("page_no", "pos", *N.user_columns(F.col("data"), F.col("captured_at")))
    return first_wins(rows, ["fullname"], ["page_no", "pos"]).drop("page_no", "pos")


def _iso_all(df):
    return df.select(*[C.iso(F.col(c)).alias(c) if t == "timestamp" else F.col(c)
                       for c, t in df.dtypes])


@query
def normalize_communities(spark, sf_dir):
    """B7 + D3: community search pages -> typed communities (``over18`` on input)."""
    return _iso_all(_communities(spark, sf_dir))


@query
def normalize_users(spark, sf_dir):
    """B7 + D4: user search pages -> typed users (``t2_`` names fall back to the profile)."""
    return _iso_all(_users(spark, sf_dir))


@query
def lookup_communities(spark, sf_dir):
    """G8 + B8: about responses -> found / not_found (empty Listing) / drift per request."""
    about = S.community_about(spark, sf_dir)
    v = E.about_verdict(about, "t5", ["request", "captured_at"], empty_listing_is_absent=True)
    cols = dict(N.community_fields(F.col("data"), F.col("captured_at")))
    rows = v.select("request", "verdict",
                    F.when(F.col("verdict") == "found", cols["fullname"]).alias("fullname"),
                    F.when(F.col("verdict") == "found", cols["subscribers"]).cast("bigint")
                    .alias("subscribers"))
    requests = about.select("request")
    return SR.lookup(requests, rows)


@query
def lookup_users(spark, sf_dir):
    """G9 + B9 + A4: user about responses; 404 -> not_found, non-t2 -> drift."""
    about = classify_responses(S.user_about(spark, sf_dir))
    v = E.about_verdict(about, "t2", ["request", "captured_at", "outcome"], empty_listing_is_absent=False)
    verdict = F.when(F.col("outcome") != "ok", F.col("outcome")).otherwise(F.col("verdict"))
    cols = dict(N.user_fields(F.col("data"), F.col("captured_at")))
    rows = v.select("request", verdict.alias("verdict"),
                    F.when(verdict == "found", cols["name"]).alias("name"),
                    F.when(verdict == "found", cols["total_karma"]).cast("bigint").alias("total_karma"))
    return SR.lookup(about.select("request"), rows)


# ---------------------------------------------------------------- search and related
SEARCH_QUERY = "the and"


@query
def search_posts_relevance(spark, sf_dir):
    """G4 + H3: BM25 over title and text, top 25."""
    r = SR.search_posts(_posts(spark, sf_dir, False), SEARCH_QUERY, limit=25)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "fullname", "relevance",
                    F.col("matched").cast("bigint").alias("matched"))


@query
def search_posts_new(spark, sf_dir):
    """G4 + H1 + F3: matching posts of one community, newest first."""
    r = SR.search_posts(_posts(spark, sf_dir, False), "der die", community="src6", sort="new", limit=20)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "fullname",
                    C.iso(F.col("created_at")).alias("created_at"))


def _index(spark, sf_dir):
    """The posts' search index, written once a session."""
    def build():
        path = ST.work_dir(spark, "search-index")
        PO.write_index(_posts(spark, sf_dir, False), path)
        return path
    return memo(spark, sf_dir, "index", build)


@query
def search_index_relevance(spark, sf_dir):
    """G4 + H3: the same search over written postings, blocks pruned by their score bounds."""
    r = PO.search_index(spark, _index(spark, sf_dir), SEARCH_QUERY, limit=25)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "fullname", "relevance",
                    F.col("matched").cast("bigint").alias("matched"))


@query
def search_index_new(spark, sf_dir):
    """G4 + H1: matches of one community from the postings, newest first."""
    r = PO.search_index(spark, _index(spark, sf_dir), "der die", community="src6", sort="new", limit=20)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "fullname",
                    C.iso(F.col("created_at")).alias("created_at"))


@query
def search_communities(spark, sf_dir):
    """Communities matching name, title or description tokens."""
    r = SR.search_named(_communities(spark, sf_dir), "fr board", ["name", "title", "description"],
                        [F.col("name").asc()], 50)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "name",
                    F.col("matched").cast("bigint").alias("matched"))


@query
def discover_communities(spark, sf_dir):
    """Community discovery, ranked by matched terms then subscribers."""
    r = SR.search_named(_communities(spark, sf_dir), "en posts", ["name", "title", "public_description"],
                        [F.col("subscribers").desc_nulls_last(), F.col("name").asc()], 10)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "name",
                    F.col("subscribers").cast("bigint").alias("subscribers"))


@query
def search_users(spark, sf_dir):
    """Users whose name tokens match, newest accounts first among equals."""
    r = SR.search_named(_users(spark, sf_dir), "user 77", ["name"],
                        [F.col("created_at").desc_nulls_last(), F.col("fullname").asc()], 20)
    return r.select(F.col("rank").cast("bigint").alias("rank"), "fullname", "name",
                    F.col("matched").cast("bigint").alias("matched"))


@query
def search_typed(spark, sf_dir):
    """The same entry searches communities and users (posts: ``search_posts_*``)."""
    tables = {"sr": _communities(spark, sf_dir), "user": _users(spark, sf_dir)}
    parts = [SR.search(tables, q, t, limit=n) for t, q, n in (("sr", "fr board", 50), ("user", "user 77", 20))]
    return parts[0].unionByName(parts[1]).select("kind", F.col("rank").cast("bigint").alias("rank"), F.col("matched").cast("bigint").alias("matched"))


@query
def related_posts(spark, sf_dir):
    """G12 + H9: per post, the five busiest other discussions of the same link."""
    p = _posts(spark, sf_dir, False)
    r = SR.related(p, F.when(~F.col("is_self"), F.col("link_url")), "num_comments", 5)
    return r.select("fullname", F.col("rank").cast("bigint").alias("rank"),
                    F.col("r_fullname").alias("related"))


@query
def related_crossposts(spark, sf_dir):
    """G12 crossposts-only: same link in other communities, newest first."""
    p = _posts(spark, sf_dir, False)
    r = SR.related(p, F.when(~F.col("is_self"), F.col("link_url")), "new", 5, other_community_only=True)
    return r.select("fullname", F.col("rank").cast("bigint").alias("rank"),
                    F.col("r_fullname").alias("related"), F.col("r_subreddit").alias("related_subreddit"))


# ---------------------------------------------------------------- user activity, profile
PROFILE_USER = "u7"


def _user_sources(spark, sf_dir):
    posts = _posts(spark, sf_dir, False)
    comments = FR.comments_view(_forest(spark, sf_dir))
    return posts, comments


def _activity_out(df):
    return df.select(F.col("rank").cast("bigint").alias("rank"), "kind", "fullname",
                     C.iso(F.col("created_at")).alias("created_at"), F.col("score").cast("bigint").alias("score"))


for _type in ("overview", "submitted", "comments", "top"):
    def _make_user(listing_type):
        def fn(spark, sf_dir):
            posts, comments = ((_posts(spark, sf_dir, False), None) if listing_type == "submitted"
                               else _user_sources(spark, sf_dir))
            return _activity_out(L.user_activity(posts, comments, PROFILE_USER, listing_type, limit=25))
        fn.__name__ = f"user_{listing_type}"
        fn.__doc__ = f"G3/G13: the ``{listing_type}`` listing of one author, mixed kinds."
        return fn
    query(_make_user(_type))


@query
def author_profile(spark, sf_dir):
    """K5: per pseudonymised author, posts, comments, score sum, first and last seen."""
    posts, comments = _user_sources(spark, sf_dir)
    both = posts.select("author", F.lit(1).alias("p"), F.lit(0).alias("c"), "score", "created_at").unionByName(
        comments.select("author", F.lit(0).alias("p"), F.lit(1).alias("c"), "score", "created_at"))
    return both.groupBy(F.sha2(F.col("author"), 256).alias("author_key")).agg(
        F.sum("p").cast("bigint").alias("posts"), F.sum("c").cast("bigint").alias("comments"),
        F.sum(F.coalesce("score", F.lit(0))).cast("bigint").alias("score_sum"),
        C.iso(F.min("created_at")).alias("first_seen"), C.iso(F.max("created_at")).alias("last_seen"))


# ---------------------------------------------------------------- media, drift, responses, schema
@query
def post_media(spark, sf_dir):
    """Media precedence, gallery order, entity decode, safe URLs."""
    posts = S.media_posts(spark, sf_dir).withColumn("v", F.parse_json("post"))
    m = posts.select("page_id", F.posexplode(N.post_media(F.col("v"))).alias("ord", "m"))
    return m.select("page_id", F.col("ord").cast("bigint").alias("ord"), F.col("m.kind").alias("kind"),
                    F.col("m.url").alias("url"), F.col("m.width").alias("width"),
                    F.col("m.height").alias("height"))


@query
def envelope_drift(spark, sf_dir):
    """The first envelope violation of each response, or the items it yields."""
    bronze = S.drift_pages(spark, sf_dir)
    checked = E.listing_pages_checked(bronze, ("t3",))
    items = (E.explode_things(checked.filter(F.col("drift").isNull()), "v", ["doc_id"])
             .filter(F.col("kind") == "t3").groupBy("doc_id").agg(F.count("*").alias("items")))
    return (checked.select("doc_id", F.col("drift.path").alias("path"),
                           F.col("drift.expected").alias("expected"))
            .join(items, "doc_id", "left")
            .select("doc_id", "path", "expected", F.coalesce("items", F.lit(0)).cast("bigint").alias("items")))


@query(name="classify_responses")
def classify_responses_query(spark, sf_dir):
    """A4 + M1: ok / rate_limited / challenge / not_found / unavailable per response."""
    r = classify_responses(S.event_responses(spark, sf_dir))
    return r.select("event_id", "outcome")


@query
def schema_conformance(spark, sf_dir):
    """Serialised posts (some broken by residue) checked against the declared schema."""
    from loomweave.operators import schema as SC

    p = _posts(spark, sf_dir)
    r = F.substring("id", 2, 20).cast("bigint") % 6
    ts_cols = {"created_at", "edited_at", "captured_at"}
    fields = []
    for name in p.columns:
        c = F.col(name)
        if name in ts_cols:
            c = C.iso(c)
        if name == "title":
            c = F.when(r == 1, F.lit("DROP-ME-SENTINEL")).otherwise(c)
        if name == "score":
            c = F.when(r == 3, F.col("score").cast("string").cast("variant")).otherwise(
                F.col("score").cast("variant"))
        if name == "over_18":
            c = F.when(r == 4, F.lit("yes").cast("variant")).otherwise(F.col("over_18").cast("variant"))
        if name == "media":
            c = F.when(r == 5, F.parse_json(F.lit("{}"))).otherwise(F.to_variant_object(F.col("media")))
        fields.append(c.alias(name))
    js = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    js = F.replace(js, F.lit(',"title":"DROP-ME-SENTINEL"'), F.lit(""))
    js = F.when(r == 2, F.concat(F.regexp_replace(js, r"\}$", ""), F.lit(',"extra":1}'))).otherwise(js)
    records = p.select(F.col("fullname").alias("record_id"), F.lit("Post").alias("record"), js.alias("json"))
    return SC.conformance(records, spark)


@query
def schema_conformance_all(spark, sf_dir):
    """Posts with media, nested comments, communities and users in one table, broken by residue, types by elimination."""
    from loomweave.operators import schema as SC

    def whole(df):
        return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})

    p = _posts(spark, sf_dir)
    r = F.substring("fullname", 5, 20).cast("bigint") % 6
    post = _iso_all(p)
    js = whole(post)
    broken = (F.when(r == 1, F.regexp_replace(js, r'"media":\[\{"kind":"[a-z]+"', '"media":[{"kind":7'))
              .when(r == 2, F.regexp_replace(js, '"created_at":"[^"]*"', '"created_at":"yesterday"'))
              .when(r == 3, F.regexp_replace(js, r'"media":\[[^\]]*\]', '"media":{}'))
              .when(r == 4, F.regexp_replace(js, ',"spoiler":(true|false)', ""))
              .when(r == 5, F.concat(F.lit('{"extra":1,'), F.substring(js, 2, 1 << 30))).otherwise(js))
    posts = post.select(F.col("fullname").alias("record_id"), broken.alias("json"))
    nested = FR.nested_comments(_forest(spark, sf_dir))
    js = F.replace("json", F.lit('"controversiality":1,"collapsed":true'), F.lit('"controversiality":"1","collapsed":true'))
    js = F.replace(js, F.lit('"distinguished":"moderator",'), F.lit(""))
    js = F.replace(js, F.lit('"stickied":true,'), F.lit('"stickied":true,"pinned":true,'))
    comments = nested.select(F.concat_ws("#", "thread_id", F.col("sib_pos").cast("string")).alias("record_id"), js.alias("json"))
    com = _iso_all(_communities(spark, sf_dir))
    js = whole(com)
    com = com.select(F.col("fullname").alias("record_id"), F.when(
        F.col("subscribers") % 2 == 1, F.regexp_replace(js, '"subscribers":[0-9]+', '"subscribers":"many"')).otherwise(js).alias("json"))
    use = _iso_all(_users(spark, sf_dir))
    k = F.substring("id", 2, 20).cast("bigint") % 11
    js = whole(use)
    use = use.select(F.col("fullname").alias("record_id"), F.when(k == 3, F.regexp_replace(js, '"total_karma":-?[0-9]+', '"total_karma":1.5'))
                     .when(k == 4, F.regexp_replace(js, '"total_karma":-?[0-9]+', '"total_karma":7.0'))
                     .when(k == 5, F.lit("[]")).when(k == 6, F.lit("{")).otherwise(js).alias("json"))
    return SC.conformance_all(posts.unionByName(comments).unionByName(com).unionByName(use))


# ---------------------------------------------------------------- expansion and verdicts
from loomweave.operators import expand as X  # noqa: E402


def _expanded(spark, sf_dir, max_depth=None):
    base = _pointed(spark, sf_dir)
    snaps = memo(spark, sf_dir, "snapshots", lambda: FR.flatten_post_responses(
        S.subtree_responses(spark, sf_dir), subtree=True)[0])
    return base, X.expand(base, snaps, max_depth=max_depth)


@query
def forest_expand(spark, sf_dir):
    """Base capture merged with subtree snapshots, display order rebuilt."""
    from loomweave.operators.common import distributed_rank

    base = _pointed(spark, sf_dir)
    snaps = memo(spark, sf_dir, "snapshots", lambda: FR.flatten_post_responses(
        S.subtree_responses(spark, sf_dir), subtree=True)[0])
    merged, _, _ = X.expand(base, snaps, renumber=False)   # display order = sortable merge path
    ranked = distributed_rank(merged, ["thread_id"], [F.col("opath")], "display_rank")
    return ranked.select("thread_id", "kind", "fullname",
                         F.col("ptr_count").cast("bigint").alias("ptr_count"),
                         F.col("display_rank").cast("bigint").alias("display_rank"))


def _snapshots(spark, sf_dir):
    return memo(spark, sf_dir, "snapshots", lambda: FR.flatten_post_responses(
        S.subtree_responses(spark, sf_dir), subtree=True)[0])


@query
def forest_expand_budget(spark, sf_dir):
    """Four requests a thread, the post's own and dead ends included, spent in display order."""
    from loomweave.operators.common import distributed_rank

    merged, _, _ = X.expand(_pointed(spark, sf_dir), _snapshots(spark, sf_dir), max_requests=4, renumber=False)
    ranked = distributed_rank(merged, ["thread_id"], [F.col("opath")], "display_rank")
    return ranked.select("thread_id", "kind", "fullname", F.col("ptr_count").cast("bigint").alias("ptr_count"),
                         F.col("display_rank").cast("bigint").alias("display_rank"))


@query
def forest_expand_limit(spark, sf_dir):
    """At most 50 comments, 9 requests, and a site that refuses after a thread's own number."""
    base = _pointed(spark, sf_dir)
    user = F.regexp_extract("thread_id", r"(\d+)$", 1).cast("bigint")
    answered = base.select("thread_id").distinct().withColumn("answered", user % 5 + 1)
    merged, done, dead = X.expand(base, _snapshots(spark, sf_dir), max_requests=9, limit=50, answered=answered)
    req = done.unionByName(dead).groupBy("thread_id").agg((F.count("*") + 1).alias("requests"))
    made = answered.join(req, "thread_id", "left").withColumn("requests", F.coalesce("requests", F.lit(1)))
    refused = made.filter((F.col("requests") < 9) & (F.col("requests") >= F.col("answered")))
    capped = FR.cap(merged, 50)
    v = FR.verdict(merged, capped, 50, dead=dead, refused=refused)
    kept = capped.groupBy("thread_id").agg(F.sum(F.when(F.col("kind") == "t1", 1).otherwise(0)).alias("shown"),
                                           F.sum(F.coalesce("ptr_count", F.lit(0))).alias("hidden"))
    return (v.join(made, "thread_id").join(kept, "thread_id")
            .select("thread_id", "verdict", F.col("shown").cast("bigint").alias("comments"),
                    F.col("hidden").cast("bigint").alias("hidden"), F.col("requests").cast("bigint").alias("requests_made")))


@query
def forest_verdict(spark, sf_dir):
    """Verdict per thread after expansion (comment limit 500), requests made."""
    _, (merged, done, dead) = _expanded(spark, sf_dir)
    capped = FR.cap(merged, 500)
    v = FR.verdict(merged, capped, 500, dead=dead)
    req = (done.unionByName(dead).groupBy("thread_id").agg((F.count("*") + 1).alias("requests")))
    n = F.col("comments")
    summary = F.concat(F.lit("1 post"), F.when(n > 0, F.concat(
        F.lit(", "), n.cast("string"), F.lit(" comment"), F.when(n == 1, F.lit("")).otherwise(F.lit("s"))))
        .otherwise(F.lit("")), F.lit(", stop reason: "), F.col("verdict"))
    return (v.join(req, "thread_id", "left")
            .select("thread_id", "verdict", F.col("comments").cast("bigint").alias("comments"),
                    F.coalesce("requests", F.lit(1)).cast("bigint").alias("requests_made"),
                    summary.alias("summary")))


@query
def forest_verdict_depth(spark, sf_dir):
    """J14 + J18: with depth 1 no pointer may be expanded: depth_capped / comment_limit."""
    v = FR.verdict(_pointed(spark, sf_dir), None, 500, max_depth=1)
    return v.select("thread_id", "verdict", F.col("comments").cast("bigint").alias("comments"))


@query
def forest_signature(spark, sf_dir):
    """Order-sensitive signature of every captured thread."""
    s = FR.signature(_forest(spark, sf_dir))
    return s.select("thread_id", "signature", F.col("nodes").cast("bigint").alias("nodes"))


@query
def forest_diff(spark, sf_dir):
    """The captures that hide comments against the whole ones, in which every 17th comment has another score."""
    from loomweave.operators import snapshots as SN

    later = _forest(spark, sf_dir)
    edited = F.substring("fullname", 5, 20).cast("bigint") % 17 == 0
    later = later.withColumn("c_score", F.when(edited, F.coalesce("c_score", F.lit(0)) + 1).otherwise(F.col("c_score")))
    d = SN.snapshot_diff(_pointed(spark, sf_dir), later, ["c_text", "c_score"])
    return d.select("thread_id", "node", F.col("depth").cast("bigint").alias("depth"), "change", "size_before", "size_after")


# ---------------------------------------------------------------- streaming
from loomweave.streaming import jobs as ST  # noqa: E402


@query
def stream_ingest(spark, sf_dir):
    """Captured pages land as files; an availableNow stream decodes and dedups them."""
    staging, silver = ST.work_dir(spark, "staging"), ST.work_dir(spark, "silver")
    S.post_pages(spark, sf_dir).write.json(staging)
    ST.ingest_captures(spark, staging, silver, ST.work_dir(spark, "ckpt"))
    return spark.read.parquet(silver).select(
        "fullname", "subreddit", F.col("score").cast("bigint").alias("score"),
        C.iso(F.col("created_at")).alias("created_at"))


@query
def stream_quarantine(spark, sf_dir):
    """S1 + B7: drifted and refused responses of the stream, kept beside its posts."""
    staging, silver, bad = (ST.work_dir(spark, x) for x in ("mixed", "mixed-silver", "mixed-bad"))
    pages = S.drift_pages(spark, sf_dir).select("response_id", "run_id", "page_no", "captured_at", F.lit(200).alias("status"),
                                                F.lit("application/json").alias("content_type"), "body")
    other = S.event_responses(spark, sf_dir).select(
        F.concat(F.lit("event:"), "event_id").alias("response_id"), F.lit(None).cast("string").alias("run_id"), F.lit(None).cast("bigint").alias("page_no"),
        S.captured_at().alias("captured_at"), "status", "content_type", "body")
    pages.unionByName(other).write.json(staging)
    ST.ingest_with_quarantine(spark, staging, silver, bad, ST.work_dir(spark, "ckpt"))
    good = spark.read.parquet(silver).select(F.col("fullname").alias("record"), F.lit("post").alias("reason"), F.lit(None).cast("string").alias("path"),
                                             F.lit(None).cast("string").alias("expected"))
    return good.unionByName(spark.read.parquet(bad).select(F.col("response_id").alias("record"), "reason", "path", "expected"))


def _broken_responses(spark, sf_dir):
    """One post response per document, broken by ``doc_id % 13``; every way in which a forest can drift is there."""
    lst = lambda *x: F.concat(F.lit('{"kind":"Listing","data":{"after":null,"children":['), F.concat_ws(",", *x), F.lit("]}}"))
    post, r = F.col("thing"), F.col("doc_id") % 13
    reply = lambda x: F.lit('{"kind":"t1","data":{"id":"c1","name":"t1_c1"%s}}' % x)
    more = lambda x: F.lit('{"kind":"more","data":{%s}}' % x)
    plain = reply(',"replies":""')
    deep = F.concat(F.lit('{"kind":"t1","data":{"id":"c0","name":"t1_c0","replies":'), lst(F.lit('{"kind":"t1","data":{"id":"c2","name":"t1_c2"}}')), F.lit("}}"))
    pair = lambda a, b: F.concat(F.lit("["), a, F.lit(","), b, F.lit("]"))
    body = (F.when(r == 1, F.lit("<html>blocked</html>")).when(r == 2, F.concat(F.lit("["), lst(post), F.lit("]")))
            .when(r == 3, pair(F.lit('{"kind":"listing"}'), lst(plain))).when(r == 4, pair(lst(post, post), lst(plain)))
            .when(r == 5, pair(lst(plain), lst(plain))).when(r == 6, pair(lst(post), lst(post)))
            .when(r == 7, pair(lst(post), lst(reply("")))).when(r == 8, pair(lst(post), lst(reply(',"replies":5'))))
            .when(r == 9, pair(lst(post), lst(deep))).when(r == 10, pair(lst(post), lst(plain, more('"parent_id":"x","count":1'))))
            .when(r == 11, pair(lst(post), lst(plain, more('"parent_id":"t1_c1","count":true')))).when(r == 12, pair(lst(post), lst(plain, plain)))
            .otherwise(pair(lst(post), lst(plain))))
    return S.post_things(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").alias("response_id"), S.captured_at().alias("captured_at"), body.alias("body"))


def _forest_drift(spark, sf_dir, subtree):
    from loomweave.session import cut_lineage

    broken = memo(spark, sf_dir, "broken", lambda: cut_lineage(_broken_responses(spark, sf_dir)))
    nodes, drift = FR.flatten_post_responses(broken.drop("doc_id"), subtree=subtree)
    good = nodes.groupBy("response_id").agg(F.count("*").alias("nodes"))
    every = broken.select("doc_id", "response_id")
    return (every.join(drift, "response_id", "left").join(good, "response_id", "left")
            .select("doc_id", "path", "expected", F.coalesce("nodes", F.lit(0)).cast("bigint").alias("nodes")))


@query
def drift_post_responses(spark, sf_dir):
    """Each way in which a post response drifts, or the nodes it yields."""
    return _forest_drift(spark, sf_dir, subtree=False)


@query
def drift_subtrees(spark, sf_dir):
    """The same responses read as subtrees, which hold exactly one comment at the top."""
    return _forest_drift(spark, sf_dir, subtree=True)


@query
def stream_dedup(spark, sf_dir):
    """Dedup of the event stream on its payload over the whole stream."""
    out = ST.work_dir(spark, "dedup")
    schema = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string")
    ST.dedup_stream(spark, sf_dir, "events.parquet", schema, ["props"], "ts", out,
                    ST.work_dir(spark, "ckpt"))
    return spark.read.parquet(out).select("props")


@query
def stream_rate_state(spark, sf_dir):
    """S3: per-client budget windows maintained as streaming state (update mode)."""
    log_dir, out = ST.work_dir(spark, "log"), ST.work_dir(spark, "windows")
    S.request_log(spark, sf_dir).repartitionByRange("ts").write.parquet(log_dir)
    # The replayed log is not in arrival order across files, so the watermark delay
    # covers the whole replay and no row is dropped as late.
    ST.rate_window_stream(spark, log_dir, out, ST.work_dir(spark, "ckpt"), delay="36500 days")
    state = ST.latest(spark, out, ["client", "w"])
    return state.select(F.col("client").cast("bigint").alias("client"),
                        C.iso(F.col("w.start")).alias("window_start"),
                        F.col("requests").cast("bigint").alias("requests"),
                        F.col("limited").cast("bigint").alias("limited"), "min_remaining")


# ---------------------------------------------------------------- structural PII scan, captures
@query
def pii_capture_scan(spark, sf_dir):
    """Value-free categories per captured listing page (posts, users, communities)."""
    pages = (S.post_pages(spark, sf_dir).unionByName(S.user_pages(spark, sf_dir))
             .unionByName(S.community_pages(spark, sf_dir)))
    cats = JT.scan(pages, "response_id", "body")
    return cats.select(F.col("id").alias("response_id"), "category", F.col("ord").cast("bigint").alias("ord"))


@query
def capture_files(spark, sf_dir):
    """A1-A3: one raw body per file, read whole; invalid or empty bodies are flagged."""
    from loomweave.sources.capture import read_in_rounds

    captures = S.drift_pages(spark, sf_dir).select(F.col("doc_id").cast("string").alias("name"), "body")
    read = read_in_rounds(captures, ST.work_dir(spark, "captures"), ST.work_dir(spark, "captures-read"))
    return read.select(F.col("name").cast("bigint").alias("doc_id"), "valid")


@query
def json_array_sink(spark, sf_dir):
    """All posts, newest first, published as one JSON array by many tasks and read back."""
    from loomweave.sources.capture import read_json_array, write_json_array

    path = ST.work_dir(spark, "json-array")
    write_json_array(_posts(spark, sf_dir, False), path, [F.col("created_at").desc(), F.col("fullname").asc()])
    v = F.try_parse_json("json")
    return read_json_array(spark, path).select("n", C.text(v, "fullname").alias("fullname"), F.md5(C.text(v, "text")).alias("text_md5"),
                                               F.try_variant_get(v, "$.score", "bigint").alias("score"))


@query
def capture_roundtrip(spark, sf_dir):
    """A1-A3: pages as captures under the last part of their url; unsafe names are refused, the rest read back in name order."""
    from loomweave.sources.capture import read_bundle, write_bundle

    pages = S.read(spark, sf_dir, "pages")
    r = F.col("page_id") % 7
    stem = F.concat(F.lit("page-"), F.lpad(F.col("page_id").cast("string"), 12, "0"))
    name = (F.when(r == 1, F.concat(F.lit("../"), stem)).when(r == 2, F.concat(F.lit("."), stem)).when(r == 3, F.concat(stem, F.lit("..json")))
            .when(r == 4, F.repeat(stem, 6)).otherwise(F.concat(stem, F.lit(".json"))))
    body = F.when(F.col("page_id") % 5 == 0, F.col("html")).otherwise(F.to_json(F.struct("url", "html")))
    path = ST.work_dir(spark, "bundle")
    refused = write_bundle(pages.select(name.alias("name"), body.alias("body")), path)
    kept = read_bundle(spark, path).select("seq", "name", "valid", F.md5("body").alias("body_md5"))
    return kept.unionByName(refused.select(F.lit(None).cast("bigint").alias("seq"), "name", F.lit(None).cast("boolean").alias("valid"),
                                           F.lit(None).cast("string").alias("body_md5")))


@query
def silver_listing(spark, sf_dir):
    """G1 + F1 on the silver layout (day folders, community-sorted files): pruned scan."""
    from loomweave.sources.capture import write_posts_silver

    path = ST.work_dir(spark, "silver-posts")
    write_posts_silver(_posts(spark, sf_dir, False), path)
    silver = spark.read.parquet(path)
    since = dt.datetime(2024, 1, 1, 3, tzinfo=dt.UTC)
    until = dt.datetime(2024, 1, 3, 12, tzinfo=dt.UTC)
    return _listing_out(L.silver_listing(silver, ["SRC8", "src12"], since, until, limit=40))


@query
def resolve_groups(spark, sf_dir):
    """Combined community names from the data; more than ten or an empty member fails."""
    docs = S.read(spark, sf_dir, "documents").select("doc_id", "source")
    names = F.transform(F.sequence(F.lit(0), (F.col("doc_id") % 12).cast("int")),
                        lambda k: F.concat(F.col("source"), F.lit("x"), k.cast("string")))
    raw = F.when(F.col("doc_id") % 13 == 0, F.concat(F.array_join(names, "+"), F.lit("++z9z")))\
        .otherwise(F.array_join(names, "+"))
    inp = docs.select("doc_id", raw.alias("raw"), F.lit("subreddit_group").alias("resolver"))
    r = ID.resolve_df(inp, "resolver", "raw")
    return r.select("doc_id", F.col("resolved.kind").alias("kind"),
                    F.col("resolved.community").alias("community"), F.col("resolved.error").alias("error"))


@query
def forest_dead_ends(spark, sf_dir):
    """Parents whose subtree snapshot brought nothing new, per thread."""
    _, (_, done, dead) = _expanded(spark, sf_dir)
    return (dead.withColumn("outcome", F.lit("dead_end"))
            .unionByName(done.withColumn("outcome", F.lit("expanded")))
            .select("thread_id", F.col("root").alias("parent"), "outcome"))


@query
def stream_budget_alerts(spark, sf_dir):
    """S3: per client, responses at or below half the budget, as stream state."""
    log_dir, out = ST.work_dir(spark, "alert-log"), ST.work_dir(spark, "alerts")
    S.request_log(spark, sf_dir).write.parquet(log_dir)
    ST.budget_alert_stream(spark, log_dir, out, ST.work_dir(spark, "ckpt"), low_water=50.0)
    state = ST.latest(spark, out, ["client"])
    return state.select(F.col("client").cast("bigint").alias("client"),
                        F.col("low_responses").cast("bigint").alias("low_responses"),
                        F.col("first_low_seq").cast("bigint").alias("first_low_seq"),
                        F.col("last_low_seq").cast("bigint").alias("last_low_seq"))


@query
def forest_context(spark, sf_dir):
    """Anchored subtrees re-rooted three ancestors up."""
    n = _forest(spark, sf_dir)
    ev = S.read(spark, sf_dir, "events")
    anchors = ev.filter(F.col("event_type") == "signup").select(
        F.concat(F.lit("t3_d"), F.col("user_id")).alias("thread_id"),
        F.concat(F.lit("e"), F.col("event_id")).alias("comment_id"))
    sub, missing = FR.anchor(n, anchors, context=3)
    found = sub.select("comment_id", F.lit(True).alias("found"), "thread_id", "kind",
                       _path_txt().alias("path"), "fullname")
    lost = missing.select("comment_id", F.lit(False).alias("found"), "thread_id",
                          F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("path"),
                          F.lit(None).cast("string").alias("fullname"))
    return found.unionByName(lost)


@query
def thread_items(spark, sf_dir):
    """Each post followed by its comment tree, capped at 20, in display order."""
    posts = _posts(spark, sf_dir, False).select(F.col("fullname").alias("thread_id"), "title")
    capped = FR.cap(_forest(spark, sf_dir), 20)
    ranked = FR.preorder(capped, kinds=("t1", "more"))
    items = ranked.select("thread_id", F.col("display_rank").cast("bigint").alias("position"), "kind",
                          F.coalesce("fullname", F.concat(F.lit("more:"), F.col("ptr_count").cast("string")))
                          .alias("item"))
    heads = posts.join(capped.select("thread_id").distinct(), "thread_id", "left_semi").select(
        "thread_id", F.lit(0).cast("bigint").alias("position"), F.lit("t3").alias("kind"),
        F.col("thread_id").alias("item"))
    return heads.unionByName(items)
