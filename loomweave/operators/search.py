"""Search, discovery, lookups and related discussions.

The remote server ranks search results in the reference; here relevance is
BM25 (Robertson and Zaragoza 2009) over the table.  Per-document term
frequencies and lengths are array expressions on the row (no token explode),
and the corpus statistics are one global aggregate of a few numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomweave.operators import listing as L

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
BM25_K1 = 1.2
BM25_B = 0.75


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


def query_terms(query: str) -> list[str]:
    import re

    terms = [t for t in re.split(r"[\W_]+", query.lower()) if t]    # as TOKEN_SPLIT
    if not terms:
        raise ValueError("query is required")
    return list(dict.fromkeys(terms))


def _equals(term: str):
    return lambda x: x == F.lit(term)


def bm25(df: DataFrame, text: Column, query: str, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """H3: adds ``matched`` (query terms present) and ``relevance`` (BM25, 6 places)."""
    terms = query_terms(query)
    toks = tokens(text)
    staged = df.withColumn("_dl", F.size(toks))
    for i, t in enumerate(terms):
        staged = staged.withColumn(f"_tf{i}", F.size(F.filter(toks, _equals(t))))
    stats = staged.agg(F.count("*").alias("n"), F.avg("_dl").alias("avgdl"),
                       *[F.sum(F.when(F.col(f"_tf{i}") > 0, 1).otherwise(0)).alias(f"df{i}")
                         for i in range(len(terms))]).first()
    n = stats["n"] or 0
    avgdl = float(stats["avgdl"] or 1.0) or 1.0
    score = F.lit(0.0)
    matched = F.lit(0)
    for i in range(len(terms)):
        df_i = stats[f"df{i}"] or 0
        idf = math.log(1.0 + (n - df_i + 0.5) / (df_i + 0.5))
        tf = F.col(f"_tf{i}").cast("double")
        norm = tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("_dl") / F.lit(avgdl))
        score = score + F.when(tf > 0, F.lit(idf) * tf * F.lit(k1 + 1.0) / norm).otherwise(0.0)
        matched = matched + F.when(F.col(f"_tf{i}") > 0, 1).otherwise(0)
    out = staged.withColumn("relevance", F.round(score, 6)).withColumn("matched", matched)
    return out.drop("_dl", *[f"_tf{i}" for i in range(len(terms))])


def search_posts(posts: DataFrame, query: str, community: str | None = None, sort: str = "relevance",
                 limit: int | None = 25, since=None, until=None) -> DataFrame:
    """G4 (+F2/F3): token match on title and text; ``relevance`` is BM25."""
    L.choice(sort, L.SEARCH_SORTS, "sort")
    effective = "new" if (since is not None or until is not None) else sort
    df = posts
    if community:
        df = df.filter(F.lower("subreddit") == community.lower())
    df = L.date_window(df, since, until)
    scored = bm25(df, F.concat_ws(" ", "title", "text"), query).filter(F.col("matched") > 0)
    if effective == "relevance":
        order = [F.col("relevance").desc(), F.col("created_at").desc(), F.col("fullname").asc()]
    else:
        order = L.post_sort_key(effective, L.dt.datetime(2024, 1, 2, tzinfo=L.dt.UTC))
    return L.ranked(scored, order, limit)


SEARCH_TYPES = ("link", "sr", "user")


def search(tables: dict[str, DataFrame], query: str, search_type: str = "link", community: str | None = None, sort: str = "relevance",
           limit: int | None = 25, since=None, until=None) -> DataFrame:
    """One entry for the three kinds of search: (rank, kind, fullname, matched).

    ``tables``: the normalised posts, communities or users under the search's type.  Only posts have dates
    to search by; bounds on another type are refused before any plan is built.
    """
    L.validate_limit(limit)
    if search_type not in SEARCH_TYPES:
        raise ValueError(f"search type must be one of {', '.join(SEARCH_TYPES)}")
    since, until = L.bounds(since, until)
    if (since is not None or until is not None) and search_type != "link":
        raise ValueError("date bounds are only supported for link searches")
    if search_type == "link":
        found = search_posts(tables["link"], query, community, sort, limit, since, until)
    elif search_type == "sr":
        found = search_named(tables["sr"], query, ["name", "title", "description"], [F.col("name").asc()], limit)
    else:
        found = search_named(tables["user"], query, ["name"], [F.col("created_at").desc_nulls_last(), F.col("fullname").asc()], limit)
    return found.select("rank", F.lit({"link": "t3", "sr": "t5", "user": "t2"}[search_type]).alias("kind"), "fullname", "matched")


def search_named(df: DataFrame, query: str, fields: list[str], order_tail: list[Column],
                 limit: int | None) -> DataFrame:
    """Rows whose name/title/description tokens contain query terms."""
    terms = query_terms(query)
    toks = F.array_distinct(F.flatten(F.array(*[tokens(F.coalesce(F.col(f), F.lit(""))) for f in fields])))
    matched = F.size(F.array_intersect(toks, F.array(*[F.lit(t) for t in terms])))
    scored = df.withColumn("matched", matched).filter(F.col("matched") > 0)
    return L.ranked(scored, [F.col("matched").desc(), *order_tail], limit)


def lookup(requests: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every request gets a verdict; a request without a response is ``missing``.

    Left join of the request table; the missing list is the left-anti side.
    """
    return requests.join(verdicts, "request", "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit("missing")))


def related(posts: DataFrame, key: Column, sort: str = "num_comments", limit: int = 5,
            other_community_only: bool = False) -> DataFrame:
    """For every post, the top ``limit`` other posts sharing its link key.

    Never emits all pairs of a link group: each group first keeps its top
    ``limit + 1`` members (``row_number() <= k`` is planned as a group limit
    before the shuffle, so a hot link key ships at most k rows per map task),
    then every member joins only those.  With ``other_community_only`` a
    community keeps at most ``limit`` of a key's rows and the key the first
    ``2 * limit`` of these: without any one community, ``limit`` still remain,
    however many communities share the link.
    """
    L.choice(sort, L.DUPLICATES_SORTS, "sort")
    order = ([F.col("num_comments").desc_nulls_last()] if sort == "num_comments" else []) + [
        F.col("created_at").desc_nulls_last(), F.col("fullname").asc()]
    keyed = posts.withColumn("_key", key).filter(F.col("_key").isNotNull() & (F.col("_key") != ""))
    def first(df: DataFrame, part: list[str], k: int) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*order)
        return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")

    if other_community_only:
        top = first(first(keyed, ["_key", "subreddit"], limit), ["_key"], 2 * limit)
    else:
        top = first(keyed, ["_key"], limit + 1)
    cand = top.select("_key", *[F.col(c).alias(f"r_{c}") for c in
                                ("fullname", "subreddit", "num_comments", "created_at")])
    pairs = keyed.select("_key", "fullname", "subreddit").join(cand, "_key").filter(
        F.col("r_fullname") != F.col("fullname"))
    if other_community_only:
        pairs = pairs.filter(F.col("r_subreddit") != F.col("subreddit"))
    rorder = ([F.col("r_num_comments").desc_nulls_last()] if sort == "num_comments" else []) + [
        F.col("r_created_at").desc_nulls_last(), F.col("r_fullname").asc()]
    w2 = Window.partitionBy("fullname").orderBy(*rorder)
    return (pairs.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= limit)
            .drop("_key"))
