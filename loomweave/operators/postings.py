"""A written index for searching posts: postings laid out by term, scored block by block.

Three Parquet tables under one folder:

* ``postings`` (term, block, fullname, tf, dl): sorted by term, so a search reads the row groups of its
  own terms (``PushedFilters: In(term, ...)``) and no text.
* ``bounds`` (term, block, most, shortest, rows): per term and block of posts the greatest frequency and
  the least length, which bound what any post of the block can score for the term; their row
  counts add up to the term's document frequency.
* ``posts``: every post once with its length ``dl``; a search reads the columns that a result shows.

A block is a class of like lengths (four to a doubling) and of the name's hash, so its bounds are close
and no ranking of posts is needed.  A search scores the blocks with the highest bounds first, at least
``limit`` matches of them, and then only blocks whose bound reaches the score of the ``limit``-th;
the result is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomweave.operators import listing as L
from loomweave.operators import search as SR
from loomweave.session import cut_lineage, shuffles_removed

#: Posts a block holds on average, where lengths spread over about so many classes.
BLOCK = 1024
LENGTHS = 16


def write_index(posts: DataFrame, path: str, block: int = BLOCK) -> None:
    """Writes the three tables under ``path``; ``fullname`` names a post once.  Posts without a token stay in ``posts`` and are never found.

    A term that a third of all posts hold is sorted and written by many tasks, as rows are range
    partitioned on (term, block, post).  A post's terms are counted in its own row, so each posting is
    shuffled once, and a step's shuffle files go before the next step writes its own.
    """
    spark = posts.sparkSession
    text = F.concat_ws(" ", "title", "text")
    with shuffles_removed(spark):
        (posts.select("fullname", "subreddit", "created_at", "score", "num_comments", F.size(SR.tokens(text)).alias("dl"), text.alias("text"))
         .write.parquet(f"{path}/posts"))
        back = spark.read.parquet(f"{path}/posts")
        classes = max(1, back.count() // (block * LENGTHS))
        length = F.floor(F.log2(F.col("dl") + 1.0) * 4).cast("bigint")
        rows = back.select((length * F.lit(1 << 32) + F.pmod(F.xxhash64("fullname"), F.lit(classes))).alias("block"), "fullname", "dl", "text")
        keys = ["term", "block", "fullname"]
        (_counted(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
         .write.option("parquet.block.size", 16 << 20).parquet(f"{path}/postings"))
        postings = spark.read.parquet(f"{path}/postings")
        (postings.groupBy("term", "block").agg(F.max("tf").alias("most"), F.min("dl").alias("shortest"), F.count("*").alias("rows"))
         .repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(f"{path}/bounds"))


def _counted(rows: DataFrame) -> DataFrame:
    """(term, block, fullname, dl, tf) of ``rows`` with their ``text``, each text's terms counted where it lies.

    In the sorted tokens a term's first place and the next term's give its count.
    """
    c = F.col
    staged = rows.select("block", "fullname", "dl", F.array_sort(SR.tokens(c("text"))).alias("_t"))
    marked = F.transform("_t", lambda t, i: F.struct(t.alias("term"), i.alias("at")))
    firsts = F.filter(marked, lambda m: (m["at"] == 0) | (F.get("_t", m["at"] - 1) != m["term"]))
    staged = staged.select("block", "fullname", "dl", F.size("_t").alias("_n"), firsts.alias("_f"))
    counts = F.transform("_f", lambda m, j: F.struct(
        m["term"].alias("term"), (F.coalesce(F.get("_f", j + 1)["at"], c("_n")) - m["at"]).cast("int").alias("tf")))
    return staged.select("block", "fullname", "dl", F.explode(counts).alias("_c")).select("_c.term", "block", "fullname", "dl", "_c.tf")


def _impact(tf: Column, dl: Column, idf: Column, mean: float) -> Column:
    f = tf.cast("double")
    return idf * f * F.lit(SR.BM25_K1 + 1.0) / (f + F.lit(SR.BM25_K1) * (F.lit(1.0 - SR.BM25_B) + F.lit(SR.BM25_B) * dl / F.lit(mean)))


def _of_terms(df: DataFrame, terms: list[str]) -> DataFrame:
    return df.filter(F.col("term").isin(*terms))


def search_index(spark: SparkSession, path: str, query: str, community: str | None = None, sort: str = "relevance",
                 limit: int | None = 25, since=None, until=None) -> DataFrame:
    """G4, H3 over a written index; BM25's statistics are those of the whole index.

    Gives the first ``limit`` posts with ``matched`` and ``relevance`` and their ``rank``.  With a
    community, a date window, another sort than relevance or no limit the terms' postings give the matches
    and the posts table the order; by relevance alone, blocks are pruned as the module says.
    """
    L.choice(sort, L.SEARCH_SORTS, "sort")
    terms = SR.query_terms(query)
    posts = spark.read.parquet(f"{path}/posts").drop("text")
    postings = _of_terms(spark.read.parquet(f"{path}/postings"), terms)
    bounds = _of_terms(spark.read.parquet(f"{path}/bounds"), terms)
    facts = posts.agg(F.count("*").alias("n"), F.avg("dl").alias("mean")).first()
    n, mean = facts["n"] or 0, float(facts["mean"] or 1.0) or 1.0
    seen = {r["term"]: r["df"] for r in bounds.groupBy("term").agg(F.sum("rows").alias("df")).collect()}  # a row per term of the query
    weights = {t: math.log(1.0 + (n - seen.get(t, 0) + 0.5) / (seen.get(t, 0) + 0.5)) for t in terms}
    idf = F.create_map(*[x for t in terms for x in (F.lit(t), F.lit(weights[t]))])[F.col("term")]

    def scored(rows: DataFrame) -> DataFrame:
        each = rows.withColumn("_s", _impact(F.col("tf"), F.col("dl"), idf, mean))
        parts = [F.coalesce(F.max(F.when(F.col("term") == t, F.col("_s"))), F.lit(0.0)) for t in terms]
        total = F.lit(0.0)
        for p in parts:     # in the order of the terms, so sums agree with a scan's to the last bit
            total = total + p
        return each.groupBy("block", "fullname").agg(F.round(total, 6).alias("relevance"), F.count("*").cast("int").alias("matched"))

    narrowed = community or since is not None or until is not None
    if sort != "relevance" or narrowed or not limit:
        found = posts if not community else posts.filter(F.lower("subreddit") == community.lower())
        found = L.date_window(found, since, until).join(scored(postings).drop("block"), "fullname")
        effective = "new" if (since is not None or until is not None) else sort
        order = _by_relevance() if effective == "relevance" else L.post_sort_key(effective, L.dt.datetime(2024, 1, 2, tzinfo=L.dt.UTC))
        return L.ranked(found, order, limit)

    top = bounds.withColumn("_s", _impact(F.col("most"), F.col("shortest"), idf, mean)).groupBy("block").agg(
        F.sum("_s").alias("bound"), F.max("rows").alias("least"))
    top = cut_lineage(top)
    # the blocks of highest bound that hold `limit` matches for certain: `limit` blocks at most
    falling = Window.orderBy(F.col("bound").desc(), "block").rowsBetween(Window.unboundedPreceding, -1)
    first = (top.orderBy(F.col("bound").desc(), "block").limit(limit)
             .withColumn("_before", F.coalesce(F.sum("least").over(falling), F.lit(0))).filter(F.col("_before") < limit))
    first = cut_lineage(first.select("block"))
    sure = scored(postings.join(first, "block", "left_semi"))
    kth = sure.orderBy(F.col("relevance").desc()).limit(limit).agg(F.count("*").alias("c"), F.min("relevance").alias("s")).first()
    # scores are rounded to 6 places: a bound that far below may still tie
    floor = kth["s"] - 2e-6 if kth["c"] == limit else None
    worth = top if floor is None else top.filter(F.col("bound") >= F.lit(floor))
    matches = scored(postings.join(worth.select("block"), "block", "left_semi"))
    if floor is not None:
        matches = matches.filter(F.col("relevance") >= F.lit(kth["s"]))
    found = posts.join(matches.drop("block"), "fullname")
    return L.ranked(found, _by_relevance(), limit)


def _by_relevance() -> list[Column]:
    return [F.col("relevance").desc(), F.col("created_at").desc(), F.col("fullname").asc()]
