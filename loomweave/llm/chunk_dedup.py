"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

Every normalised text is cut where its own content says so: a chunk ends after
the first anchor (one of a few letters or digits followed by white space or
punctuation) past ``MIN_CHUNK`` characters, or at ``MAX_CHUNK`` characters where no anchor
comes.  The cuts depend on nothing but the text, so equal texts have equal
chunk lists.  A document becomes its recipe: the ordered list of chunk
identifiers.

Identifiers are verified, not trusted: chunk texts are moved once, as distinct
(hash, text) pairs combined map-side; where a hash names more than one text, the
texts themselves become part of the recipe.  Only documents holding such a chunk
are looked at again.  After that only recipes (8 bytes for each 2 KB or so of text) are
compared; document texts are not shuffled.

A group of copies may hold any share of the rows: recipes are grouped with
partial aggregation, and the way back is an equi-join on the recipe that
adaptive execution splits when one recipe is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomweave.llm.io import OWN, rows_that_stay, saved, whole_text

MIN_CHUNK = 512
MAX_CHUNK = 8192
#: Characters that end a chunk when white space or punctuation follows.
ANCHOR = "dgmrty059"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters beyond ASCII that lower() would change.
_OTHER_UPPER = r"[\x{80}-\x{10FFFF}&&[\p{IsUppercase}\p{IsTitlecase}]]"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.

    ``translate`` works character by character through a map, so texts in which
    lower() can change nothing but A-Z take lower().
    """
    plain = (F.octet_length(text) == F.char_length(text)) | ~text.rlike(_OTHER_UPPER)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The ordered chunks of a text; joined they are the text, and an empty text has none."""
    anchored = rf"(?s).{{{least},{most}}}?(?<=[{ANCHOR}][\s\p{{Punct}}])|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(anchored), F.lit(0))


def chunk_hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher=chunk_hash) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    Of rows with equal normalised text the one with the largest ``id_col``
    stays.  Null text counts as empty; empty texts are one group.  A null id
    loses to any other and its ``keep_id`` is null only if all ids of the group
    are null.  Of rows that repeat id and text exactly one is kept.  Other
    columns are not read.  An empty table gives no rows.
    """
    row, ids, fix, sha = f"{OWN}row", f"{OWN}ids", f"{OWN}fix", f"{OWN}sha"
    norm = ascii_lower(whole_text(text_col))
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), norm.alias(f"{OWN}t"))
    cut = source.withColumn(f"{OWN}c", chunks(F.col(f"{OWN}t")))
    recipes = saved(cut.select(
        "doc_id", F.monotonically_increasing_id().alias(row), F.sha2(F.col(f"{OWN}t").cast("binary"), 256).alias(sha),
        F.transform(f"{OWN}c", hasher).alias(ids)))

    # Verification: the only step that moves text, each distinct chunk of a task once.
    pieces = cut.select(F.explode(f"{OWN}c").alias("chunk")).select(hasher(F.col("chunk")).alias("h"), "chunk")
    doubtful = saved(pieces.distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"))
    if doubtful.isEmpty():
        keyed = recipes.withColumn(fix, F.array().cast("array<string>"))
    else:
        keyed = _resolved(recipes, cut, doubtful, hasher)

    groups = keyed.groupBy(ids, fix).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by(row, F.coalesce("doc_id", F.lit(-(1 << 63)))).alias(f"{OWN}best"))
    a, b = keyed.alias("a"), groups.alias("b")
    return (a.join(b, (F.col(f"a.{ids}") == F.col(f"b.{ids}")) & (F.col(f"a.{fix}") == F.col(f"b.{fix}")))
            .select(F.col("a.doc_id"), F.col("b.keep_id"), F.col("b.group_size"),
                    (F.col(f"a.{row}") == F.col(f"b.{OWN}best")).alias("kept"),
                    F.col(f"a.{sha}").alias("text_sha256"),
                    F.size(f"a.{ids}").cast("bigint").alias("n_chunks")))


def _resolved(recipes: DataFrame, cut: DataFrame, doubtful: DataFrame, hasher) -> DataFrame:
    """Recipes with the true identity of every chunk whose hash names several texts.

    Only documents with such a chunk are read again; the chunk texts in doubt
    become part of the identifier list.
    """
    ids, fix, sha = f"{OWN}ids", f"{OWN}fix", f"{OWN}sha"
    parts = (cut.select(F.sha2(F.col(f"{OWN}t").cast("binary"), 256).alias(sha), F.posexplode(f"{OWN}c"))
             .withColumn("h", hasher(F.col("col"))).join(doubtful, "h", "left_semi").distinct())
    lists = (parts.groupBy(sha).agg(F.sort_array(F.collect_list(F.struct("pos", "col"))).alias("l"))
             .select(sha, F.transform("l", lambda x: x["col"]).alias(fix)))
    return recipes.join(lists, sha, "left").withColumn(fix, F.coalesce(F.col(fix), F.array().cast("array<string>")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hasher=chunk_hash) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    ``exact_groups`` decides on narrow rows.  If ids repeat with other texts,
    rows are matched on (id, sha256 of the normalised text), and one of rows
    equal in both stays.
    """
    keys = saved(exact_groups(docs, id_col, text_col, hasher).groupBy(F.col("doc_id").alias("id"), F.col("text_sha256").alias("key")).agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")))
    sha = F.sha2(ascii_lower(whole_text(text_col)).cast("binary"), 256)
    return rows_that_stay(docs, keys, F.col(id_col).cast("bigint"), sha)
