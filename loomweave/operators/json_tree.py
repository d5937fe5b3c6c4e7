"""Redaction and PII scan of nested JSON documents, level by level.

Every document becomes a variant; each level is one ``variant_explode`` of the
containers left, carrying only what a child must know of its parents.  Leaves
are tested or masked at their level and dropped from the loop.  Redaction then
rebuilds each container from its own children, deepest level first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomweave.functions import pii as PII
from loomweave.functions import redact as R
from loomweave.session import cut_lineage, shuffles_removed, stored

_SHAPE = "CASE WHEN startswith(s, 'OBJECT') THEN 'o' WHEN startswith(s, 'ARRAY') THEN 'a' WHEN s = 'STRING' THEN 's' ELSE 'x' END"


def _typed(df: DataFrame, value: str = "v") -> DataFrame:
    """``kind``: o object, a array, s string, x any other leaf; ``str``: the string of a string leaf."""
    return (df.withColumn("s", F.schema_of_variant(value)).withColumn("kind", F.expr(_SHAPE)).drop("s")
            .withColumn("str", F.when(F.col("kind") == "s", F.try_variant_get(value, "$", "string"))))


def _children(nodes: DataFrame, all_rows: bool = False) -> DataFrame:
    """The columns of ``nodes`` with one row per child: pos, key (null in arrays), value; with ``all_rows`` also one without them for a row that has no child."""
    names = nodes.columns
    own = nodes.toDF(*[f"n_{c}" for c in names])
    spark = nodes.sparkSession
    explode = spark.tvf.variant_explode_outer if all_rows else spark.tvf.variant_explode
    out = own.lateralJoin(explode(F.col("n_v").outer()))
    return out.select(*[F.col(f"n_{c}").alias(f"p_{c}") for c in names], "pos", "key", F.col("value").alias("v"))


def _text_of(v: str, path: str) -> Column:
    """The string at a path of an object, null if it is no string."""
    at = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(at) == "STRING", F.try_variant_get(v, path, "string"))


# ---------------------------------------------------------------- PII scan
#: Levels that a pass goes down before its rows are stored: what most responses hold.
LEVELS = 7


def scan(docs: DataFrame, id_col: str, json_col: str, levels: int = LEVELS) -> DataFrame:
    """id, ord, category: value-free categories of each document in the fixed order (no row for a clean one).

    A pass takes every document ``levels`` levels apart in the task that reads it; only findings are stored, and the
    containers that lie deeper, which the next pass starts from.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(json_col).alias("j"), F.try_parse_json(json_col).alias("v"))
    level = _typed(base.withColumn("user", F.lit(False)))
    unread = F.when(F.col("j").isNull(), F.array(F.lit("unsafe-file"))).when(F.col("v").isNull(), F.array(F.lit("invalid-json")))
    held = level.select("id", "user", "kind", _container().alias("v"), F.coalesce(unread, _text_findings()).alias("cats"))
    found = []
    while True:
        for _ in range(levels):
            held = _below(held)
        with shuffles_removed(docs.sparkSession):
            held = stored(held, "scanned")
        found.append(held.select("id", F.explode("cats").alias("category")))
        held = held.filter("kind in ('o', 'a')").withColumn("cats", F.array().cast("array<string>"))
        if held.isEmpty():
            break
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    order = F.array(*[F.lit(c) for c in PII.CATEGORY_ORDER])
    listed = every.groupBy("id").agg(F.collect_set("category").alias("c"))
    return listed.select("id", F.posexplode(F.filter(order, lambda x: F.array_contains("c", x))).alias("ord", "category"))


def _container() -> Column:
    return F.when(F.col("kind").isin("o", "a"), F.col("v"))


def _below(held: DataFrame) -> DataFrame:
    """The children of the containers of ``held`` that are containers or have findings; a container's own findings go on with its first child, or alone."""
    asked = held.withColumn("record", F.col("user") | F.coalesce(_text_of("v", "$.fullname").startswith("t2_"), F.lit(False)))
    asked = asked.withColumn("t2", F.coalesce(_text_of("v", "$.kind") == "t2", F.lit(False))).withColumn("author", _text_of("v", "$.author"))
    kids = _typed(_children(asked, all_rows=True))
    in_object, none = F.col("p_kind") == "o", F.array().cast("array<string>")
    user = F.when(in_object, F.col("p_record") | (F.col("p_t2") & (F.col("key") == "data"))).otherwise(F.col("p_user"))
    carried = F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("p_cats")).otherwise(none)
    cats = F.concat(carried, _text_findings(), F.when(in_object, _key_findings()).otherwise(none))
    return kids.select(F.col("p_id").alias("id"), user.alias("user"), "kind", _container().alias("v"), cats.alias("cats")).filter(
        F.col("kind").isin("o", "a") | (F.size("cats") > 0))


def _text_findings() -> Column:
    """Categories of a string leaf."""
    return F.when(F.col("kind") == "s", PII.text_categories(F.col("str"))).otherwise(F.array().cast("array<string>"))


def _key_findings() -> Column:
    """Categories that an object's key gives with its value."""
    norm, name = F.array_join(PII.key_words(F.col("key")), "_"), PII.non_synthetic_username(F.col("str"))
    marked_author = F.coalesce(PII.has_synthetic_marker(F.coalesce("p_author", F.lit(""))), F.lit(False))
    url = norm.isin(*PII.PROFILE_URL_KEYS) | (F.col("p_record") & (norm == "url"))
    person = ((norm.isin(*PII.USERNAME_KEYS) & name) | ((norm == "author_fullname") & name & ~marked_author)
              | (F.col("p_record") & (norm == "name") & name) | (url & PII.non_synthetic_username(PII.profile_username(F.col("str")))))
    flags = F.array(F.when(PII.credential_shaped_key(F.col("key")), F.lit("credential-key")), F.when(person, F.lit("non-synthetic-username")))
    return F.filter(flags, lambda x: x.isNotNull())


# ---------------------------------------------------------------- redaction
def _quoted(s: Column) -> Column:
    """A string as JSON text."""
    j = F.to_json(F.array(s))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def redact(docs: DataFrame, id_col: str, json_col: str, raw_only: bool = True) -> DataFrame:
    """id, doc: JSON text with sensitive and path keys masked and free text cut.

    With ``raw_only`` (L5) only below a ``raw`` key, at any depth; else (L4)
    everywhere.  Null and invalid documents give null.  One row per input row:
    rows are told apart by a number of their own, so ids may repeat or be null.
    """
    base = cut_lineage(docs.select(F.col(id_col).alias("name"), F.monotonically_increasing_id().alias("id"), F.try_parse_json(json_col).alias("v")))
    top = _typed(base.filter(F.col("v").isNotNull())).select(
        "id", F.lit("").alias("path"), F.lit(None).cast("string").alias("up"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("key"),
        "kind", F.lit(not raw_only).alias("inside"), F.to_json("v").alias("leaf"), "v")
    levels = [cut_lineage(top)]
    while not (nodes := levels[-1].filter("kind in ('o', 'a')").select("id", "path", "kind", "inside", "v")).isEmpty():
        kids = _typed(_children(nodes))
        acts = F.col("p_inside") & (F.col("p_kind") == "o")
        mask = acts & (R.is_sensitive_key(F.col("key")) | R.is_path_key(F.col("key")))
        cut = acts & R.normalized_key(F.col("key")).isin(*R.TEXT_KEYS) & (F.col("kind") == "s")
        leaf = F.when(mask, F.lit(f'"{R.REDACTED}"')).when(cut, _quoted(R.redact_text(F.col("str")))).otherwise(F.to_json("v"))
        inside = F.col("p_inside") | ((F.col("p_kind") == "o") & (F.col("key") == "raw"))
        kind = F.when(mask, F.lit("x")).otherwise(F.col("kind"))
        levels.append(cut_lineage(kids.select(
            F.col("p_id").alias("id"), F.concat(F.col("p_path"), F.lit("."), F.col("pos").cast("string")).alias("path"), F.col("p_path").alias("up"),
            "pos", "key", kind.alias("kind"), inside.alias("inside"), F.when(kind.isin("o", "a"), F.lit(None)).otherwise(leaf).alias("leaf"),
            F.when(kind.isin("o", "a"), F.col("v")).alias("v"))))
    built = None
    for rows in reversed(levels):
        text = F.col("leaf")
        if built is not None:
            own = F.when(F.col("kind") == "o", F.concat(F.lit("{"), F.array_join(F.transform(
                F.col("l"), lambda x: F.concat(_quoted(x["key"]), F.lit(":"), x["text"])), ","), F.lit("}"))).otherwise(
                F.concat(F.lit("["), F.array_join(F.transform(F.col("l"), lambda x: x["text"]), ","), F.lit("]")))
            groups = built.groupBy(F.col("id").alias("g"), F.col("up").alias("gp")).agg(F.sort_array(F.collect_list(F.struct("pos", "key", "text"))).alias("l"))
            rows = rows.join(groups, (F.col("id") == F.col("g")) & (F.col("path") == F.col("gp")), "left")
            empty = F.when(F.col("kind") == "o", F.lit("{}")).otherwise(F.lit("[]"))
            text = F.when(F.col("kind").isin("o", "a"), F.when(F.col("l").isNull(), empty).otherwise(own)).otherwise(F.col("leaf"))
        built = rows.select("id", "up", "pos", "key", text.alias("text"))
    return base.select("id", "name").join(built.select("id", F.col("text").alias("doc")), "id", "left").select(F.col("name").alias("id"), "doc")
