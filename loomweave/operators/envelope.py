"""Fail-closed decode of Listing / thing envelopes into rows.

A violation never raises inside a task.  It becomes a ``drift`` struct
``(path, expected)`` on the response row; the first violation in document
order wins, and a response with drift contributes no items (the reference
rejects the whole response).  All checks are column expressions with
higher-order array functions, so decoding is narrow: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomweave.functions import coerce as C

# Fixed values that must equal the envelope model's.
THING_KINDS = ("t1", "t2", "t3", "t5", "more")
STRUCTURAL_KINDS = ("more",)

DRIFT_TYPE = "struct<path:string,expected:string>"


def drift(path: Column | str, expected: str) -> Column:
    p = F.lit(path) if isinstance(path, str) else path
    return F.struct(p.alias("path"), F.lit(expected).alias("expected"))


def no_drift() -> Column:
    return F.lit(None).cast(DRIFT_TYPE)


def kind_of(thing: Column) -> Column:
    return C.string_or_null(thing, "kind")


def thing_violation(thing: Column, path: Column) -> Column:
    """B1: object, allowed kind, object ``data``."""
    kind = kind_of(thing)
    return (F.when(~C.is_object(thing), drift(path, "a thing object"))
            .when(kind.isNull() | ~kind.isin(*THING_KINDS),
                  drift(F.concat(path, F.lit(".kind")), "t1, t2, t3, t5, or more"))
            .when(~C.has_object(thing, "data"),
                  drift(F.concat(path, F.lit(".data")), "an object")))


def listing_violation(v: Column, path: str, allowed_kinds: Iterable[str] | None = None,
                      child_kinds: Iterable[str] | None = None,
                      children: Column | None = None) -> Column:
    """B2 (+B7 when ``allowed_kinds`` is given): first violation of a Listing, or NULL.

    ``child_kinds`` restricts children structurally (t1/more inside replies, B6).
    ``allowed_kinds`` is the per-command filter: ``more`` is skipped, any other
    unexpected kind is drift.
    """
    data = C.get(v, "data")
    if children is None:
        children = C.as_array(C.get(data, "children"))
    after = C.get(data, "after")
    after_t = C.vtype(after)

    def child_check(c: Column, i: Column) -> Column:
        cpath = F.concat(F.lit(f"{path}.data.children["), i.cast("string"), F.lit("]"))
        check = thing_violation(c, cpath)
        if child_kinds is not None:
            check = F.coalesce(check, F.when(
                ~kind_of(c).isin(*child_kinds),
                drift(F.concat(cpath, F.lit(".kind")), " or ".join(child_kinds))))
        if allowed_kinds is not None:
            allowed = tuple(allowed_kinds)
            check = F.coalesce(check, F.when(
                ~kind_of(c).isin(*allowed, *STRUCTURAL_KINDS),
                drift(F.concat(cpath, F.lit(".kind")), "an allowed kind for this query")))
        return check

    first_child = F.element_at(
        F.filter(F.transform(children, child_check), lambda d: d.isNotNull()), 1)
    return (F.when(~C.is_object(v), drift(path, "a Listing object"))
            .when(F.coalesce(C.string_or_null(v, "kind"), F.lit("")) != "Listing",
                  drift(f"{path}.kind", "Listing"))
            .when(~C.is_object(data), drift(f"{path}.data", "an object"))
            .when(children.isNull(), drift(f"{path}.data.children", "a list"))
            .when(after.isNotNull() & (after_t != "VOID") & (after_t != "STRING"),
                  drift(f"{path}.data.after", "a string or null"))
            .otherwise(first_child))


def listing_after(v: Column) -> Column:
    return C.string_or_null(C.get(v, "data"), "after")


def listing_children(v: Column) -> Column:
    return C.as_array(C.get(C.get(v, "data"), "children"))


def explode_things(df: DataFrame, v_col: str, keep: list[str]) -> DataFrame:
    """One row per child thing: ``pos`` (0-based), ``kind``, ``data`` VARIANT."""
    return (df.select(*keep, F.posexplode(listing_children(F.col(v_col))).alias("pos", "thing"))
            .select(*keep, "pos", kind_of(F.col("thing")).alias("kind"),
                    C.get(F.col("thing"), "data").alias("data")))


def parse_body(df: DataFrame, body_col: str = "body") -> DataFrame:
    """A1: parse once to VARIANT; unparsable text becomes NULL (quarantine)."""
    return df.withColumn("v", F.try_parse_json(F.col(body_col)))


def listing_pages_checked(bronze: DataFrame, allowed_kinds: Iterable[str],
                          select_element: int | None = None) -> DataFrame:
    """Page-level decode: bronze + ``v`` + first ``drift`` (or NULL) + ``after`` cursor.

    ``select_element`` picks one element of a two-element array response first
    (B10, the related-discussions envelope).
    """
    df = parse_body(bronze)
    checks = [F.when(F.col("v").isNull() & F.col("body").isNotNull(),
                     drift("response", "a JSON body"))]
    if select_element is not None:
        arr = C.as_array(F.col("_resp"))
        df = df.withColumnRenamed("v", "_resp").withColumn(
            "v", F.when(F.size(arr) == 2, F.element_at(arr, select_element + 1)))
        checks = [F.when(F.col("_resp").isNull() & F.col("body").isNotNull(),
                         drift("response", "a JSON body")),
                  F.when(arr.isNull() | (F.size(arr) != 2), drift("response", "a two-element array"))]
    checks.append(listing_violation(F.col("v"), "response", allowed_kinds))
    return (df.withColumn("drift", F.coalesce(*checks))
            .withColumn("after", F.when(F.col("drift").isNull(), listing_after(F.col("v")))))


def decode_listing_pages(bronze: DataFrame, allowed_kinds: Iterable[str], keep: list[str],
                         select_element: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Decode listing responses into (items, drift)."""
    allowed_kinds = tuple(allowed_kinds)
    df = listing_pages_checked(bronze, allowed_kinds, select_element)
    ok = df.filter(F.col("drift").isNull())
    items = explode_things(ok, "v", keep + ["after"]).filter(F.col("kind").isin(*allowed_kinds))
    bad = df.filter(F.col("drift").isNotNull()).select(
        *keep, F.col("drift.path").alias("path"), F.col("drift.expected").alias("expected"))
    return items, bad


def about_verdict(bronze: DataFrame, expected_kind: str, keep: list[str],
                  empty_listing_is_absent: bool) -> DataFrame:
    """Single-record "about" envelope -> found / not_found / drift."""
    df = parse_body(bronze)
    v = F.col("v")
    kind = C.string_or_null(v, "kind")
    children = listing_children(v)
    is_thing = (kind == expected_kind) & C.is_object(C.get(v, "data"))
    absent = (kind == "Listing") & C.is_object(C.get(v, "data")) & (F.size(children) == 0)
    verdict = F.when(is_thing, F.lit("found"))
    if empty_listing_is_absent:
        verdict = verdict.when(absent, F.lit("not_found"))
    verdict = verdict.otherwise(F.lit("drift"))
    return df.select(*keep, "v", verdict.alias("verdict"),
                     F.when(is_thing, C.get(v, "data")).alias("data"))
