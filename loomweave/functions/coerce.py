"""Strict typed coercions over VARIANT values (column expressions only).

Every helper takes the VARIANT holding a thing's ``data`` object and a key,
and returns a typed Column.  The rules follow the record model exactly:
a value of the wrong JSON type never leaks through a lenient cast.

``try_variant_get(..., 'bigint')`` would turn ``true`` into 1 and ``42.0``
into 42, so every cast is gated on ``schema_of_variant`` of the field.
``parse_json`` reads ``1.0`` as ``DECIMAL(1,0)``; the model rejects floats as
integers, so only ``BIGINT`` (and digit strings) count as integers.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the model's.
SITE_BASE = "https://www.reddit.com"
# Python datetime covers years 1..9999; epoch seconds outside are rejected.
MIN_EPOCH = -62135596800
MAX_EPOCH_EXCLUSIVE = 253402300800


def _path(key: str) -> str:
    if key.startswith("$"):
        return key
    return "$." + ".".join(f"['{part}']" if not part.isidentifier() else part
                           for part in key.split("."))


class Fields:
    """An object whose values are already apart: a struct column with a VARIANT per key."""

    def __init__(self, struct: Column):
        self.struct = struct


class Sorted:
    """An object whose values are already apart by JSON type, in columns named ``<letter>_<key>``.

    ``s_`` holds strings, ``i_`` integers in the range of BIGINT, ``f_`` any finite number, ``b_`` booleans; NULL
    where the value is absent or of another type.  Only the letters that a key's rule reads are there.
    """

    def at(self, letter: str, key: str) -> Column:
        return F.col(f"{letter}_{key}")


def get(v: Column | Fields, key: str) -> Column:
    """Raw VARIANT at ``key`` (SQL NULL when absent or ``v`` is not an object)."""
    if isinstance(v, Fields):
        return v.struct[key]
    return F.try_variant_get(v, _path(key), "variant")


def vtype(x: Column) -> Column:
    """Type name of a VARIANT value: BIGINT, DOUBLE, DECIMAL(p,s), STRING, BOOLEAN, VOID, OBJECT<..>."""
    return F.schema_of_variant(x)


def is_object(x: Column) -> Column:
    """True when ``x`` is a JSON object (cheap: casts to an empty struct)."""
    return F.try_variant_get(x, "$", "struct<>").isNotNull()


def has_object(x: Column, key: str) -> Column:
    """True when ``x[key]`` is a JSON object, without materialising the value."""
    return F.try_variant_get(x, _path(key), "struct<>").isNotNull()


def as_array(x: Column) -> Column:
    """``array<variant>`` when ``x`` is a JSON array, else NULL."""
    return F.try_variant_get(x, "$", "array<variant>")


def _is_numeric_type(t: Column) -> Column:
    return t.isin("BIGINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL")


def string_or_null(v: Column | Sorted, key: str) -> Column:
    if isinstance(v, Sorted):
        return v.at("s", key)
    x = get(v, key)
    return F.when(vtype(x) == "STRING", F.try_variant_get(x, "$", "string"))


def text(v: Column, key: str, default: str = "") -> Column:
    """The value if it is a string, else ``default``."""
    return F.coalesce(string_or_null(v, key), F.lit(default))


def opt_text(v: Column, key: str) -> Column:
    """Nullable string: a string that is empty becomes NULL."""
    return F.nullif(text(v, key), F.lit(""))


def digits(text: Column) -> Column:
    """The integer that a digit string names, white space around it trimmed."""
    s = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(s.rlike(r"^-?[0-9]+$"), s.try_cast("bigint"))


def integer(v: Column | Sorted, key: str) -> Column:
    """JSON integers and trimmed digit strings; bool and float rejected."""
    if isinstance(v, Sorted):
        return F.coalesce(v.at("i", key), digits(v.at("s", key)))
    x = get(v, key)
    t = vtype(x)
    return (F.when(t == "BIGINT", F.try_variant_get(x, "$", "bigint"))
            .when(t == "STRING", digits(F.try_variant_get(x, "$", "string"))))


def number(v: Column | Sorted, key: str) -> Column:
    """Any JSON number as DOUBLE; bool and strings rejected."""
    if isinstance(v, Sorted):
        return v.at("f", key)
    x = get(v, key)
    return F.when(_is_numeric_type(vtype(x)), F.try_variant_get(x, "$", "double"))


def boolean(v: Column | Sorted, key: str) -> Column:
    """C4: a real JSON boolean, anything else is false."""
    if isinstance(v, Sorted):
        return F.coalesce(v.at("b", key), F.lit(False))
    x = get(v, key)
    return F.coalesce(F.when(vtype(x) == "BOOLEAN", F.try_variant_get(x, "$", "boolean")),
                      F.lit(False))


def opt_boolean(v: Column, key: str) -> Column:
    """Three-state flag; absent or malformed is NULL (unknown, not safe)."""
    x = get(v, key)
    return F.when(vtype(x) == "BOOLEAN", F.try_variant_get(x, "$", "boolean"))


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds (double) to TIMESTAMP with the model's range guard."""
    return F.when((seconds >= MIN_EPOCH) & (seconds < MAX_EPOCH_EXCLUSIVE),
                  F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint")))


def timestamp(v: Column, key: str) -> Column:
    """Numbers only, UTC, NaN/out of range -> NULL."""
    return epoch_to_ts(number(v, key))


def edited(v: Column, key: str) -> Column:
    """``false`` means never edited; booleans are already rejected by C6."""
    return timestamp(v, key)


def strip_prefix(s: Column, prefix: str) -> Column:
    """Id without its thing-type prefix."""
    return F.when(s.startswith(prefix), s.substr(F.lit(len(prefix) + 1), F.length(s))).otherwise(s)


def fullname(name: Column, prefix: str, ident: Column) -> Column:
    """``name`` when it carries the prefix, else prefix + id."""
    return F.when(name.startswith(prefix), name).otherwise(F.concat(F.lit(prefix), ident))


def site_url(s: Column, base: str = SITE_BASE) -> Column:
    """Absolute URL from a site-relative path."""
    return F.when(s.startswith("/"), F.concat(F.lit(base), s)).otherwise(s)


def iso(ts: Column) -> Column:
    """C11: ISO-8601 UTC text with ``Z``; the fraction only when non-zero."""
    has_fraction = (F.unix_micros(ts) % 1_000_000) != 0
    return (F.when(ts.isNull(), F.lit(None).cast("string"))
            .when(has_fraction, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` written into the plan once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _code_point_text(code: Column) -> Column:
    """The character of a numeric reference under the HTML5 rules (its cases for control, surrogate and unassigned codes)."""
    high_latin = F.array(*[F.lit(bytes([n]).decode("cp1252", "ignore") or chr(n)) for n in range(0x80, 0xA0)])
    return (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd"))
            .when(code.between(0x80, 0x9F), F.get(high_latin, code - 0x80))
            .when(code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F)
                  | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), F.lit(""))
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


def _code(digits: Column, base: int, longest: int) -> Column:
    """A reference's number; one with more digits than any code point has counts as out of range."""
    bare = F.regexp_replace(digits, "^0+", "")
    return (F.when(F.length(bare) > longest, F.lit(0x110000)).when(bare == "", F.lit(0))
            .otherwise(F.conv(bare, base, 10).cast("int")))


def _literal_map(pairs: dict[str, str]) -> Column:
    """A map that Catalyst folds to one literal."""
    return F.str_to_map(F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in pairs.items())), F.lit("\u0001"), F.lit("\u0002"))


def html_unescape(s: Column) -> Column:
    """Decode every HTML5 character reference, in one pass from left to right.

    The text is cut before each ``&``; each piece starts with at most one
    reference, so a decoded ``&`` is never read again (``&amp;lt;`` gives
    ``&lt;``).  Names come from the public HTML5 entity list; those that it also
    has without a semicolon match as the longest prefix.
    """
    closed = _literal_map({k: v for k, v in html5.items() if k.endswith(";")})
    bare = {k: v for k, v in html5.items() if not k.endswith(";")}
    opened, starts = _literal_map(bare), "^(" + "|".join(sorted(bare, key=lambda k: (-len(k), k))) + ")"

    def numeric(t: Column) -> Column:
        dec, hexa = F.regexp_extract(t, "^&#([0-9]+);?", 1), F.regexp_extract(t, "^&#[xX]([0-9a-fA-F]+);?", 1)
        code = F.when(dec != "", _code(dec, 10, 7)).when(hexa != "", _code(hexa, 16, 6))
        rest = F.regexp_replace(t, "^&#([0-9]+|[xX][0-9a-fA-F]+);?", "")
        return bind(code, lambda c: F.when(c.isNull(), t).otherwise(F.concat(_code_point_text(c), rest)))

    def piece(t: Column) -> Column:
        name = F.regexp_extract(t, r"^&([^\t\n\f <&#;]{1,32};)", 1)
        prefix = F.regexp_extract(t.substr(F.lit(2), F.length(t)), starts, 1)
        exact = F.when(name != "", F.concat(F.try_element_at(closed, name), t.substr(F.length(name) + 2, F.length(t))))
        return (F.when(~t.startswith("&"), t)
                .when(t.startswith("&#"), numeric(t))
                .when(exact.isNotNull(), exact)
                .when(prefix != "", F.concat(F.try_element_at(opened, prefix), t.substr(F.length(prefix) + 2, F.length(t))))
                .otherwise(t))

    return bind(s, lambda x: F.when(F.instr(x, "&") == 0, x).otherwise(
        F.array_join(F.transform(F.split(x, "(?=&)", -1), piece), "")))


def safe_external_url(s: Column) -> Column:
    """http/https URL with a host, else ''."""
    def checked(url: Column) -> Column:
        proto = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
        host = F.try_parse_url(url, F.lit("HOST"))
        ok = proto.isin("http", "https") & host.isNotNull() & (host != "")
        return F.when(ok, url).otherwise(F.lit(""))

    return bind(html_unescape(F.coalesce(s, F.lit(""))), checked)


def first_nonempty(*cols: Column) -> Column:
    """C14: first non-empty string (NULL if none)."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def truthy_integer(v: Column, key: str, fallback: str) -> Column:
    """``_integer(a or b)``: a falsy first value (absent, 0, '', false) falls through."""
    x = get(v, key)
    t = vtype(x)
    falsy = (x.isNull() | (t == "VOID")
             | ((t == "BIGINT") & (F.try_variant_get(x, "$", "bigint") == 0))
             | (t.startswith("DECIMAL") & (F.try_variant_get(x, "$", "double") == 0))
             | ((t == "DOUBLE") & (F.try_variant_get(x, "$", "double") == 0))
             | ((t == "STRING") & (F.try_variant_get(x, "$", "string") == ""))
             | ((t == "BOOLEAN") & ~F.try_variant_get(x, "$", "boolean"))
             | (t == "ARRAY<>") | (t == "OBJECT<>"))
    return F.when(falsy, integer(v, fallback)).otherwise(integer(v, key))
