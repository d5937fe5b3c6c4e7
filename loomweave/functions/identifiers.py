"""Identifier normalisation as column expressions.

Every resolver returns ``struct<kind, community, post_id, comment_id, error>``;
an invalid identifier yields ``error`` text instead of an exception, so a
table of raw identifiers resolves in one projection.  URLs are split with a
regex that follows ``urlsplit`` (scheme, netloc, path), not a strict URI
parser, so lenient inputs behave as in the reference.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
ALLOWED_HOSTS = ("reddit.com", "www.reddit.com", "old.reddit.com", "np.reddit.com", "sh.reddit.com")
SUBREDDIT_RE = r"\A[A-Za-z0-9_]{3,21}\z"
USERNAME_RE = r"\A[A-Za-z0-9_-]{3,20}\z"
ID36_RE = r"\A[0-9A-Za-z]{1,10}\z"
MAX_GROUP = 10

_URL_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):(//([^/?#]*))?([^?#]*)"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _result(kind=None, community=None, post=None, comment=None, error=None) -> Column:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x).cast("string")
    return F.struct(lit(kind).alias("kind"), lit(community).alias("community"),
                    lit(post).alias("post_id"), lit(comment).alias("comment_id"),
                    lit(error).alias("error"))


def _err(msg: str) -> Column:
    return _result(error=msg)


class Hosts:
    """Exact host allowlist (the reference's) plus optional allowed parent domains."""

    def __init__(self, exact: Iterable[str] = ALLOWED_HOSTS, suffixes: Iterable[str] = ()):
        self.exact = tuple(h.lower() for h in exact)
        self.suffixes = tuple(s.lower() for s in suffixes)

    def allowed(self, host: Column) -> Column:
        ok = host.isin(*self.exact)
        for s in self.suffixes:
            ok = ok | (host == s) | host.endswith("." + s)
        return ok

    def prefixed(self, lowered: Column) -> Column:
        """``value`` starts with ``<allowed host>/`` (the no-scheme URL form)."""
        head = F.regexp_extract(lowered, r"^([^/]*)/", 1)
        return (F.instr(lowered, "/") > 0) & self.allowed(head)


def looks_like_url(v: Column, hosts: Hosts) -> Column:
    return (F.instr(v, "://") > 0) | hosts.prefixed(F.lower(v))


def url_segments(v: Column, hosts: Hosts) -> tuple[Column, Column]:
    """``(segments, error)`` of an allowed http(s) URL without credentials."""
    cand = F.when(F.instr(v, "://") > 0, v).otherwise(F.concat(F.lit("https://"), v))
    scheme = F.lower(F.regexp_extract(cand, _URL_RE, 1))
    netloc = F.regexp_extract(cand, _URL_RE, 3)
    path = F.regexp_extract(cand, _URL_RE, 4)
    host = F.lower(F.regexp_replace(F.regexp_replace(netloc, r"^.*@", ""), r":[0-9]*$", ""))
    host = F.regexp_replace(host, r"^\[|\]$", "")
    # url_decode maps '+' to a space and fails at a % that starts no escape; both stand for themselves.
    stray = F.regexp_replace(path, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.try_url_decode(F.replace(stray, F.lit("+"), F.lit("%2B")))
    segments = F.filter(F.split(decoded, "/"), lambda s: s != "")
    error = (F.when(~scheme.isin("http", "https"), F.lit("only http/https URLs are accepted"))
             .when(F.instr(netloc, "@") > 0, F.lit("URLs must not contain credentials"))
             .when((host == "") | ~hosts.allowed(host), F.lit("URL host must be an allowed site host"))
             .when(decoded.isNull(), F.lit("malformed URL path")))
    return segments, error


def resolve_df(df, kind_col: str, raw_col: str, hosts: Hosts = Hosts(), out: str = "resolved"):
    """E1-E9 over a DataFrame with the shared parts computed once per row: the trimmed
    value, URL split and path segments are columns, and every resolver is a small
    expression over them.
    """
    raw = F.col(raw_col)
    v = _strip(raw)
    staged = df.withColumn("_v", v).withColumn("_is_url", looks_like_url(F.col("_v"), hosts))
    segs, uerr = url_segments(F.col("_v"), hosts)
    staged = (staged.withColumn("_segs", segs).withColumn("_uerr", uerr)
              .withColumn("_parts", F.filter(F.split(F.col("_v"), "/"), lambda s: s != "")))
    V, U, SG, UE, PT = (F.col(c) for c in ("_v", "_is_url", "_segs", "_uerr", "_parts"))
    kind = F.col(kind_col)
    label = (F.when(kind.isin("subreddit", "subreddit_group"), F.lit("subreddit"))
             .otherwise(kind))
    req = (F.when(raw.isNull(), F.concat(label, F.lit(" identifier must be text")))
           .when(V == "", F.concat(label, F.lit(" identifier is empty"))))

    def named(prefixes, url_msg, bad_msg):
        url_ok = (F.size(SG) == 2) & F.lower(F.element_at(SG, 1)).isin(*prefixes)
        one = F.size(PT) == 1
        two = (F.size(PT) == 2) & F.lower(F.element_at(PT, 1)).isin(*prefixes)
        name = (F.when(U, F.when(UE.isNull() & url_ok, F.element_at(SG, 2)))
                .when(one, F.element_at(PT, 1)).when(two, F.element_at(PT, 2)))
        err = F.when(U, F.coalesce(UE, F.when(~url_ok, F.lit(url_msg)))).when(~(one | two), F.lit(bad_msg))
        return name, err

    sub_name, sub_err = named(("r",), "expected a subreddit URL", "invalid subreddit identifier")
    user_name, user_err = named(("u", "user"), "expected a user URL", "invalid user identifier")
    names = F.split(sub_name, r"\+", -1)
    # permalink parts from the shared segments
    ok_shape = ((F.size(SG) >= 4) & (F.lower(F.element_at(SG, 1)) == "r")
                & (F.lower(F.element_at(SG, 3)) == "comments"))
    community, post_seg = F.element_at(SG, 2), F.element_at(SG, 4)
    tail_n = F.size(SG) - 4
    com_seg = F.when(tail_n == 2, F.element_at(SG, 6))
    perm_err = (F.when(UE.isNotNull(), UE).when(~ok_shape, F.lit("expected a post permalink"))
                .when(~community.rlike(SUBREDDIT_RE), F.lit("invalid subreddit name"))
                .when(~post_seg.rlike(ID36_RE), F.lit("invalid post id"))
                .when(tail_n > 2, F.lit("invalid comment permalink"))
                .when(com_seg.isNotNull() & ~com_seg.rlike(ID36_RE), F.lit("invalid comment id")))
    perm_kind = F.when(com_seg.isNotNull(), F.lit("comment")).otherwise(F.lit("post"))
    bare = F.regexp_replace(F.regexp_replace(V, "^t3_", ""), "^T3_", "")

    result = (
        F.when(req.isNotNull(), _result(error=req))
        .when(kind == "subreddit", F.when(sub_err.isNotNull(), _result(error=sub_err))
              .when(~sub_name.rlike(SUBREDDIT_RE), _err("invalid subreddit name"))
              .otherwise(_result("subreddit", sub_name)))
        .when(kind == "subreddit_group", F.when(sub_err.isNotNull(), _result(error=sub_err))
              .when(F.size(names) > MAX_GROUP, _err("too many subreddits in a combined listing"))
              .when(~F.forall(names, lambda s: s.rlike(SUBREDDIT_RE)), _err("invalid subreddit name"))
              .otherwise(_result("subreddits", sub_name)))
        .when(kind == "user", F.when(user_err.isNotNull(), _result(error=user_err))
              .when(~user_name.rlike(USERNAME_RE), _err("invalid username"))
              .otherwise(_result("user", user_name)))
        .when(kind == "post", F.when(U, F.when(perm_err.isNotNull(), _result(error=perm_err))
                                     .otherwise(_result("post", community, F.lower(post_seg))))
              .when(~bare.rlike(ID36_RE), _err("invalid post id"))
              .otherwise(_result("post", None, F.lower(bare))))
        .when(kind == "comment", F.when(~U, _err("a comment identifier must be a permalink"))
              .when(perm_err.isNotNull(), _result(error=perm_err))
              .when(com_seg.isNull(), _err("expected a comment permalink"))
              .otherwise(_result("comment", community, F.lower(post_seg), F.lower(com_seg))))
        .when(kind == "permalink", F.when(~U, _err("a permalink must be a site URL"))
              .when(perm_err.isNotNull(), _result(error=perm_err))
              .otherwise(_result(perm_kind, community, F.lower(post_seg), F.lower(com_seg))))
        .otherwise(_err("unknown identifier kind")))
    return staged.withColumn(out, result).drop("_v", "_is_url", "_segs", "_uerr", "_parts")
