"""Identifier forms (invented names)."""

from pyspark.sql import functions as F

from loomweave.functions import identifiers as ID


def resolve(spark, kind, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    out = ID.resolve_df(df.withColumn("k", F.lit(kind)), "k", "raw", out="r").orderBy("i").collect()
    return [(r["r"]["kind"], r["r"]["community"], r["r"]["post_id"], r["r"]["comment_id"], r["r"]["error"])
            for r in out]


def test_subreddit_forms(spark):
    out = resolve(spark, "subreddit", ["pyth0n", "r/pyth0n", "/r/pyth0n/", "https://old.reddit.com/r/pyth0n",
                                       "www.reddit.com/r/pyth0n", "ab", "  ", "https://evil.example.com/r/x1x",
                                       "https://u:p@reddit.com/r/abc", "ftp://reddit.com/r/abc", "a/b/c"])
    assert [o[1] for o in out[:5]] == ["pyth0n"] * 5
    assert out[5][4] == "invalid subreddit name"
    assert out[6][4] == "subreddit identifier is empty"
    assert out[7][4] == "URL host must be an allowed site host"
    assert out[8][4] == "URLs must not contain credentials"
    assert out[9][4] == "only http/https URLs are accepted"
    assert out[10][4] == "invalid subreddit identifier"


def test_group_limits(spark):
    ok, too_many, empty = resolve(spark, "subreddit_group", [
        "aaa+bbb+ccc", "+".join(f"n{i:02d}" for i in range(11)), "aaa++bbb"])
    assert ok[:2] == ("subreddits", "aaa+bbb+ccc")
    assert too_many[4] == "too many subreddits in a combined listing"
    assert empty[4] == "invalid subreddit name"


def test_user_post_comment_permalinks(spark):
    assert resolve(spark, "user", ["u/some-one", "https://reddit.com/user/some_one"])[0][1] == "some-one"
    posts = resolve(spark, "post", ["t3_AbC12", "abc12", "https://www.reddit.com/r/sub/comments/AbC12/slug/",
                                    "https://www.reddit.com/r/sub/comments/AbC12/slug/x/y"])
    assert [p[2] for p in posts[:3]] == ["abc12"] * 3
    assert posts[3][4] == "invalid comment permalink"
    c = resolve(spark, "comment", ["https://np.reddit.com/r/sub/comments/p1/_/C9", "p1"])
    assert c[0][:4] == ("comment", "sub", "p1", "c9")
    assert c[1][4] == "a comment identifier must be a permalink"
    pl = resolve(spark, "permalink", ["https://reddit.com/r/sub/comments/p1/slug-only"])
    assert pl[0][0] == "post" and pl[0][3] is None


def test_plus_is_not_a_space(spark):
    out = resolve(spark, "subreddit_group", ["https://reddit.com/r/aaa+bbb"])
    assert out[0][1] == "aaa+bbb"


def test_look_alike_hosts_and_group_size(spark):
    out = resolve(spark, "subreddit", ["https://reddit.com.evil.example.org/r/abc",
                                       "https://www.reddit.com.evil.example.org/r/abc",
                                       "old.reddit.com/r/abc"])
    assert out[0][4] == out[1][4] == "URL host must be an allowed site host"
    assert out[2][:2] == ("subreddit", "abc")
    eleven = resolve(spark, "subreddit_group", ["+".join(f"abc{i}" for i in range(11))])
    ten = resolve(spark, "subreddit_group", ["+".join(f"abc{i}" for i in range(10))])
    assert eleven[0][4] == "too many subreddits in a combined listing" and ten[0][0] == "subreddits"


def test_whole_match_and_stray_percent(spark):
    out = resolve(spark, "subreddit", ["https://reddit.com/r/abc%0A", "https://reddit.com/r/a%62c", "https://reddit.com/r/ab%zz"])
    assert [o[4] for o in out] == ["invalid subreddit name", None, "invalid subreddit name"]
    assert out[1][1] == "abc"
    post = resolve(spark, "post", ["https://reddit.com/r/sub/comments/p1/100%", "https://reddit.com/r/sub/comments/p1%0A"])
    assert post[0][2] == "p1" and post[1][4] == "invalid post id"
