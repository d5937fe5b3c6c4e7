"""Normalisers from a thing's ``data`` VARIANT to typed columns.

Each builder returns an ordered list of Columns in the record's serialised
field order, so ``select(*post_columns(...))`` is the whole projection and
stays inside one whole-stage-codegen span (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomweave.functions import coerce as C

MEDIA_TYPE = "array<struct<kind:string,url:string,width:bigint,height:bigint>>"


def _media_struct(kind: str | Column, url: Column, width: Column, height: Column) -> Column:
    k = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(k.alias("kind"), url.alias("url"), width.cast("bigint").alias("width"),
                    height.cast("bigint").alias("height"))


def build_media(node: Column, kind: str | Column) -> Column:
    """``s`` sub-object when present; url from url/fallback_url/u (decoded)."""
    source = F.when(C.is_object(C.get(node, "s")), C.get(node, "s")).otherwise(node)
    url = F.coalesce(C.first_nonempty(C.text(source, "url"), C.text(source, "fallback_url"),
                                      C.text(source, "u")), F.lit(""))
    return _media_struct(kind, C.html_unescape(url), C.truthy_integer(source, "x", "width"),
                         C.truthy_integer(source, "y", "height"))


def _embed(url: Column, node: Column) -> Column:
    """Embed attachment from the post's own safe URL, sized by ``node``."""
    return F.when(url != "", F.array(_media_struct("embed", url, C.integer(node, "width"),
                                                   C.integer(node, "height"))))


def post_media(post: Column) -> Column:
    """Gallery > hosted video > oembed > media_embed > image; [] if none."""
    gallery = C.get(post, "gallery_data")
    metadata = F.try_variant_get(C.get(post, "media_metadata"), "$", "map<string,variant>")
    items = C.as_array(C.get(gallery, "items"))
    gallery_media = F.filter(
        F.transform(items, lambda item: F.when(
            C.is_object(item) & C.is_object(F.element_at(metadata, C.string_or_null(item, "media_id"))),
            build_media(F.element_at(metadata, C.string_or_null(item, "media_id")), "gallery"))),
        lambda m: m.isNotNull() & (m["url"] != ""))
    gallery_branch = F.when(C.is_object(gallery) & metadata.isNotNull(), gallery_media)

    secure = C.get(post, "secure_media")
    media = F.when(C.is_object(secure), secure).otherwise(C.get(post, "media"))
    video = C.get(media, "reddit_video")
    video_branch = F.when(C.is_object(media) & C.is_object(video),
                          F.filter(F.array(build_media(video, "video")), lambda m: m["url"] != ""))
    oembed = C.get(media, "oembed")
    embed = C.get(post, "media_embed")
    first_image = F.element_at(C.as_array(C.get(C.get(post, "preview"), "images")), 1)
    source = F.when(C.is_object(first_image) & C.is_object(C.get(first_image, "source")),
                    C.get(first_image, "source"))

    def from_url(url: Column) -> Column:
        oembed_branch = F.when(C.is_object(media) & C.is_object(oembed), _embed(url, oembed))
        embed_branch = F.when(C.is_object(embed), _embed(url, embed))
        image_branch = F.when((C.text(post, "post_hint") == "image") & (url != ""),
                              F.array(_media_struct("image", url, C.integer(source, "width"),
                                                    C.integer(source, "height"))))
        return F.coalesce(oembed_branch, embed_branch, image_branch, F.array().cast(MEDIA_TYPE))

    def some(branch: Column, otherwise: Column) -> Column:
        return C.bind(branch, lambda found: F.when(F.size(found) > 0, found).otherwise(otherwise))

    return some(gallery_branch, some(video_branch, C.bind(C.safe_external_url(C.text(post, "url")), from_url)))


def post_columns(d: Column, captured_at: Column, with_media: bool = True) -> list[Column]:
    """32 post columns in serialised order."""
    ident = C.strip_prefix(C.text(d, "id"), "t3_")
    is_self = C.boolean(d, "is_self")
    cols = [
        ident.alias("id"),
        C.fullname(C.text(d, "name"), "t3_", ident).alias("fullname"),
        C.site_url(C.text(d, "permalink")).alias("url"),
        F.when(~is_self, C.text(d, "url")).alias("link_url"),
        C.text(d, "subreddit").alias("subreddit"),
        C.text(d, "subreddit_name_prefixed").alias("subreddit_prefixed"),
        C.text(d, "author").alias("author"),
        C.opt_text(d, "author_fullname").alias("author_fullname"),
        C.text(d, "title").alias("title"),
        C.text(d, "selftext").alias("text"),
        C.timestamp(d, "created_utc").alias("created_at"),
        C.edited(d, "edited").alias("edited_at"),
        C.integer(d, "score").alias("score"),
        C.number(d, "upvote_ratio").alias("upvote_ratio"),
        C.integer(d, "num_comments").alias("num_comments"),
        C.integer(d, "num_crossposts").alias("num_crossposts"),
        C.opt_boolean(d, "over_18").alias("over_18"),
        C.boolean(d, "spoiler").alias("spoiler"),
        is_self.alias("is_self"),
        C.boolean(d, "is_video").alias("is_video"),
        C.boolean(d, "is_original_content").alias("is_original_content"),
        C.boolean(d, "stickied").alias("stickied"),
        C.boolean(d, "pinned").alias("pinned"),
        C.boolean(d, "locked").alias("locked"),
        C.opt_text(d, "distinguished").alias("distinguished"),
        C.opt_text(d, "link_flair_text").alias("flair"),
        C.opt_text(d, "domain").alias("domain"),
        C.opt_text(d, "thumbnail").alias("thumbnail"),
    ]
    if with_media:
        cols.append(post_media(d).alias("media"))
    cols += [
        C.integer(d, "total_awards_received").alias("total_awards"),
        C.opt_text(d, "removed_by_category").alias("removed"),
        captured_at.alias("captured_at"),
    ]
    return cols


def comment_fields(d: Column, captured_at: Column | None = None) -> list[tuple[str, Column]]:
    """Comment fields in serialised order (``replies``/``more_count`` come from the forest)."""
    ident = C.strip_prefix(C.text(d, "id"), "t1_")
    fields = [
        ("id", ident),
        ("fullname", C.fullname(C.text(d, "name"), "t1_", ident)),
        ("permalink", C.site_url(C.text(d, "permalink"))),
        ("post_id", C.text(d, "link_id")),
        ("subreddit", C.text(d, "subreddit")),
        ("parent_id", C.text(d, "parent_id")),
        ("author", C.text(d, "author")),
        ("author_fullname", C.opt_text(d, "author_fullname")),
        ("text", C.text(d, "body")),
        ("created_at", C.timestamp(d, "created_utc")),
        ("edited_at", C.edited(d, "edited")),
        ("score", C.integer(d, "score")),
        ("depth", C.integer(d, "depth")),
        ("is_submitter", C.boolean(d, "is_submitter")),
        ("stickied", C.boolean(d, "stickied")),
        ("distinguished", C.opt_text(d, "distinguished")),
        ("controversiality", C.integer(d, "controversiality")),
        ("collapsed", C.boolean(d, "collapsed")),
        ("score_hidden", C.boolean(d, "score_hidden")),
        ("total_awards", C.integer(d, "total_awards_received")),
    ]
    if captured_at is not None:
        fields.append(("captured_at", captured_at))
    return fields


def comment_columns(d: Column, captured_at: Column) -> list[Column]:
    return [c.alias(n) for n, c in comment_fields(d, captured_at)]


def community_fields(d: Column, captured_at: Column) -> list[tuple[str, Column]]:
    """D3: community record; note ``over18`` (no underscore) on input."""
    ident = C.strip_prefix(C.text(d, "id"), "t5_")
    return [
        ("id", ident),
        ("fullname", C.fullname(C.text(d, "name"), "t5_", ident)),
        ("name", C.text(d, "display_name")),
        ("prefixed", C.text(d, "display_name_prefixed")),
        ("title", C.text(d, "title")),
        ("public_description", C.text(d, "public_description")),
        ("description", C.text(d, "description")),
        ("subscribers", C.integer(d, "subscribers")),
        ("created_at", C.timestamp(d, "created_utc")),
        ("over_18", C.opt_boolean(d, "over18")),
        ("subreddit_type", C.opt_text(d, "subreddit_type")),
        ("url", C.site_url(C.text(d, "url"))),
        ("lang", C.opt_text(d, "lang")),
        ("icon_url", C.first_nonempty(C.text(d, "community_icon"), C.text(d, "icon_img"))),
        ("quarantine", C.boolean(d, "quarantine")),
        ("captured_at", captured_at),
    ]


def community_columns(d: Column, captured_at: Column) -> list[Column]:
    return [c.alias(n) for n, c in community_fields(d, captured_at)]


def user_fields(d: Column, captured_at: Column) -> list[tuple[str, Column]]:
    """User record; a ``t2_``-looking name falls back to the profile display name."""
    ident = C.strip_prefix(C.text(d, "id"), "t2_")
    raw_name = C.text(d, "name")
    profile = C.get(d, "subreddit")
    name = F.when(raw_name.startswith("t2_"),
                  F.when(C.is_object(profile), C.text(profile, "display_name")).otherwise(F.lit("")))
    return [
        ("id", ident),
        ("fullname", C.fullname(raw_name, "t2_", ident)),
        ("name", name.otherwise(raw_name)),
        ("created_at", C.timestamp(d, "created_utc")),
        ("link_karma", C.integer(d, "link_karma")),
        ("comment_karma", C.integer(d, "comment_karma")),
        ("total_karma", C.integer(d, "total_karma")),
        ("is_gold", C.boolean(d, "is_gold")),
        ("is_mod", C.boolean(d, "is_mod")),
        ("is_employee", C.boolean(d, "is_employee")),
        ("verified", C.boolean(d, "verified")),
        ("has_verified_email", C.boolean(d, "has_verified_email")),
        ("icon_url", C.first_nonempty(C.text(d, "icon_img"), C.text(d, "snoovatar_img"))),
        ("accept_followers", C.boolean(d, "accept_followers")),
        ("captured_at", captured_at),
    ]


def user_columns(d: Column, captured_at: Column) -> list[Column]:
    return [c.alias(n) for n, c in user_fields(d, captured_at)]
