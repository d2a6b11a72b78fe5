"""SRC-2, SRC-3, SRC-4: JSON of comment threads, post searches and commit streams as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import clean_label, text_or_empty
from siftline.functions.urls import public_url
from siftline.schemas import COMMENT_PAGE, COMMIT_EVENT, POST_PAGE
from siftline.sources.records import to_records

# The shape of a zoned time, the link feature and the wanted collection.
ZONED = r"(?:[Zz]|[+-]\d{2}:\d{2})$"
LINK_FEATURE = "app.bsky.richtext.facet#link"
POSTS = "app.bsky.feed.post"


def zoned_time(c: Column) -> Column:
    """Timestamp of an RFC 3339 text; null without a zone."""
    return F.when(c.rlike(ZONED), F.try_to_timestamp(c))


def comment_records(pages: DataFrame, body: str = "body", video: str = "video") -> DataFrame:
    """SRC-2: one record per comment of a thread page; rows without id or zoned time are dropped."""
    parsed = pages.select(F.col(video).alias("_video"), F.explode(F.from_json(body, COMMENT_PAGE)["items"]).alias("c"))
    s = F.col("c.snippet")
    channel = text_or_empty(s["authorChannelId"]["value"])
    who = F.when(channel != "", channel).otherwise(F.col("c.id"))
    link = public_url(s["authorChannelUrl"])
    rows = parsed.filter(F.col("c.id").isNotNull()).select(
        F.lit("youtube").alias("source"), F.col("c.id").alias("source_record_id"), who.alias("identity"),
        F.coalesce(s["textOriginal"], s["textDisplay"], F.lit("")).alias("text"),
        F.concat(F.lit("https://www.youtube.com/watch?v="), "_video", F.lit("&lc="), "c.id").alias("url"),
        zoned_time(s["publishedAt"]).alias("published_at"), clean_label(s["authorDisplayName"]).alias("display_name"),
        F.when(link != "", F.array(link)).otherwise(F.array().cast("array<string>")).alias("urls"),
        F.create_map(F.lit("video_id"), F.col("_video"), F.lit("comment_id"), F.col("c.id"), F.lit("channel_id"), channel).alias("metadata"))
    return to_records(rows.filter("published_at IS NOT NULL"))


def _links(post: Column) -> Column:
    """Link facets (first 20 facets, first 5 features each), then the embedded link."""
    none = F.array().cast("array<string>")
    facets = F.slice(F.coalesce(post["facets"], F.array().cast(
        "array<struct<features:array<struct<`$type`:string,uri:string>>>>")), 1, 20)
    uris = F.flatten(F.transform(facets, lambda f: F.coalesce(F.transform(
        F.filter(F.slice(f["features"], 1, 5), lambda x: x["$type"] == LINK_FEATURE), lambda x: text_or_empty(x["uri"])), none)))
    outer = text_or_empty(post["embed"]["external"]["uri"])
    return F.concat(uris, F.when(outer != "", F.array(outer)).otherwise(none))


def _post_rows(rows: DataFrame, post: Column, did: Column, rkey: Column, name: Column, handle: Column, profile: Column,
               collection: Column) -> DataFrame:
    fine = did.startswith("did:") & (rkey != "") & ~F.contains(rkey, F.lit("/"))
    out = rows.filter(F.coalesce(fine, F.lit(False))).select(
        F.lit("bluesky").alias("source"), F.concat(did, F.lit("/"), rkey).alias("source_record_id"), did.alias("identity"),
        text_or_empty(post["text"]).alias("text"),
        F.concat(F.lit("https://bsky.app/profile/"), did, F.lit("/post/"), rkey).alias("url"),
        zoned_time(post["createdAt"]).alias("published_at"), clean_label(name).alias("display_name"),
        clean_label(handle).alias("username"), _links(post).alias("urls"), profile.alias("profile_url"),
        F.create_map(F.lit("did"), did, F.lit("rkey"), rkey, F.lit("collection"), collection).alias("metadata"))
    return to_records(out.filter("published_at IS NOT NULL"))


def post_records(pages: DataFrame, body: str = "body") -> DataFrame:
    """SRC-3: one record per post of a search page."""
    rows = pages.select(F.explode(F.from_json(body, POST_PAGE)["posts"]).alias("p"))
    did = F.col("p.author.did")
    rkey = F.regexp_extract("p.uri", r"/([^/]*)$", 1)
    return _post_rows(rows, F.col("p.record"), did, rkey, F.col("p.author.displayName"), F.col("p.author.handle"),
                      F.concat(F.lit("https://bsky.app/profile/"), did), F.lit(POSTS))


def commit_records(events: DataFrame, body: str | None = None, collection: str = POSTS) -> DataFrame:
    """SRC-4: created posts of a commit stream; batch or streaming input."""
    rows = events.select(F.from_json(body, COMMIT_EVENT).alias("e")).select("e.*") if body else events
    made = rows.filter((F.col("commit.operation") == "create") & (F.col("commit.collection") == collection))
    none = F.lit("")
    return _post_rows(made, F.col("commit.record"), F.col("did"), F.col("commit.rkey"), none, none, none, F.col("commit.collection"))


def with_bios(records: DataFrame, bios: DataFrame, limit: int | None = 1000) -> DataFrame:
    """JN-9: author bio by identity, distinct ids, '' when missing; bounded as the profile field is, or whole."""
    from siftline.operators.keys import lookup

    known = bios.groupBy("identity").agg(F.min("bio").alias("_bio"))
    joined = lookup(records, known, "identity")
    bio = text_or_empty(F.col("_bio"))
    return joined.withColumn("bio", F.left(bio, F.lit(limit)) if limit else bio).drop("_bio")
