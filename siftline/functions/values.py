"""Placement names, durations, tokens, keys of delivered rows and the delivered row itself."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, functions as F

from siftline.functions.emails import bucket
from siftline.functions.profile import greeting_name, salutation
from siftline.functions.text import digest, source_evidence, text_or_empty
from siftline.functions.urls import host_of, url_part

# The delivered fields in order, the tab names and the id pattern.
FIELDS = ["lead_id", "campaign_id", "display_name", "first_name", "salutation", "username", "business_name", "email",
          "source", "source_evidence", "source_url", "email_source_url", "product_type", "rank_score", "score",
          "validation_status", "created_at"]
TAB = r"^(?:VALIDATED_(?:([A-Z]|OTHER)_)?|(PROSPECTS)_)(\d{3,})$"
LEAD_ID = r"^[A-Za-z0-9_-]{1,64}:\d{1,18}$"
WEEK_SECONDS = 604_800
MAX_EXACT_INTEGER = 9_007_199_254_740_991


def tab_name(bucket_name: Column, position: Column, shard_rows: int) -> Column:
    """TXT-29: tab of a 0-based position; a null bucket is the sequential layout."""
    shard = F.format_string("%03d", F.floor(position / F.lit(shard_rows)) + 1)
    lettered = F.when(bucket_name == "PROSPECTS", F.concat(F.lit("PROSPECTS_"), shard))
    lettered = lettered.when(bucket_name.isNull(), F.concat(F.lit("VALIDATED_"), shard))
    return lettered.otherwise(F.concat(F.lit("VALIDATED_"), bucket_name, F.lit("_"), shard))


def tab_row(position: Column, shard_rows: int) -> Column:
    """TXT-29: row in the tab; row 1 is the header."""
    return (F.pmod(position, F.lit(shard_rows)) + 2).cast("int")


def tab_bucket(tab: Column) -> Column:
    """Bucket of a tab name, SEQUENTIAL without a letter, null when the name is no tab."""
    letter, prospects = F.regexp_extract(tab, TAB, 1), F.regexp_extract(tab, TAB, 2)
    named = F.when(prospects != "", F.lit("PROSPECTS")).when(letter != "", letter).otherwise(F.lit("SEQUENTIAL"))
    return F.when(tab.rlike(TAB), named)


def tab_shard(tab: Column) -> Column:
    return F.regexp_extract(tab, TAB, 3).try_cast("int")


def duration_seconds(c: Column) -> Column:
    """TXT-31: seconds of a plain number or of ``1h2m3.5s``; null when malformed or over a week."""
    unit = r"(\d+(?:\.\d+)?)(ms|s|m|h|d)"
    compact = c.rlike(f"^(?:{unit})+$")
    amounts = F.regexp_extract_all(c, F.lit(unit), F.lit(1))
    units = F.regexp_extract_all(c, F.lit(unit), F.lit(2))
    factor = F.create_map(F.lit("ms"), F.lit(0.001), F.lit("s"), F.lit(1.0), F.lit("m"), F.lit(60.0), F.lit("h"),
                          F.lit(3600.0), F.lit("d"), F.lit(86400.0))
    parts = F.zip_with(amounts, units, lambda a, u: a.try_cast("double") * F.try_element_at(factor, u))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    number = F.when(c.rlike(r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"), F.trim(c).try_cast("double"))
    value = F.when(compact, total).otherwise(number)
    return F.when(value.between(0, WEEK_SECONDS), value)


def reset_seconds(c: Column) -> Column:
    """TXT-31, second form: ``XmY.Zs`` of a reset header, a minute when it cannot be read."""
    shape = r"^(?:(\d+)m)?(?:([\d.]+)s)?$"
    minutes = F.coalesce(F.regexp_extract(c, shape, 1).try_cast("double"), F.lit(0.0))
    secs = F.coalesce(F.regexp_extract(c, shape, 2).try_cast("double"), F.lit(0.0))
    return F.when(text_or_empty(c).rlike(shape), F.when(text_or_empty(c) == "", F.lit(0.0)).otherwise(minutes * 60 + secs)).otherwise(F.lit(60.0))


def backoff(at: Column, attempts: Column, unit: str) -> Column:
    """TXT-32: next try: 2^n minutes, up to 24 hours by hours, up to an hour by 30-second steps."""
    power = F.pow(F.lit(2.0), attempts.cast("double"))
    secs = {"minutes": power * 60, "hours": F.least(F.lit(24.0), power) * 3600,
            "seconds": F.least(F.lit(3600.0), power * 30)}[unit]
    return F.timestamp_micros(F.unix_micros(at) + (secs * 1_000_000).cast("long"))


def signed_token(lead_id: Column, secret: str, prefix: str = "") -> Column:
    """TXT-33: first 32 hex characters of HMAC-SHA256 over prefix + id; the key is the caller's."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(k ^ pad for k in key)) for pad in (0x36, 0x5C))
    message = F.concat(F.lit(prefix), lead_id).cast("binary")
    return F.left(F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256), F.lit(32))


def token_valid(lead_id: Column, token: Column, secret: str, prefix: str = "") -> Column:
    shaped = lead_id.rlike(LEAD_ID) & token.rlike("^[a-f0-9]{32}$")
    return F.coalesce(shaped & (signed_token(F.when(shaped, lead_id), secret, prefix) == token), F.lit(False))


def outdated(version: Column, current: str) -> Column:
    """TXT-35: produced by another version of the rules."""
    version = text_or_empty(version)
    return version.startswith("rules-") & (version != current)


def batch_key(ids: Column) -> Column:
    """TXT-36 over a bounded array: order-free key of a batch of ids."""
    return F.left(F.sha2(F.array_join(F.sort_array(ids), "\n"), 256), F.lit(32))


def delivered_keys(source: Column, source_url: Column, email: Column, validation_status: Column) -> Column:
    """TXT-30: permanent keys rebuilt from a delivered row; none for synthetic rows."""
    none = F.lit(None).cast("string")
    key = lambda namespace, *parts: F.concat(F.lit(namespace + ":"), digest(F.concat(*parts)))
    raw_host = F.lower(url_part(source_url, "HOST"))
    seg = F.split(F.regexp_replace(text_or_empty(url_part(source_url, "PATH")), "^/+|/+$", ""), "/")
    at = lambda i: F.coalesce(F.get(seg, i), F.lit(""))
    post = ((source == "bluesky") & (raw_host == "bsky.app") & (F.size(seg) == 4) & (at(0) == "profile")
            & (at(2) == "post") & at(1).startswith("did:"))
    page = (source == "commoncrawl") & raw_host.isNotNull()
    comment = url_part(source_url, "QUERY", "lc")
    thread = (source == "youtube") & raw_host.isin("www.youtube.com", "youtube.com") & (text_or_empty(comment) != "")
    keys = F.array(
        F.when(text_or_empty(email) != "", key("email", email)).otherwise(none),
        F.when(post, key("record", F.lit("bluesky:"), at(1), F.lit("/"), at(3)))
        .when(page, key("record", F.lit("commoncrawl:"), host_of(source_url)))
        .when(thread, key("record", F.lit("youtube:"), comment)).otherwise(none),
        F.when(post, key("lead", F.lit("bluesky:"), at(1)))
        .when(page, key("lead", F.lit("commoncrawl:"), host_of(source_url))).otherwise(none))
    keys = F.filter(keys, lambda k: k.isNotNull())
    return F.when(text_or_empty(validation_status) == "SYNTHETIC_TEST", F.array().cast("array<string>")).otherwise(keys)


def delivered_values(campaign_id: str, p: str = "profile.") -> Column:
    """TXT-37: the 17 text fields of a final row.  Empty, null and numeric zero all become ''."""
    name = greeting_name(F.col(p + "first_name"), F.col(p + "name_reliable"), F.col(p + "name_source"),
                         F.col(p + "business_name"))
    values = {
        "lead_id": F.concat(F.lit(campaign_id + ":"), F.col("id").cast("string")),
        "campaign_id": F.lit(campaign_id),
        "display_name": F.col(p + "display_name"),
        "first_name": name,
        "salutation": salutation(name),
        "username": F.col(p + "username"),
        "business_name": F.col(p + "business_name"),
        "email": F.col("email"),
        "source": F.col("source"),
        "source_evidence": source_evidence(F.col("excerpt"), F.col(p + "geography.excerpt"), F.col(p + "geography.source_url")),
        "source_url": F.col("source_url"),
        "email_source_url": F.col("email_source_url"),
        "product_type": F.col("product_type"),
        "rank_score": F.format_string("%.2f", F.col("rank_score").cast("double")),
        "score": F.when(F.col("score") != 0, F.col("score").cast("string")),
        "validation_status": F.col("validation_status"),
        "created_at": iso_time(F.col("created_at")),
    }
    return F.array(*[text_or_empty(values[f]) for f in FIELDS])


def iso_time(ts: Column) -> Column:
    """ISO time with offset, microseconds only when they are not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(micros != 0, F.format_string(".%06d", micros)).otherwise(F.lit("")), F.lit("+00:00"))


def bucket_for(layout: str, email: Column) -> Column:
    """Bucket that places a final: prospects apart, letters only in the alphabetical layout."""
    named = bucket(email)
    if layout == "alphabetical":
        return named
    return F.when(named == "PROSPECTS", named)
