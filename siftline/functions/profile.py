"""Profile projections: the only personal fields that travel with a record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftline.functions.text import clean_label, text_or_empty
from siftline.functions.urls import public_url, public_urls

# Provenance marks that make a given name reliable, and the metadata keys that are kept.
NAME_SOURCES = ("explicit_given_name", "operator_verified")
METADATA_KEYS = ("video_id", "comment_id", "channel_id", "did", "rkey", "collection")


def reliable_name(first_name: Column, name_reliable: Column, name_source: Column) -> Column:
    """TXT-8: the given name when its flag, provenance and letters all allow it, else ''."""
    name = clean_label(first_name, 80)
    fine = (F.coalesce(name_reliable, F.lit(False)) & F.coalesce(name_source.isin(*NAME_SOURCES), F.lit(False))
            & name.rlike(r"^[\p{L} \-'’]+$") & name.rlike(r"\p{L}"))
    return F.when(fine, name).otherwise(F.lit(""))


def kept_metadata(metadata: Column) -> Column:
    """TXT-9: allow-listed keys, values cleaned to 200 characters.

    The keys are known, so each value is looked up by name: the label batch cannot run inside a
    higher-order function.
    """
    given = F.coalesce(metadata, F.create_map().cast("map<string,string>"))
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), clean_label(F.try_element_at(given, F.lit(k)), 200).alias("value"))
                      for k in METADATA_KEYS])
    return F.map_from_entries(F.filter(pairs, lambda p: F.map_contains_key(given, p["key"])))


def profile(record_prefix: str = "") -> Column:
    """Profile struct of a record row."""
    col = lambda name: F.col(record_prefix + name)
    name = reliable_name(col("first_name"), col("name_reliable"), col("name_source"))
    return F.struct(
        clean_label(col("display_name")).alias("display_name"),
        name.alias("first_name"),
        (name != "").alias("name_reliable"),
        F.when(name != "", col("name_source")).otherwise(F.lit("")).alias("name_source"),
        clean_label(col("username")).alias("username"),
        clean_label(col("business_name")).alias("business_name"),
        public_urls(col("urls")).alias("urls"),
        clean_label(col("bio"), 1000).alias("bio"),
        public_url(col("profile_url")).alias("profile_url"),
        kept_metadata(col("metadata")).alias("metadata"),
    )


def greeting_name(first_name: Column, name_reliable: Column, name_source: Column, business_name: Column) -> Column:
    """TXT-27: the name a delivered row may use, '' without reliable provenance or with a business name."""
    name = text_or_empty(first_name)
    fine = (F.coalesce(name_reliable, F.lit(False)) & F.coalesce(name_source.isin(*NAME_SOURCES), F.lit(False))
            & F.length(name).between(2, 60) & name.rlike(r"^[\p{L}\p{M}\-'’]+$") & name.rlike(r"\p{L}")
            & (text_or_empty(business_name) == ""))
    return F.when(fine, name).otherwise(F.lit(""))


def salutation(name: Column) -> Column:
    return F.when(name != "", F.concat(F.lit("Good day "), name, F.lit(","))).otherwise(F.lit("Good day,"))
