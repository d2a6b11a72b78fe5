"""Web page projections: titles, excerpts and the thin-page test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.emails import PAGE_MAILBOX
from siftline.functions.text import (SPACE, clean_label, decode_entities, redact_excerpt, text_or_empty)

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
TAG = r"<[^>]+>"
HEADING = r"(?is)<h[12][^>]*>(.*?)</h[12]>"
META_FIRST = r"(?i)<meta[^>]+(?:name|property)=[\"'](?:og:)?description[\"'][^>]+content=[\"']([^\"']*)[\"']"
META_LAST = r"(?i)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]+(?:name|property)=[\"'](?:og:)?description[\"']"
CHROME = r"(?is)<(script|style|noscript|svg|nav|footer|header).*?</\1>"
# Lengths of the excerpt parts, the excerpt, and the word floor of a page that says enough.
TITLE_LIMIT, BODY_LIMIT, EXCERPT_LIMIT, HEADINGS, WORD_FLOOR = 120, 900, 1100, 6, 20


def page_title(html: Column) -> Column:
    """TXT-16: first title without tags and without anything that looks like an address."""
    inner = F.regexp_replace(F.regexp_extract(text_or_empty(html), TITLE, 1), TAG, " ")
    strict = clean_label(F.regexp_replace(inner, PAGE_MAILBOX, " "), TITLE_LIMIT)
    return clean_label(F.regexp_replace(strict, r"\S*@\S*", " "), TITLE_LIMIT)


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def with_excerpt(pages: DataFrame, html: str = "html") -> DataFrame:
    """TXT-18 and TXT-19: adds ``excerpt`` and ``thin`` to a table of pages.

    Entities are decoded once per part.  Numeric references are the only piece that may leave generated
    code, so the headings are decoded as one delimited text and split afterwards.
    """
    page = text_or_empty(F.col(html))
    mark = "\u0001"
    heads = F.regexp_extract_all(page, F.lit(HEADING), F.lit(1))
    staged = pages.withColumns({
        "_title": F.regexp_replace(decode_entities(F.regexp_extract(page, TITLE, 1)), TAG, " "),
        "_meta1": F.regexp_replace(decode_entities(F.regexp_extract(page, META_FIRST, 1)), TAG, " "),
        "_meta2": F.regexp_replace(decode_entities(F.regexp_extract(page, META_LAST, 1)), TAG, " "),
        "_heads": decode_entities(F.array_join(F.transform(heads, lambda h: F.regexp_replace(h, TAG, " ")), mark)),
        "_body": decode_entities(F.regexp_replace(F.regexp_replace(page, CHROME, " "), TAG, " ")),
    })
    cleaned = F.filter(F.transform(F.split("_heads", mark), _spaced), lambda h: h != "")
    staged = staged.withColumns({
        "_meta": F.when(F.col("_meta1") != "", F.col("_meta1")).otherwise(F.col("_meta2")),
        "_heads": F.array_join(F.slice(F.array_distinct(cleaned), 1, HEADINGS), " | "),
        "_heads_plain": F.array_join(F.slice(F.array_distinct(cleaned), 1, HEADINGS), " "),
        "_body": F.left(_spaced(F.col("_body")), F.lit(BODY_LIMIT)),
    })
    part = lambda label, name: F.when(F.col(name) != "", F.concat(F.lit(label), F.col(name)))
    joined = F.concat_ws(". ", part("Title: ", "_title"), part("Description: ", "_meta"),
                         part("Headings: ", "_heads"), part("Text: ", "_body"))
    said = redact_excerpt(F.concat_ws(" ", "_meta", "_heads_plain", "_body"))
    words = F.size(F.filter(F.split(said, " "), lambda w: F.length(w) > 2))
    staged = staged.withColumns({"excerpt": F.left(redact_excerpt(joined), F.lit(EXCERPT_LIMIT)),
                                 "thin": words < WORD_FLOOR})
    return staged.drop("_title", "_meta1", "_meta2", "_meta", "_heads", "_heads_plain", "_body")
