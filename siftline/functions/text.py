"""Text projections.  Built-in expressions carry plain ASCII rows; Arrow batches take the rest.

Unicode compatibility folding and HTML entities have no built-in in Spark.  For ASCII rows without an
ampersand both are the identity, so these rows stay in generated code and pass a null into the Arrow batch.
The test compares two lengths: a character class that lists the harmless letters costs several times
more than the batch it would save.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F, types as T

from siftline.session import text_batches

# Python's \w, \s and \d on text, spelled for Java's regular expressions.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\p{Z}\x85\x1c-\x1f]"
SOLID = r"[^\s\p{Z}\x85\x1c-\x1f]"

# ASCII characters that Python's str.split() takes for white space.
_BLANKS = r"[ \t-\r\x1c-\x1f]+"

# Patterns and marks of the redaction step, applied in this order.
EMAIL = r"[a-zA-Z0-9.!#$%&'*+/=?^_`{|}~-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,63}"
LINK = r"https?://" + SOLID + "+"
HANDLE = f"(?<!{WORD})@{WORD}+"
PHONE = rf"(?<!{WORD})\+?\p{{Nd}}(?:[\p{{Nd}}().-]|{SPACE}){{7,}}\p{{Nd}}"
REDACTIONS = ((EMAIL, "[EMAIL]"), (LINK, "[URL]"), (HANDLE, "[HANDLE]"), (PHONE, "[PHONE]"))
EXCERPT_LIMIT = 2000
PLACE_REACH, PLACE_LIMIT = 60, 200


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _needs_folding(c: Column) -> Column:
    return ~_ascii(c) | F.contains(c, F.lit("&"))


def _unentity(value: str) -> str:
    return unicodedata.normalize("NFKC", html.unescape(value))


@F.pandas_udf(T.StringType())
def _fold_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda v: " ".join(_unentity(v).split()).casefold(), na_action="ignore")


@F.pandas_udf(T.StringType())
def _label_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda v: " ".join(_unentity(v).split()), na_action="ignore")


@F.pandas_udf(T.StringType())
def _case_batch(values: pd.Series) -> pd.Series:
    return values.map(str.casefold, na_action="ignore")


def _batched(batch, c: Column) -> Column:
    """``batch`` over ``c`` in small batches: by default ten thousand whole texts meet in each worker."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        text_batches(spark)
    return batch(c)


def fold_case(c: Column) -> Column:
    """Unicode case folding alone."""
    rare = ~_ascii(c)
    return F.when(rare, _batched(_case_batch, F.when(rare, c))).otherwise(F.lower(c))


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def canonical_text(c: Column) -> Column:
    """TXT-1: entities, compatibility form, single spaces, case folded; null becomes ''."""
    c = text_or_empty(c)
    folding = _needs_folding(c)
    return F.when(folding, _batched(_fold_batch, F.when(folding, c))).otherwise(F.lower(_squeeze(c)))


def matching_text(c: Column) -> Column:
    """TXT-2: canonical text with typographic apostrophes as ``'`` (never hashed)."""
    return F.translate(canonical_text(c), "‘’‛ʼ", "''''")


def straight_apostrophes(canonical: Column) -> Column:
    """TXT-2 for text that is canonical already."""
    return F.translate(canonical, "‘’‛ʼ", "''''")


def digest(c: Column) -> Column:
    """TXT-3: SHA-256 of the canonical text."""
    return F.sha2(canonical_text(c), 256)


def keyed(namespace: str, *parts: Column) -> Column:
    """TXT-4: ``namespace:`` + digest of the parts joined by ':'."""
    return F.concat(F.lit(namespace + ":"), digest(F.concat_ws(":", *parts)))


def clean_label(c: Column, limit: int = 160) -> Column:
    """TXT-5: like the canonical text but with its case kept, cut to ``limit``."""
    c = text_or_empty(c)
    folding = _needs_folding(c)
    whole = F.when(folding, _batched(_label_batch, F.when(folding, c))).otherwise(_squeeze(c))
    return F.left(whole, F.lit(limit))


def redact(c: Column, limit: int | None = EXCERPT_LIMIT) -> Column:
    """TXT-10: contact details replaced by marks over the whole text, then cut; without a limit nothing is cut."""
    for pattern, mark in REDACTIONS:
        c = F.regexp_replace(c, pattern, mark)
    return c if limit is None else F.left(c, F.lit(limit))


def formula_safe(c: Column) -> Column:
    """TXT-26: a quote before text that a spreadsheet would run as a formula; null becomes ''."""
    c = text_or_empty(c.cast("string"))
    risky = c.rlike(rf"^{SPACE}*[=+\-@]|^[\t\r\n]")
    return F.when(risky, F.concat(F.lit("'"), c)).otherwise(c)


def quoted_cell(c: Column) -> Column:
    """One cell of the all-quoted CSV dialect."""
    return F.concat(F.lit('"'), F.replace(formula_safe(c), F.lit('"'), F.lit('""')), F.lit('"'))


def ascii_punctuation(c: Column) -> Column:
    """TXT-21: dashes, quotes and the ellipsis to ASCII, spaces collapsed."""
    c = F.translate(text_or_empty(c), "‐‑‒–—―−�‘’‛“”", "--------'''\"\"")
    c = F.replace(c, F.lit("…"), F.lit("..."))
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def source_evidence(excerpt: Column, place_excerpt: Column, place_url: Column) -> Column:
    """TXT-25: excerpt plus the labelled place; the label always survives the 2000 characters."""
    # Fixed value: wording of the evidence label.
    suffix = F.concat(
        F.lit(" || SA location evidence (same author's public profile bio, "),
        F.left(text_or_empty(place_url), F.lit(300)), F.lit('): "'),
        F.left(text_or_empty(place_excerpt), F.lit(200)), F.lit('"'))
    room = F.greatest(F.lit(0), F.lit(EXCERPT_LIMIT) - F.length(suffix))
    with_place = F.concat(F.left(text_or_empty(excerpt), room), suffix)
    return F.when(place_excerpt.isNull(), F.left(text_or_empty(excerpt), F.lit(EXCERPT_LIMIT))).otherwise(with_place)


def _once(value: Column, make) -> Column:
    """``make(value)`` with the value computed once, however often ``make`` uses it."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def place_window(bio: Column, terms: list[str]) -> Column:
    """TXT-24: whole words around the first place term (in term order) of the whole redacted bio, else null."""
    from siftline.functions.phrases import WORD, phrase_pattern

    ordered = [unicodedata.normalize("NFKC", t).casefold() for t in terms]
    if not ordered:
        return F.lit(None).cast("string")

    def around(text: Column, term: str) -> Column:
        # what stands before the first hit; its length is the place of the term
        head = F.regexp_extract(text, f"(?s)^(.*?)(?<!{WORD}){re.escape(term)}(?!{WORD})", 1)

        def cut(before: Column) -> Column:
            after = F.substring(text, F.length(before) + F.lit(len(term) + 1), F.length(text))
            near = F.right(before, F.lit(PLACE_REACH))
            left = F.when(F.length(before) > PLACE_REACH, F.regexp_replace(near, "^[^ ]* ", "")).otherwise(near)
            far = F.left(after, F.lit(PLACE_REACH))
            right = F.when(F.length(after) > PLACE_REACH, F.regexp_replace(far, " [^ ]*$", "")).otherwise(far)
            return F.left(F.trim(F.concat(left, F.lit(term), right)), F.lit(PLACE_LIMIT))

        return F.when(text.rlike(phrase_pattern([term])), _once(head, cut))

    return _once(redact(matching_text(bio), None), lambda text: F.coalesce(*[around(text, t) for t in ordered]))


def decode_entities(c: Column) -> Column:
    """TXT-17: the small named set and decimal references."""
    c = text_or_empty(c)
    # The named entities, in replacement order.
    for pattern, out in ((r"(?i)&nbsp;", " "), (r"(?i)&amp;", "&"), (r"(?i)&quot;", '"'), (r"(?i)&#0?39;|&apos;", "'"),
                         (r"(?i)&lt;", "<"), (r"(?i)&gt;", ">")):
        c = F.regexp_replace(c, pattern, out)
    numeric = c.rlike(r"&#\d{2,5};")
    return F.when(numeric, _batched(_numeric_batch, F.when(numeric, c))).otherwise(c)


_NUMERIC = re.compile(r"&#([0-9]{2,5});")


def _character(found: re.Match) -> str:
    code = int(found.group(1))
    return chr(code) if 32 <= code < 65536 and not 0xD800 <= code < 0xE000 else " "


@F.pandas_udf(T.StringType())
def _numeric_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda v: _NUMERIC.sub(_character, v), na_action="ignore")


def redact_excerpt(c: Column, country_code: str = "27") -> Column:
    """TXT-20: addresses, links and national phone numbers to a space, spaces collapsed."""
    c = text_or_empty(c)
    c = F.regexp_replace(c, f"{SOLID}+@{SOLID}+", " ")
    c = F.regexp_replace(c, rf"(?i)https?://{SOLID}+|www\.{SOLID}+", " ")
    c = F.regexp_replace(c, rf"(?:\+?{country_code}|0)(?:{SPACE}|[\-().])*\d(?:(?:{SPACE}|[\-().])*\d){{7,10}}", " ")
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))
