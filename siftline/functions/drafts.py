"""Projections over supplied (generated) lines: short names and the line validator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftline.functions.text import ascii_punctuation, text_or_empty

# Limits, words and patterns a supplied line is checked against.
LINE_LIMIT, NAME_LIMIT = 320, 60
CONTACT_DATA = r"(?i)@|https?:|www\.|\d{3}[\s-]?\d{3,}"
BANNED = r"(?i)insur|cover|premium|polic(?:y|ies)|risk"
OPENING = r"(?i)^(?:we noticed|we see)"
COMMON_NAME_WORDS = ["the", "and", "for", "pty", "ltd", "inc", "home", "welcome"]
SPAM_PAGE = (r"(?i)\b(?:slot|slots|casino|gacor|togel|betting|bet365|poker|jackpot|porn|xxx|viagra|cialis|escort|"
             r"crypto ?casino)\b")
TRADE_PAGE = (r"(?i)(?:authori[sz]ed financial services provider|FSP\s*(?:no|number)?\.?\s*\d|insurance broker|"
              r"insurance brokers|brokers?[^.]{0,40}insur|insur[a-z]*[^.]{0,40}broker|"
              r"funeral (?:cover|plan|policy|scheme)|short[- ]term insurance|long[- ]term insurance|life insurance|"
              r"underwrit|insurer)")


def short_name(proposed: Column, business: Column, excerpt: Column) -> Column:
    """TXT-22: the proposed name when the excerpt holds it, else the shortest title segment."""
    name = F.regexp_replace(ascii_punctuation(proposed), r"^[\s\"'.,-]+|[\s\"'.,-]+$", "")
    usable = (name != "") & (F.length(name) <= NAME_LIMIT) & F.contains(F.lower(ascii_punctuation(excerpt)), F.lower(name))
    title = ascii_punctuation(business)
    parts = F.filter(F.transform(F.split(title, r"\s+[|:-]\s+"), lambda p: F.trim(p)), lambda p: p != "")
    by_length = F.transform(parts, lambda p, i: F.struct(F.length(p).alias("n"), i.alias("i"), p.alias("p")))
    shortest = F.try_element_at(F.array_sort(by_length), F.lit(1))["p"]
    return F.when(usable, name).otherwise(F.left(F.coalesce(shortest, title), F.lit(NAME_LIMIT)))


def clean_line(line: Column, name: Column, banned: str = BANNED, opening: str = OPENING) -> Column:
    """TXT-23: the line in plain punctuation with a full stop, '' when it breaks a rule."""
    text = ascii_punctuation(line)
    words = F.filter(F.split(F.lower(ascii_punctuation(name)), r"[^a-z0-9&]+"),
                     lambda w: (F.length(w) >= 3) & ~w.isin(COMMON_NAME_WORDS))
    named = (F.size(words) == 0) | F.exists(words, lambda w: F.contains(F.lower(text), w))
    fine = ((text != "") & (F.length(text) <= LINE_LIMIT) & ~text.rlike(CONTACT_DATA) & ~text.rlike(banned)
            & ~text.rlike(SPAM_PAGE) & text.rlike(opening) & named)
    ended = F.when(text.rlike(r"[.!]$"), text).otherwise(F.concat(text, F.lit(".")))
    return F.when(fine, ended).otherwise(F.lit(""))


def subject(name: Column) -> Column:
    shown = F.when(text_or_empty(name) == "", F.lit("your business")).otherwise(name)
    return F.concat(F.lit("A quick one for "), F.left(shown, F.lit(80)))
