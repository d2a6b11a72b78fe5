"""RUL-1 and FLT-1: which term groups a text hits.

Two physical forms with equal results: one pass of a compiled prefix-tree expression inside generated
code (the default), or words joined with a terms table, each term under its rarest word, when the dictionary is too large
to be compiled into an expression.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.phrases import implied, longest_phrase_pattern, phrase_pattern
from siftline.functions.text import WORD
from siftline.operators.pin import pinned
from siftline.rules import RuleBook
from siftline.session import durable

_APOSTROPHES = str.maketrans("‘’‛ʼ", "''''")
BROADCAST_TERMS = 200_000
_WORD_SIGNS = r"\p{L}\p{N}_"


def fold_term(term: str) -> str:
    """Driver-side twin of the matching text, for dictionary terms."""
    return " ".join(unicodedata.normalize("NFKC", term).split()).casefold().translate(_APOSTROPHES)


def folded(terms: list[str]) -> list[str]:
    return list(dict.fromkeys(fold_term(t) for t in terms))


def found_terms(text: Column, terms: list[str]) -> Column:
    """Distinct longest dictionary terms that start at some word of ``text``."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(longest_phrase_pattern(folded(terms))), F.lit(1)))


def matched_groups(found: Column, groups: dict[str, list[str]]) -> Column:
    """Names of the hit groups in bundle order, from the longest terms found.

    A term found at a place implies its own prefixes there, so a group is hit when one of its terms is
    implied by a found one.
    """
    groups = {name: folded(terms) for name, terms in groups.items()}
    everything = list(dict.fromkeys(t for terms in groups.values() for t in terms))
    means = implied(everything)
    hits = []
    for name, terms in groups.items():
        own = set(terms)
        witnesses = sorted(t for t in everything if own & set(means[t]))
        if witnesses:
            test = F.arrays_overlap(found, F.array(*[F.lit(w) for w in witnesses]))
            hits.append(F.when(test, F.lit(name)))
    listed = F.filter(F.array(*hits), lambda g: g.isNotNull()) if hits else F.array().cast("array<string>")
    return F.when(F.size(found) == 0, F.array().cast("array<string>")).otherwise(listed)


def with_matches(df: DataFrame, book: RuleBook, text: str = "match_text", out: str = "matched") -> DataFrame:
    """Adds the hit groups of every row.  The text is scanned once, whatever the number of groups."""
    groups = book.groups()
    terms = [t for members in groups.values() for t in members]
    staged = pinned(df, _found=found_terms(F.col(text), terms))
    return staged.withColumn(out, matched_groups(F.col("_found"), groups)).drop("_found")


def hits_any(text: Column, terms: list[str]) -> Column:
    """Whole-phrase hit of any term in a matching text."""
    return text.rlike(phrase_pattern(folded(terms)))


def discovery_match(text: Column, book: RuleBook) -> Column:
    """FLT-1: a product term or a term of a signal that is not negative occurs."""
    return hits_any(text, book.discovery_terms())


def _words(text: Column) -> Column:
    """The distinct words of a text, whatever stands between them."""
    return F.array_distinct(F.filter(F.split(text, rf"[^{_WORD_SIGNS}]+"), lambda w: w != ""))


def anchors(df: DataFrame, lookup: DataFrame, text: str, small: bool) -> DataFrame:
    """``(grp, ord, term, _word)``: every term under its word that the fewest texts hold, ``""`` for terms without a word.

    Terms with a word that no text holds are left out, as they cannot occur.
    """
    listed = lookup.withColumn("_word", F.explode_outer(_words(F.col("term"))))
    own = listed.select("_word").filter("_word IS NOT NULL").distinct()
    held = (df.select(F.explode(_words(F.col(text))).alias("_word")).join(F.broadcast(own) if small else own, "_word", "left_semi")
            .groupBy("_word").agg(F.count(F.lit(1)).alias("_n")))
    counted = listed.join(held, "_word", "left").withColumn("_n", F.when(F.col("_word").isNull(), 0).otherwise(F.coalesce("_n", F.lit(-1))))
    per = counted.groupBy("grp", "ord", "term").agg(F.min("_n").alias("_least"), F.min_by(F.coalesce("_word", F.lit("")), F.struct("_n", "_word")).alias("_word"))
    return per.filter("_least >= 0").drop("_least")


def match_by_join(df: DataFrame, terms: DataFrame, key: str, text: str = "match_text") -> DataFrame:
    """RUL-1 for dictionaries kept as a table ``(grp, ord, term)``: ``(key, matched)`` for rows with a hit.

    Every term is listed under its rarest word.  The distinct words of a text are joined with that list, and what they
    name is confirmed in the text itself, punctuation, spacing and word boundaries included.  So the rows of a text are its
    distinct words, however long the terms are, and a word in a third of all texts is the key of a term only if all
    words of the term are that frequent.  ``df`` is read for the counts, the words and the confirmation.
    """
    lookup = terms.select("grp", "ord", "term").filter(F.col("term") != "").distinct()
    small = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    listed = durable(anchors(df, lookup, text, small), "anchors")
    # a term without any word is tried on every text
    words = F.concat(_words(F.col(text)), F.array(F.lit("")))
    tried = (df.select(key, F.explode(words).alias("_word")).join(F.broadcast(listed) if small else listed, "_word")
             .groupBy(F.col(key).alias("_key")).agg(F.collect_set(F.struct("ord", "grp", "term")).alias("_t")))
    tried = df.select(key, text).join(tried, F.col(key).eqNullSafe(F.col("_key")))
    exact = lambda t: F.contains(F.col(text), t["term"]) & F.regexp_like(F.col(text), F.concat(F.lit(f"(?<!{WORD})\\Q"), F.replace(t["term"], F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(f"\\E(?!{WORD})")))
    hit = tried.select(key, F.explode(F.filter("_t", exact)).alias("_t")).select(key, "_t.ord", "_t.grp")
    grouped = hit.groupBy(key).agg(F.collect_set(F.struct("ord", "grp")).alias("_g"))
    return grouped.select(key, F.transform(F.array_sort("_g"), lambda g: g["grp"]).alias("matched"))
