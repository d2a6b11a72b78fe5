"""Quality rules: counts of words, symbols and repeats per text, and lines that too many documents of a host share.

Main path in DataFrame functions only.  The text is read once; what the later steps need (a hash and a word count per
line) is written as a narrow table.  A normalised line is lower-cased, its digits become ``0`` and its white space one
space.  Per host (``source``) the distinct documents of every line are counted, copies of a text each by their own id;
rows without an id count once per text.  Above ``max_documents`` the line is removed from every document but the one with
the smallest id, so that each line stays somewhere.  A document that loses more than ``max_lost`` per cent of its words this way is rejected.

Defined cases: a null text has no words and no lines; null hosts form one host; a null id never is the smallest one unless
all ids of the line are null, and then every holder keeps the line; repeated rows get equal results; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.llm.common import WORD, Scratch, whole
from siftline.operators.pin import pinned

MAX_DOCUMENTS = 20
MAX_LOST = 50
MIN_WORDS = 50
MAX_REPEATED = 50
SYMBOLS = "#*$%&|<>"
_SPACES = r"[\x20\x09-\x0D]+"


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), _SPACES, " "))


def repeat_words(hashes: Column) -> Column:
    """Number of words inside a three-word window that occurs at least twice; ``hashes`` has a hash per word."""
    n = F.size(hashes)
    zipped = F.arrays_zip(hashes.alias("a"), F.slice(hashes, F.lit(2), F.greatest(n, F.lit(1))).alias("b"),
                          F.slice(hashes, F.lit(3), F.greatest(n, F.lit(1))).alias("c"))
    return F.transform(F.slice(zipped, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda z: F.xxhash64(z["a"], z["b"], z["c"]))


def covered(windows: Column) -> Column:
    """Words covered by windows that occur twice; sorted copies meet as neighbours, so the work is that of a sort."""
    n = F.size(windows)
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    shifted = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(placed, F.lit(1), n - 1))
    following = F.slice(placed, F.lit(2), n)
    beside = F.arrays_zip(placed.alias("x"), shifted.alias("y"), following.alias("z"))
    twice = F.filter(beside, lambda r: r["x"]["h"].eqNullSafe(r["y"]["h"]) | r["x"]["h"].eqNullSafe(r["z"]["h"]))
    places = F.flatten(F.transform(twice, lambda r: F.array(r["x"]["i"], r["x"]["i"] + 1, r["x"]["i"] + 2)))
    return F.when(F.size(F.array_distinct(windows)) < n, F.size(F.array_distinct(places))).otherwise(0)


def measures(docs: DataFrame) -> DataFrame:
    """Per row the counts of the text and its lines as ``h`` (hash) and ``w`` (words)."""
    rows = docs.select("doc_id", "source", whole().alias("_t"))
    rows = pinned(rows, _words=F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)),
                  _lines=F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = pinned(rows, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))
    rows = pinned(rows, _windows=repeat_words(F.col("_hashes")))
    return rows.select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", "source", F.xxhash64("_t").alias("_content"),
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", _SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered(F.col("_windows")).cast("long").alias("n_repeat_words"),
        F.transform("_lines", lambda x: F.struct(F.xxhash64(normalised(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w"))).alias("_lines"))


def judged(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_lost: int = MAX_LOST) -> DataFrame:
    """Counts, base rules and verdict per row of ``docs``; ``n_removed`` has the words in removed lines."""
    rows = Scratch(docs.sparkSession).keep(measures(docs), "measures")
    lines = rows.select("_row", "doc_id", "source", "_content", F.explode("_lines").alias("_l")).select("*", "_l.h", "_l.w").drop("_l")
    holders = lines.select("source", "h", "doc_id", F.when(F.col("doc_id").isNull(), F.col("_content")).alias("_content")).distinct()
    common = (holders.groupBy("source", "h").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_first"))
              .filter(F.col("_n") > max_documents).select(F.col("source").alias("_s"), F.col("h").alias("_h"), "_first"))
    # all lines of a row are summed before the join, so that a row meets a common line once
    held = lines.groupBy("_row", "doc_id", "source", "h").agg(F.sum("w").alias("w"))
    lost = (held.join(common, F.col("source").eqNullSafe(F.col("_s")) & (F.col("h") == F.col("_h")))
            .filter(F.col("_first").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("_first")))
            .groupBy("_row").agg(F.sum("w").cast("long").alias("n_removed")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    full = rows.drop("_lines").join(lost, "_row", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0)).cast("long"))
    return (full.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & (100 * F.col("n_removed") <= max_lost * F.col("n_words")))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed"))


SQL = r"""WITH t AS (SELECT doc_id, source, coalesce(text,'') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text,'[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x,'[^\x20\x09-\x0D]')) AS l FROM t),
grams AS (SELECT doc_id, i, w[i:i+2] AS g FROM words, unnest(range(1, len(w)-1)) AS u(i)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
reps AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i,i+1,i+2]) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, source, coalesce('i'||doc_id, 't'||sha256(text)) AS who, unnest(l) AS x FROM words),
normal AS (SELECT doc_id, source, who, trim(regexp_replace(regexp_replace(lower(x),'[0-9]+','0','g'),'[\x20\x09-\x0D]+',' ','g'),' ') AS h,
  len(regexp_extract_all(x,'[^\x20\x09-\x0D]+')) AS n FROM lines),
common AS (SELECT source, h, min(doc_id) AS first FROM normal GROUP BY source, h HAVING count(DISTINCT who) > 20),
lost AS (SELECT n.doc_id, sum(n.n)::BIGINT AS n FROM normal n JOIN common c ON n.source IS NOT DISTINCT FROM c.source AND n.h = c.h
  WHERE n.doc_id <> c.first GROUP BY n.doc_id),
counted AS (SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(w.text,'[\x20\x09-\x0D]+','','g'))::BIGINT AS word_chars,
  (length(w.text) - length(regexp_replace(w.text,'[#*$%&|<>]','','g')))::BIGINT AS n_symbols,
  (len(w.l) - len(list_distinct(w.l)))::BIGINT AS n_dup_lines, coalesce(r.n,0)::BIGINT AS n_repeat_words, coalesce(x.n,0)::BIGINT AS n_removed
  FROM words w LEFT JOIN reps r USING (doc_id) LEFT JOIN lost x USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100*n_removed <= 50*n_words AS kept, n_removed
FROM (SELECT *, n_words < 50 OR 100*n_repeat_words > 50*n_words AS base_failed FROM counted)"""
