"""Line dedup by log templates: a tree of fixed depth, variable fields, recurring templates.

A line is its words.  A word with a digit, an ``@`` or ``://`` is a variable field, written ``<*>``.  The tree has two
levels: number of words, then the first ``DEPTH`` words; a leaf with fewer than ``MIN_DOCUMENTS`` distinct documents holds
nothing that recurs and is left at once.  Within a leaf a word is constant at its place if lines of ``MIN_DOCUMENTS``
documents have it there; other places are generalised to ``<*>``, provided that at least ``SIMILAR`` per cent of the words,
and two more than the leading ones, stay constant, else the line is its own template.  A template in ``MIN_DOCUMENTS``
distinct documents or more recurs: all its lines go, except those of the document with the smallest id.

A line that is equal word for word, as written, recurs without a template: from ``EXACT_DOCUMENTS`` distinct documents on
if it has ``MIN_WORDS`` words, else from ``MIN_DOCUMENTS`` on.  It stays in the document with the smallest id likewise.

A near copy would lose every line but the changed ones, and what is left of it would look like a document of its own.
``deduplicated`` therefore keeps such copies together for the near-duplicate stage: of every document that loses ``CANDIDATE``
per cent of its words or more to lines that stay in one and the same document, its partner, the texts of both without all other
dropped lines are compared by their five-word shingles.  At a similarity of ``COPY`` per cent or more the lines that stay in the
partner stay here too.  ``report`` and its counts are those of the rule above.

The tree is not grown line by line: counts decide, so the order of the rows does not matter and no task needs a whole
leaf.  Documents are counted by id, copies of a text included; rows without an id count once per text.

Defined cases: a null text has no lines and stays null; lines with fewer than ``MIN_WORDS`` words are no templates; if every id
that holds a template or line is null, all its lines stay; repeated rows get equal results; an empty table gives an empty result;
other columns are kept by ``deduplicated`` and ignored by ``report``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from siftline.llm.common import WORD, Scratch, text_batches, whole, word_hashes
from siftline.llm.near_dupes import SHARE, shingles
from siftline.operators.pin import pinned

DEPTH = 3
MIN_WORDS = 3
MIN_DOCUMENTS = 5
EXACT_DOCUMENTS = 2
SIMILAR = 70
CANDIDATE, COPY = 5, SHARE  # per cent
PARTNERS = 256  # documents with one partner that are compared in one task
FIELD = "<*>"
_VARIABLE = r"[0-9@]|://"


def _masked(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(w.rlike(_VARIABLE), F.lit(FIELD)).otherwise(w))


def parsed_lines(docs: DataFrame) -> DataFrame:
    """A row per line with words: doc_id, _content (hash of the text), place, exact (hashes of the words as written), words
    and leaf; the leaf is null for lines with too few words."""
    rows = docs.select(F.col("doc_id"), whole().alias("_t")).withColumn("_content", F.xxhash64("_t"))
    lines = rows.select("doc_id", "_content", F.posexplode(F.split("_t", "\n")).alias("place", "_line"))
    lines = pinned(lines.filter(F.col("_line").rlike(r"[^\x20\x09-\x0D]")), _raw=F.regexp_extract_all("_line", F.lit(WORD), F.lit(0)))
    lines = pinned(lines, words=F.when(F.col("_line").rlike(_VARIABLE), _masked(F.col("_raw"))).otherwise(F.col("_raw")))
    lines = lines.withColumn("exact", F.struct(F.xxhash64("_raw").alias("a"), F.xxhash64(F.lit(1), "_raw").alias("b"))).drop("_line", "_raw")
    leaf = F.xxhash64(F.size("words"), *[F.get("words", F.lit(i)) for i in range(DEPTH)])
    return lines.withColumn("leaf", F.when(F.size("words") >= MIN_WORDS, leaf))


def _documents(lines: DataFrame, *keys: str) -> DataFrame:
    """The distinct documents of every key: by id, and by text where the id is null."""
    return lines.select(*keys, "doc_id", F.when(F.col("doc_id").isNull(), F.col("_content")).alias("_content")).distinct()


def _equal_lines(lines: DataFrame, min_documents: int, exact_documents: int) -> DataFrame:
    """The lines that stand word for word in a document with a smaller id, where they recur, with that document as ``first``."""
    least = F.when(F.col("long"), exact_documents).otherwise(min_documents)
    lines = lines.withColumn("long", F.col("leaf").isNotNull())
    recurring = (_documents(lines, "exact", "long").groupBy("exact", "long").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("first"))
                 .filter((F.col("_n") >= least) & F.col("first").isNotNull()).select("exact", "first"))
    found = lines.select("doc_id", "_content", "place", "words", "exact").join(recurring, "exact")
    return found.filter(~F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "_content", "first", "place", "words")


def dropped_lines(docs: DataFrame, scratch: Scratch, min_documents: int = MIN_DOCUMENTS, similar: int = SIMILAR, exact_documents: int = EXACT_DOCUMENTS) -> DataFrame:
    """doc_id, _content and the lines to drop, a row per document that loses any: ``_drops`` has, by the document where they stay
    (``first``), the places of the lines and their number of words."""
    lines = parsed_lines(docs)
    # every text is parsed once; later steps read the columns they need
    shape = F.when(F.col("leaf").isNotNull(), F.array_join("words", " "))
    lines = scratch.keep(lines.select("doc_id", "_content", "place", "exact", "leaf", F.size("words").alias("words"), shape.alias("_shape")), "lines")
    narrow = lines.drop("_shape")
    leaves = (_documents(narrow.filter(F.col("leaf").isNotNull()), "leaf").groupBy("leaf").agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") >= min_documents).select("leaf"))
    leaves = scratch.keep(leaves, "leaves")  # a table of its own, so that the join can split a hot leaf
    # from here on shapes are known by two hashes
    texts = lines.filter(F.col("leaf").isNotNull()).select("doc_id", "_content", "place", "leaf", "_shape")
    held = texts.join(leaves, "leaf").withColumn("words", F.split("_shape", " ")).drop("_shape").withColumn("shape", F.struct(F.xxhash64("leaf", "words").alias("a"), F.xxhash64(F.lit(1), "words").alias("b")))
    held = scratch.keep(held, "held")
    holders = _documents(held, "leaf", "shape")
    shapes = holders.groupBy("leaf", "shape").agg(F.count(F.lit(1)).alias("n"))
    texts = held.groupBy("shape").agg(F.first("words").alias("words"))
    shapes = scratch.keep(shapes.join(texts, "shape"), "shapes")

    cells = shapes.select("leaf", "shape", "n", F.posexplode("words").alias("at", "word"))
    constant = cells.filter(F.col("word") != FIELD).groupBy("leaf", "at", "word").agg(F.sum("n").alias("_s")).filter(F.col("_s") >= min_documents).drop("_s")
    fixed = (cells.join(constant, ["leaf", "at", "word"]).groupBy("shape")
             .agg(F.count(F.lit(1)).alias("_c"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("_fixed")))
    named = shapes.select("leaf", "shape", F.size("words").alias("_size")).join(fixed, "shape", "left")
    general = (F.col("_c") * 100 >= similar * F.col("_size")) & (F.col("_c") >= DEPTH + 2)
    own = F.struct(F.col("shape.a").alias("x"), F.col("shape.b").alias("y"))
    template = F.when(general, F.struct(F.xxhash64("leaf", "_fixed").alias("x"), F.xxhash64(F.lit(2), "leaf", "_fixed").alias("y"))).otherwise(own)
    named = scratch.keep(named.select("shape", template.alias("template")), "named")

    carried = _documents(holders.select("shape", "doc_id", "_content").join(named, "shape"), "template")
    recurring = (carried.groupBy("template").agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("first"))
                 .filter((F.col("_n") >= min_documents) & F.col("first").isNotNull()).select("template", "first"))
    doomed = named.join(recurring, "template").select("shape", "first")
    lost = held.select("doc_id", "_content", "place", F.size("words").alias("words"), "shape").join(doomed, "shape").filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    lost = lost.select("doc_id", "_content", "first", "place", "words").unionByName(_equal_lines(narrow, min_documents, exact_documents))
    # a document's lines meet by the document they stay in, then by the document itself: both are bounded by its text
    by_first = lost.groupBy("doc_id", "_content", "first").agg(F.collect_set("place").alias("places"), F.sum("words").alias("words"))
    out = scratch.keep(by_first.groupBy("doc_id", "_content").agg(F.collect_list(F.struct("words", "first", "places")).alias("_drops")), "lost")
    scratch.drop("lines", "leaves", "held", "shapes", "named")
    return out


def _places(drops: str, but: Column | None = None) -> Column:
    """The places to drop, but for lines that stay in the document ``but``."""
    chosen = F.col(drops) if but is None else F.filter(drops, lambda d: d["first"] != but)
    return F.array_distinct(F.flatten(F.transform(chosen, lambda d: d["places"])))


def _sets_without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of texts without some of their lines."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            texts = [(t or b"").lower() for t in part.column("_t").cast(pa.binary()).to_pylist()]
            left = [_left(t, b"\n", d or ()) for t, d in zip(texts, part.column("_drop").to_pylist(), strict=True)]
            items = [shingles(words).view(np.int64) for words in word_hashes(left)]
            kept = [c for c in part.schema.names if c not in ("_t", "_drop")]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(items, pa.list_(pa.int64()))], names=[*kept, "items"])


def copies(docs: DataFrame, lost: DataFrame, scratch: Scratch, candidate: int = CANDIDATE, share: int = COPY) -> DataFrame:
    """doc_id, _content and ``_partner`` of the documents that, without what both lose otherwise, are near copies of the document where most of
    their dropped lines stay."""
    texts = docs.select("doc_id", whole().alias("_t")).withColumn("_content", F.xxhash64("_t")).distinct()
    main = F.array_max(F.transform("_drops", lambda d: F.struct(d["words"].alias("words"), d["first"].alias("first"))))
    asked = lost.select(F.col("doc_id").alias("_id"), F.col("_content").alias("_c"), "_drops", main.alias("_main"))
    mine = texts.join(asked, texts["doc_id"].eqNullSafe(F.col("_id")) & (texts["_content"] == F.col("_c")))
    mine = mine.filter(100 * F.col("_main.words") >= candidate * F.regexp_count("_t", F.lit(WORD)))
    mine = mine.select("doc_id", "_content", F.col("_main.first").alias("_partner"), "_t", _places("_drops", F.col("_main.first")).alias("_drop"))
    # hot partners: their documents are dealt to as many parts as they need, and the partner goes to each
    schema = lambda df: StructType([*[f for f in df.schema.fields if f.name not in ("_t", "_drop")], StructField("items", ArrayType(LongType()))])
    mine = scratch.keep(mine.mapInArrow(_sets_without, schema(mine)), "candidates")
    wanted = scratch.keep(mine.groupBy("_partner").agg(F.count(F.lit(1)).alias("_n")), "partners")
    # a partner's text is the one with the smallest hash, if its id is repeated
    theirs = texts.join(wanted.select(F.col("_partner").alias("doc_id")), "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by("_t", "_content").alias("_t"), F.min("_content").alias("_content"))
    lost_ = lost.select(F.col("doc_id").alias("_id"), F.col("_content").alias("_c"), "_drops")
    theirs = theirs.join(lost_, (theirs["doc_id"] == F.col("_id")) & (theirs["_content"] == F.col("_c")), "left")
    theirs = theirs.select(F.col("doc_id").alias("_partner"), "_t", _places("_drops").alias("_drop"))
    theirs = theirs.mapInArrow(_sets_without, schema(theirs)).withColumnRenamed("items", "_theirs")
    parts = F.ceil(F.col("_n") / F.lit(PARTNERS)).cast("int")
    dealt = theirs.join(wanted, "_partner").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_n")
    mine = mine.join(wanted, "_partner").withColumn("_part", F.pmod(F.xxhash64("doc_id", "_content"), parts.cast("long")).cast("int"))
    both = mine.join(dealt, ["_partner", "_part"])
    common = F.size(F.array_intersect("items", "_theirs"))
    same = both.select("doc_id", "_content", "_partner", common.alias("_both"), (F.size("items") + F.size("_theirs")).alias("_sum"))
    found = same.filter((F.col("_sum") > 0) & (100 * F.col("_both") >= share * (F.col("_sum") - F.col("_both")))).select("doc_id", "_content", "_partner")
    found = scratch.keep(found, "copies")
    scratch.drop("candidates", "partners")
    return found


def _left(text, end, gone):
    gone = set(gone)
    return end.join(line for i, line in enumerate(text.split(end)) if i not in gone)


@F.pandas_udf(StringType())
def _without(texts: pd.Series, drops: pd.Series) -> pd.Series:
    return pd.Series([None if text is None or drop is None else _left(text, "\n", drop.tolist()) for text, drop in zip(texts, drops, strict=True)], dtype=object)


def _joined(docs: DataFrame, together: bool, **settings) -> DataFrame:
    """The rows of ``docs`` as ``_doc``, their text and what is left of it (``_left``; null if nothing was dropped)."""
    text_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    lost = dropped_lines(docs, scratch, **settings)
    if together:
        found = copies(docs, lost, scratch).select(F.col("doc_id").alias("_i"), F.col("_content").alias("_c"), "_partner")
        lost = lost.join(found, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_content") == F.col("_c")), "left")
        drop = F.when(F.col("_partner").isNull(), _places("_drops")).otherwise(_places("_drops", F.col("_partner")))
    else:
        drop = _places("_drops")
    lost = lost.select("doc_id", "_content", drop.alias("_drop")).filter(F.size("_drop") > 0)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("doc_id").alias("_id"), F.xxhash64(whole()).alias("_h"))
    rows = rows.join(lost, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("_content")), "left")
    text = F.when(F.col("_drop").isNotNull(), F.col("_doc.text"))
    return rows.select("_doc", "_drop", _without(text, "_drop").alias("_left"))


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` without the dropped lines, near copies kept together; documents that lose every word go.  ``n_chars``, where present, follows the text."""
    rows = _joined(docs, True, **settings)
    emptied = F.col("_left").isNotNull() & ~F.col("_left").rlike(r"[^\x20\x09-\x0D]")
    text = F.coalesce("_left", F.col("_doc.text"))
    made = {"text": text, "n_chars": F.when(F.col("_left").isNotNull(), F.length("_left")).otherwise(F.col("_doc.n_chars")) if "n_chars" in docs.columns else None}
    columns = [(made[c].cast(docs.schema[c].dataType) if made.get(c) is not None else F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns]
    return rows.filter(~emptied).select(*columns)


def report(docs: DataFrame, **settings) -> DataFrame:
    """Per row: doc_id, lines before, lines dropped, words left, digest of the text that is left."""
    rows = _joined(docs, False, **settings)
    left = F.coalesce("_left", F.col("_doc.text"), F.lit(""))
    return rows.select(F.col("_doc.doc_id").alias("doc_id"), F.size(F.split(F.coalesce("_doc.text", F.lit("")), "\n")).cast("long").alias("n_lines"),
                       F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
                       F.regexp_count(left, F.lit(WORD)).cast("long").alias("n_words_left"), F.sha2(left, 256).alias("text_sha256"))


SQL = r"""WITH l AS (SELECT doc_id, coalesce(text,'') AS text, unnest(string_split(coalesce(text,''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text,''), chr(10)), 1) AS place FROM documents),
p AS MATERIALIZED (SELECT doc_id, coalesce('i'||doc_id, 't'||sha256(text)) AS who, place, regexp_extract_all(line,'[^\x20\x09-\x0D]+') AS raw,
  list_transform(regexp_extract_all(line,'[^\x20\x09-\x0D]+'), lambda w: CASE WHEN regexp_matches(w,'[0-9@]|://') THEN '<*>' ELSE w END) AS words FROM l),
q AS (SELECT *, (len(words), words[1:3]) AS leaf FROM p WHERE len(words) >= 3),
leaves AS (SELECT leaf FROM q GROUP BY leaf HAVING count(DISTINCT who) >= 5),
held AS MATERIALIZED (SELECT q.* FROM q JOIN leaves USING (leaf)),
shapes AS MATERIALIZED (SELECT leaf, words, count(DISTINCT who) AS n FROM held GROUP BY ALL),
cells AS (SELECT leaf, words, n, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM shapes),
constant AS (SELECT leaf, pos, word FROM cells WHERE word <> '<*>' GROUP BY ALL HAVING sum(n) >= 5),
fixed AS (SELECT leaf, words, count(*) AS c, list((pos, word) ORDER BY pos) AS f FROM cells JOIN constant USING (leaf, pos, word) GROUP BY leaf, words),
named AS MATERIALIZED (SELECT s.leaf, s.words, CASE WHEN c*100 >= 70*len(s.words) AND c >= 5 THEN 'g'||CAST(s.leaf AS VARCHAR)||CAST(f AS VARCHAR) ELSE 's'||CAST(s.words AS VARCHAR) END AS template
  FROM shapes s LEFT JOIN fixed x ON s.leaf = x.leaf AND s.words = x.words),
lines AS MATERIALIZED (SELECT h.doc_id, h.who, h.place, n.template FROM held h JOIN named n ON h.leaf = n.leaf AND h.words = n.words),
recurring AS (SELECT template, min(doc_id) AS first FROM lines GROUP BY template HAVING count(DISTINCT who) >= 5 AND min(doc_id) IS NOT NULL),
equal AS (SELECT raw, min(doc_id) AS first FROM p WHERE len(raw) > 0 GROUP BY raw HAVING count(DISTINCT who) >= CASE WHEN len(raw) >= 3 THEN 2 ELSE 5 END AND min(doc_id) IS NOT NULL),
lost AS (SELECT l.doc_id, l.place FROM lines l JOIN recurring r USING (template) WHERE l.doc_id IS DISTINCT FROM r.first
  UNION SELECT p.doc_id, p.place FROM p JOIN equal e USING (raw) WHERE p.doc_id IS DISTINCT FROM e.first),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY place) AS t FROM l ANTI JOIN lost x ON l.doc_id = x.doc_id AND l.place = x.place GROUP BY l.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id), gone AS (SELECT doc_id, count(*) AS n FROM lost GROUP BY doc_id)
SELECT d.doc_id, c.n::BIGINT AS n_lines, coalesce(g.n,0)::BIGINT AS n_dropped, len(regexp_extract_all(coalesce(k.t,''),'[^\x20\x09-\x0D]+'))::BIGINT AS n_words_left,
  sha256(coalesce(k.t,'')) AS text_sha256 FROM documents d JOIN counts c USING (doc_id) LEFT JOIN gone g USING (doc_id) LEFT JOIN kept k USING (doc_id)"""
