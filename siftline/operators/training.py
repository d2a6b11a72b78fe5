"""ML-1..ML-7: text classification over a labelled table.

Features are relational: a row's terms are ``(key, term, tf)``, the vocabulary is a table of at most ``size`` terms, and a score is
a join with the vocabulary and a sum per row.  Rows meet the vocabulary by 64-bit codes of the terms, and the terms themselves are
compared where codes are equal.  Only the fit itself takes vectors, one for each training row.  ``key`` tells
the rows of a table apart; null and empty texts have no terms and are scored by the intercepts alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from siftline.operators.keys import BROADCAST_ROWS  # noqa: F401  (the tests set it)
from siftline.operators.logistic import BLOCK_SHAPE, fit_labels, packed
from siftline.operators.reports import classification_report, last_wins
from siftline.session import durable, text_batches

# The supported labels, the size gates and the model settings.
LABELS = ["HIGH_INTENT", "MEDIUM_INTENT", "LOW_INTENT", "NOT_INSURANCE", "ADVERTISEMENT", "BROKER_OR_AGENT", "NEWS", "JOB_POST"]
# Buckets of terms that a task adds up, a power of two: 16 MB a task.
BUCKETS = 1 << 21
# Buckets that travel as one value, and sums of terms that a task holds before they leave it.
PIECE, TERM_SUMS = 1 << 11, 1 << 20
MIN_ROWS, MIN_PER_LABEL, TEST_SHARE, FEATURES, SEED = 500, 10, 0.2, 30_000, 42


def gate(rows: DataFrame, labels: list[str], min_rows: int = MIN_ROWS, min_per_label: int = MIN_PER_LABEL) -> DataFrame:
    """ML-1: deduplicated rows per label with the verdict of each gate."""
    per = last_wins(rows).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    wanted = rows.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    both = wanted.withColumn("supported", F.lit(True)).join(per, "label", "full_outer").na.fill(0, ["n"])
    verdict = (F.when(F.col("supported").isNull(), "unsupported_label").when(F.col("n") < min_per_label, "too_few").otherwise("ok"))
    total = F.sum("n").over(Window.partitionBy())
    return both.select("label", "n", verdict.alias("verdict"), (total >= min_rows).alias("enough_rows"))


def require(gated: DataFrame) -> None:
    failed = gated.filter((F.col("verdict") != "ok") | ~F.col("enough_rows"))
    if not failed.isEmpty():
        raise ValueError("need enough deduplicated examples with supported labels and enough of every label")


def split(rows: DataFrame, label: str = "label", key: str = "pos", share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """ML-2: adds ``part``: per label the first share of rows in the order of a seeded hash is the test part.

    Labels are few and may be hot, so the cut is taken from hash buckets: whole buckets below the cut are
    test rows, and only the rows of the one bucket that holds the cut are ordered.
    """
    h = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")), 256)
    staged = rows.withColumn("_h", h).withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    sizes = staged.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    sizes = sizes.withColumn("_test", F.ceil(F.sum("_n").over(Window.partitionBy(label)) * share))
    # 4096 buckets per label: as a table of known size it is broadcast for any sensible number of labels, and rows stay where they are
    staged = staged.join(durable(sizes, "sizes"), [label, "_b"])
    whole = F.col("_before") + F.col("_n") <= F.col("_test")
    edge = ~whole & (F.col("_before") < F.col("_test"))
    local = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h"))
    at_edge = staged.filter(edge).withColumn("_k", local)
    at_edge = at_edge.withColumn("part", F.when(F.col("_before") + F.col("_k") <= F.col("_test"), "test").otherwise("train")).drop("_k")
    others = staged.filter(~edge).withColumn("part", F.when(whole, "test").otherwise("train"))
    return at_edge.unionByName(others).drop("_h", "_b", "_n", "_before", "_test")


@dataclass(frozen=True)
class TextModel:
    """A fitted model: ``terms`` is ``(term, idx, idf, coefficients)`` with one coefficient a label, at most as many rows as features."""

    labels: list[str]
    intercepts: list[float]
    terms: DataFrame

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.mode("errorifexists").parquet(f"{path}/terms")
        rows = list(zip(range(len(self.labels)), self.labels, self.intercepts))
        spark.createDataFrame(rows, "idx int, label string, intercept double").coalesce(1).write.mode("errorifexists").parquet(f"{path}/labels")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        rows = spark.read.parquet(f"{path}/labels").orderBy("idx").collect()  # one row a label
        return TextModel([r.label for r in rows], [r.intercept for r in rows], spark.read.parquet(f"{path}/terms"))


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"(?U)\w\w+"), F.lit(0))


def _neighbours(items: str, joined) -> Column:
    """``joined`` of every item of an array and the next one."""
    n = F.greatest(F.size(items) - 1, F.lit(0))
    return F.zip_with(F.slice(items, F.lit(1), n), F.slice(items, F.lit(2), n), joined)


def term_counts(rows: DataFrame, key: str = "pos", text: str = "text") -> DataFrame:
    """Words of two or more characters and pairs of neighbours: ``(key, term, tf)``.

    Counted inside the row from its sorted terms, so nothing is shuffled.
    """
    s, starts = F.col("_s"), F.col("_at")
    pairs = _neighbours("_w", lambda a, b: F.concat(a, F.lit(" "), b))
    first = F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i))
    counted = F.transform(starts, lambda p, i: F.struct(
        F.get(s, p).alias("term"), (F.coalesce(F.get(starts, i + 1), F.size(s)) - p).alias("tf")))
    staged = (rows.select(F.col(key), _words(text).alias("_w"))
              .select(key, F.sort_array(F.concat("_w", pairs)).alias("_s"))
              .select(key, "_s", F.filter(first, lambda p: p.isNotNull()).alias("_at")))
    return staged.select(key, F.inline(counted))


def term_code(term: Column) -> Column:
    """The code of a term: that of its word, or of the codes of its two words."""
    first, second = F.xxhash64(F.substring_index(term, " ", 1)), F.xxhash64(F.substring_index(term, " ", -1))
    return F.when(F.contains(term, F.lit(" ")), F.xxhash64(first, second)).otherwise(first)


def occurrences(rows: DataFrame, key: str = "pos", text: str = "text", terms: bool = True) -> DataFrame:
    """``(key, code, term)``, a row per occurrence of a term; ``terms=False`` leaves the term out and makes no strings of pairs.

    The words of a text stay one array, of which every row takes a place: words at the even places, pairs at the odd ones between them.
    The generator is an outer one: for an inner one the optimizer infers a filter on the size of the array and moves it down as a
    copy of the expression, so that every text would be cut twice.
    """
    n, at = F.size("_w"), F.shiftright("_p", 1)
    placed = rows.select(F.col(key), _words(text).alias("_w")).select(key, "_w", F.explode_outer(F.when(n > 0, F.sequence(F.lit(0), 2 * n - 2))).alias("_p"))
    first, second, word = F.get("_w", at), F.get("_w", at + 1), F.col("_p").bitwiseAND(1) == 0
    code = F.when(word, F.xxhash64(first)).otherwise(F.xxhash64(F.xxhash64(first), F.xxhash64(second))).alias("code")
    term = [F.when(word, first).otherwise(F.concat(first, F.lit(" "), second)).alias("term")] if terms else []
    return placed.filter("_p IS NOT NULL").select(key, code, *term)


def _most(counts: DataFrame, size: int) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df")).orderBy(F.desc("n"), "term").limit(size)


def _numbered(top: DataFrame, rows: int) -> DataFrame:
    # one task numbers at most ``size`` terms
    idx = F.row_number().over(Window.orderBy("term")) - 1
    return top.select("term", idx.alias("idx"), (F.log((F.lit(1.0) + rows) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))


def vocabulary(counts: DataFrame, rows: int, size: int = FEATURES) -> DataFrame:
    """The ``size`` terms with the largest counts, ties by term: ``(term, idx, idf)`` with idf = 1 + ln((1 + rows) / (1 + df))."""
    return _numbered(_most(counts, size), rows)


def word_characters(spark: SparkSession) -> np.ndarray:
    """For every code point whether words hold it, asked from the engine that cuts them in :func:`_words`."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = spark.createDataFrame(pa.table({"t": [every]})).select(F.regexp_replace("t", r"(?U)\W+", "")).first()[0]
    held = np.zeros(0x110000, dtype=bool)
    held[np.frombuffer(found.encode("utf-32-le"), dtype="<u4")] = True
    return held


def cut_words(texts: pa.StringArray, held: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """The words of the texts of :func:`_lower` as :func:`_words` finds them, all in a row, and their number in each text."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if ends[-1] > ends[0] else np.zeros(0, dtype=np.uint8)
    ends = ends - ends[0]
    ascii_only = bytes((held[:256] & (np.arange(256) < 128)).astype(np.uint8))
    inside = np.frombuffer(bytearray(raw.tobytes().translate(ascii_only)), dtype=np.uint8)
    at = np.flatnonzero(raw >= 0xC0)
    if len(at):  # characters of two to four bytes; all of their bytes are inside or outside
        lead, b1, b2, b3 = raw[at].astype(np.int64), *(np.append(raw, np.zeros(3, dtype=np.uint8))[at + k].astype(np.int64) & 0x3F for k in (1, 2, 3))
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        point = np.choose(size - 2, [(lead & 0x1F) << 6 | b1, (lead & 0xF) << 12 | b1 << 6 | b2, (lead & 7) << 18 | b1 << 12 | b2 << 6 | b3])
        of = held[np.minimum(point, 0x10FFFF)]
        for k in range(4):
            inside[at[of & (size > k)] + k] = 1
    # a text ends outside of a word, so runs of texts do not touch
    starts, stops = np.flatnonzero(np.diff(inside, prepend=np.uint8(0)) != 0).reshape(-1, 2).T
    first, length = raw[starts], stops - starts
    single = length == 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
    for k in range(4):  # a word has two characters or more
        inside[starts[single & (length > k)] + k] = 0
    starts, length = starts[~single], length[~single]
    bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
    letters = (raw * inside).tobytes().translate(None, b"\0")
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(bounds), pa.py_buffer(letters)), np.diff(np.searchsorted(starts, ends))


def _codes(words: pa.StringArray) -> np.ndarray:
    """A 64-bit number for each word, from its bytes and their places."""
    bounds, raw = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64), words.buffers()[2]
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    length = np.diff(bounds)
    place = np.arange(bounds[0], bounds[-1]) - np.repeat(bounds[:-1], length)
    power = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15, dtype=np.uint64))
    sums = np.add.reduceat((np.frombuffer(raw, dtype=np.uint8)[bounds[0]:bounds[-1]] + np.uint64(1)) * power[place], bounds[:-1] - bounds[0])
    return _mixed(sums + length.astype(np.uint64))


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return code ^ (code >> np.uint64(29))


class _Cut:
    """The words of a batch as numbers (``words``) of ``names``, the row of each (``row``), the words with a neighbour behind (``at``)."""

    def __init__(self, texts: pa.StringArray, held: np.ndarray):
        words, counts = cut_words(texts, held)
        coded = words.dictionary_encode()
        self.names, self.words = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(len(texts)), counts)
        self.at = np.flatnonzero(self.row[1:] == self.row[:-1])

    def buckets(self, buckets: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """The two buckets of the words and of the pairs, one in each half."""
        half = np.uint64(buckets // 2)
        code = _codes(self.names)[self.words]
        pair = _mixed(code[self.at] * np.uint64(0x9E3779B97F4A7C15) + code[self.at + 1])
        return tuple(((c >> np.uint64(8) & half - np.uint64(1)).astype(np.int64), (half + (c >> np.uint64(36) & half - np.uint64(1))).astype(np.int64)) for c in (code, pair))


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)


def _bucket_sums(buckets: int, characters: bytes):
    def sums(batches):
        held, total = _flags(characters), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            of_words, of_pairs = _Cut(batch.column(1), held).buckets(buckets)
            total += np.bincount(np.concatenate([*of_words, *of_pairs]), minlength=buckets)
        pieces = np.split(total, max(buckets // PIECE, 1))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces))), pa.array([p.tobytes() for p in pieces], pa.binary())], names=["piece", "n"])

    return sums


def _added_pieces(batches):
    """``(bucket, n)`` of the pieces that all tasks have sent."""
    held = {}
    for batch in batches:
        for piece, n in zip(*(c.to_pylist() for c in batch.columns)):
            n = np.frombuffer(n, dtype=np.int64)
            held[piece] = held[piece] + n if piece in held else n
    for piece, n in held.items():
        full = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(full + piece * len(n)), pa.array(n[full])], names=["bucket", "n"])


def _term_sums(packed: bytes, characters: bytes):
    """``(term, n, df)`` of the terms both of whose buckets are given, added up as far as a task holds them."""
    def added(found):
        both = pa.Table.from_batches(found).group_by("term").aggregate([("n", "sum"), ("df", "sum")])
        return both.select(["term", "n_sum", "df_sum"]).rename_columns(["term", "n", "df"]).to_batches()

    def sums(batches):
        held, full, sent = _flags(characters), _flags(packed), []
        for batch in batches:
            cut, rows = _Cut(batch.column(1), held), max(batch.num_rows, 1)
            n, (some, pairs) = len(cut.names), (full[a] & full[b] for a, b in cut.buckets(len(full)))
            at = cut.at[pairs]
            # a term is the number of its word, or n and more for a pair; none is taken for another
            term = np.concatenate([cut.words[some], n + cut.words[at] * n + cut.words[at + 1]])
            found, tf = np.unique(term * rows + np.concatenate([cut.row[some], cut.row[at]]), return_counts=True)
            term = found // rows
            first = np.flatnonzero(np.diff(term, prepend=-1))
            if not len(first):
                continue
            term, total, df = term[first], np.add.reduceat(tf, first), np.diff(first, append=len(term))
            for of, pairs in ((term < n, False), (term >= n, True)):
                left, right = np.divmod(term[of] - n, n) if pairs else (term[of], None)
                names = cut.names.take(pa.array(left))
                if pairs:
                    names = pc.binary_join_element_wise(names, cut.names.take(pa.array(right)), " ")
                sent.append(pa.RecordBatch.from_arrays([names, pa.array(total[of]), pa.array(df[of])], names=["term", "n", "df"]))
            if sum(b.num_rows for b in sent) >= TERM_SUMS:
                yield from added(sent)
                sent = []
        if sent:
            yield from added(sent)

    return sums


class _Known:
    """A vocabulary for tasks that count its terms: its words by number, and its pairs as ordered pairs of numbers."""

    def __init__(self, terms: list[str]):
        parts = [t.split(" ") for t in terms]  # words hold no space
        numbers = {w: i for i, w in enumerate(dict.fromkeys(w for p in parts for w in p))}
        self.words, self.size = pa.array(list(numbers), pa.string()), max(len(terms), 1)
        self.single = np.full(len(numbers) + 1, -1)  # the last one is for words outside
        for i, p in enumerate(parts):
            if len(p) == 1:
                self.single[numbers[p[0]]] = i
        pairs = sorted((numbers[p[0]] * len(numbers) + numbers[p[1]], i) for i, p in enumerate(parts) if len(p) == 2)
        self.pairs, self.of_pair = np.array([*pairs, (-1, -1)], dtype=np.int64).T[:, :len(pairs)] if pairs else np.zeros((2, 0), dtype=np.int64)
        self.maybe = np.zeros(BUCKETS, dtype=bool)
        self.maybe[self._bucket(self.pairs)] = True

    def _bucket(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) & np.uint64(len(self.maybe) - 1)).astype(np.int64)

    def counts(self, cut: _Cut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, idx, tf`` of the terms of a batch, by row and idx."""
        word = pc.fill_null(pc.index_in(cut.names, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)[cut.words]
        one = self.single[word]
        left, right = word[cut.at], word[cut.at + 1]
        some = np.flatnonzero((left >= 0) & (right >= 0))
        pair = left[some] * len(self.words) + right[some]
        likely = self.maybe[self._bucket(pair)]
        some, pair = some[likely], pair[likely]
        place = np.searchsorted(self.pairs, pair)
        same = np.append(self.pairs, -1)[place] == pair
        row = np.concatenate([cut.row[one >= 0], cut.row[cut.at[some[same]]]])
        found, tf = np.unique(row * self.size + np.concatenate([one[one >= 0], self.of_pair[place[same]]]), return_counts=True)
        return *np.divmod(found, self.size), tf


def _known_counts(known: _Known, characters: bytes):
    def counts(batches):
        held = _flags(characters)
        for batch in batches:
            row, idx, tf = known.counts(_Cut(batch.column(1), held))
            arrays = [batch.column(0).take(pa.array(row)), pa.array(idx.astype(np.int32)), pa.array(tf)]
            yield pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[0], "idx", "tf"])

    return counts


def _lower(text: str) -> Column:
    """The text for :func:`cut_words`, ended by a character that is part of no word."""
    return F.concat(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit("\n")).alias("_t")


def _fitted_terms(rows: DataFrame, size: int, text: str, characters: bytes) -> DataFrame:
    """:func:`vocabulary` of the terms of ``rows``.

    Occurrences are first added up in a fixed number of buckets, two for a term, which a task does by itself whatever the number of terms.
    A bucket counts at least as often as any of its terms, so terms with another bucket than the fullest ones are outside if the last term
    found in these counts no less than each of the others.  Otherwise its count is a bound that the right last term reaches too, and all
    buckets from there on are taken.  A text lies in one task, so its terms are counted without a shuffle, and only sums leave the task.
    """
    total = rows.count()
    cut = rows.select(F.lit(0).alias("_0"), _lower(text))
    pieces = cut.mapInArrow(_bucket_sums(BUCKETS, characters), "piece long, n binary").repartition("piece")
    buckets = durable(pieces.mapInArrow(_added_pieces, "bucket long, n long"), "buckets")
    least, found = buckets.orderBy(F.desc("n")).limit(8 * size).agg(F.min("n"), F.count(F.lit(1))).first()
    least = least if found == 8 * size else 0
    while True:
        full = np.zeros(BUCKETS, dtype=bool)  # at most BUCKETS numbers pass the driver
        full[buckets.filter(F.col("n") >= least).select("bucket").toArrow().column(0).to_numpy()] = True
        sums = cut.mapInArrow(_term_sums(_bits(full), characters), "term string, n long, df long")
        sums = sums.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
        top = durable(sums.orderBy(F.desc("n"), "term").limit(size), "terms")
        worst, kept = top.agg(F.min("n"), F.count(F.lit(1))).first()
        worst = worst if kept == size else 0
        if worst >= least:
            break
        least = worst
    return durable(_numbered(top, total), "numbered")


def _listed(terms: DataFrame) -> tuple[list[str], np.ndarray]:
    """Terms and idf by idx: at most ``size`` rows."""
    table = terms.select("idx", "term", "idf").toArrow().sort_by("idx")
    return table.column("term").to_pylist(), table.column("idf").to_numpy()


def fitted_vocabulary(rows: DataFrame, size: int = FEATURES, key: str = "pos", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """:func:`vocabulary` of the terms of ``rows``, and counts ``(key, term, tf, idx)`` of its terms."""
    text_batches(rows.sparkSession)
    characters = _bits(word_characters(rows.sparkSession))
    terms = _fitted_terms(rows, size, text, characters)
    cut = rows.select(F.col(key), _lower(text))
    shape = StructType([cut.schema[key], StructField("idx", IntegerType()), StructField("tf", LongType())])
    counts = durable(cut.mapInArrow(_known_counts(_Known(_listed(terms)[0]), characters), shape), "counts")
    return terms, counts.join(F.broadcast(terms.select("term", "idx")), "idx")


def raw_weights(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """``counts`` with the columns of ``terms`` and ``raw`` = (1 + ln tf) * idf; terms outside the vocabulary go."""
    # a vocabulary is at most FEATURES terms
    by = "idx" if "idx" in counts.columns else "term"
    both = counts.drop("term") if by == "idx" else counts
    return both.join(F.broadcast(terms), by).withColumn("raw", (F.log(F.col("tf").cast("double")) + 1) * F.col("idf"))


def _known_numbers(rows: DataFrame, terms: DataFrame, key: str = "pos", text: str = "text") -> DataFrame:
    """``(key, idx, tf)`` for the terms of ``terms`` alone.

    Rows are dealt by ``key`` once, as pairs of numbers; what is computed per row and term or per row afterwards moves nothing.
    """
    numbers = F.broadcast(terms.select(term_code(F.col("term")).alias("_code"), F.col("term").alias("_term"), "idx"))
    # between instead of equality: an equality would become part of the hashed key, and hash every string
    same = (F.col("code") == F.col("_code")) & F.col("term").between(F.col("_term"), F.col("_term"))
    met = occurrences(rows, key, text).join(numbers, same).select(key, "idx")
    return met.repartition(key).groupBy(key, "idx").agg(F.count(F.lit(1)).alias("tf"))


def known_counts(rows: DataFrame, terms: DataFrame, key: str = "pos", text: str = "text") -> DataFrame:
    """``(key, term, tf)`` for the terms of ``terms`` alone."""
    return _known_numbers(rows, terms, key, text).join(F.broadcast(terms.select("term", "idx")), "idx").select(key, "term", "tf")


def weighted(counts: DataFrame, terms: DataFrame, key: str = "pos") -> DataFrame:
    """ML-3: ``(key, term, idx, weight)``, the weights of a row at unit length."""
    of_row = Window.partitionBy(key)
    raw = raw_weights(counts, terms)
    return raw.select(key, "term", "idx", (F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(of_row))).alias("weight"))


def row_totals(counts: DataFrame, terms: DataFrame, key: str = "pos") -> DataFrame:
    """``(key, terms, total, largest)``: number, sum and maximum of the :func:`weighted` terms of a row.

    The length of a row is a factor of them all, so one sum per row does, and the terms of a row are not brought together.
    """
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
    return raw_weights(counts, terms).groupBy(key).agg(
        F.count(F.lit(1)).alias("terms"), (F.sum("raw") / norm).alias("total"), (F.max("raw") / norm).alias("largest"))


def features(rows: DataFrame, terms: DataFrame, key: str = "pos", text: str = "text") -> DataFrame:
    """ML-3: :func:`weighted` terms of rows, which need not be those of the vocabulary."""
    return weighted(known_counts(rows, terms, key, text), terms, key)


def sparse(indices: Column, values: Column, size: int) -> Column:
    """A vector of Spark ML from two arrays, without a Python function: the stored form of a vector, read back from JSON."""
    stored = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(stored.alias("v"))), StructType().add("v", VectorUDT()))["v"]


def _packed(entries: DataFrame, size: int, key: str) -> DataFrame:
    listed = entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_e"))
    return listed.select(key, sparse(F.col("_e.idx"), F.col("_e.weight"), size).alias("features"))


def vectors(rows: DataFrame, terms: DataFrame, size: int = FEATURES, key: str = "pos", text: str = "text") -> DataFrame:
    """``(key, features)`` of the rows that hold a term; at most ``size`` entries a row."""
    return _packed(features(rows, terms, key, text), size, key)


def balanced(rows: DataFrame, label: str = "label") -> DataFrame:
    """Row weights n / (classes * n_label)."""
    per = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    per = per.withColumn("weight", F.sum("_n").over(Window.partitionBy()) / (F.count(F.lit(1)).over(Window.partitionBy()) * F.col("_n")))
    return rows.join(F.broadcast(per.drop("_n")), label)


def _vector_blocks(known: _Known, idf: np.ndarray, labels: list[str], characters: bytes):
    """Rows for :func:`siftline.operators.logistic.fit_labels`: the entries of its vectors as numbers of terms and counts."""
    def blocks(batches):
        held, names = _flags(characters), pa.array(labels, pa.string())
        for batch in batches:
            row, idx, tf = known.counts(_Cut(batch.column(1), held))
            if batch.column(0).null_count:  # a row without a key has no terms
                some = batch.column(0).is_valid().to_numpy(zero_copy_only=False)[row]
                row, idx, tf = row[some], idx[some], tf[some]
            raw = (np.log(tf) + 1) * idf[idx]
            norm = np.sqrt(np.bincount(row, raw * raw, minlength=batch.num_rows))
            label = pc.index_in(batch.column(2).cast(pa.string()), value_set=names).to_numpy(zero_copy_only=False)
            yield from packed(np.bincount(row, minlength=batch.num_rows), idx, tf, norm, label, batch.column(3).to_numpy())

    return blocks


def train(rows: DataFrame, size: int = FEATURES, key: str = "pos") -> TextModel:
    """ML-3/ML-4: one balanced logistic regression per label over the text features; rows without a label are left out."""
    rows = rows.filter("label IS NOT NULL").withColumn("label", F.col("label").cast("string"))
    spark = rows.sparkSession
    text_batches(spark)
    characters = _bits(word_characters(spark))
    weights = balanced(rows)
    labels = sorted((r.label for r in rows.select("label").distinct().collect()), key=lambda x: x.encode("utf-16-be"))  # a coefficient each
    if not labels:
        raise ValueError("no labelled rows")
    terms = _fitted_terms(rows, size, "text", characters)
    names, idf = _listed(terms)
    cut = weights.select(key, _lower("text"), "label", "weight")
    blocks = cut.mapInArrow(_vector_blocks(_Known(names), idf, labels, characters), BLOCK_SHAPE)
    intercepts, per_label = fit_labels(blocks, idf, len(labels))
    coefficients = spark.createDataFrame(list(enumerate(per_label.T.tolist())), "idx int, coefficients array<double>")  # size x labels numbers
    return TextModel(labels, intercepts, durable(terms.join(F.broadcast(coefficients), "idx"), "terms"))


def label_shares(model: TextModel, rows: DataFrame, key: str = "pos", text: str = "text") -> DataFrame:
    """``(key, _p)``: the probability of every label for the rows that hold a term, from one sum per row and label.

    The terms of a row are dealt to one task by ``key``, and the sums move no further.
    """
    raw = raw_weights(_known_numbers(rows, model.terms, key, text), model.terms)
    names = [f"_m{i}" for i in range(len(model.labels))]
    sums = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_norm"),
                                *[F.sum(F.col("raw") * F.col("coefficients")[i]).alias(n) for i, n in enumerate(names)])
    share = lambda margin: 1.0 / (1.0 + F.exp(-margin))
    return sums.select(key, F.array(*[share(F.col(n) / F.col("_norm") + b) for n, b in zip(names, model.intercepts)]).alias("_p"))


def score_rows(model: TextModel, rows: DataFrame, version: str, labels: list[str] | None = None, key: str = "pos") -> DataFrame:
    """ML-5: best label, confidence and version per row; null for labels outside the supported list."""
    without = F.array(*[1.0 / (1.0 + F.exp(F.lit(-b))) for b in model.intercepts])
    staged = rows.join(label_shares(model, rows, key), key, "left").withColumn("_p", F.coalesce("_p", without))
    best = F.array_max("_p")
    total = F.aggregate("_p", F.lit(0.0), lambda a, x: a + x)
    name = F.try_element_at(F.array(*[F.lit(n) for n in model.labels]), F.array_position("_p", best).cast("int"))
    staged = staged.withColumn("predicted", name).withColumn("confidence", best / total).withColumn("model_version", F.lit(version))
    if labels is not None:
        fine = F.col("predicted").isin(labels)
        staged = staged.withColumn("confidence", F.when(fine, F.col("confidence"))).withColumn("predicted", F.when(fine, F.col("predicted")))
    return staged.select(*rows.columns, "predicted", "confidence", "model_version")


def holdout_report(model: TextModel, test: DataFrame, version: str = "holdout") -> DataFrame:
    """ML-6."""
    return classification_report(score_rows(model, test, version))
