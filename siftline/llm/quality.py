"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Indicators of a text: its words and word pairs (ASCII letters lower-cased), and n-grams (n = 1, 2, 3) of word shapes, each
with the magnitude of its share of the text, so that a long text is not marked by a single odd word.  A shape tells case,
digits, symbols, length class, last character and whether the word repeats the one before.  All are hashed to ``SIZE``
places.  The two blocks are scaled to length one each; indicators are multiplied by their class log-count ratio, and a
linear hinge loss is fitted by dual coordinate descent.  Scores are calibrated on rows the fit has not seen.

The fit uses at most ``SAMPLE`` labelled rows, those with the smallest hash of their id; held-out rows never take part.
Scoring reads every text in full.  Inputs are the text alone.

Defined cases: a null or wordless text has no indicators and gets the score of the bias; a null label or id is no label;
an id with several labels counts once, with its smallest label; without labels of both classes all scores are the same;
repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from siftline.llm import margin
from siftline.llm.common import PIECE, SPACES, _pieces, mixed, split_remainder, text_batches, whole

SIZE = 1 << 18
SAMPLE = 4_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.full(256, 4, dtype=np.uint8)  # 0 space, 1 upper, 2 lower and non-ASCII, 3 digit, 4 symbol, 5 punctuation of prose
_KIND[list(SPACES)] = 0
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 2, 2, 3
_KIND[[ord(c) for c in ".,;:'-\"()?"]] = 5
_TALLY = np.array([1 << 16 * (k - 1) if 1 <= k <= 4 else 0 for k in _KIND.tolist()], dtype=np.uint64)  # four counters in one number
_STEP = mixed(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _word_table(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of every word."""
    raw = np.frombuffer(piece, dtype=np.uint8)
    kind = _KIND[raw]
    at = np.flatnonzero(kind != 0)
    if at.size == 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    starts = np.flatnonzero(np.diff(at) > 1) + 1
    heads = np.concatenate([[0], starts])
    ends = np.concatenate([starts, [at.size]])
    sizes = ends - heads
    within = at - np.repeat(at[heads], sizes)
    letters = raw[at]
    words = mixed(np.add.reduceat((_LOWER[letters] + np.uint64(1)) * _STEP[within & 511], heads))
    counts = np.add.reduceat(_TALLY[letters], heads)
    upper, lower, digits, symbols = (counts >> np.uint64(16 * i) & np.uint64(0xFFFF) for i in range(4))
    initial, last = kind[at[heads]], kind[at[ends - 1]]
    case = np.where(upper == 0, 0, np.where(lower == 0, np.where(upper > 1, 3, 2), np.where(initial == 1, 1, 4)))
    length = np.minimum(np.log2(sizes), 5)
    again = np.zeros(words.size, dtype=bool)
    again[1:] = words[1:] == words[:-1]
    shape = case.astype(np.uint64)
    for value, width in ((np.minimum(digits, 1), 2), (np.minimum(symbols, 3), 4), (last, 6), (length, 6), (again, 2)):
        shape = shape * np.uint64(width) + value.astype(np.uint64)
    return words, shape


def indicators(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the indicators of a whole text and their values before the ratios."""
    if len(text) <= PIECE:
        words, shapes = _word_table(text)
    else:
        tables = [_word_table(p) for p in _pieces(text)]
        words, shapes = (np.concatenate([t[i] for t in tables]) for i in (0, 1))
    if words.size == 0:
        return np.empty(0, np.int64), np.empty(0)
    two, half = np.uint64(0xA24BAED4963EE407), np.uint64(SIZE // 2 - 1)
    lexical = mixed(np.concatenate([words, words[:-1] * two + words[1:]])) & half
    single = shapes + np.uint64(1)
    double = single[:-1] * two + single[1:]
    triple = double[:-1] * two + single[2:]
    kinds, times = np.unique(np.concatenate([single, double + np.uint64(1 << 20), triple + np.uint64(1 << 21)]), return_counts=True)
    share = np.maximum(np.floor(np.log2(times / words.size)), -8).astype(np.int64) + 9
    # a share of 1/4 also is one of 1/8
    level = np.arange(share.sum()) - np.repeat(np.cumsum(share) - share, share)
    formal = mixed(np.repeat(kinds, share) + level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & half
    places = np.concatenate([lexical, formal + half + np.uint64(1)]).astype(np.int32)
    places.sort()
    places = places[np.concatenate([[True], places[1:] != places[:-1]])]
    n = int(np.searchsorted(places, SIZE // 2))
    values = np.empty(places.size)
    values[:n], values[n:] = n**-0.5, max(places.size - n, 1) ** -0.5
    return places.astype(np.int64), values


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("_t").cast(pa.binary()).to_pylist()]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = [indicators(t) for t in _texts(part)]
            yield pa.RecordBatch.from_arrays([part.column("_o"), part.column("_y"), pa.array([r[0].astype(np.int32).tobytes() for r in rows], pa.binary()),
                                              pa.array([r[1].astype(np.float32).tobytes() for r in rows], pa.binary())], names=["_o", "_y", "i", "v"])


def _fitted(table: pa.Table) -> pa.Table:
    """The model of the sample, made in one task; the sample is bounded."""
    table = table.sort_by("_o")
    rows = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32))
            for i, v in zip(table.column("i").to_pylist(), table.column("v").to_pylist(), strict=True)]
    return pa.table({"model": pa.array([pickle.dumps(margin.fit(rows, np.array(table.column("_y").to_pylist(), dtype=np.float64), SIZE))], pa.binary())})


def labelled_sample(labels: DataFrame, label: str, folds: int, held_out: int, size: int) -> DataFrame:
    """At most ``size`` ids with a label outside the held-out part, by the hash of the id: _id, _y, _o."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (split_remainder(folds) != held_out))
    one = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min(label).cast("int").alias("_y"))
    return one.withColumn("_o", F.xxhash64("_id")).orderBy("_o", "_id").limit(size)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> margin.Model:
    text_batches(docs.sparkSession)
    chosen = labelled_sample(labels, "quality", FOLDS, HELD_OUT, sample)
    # at most ``sample`` rows of three numbers are broadcast; of repeated ids the first text in order counts
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), whole().alias("_t")).join(F.broadcast(chosen), "_id")
    texts = texts.groupBy("_id", "_o", "_y").agg(F.min("_t").alias("_t"))
    rows = texts.select("_o", "_y", "_t").mapInArrow(_featured, "_o long, _y int, i binary, v binary")
    made = rows.groupBy(F.lit(1).alias("_k")).applyInArrow(_fitted, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else margin.fit([], np.empty(0), SIZE)


def scored(docs: DataFrame, model: margin.Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` packed as ``_doc`` with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SIZE weights, whatever the data

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                packed = batch.column("_doc").slice(at, 256)
                texts = [t or b"" for t in packed.field("text").cast(pa.binary()).to_pylist()]
                score = shared.value.score([indicators(t) for t in texts])
                yield pa.RecordBatch.from_arrays([packed, pa.array(score, pa.float64())], names=["_doc", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    rows = rows.mapInArrow(scores, StructType([*rows.schema.fields, StructField("score", DoubleType())]))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    rows = scored(docs.select("doc_id", "text"), train(docs, labels))
    return rows.select(F.col("_doc.doc_id").alias("doc_id"), (split_remainder(FOLDS, "_doc.doc_id") == HELD_OUT).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return scored(docs, train(docs, labels)).filter("predicted = 1").select("_doc.*")
