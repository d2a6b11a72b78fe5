"""Whitening and fill-in-middle against plain versions, and their defined odd cases."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftline.llm import fill_middle, whitening


def plain_whitening(rows, k=8):
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], dtype=object)
    n = len(rows)
    sums = x.sum(axis=0)
    deviation = [int(sum((n * a - s) ** 2 for a, s in zip(r, sums))) for r in x]
    centred = x.astype(float) - (sums / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, len(values))
    return [i for i, _ in rows], deviation, centred @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def gathered(rows):
    out = {}
    for r in rows:
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


@pytest.mark.parametrize("rows, columns", [(1024, 1024), (64, 16)])
def test_whitening_against_numpy(spark, monkeypatch, rows, columns):
    monkeypatch.setattr(whitening, "ROWS", rows)
    monkeypatch.setattr(whitening, "COLUMNS", columns)
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(300, 40)) * np.linspace(3, 0.5, 40) + 2).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0, None] * 20), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, [0.0] * 40)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(5)
    frame = frame.withColumn("index", F.lit(1)).withColumn("x", F.lit(2)).withColumn("n", F.lit(3))
    got = gathered(whitening.report(frame).collect())
    ids, deviation, want, shares = plain_whitening([(i, [float(np.float32(c)) if c is not None else None for c in v] if v else v) for i, v in data])
    assert sorted(got) == sorted(ids) and 904 in got
    signs = np.sign([got[0][c + 1].whitened * want[0][c] for c in range(8)])
    for i, d, w in zip(ids, deviation, want, strict=True):
        own = got[i]
        assert sorted(own) == list(range(1, 9)) and {(r.n, r.deviation) for r in own.values()} == {(len(ids), d)}
        assert np.allclose([own[c].whitened for c in range(1, 9)], w * signs, atol=1e-9)
        assert np.allclose([own[c].explained for c in range(1, 9)], shares, rtol=1e-9)
    assert max(r.identity_error for own in got.values() for r in own.values()) < 1e-9


def test_whitening_of_odd_tables(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 4.0]), (3, [5.0]), (4, [])], "vec_id long, embedding array<double>")
    rows = whitening.report(frame).collect()
    assert [(r.vec_id, r.component) for r in sorted(rows, key=lambda r: (r.vec_id or 0, r.component))] == [(None, 1), (None, 2), (1, 1), (1, 1), (1, 2), (1, 2)]
    assert {r.whitened for r in rows if r.component == 2} == {None} and {round(r.explained, 9) for r in rows} == {0.0, 1.0}
    assert {r.identity_error < 1e-9 for r in rows} == {True} and {r.deviation for r in rows} == {2048 ** 2, 4096 ** 2}
    same = whitening.report(spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in same] == [(None, 0.0, None, 0)] * 2
    assert whitening.report(frame.limit(0)).count() == 0
    huge = spark.createDataFrame([(i, [float(i * 2**20), 1.0]) for i in range(4000)], "vec_id long, embedding array<double>")
    assert {r.deviation is None for r in whitening.report(huge).filter("vec_id in (0, 3999)").collect()} == {True}
    assert whitening.whitened(huge).filter("vec_id = 0").first().deviation == (4000 * 0 - 1024 * 2**20 * sum(range(4000))) ** 2


def plain_cut(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = ["".join(u) for u in (units[:a], units[a:b], units[b:])]
    if not text or any(m in text for m in fill_middle.MARKS):
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<P>{parts[0]}<S>{parts[2]}<M>{parts[1]}" if form == "psm" else f"<S>{parts[2]}<P>{parts[0]}<M>{parts[1]}"
    return n, form, len(parts[0]), len(parts[1]), out


def test_texts_are_cut_and_restored(spark):
    rng = random.Random(9)
    signs = ["a", "é", "漢", "😀", "\n", "\n\n", "\r\n", "<", "<S", "P>", "\x8a", "ਊ", "ਊ", "\x00", " "]
    docs = [(k, "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))) for k in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "\n"), (1003, "x"), (1004, "has <M> in it\nand more"), (None, "a\nb\nc"), (7, "a\nb"), (7, "a\nb"), (1005, "word " * 100_000 + "\n" + "é\n" * 200_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(5)).withColumn("output", F.lit("x")).withColumn("_t", F.lit("y"))
    rows = fill_middle.transformed(frame)
    rows = rows.select("_doc.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored(F.col("output"), F.col("form")).alias("back"), F.col("_doc.output").alias("own"))
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in rows.collect()), key=str)
    assert got == sorted(((i, *plain_cut(i, t), t or "") for i, t in docs), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"} and {r.own for r in rows.select("own").distinct().collect()} == {"x"}
    assert fill_middle.report(frame.limit(0)).count() == 0


def test_rate_of_cut_texts(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a\nb").alias("text"))
    forms = {r.form: r["count"] for r in fill_middle.transformed(docs, rate=50, spm=20).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 2000) < 150 and abs(forms["spm"] - 400) < 100


def test_marks_in_words():
    raw = np.random.default_rng(1).integers(0, 256, 8 * 500, dtype=np.uint8)
    raw[::7] = 0x0A
    raw[3::11] = 0x0B
    marked = fill_middle.Marked(raw.view("<u8"), fill_middle.ending)
    at = np.flatnonzero(raw == 0x0A)
    assert np.array_equal(marked.select(np.arange(1, at.size + 1)), at)
    places = np.arange(raw.size + 1)
    assert np.array_equal(marked.rank(places), np.searchsorted(at, places))
    assert np.array_equal(fill_middle.Marked(raw.view("<u8"), fill_middle.leading).rank(places), np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]))


def test_sliced_columns_are_read_from_their_own_offset():
    texts = pa.array(["zz\n", "a\nb\n", "", "c", "d\n\ne"]).slice(1, 3)
    found = fill_middle.cuts(texts, np.array([1, 0, 1]), np.array([2, 0, 0]))
    assert [found[k].tolist() for k in ("n", "one", "two", "prefix_chars", "middle_chars")] == [[2, 0, 1], [2, 0, 0], [4, 0, 1], [2, 0, 0], [2, 0, 1]]
