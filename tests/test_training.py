"""Relational text features and scores beside plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.ml.classification import LogisticRegression

from siftline.operators import training
from siftline.session import fresh_path

TEXTS = [(1, "Cover my car, cover my home", "a"), (2, "car car CAR insurance é", "a"), (3, "news of the day: home", "b"), (4, "the day the news came", "b"),
         (5, "job post for the car shop", "c"), (6, "job post, apply today", "c"), (7, "", "a"), (8, None, "b"), (9, "x y z", "c")]


def grams(text):
    words = re.findall(r"\w\w+", (text or "").lower())
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def plain_features(rows, size):
    counts = {k: grams(t) for k, t, _ in rows}
    total, df = Counter(), Counter()
    for c in counts.values():
        total.update(c)
        df.update(c.keys())
    kept = sorted(total, key=lambda t: (-total[t], t))[:size]
    idf = {t: 1 + math.log((1 + len(rows)) / (1 + df[t])) for t in kept}
    out = {}
    for k, c in counts.items():
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(k, t): v / norm for t, v in raw.items()})
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(TEXTS, "pos long, text string, label string")


@pytest.mark.parametrize("size", [7, 1000])
def test_features_are_those_of_plain_python(rows, size):
    terms = training.vocabulary(training.term_counts(rows), len(TEXTS), size)
    got = {(r.pos, r.term): r.weight for r in training.features(rows, terms).collect()}
    want = plain_features(TEXTS, size)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    by_row = {r.pos: r.features for r in training.vectors(rows, terms, size).collect()}
    assert by_row.keys() == {k for k, _ in want} and by_row[2].size == size
    assert sum(v * v for v in by_row[2].values) == pytest.approx(1)


def test_scores_are_recounted_from_the_coefficients(spark, rows):
    model = training.train(rows, 1000)
    path = fresh_path(spark, "model")
    model.save(path)
    model = training.TextModel.load(spark, path)
    assert model.labels == ["a", "b", "c"]
    table = {r.term: r for r in model.terms.collect()}
    other = [*TEXTS, (10, "car car news", None), (11, "unknown words only", None)]
    scored = training.score_rows(model, spark.createDataFrame(other, "pos long, text string, label string"), "v1")
    assert scored.columns == ["pos", "text", "label", "predicted", "confidence", "model_version"]
    got = {r.pos: r for r in scored.collect()}
    assert len(got) == len(other)
    for pos, text, label in other:
        raw = {t: (1 + math.log(n)) * table[t].idf for t, n in grams(text).items() if t in table}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        margins = [b + sum(v * table[t].coefficients[i] for t, v in raw.items()) / norm for i, b in enumerate(model.intercepts)]
        shares = [1 / (1 + math.exp(-m)) for m in margins]
        assert got[pos].confidence == pytest.approx(max(shares) / sum(shares), abs=1e-9)
        assert got[pos].predicted == model.labels[shares.index(max(shares))]
        if text and label and len(text) > 5:
            assert got[pos].predicted == label
    limited = training.score_rows(model, rows, "v1", ["a", "b"])
    assert {r.predicted for r in limited.collect()} == {"a", "b", None}


def test_scoring_runs_without_python_and_shuffles_sums(rows):
    model = training.train(rows, 1000)
    plan = training.label_shares(model, rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_empty_table(spark, rows):
    terms = training.vocabulary(training.term_counts(rows), len(TEXTS))
    assert training.features(rows.limit(0), terms).count() == 0


def test_texts_are_cut_once_and_the_vocabulary_is_that_of_all_terms(spark, rows, monkeypatch):
    for terms in (True, False):
        plan = training.occurrences(rows, terms=terms)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all") == 1
    many = spark.createDataFrame([(i, f"common words {i % 7} of row{i % 40} again common", "a") for i in range(400)], "pos long, text string, label string")
    for table, size in ((many, 5), (many, 60), (rows, 7), (rows, 1000), (rows.limit(0), 7)):
        want = training.vocabulary(training.term_counts(table), table.count(), size).orderBy("idx").collect()
        terms, counts = training.fitted_vocabulary(table, size)
        assert terms.orderBy("idx").collect() == want
        weights = lambda df: {(r.pos, r.term): r.weight for r in df.collect()}
        assert weights(training.weighted(counts, terms)) == pytest.approx(weights(training.features(table, terms)))
    # only terms that may be in the vocabulary are kept as strings
    few = training.fitted_vocabulary(many, 5)[1].select("term").distinct().count()
    assert few < 20 < training.term_counts(many).select("term").distinct().count()
    # codes that clash, or too many of them, lead to the count of all terms
    want = training.vocabulary(training.term_counts(many), 400, 5).orderBy("idx").collect()
    monkeypatch.setattr(training, "BROADCAST_ROWS", 2)
    assert training.fitted_vocabulary(many, 5)[0].orderBy("idx").collect() == want
    monkeypatch.undo()
    coded = training.occurrences
    clash = training.F.pmod(training.F.col("code"), training.F.lit(3))
    monkeypatch.setattr(training, "occurrences", lambda *a, **k: coded(*a, **k).withColumn("code", clash))
    assert training.fitted_vocabulary(many, 5)[0].orderBy("idx").collect() == want


def test_terms_are_counted_in_a_bounded_table_and_rows_move_nothing(spark, rows, monkeypatch):
    written = []
    keep = training.durable
    monkeypatch.setattr(training, "durable", lambda df, name: (written.append((name, keep(df, name))), written[-1][1])[1])
    monkeypatch.setattr(training, "BUCKETS", 64)  # so few that all of them are shared
    many = spark.createDataFrame([(i, f"common words a{i % 7} of row{i} again été common", "a") for i in range(200)], "pos long, text string, label string")
    want = training.vocabulary(training.term_counts(many), 200, 5).orderBy("idx").collect()
    terms, counts = training.fitted_vocabulary(many, 5)
    assert terms.orderBy("idx").collect() == want
    assert {df.count() <= 64 for name, df in written if name == "buckets"} == {True}
    weights = training.weighted(counts, terms).groupBy("pos").agg(training.F.sum("weight").alias("s"), training.F.max("weight").alias("m"))
    totals = training.row_totals(counts, terms)
    assert {r.pos: r.total for r in totals.collect()} == pytest.approx({r.pos: r.s for r in weights.collect()})
    assert {r.pos: r.largest for r in totals.collect()} == pytest.approx({r.pos: r.m for r in weights.collect()})
    assert "Window" not in totals._jdf.queryExecution().executedPlan().toString()


ODD = ["a", "b", "é", "ß", "İ", "_", "٣", "Ⅷ", "中", "́", "‍", "‿", "𝒜", "😀", "-", " ", " ", "\n", "\x00", "."]


def test_words_are_those_of_the_engine(spark):
    odd = random.Random(5)
    texts = ["".join(odd.choices(ODD, k=odd.randrange(40))) for _ in range(800)] + ["", "a", "é", "𝒜", "𝒜b", "ab", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "pos long, text string")
    table = rows.select(training._lower("text"), training._words("text").alias("w")).toArrow().combine_chunks()
    held, want = training.word_characters(spark), table.column("w").to_pylist()
    lowered = table.column("_t").chunk(0)
    for at, n in ((0, len(texts)), (100, 500), (len(texts), 0)):  # parts of an array start at an offset
        words, counts = training.cut_words(lowered.slice(at, n), held)
        assert list(counts) == [len(w) for w in want[at:at + n]]
        assert words.to_pylist() == [x for w in want[at:at + n] for x in w]


def test_labels_are_fitted_side_by_side_as_mllib_fits_each(spark):
    odd = random.Random(3)
    texts = [(i, " ".join(odd.choices([f"w{k}" for k in range(40)] + [f"own{i % 6} été"] * 6, k=12)) if i % 11 else "", f"label{i % 6}") for i in range(240)]
    rows = spark.createDataFrame(texts, "pos long, text string, label string").localCheckpoint()
    context = spark.sparkContext
    context.setJobGroup("training", "jobs of the fit")
    try:
        model = training.train(rows, 500)
        jobs = len(context.statusTracker().getJobIdsForGroup("training"))
    finally:
        context.setJobGroup("other", "")
    assert jobs < 130  # a fit for each of six labels has several hundred
    terms, counts = training.fitted_vocabulary(rows, 500)
    entries = training._packed(training.weighted(counts, terms), 500, "pos")
    empty = training.sparse(training.F.array().cast("array<int>"), training.F.array().cast("array<double>"), 500)
    data = training.balanced(rows).join(entries, "pos", "left").withColumn("features", training.F.coalesce("features", empty)).localCheckpoint()
    found = {r.idx: r.coefficients for r in model.terms.collect()}
    assert model.labels == [f"label{k}" for k in range(6)]
    for k in (0, 4):
        own = data.withColumn("y", (training.F.col("label") == f"label{k}").cast("double"))
        want = LogisticRegression(maxIter=50, regParam=0.01, weightCol="weight", labelCol="y").fit(own)
        assert model.intercepts[k] == pytest.approx(want.intercept, abs=1e-6)
        assert [found[i][k] for i in sorted(found)] == pytest.approx(list(want.coefficients.toArray()[:len(found)]), abs=1e-6)
    # one label has nothing to be told from; a row without a key has no terms; without rows there is no model
    alone = training.train(rows.filter("label = 'label1'"), 500)
    assert alone.intercepts == [float("inf")] and {tuple(r.coefficients) for r in alone.terms.collect()} == {(0.0,)}
    with pytest.raises(ValueError):
        training.train(rows.limit(0), 500)


def test_features_of_equal_entries_have_no_coefficient(spark):
    rows = spark.createDataFrame([(i, "red car", "ab"[i % 2]) for i in range(6)], "pos long, text string, label string")
    model = training.train(rows, 50)
    assert model.intercepts == [0.0, 0.0] and {tuple(r.coefficients) for r in model.terms.collect()} == {(0.0, 0.0)}
