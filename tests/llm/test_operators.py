"""Operators for training text: brute force, round trips, held-out accuracy and the defined odd cases."""

import random
import re
import sys
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from siftline.llm import archive, catalog, components, credentials, line_rules, line_templates, mixture, near_dupes, neighbours, quality, segmentation, toxicity
from siftline.llm.common import Scratch, word_hashes
from siftline.session import durable

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, target string, _left int"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ter", "son", "vel"]) for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names operators use themselves."""
    same = prose(1, 80)
    rows = [(1, same, "en", "a"), (1, same, "en", "a"), (2, same, "en", None), (3, None, None, "a"), (4, "", "en", "a"), (None, "x y", "en", "b"),
            (None, same + " z", None, None), (5, " \t\r\n ", "en", "b"), (6, "one two three", "en", "b"), (7, "ONE two\nthree", "en", "b"), (8, prose(2, 30_000), "en", "c")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 0.5, "t", 3) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 1), (6, 0, 0), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda d, y: segmentation.report(d), "op2": lambda d, y: line_templates.report(d), "op3": lambda d, y: near_dupes.near_duplicates(d),
    "op4": quality.judged, "op6": lambda d, y: credentials.report(d), "op7": toxicity.scored, "op8": lambda d, y: line_rules.judged(d),
    "op10": lambda d, y: mixture.decisions(d), "stage2": lambda d, y: line_templates.deduplicated(d), "stage3": lambda d, y: near_dupes.deduplicated(d),
    "stage4": quality.accepted, "stage10": lambda d, y: mixture.mix(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_and_empty_tables(spark, odd, labels, name):
    rows = OPERATORS[name](odd, labels).collect()
    if name == "op1":
        assert {r.doc_id for r in rows} == {1, 2, 3, 4, None, 5, 6, 7, 8} and all(r.exact for r in rows)
    elif name.startswith("op"):
        assert len(rows) == odd.count()
    else:
        assert set(rows[0].asDict()) == set(odd.columns)
    assert OPERATORS[name](odd.limit(0), labels.limit(0)).count() == 0


def test_odd_results(spark, odd, labels):
    near = {(r.doc_id, r.n_shingles): r for r in near_dupes.near_duplicates(odd).collect()}
    assert near[(2, 76)].component_id == 1 and not near[(2, 76)].kept and near[(1, 76)].kept
    assert near[(None, 77)].component_id == 1 and not near[(None, 77)].kept
    assert near[(3, 0)].kept and near[(None, 1)].component_id is None and near[(None, 1)].kept
    assert near[(7, 1)].component_id == 6  # equal words whatever the white space
    mixed = {(r.doc_id, r.size): r for r in mixture.decisions(odd).collect()}
    assert all(r.taken <= 3 * r.size for r in mixed.values()) and mixed[(3, 0)].taken == 0
    assert sorted({r.kept for r in line_rules.judged(odd).filter("doc_id in (1, 2)").collect()}) == [True]
    assert all(0 <= r.score <= 1 for r in quality.judged(odd, labels).collect() + toxicity.scored(odd, labels).collect())


def test_word_hashes_do_not_depend_on_grouping():
    texts = [b"", b" ", b"a bb  ccc\t\x0bd", b"x" * 700_000 + b" tail", prose(3, 90_000).encode()]
    together = list(word_hashes(texts))
    for text, got in zip(texts, together, strict=True):
        assert len(got) == len(text.split())
        assert np.array_equal(got, next(word_hashes([text])))
    assert len(set(together[4].tolist())) == len(set(texts[4].split()))


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    docs = []
    for g in range(12):
        base = prose(100 + g, 60).split()
        for _ in range(6):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(60)] = prose(rng.randrange(10**6), 1)
            docs.append((len(docs), " ".join(own)))
    got = {r.doc_id: r.component_id for r in near_dupes.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in docs}
    root = {i: i for i, _ in docs}
    for _ in docs:
        for a in root:
            for b in root:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_sequential_bounds_are_monotone():
    limits = near_dupes.bounds()
    assert limits[-1][0] == near_dupes.BANDS * near_dupes.ROWS
    assert all(later[1] > earlier[1] and later[1] / later[0] <= earlier[1] / earlier[0] for earlier, later in zip(limits, limits[1:]))


def test_stated_miss_is_kept():
    """Exact chance that a pair at the stated similarity is dropped by any check."""
    from math import comb

    agree = 0.5**near_dupes.PLANES + (1 - 0.5**near_dupes.PLANES) * near_dupes.SHARE / 100
    alive, done = {0: 1.0}, 0
    for n, most in near_dupes.bounds():
        step, after = n - done, {}
        for differing, p in alive.items():
            for d in range(step + 1):
                if differing + d <= most:
                    after[differing + d] = after.get(differing + d, 0.0) + p * comb(step, d) * (1 - agree) ** d * agree ** (step - d)
        alive, done = after, n
    assert 1 - sum(alive.values()) <= near_dupes.MISS


def test_one_of_a_group_stays_whatever_the_columns(spark):
    rows = spark.createDataFrame([(1, "a b c d e f g", 1, "x"), (2, "a b c d e f g", 2, "y"), (3, "other words", 3, "z")], "doc_id long, text string, _stay int, _doc string")
    assert sorted((r.doc_id, r["_stay"], r["_doc"]) for r in near_dupes.deduplicated(rows).collect()) == [(1, 1, "x"), (3, 3, "z")]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(7, j) for j in range(8, 20)] + [(50, 50)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, **{j: 7 for j in range(7, 20)}}


@pytest.fixture(scope="module")
def lexicon():
    return segmentation.Lexicon.load(segmentation.MODEL)


def sequential(lexicon, text):
    symbols = lexicon.symbols(text, True)
    _, back = lexicon.sums(symbols, 0, len(symbols), len(symbols), {0: 0})
    return lexicon.traced(symbols, back, len(symbols))[0]


def test_chunks_give_the_sequential_path(spark, lexicon):
    rng = random.Random(2)
    docs = []
    for k in range(24):
        n = rng.randint(60, 900)
        docs.append((k, ["".join(rng.choice("abcdeths") for _ in range(n)), "".join(rng.choice(["the", "ing", " ", "  ", "\n", "é", "▁", "漢", "er"]) for _ in range(n)), prose(k, n // 5)][k % 3]))
    rows = segmentation.encoded(spark.createDataFrame(docs, "doc_id long, text string"), chunk=32).orderBy("doc_id", "part").collect()
    for k, text in docs:
        own = [r for r in rows if r.doc_id == k]
        ids = [i for r in own for i in r.ids]
        assert ids == sequential(lexicon, text) and lexicon.decode(ids) == text and all(r.exact for r in own)
        assert len(own) == own[0].parts == max(1, len(text) // 32 if len(text) >= 64 else 1)


def plain_encoding(text, scores, names, of_byte):
    """Best path over all cuts of a text by a plain dynamic program; of equal sums the last piece that starts first."""
    if not text:
        return []
    # the mark as a character of the text has no piece of its own; here it is one that no piece holds
    symbols = "▁" + text.replace("▁", "\ud800").replace(" ", "▁")
    longest, unknown = max(map(len, scores)), min(scores.values()) - 10
    best, came = [0] + [None] * len(symbols), [0] * (len(symbols) + 1)
    for j in range(1, len(symbols) + 1):
        for i in range(max(0, j - longest), j):
            score = scores.get(symbols[i:j], unknown if j == i + 1 else None)
            if score is not None and (best[j] is None or best[i] + score > best[j]):
                best[j], came[j] = best[i] + score, i
    ids, j = [], len(symbols)
    while j:
        piece = symbols[came[j]:j]
        ids[:0] = [names[piece]] if piece in names else [of_byte[b] for b in piece.replace("\ud800", "▁").encode()]
        j = came[j]
    return ids


@pytest.fixture(scope="module")
def pieces_of_file():
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=segmentation.MODEL)
    scores, names, of_byte = {}, {}, {}
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            of_byte[int(piece[1:-1], 16)] = i
        elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
            scores[piece], names[piece] = max(int(processor.get_score(i)), int(segmentation.FLOOR)), i
    return scores, names, of_byte


@pytest.mark.parametrize("chunk", [1 << 15, 64])
def test_ids_are_those_of_a_plain_dynamic_program(spark, pieces_of_file, chunk):
    rng = random.Random(9)
    odd = ["", " ", "  a", "▁", "a▁ b", "漢字 é", "\n\n", "x" * 300, " " * 200, "".join(rng.choice(["the", "ing", " ", "  ", "\n", "é", "▁", "漢", "er"]) for _ in range(400))]
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    docs = list(enumerate(odd + texts))
    rows = segmentation.encoded(spark.createDataFrame(docs, "doc_id long, text string"), chunk=chunk).orderBy("doc_id", "part").collect()
    got = {k: [] for k, _ in docs}
    for r in rows:
        got[r.doc_id] += r.ids or []
    assert all(got[k] == plain_encoding(t or "", *pieces_of_file) for k, t in docs)
    assert (len(rows) > len(docs)) == (chunk == 64)


def test_tables_of_ids_are_decoded(spark):
    texts = [(1, "a b" * 100), (1, "a b" * 100), (2, "short"), (2, "short"), (3, ""), (4, None), (None, "no id"), (5, "漢字▁ é\n" * 60), (6, "lost part " * 30)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("parts", F.lit("x"))
    parts = durable(segmentation.report(df, chunk=64), "parts")
    parts = parts.filter("NOT (doc_id = 6 AND part = 1)")
    got = sorted(((r.doc_id, r.text) for r in segmentation.decoded(parts).collect()), key=str)
    assert got == sorted([(k, (None if k == 6 else t or "")) for k, t in texts], key=str)
    assert segmentation.decoded(parts.limit(0)).count() == 0


def test_neighbours_reach_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.nearest(vectors, least=1).collect()
    table = vectors.orderBy("vec_id").toPandas()
    x = np.stack(table["embedding"]).astype(float)
    units, ids = x / np.linalg.norm(x, axis=1, keepdims=True), table["vec_id"].to_numpy()
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, own in found.items():
        score = units @ units[ids == q][0]
        score[ids == q] = -2
        hits += len(own & set(ids[np.argsort(-score, kind="stable")[:5]].tolist()))
    assert len(found) == (ids % 50 == 0).sum() and hits / (5 * len(found)) >= 0.9


@pytest.mark.parametrize("clusters, noise", [(40, 0.1), (400, 0.2)])
def test_neighbours_of_clustered_vectors_over_many_partitions(spark, clusters, noise):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(clusters, 32))
    x = (centres[rng.integers(0, clusters, 5000)] + noise * rng.normal(size=(5000, 32))).astype(np.float32).astype(float)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = neighbours.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), least=1).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 5000, 50):
        score = units @ units[q]
        score[q] = -2
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-score, kind="stable")[:5].tolist()))
    assert hits / 500 >= 0.9


def test_neighbours_ties_and_unusable_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 12)] + [(50, [0.0, 1.0]), (50, [0.0, 1.0]), (51, None), (52, [0.0, 0.0]), (53, [1.0, None]), (54, [float("nan"), 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("entry", F.lit(2))
    got = {}
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4]}
    assert neighbours.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 255, 256, 257, 40_000])
def test_many_matches_of_one_text_are_placed(spark, n):
    text = "é ".join(f"{i:030x}" + (" token: abcdefgh" if i % 5 == 0 else "") for i in range(n))
    row = credentials.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{24,}", text)]
    assert [(x.start, x.end) for x in row.base if x.kind == 2] == want and row.n_hex == n and row.n_assign == -(-n // 5)


def test_linked_credentials(spark):
    secret = "Ab1/" * 10
    far = " w" * 400
    texts = {1: f"user_id = alice01 then {secret} at https://api.example.com", 2: f"user_id = alice01 {far} {secret}", 3: secret, 4: "https://api.example.com", 5: "token=abc", 6: None,
             7: "PASSWORD: 'hunter22' key AKIA" + "Z" * 16 + " " + "0a" * 12}
    rows = {r.doc_id: r for r in credentials.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert [s.split(":")[0] for s in rows[1].spans.split(",")] == ["identifier", "secret", "endpoint"]
    assert [rows[i].spans for i in (2, 3, 4, 5, 6)] == [""] * 5
    assert (rows[7].n_assign, rows[7].n_access, rows[7].n_hex) == (1, 1, 1)


def test_quality_and_toxicity_on_held_out_rows(spark):
    docs, known = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    docs = docs.join(known.select("doc_id"), "doc_id", "left_semi").repartition(8)
    q = quality.judged(docs, known).filter("held_out").join(known, "doc_id").select("predicted", "quality").toPandas()
    assert (q["predicted"] == q["quality"]).mean() > 0.97
    t = toxicity.scored(docs, known).filter("held_out").join(known, "doc_id").select("predicted", "toxic").toPandas()
    assert t[t.toxic == 1].predicted.mean() > 0.8 and t[t.toxic == 0].predicted.mean() < 0.02


def test_disguised_words_are_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000)
    model = toxicity.language_model(docs)
    read = {"1d10t": "idiot", "stuuupid": "stupid", "s.t.u.p.i.d": "stupid", "$tup!d": "stupid", "m0r0n": "moron", "p a t h e t i c": "pathetic", "ïdïot": "idiot"}
    assert {k: toxicity.decode(k, model) for k in read} == read
    restored = toxicity.Restorer(model).restored("You are a s t u p i d 1d10t, really.")
    assert {"stupid", "idiot"} <= set(restored.split())


def test_archives(spark):
    long = "é" * 60
    rows = [(1, "http://b.example.com/x", long), (2, "http://a.example.com/", long), (0, "http://a.example.com/z y", "short"), (3, None, None), (None, "http://c.example.com", long),
            (5, "no address", "short"), (2, "http://a.example.com/", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("key", F.lit(2))
    got = sorted(((r.page_id is None, r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in archive.archived(pages).collect()), key=str)
    want = [(False, 0, "response", None, 5), (False, 1, "response", None, 120), (False, 2, "revisit", 1, 120), (False, 2, "revisit", 1, 120), (False, 3, "response", None, 0),
            (False, 5, "response", None, 5), (True, None, "revisit", 1, 120)]
    assert got == sorted(want, key=str)
    assert archive.archived(pages.limit(0)).count() == 0


def test_mix_comes_near_its_targets(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixture.decisions(rows.withColumn("source", F.when(F.col("source") < "src15", "big").otherwise(F.col("source"))))
    per = rows.groupBy("target", "source_size").agg(F.sum("taken").alias("t"), F.max("size").alias("m"), F.first("source_size").alias("s")).collect()
    assert all(abs(r.t - r.target) <= r.m for r in per) and all(r.target <= 3 * r.s for r in per)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql_twins(spark, name):
    from compare import compare, connect

    n, problem = compare(spark, connect(FOLDER), FOLDER, name, catalog.QUERIES[name], catalog.SQL[name])
    assert n and problem == ""


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = Scratch(spark).keep(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == columns and docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.filter("part = 0").count() == docs.count() and last.filter("not exact").count() == 0

def test_common_lines_count_copies_by_their_id(spark):
    text = "\n".join(prose(900 + k, 12) for k in range(6))
    rows = [(i, text, "a") for i in range(30)] + [(100 + i, text, "b") for i in range(20)] + [(None, text, "c")] * 30
    got = {(r.doc_id, r.n_removed, r.kept) for r in line_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == {(0, 0, True), (None, 0, True)} | {(i, 72, False) for i in range(1, 30)} | {(100 + i, 0, True) for i in range(20)}


def test_recurring_lines_by_id_and_word_for_word(spark):
    copied, twice, single = ["\n".join(prose(950 + k, 9) for k in range(2)), prose(960, 7), prose(961, 60)]
    numbered = [f"{prose(970, 6)} no {k}" for k in range(8)]
    rows = [(i, copied) for i in range(6)] + [(10, twice + "\n" + prose(962, 9)), (11, prose(963, 9) + "\n" + twice), (12, single)]
    rows += [(20 + i, f"next page\n{prose(980 + i, 9)}") for i in range(5)] + [(30 + i, f"go on\n{prose(990 + i, 9)}\n{numbered[i]}") for i in range(4)]
    rows += [(None, copied), (None, "next page")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_dropped) for r in line_templates.report(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(False, 0, 0)] + [(False, i, 2) for i in range(1, 6)] + [(False, 10, 0), (False, 11, 1), (False, 12, 0), (False, 20, 0)] + [(False, 20 + i, 1) for i in range(1, 5)]
    assert got == want + [(False, 30 + i, 0) for i in range(4)] + [(True, 0, 1), (True, 0, 2)]


def test_disguised_words_are_selected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000)
    restorer = toxicity.Restorer(toxicity.language_model(docs))
    seen = []
    restorer.read = lambda noisy, read=restorer.read: (seen.append(noisy), read(noisy))[1]
    for text in ["idi07", '"idio7."', "idiot5,", "worthle$$", "worthle55", "sh!+", "stuupiidd", "iddiioott", "s/t/u/p/i/d", "s,t,u,p,i,d", "s\tt\tu\tp\ti\td", "s\nt\nu\np\ni\nd",
                 "s   t   u   p   i   d", "b a d"]:
        seen.clear()
        restorer.restored(f"You are {text} really")
        assert seen, text
    read = {"idi07": "idiot", '"idio7."': "idiot", "s/t/u/p/i/d": "stupid", "s\tt\tu\tp\ti\td": "stupid", "s   t   u   p   i   d": "stupid"}
    assert {k: w for k, w in read.items() if w not in restorer.restored(f"so {k} really").split()} == {}


def test_long_words_are_read_in_time(spark):
    import string
    import time

    model = toxicity.language_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000))
    rng = random.Random(1)
    words = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(1_000_000)), " ".join(rng.choice("acgt") for _ in range(400_000)),
             "a" + "." * 1_000_000 + "a", "ab" * 500_000, "0a1b2c" * 100_000]
    for word in words:
        start = time.process_time()
        assert toxicity.Restorer(model).restored(word).startswith(word.lower())
        assert time.process_time() - start < 10


def plain_reading(noisy, model):
    """Cheapest of all ways through the lattice, by trying every one."""
    from itertools import groupby, product

    best = None
    for way in product(*[toxicity.choices(sign, len(list(run))) for sign, run in groupby(noisy)]):
        cost, at = 0.0, 0
        for letters, extra in [*way, (" ", 0.0)]:
            cost += extra
            for c in letters:
                code = toxicity._code(c)
                if code or at % toxicity.LETTERS:
                    cost += float(model[at * toxicity.LETTERS + code])
                    at = (at * toxicity.LETTERS + code) % toxicity.LETTERS**3
        written = "".join(letters for letters, _ in way).strip()
        best = min(best, (round(cost, 6), written)) if best else (round(cost, 6), written)
    return best


def test_readings_against_all_ways(spark, monkeypatch):
    model = toxicity.language_model(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000))
    monkeypatch.setattr(toxicity.Channel, "SETTLE", 2)  # settle often, so that short words go through it
    rng = random.Random(8)
    channel = toxicity.Channel(model)
    for _ in range(400):
        noisy = "".join(rng.choice("abcdeiostt0134578@$!. -") * rng.choice((1, 1, 1, 2, 3)) for _ in range(rng.randint(1, 8)))
        assert channel.decode(noisy) == plain_reading(noisy, model)[1], noisy


COPIES = [(i, "\n".join(prose(700 + k, 12) for k in range(6)), "a") for i in range(30)] + [(100 + i, "\n".join(prose(720 + k, 9) for k in range(3)) + f"\nown {prose(730 + i, 5)}", "b") for i in range(4)]
COPIES += [(None, "\n".join(prose(700 + k, 12) for k in range(6)), "a"), (200, "next page\nx", "b"), (201, None, "b"), (202, "", None)] + [(210 + i, f"next page\n{prose(740 + i, 60)} no {i}", "c") for i in range(6)]


@pytest.mark.parametrize("name, made", [("op2_line_templates", line_templates.report), ("op8_line_frequency_rules", line_rules.judged)])
def test_sql_twins_count_copies_by_their_id(spark, name, made):
    import pandas as pd
    from compare import rows_of

    rows = [r for r in COPIES if name != "op2_line_templates" or r[0] is not None]  # the twin joins its counts by id
    con = duckdb.connect()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    con.register("documents", documents)
    cur = con.execute(catalog.SQL[name])
    got = made(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if name == "op8_line_frequency_rules":  # null ids do not meet in the twin's joins
        want, rows_ = [r for r in want if "∅" not in r], [tuple(r) for r in got.filter("doc_id is not null").collect()]
    else:
        rows_ = [tuple(r) for r in got.collect()]
    assert rows_of(got.columns, rows_) == want


def test_near_copies_are_kept_for_the_next_stage(spark):
    lines = [prose(800 + k, 12) for k in range(8)]
    license_ = prose(850, 60)

    def changed(n, seed):
        own = [line.split() for line in lines]
        for k in range(n):
            own[k % 8][5] = "".join(chr(97 + (seed * 8 + k) // 26**p % 26) for p in range(4))
        return "\n".join(" ".join(w) for w in own)

    rows = [(1, f"{license_}\n" + "\n".join(lines)), (2, f"{license_}\n" + changed(1, 1)), (3, f"{license_}\n" + changed(2, 2)), (4, f"{license_}\n{prose(870, 50)}"),
            (5, f"{license_}\n{prose(871, 200)}"), (6, "\n".join(lines[:4]) + f"\n{prose(872, 90)}"), (0, f"{license_}\n{prose(873, 80)}")]
    rows += [(100 + i, changed(1, 20 + i)) for i in range(700)]  # a hot partner
    left = {r.doc_id: r.text for r in line_templates.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert left[0] == texts[0] and left[1] == "\n".join(lines) and left[4] == prose(870, 50) and left[5] == prose(871, 200) and left[6] == prose(872, 90)
    # copies lose what the document that they copy has lost, and nothing else
    assert left[2] == changed(1, 1) and left[3] == changed(2, 2) and all(left[100 + i] == changed(1, 20 + i) for i in range(700))
    kept = near_dupes.deduplicated(spark.createDataFrame(list(left.items()), "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == {0, 1, 4, 5, 6}
