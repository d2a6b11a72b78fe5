import random

import pytest
from pyspark.sql import functions as F

from siftline.operators import admission, keys


def fold(rows):
    taken, kept = (set(), set()), []
    for pos, a, b in sorted(rows):
        if a not in taken[0] and b not in taken[1]:
            taken[0].add(a)
            taken[1].add(b)
            kept.append(pos)
    return kept


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "pos long, a string, b string")
    return sorted(r.pos for r in admission.greedy_claims(df, "pos", ["a", "b"], **how).collect())


def test_loser_claims_nothing(spark):
    assert run(spark, [(1, "r1", "c1"), (2, "r1", "c2"), (3, "r3", "c2")]) == [1, 3]


@pytest.mark.parametrize("seed", range(3))
def test_rounds_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    n, span = rng.randrange(2, 60), rng.randrange(2, 14)
    rows = [(i, f"a{rng.randrange(span)}", f"b{rng.randrange(span)}") for i in range(n)]
    assert run(spark, rows, patience=99) == fold(rows)  # rounds only
    assert run(spark, rows, patience=0) == fold(rows)  # chains are contracted in every round
    assert run(spark, rows, patience=1) == fold(rows)


def chain(n, first=0, name=""):
    return [(first + i, f"k{name}{(i + 1) // 2}", f"m{name}{i // 2}") for i in range(n)]


def test_long_alternating_chains(spark):
    rows = chain(10_000)
    rng = random.Random(4)
    for c in range(30):  # shorter ones, some of which hang on others
        rows += chain(rng.randrange(2, 60), 10_000 + 100 * c, f"-{c}-" if c % 3 else "")
    assert run(spark, rows) == fold(rows)
    assert run(spark, chain(12), patience=99) == fold(chain(12))  # link by link


@pytest.mark.parametrize("seed", range(2))
def test_chains_in_reverse_and_shuffled_order(spark, seed):
    rng = random.Random(seed)
    links = [(a, b) for _, a, b in chain(300)]
    order = list(range(300))[::-1] if seed == 0 else rng.sample(range(300), 300)
    rows = [(o, a, b) for o, (a, b) in zip(order, links)]
    assert run(spark, rows, patience=0) == fold(rows) == run(spark, rows)


def test_hot_keys_take_their_own_join(spark, monkeypatch):
    monkeypatch.setattr(keys, "HOT_FLOOR", 3)
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"a{rng.randrange(40)}", "hot" if i % 5 == 0 else f"b{rng.randrange(40)}") for i in range(120)]
    assert run(spark, rows, patience=99) == fold(rows)


def test_rows_after_a_settled_key_are_dropped_at_once(spark, monkeypatch):
    written = []
    keep = admission.durable
    monkeypatch.setattr(admission, "durable", lambda df, name: (written.append((name, df.schema)), keep(df, name))[1])
    # everybody asks for a shared key and then for one of their own, again and again: the first turn of each decides
    rng = random.Random(5)
    asked = [(f"a{rng.randrange(12)}", f"u{rng.randrange(40)}") for _ in range(400)]
    rows = [(2 * i + k, a if k == 0 else f"own-{u}", u) for i, (a, u) in enumerate(asked) for k in (0, 1)]
    assert run(spark, rows) == fold(rows)
    assert sum(name == "marked" for name, _ in written) <= 2
    # claims of finals are ordered by a number, whose least is no sort
    df = spark.createDataFrame([(1, "u", 1.0, 1, 1, [("a@x.org", "")]), (2, "u", 2.0, 1, 1, [])],
                               "candidate_id long, identity_hash string, rank_score double, score int, created_at long, contacts array<struct<email:string,source_url:string>>")
    assert [(r.candidate_id, r.email) for r in admission.finalise(df, spark.createDataFrame([], "key string"), F.lit(False)).collect()] == [(2, None)]
    assert [r.email for r in admission.finalise(df, spark.createDataFrame([], "key string"), F.lit(True)).collect()] == ["a@x.org"]
    assert {s["turn"].dataType.simpleString() for name, s in written if name == "claims"} == {"bigint"}


def test_batches_and_permanent_keys(spark):
    def arrive(batch, claimed):
        rows = spark.createDataFrame([(i, "s", a, t, "u" + a) for i, (a, t) in enumerate(batch)], "pos long, source string, source_record_id string, text string, identity string")
        keyed = admission.with_record_keys(rows)
        verdicts = admission.admit(keyed, claimed)
        stored = admission.stored(keyed, verdicts)
        added = admission.new_keys(stored, F.current_timestamp()).select("key")
        return verdicts.filter("verdict = 'stored'").count(), claimed.unionByName(added)

    n, claimed = arrive([("a", "x"), ("a", "y"), ("b", "x"), ("c", "z")], spark.createDataFrame([], "key string"))
    assert n == 2
    n, claimed = arrive([("c", "new"), ("d", "d")], claimed)
    assert n == 1
    n, _ = arrive([("c", "new"), ("d", "d")], claimed)  # a replay stores nothing
    assert n == 0


def test_known_contacts_need_all_to_be_known(spark):
    c = "array<struct<email:string,source_url:string>>"
    rows = spark.createDataFrame([(1, [("a@x.org", "")]), (2, [("a@x.org", ""), ("b@x.org", "")]), (3, [])], f"pos long, contacts {c}")
    claimed = spark.createDataFrame([("a@x.org",)], "e string").select(F.concat(F.lit("email:"), admission.digest(F.col("e"))).alias("key"))
    out = {r.pos: r.all_known for r in admission.with_known_contacts(rows, claimed, "pos").collect()}
    assert out == {1: True, 2: False, 3: False}


def finals_fold(rows, claimed=()):
    emails, leads, out = set(claimed), set(), {}
    for cid, ident, rank, score, at, contacts in sorted(rows, key=lambda r: (-r[2], -r[3], r[4], r[0])):
        for e in contacts:
            if e not in emails and ident not in leads:
                emails.add(e)
                leads.add(ident)
                out[cid] = e
                break
        else:
            if not contacts and ident not in leads:
                leads.add(ident)
                out[cid] = None
    return out


@pytest.mark.parametrize("seed", range(2))
def test_final_claims_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"u{rng.randrange(12)}", rng.randrange(3) / 2, rng.randrange(3), i // 4, [f"e{rng.randrange(14)}@x.org" for _ in range(rng.randrange(4))]) for i in range(40)]
    df = spark.createDataFrame(rows, "candidate_id long, identity_hash string, rank_score double, score int, created_at long, e array<string>")
    df = df.withColumn("contacts", F.transform("e", lambda e: F.struct(e.alias("email"), F.lit("u").alias("source_url"))))
    out = admission.finalise(df, spark.createDataFrame([], "key string"), F.lit(False))
    assert {r.candidate_id: r.email for r in out.collect()} == finals_fold(rows)


def test_positions_with_a_hot_group(spark):
    rng = random.Random(2)
    ids = rng.sample(range(10_000), 700)
    rows = [(i, "hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}") for i in ids]
    df = spark.createDataFrame(rows, "id long, g string")
    out = {r.id: r.position for r in keys.positions(df, "id", "g", pieces=13).collect()}
    for g in {x[1] for x in rows}:
        assert [out[i] for i in sorted(x[0] for x in rows if x[1] == g)] == list(range(sum(x[1] == g for x in rows)))


def test_positions_of_sparse_ids_are_balanced(spark, monkeypatch):
    ids = [i * 10**9 + i * i for i in range(4000)]
    written = []
    keep = keys.durable
    monkeypatch.setattr(keys, "durable", lambda df, name: (written.append(keep(df, name)), written[-1])[1])
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7).withColumn("_n", F.lit(1)).withColumn("_first", F.lit(2))
    out = {r.id: r.position for r in keys.positions(df, "id", pieces=8).collect()}
    assert [out[i] for i in ids] == list(range(4000))
    sizes = [r["count"] for r in written[0].groupBy(F.shiftright("_pos_at", 33).alias("p")).count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 3 * 4000 / 8
    assert keys.positions(df.limit(0), "id").count() == 0
