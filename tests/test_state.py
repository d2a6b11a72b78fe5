import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siftline.operators import samples, timelines
from siftline.session import durable

START = datetime(2024, 1, 1, 12)


def sample_fold(rows, cap):
    held = {}
    for pos, source, level in sorted(rows):
        mine = held.setdefault(source, [])
        if len(mine) >= cap:
            weakest = min(mine, key=lambda r: (r[1], r[0]))
            if weakest[1] >= level:
                continue
            mine.remove(weakest)
        mine.append((pos, level))
    return sorted(p for mine in held.values() for p, _ in mine)


def sample_fold_with_repeats(batches, cap):
    """One source: held rows in place, captures of a batch merged by record first."""
    held = {}
    for batch in batches:
        merged = {}
        for pos, record, level, outcome in batch:
            first = merged.setdefault(record if record is not None else ("none", pos), [pos, level, outcome])
            first[1], first[2] = max(first[1], level), outcome
        for record, (_, level, outcome) in merged.items():
            if record in held and not isinstance(record, tuple):
                held[record][1], held[record][2] = max(held[record][1], level), outcome
        for record, row in merged.items():
            if record in held:
                continue
            if len(held) >= cap:
                weakest = min(held, key=lambda r: (held[r][1], held[r][0]))
                if held[weakest][1] >= row[1]:
                    continue
                del held[weakest]
            held[record] = list(row)
    return sorted(tuple(r) for r in held.values())


@pytest.mark.parametrize("seed", range(3))
def test_repeated_captures_update_the_row_that_is_held(spark, seed):
    rng = random.Random(seed)
    rows = [(pos, rng.choice([None, *range(14)]) if pos % 2 else rng.randrange(14), rng.randint(0, 4), f"o{pos}") for pos in range(60)]
    schema = "source string, pos long, record int, priority int, outcome string"
    batches = [rows[:20], rows[20:40], rows[40:]]
    held = None
    for i, batch in enumerate(batches):
        df = spark.createDataFrame([("s", pos, record, level, outcome) for pos, record, level, outcome in batch], schema)
        held = durable(samples.bounded_sample(df, 6, held=held, record="record", latest=("outcome",)), "held")
        assert sorted((r.pos, r.priority, r.outcome) for r in held.collect()) == sample_fold_with_repeats(batches[:i + 1], 6)


@pytest.mark.parametrize("seed", range(3))
def test_bounded_sample_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("aab"), rng.randrange(5)) for i in range(90)]
    df = spark.createDataFrame(rows, "pos long, source string, priority int")
    for cap in (1, 7, 200):
        assert sorted(r.pos for r in samples.bounded_sample(df, cap).collect()) == sample_fold(rows, cap)
    # in two steps, the second one knowing only the sample of the first
    held = samples.bounded_sample(df.filter("pos < 40"), 7)
    assert sorted(r.pos for r in samples.bounded_sample(df.filter("pos >= 40"), 7, held=held).collect()) == sample_fold(rows, 7)


def series(spark, marks, step=600):
    rows = [("k", i, START + timedelta(seconds=i * step), m) for i, m in enumerate(marks)]
    return spark.createDataFrame(rows, "k string, i long, ts timestamp, m string")


def test_switch_after_runs_in_a_row(spark):
    marks = "uhuhu" + "uuu" + "hh" + "h" + "?" + "hh" + "u?u?u"
    df = series(spark, marks)
    bad = F.when(F.col("m") != "?", F.col("m") == "u")
    for pieces in (1, 3, 16):
        out = [r["mode"] for r in timelines.streak_state(df, "k", ["ts"], "ts", bad, 3, 3, pieces=pieces).orderBy("i").collect()]
        mode, b, g, want = "cloud", 0, 0, []
        for m in marks:
            if m != "?":
                b, g = (b + 1, 0) if m == "u" else (0, g + 1)
                mode = "device" if mode == "cloud" and b >= 3 else "cloud" if mode == "device" and g >= 3 else mode
            want.append(mode)
        assert out == want


def test_hysteresis_and_rolling_totals_do_not_depend_on_chunks(spark):
    rng = random.Random(11)
    rows = [("ab"[i % 2], i, START + timedelta(seconds=rng.randrange(0, 20_000)), rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i long, ts timestamp, v double")
    with pytest.raises(ValueError):
        timelines.hysteresis(df, "k", "ts", "v", 0.2, 0.2)
    on = [{r.i: r.d for r in timelines.hysteresis(df, "k", "ts", "v", 0.8, 0.3, "d", pieces=c).collect()} for c in (9, 1)]
    assert on[0] == on[1]
    small = {r.i: r.n for r in timelines.rolling_minute(df, "k", "ts", {"n": F.lit(1)}, chunk_seconds=61).collect()}
    want = {i: sum(k2 == k and t - timedelta(seconds=60) < t2 <= t for k2, _, t2, _ in rows) for k, i, t, _ in rows}
    assert small == want


def test_rolling_totals_of_a_dense_minute_are_not_added_again_for_every_row(spark):
    log = spark.range(120_000).selectExpr("id", "'k' AS k", "timestamp_micros(1704067200000000 + id * 400) AS ts", "if(id % 3 = 0, NULL, id) AS v", "id / 2 AS half")
    whole = {"n": F.lit(1), "total": F.col("v")}
    out = timelines.rolling_minute(log, "k", "ts", whole)
    # the frame that begins at an offset is what adds a minute again for each of its rows
    assert "-59999999" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.filter("id IN (0, 1, 7, 119999)").collect():
        seen = [v for v in range(max(0, r.id - 149_999), r.id + 1)]
        assert r.n == len(seen) and r.total == (sum(v for v in seen if v % 3) or None)
    # amounts whose differences are not exact, and rows that leave the interval
    few = log.filter("id < 40").withColumn("ts", F.timestamp_micros(1704067200000000 + F.col("id") * 7_000_000))
    for r in timelines.rolling_minute(few, "k", "ts", {**whole, "h": F.col("half")}, chunk_seconds=61).collect():
        seen = range(max(0, r.id - 8), r.id + 1)
        assert (r.n, r.total, r.h) == (len(seen), sum(v for v in seen if v % 3) or None, sum(v / 2 for v in seen))


def test_erasure_and_updates(spark):
    df = spark.createDataFrame([("a", "1", 1, "candidate", 2, {"n": "1"}), ("a", "2", 2, "rejected", 0, {}), ("b", "1", 3, "candidate", 2, {})],
                               "source string, source_record_id string, candidate_id long, outcome string, priority int, detail map<string,string>")
    assert samples.erase(df, "a", "1").count() == 2 and samples.erase(df, "a").count() == 1
    late = spark.createDataFrame([(1, "final", {"n": "2"}), (3, None, {"x": "y"})], "candidate_id long, outcome string, detail map<string,string>")
    out = {r.candidate_id: (r.outcome, r.priority, r.detail) for r in samples.update_samples(df, late).collect()}
    assert out == {1: ("final", 4, {"n": "2"}), 2: ("rejected", 0, {}), 3: ("candidate", 2, {"x": "y"})}


def streak_fold(rows, to_bad, to_good):
    """Plain pass over (key, order, code, forced): runs, last event and where it was."""
    state, out = {}, {}
    for key, i, code, forced in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        b, g, kind, at = state.get(key, (0, 0, None, None))
        if code == 1:
            b, g = b + 1, 0
            if b >= to_bad or forced:
                kind, at = 1, i
        elif code == 0:
            b, g = 0, g + 1
            if to_good and g >= to_good:
                kind, at = 0, i
        state[key] = out[i] = (b, g, kind, at)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_segmented_scan_equals_the_fold(spark, seed):
    from siftline.operators.scans import streaks

    rng = random.Random(seed)
    stay = rng.choice([0.5, 0.9, 0.99])
    rows, code = [], 0
    for i in range(600):
        code = code if rng.random() < stay else rng.choice([0, 1, None])
        rows.append(("hot" if rng.random() < 0.7 else rng.choice(["a", "b", "z", None]), i, code, rng.random() < 0.03))
    df = spark.createDataFrame(rows, "k string, i long, code int, f boolean")
    to_bad, to_good = rng.choice([(1, 1), (3, 2), (40, None), (7, 60)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        for pieces in (1, 5, 40):
            done = streaks(df, "k", ["i"], F.col("code"), to_bad, to_good, forced=F.col("f"), payload=F.col("i"), pieces=pieces)
            assert {r.i: (r.bad_run, r.good_run, r.event, r.event_at) for r in done.collect()} == streak_fold(rows, to_bad, to_good)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert streaks(df.limit(0), "k", ["i"], F.col("code")).count() == 0


def test_scan_has_one_shuffle_of_rows(spark, monkeypatch):
    from siftline.operators import scans

    plans = []
    keep = scans.durable
    monkeypatch.setattr(scans, "durable", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), keep(df, name))[1])
    df = series(spark, "uhuhuhhuuu")
    out = timelines.streak_state(df, "k", ["ts"], "ts", F.col("m") == "u", 3, 3)
    after = out._jdf.queryExecution().executedPlan().toString()
    assert plans[0].count("Exchange") == 1 and "rangepartitioning" in plans[0] and "Window" not in plans[0] + after
    assert after.count("Exchange hashpartitioning") == 0 and after.count("BroadcastExchange") <= 1
