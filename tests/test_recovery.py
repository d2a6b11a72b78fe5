"""Coverage by ranges, order-free sums, verdicts and refusals beside plain Python."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_delivery import finals

from siftline.operators import delivery, placement, recovery

PLACED = "tab string, row int, values array<string>"


def plain_coverage(placed, tabs):
    values = {}
    for tab, row, v in placed:
        values.setdefault((tab, row), set()).add(tuple(v))
    out = {(tab, row, "missing") for tab, n in tabs for row in range(2, n + 2) if (tab, row) not in values}
    sizes = dict(tabs)
    for (tab, row), seen in values.items():
        if tab not in sizes or not 2 <= row <= sizes[tab] + 1:
            out.add((tab, row, "outside"))
        elif len(seen) > 1:
            out.add((tab, row, "conflicting"))
    return out


@pytest.mark.parametrize("seed, block", [(1, 4096), (2, 4), (3, 7)])
def test_coverage_is_the_plain_one(spark, monkeypatch, seed, block):
    monkeypatch.setattr(recovery, "BLOCK", block)
    rng = random.Random(seed)
    placed = [(f"T{rng.randint(1, 4)}", rng.randint(0, 40), [rng.choice("aab")]) for _ in range(120)]
    tabs = [("T1", 30), ("T2", 0), ("T3", 39), ("T5", 3)]
    items, sizes = spark.createDataFrame(placed, PLACED), spark.createDataFrame(tabs, "tab string, rows long")
    want = plain_coverage(placed, tabs)
    rows = recovery.coverage(items, sizes).collect()
    assert len(rows) == len(want) and {(r.tab, r.row, r.problem) for r in rows} == want
    counts = {r.tab: r.missing for r in recovery.missing_per_tab(recovery.coverage_ranges(items, sizes)).collect()}
    assert counts == Counter(tab for tab, _, p in want if p == "missing")


def test_a_large_tab_is_one_range(spark):
    items = spark.createDataFrame([("T1", 2, ["a"])], PLACED)
    sizes = spark.createDataFrame([("T1", 10**12), ("T2", 10**12)], "tab string, rows long")
    out = {(r.tab, r.problem, r.first, r.last) for r in recovery.coverage_ranges(items, sizes).select("tab", "problem", F.col("first"), F.col("last")).collect()}
    assert out == {("T1", "missing", 3, 10**12 + 1), ("T2", "missing", 2, 10**12 + 1)}
    assert recovery.coverage_ranges(items.limit(0), sizes.limit(0)).count() == 0


def test_multisets_are_compared_by_sums(spark):
    schema = "batch_id string, lead_id long, tab string, row int"
    left = [("a", 1, "T", 2), ("a", 1, "T", 2), ("a", 2, "T", 3), ("b", 3, "T", 4), ("c", 4, None, 5), ("d", 6, "T", 7)]
    right = [("a", 2, "T", 3), ("a", 1, "T", 2), ("b", 3, "T", 4), ("c", 4, "", 5), ("e", 6, "T", 7), ("e", 6, "T", 7)]
    l, r = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    want = [(*k, "delivered") for k in (Counter(left) - Counter(right)).elements()] + [(*k, "expected") for k in (Counter(right) - Counter(left)).elements()]
    got = delivery.placement_mismatches(l, r).select("batch_id", "lead_id", "tab", "row", "missing_in").collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert {x.batch_id for x in delivery.differing_batches(l, r).collect()} == {"a", "c", "d", "e"}
    assert delivery.differing_batches(l, l.orderBy(F.desc("row"))).count() == 0
    assert delivery.placement_mismatches(l.limit(0), r.limit(0)).count() == 0


def test_every_verdict(spark):
    names = ["export_batch_not_found", "acknowledgement_conflict", "replayed", "export_receipt_mismatch", "export_placement_mismatch", "export_pending_data_missing", "acknowledged"]
    expected = spark.createDataFrame([(n, i * 10 + k, "T", i * 10 + k) for i, n in enumerate(names) for k in (1, 2)], "batch_id string, lead_id long, tab string, row int")
    moved = F.when((F.col("batch_id") == names[4]) & (F.col("row") % 10 == 1), F.col("row") + 5).otherwise(F.col("row"))
    done = F.col("batch_id").isin(names[1], names[2])
    x = F.lit("x")
    base = expected.groupBy("batch_id").agg(F.count(F.lit(1)).alias("count"))
    batches = base.filter(F.col("batch_id") != names[0]).select(
        "batch_id", "count", x.alias("checksum"), x.alias("spreadsheet_id"), x.alias("drive_folder_id"), F.when(done, "ACKNOWLEDGED").otherwise("CLAIMED").alias("status"),
        F.when(F.col("batch_id") == names[1], "other").otherwise("x").alias("ack_digest"))
    receipts = base.select("batch_id", x.alias("checksum"), F.when(F.col("batch_id") == names[3], "y").otherwise("x").alias("drive_checksum"), x.alias("spreadsheet_id"),
                           x.alias("drive_folder_id"), x.alias("digest"))
    kept = expected.filter((F.col("batch_id") != names[5]) | (F.col("row") % 10 == 1)).select(F.col("lead_id").alias("id"))
    out = delivery.acknowledge(batches, expected, receipts, expected.withColumn("row", moved), kept).collect()
    assert {r.batch_id: r.verdict for r in out} == {n: n for n in names} and len(out) == 7


def test_refusals_name_every_reason(spark):
    items = delivery.items(placement.place(finals(spark, ["ann@x", "abe@x", "al@x", "bo@x"]), "alphabetical", 100), "camp")
    env = delivery.envelopes(delivery.batched(items, size=2), "camp", "sheet", "folder", 100).drop("batch_no")
    good = spark.createDataFrame([("VALIDATED_A_001", 3, None), ("VALIDATED_B_001", 1, None)], "tab string, rows int, problem string")
    config = ("sheet", "folder", 100)
    reasons = lambda e=env, s=good, c=config: {(r.reason, r.cases) for r in recovery.refusals(e, s, c).collect()}
    assert reasons() == set()
    plan = recovery.recovery_plan(env, good, config)
    assert {r.batch_id for r in plan["receipts"].collect()} == {r.batch_id for r in env.collect()} and plan["totals"].first().max_lead_id == 4
    first = env.agg(F.min("batch_id")).first()[0]
    changed = env.withColumn("items", F.when(F.col("batch_id") == first, F.transform("items", lambda i: i.withField("values", F.transform(i["values"], lambda v: F.concat(v, F.lit("!"))))))
                             .otherwise(F.col("items")))
    assert reasons(changed) == {("checksum", 1)}
    both = {r for r in reasons(env.unionByName(changed))}
    assert both == {("checksum", 1), ("conflicting_placement", 2)} or both == {("checksum", 1), ("conflicting_placement", 1)}
    assert reasons(env.limit(0)) == {("no_delivery_inputs", 0), ("incomplete_coverage", 3), ("incomplete_coverage", 1)}
    moved = env.withColumn("spreadsheet_id", F.when(F.col("batch_id") == first, "other").otherwise("sheet"))
    assert reasons(moved) == {("mixed_destinations", 2), ("destination_differs_from_configuration", 1)}
    assert reasons(c=("sheet", "folder", 50)) == {("shard_rows_differs_from_configuration", 2)}
    assert reasons(s=good.withColumn("rows", F.lit(2))) == {("placement_outside_sheet", 1), ("incomplete_coverage", 1)}
    stale = spark.createDataFrame([(None, None, "snapshot_not_current")], "tab string, rows int, problem string")
    assert ("snapshot_not_current", 1) in reasons(s=stale)
    with pytest.raises(ValueError, match="checksum"):
        recovery.recovery_plan(changed, good, config)
