import hashlib
import json

import pytest
from pyspark.sql import functions as F

from siftline.functions.values import FIELDS
from siftline.operators import delivery, placement, recovery
from siftline.session import fresh_path
from siftline.sinks import tables
from siftline.sources import deliveries

PROFILE = "struct<display_name:string,first_name:string,name_reliable:boolean,name_source:string,username:string,business_name:string,geography:struct<excerpt:string,source_url:string>>"


def finals(spark, emails, first=1):
    rows = [(i, e, f"s{i}", "café \"x\" / \\  ", 0 if i % 2 else 7, 6.5, "DELIVERABLE_DOMAIN" if e else "NO_EMAIL", ("n", "Thandi", True, "operator_verified", "", "", None))
            for i, e in enumerate(emails, first)]
    df = spark.createDataFrame(rows, f"id long, email string, source string, excerpt string, score int, rank_score double, validation_status string, profile {PROFILE}")
    return df.withColumns({"source_url": F.lit("https://x.example.org/"), "email_source_url": F.lit(""), "product_type": F.lit("MOTOR"), "created_at": F.timestamp_seconds(F.lit(1704067200))})


def test_placement_goes_on_after_the_durable_positions(spark):
    first = placement.place(finals(spark, ["ann@x", "abe@x", "9@x", "zed@x", "bo@x", "al@x"]), "alphabetical", 2)
    out = {r.email: (r.tab, r.row) for r in first.collect()}
    assert out == {"ann@x": ("VALIDATED_A_001", 2), "abe@x": ("VALIDATED_A_001", 3), "al@x": ("VALIDATED_A_002", 2), "9@x": ("VALIDATED_OTHER_001", 2),
                   "zed@x": ("VALIDATED_Z_001", 2), "bo@x": ("VALIDATED_B_001", 2)}
    starts = placement.next_starts(first)
    again = placement.place(finals(spark, ["amy@x", "_q@x"], 7), "alphabetical", 2, starts)
    assert {r.email: (r.tab, r.row) for r in again.collect()} == {"amy@x": ("VALIDATED_A_002", 3), "_q@x": ("VALIDATED_OTHER_001", 3)}
    assert {r.bucket: r.start for r in placement.next_starts(again).collect()} == {"A": 4, "OTHER": 2}


@pytest.mark.parametrize("groups, tabs", [([(f"g{i}", 100_000 // 27 + (i < 100_000 % 27)) for i in range(27)], 27), ([("A", 60_000), ("B", 40_000)], 20)])
def test_capacity(spark, groups, tabs):
    row = placement.capacity_plan(spark.createDataFrame(groups, "bucket string, rows long"), 5000).first()
    assert row.tabs == tabs and row.delivery_cells == (100_000 + tabs) * 17 and row.within_limit


def test_envelope_checksum_is_the_agreed_serialisation(spark):
    items = delivery.items(placement.place(finals(spark, ["ann@x", None, "bo@x"]), "alphabetical", 100), "camp")
    env = delivery.envelopes(delivery.batched(items), "camp", "sheet", "folder", 100)
    row = env.first()
    plain = [{"lead_id": i.lead_id, "tab": i.tab, "row": i.row, "values": list(i["values"])} for i in row["items"]]
    text = json.dumps(plain, ensure_ascii=False, separators=(",", ":"))
    assert row.checksum == hashlib.sha256(text.encode()).hexdigest()
    assert plain[0]["values"][FIELDS.index("score")] == "" and plain[1]["values"][FIELDS.index("score")] == "7"
    path = fresh_path(spark, "env")
    env.drop("count", "qualified_count").write.option("maxRecordsPerFile", 1).json(path)
    back = deliveries.read_envelopes(spark, f"{path}/*.json")
    assert delivery.envelope_reasons(back).first().reason is None
    bad = back.withColumn("items", F.transform("items", lambda i: i.withField("row", i["row"] + 1)))
    assert delivery.envelope_reasons(bad).first().reason == "checksum"


def test_coverage_names_each_problem(spark):
    items = delivery.items(placement.place(finals(spark, ["ann@x", "abe@x", "al@x"]), "alphabetical", 100), "camp")
    twice = items.unionByName(items.filter("row = 2").withColumn("values", F.transform("values", lambda v: F.concat(v, F.lit("!")))))
    tabs = spark.createDataFrame([("VALIDATED_A_001", 4)], "tab string, rows int")
    out = {(r.row, r.problem) for r in recovery.coverage(twice, tabs).collect()}
    assert out == {(2, "conflicting"), (5, "missing")}
    short = spark.createDataFrame([("VALIDATED_A_001", 2)], "tab string, rows int")
    assert [(r.row, r.problem) for r in recovery.coverage(items, short).collect()] == [(4, "outside")]


def test_snapshot_problems(spark):
    good = {"spreadsheet_sha256": hashlib.sha256(b"sheet").hexdigest(), "captured_at": "2024-01-01T12:00:00Z", "tabs": {"VALIDATED_A_001": 3, "NOTES": 9, "PROSPECTS_001": 0}}
    problem = lambda when, **change: [(r.tab, r.problem) for r in deliveries.snapshot_tabs(
        spark.createDataFrame([(json.dumps({**good, **change}),)], "body string"), "sheet", F.lit(when).cast("timestamp")).collect()]
    assert problem("2024-01-01 12:20:00") == [("VALIDATED_A_001", None)]
    assert problem("2024-01-01 12:31:00")[0][1] == "snapshot_not_current"
    assert problem("2024-01-01 11:54:00")[0][1] == "snapshot_not_current"
    assert problem("2024-01-01 12:20:00", spreadsheet_sha256="x")[0][1] == "snapshot_destination_mismatch"
    assert problem("2024-01-01 12:20:00", captured_at="soon")[0][1] == "snapshot_time_invalid"


def test_csv_dialects_and_guards(spark):
    rows = spark.createDataFrame([("a", "=1", None), ('q"t', "x,y", "\tz")], "a string, b string, c string")
    path = fresh_path(spark, "csv")
    tables.write_csv(rows.coalesce(1), ["a", "b", "c"], path)
    from pathlib import Path

    text = next(Path(path).glob("part-*.csv")).read_bytes().decode()
    assert text.startswith("a,b,c\r\na,'=1,\r\n") and '"q""t","x,y",\'\tz\r\n' in text
    lines = rows.select(tables.quoted_line(F.array("a", "b", "c")).alias("v")).collect()
    assert lines[1].v == '"q""t","x,y","\'\tz"'
    with pytest.raises(ValueError):
        tables.replace_report([rows], "VALIDATED_A_001", path)


def test_backup_refuses_gaps(spark):
    items = delivery.items(placement.place(finals(spark, ["ann@x"]), "alphabetical", 100), "camp")
    gap = items.withColumn("values", F.transform("values", lambda v, i: F.when(i == 0, "").otherwise(v)))
    with pytest.raises(ValueError):
        tables.write_backup(gap, fresh_path(spark, "backup"))


def test_keyset_pages(spark):
    df = spark.range(1, 11)
    page, through, after = tables.page_after(df, 0, None, 4)
    assert [r.id for r in page.collect()] == [1, 2, 3, 4] and (through, after) == (10, 4)
    page, _, after = tables.page_after(df, 8, 10, 4)
    assert [r.id for r in page.collect()] == [9, 10] and after is None
