"""Streams: key store, run names, state with expiry, restarts."""

import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from siftline.session import fresh_path
from siftline.streaming import ingest, state
from siftline.streaming.keystore import KeyStore


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "key string").withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))


def test_key_store_finds_every_key_and_prunes_parts(spark):
    store = KeyStore(spark, fresh_path(spark, "keys"), parts=64, words=64)
    first, second = [f"record:{i}" for i in range(500)], [f"content:{i}" for i in range(500)]
    store.add(keys(spark, first), "a", 0)
    store.add(keys(spark, second), "a", 1)
    store.add(keys(spark, ["other"]), "b", 0)
    asked = keys(spark, ["record:3", "content:4", "other", "never", None])
    found = lambda run, batch: {r.key for r in store.known(asked, run, batch).collect()}
    assert found("a", 2) == {"record:3", "content:4", "other"} and found("a", 1) == {"record:3", "other"} and found("a", 0) == {"other"} and found("c", 0) == {"record:3", "content:4", "other"}
    assert {r.key for r in store.known(keys(spark, first + second), "c", 0).collect()} == {*first, *second}
    few = store.known(asked, "c", 0)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len({f.split("part=")[1].split("/")[0] for f in few.inputFiles() if "part=" in f}) <= 64
    scanned = store._earlier("keys", "key string, created_at timestamp, run string, batch_id bigint, seg string, part int", None, None)
    parts = [r.part for r in store.possible(asked).select("part").distinct().collect()]
    assert 3 <= len(parts) <= 5 and scanned.filter(F.col("part").isin(parts)).count() < 200


def test_key_store_is_merged_without_losing_who_wrote_what(spark):
    path = fresh_path(spark, "keys")
    store = KeyStore(spark, path, parts=4, words=16)
    for batch in range(4):
        store.add(keys(spark, [f"k{batch}", "again"]), "a", batch)
    assert store.compacted() == 4 and len(ingest.subfolders(spark, f"{path}/keys")) == 1
    asked = keys(spark, ["k0", "k1", "k2", "k3", "again", "x"])
    assert {r.key for r in store.known(asked, "a", 3).collect()} == {"k0", "k1", "k2", "again"}
    assert {r.key for r in store.known(asked, "a", 0).collect()} == set()
    store.add(keys(spark, ["k3", "again"]), "a", 3)  # a repeated batch after the merge
    assert {r.key for r in store.known(asked, "b", 0).collect()} == {"k0", "k1", "k2", "k3", "again"} and store.compacted() == 2
    with pytest.raises(ValueError):
        KeyStore(spark, path, parts=8, words=16)


def numbers(spark, values, path):
    spark.createDataFrame([(v, f"s{v % 2}") for v in values], "lead_id long, tab string").coalesce(1).write.mode("append").parquet(path)
    return ingest.file_stream(spark, path, "lead_id long, tab string", files_per_batch=1)


def test_a_new_checkpoint_under_an_old_name_is_refused(spark):
    path, out = fresh_path(spark, "items"), fresh_path(spark, "delivered")
    stream = numbers(spark, range(5), path)
    first = fresh_path(spark, "checkpoint")
    ingest.run_to_end(state.deliver_stream(stream, out), first)
    stream = numbers(spark, range(5, 9), path)
    with pytest.raises(StreamingQueryException, match="belongs to another checkpoint"):
        ingest.run_to_end(state.deliver_stream(stream, out), fresh_path(spark, "checkpoint"))
    read = lambda: sorted(r.lead_id for r in spark.read.parquet(out).collect())
    assert read() == [0, 1, 2, 3, 4]
    ingest.run_to_end(state.deliver_stream(stream, out, run="other"), fresh_path(spark, "checkpoint"))
    assert read() == list(range(9))
    ingest.run_to_end(state.deliver_stream(stream, out), first)  # the first one goes on; the new items are delivered already
    assert read() == list(range(9))


def test_admission_over_three_batches_and_a_new_checkpoint(spark):
    path, stored, held = (fresh_path(spark, n) for n in ("arrivals", "stored", "keys"))
    schema = "pos long, source string, source_record_id string, identity string, text string"
    texts = ["a b", "c d", "a b", "e f", "c d", "g h", "a b", "i j", "g h"]
    for k in range(3):
        rows = [(i, "s", str(i), "u", texts[i]) for i in range(3 * k, 3 * k + 3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    stream = ingest.file_stream(spark, path, schema, files_per_batch=1)
    checkpoint = fresh_path(spark, "checkpoint")
    options = {"parts": 4, "words": 16, "segments": 2}
    ingest.run_to_end(ingest.ingest(stream, stored, held, run="one", **options), checkpoint)
    with pytest.raises(StreamingQueryException, match="belongs to another checkpoint"):
        ingest.run_to_end(ingest.ingest(stream, stored, held, run="one", **options), fresh_path(spark, "checkpoint"))
    ingest.run_to_end(ingest.ingest(stream, stored, held, **options), fresh_path(spark, "checkpoint"))
    assert sorted(r.pos for r in spark.read.parquet(stored).collect()) == [0, 1, 3, 5, 7]


def test_state_expires_and_late_rows_are_answered(spark):
    path, out, checkpoint = (fresh_path(spark, n) for n in ("checks", "cached", "checkpoint"))
    schema = "email_hash string, seq long, ts timestamp, status string, reason string"

    def run(rows, keep):
        rows = [(h, i, t, "OK", r) for h, i, t, r in rows]
        day = spark.createDataFrame(rows, "email_hash string, seq long, t string, status string, reason string")
        day.withColumn("ts", F.to_timestamp("t")).select(*[c.split()[0] for c in schema.split(", ")]).coalesce(1).write.mode("append").parquet(path)
        stream = state.cached_results(ingest.file_stream(spark, path, schema), keep)
        query = ingest.run_to_end(stream.writeStream.format("parquet").option("path", out), checkpoint, timers=spark)
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run([("a", 1, "2024-01-05", "x"), ("b", 2, "2024-01-05", "y"), ("t", 3, "2024-01-05", "dns_temporary")], 60) == 2
    # late: older than what is held, and answered from it; a result of three days and more is replaced
    assert run([("a", 4, "2024-01-01", "late"), ("b", 5, "2024-01-09", "z"), ("b", 6, "2024-01-10", "w")], 2) == 2
    time.sleep(3)
    assert run([("c", 7, "2024-01-11", "q")], 60) == 1
    assert run([("a", 8, "2024-01-06", "new")], 60) == 2  # forgotten, so checked again
    got = {r.seq: (r.reason, r.reused) for r in spark.read.parquet(out).collect()}
    assert got == {1: ("x", False), 2: ("y", False), 3: ("dns_temporary", False), 4: ("x", True), 5: ("z", False), 6: ("z", True), 7: ("q", False), 8: ("new", False)}


def test_hot_address_is_read_in_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        path = fresh_path(spark, "checks")
        rows = spark.range(400).select(F.lit("a").alias("email_hash"), F.col("id").alias("seq"), F.timestamp_seconds(F.col("id")).alias("ts"), F.lit("OK").alias("status"), F.lit("r").alias("reason"))
        rows.coalesce(1).write.parquet(path)
        out = fresh_path(spark, "cached")
        ingest.run_to_end(state.cached_results(ingest.file_stream(spark, path, rows.schema)).writeStream.format("parquet").option("path", out), fresh_path(spark, "checkpoint"), timers=spark)
        assert {(r.reused, r.n) for r in spark.read.parquet(out).groupBy("reused").agg(F.count("*").alias("n")).collect()} == {(False, 1), (True, 399)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
