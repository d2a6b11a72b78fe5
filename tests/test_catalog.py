"""Derived tables and steps of the driver queries."""

from siftline.catalog.common import Tables


def test_rank_scores_of_finals_round_the_double_and_not_its_decimal(spark, tmp_path):
    rows = [(k, f"Customer#{k}", 0, balance, "AUTOMOBILE") for k, balance in enumerate([8495.0, -9325.0, 8505.0, 8494.0, 125.0, 0.0])]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = {r.candidate_id: r.rank_score for r in Tables(spark, str(tmp_path)).finals.collect()}
    # what DuckDB's round(abs(c_acctbal) / 1000, 2) gives for these balances
    assert got == {0: 8.49, 1: 9.32, 2: 8.51, 3: 8.49, 4: 0.13, 5: 0.0}


def test_folded_texts_travel_in_small_batches(spark):
    from pyspark.sql import functions as F

    from siftline.functions.text import canonical_text

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "10000")
        canonical_text(F.col("text"))
        assert int(spark.conf.get(setting)) <= 1000
        spark.conf.set(setting, "200")
        canonical_text(F.col("text"))
        assert spark.conf.get(setting) == "200"
    finally:
        spark.conf.set(setting, before)


def test_records_of_a_decision_are_scored_once(spark, monkeypatch):
    from siftline.catalog import rules

    scored = []
    monkeypatch.setattr(rules, "_scored", lambda t: scored.append(1) or spark.range(3).selectExpr("id AS pos", "'long' AS text", "struct(id AS score) AS rules"))
    rows = rules._scored_once(None)
    assert rows.columns == ["pos", "rules"] and rows.count() == 3 and len(scored) == 1
    assert len(rows.inputFiles()) > 0


def test_files_of_a_stream_are_bounded_and_its_micro_batches_are_not_more(spark, tmp_path, monkeypatch):
    from siftline.catalog import streams
    from siftline.streaming import ingest

    monkeypatch.setattr(streams, "PART_ROWS", 10)
    rows = spark.range(100)
    path, each = streams._parts(Tables(spark, str(tmp_path)), rows, "bounded", 3)
    held = [r.n for r in spark.read.parquet(path).selectExpr("input_file_name() AS f").groupBy("f").count().withColumnRenamed("count", "n").collect()]
    assert sum(held) == 100 and max(held) <= 12 and each == 4
    seen = []
    stream = ingest.file_stream(spark, path, rows.schema, files_per_batch=each)
    ingest.run_to_end(stream.writeStream.foreachBatch(lambda b, i: seen.append(b.count())), f"{tmp_path}/checkpoint")
    assert len(seen) == 3 and sum(seen) == 100
