"""STR-1..STR-5, STR-14: file streams through the same transforms as the batch jobs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from siftline.functions.text import matching_text
from siftline.operators.admission import admit, new_keys, stored, with_record_keys
from siftline.operators.matching import discovery_match
from siftline.operators.ranking import rank_route
from siftline.operators.scoring import rules_result
from siftline.session import fresh_path
from siftline.streaming.keystore import KeyStore
from siftline.streaming.runs import removed, run_folder, subfolders


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None,
                only: str | None = None) -> DataFrame:
    """STR-14: stream over files with an explicit schema and a limit per micro-batch; the checkpoint is the cursor."""
    reader = spark.readStream.schema(schema).format(fmt)
    if only:
        reader = reader.option("pathGlobFilter", only)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_to_end(writer, checkpoint: str, timers: SparkSession | None = None) -> StreamingQuery:
    """Process everything there is, in limited batches, and stop.

    State with timers of processing time asks for one more batch without end.  ``timers`` names the session of such a stream:
    empty batches are off while it starts, and timers fire with the batches that bring rows.
    """
    before = timers.conf.get(IDLE) if timers else None
    if timers:
        timers.conf.set(IDLE, "false")
    try:
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if timers:
            timers.conf.set(IDLE, before)
    query.awaitTermination()
    return query


def deduplicated(stream: DataFrame, keys: list[str], ts: str, overlap: str) -> DataFrame:
    """STR-2: rows that are read again within the overlap are dropped; state older than it is released."""
    return stream.withWatermark(ts, overlap).dropDuplicatesWithinWatermark(keys)


def within_age(stream: DataFrame, ts: str, as_of: Column, max_days: int) -> DataFrame:
    """STR-3: watermark for state, and the plain age test for every row."""
    age = (F.unix_micros(as_of) - F.unix_micros(ts)) / 86_400e6
    return stream.withWatermark(ts, f"{max_days} days").filter(age.between(-1, max_days))


def daily_counts(stream: DataFrame, ts: str = "ts", late: str | None = None) -> DataFrame:
    """STR-5: running daily counters (update mode).  Without ``late`` every amount counts, however late, and state is kept."""
    day = F.window(ts, "1 day")
    rows = (stream.withWatermark(ts, late) if late else stream).groupBy(day.alias("w"), "source", "name").agg(F.sum("amount").alias("value"))
    return rows.select(F.to_date("w.start").alias("day"), "source", "name", "value")


def write_updates(stream: DataFrame, path: str, run: str = "updates"):
    """Update-mode writer: the changed rows of a micro-batch go to a folder of its run and batch id."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{run_folder(batch, path, run, batch_id)}")

    return stream.writeStream.outputMode("update").foreachBatch(each)


def latest_updates(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Newest state per key from the folders of the one run of :func:`write_updates`."""
    rows = spark.read.schema(schema + ", run string, batch_id bigint").parquet(path)
    values = [c for c in rows.columns if c not in keys and c not in ("run", "batch_id")]
    newest = F.max_by(F.struct(*values), F.col("batch_id")).alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def scored_stream(records: DataFrame, book, as_of: Column) -> DataFrame:
    """STR-4: filter, match, score, rank and route; stateless, so it runs on a stream unchanged."""
    kept = records.filter(discovery_match(matching_text(F.col("text")), book))
    scored = rules_result(kept, book, as_of, bio="bio" if "bio" in records.columns else None)
    return scored.withColumn("ranking", rank_route(F.col("rules"), F.lit(False), book.policy))


def ingest(stream: DataFrame, records_path: str, keys_path: str, order: str = "pos", run: str | None = None, as_of: Column | None = None,
           parts: int = 256, words: int = 1024, segments: int = 64):
    """STR-1: writer that admits every micro-batch against the key store and stores rows and keys.

    Rows, then keys, go to the folder of the run and the batch id.  A batch that is run again after a failure replaces
    what it wrote and never reads its own keys, so it stores the same rows once.  A run is named after its stream unless
    ``run`` names it; a new checkpoint under an old name is refused.  ``as_of`` dates the keys; without it they carry the
    start of the writer.  The store is compacted when it has ``segments`` of them.
    """
    stamp = as_of if as_of is not None else F.lit(datetime.now(timezone.utc))

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = run_folder(batch, records_path, run, batch_id)
        name = folder.split("/")[0].removeprefix("run=")
        store = KeyStore(spark, keys_path, parts, words)
        arrived = fresh_path(spark, "arrived")
        with_record_keys(batch).write.parquet(arrived)
        keyed = spark.read.parquet(arrived)
        earlier = store.known(keyed.select(F.explode(F.array("record_key", "content_key")).alias("key")), name, batch_id)
        rows = stored(keyed, admit(keyed, earlier, order), order)
        rows.write.mode("overwrite").parquet(f"{records_path}/{folder}")
        kept = spark.read.schema(rows.schema).parquet(f"{records_path}/{folder}")
        store.add(new_keys(kept, stamp), name, batch_id)
        if len(subfolders(spark, f"{keys_path}/keys")) >= segments:
            store.compacted()
        removed(spark, arrived)

    return stream.writeStream.foreachBatch(each)
