"""Driver queries for streams (STR): every one runs a file stream over the given tables to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog.common import AS_OF, book, hit, query
from siftline.catalog.joins import placed
from siftline.catalog.storage import SAMPLE_SQL, captured
from siftline.operators import circuits, delivery
from siftline.session import fresh_path
from siftline.streaming import ingest, state

_B = book()


def _stream(t, name: str, files_per_batch: int | None = None):
    """Stream over a given table: a folder of files, or one file picked out of the folder of all tables."""
    table = getattr(t, name)
    single = table.inputFiles()[0].endswith(f"/{name}.parquet")
    only = f"{name}.parquet" if single else None
    return ingest.file_stream(t.spark, t.folder if single else t.path(name), table.schema, files_per_batch=files_per_batch, only=only)


def _events(t):
    return _stream(t, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# Rows of a file that one task writes and reads; whole texts take some 3 KB a row.
PART_ROWS = 50_000


def _parts(t, df, name: str, count: int):
    """Rows written as files of bounded size, and how many of them make a micro-batch, so a stream over them has ``count`` micro-batches."""
    path = fresh_path(t.spark, name)
    each = max(1, -(-df.count() // (count * PART_ROWS)))
    df.repartition(count * each).write.parquet(path)
    return path, each


def _in_order(t, df, order: str, name: str, count: int):
    """Rows written as files one after the other, each holding the next part of the range of ``order``."""
    path = fresh_path(t.spark, name)
    cuts = df.select(F.percentile_approx(order, F.array(*[F.lit((k + 1) / count) for k in range(count - 1)])).alias("c")).first()["c"]
    bounds = [None, *(cuts or []), None]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        part = df if low is None else df.filter(F.col(order) > F.lit(low))
        part = part if high is None else part.filter(F.col(order) <= F.lit(high))
        part.coalesce(1).write.mode("append").parquet(path)
        yield path


def _ran(t, writer, name: str):
    ingest.run_to_end(writer, fresh_path(t.spark, name + "-checkpoint"))


def _to_table(t, df, name: str):
    path = fresh_path(t.spark, name)
    _ran(t, df.writeStream.format("parquet").option("path", path), name)
    return t.spark.read.schema(df.schema).parquet(path)


@query("str1_incremental_admission", "SELECT DISTINCT content_key FROM keyed", ctes="keyed")
def _(t):
    rows = t.records.drop("lang")
    again = rows.withColumn("pos", F.col("pos") + F.lit(1 << 40)).withColumn("source_record_id", F.concat("source_record_id", F.lit("-again")))
    path, each = _parts(t, rows.unionByName(again), "arrivals", 3)
    stored, keys = fresh_path(t.spark, "stored"), fresh_path(t.spark, "keys")
    stream = ingest.file_stream(t.spark, path, rows.schema, files_per_batch=each)
    _ran(t, ingest.ingest(stream, stored, keys, parts=16, segments=3), "admission")
    # a new checkpoint starts its batch ids again and reads everything again: nothing is stored twice, nothing lost
    _ran(t, ingest.ingest(stream, stored, keys, parts=16, segments=3), "admission-again")
    return t.spark.read.parquet(stored).select("content_key")


@query("str2_replay_overlap", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    twice = t.log.unionByName(t.log)
    path, each = _parts(t, twice, "overlap", 3)
    stream = ingest.file_stream(t.spark, path, twice.schema, files_per_batch=each)
    return _to_table(t, ingest.deduplicated(stream, ["event_id"], "ts", "40 days"), "distinct").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("str3_late_data", "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY 1")
def _(t):
    rows = ingest.within_age(_events(t), "ts", F.lit("2024-01-30 00:00:00").cast("timestamp"), 20)
    return _to_table(t, rows, "recent").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("str4_streaming_funnel", f"SELECT source, route, count(*) AS n FROM ranked WHERE {hit('mtext', _B.discovery_terms())} GROUP BY 1,2", ctes="ranked")
def _(t):
    seen = t.log.select(F.col("event_id").alias("doc_id"), F.col("ts").alias("published_at"))
    rows = _stream(t, "documents").join(seen, "doc_id").select(F.col("doc_id").alias("pos"), "source", "text", "published_at")
    out = ingest.scored_stream(rows, _B, AS_OF).select("source", F.col("ranking.route").alias("route"))
    return _to_table(t, out, "routes").groupBy("source", "route").agg(F.count(F.lit(1)).alias("n"))


@query("str5_daily_counters", "SELECT strftime(ts,'%Y-%m-%d') AS day, 'src'||user_id % 4 AS source, event_type AS name, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS value FROM events GROUP BY 1,2,3")
def _(t):
    path, each = _parts(t, t.log, "counted", 3)
    stream = ingest.file_stream(t.spark, path, t.log.schema, files_per_batch=each)
    rows = stream.select("ts", F.concat(F.lit("src"), F.col("user_id") % 4).alias("source"), F.col("event_type").alias("name"), F.floor("value").alias("amount"))
    out = fresh_path(t.spark, "counters")
    _ran(t, ingest.write_updates(ingest.daily_counts(rows), out), "counters")
    latest = ingest.latest_updates(t.spark, out, "day date, source string, name string, value bigint", ["day", "source", "name"])
    return latest.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


_CACHE = """WITH RECURSIVE l AS MATERIALIZED (SELECT user_id, event_id, epoch_us(ts)/1e6 AS t, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    s AS (SELECT user_id, 0::BIGINT AS i, 0::BIGINT AS event_id, NULL::VARCHAR AS held, 0.0::DOUBLE AS held_at, ''::VARCHAR AS reason, false AS reused FROM (SELECT DISTINCT user_id FROM l)
      UNION ALL SELECT user_id, i, event_id, CASE WHEN r THEN held WHEN event_type='error' THEN NULL ELSE event_type END, CASE WHEN r THEN held_at ELSE t END, CASE WHEN r THEN held WHEN event_type='error' THEN 'dns_temporary' ELSE event_type END, r
      FROM (SELECT l.user_id, l.i, l.event_id, l.event_type, l.t, s.held, s.held_at, s.held IS NOT NULL AND s.held_at > l.t - 259200 AS r FROM s JOIN l ON l.user_id=s.user_id AND l.i=s.i+1))
    SELECT event_id AS seq, reason, reused FROM s WHERE i > 0"""


@query("str6_cached_results", _CACHE)
def _(t):
    out, checkpoint = fresh_path(t.spark, "cached"), fresh_path(t.spark, "cached-checkpoint")
    for path in _in_order(t, t.log, "ts", "checks", 3):  # three micro-batches, each after a restart
        log = ingest.file_stream(t.spark, path, t.log.schema, files_per_batch=1)
        kind = F.col("event_type")
        rows = log.select(F.concat(F.lit("u"), "user_id").alias("email_hash"), F.col("event_id").alias("seq"), "ts", F.lit("RISKY").alias("status"),
                          F.when(kind == "error", "dns_temporary").otherwise(kind).alias("reason"))
        ingest.run_to_end(state.cached_results(rows).writeStream.format("parquet").option("path", out), checkpoint, timers=t.spark)
    return t.spark.read.schema(state.CACHE_OUT).parquet(out).select("seq", "reason", "reused")


@query("str7_stream_sample", SAMPLE_SQL)
def _(t):
    rows = captured(t)
    rows = rows.withColumn("pos", F.col("doc_id"))
    out = fresh_path(t.spark, "sample")
    cut = F.lit(rows.select(F.percentile_approx("pos", 0.66).alias("c")).first()["c"])
    *_, path = _in_order(t, rows.filter(F.col("pos") <= cut), "pos", "captures", 2)
    _ran(t, state.sample_stream(ingest.file_stream(t.spark, path, rows.schema, files_per_batch=1), out, 10), "sample")
    # a new checkpoint is a new run and goes on from the sample of the first one
    *_, path = _in_order(t, rows.filter((F.col("pos") > cut) | F.col("pos").isNull()), "pos", "later-captures", 1)
    _ran(t, state.sample_stream(ingest.file_stream(t.spark, path, rows.schema), out, 10, run="second", after="sample"), "sample-again")
    return t.spark.read.schema(rows.schema).parquet(state.last_table(t.spark, f"{out}/run=second")).drop("pos")


@query("str9_reset_headers", "SELECT event_id, CAST(user_id*60 + 0.5 AS DOUBLE) AS reset_requests, CAST(user_id AS DOUBLE) AS remaining_tokens, CAST(CASE WHEN event_type='error' THEN 120.0 END AS DOUBLE) AS retry_after FROM events")
def _(t):
    u = F.col("user_id").cast("string")
    headers = F.create_map(F.lit("X-RateLimit-Reset-Requests"), F.concat(u, F.lit("m0.5s")), F.lit("x-ratelimit-remaining-tokens"), u,
                           F.lit("Retry-After"), F.when(F.col("event_type") == "error", "120").otherwise("soon"))
    rows = circuits.with_observed_headers(t.events.select("event_id", headers.alias("headers")))
    return rows.select("event_id", "reset_requests", "remaining_tokens", "retry_after")


@query("str10_exactly_once", "SELECT tab, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM placed GROUP BY tab", ctes="placed")
def _(t):
    items = delivery.items(placed(t), "camp")
    path, each = _parts(t, items, "items", 3)
    out, checkpoint = fresh_path(t.spark, "delivered"), fresh_path(t.spark, "delivered-checkpoint")
    stream = lambda: ingest.file_stream(t.spark, path, items.schema, files_per_batch=each)
    ingest.run_to_end(state.deliver_stream(stream(), out), checkpoint)
    ingest.run_to_end(state.deliver_stream(stream(), out), checkpoint)  # a restart finds nothing left to do
    ingest.run_to_end(state.deliver_stream(stream(), out, run="replay"), fresh_path(t.spark, "replayed"))  # a full replay delivers nothing again
    return t.spark.read.parquet(out).groupBy("tab").agg(F.count(F.lit(1)).alias("n"), F.sum("lead_id").alias("ids"))


@query("str14_resumable_scan", "SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1")
def _(t):
    path, each = _parts(t, t.docs, "scan", 4)
    stream = ingest.file_stream(t.spark, path, t.docs.schema, files_per_batch=each)
    return _to_table(t, stream, "scanned").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))

