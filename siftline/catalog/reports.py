"""Driver queries for aggregates (AGG), windows (WIN) and sorts (SRT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog.common import book, query
from siftline.catalog.joins import placed
from siftline.catalog.rules import _ranked, work
from siftline.functions.emails import bucket
from siftline.operators import circuits, companies, delivery, placement, recovery, reports, retention, timelines

_B = book()
_NAMES = ["raw_scanned", "stored", "duplicates", "validated", "failures"]
_COUNTERS = """c AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN user_id % 4 = 0 THEN 'all' ELSE 'src'||(user_id % 4) END AS source,
    CASE event_type WHEN 'click' THEN 'raw_scanned' WHEN 'view' THEN 'stored' WHEN 'signup' THEN 'validated' WHEN 'error' THEN 'failures' ELSE 'duplicates' END AS name, CAST(floor(value) AS BIGINT) AS amount FROM events)"""


def amounts(t):
    kind = F.col("event_type")
    name = (F.when(kind == "click", "raw_scanned").when(kind == "view", "stored").when(kind == "signup", "validated").when(kind == "error", "failures").otherwise("duplicates"))
    source = F.when(F.col("user_id") % 4 == 0, "all").otherwise(F.concat(F.lit("src"), F.col("user_id") % 4))
    return t.log.select("ts", source.alias("source"), name.alias("name"), F.floor("value").alias("amount"))


def counters(t):
    return reports.daily_counters(amounts(t))


@query("agg1_daily_counters", "WITH " + _COUNTERS + " SELECT strftime(day,'%Y-%m-%d') AS day, source, name, CAST(2*sum(amount) AS BIGINT) AS value FROM c GROUP BY 1,2,3")
def _(t):
    once = counters(t)
    return reports.merge_counters(once, once).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("agg2_day_totals", "WITH " + _COUNTERS + " SELECT name, CAST(sum(amount) AS BIGINT) AS value FROM c WHERE day=DATE '2024-01-05' AND source <> 'all' GROUP BY 1")
def _(t):
    return reports.day_totals(counters(t), F.lit("2024-01-05").cast("date"))


@query("agg3_source_stats", "WITH " + _COUNTERS + " SELECT source, " + ", ".join(f"CAST(coalesce(sum(amount) FILTER (name='{n}'),0) AS BIGINT) AS {n}" for n in _NAMES) +
       ", round(coalesce(sum(amount) FILTER (name='validated'),0)/greatest(1,coalesce(sum(amount) FILTER (name='raw_scanned'),0)),6) AS conversion_rate FROM c GROUP BY 1")
def _(t):
    return reports.source_stats(counters(t), _NAMES).withColumn("conversion_rate", F.round("conversion_rate", 6))


@query("agg4_queue_counts", """SELECT 'jobs' AS kind, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'candidates',
    CASE event_type WHEN 'click' THEN 'VALIDATE' WHEN 'view' THEN 'CLASSIFY' WHEN 'signup' THEN 'DEFERRED' WHEN 'error' THEN 'REVIEW' ELSE 'REJECTED' END, count(*) FROM events GROUP BY 2""")
def _(t):
    return reports.status_counts(t.orders, "jobs", "o_orderstatus").unionByName(reports.status_counts(work(t), "candidates"))


@query("agg5_backlog", "SELECT count(*) AS pending, epoch_us(min(ts)) AS oldest FROM events WHERE event_type='purchase'")
def _(t):
    rows = t.log.select(F.when(F.col("event_type") == "purchase", "PENDING").otherwise("PROCESSED").alias("status"), F.col("ts").alias("created_at"))
    return reports.backlog(rows).withColumn("oldest", F.unix_micros("oldest"))


_BATCHES = """b AS (SELECT CASE WHEN o_orderstatus='F' THEN 'ACKNOWLEDGED' ELSE 'CLAIMED' END AS status, CASE WHEN o_custkey % 2=0 THEN 'c1' ELSE 'c2' END AS campaign_id, o_orderdate AS created_at,
    200 AS count, CAST(o_custkey % 200 AS INTEGER) AS qualified_count FROM orders)"""


def batches(t):
    return t.orders.select(F.when(F.col("o_orderstatus") == "F", "ACKNOWLEDGED").otherwise("CLAIMED").alias("status"), F.when(F.col("o_custkey") % 2 == 0, "c1").otherwise("c2").alias("campaign_id"),
                           F.col("o_orderdate").cast("timestamp").alias("created_at"), F.lit(200).alias("count"), (F.col("o_custkey") % 200).cast("int").alias("qualified_count"))


_DONE = "SELECT coalesce(sum(qualified_count),0) AS q, coalesce(sum(count-qualified_count),0) AS n FROM b WHERE status='ACKNOWLEDGED' AND campaign_id='c1' AND created_at >= TIMESTAMP '1998-01-01 00:00:00'"
_START = "1998-01-01 00:00:00"


def accepted(t):
    return reports.accepted(t.finals, batches(t), "c1", F.lit(_START).cast("timestamp"))


@query("agg6_accepted_finals", "WITH " + _BATCHES + f", d AS ({_DONE}) SELECT CAST((SELECT count(*) FROM finals WHERE email IS NOT NULL AND validation_status='DELIVERABLE_DOMAIN') + q AS BIGINT) AS accepted_finals FROM d", ctes="finals")
def _(t):
    return accepted(t).select("accepted_finals")


@query("agg7_non_qualified", "WITH " + _BATCHES + f", d AS ({_DONE}) SELECT CAST((SELECT count(*) FROM finals WHERE validation_status='NO_EMAIL') + n AS BIGINT) AS non_qualified_rows FROM d", ctes="finals")
def _(t):
    return accepted(t).select("non_qualified_rows")


@query("agg8_progress", "WITH " + _BATCHES + f", d AS ({_DONE}), a AS (SELECT CAST((SELECT count(*) FROM finals WHERE email IS NOT NULL AND validation_status='DELIVERABLE_DOMAIN') + q AS BIGINT) AS acc FROM d) "
       "SELECT 100000 AS final_target, acc AS accepted_finals, greatest(0,100000-acc) AS finals_remaining, acc >= 100000 AS final_target_reached FROM a", ctes="finals")
def _(t):
    return reports.progress(accepted(t), 100_000, 1_000_000, F.lit(500)).select("final_target", "accepted_finals", "finals_remaining", "final_target_reached")


@query("agg9_capacity_plan", """WITH g AS (SELECT bucket, count(*) AS n FROM bucketed GROUP BY 1), x AS (SELECT CAST(sum(ceil(n/100.0)) AS BIGINT) AS tabs, CAST(sum((n+ceil(n/100.0))*17) AS BIGINT) AS delivery_cells FROM g)
    SELECT tabs, delivery_cells, 0 AS existing_cells, delivery_cells AS total_cells, 10000000 AS cell_limit, delivery_cells <= 10000000 AS within_limit, greatest(0,10000000-delivery_cells) AS headroom_cells FROM x""", ctes="bucketed")
def _(t):
    rows = t.finals.groupBy(bucket(F.col("email")).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    return placement.capacity_plan(rows, 100)


def delivered(t):
    items = delivery.batched(delivery.items(placed(t), "camp"))
    return items.select(F.concat(F.lit("b"), "batch_no").alias("batch_id"), F.lit("camp").alias("campaign_id"), "lead_id", "tab", "row", "values")


_DEL = "d AS (SELECT *, 'b'||((row_number() OVER (ORDER BY id) - 1)//200) AS batch_id, strftime(created_at,'%Y-%m-%dT%H:%M:%S+00:00') AS iso, email IS NOT NULL AND validation_status='DELIVERABLE_DOMAIN' AS q FROM placed)"


@query("agg10_receipts", "WITH " + _DEL + " SELECT batch_id, count(*) AS count, count(*) FILTER (q) AS qualified_count, 'alphabetical' AS layout, min(iso) AS created_at, max(iso) AS acknowledged_at FROM d GROUP BY 1", ctes="placed")
def _(t):
    return recovery.receipts(delivered(t)).drop("campaign_id")


@query("agg11_next_positions", "SELECT bucket, CAST(count(*) AS BIGINT) AS next_position FROM placed GROUP BY 1", ctes="placed")
def _(t):
    rows = placed(t).groupBy("tab").agg(F.count(F.lit(1)).alias("rows"))
    return placement.next_positions(rows, 100)


@query("agg12_totals", "SELECT 'camp' AS campaign_id, max(id) AS max_lead_id, count(*) AS rows, count(*) FILTER (email IS NOT NULL AND validation_status='DELIVERABLE_DOMAIN') AS qualified FROM finals", ctes="finals")
def _(t):
    return recovery.totals(delivered(t))


@query("agg13_usage", """WITH l AS (SELECT *, CASE WHEN event_type='view' THEN 'youtube' ELSE 'groq_'||event_type END AS provider, CAST(floor(value) AS BIGINT) AS tin, user_id AS tout, CASE WHEN event_type='click' THEN user_id*1000 END AS ticks FROM events)
    SELECT strftime(CASE WHEN provider='youtube' THEN ts - INTERVAL 8 HOUR ELSE ts END,'%Y-%m-%d') AS day, provider, count(*) AS requests, CAST(sum(tin) AS BIGINT) AS input_tokens, CAST(sum(tout) AS BIGINT) AS output_tokens,
    round(sum(coalesce(ticks/1e10, (tin*0.2+tout*0.5)/1e6)),6) AS cost FROM l GROUP BY 1,2""")
def _(t):
    kind = F.col("event_type")
    log = t.log.select("ts", F.when(kind == "view", "youtube").otherwise(F.concat(F.lit("groq_"), kind)).alias("provider"), F.floor("value").alias("input_tokens"),
                       F.col("user_id").alias("output_tokens"), F.when(kind == "click", F.col("user_id") * 1000).alias("ticks"))
    zone = F.when(F.col("provider") == "youtube", "America/Los_Angeles").otherwise("UTC")
    return reports.usage(log, zone, 0.2, 0.5).withColumn("day", F.date_format("day", "yyyy-MM-dd")).withColumn("cost", F.round("cost", 6))


@query("agg14_allowances", """WITH l AS (SELECT 'org'||user_id % 7 AS org, ts, CASE WHEN event_type IN ('click','view') THEN 'ok' ELSE 'minute_cap' END AS code, CASE event_type WHEN 'error' THEN 429 WHEN 'signup' THEN 500 ELSE 200 END AS status,
      CAST(floor(value) AS BIGINT) AS tokens, CASE WHEN event_type='error' THEN ts + INTERVAL 2 HOUR END AS nxt FROM events),
    a AS (SELECT org, count(*) FILTER (code='ok' AND CAST(ts AS DATE)=DATE '2024-01-30') AS requests_today, CAST(coalesce(sum(tokens) FILTER (code='ok' AND CAST(ts AS DATE)=DATE '2024-01-30'),0) AS BIGINT) AS reserved_tokens_today,
      count(*) FILTER (status=429) AS responses_429, count(*) FILTER (status >= 400 AND status <> 429) AS error_responses, count(*) FILTER (code <> 'ok' AND status <> 429) AS admission_deferrals,
      coalesce(max(nxt) > TIMESTAMP '2024-01-30 22:00:00', false) AS cooling_down FROM l GROUP BY 1)
    SELECT *, greatest(0,20-requests_today) AS requests_remaining, greatest(0,1000-reserved_tokens_today) AS tokens_remaining FROM a""")
def _(t):
    kind = F.col("event_type")
    log = t.log.select(F.concat(F.lit("org"), F.col("user_id") % 7).alias("org"), "ts", F.when(kind.isin("click", "view"), "ok").otherwise("minute_cap").alias("code"),
                       F.when(kind == "error", 429).when(kind == "signup", 500).otherwise(200).alias("status"), F.floor("value").alias("tokens"),
                       F.when(kind == "error", F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("next_allowed_at"))
    return reports.allowances(log, F.lit("2024-01-30 22:00:00").cast("timestamp"), 20, 1000)


_LAB = "l AS (SELECT r.pos, r.route <> 'REJECT' AS predicted, r.rank_score, r.score, b.quality=1 AS positive FROM ranked r JOIN labels b ON b.doc_id=r.pos)"


def labelled(t):
    return _ranked(t).select("pos", "ranking.route", "ranking.rank_score", "rules.score").join(t.labels.select(F.col("doc_id").alias("pos"), "quality"), "pos")


@query("agg15_quality", "WITH " + _LAB + """ SELECT count(*) AS rows, count(*) FILTER (positive) AS positives, count(*) FILTER (NOT positive) AS negatives,
    round(count(*) FILTER (positive AND predicted)/greatest(1,count(*) FILTER (predicted)),6) AS positive_precision, round(count(*) FILTER (NOT positive AND predicted)/greatest(1,count(*) FILTER (NOT positive)),6) AS negative_false_positive_rate,
    round(count(*) FILTER (positive = predicted)/count(*),6) AS accuracy FROM l""", ctes="ranked")
def _(t):
    out = reports.quality(labelled(t), F.col("quality") == 1, F.col("route") != "REJECT")
    return out.withColumns({n: F.round(n, 6) for n in ("positive_precision", "negative_false_positive_rate", "accuracy")})


_CELLS = "x AS (SELECT r.pos, CASE WHEN b.quality=1 THEN 'good' ELSE 'poor' END AS label, CASE WHEN r.score >= 60 THEN 'good' ELSE 'poor' END AS predicted FROM ranked r JOIN labels b ON b.doc_id=r.pos)"


@query("agg16_classification_report", "WITH " + _CELLS + """, n AS (SELECT unnest(['good','poor']) AS label), c AS (SELECT n.label, count(*) FILTER (x.label=n.label) AS s, count(*) FILTER (x.predicted=n.label) AS p,
    count(*) FILTER (x.label=n.label AND x.predicted=n.label) AS h FROM n, x GROUP BY 1), r AS (SELECT label, s, CASE WHEN p>0 THEN h/p ELSE 0 END AS pr, CASE WHEN s>0 THEN h/s ELSE 0 END AS re FROM c)
    SELECT label, round(pr,6) AS precision, round(re,6) AS recall, round(CASE WHEN pr+re>0 THEN 2*pr*re/(pr+re) ELSE 0 END,6) AS f1, s AS support FROM r""", ctes="ranked")
def _(t):
    rows = labelled(t).select(F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"), F.when(F.col("score") >= 60, "good").otherwise("poor").alias("predicted"))
    return reports.classification_report(rows).withColumns({n: F.round(n, 6) for n in ("precision", "recall", "f1")})


@query("agg17_route_shares", "SELECT route, count(*) AS n, round(100.0*count(*)/(SELECT count(*) FROM ranked),4) AS percent FROM ranked GROUP BY 1", ctes="ranked")
def _(t):
    return reports.shares(_ranked(t).select("ranking.route"), "route")


_HOST = r"regexp_replace(lower(regexp_extract(url,'^https?://([^/?#:]+)',1)),'^www\.','')"


@query("agg18_company_records", f"""WITH h AS (SELECT page_id, url, html, {_HOST} AS host FROM pages), m AS (SELECT * FROM h WHERE ends_with(host,'.com')),
    f AS (SELECT host, arg_min(url, page_id) AS url, min(page_id) AS first_page, count(*) AS pages FROM m GROUP BY host)
    SELECT host, url, CASE WHEN pages > 1 THEN 'info@'||host||'|sales@'||host||'|accounts@'||host ELSE 'info@'||host||'|sales@'||host END AS emails, epoch_us(TIMESTAMP '2024-01-01 00:00:00') + first_page*1000000 AS published_us FROM f""")
def _(t):
    from siftline.functions.urls import host_of

    pages = t.spread(t.pages).withColumn("host", host_of(F.col("url")))
    # the first page of a host names info@ twice and sales@, every later page accounts@ first and info@ again
    first = pages.groupBy("host").agg(F.min("page_id").alias("_first"))
    pages = pages.join(first, "host")
    on_first = F.concat(F.lit(" info@"), "host", F.lit(" joe@"), "host", F.lit(" Sales@"), "host", F.lit(" info@"), "host")
    later = F.concat(F.lit(" accounts@"), "host", F.lit(" info@"), "host")
    html = F.concat("html", F.when(F.col("page_id") == F.col("_first"), on_first).otherwise(later))
    rows = pages.select("url", html.alias("html"), F.col("page_id").alias("pos"), F.timestamp_seconds(F.lit(1704067200) + F.col("page_id")).alias("fetched_at"))
    out = companies.company_records(rows, _B.lookups)
    return out.select("host", "url", F.array_join("emails", "|").alias("emails"), F.unix_micros("published_at").alias("published_us"))


@query("agg19_identity_seen", "SELECT 'u'||user_id AS identity_hash, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, arg_max(CASE WHEN event_type='purchase' THEN 'e'||event_id END, CASE WHEN event_type='purchase' THEN ts END) AS email_hash FROM events GROUP BY 1")
def _(t):
    rows = t.log.select(F.concat(F.lit("u"), "user_id").alias("identity_hash"), F.col("ts").alias("seen_at"), F.when(F.col("event_type") == "purchase", F.concat(F.lit("e"), "event_id")).alias("email_hash"))
    out = reports.identity_seen(rows)
    return out.select("identity_hash", F.unix_micros("first_seen_at").alias("first_us"), F.unix_micros("last_seen_at").alias("last_us"), "email_hash")


@query("agg20_status_counts", "SELECT 'drafts' AS kind, validation_status AS status, count(*) AS n FROM finals GROUP BY 2 UNION ALL SELECT 'responses', event_type, count(*) FROM events GROUP BY 2", ctes="finals")
def _(t):
    return reports.status_counts(t.finals, "drafts", "validation_status").unionByName(reports.status_counts(t.events, "responses", "event_type"))


@query("agg21_duplicate_accounting", """WITH v AS (SELECT source, CASE WHEN row_number() OVER (PARTITION BY content_key ORDER BY pos)=1 THEN 1 ELSE 0 END AS s FROM keyed)
    SELECT source, count(*)+3 AS scanned, CAST(sum(s) AS BIGINT) AS stored, CAST(sum(1-s) AS BIGINT) AS duplicates, 3 AS discovery_rejected FROM v GROUP BY 1""", ctes="keyed")
def _(t):
    from siftline.operators.admission import admit, with_record_keys

    rows = with_record_keys(t.records)
    verdicts = admit(rows).join(t.documents.select(F.col("doc_id").alias("pos"), "source"), "pos")
    scanned = t.documents.groupBy("source").agg((F.count(F.lit(1)) + 3).alias("scanned"))
    return reports.duplicate_accounting(verdicts, scanned)


@query("agg22_provider_counters", "SELECT 'src'||user_id % 4 AS source, event_type AS provider, 'org'||user_id % 3 AS org, count(*) AS classified FROM events GROUP BY 1,2,3")
def _(t):
    return reports.provider_counters(t.events.select(F.concat(F.lit("src"), F.col("user_id") % 4).alias("source"), F.col("event_type").alias("provider"), F.concat(F.lit("org"), F.col("user_id") % 3).alias("org")))


@query("agg23_funnel", """SELECT source, count(*) AS scanned, count(*) FILTER (NOT rejected) AS candidates, count(*) FILTER (route IN ('SEMANTIC','DIRECT_FINAL')) AS qualified, count(*) FILTER (route='DIRECT_FINAL') AS direct FROM ranked GROUP BY 1""", ctes="ranked")
def _(t):
    route = F.col("ranking.route")
    rows = _ranked(t).select("source", (~F.col("rules.rejected")).alias("candidates"), route.isin("SEMANTIC", "DIRECT_FINAL").alias("qualified"), (route == "DIRECT_FINAL").alias("direct"))
    return reports.funnel(rows, ["candidates", "qualified", "direct"])


@query("agg24_destination_snapshot", "SELECT tab, count(*) AS rows, sha256('sheet-1') AS spreadsheet_sha256 FROM placed GROUP BY 1", ctes="placed")
def _(t):
    return recovery.snapshot_of(placed(t), "sheet-1", F.current_timestamp()).drop("captured_at")


@query("agg25_planned_growth", """WITH n AS (SELECT tab, max(row) AS want FROM placed GROUP BY 1), c AS (SELECT tab, 40 AS rows, 17 AS cols FROM n WHERE tab LIKE '%001'), j AS (SELECT coalesce(c.rows,0) AS r, coalesce(c.cols,0) AS k, want FROM n FULL JOIN c USING (tab))
    SELECT CAST(sum(r*k) AS BIGINT) AS allocated_cells, CAST(sum(greatest(r,want)*greatest(k,17)-r*k) AS BIGINT) AS growth_cells, 9000000 AS usable_cells, true AS fits FROM j""", ctes="placed")
def _(t):
    needed = placement.runs(placed(t))
    current = needed.select("tab").distinct().filter(F.col("tab").endswith("001")).select("tab", F.lit(40).alias("rows"), F.lit(17).alias("cols"))
    return placement.planned_growth(current, needed)


# ---- windows ------------------------------------------------------------------------------------

@query("win1_top_captures", f"""WITH h AS (SELECT page_id, url, {_HOST} AS host, regexp_extract(url,'^https?://[^/?#]+([^?#]*)',1) AS path FROM pages), k AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY length(path), page_id) AS rn FROM h WHERE path LIKE '/en/%')
    SELECT host, page_id, rn FROM k WHERE rn <= 2""")
def _(t):
    out = companies.top_captures(t.pages.select("page_id", "url"), 2, pos="page_id", contact_path="^/en/")
    return out.select("host", "page_id", F.col("rn").cast("long").alias("rn"))


@query("win2_first_wins", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1,2")
def _(t):
    from siftline.operators.keys import first_by

    return first_by(t.events, ["user_id", "event_type"], ["event_id"], ["event_id"])


@query("win3_sequential_placement", "SELECT id, CASE WHEN email IS NULL THEN 'PROSPECTS_' ELSE 'VALIDATED_' END||printf('%03d', (p//100)+1) AS tab, CAST(p % 100 + 2 AS INTEGER) AS row FROM (SELECT id, email, row_number() OVER (PARTITION BY email IS NULL ORDER BY id) - 1 + CASE WHEN email IS NULL THEN 0 ELSE 150 END AS p FROM finals)", ctes="finals")
def _(t):
    starts = t.spark.createDataFrame([("SEQUENTIAL", 150)], "bucket string, start long")
    return placement.place(t.finals, "sequential", 100, starts).select("id", "tab", "row")


@query("win3_global_positions", "SELECT l_orderkey * 8 + l_linenumber AS k, row_number() OVER (ORDER BY l_orderkey * 8 + l_linenumber) - 1 AS position FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def _(t):
    from siftline.operators.keys import positions

    rows = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k")).distinct()
    return positions(rows, "k")


@query("win4_bucket_placement", "SELECT id, bucket, position, tab, row FROM placed", ctes="placed")
def _(t):
    return placed(t).select("id", "bucket", "position", "tab", "row")


@query("win5_row_runs", "WITH g AS (SELECT tab, row, row - row_number() OVER (PARTITION BY tab ORDER BY row) AS i FROM placed WHERE c_nationkey <> 3) SELECT tab, min(row) AS row, count(*) AS items FROM g GROUP BY tab, i", ctes="placed")
def _(t):
    return placement.runs(placed(t).filter("source <> 'src3'"))


@query("win6_precision_at", "WITH " + _LAB + " SELECT 10 AS k, round(avg(CASE WHEN positive THEN 1.0 ELSE 0.0 END),6) AS precision FROM (SELECT positive FROM l ORDER BY rank_score DESC, score DESC, pos LIMIT 10) UNION ALL SELECT 50, round(avg(CASE WHEN positive THEN 1.0 ELSE 0.0 END),6) FROM (SELECT positive FROM l ORDER BY rank_score DESC, score DESC, pos LIMIT 50)", ctes="ranked")
def _(t):
    rows = labelled(t)
    order = [-F.col("rank_score"), -F.col("score"), F.col("pos")]
    at = lambda k: reports.precision_at(rows, k, order, F.col("quality") == 1).select(F.lit(k).alias("k"), F.round("precision", 6).alias("precision"))
    return at(10).unionByName(at(50))


@query("win7_rolling_minute", "SELECT event_id, count(*) OVER w AS requests, CAST(sum(CAST(floor(value) AS BIGINT)) OVER w AS BIGINT) AS tokens FROM events WINDOW w AS (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)")
def _(t):
    out = timelines.rolling_minute(t.log, "event_type", "ts", {"requests": F.lit(1), "tokens": F.floor("value")}, seconds=3600, chunk_seconds=7200)
    return out.select("event_id", "requests", "tokens")


_HYST = """m AS (SELECT *, CASE WHEN value >= 80 THEN true WHEN value <= 10 THEN false END AS mark FROM events)"""


@query("win8_hysteresis", "WITH " + _HYST + " SELECT event_id, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS draining FROM m")
def _(t):
    return timelines.hysteresis(t.log, "event_type", "ts", "value", 80, 10).select("event_id", "draining")


_STREAK = """k AS (SELECT event_id, user_id, ts, event_type='error' AS bad, event_type <> 'signup' AS known FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM k WHERE known),
    r AS (SELECT *, i - coalesce(max(CASE WHEN NOT bad THEN i END) OVER w, 0) AS b, i - coalesce(max(CASE WHEN bad THEN i END) OVER w, 0) AS g FROM n WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    e AS (SELECT event_id, CASE WHEN bad AND b >= 2 THEN 'device' WHEN NOT bad AND g >= 3 THEN 'cloud' END AS ev, CASE WHEN bad THEN b ELSE 0 END AS bad_run FROM r)"""


@query("win9_consecutive_switch", "WITH " + _STREAK + " SELECT k.event_id, e.bad_run, coalesce(last_value(e.ev IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'cloud') AS mode FROM k LEFT JOIN e USING (event_id)")
def _(t):
    bad = F.when(F.col("event_type") != "signup", F.col("event_type") == "error")
    out = timelines.streak_state(t.log, "user_id", ["ts"], "ts", bad, 2, 3)
    return out.select("event_id", "bad_run", "mode")


@query("win10_last_wins", """WITH k AS (SELECT doc_id, source, replace(lower(trim(text)),'ß','ss') AS t FROM documents) SELECT min(doc_id) AS pos, arg_max(source, doc_id) AS source FROM k WHERE t <> '' GROUP BY t""")
def _(t):
    rows = t.docs.select(F.col("doc_id").alias("pos"), "text", "source")
    return reports.last_wins(rows).select("pos", "source")


_RUNS = """n AS (SELECT event_id, user_id, ts, event_type IN ('error','signup') AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
    r AS (SELECT *, CASE WHEN bad THEN i - coalesce(max(CASE WHEN NOT bad THEN i END) OVER (PARTITION BY user_id ORDER BY i), 0) ELSE 0 END AS failures FROM n)"""


@query("win11_failure_streak", "WITH " + _RUNS + " SELECT event_id, failures, max(CASE WHEN failures >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) = 1 AS disabled FROM r")
def _(t):
    out = timelines.failure_streak(t.log, "user_id", ["ts"], "ts", F.col("event_type").isin("error", "signup"), 5)
    return out.select("event_id", "failures", "disabled")


@query("win12_heartbeats", """WITH l AS (SELECT user_id, max(ts) AS last_at, arg_max(event_type <> 'error', ts) AS ok FROM events GROUP BY 1), a AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-31 00:00:00')-epoch_us(last_at))/1e6 AS age FROM l)
    SELECT user_id, round(age,3) AS age, CASE WHEN NOT ok THEN 'render_unreachable' WHEN age > 50000 THEN 'scheduler_stalled' ELSE 'cloud_healthy' END AS assessment FROM a""")
def _(t):
    out = timelines.heartbeat(t.log, "user_id", "ts", F.col("event_type") != "error", F.lit("2024-01-31 00:00:00").cast("timestamp"), 50_000)
    return out.select("user_id", F.round("age", 3).alias("age"), "assessment")


# ---- sorts --------------------------------------------------------------------------------------

@query("srt1_work_priority", "SELECT event_id AS candidate_id FROM events ORDER BY round(value/50,3) DESC, CAST(floor(value) AS INTEGER) DESC, ts, event_id LIMIT 600")
def _(t):
    return retention.ranked_work(work(t), 600).select("candidate_id")


@query("srt2_oldest", "SELECT event_id AS candidate_id FROM events WHERE event_type='click' ORDER BY ts, event_id LIMIT 600")
def _(t):
    return retention.oldest(work(t).filter("status = 'VALIDATE'"), 600).select("candidate_id")


@query("srt3_oldest_finals", "SELECT c_custkey+1 AS id FROM customer ORDER BY 1 LIMIT 200")
def _(t):
    return retention.oldest(t.finals, 200, at="id", tie="id").select("id")


@query("srt4_newest", "SELECT event_id AS id FROM events WHERE event_type='error' ORDER BY ts DESC, event_id DESC LIMIT 100")
def _(t):
    return retention.newest(work(t).filter("status = 'REVIEW'"), 100).select("id")


@query("srt5_sample_listing", """SELECT source, doc_id FROM documents ORDER BY source, CASE WHEN lang='en' THEN 2 ELSE 0 END DESC, doc_id LIMIT 200""")
def _(t):
    from siftline.operators.samples import listing

    rows = t.documents.select("source", "doc_id", F.when(F.col("lang") == "en", 2).otherwise(0).alias("priority"), F.col("doc_id").alias("captured_at"))
    return listing(rows).select("source", "doc_id")


@query("srt6_natural_tab_order", """WITH t AS (SELECT DISTINCT tab, bucket, CAST(right(tab,3) AS INTEGER) AS s FROM placed) SELECT tab, row_number() OVER (ORDER BY CASE WHEN bucket='PROSPECTS' THEN 1 ELSE 0 END, bucket, s) AS place FROM t""", ctes="placed")
def _(t):
    from pyspark.sql import Window

    tabs = placed(t).select("tab").distinct()
    # tabs are shards: a list of thousands, not of rows
    return tabs.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(*placement.natural_order(F.col("tab")))).cast("long"))


@query("srt7_newest_delivered", "SELECT id, tab FROM placed ORDER BY created_at DESC, id DESC LIMIT 50", ctes="placed")
def _(t):
    return retention.newest(placed(t), 50).select("id", "tab")


# ---- logs that live beside the windows ----------------------------------------------------------

@query("str11_mode_ladder", """WITH m AS (SELECT event_id, event_type, ts, value, coalesce(last_value(CASE WHEN value >= 100 THEN true WHEN value <= 20 THEN false END IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS d FROM events)
    SELECT event_id, CASE WHEN value >= 300 THEN 'storage_pressure' WHEN event_id % 50=0 THEN 'paused' WHEN event_type='signup' THEN 'drain' WHEN d THEN 'drain' ELSE 'collect' END AS mode FROM m""")
def _(t):
    rows = timelines.hysteresis(t.log, "event_type", "ts", "value", 100, 20)
    rows = rows.withColumns({"pressure": F.col("value") >= 300, "paused": F.col("event_id") % 50 == 0, "campaign_status": F.when(F.col("event_type") == "signup", "DRAINING").otherwise("RUNNING")})
    return timelines.mode_ladder(rows).select("event_id", "mode")


_IDLE = "event_type='view'"


@query("str12_campaign_phases", f"""WITH d AS (SELECT user_id, min(ts) FILTER (value >= 120) AS a FROM events GROUP BY 1), f AS (SELECT e.user_id, min(ts) AS b FROM events e JOIN d USING (user_id) WHERE {_IDLE} AND ts > a GROUP BY 1),
    c AS (SELECT e.user_id, min(ts) AS c FROM events e JOIN f USING (user_id) WHERE {_IDLE} AND ts > b GROUP BY 1)
    SELECT user_id, epoch_us(a) AS draining_us, epoch_us(b) AS finalizing_us, epoch_us(c) AS completed_us, CASE WHEN c IS NOT NULL THEN 'COMPLETE' WHEN b IS NOT NULL THEN 'FINALIZING' WHEN a IS NOT NULL THEN 'DRAINING' ELSE 'RUNNING' END AS phase,
    epoch_us(a) + 86400000000 AS deadline_us FROM d LEFT JOIN f USING (user_id) LEFT JOIN c USING (user_id)""")
def _(t):
    out = circuits.campaign_phases(t.log, "user_id", "ts", F.col("value") >= 120, F.col("event_type") == "view", 24)
    us = lambda n: F.unix_micros(n)
    return out.select("user_id", us("draining_at").alias("draining_us"), us("finalizing_at").alias("finalizing_us"), us("completed_at").alias("completed_us"), "phase", us("semantic_deadline").alias("deadline_us"))


@query("str13_circuits", """WITH n AS (SELECT event_id, user_id, ts, event_type IN ('error','signup') AS bad, event_type='signup' AND value > 80 AS mm, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
    r AS (SELECT *, CASE WHEN bad THEN i - coalesce(max(CASE WHEN NOT bad THEN i END) OVER (PARTITION BY user_id ORDER BY i), 0) ELSE 0 END AS f FROM n), o AS (SELECT *, bad AND (mm OR f >= 3) AS opens FROM r)
    SELECT event_id, f AS consecutive_failures, opens, epoch_us(last_value(CASE WHEN opens THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) + 600000000 AS open_until_us FROM o""")
def _(t):
    out = circuits.circuit_states(t.log, "user_id", ["ts"], "ts", ~F.col("event_type").isin("error", "signup"), (F.col("event_type") == "signup") & (F.col("value") > 80), 3, 600)
    return out.select("event_id", "consecutive_failures", "opens", F.unix_micros("open_until").alias("open_until_us"))


@query("str13_worker_days", """WITH n AS (SELECT *, event_type IN ('error','signup') AS bad, event_type='signup' AND value > 80 AS mm, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS i FROM events),
    r AS (SELECT *, CASE WHEN bad THEN i - coalesce(max(CASE WHEN NOT bad THEN i END) OVER (PARTITION BY user_id ORDER BY i), 0) ELSE 0 END AS f FROM n)
    SELECT user_id, strftime(ts,'%Y-%m-%d') AS day, count(*) AS calls, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS items, count(*) FILTER (bad) AS failures, count(*) FILTER (mm) AS mismatches, count(*) FILTER (bad AND (mm OR f >= 3)) AS circuit_opens FROM r GROUP BY 1,2""")
def _(t):
    ok, mismatch = ~F.col("event_type").isin("error", "signup"), (F.col("event_type") == "signup") & (F.col("value") > 80)
    out = circuits.worker_day(circuits.circuit_states(t.log, "user_id", ["ts"], "ts", ok, mismatch, 3, 600), "user_id", "ts", ok, mismatch, F.floor("value"))
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))

