"""Driver queries for admission and the other joins (JN) and the set operations SET-3..SET-5."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog.common import KEYWORDS, book, canon, digest, hit, query, quote, redact_sql
from siftline.catalog.rules import _EACH, _each_email, _scored, mx_facts, with_bio, work
from siftline.functions import emails, text, values
from siftline.operators import admission, companies, decisions, delivery, placement, recovery, retention, samples, shadow, validation
from siftline.operators.keys import first_by

_B = book()


def _keyed(t):
    return admission.with_record_keys(t.records)


# ---- admission ----------------------------------------------------------------------------------

# Permanent keys of the first query: content of German documents and the benchmark texts.
_CLAIMED = f"claimed AS (SELECT DISTINCT 'content:'||{digest('text')} AS key FROM documents WHERE lang='de' UNION SELECT DISTINCT 'content:'||{digest('text')} FROM benchmark)"


def _claimed(t):
    of = lambda rows: rows.select(F.concat(F.lit("content:"), text.digest(F.col("text"))).alias("key"))
    return of(t.docs.filter("lang = 'de'")).unionByName(of(t.benchmark)).distinct()


@query("jn1_known_keys", "SELECT pos FROM keyed WHERE content_key NOT IN (SELECT key FROM claimed) AND record_key NOT IN (SELECT key FROM claimed)", ctes="keyed", more=_CLAIMED)
def _(t):
    known = _claimed(t)
    rows = _keyed(t).select("pos", "record_key", "content_key")
    return admission.known_keys(admission.known_keys(rows, "record_key", known), "content_key", known).select("pos")


@query("jn2_admission_verdicts", """SELECT pos, CASE WHEN row_number() OVER (PARTITION BY content_key ORDER BY pos) = 1 AND content_key NOT IN (SELECT key FROM claimed) THEN 'stored' ELSE 'duplicate' END AS verdict FROM keyed""",
       ctes="keyed", more=_CLAIMED)
def _(t):
    return admission.admit(_keyed(t), _claimed(t)).select("pos", "verdict")


# H-1 on a pair of keys that both repeat: customer, and day with priority, of every order in order of its number.


def greedy_sql(rows: str) -> str:
    """Greedy claims over ``rows(pos, a, b)`` by rounds of local minima."""
    return f"""WITH RECURSIVE r AS MATERIALIZED ({rows}), g AS (SELECT pos, a, b, false AS kept FROM r UNION ALL
      SELECT pos, a, b, win AS kept FROM (SELECT *, bool_or(win) OVER (PARTITION BY a) AS ta, bool_or(win) OVER (PARTITION BY b) AS tb FROM
        (SELECT *, pos = min(pos) OVER (PARTITION BY a) AND pos = min(pos) OVER (PARTITION BY b) AS win FROM g WHERE NOT kept)) WHERE win OR NOT (ta OR tb))"""


_ORDER_KEYS = "SELECT o_orderkey AS pos, 'c'||o_custkey AS a, 'd'||strftime(o_orderdate,'%Y%m%d')||'-'||left(o_orderpriority,1) AS b FROM orders"


@query("h1_greedy_claims", greedy_sql(_ORDER_KEYS) + " SELECT pos, a, b FROM g WHERE kept")
def _(t):
    rows = t.orders.select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("c"), F.col("o_custkey")).alias("a"),
                           F.concat(F.lit("d"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("b"))
    return admission.greedy_claims(rows, "pos", ["a", "b"]).select("pos", "a", "b")


@query("h1_greedy_claims_check", "SELECT 0 AS missed, 0 AS clashes, true AS first_wins")
def _(t):
    """What defines the greedy result, tested on all rows: kept rows never share a key, and every dropped row shares a key
    with an earlier kept row."""
    from siftline.session import durable

    rows = t.orders.select(F.col("o_orderkey").alias("pos"), F.concat(F.lit("c"), F.col("o_custkey")).alias("a"),
                           F.concat(F.lit("d"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("b"))
    kept = durable(admission.greedy_claims(rows, "pos", ["a", "b"]), "kept")
    ka, kb = kept.select("a", F.col("pos").alias("pa")), kept.select("b", F.col("pos").alias("pb"))
    lost = rows.join(kept.select("pos"), "pos", "left_anti").join(ka, "a", "left").join(kb, "b", "left")
    blocked = (F.coalesce(F.col("pa") < F.col("pos"), F.lit(False))) | (F.coalesce(F.col("pb") < F.col("pos"), F.lit(False)))
    missed = lost.agg(F.count_if(~blocked).cast("int").alias("missed"))
    sizes = kept.agg((2 * F.count(F.lit(1)) - F.count_distinct("a") - F.count_distinct("b")).cast("int").alias("clashes"))
    lowest = kept.agg(F.min("pos").alias("k")).crossJoin(rows.agg(F.min("pos").alias("m"))).select((F.col("k") == F.col("m")).alias("first_wins"))
    return missed.crossJoin(sizes).crossJoin(lowest)


@query("jn3_known_contacts", _EACH + """, n AS (SELECT 'email:'||sha256(email) AS key FROM d WHERE domain LIKE 'mail5%' OR domain LIKE 'mail2%')
    SELECT doc_id AS pos, bool_and('email:'||sha256(email) IN (SELECT key FROM n)) AS all_known FROM d GROUP BY doc_id UNION ALL SELECT doc_id, false FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM d)""")
def _(t):
    rows = t.docs.select(F.col("doc_id").alias("pos"), emails.contacts(text.canonical_text(F.col("text")), F.col("source")).alias("contacts"))
    each = _each_email(t).filter(F.col("domain").startswith("mail5") | F.col("domain").startswith("mail2"))
    claimed = each.select(F.concat(F.lit("email:"), text.digest(F.col("email"))).alias("key")).distinct()
    return admission.with_known_contacts(rows, claimed, "pos").select("pos", "all_known")


@query("jn4_first_identity", """SELECT min(pos) AS pos FROM keyed WHERE identity_hash NOT IN (SELECT """ + digest("source||':u'||c_custkey") + """ FROM customer, (SELECT DISTINCT source FROM documents) WHERE c_mktsegment='BUILDING') GROUP BY identity_hash""", ctes="keyed")
def _(t):
    sources = t.documents.select("source").distinct()
    holders = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey").join(F.broadcast(sources))
    claimed = holders.select(F.concat(F.lit("lead:"), text.digest(F.concat("source", F.lit(":u"), "c_custkey"))).alias("key"))
    rows = _keyed(t).select("pos", "identity_hash")
    return admission.first_identities(rows, claimed, "pos").select("pos")


@query("h2_final_claims_check", "SELECT 0 AS email_repeats, 0 AS identity_repeats, 0 AS refused_without_cause")
def _(t):
    """H-2 over events: addresses and identities that compete; the result is tested by its definition."""
    from siftline.session import durable

    cand = _competing(t)
    no = F.lit(False)
    won = durable(admission.finalise(cand, t.spark.createDataFrame([], "key string"), no), "won")
    held = won.join(cand.select("candidate_id", "identity_hash"), "candidate_id")
    taken_mail, taken_id = held.select("email"), held.select("identity_hash")
    lost = cand.join(won.select("candidate_id"), "candidate_id", "left_anti").join(taken_id, "identity_hash", "left_anti")
    free = lost.select("candidate_id", F.explode("contacts").alias("c")).select("candidate_id", F.col("c.email").alias("email")).join(taken_mail, "email", "left_anti")
    return held.agg((F.count(F.lit(1)) - F.count_distinct("email")).cast("int").alias("email_repeats"),
                    (F.count(F.lit(1)) - F.count_distinct("identity_hash")).cast("int").alias("identity_repeats")).crossJoin(
        free.agg(F.count(F.lit(1)).cast("int").alias("refused_without_cause")))


def _competing(t):
    contact = lambda e: F.struct(e.alias("email"), F.lit("post").alias("source_url"))
    first = F.concat(F.lit("a"), F.floor("value"), F.lit("@x.example.com"))
    second = F.concat(F.lit("b"), "user_id", F.lit("@x.example.com"))
    return work(t, F.array(contact(first), contact(second)).alias("contacts"))


_COMPETING = """SELECT row_number() OVER (ORDER BY round(value/50,3) DESC, CAST(floor(value) AS INTEGER) DESC, ts, event_id, slot) AS pos, CASE slot WHEN 0 THEN 'a'||CAST(floor(value) AS INTEGER) ELSE 'b'||user_id END||'@x.example.com' AS a,
    'u'||user_id AS b, event_id FROM events, (SELECT unnest([0,1]) AS slot)"""


@query("h2_final_claims", greedy_sql(_COMPETING) + " SELECT r.event_id AS candidate_id, r.a AS email FROM g JOIN r USING (pos) WHERE kept")
def _(t):
    return admission.finalise(_competing(t), t.spark.createDataFrame([], "key string"), F.lit(False)).select("candidate_id", "email")


# ---- lookups ------------------------------------------------------------------------------------

@query("jn5_rules_result", "SELECT d.doc_id, s.score, s.score IS NULL AS missing FROM documents d LEFT JOIN (SELECT pos, score FROM scored WHERE NOT rejected) s ON d.doc_id=s.pos", ctes="scored")
def _(t):
    rules = _scored(t).filter(~F.col("rules.rejected")).select(F.col("pos").alias("doc_id"), F.col("rules.score").alias("score"))
    return t.documents.select("doc_id").join(rules, "doc_id", "left").withColumn("missing", F.col("score").isNull())


@query("jn6_cached_validation", """WITH c AS (SELECT 'u'||user_id AS h, max(ts) AS checked_at, arg_max(event_type, ts) AS reason FROM events WHERE event_type <> 'purchase' GROUP BY 1)
    SELECT event_id, CASE WHEN e.event_type <> 'click' AND c.checked_at > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 3 DAY AND c.reason <> 'error' THEN c.reason END AS cached_reason FROM events e LEFT JOIN c ON c.h='u'||e.user_id""")
def _(t):
    who = F.concat(F.lit("u"), "user_id")
    cache = t.log.filter("event_type <> 'purchase'").groupBy(who.alias("email_hash")).agg(F.max("ts").alias("checked_at"), F.max_by("event_type", "ts").alias("reason"))
    cache = cache.withColumn("reason", F.when(F.col("reason") == "error", validation.TEMPORARY).otherwise(F.col("reason"))).withColumn("status", F.lit("RISKY"))
    rows = t.log.select("event_id", who.alias("email_hash"), (F.col("event_type") == "click").alias("company"))
    out = validation.reuse_or_compute(rows, cache, F.lit("2024-01-30 00:00:00").cast("timestamp"), F.col("company"))
    return out.select("event_id", "cached_reason")


@query("jn7_domain_facts", """SELECT 'mail'||n_nationkey||'.example.com' AS domain, n_nationkey % 5 = 0 AS has_mx, n_nationkey % 5 IN (0,1) AS answered, n_nationkey % 5 = 2 AS no_domain, n_nationkey % 5 = 3 AS no_answer FROM nation""")
def _(t):
    return validation.domain_facts(mx_facts(t).unionByName(mx_facts(t)))


@query("jn8_suffix_join", "SELECT id FROM finals WHERE email IS NOT NULL AND (split_part(email,'@',2) IN ('mail1.example.com','mail2.example.com') OR c_nationkey=11)", ctes="finals")
def _(t):
    listed = t.spark.createDataFrame([("mail1.example.com",), ("mail2.example.com",), ("mail11.example.com",)], "domain string")
    rows = t.finals.filter("email IS NOT NULL").select("id", emails.domain_part(F.col("email")).alias("domain"))
    return validation.listed_domains(rows, listed).select("id")


@query("jn9_author_bios", "SELECT pos, md5(coalesce(b.text,'')) AS bio FROM records r LEFT JOIN (SELECT 'u'||conv_id AS identity, text FROM conversations WHERE turn=0) b USING (identity)", ctes="records")
def _(t):
    return with_bio(t).select("pos", F.md5("bio").alias("bio"))


@query("jn10_without_finals", "SELECT event_id AS candidate_id FROM events WHERE event_type IN ('signup','error') AND 'u'||user_id NOT IN (SELECT 'u'||c_custkey FROM customer WHERE c_mktsegment='BUILDING') AND ts + INTERVAL 36 HOUR < TIMESTAMP '2024-01-18 00:00:00'")
def _(t):
    kept = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("u"), "c_custkey").alias("identity_hash"))
    none = t.spark.createDataFrame([], "candidate_id long, route string")
    gone = retention.candidates_expired(work(t).filter("status <> 'REJECTED'"), none, kept, F.lit("2024-01-20 00:00:00").cast("timestamp"), 48, 7)
    return gone.select("candidate_id")


@query("jn11_semantic_pending", "SELECT event_id AS candidate_id FROM events WHERE event_type='view' AND CAST(floor(value) AS INTEGER) > 100")
def _(t):
    w = work(t)
    route = w.select("candidate_id", F.when(F.col("score") > 100, "SEMANTIC").otherwise("REJECT").alias("route"))
    return retention.semantic_pending(w, route).select("candidate_id")


# ---- delivery -----------------------------------------------------------------------------------

def placed(t, shard_rows=100):
    return placement.place(t.finals, "alphabetical", shard_rows)


_ACK = """b AS (SELECT 'b'||(position//50)||bucket AS batch_id, position//50 AS k, bucket, id FROM placed),
    n AS (SELECT batch_id, any_value(k) AS k, any_value(bucket) AS bucket, count(*) FILTER (id%61=7) AS wrong, count(*) FILTER (id%59=11) AS gone FROM b GROUP BY 1)
    SELECT batch_id, CASE WHEN k%4=3 THEN 'export_batch_not_found' WHEN bucket='A' THEN CASE WHEN k%2=1 THEN 'acknowledgement_conflict' ELSE 'replayed' END
    WHEN bucket='H' AND k%2=0 THEN 'export_receipt_mismatch' WHEN wrong > 0 THEN 'export_placement_mismatch' WHEN gone > 0 THEN 'export_pending_data_missing' ELSE 'acknowledged' END AS verdict FROM n"""


@query("jn12_acknowledgement", "WITH " + _ACK, ctes="placed")
def _(t):
    k = F.floor(F.col("position") / 50)
    p = placed(t).withColumns({"k": k, "batch_id": F.concat(F.lit("b"), k, "bucket")})
    expected = p.select("batch_id", F.col("id").alias("lead_id"), "tab", "row")
    delivered = expected.withColumn("row", F.when(F.col("lead_id") % 61 == 7, F.col("row") + 1).otherwise(F.col("row")))
    one, first = F.lit("x"), F.col("bucket") == "A"
    per = p.groupBy("batch_id", "k", "bucket").agg(F.count(F.lit(1)).alias("count"))
    batches = per.filter("k % 4 <> 3").select(
        "batch_id", "count", one.alias("checksum"), one.alias("spreadsheet_id"), one.alias("drive_folder_id"),
        F.when(first, "ACKNOWLEDGED").otherwise("CLAIMED").alias("status"), F.when(first & (F.col("k") % 2 == 1), "y").otherwise("x").alias("ack_digest"))
    receipts = per.select("batch_id", one.alias("checksum"), F.when((F.col("bucket") == "H") & (F.col("k") % 2 == 0), "y").otherwise("x").alias("drive_checksum"),
                          one.alias("spreadsheet_id"), one.alias("drive_folder_id"), one.alias("digest"))
    return delivery.acknowledge(batches, expected, receipts, delivered, t.finals.filter("id % 59 <> 11"))


@query("jn12_batch_sums", """WITH b AS (SELECT 'b'||(position//50)||bucket AS batch_id, md5(id||'|'||tab||'|'||row) AS h FROM placed)
    SELECT batch_id, count(*) AS n, CAST(sum(CAST('0x'||substr(h,1,16) AS UBIGINT)) AS VARCHAR) AS upper, CAST(sum(CAST('0x'||substr(h,17,16) AS UBIGINT)) AS VARCHAR) AS lower FROM b GROUP BY 1""", ctes="placed")
def _(t):
    p = placed(t).select(F.concat(F.lit("b"), F.floor(F.col("position") / 50), "bucket").alias("batch_id"), F.col("id").alias("lead_id"), "tab", "row")
    return delivery.batch_sums(p).select("batch_id", "n", F.col("upper").cast("string").alias("upper"), F.col("lower").cast("string").alias("lower"))


@query("jn13_cascade", """WITH a AS (SELECT id, candidate_id FROM finals WHERE validation_status <> 'NO_EMAIL'), c AS (SELECT c_custkey AS candidate_id, c_custkey*2 AS record_id FROM customer)
    SELECT 'finals' AS tbl, count(*) AS n FROM finals WHERE id NOT IN (SELECT id FROM a) UNION ALL SELECT 'candidates', count(*) FROM c WHERE candidate_id NOT IN (SELECT candidate_id FROM a)
    UNION ALL SELECT 'records', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT record_id FROM c WHERE candidate_id IN (SELECT candidate_id FROM a))
    UNION ALL SELECT 'claimed', count(*) FROM c WHERE candidate_id NOT IN (SELECT candidate_id FROM a)""", ctes="finals")
def _(t):
    finals = t.finals
    cand = finals.select("candidate_id", "identity_hash", (F.col("candidate_id") * 2).alias("record_id"), F.lit("VALIDATED").alias("status"))
    records = t.orders.select(F.col("o_orderkey").alias("record_id"))
    claimed = cand.select(F.concat(F.lit("candidate:"), "identity_hash").alias("key"))
    acked = finals.filter("validation_status <> 'NO_EMAIL'").select(F.col("id").alias("lead_id"))
    rest = delivery.cascade(acked, finals, cand, records, claimed)
    count = lambda name: rest[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
    return count("finals").unionByName(count("candidates")).unionByName(count("records")).unionByName(count("claimed"))


_SNAP = "s AS (SELECT tab, max(row)-1 + CASE WHEN tab LIKE '%H_001' THEN 2 WHEN tab LIKE '%M_002' THEN -1 ELSE 0 END AS n FROM placed GROUP BY tab)"


@query("jn14_coverage", "WITH " + _SNAP + """, e AS (SELECT tab, unnest(range(2, n+2)) AS row FROM s), p AS (SELECT DISTINCT tab, row FROM placed)
    SELECT coalesce(e.tab,p.tab) AS tab, CAST(coalesce(e.row,p.row) AS INTEGER) AS row, CASE WHEN p.tab IS NULL THEN 'missing' ELSE 'outside' END AS problem FROM e FULL JOIN p ON e.tab=p.tab AND e.row=p.row WHERE p.tab IS NULL OR e.tab IS NULL""", ctes="placed")
def _(t):
    items = delivery.items(placed(t), "camp")
    tabs = items.groupBy("tab").agg((F.max("row") - 1).alias("rows"))
    tabs = tabs.withColumn("rows", F.col("rows") + F.when(F.col("tab").endswith("H_001"), 2).when(F.col("tab").endswith("M_002"), -1).otherwise(0))
    return recovery.coverage(items, tabs)


# every seventh delivered row is lost, every eleventh delivered twice with other values
_LOST = "d AS (SELECT DISTINCT tab, row, position%11=0 AS two FROM placed WHERE position%7 <> 2)"


@query("jn14_ranges", "WITH " + _SNAP + ", " + _LOST + """, m AS (SELECT s.tab, r.row FROM (SELECT tab, unnest(range(2, n+2)) AS row FROM s) r JOIN s USING (tab) ANTI JOIN d ON d.tab=s.tab AND d.row=r.row),
    i AS (SELECT tab, row, row - row_number() OVER (PARTITION BY tab ORDER BY row) AS g FROM m)
    SELECT tab, 'missing' AS problem, min(row) AS first, max(row) AS last FROM i GROUP BY tab, g
    UNION ALL SELECT d.tab, CASE WHEN d.row > s.n+1 THEN 'outside' ELSE 'conflicting' END, d.row, d.row FROM d JOIN s USING (tab) WHERE d.row > s.n+1 OR two""", ctes="placed")
def _(t):
    p = placed(t)
    tabs = p.groupBy("tab").agg((F.max("row") - 1).alias("rows"))
    tabs = tabs.withColumn("rows", F.col("rows") + F.when(F.col("tab").endswith("H_001"), 2).when(F.col("tab").endswith("M_002"), -1).otherwise(0))
    kept = p.filter("position % 7 <> 2")
    items = delivery.items(kept, "camp")
    other = delivery.items(kept.filter("position % 11 = 0").withColumn("excerpt", F.lit("changed")), "camp")
    return recovery.coverage_ranges(items.unionByName(other), tabs)


# of three delivered files one is as it was, one was changed and one is lost
@query("jn14_refusals", """WITH b AS (SELECT (row_number() OVER (ORDER BY id)-1)//50 AS k FROM placed)
    SELECT 'checksum' AS reason, count(DISTINCT k) AS cases FROM b WHERE k%3=1 HAVING count(*) > 0 UNION ALL SELECT 'incomplete_coverage', count(*) FROM b WHERE k%3=2 HAVING count(*) > 0""", ctes="placed")
def _(t):
    p = placed(t)
    env = delivery.envelopes(delivery.batched(delivery.items(p, "camp"), size=50), "camp", "sheet-1", "folder-1", 100)
    changed = F.transform("items", lambda i: i.withField("values", F.transform(i["values"], lambda v, at: F.when(at == 3, F.concat(v, F.lit("!"))).otherwise(v))))
    env = env.filter("batch_no % 3 <> 2").withColumn("items", F.when(F.col("batch_no") % 3 == 1, changed).otherwise(F.col("items")))
    snapshot = recovery.snapshot_of(p, "sheet-1", F.current_timestamp()).select("tab", "rows", F.lit(None).cast("string").alias("problem"))
    return recovery.refusals(env, snapshot, ("sheet-1", "folder-1", 100)).groupBy("reason").agg(F.sum("cases").alias("cases"))


@query("jn15_pending", "SELECT 'camp:'||id AS lead_id FROM finals WHERE validation_status <> 'NO_EMAIL' AND id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus='F') AND c_nationkey <> 9", ctes="finals")
def _(t):
    rows = t.finals.filter("validation_status <> 'NO_EMAIL'").select(F.concat(F.lit("camp:"), "id").alias("lead_id"), "source")
    done = t.orders.filter("o_orderstatus = 'F'").select(F.concat(F.lit("camp:"), "o_orderkey").alias("lead_id"))
    gone = t.customer.filter("c_nationkey = 9").select(F.concat(F.lit("camp:"), F.col("c_custkey") + 1).alias("lead_id"))
    return companies.pending(rows, done, gone).select("lead_id")


@query("jn16_responses", """SELECT 'camp:'||user_id AS lead_id, CASE WHEN event_type='click' THEN 'interest' ELSE 'unsubscribe' END AS kind, epoch_us(min(ts)) AS at_us,
    CASE WHEN event_type='click' THEN 'interested' ELSE 'unsubscribed' END || CASE WHEN max(f.email) IS NULL THEN '_lead_not_found' ELSE '' END AS status, coalesce(max(f.email),'') AS email
    FROM events LEFT JOIN finals f ON f.id=user_id WHERE event_type IN ('click','view') GROUP BY user_id, event_type""", ctes="finals")
def _(t):
    secret = "a-test-key"
    log = t.log.select(F.concat(F.lit("camp:"), "user_id").alias("lead_id"), "ts",
                       F.when(F.col("event_type").isin("click", "error"), "interest").otherwise("unsubscribe").alias("kind"), "event_type")
    own = values.signed_token(F.col("lead_id"), secret)
    other = values.signed_token(F.col("lead_id"), secret, "unsub:")
    log = log.withColumn("_a", own).withColumn("_b", other)
    # clicks and views carry their right token, errors the other kind's, all else none
    log = log.withColumn("token", F.when(F.col("event_type") == "click", F.col("_a")).when(F.col("event_type").isin("view", "error"), F.col("_b")).otherwise("0")).drop("_a", "_b")
    sent = t.finals.select(F.concat(F.lit("camp:"), "id").alias("lead_id"), F.lit("").alias("business_name"), "email", "source_url")
    return companies.responses(log, sent, secret).select("lead_id", "kind", F.unix_micros("at").alias("at_us"), "status", "email")


@query("jn17_shadow_verdicts", "SELECT source AS batch, count(*) AS items, count(*) AS checked, count(*) FILTER (lang='de' AND source='src3') AS mismatches, count(*) FILTER (lang='de' AND source='src3') = 0 AS accepted FROM documents GROUP BY source")
def _(t):
    from siftline.operators.matching import with_matches

    rows = with_matches(t.docs.withColumn("match_text", text.matching_text(F.col("text"))), _B).select(F.col("source").alias("batch"), F.col("doc_id").alias("id"), "lang", "matched")
    wrong = (F.col("lang") == "de") & (F.col("batch") == "src3")
    remote = rows.withColumn("matched", F.when(wrong, F.array(F.lit("other"))).otherwise(F.reverse("matched")))
    return shadow.verified(rows, remote, 1.0)


@query("jn18_contract", """SELECT source AS batch, count(*) FILTER (lang='fr') AS unexpected, count(*) FILTER (lang='es') AS repeated, count(*) FILTER (lang='de') AS missing, count(*) FILTER (lang='es') AS unknown_group FROM documents GROUP BY source""")
def _(t):
    d = t.documents.select(F.col("source").alias("batch"), F.col("doc_id").alias("id"), "lang")
    request = d.filter("lang <> 'fr'")
    known, odd = F.array(F.lit("relevance")), F.array(F.lit("relevance"), F.lit("relevance"))
    answers = d.filter("lang <> 'de'").withColumn("matched", known)
    result = answers.unionByName(d.filter("lang = 'es'").withColumn("matched", odd))
    return shadow.contract_problems(request, result, list(_B.groups()))


@query("jn19_sample_update", """SELECT pos, CASE WHEN lang='de' THEN 'final' WHEN lang='fr' THEN 'candidate' WHEN rejected THEN 'rejected' ELSE 'candidate' END AS outcome,
    CASE WHEN lang='de' THEN 4 WHEN lang='fr' THEN 2 WHEN rejected THEN 0 ELSE 2 END AS priority, 'score='||score||CASE WHEN lang IN ('de','fr') THEN ',step=late' ELSE '' END AS detail FROM
    (SELECT s.*, d.lang FROM scored s JOIN documents d ON d.doc_id=s.pos)""", ctes="scored")
def _(t):
    rows = _scored(t)
    outcome = F.when(F.col("lang") == "fr", "candidate").when(F.col("rules.rejected"), "rejected").otherwise("candidate")
    base = rows.select(F.col("pos").alias("candidate_id"), outcome.alias("outcome"), F.create_map(F.lit("score"), F.col("rules.score").cast("string")).alias("detail"))
    base = base.withColumn("priority", decisions.sample_priority(F.col("outcome")))
    late = t.documents.filter("lang IN ('de','fr')").select(F.col("doc_id").alias("candidate_id"), F.when(F.col("lang") == "de", "final").alias("outcome"),
                                                          F.create_map(F.lit("step"), F.lit("late")).alias("detail"))
    out = samples.update_samples(base, late)
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("detail"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return out.select(F.col("candidate_id").alias("pos"), "outcome", "priority", shown.alias("detail"))


@query("jn20_contact_roles", r"""WITH h AS (SELECT url, min(page_id) AS page_id, regexp_replace(lower(regexp_extract(url,'^https?://([^/?#:]+)',1)),'^www\.','') AS host FROM pages GROUP BY url)
    SELECT 'camp:'||page_id AS lead_id, 'https://'||host||'/' AS website, 'sales@'||host AS delivered_email, 'Sales' AS delivered_role, CASE WHEN ends_with(host,'.com') THEN 'accounts@'||host ELSE 'sales@'||host END AS best_email,
    CASE WHEN ends_with(host,'.com') THEN 'info@'||host||', sales@'||host ELSE '' END AS others, 'checked' AS status FROM h""".replace("'info@'||host||', sales@'||host", "'sales@'||host||', info@'||host"))
def _(t):
    from siftline.functions.urls import host_of

    pages = t.spread(t.pages).withColumn("host", host_of(F.col("url")))
    pages = pages.withColumn("html", F.concat("html", F.lit(" info@"), "host", F.lit(" accounts@"), "host"))
    leads = first_by(pages, ["url"], ["page_id"], ["page_id", "host"]).select(
        F.concat(F.lit("camp:"), "page_id").alias("lead_id"), F.col("host").alias("business_name"), F.concat(F.lit("sales@"), "host").alias("email"), F.col("url").alias("source_url"))
    out = companies.contact_roles(leads, pages, _B.lookups)
    return out.select("lead_id", "website", "delivered_email", "delivered_role", "best_email", F.col("other_mailboxes").alias("others"), "status")


_PLACE_TERMS = KEYWORDS["signals"]["nearby"]


@query("jn21_rebuilt_place", f"SELECT conv_id, turn, {hit('left(' + redact_sql('translate(' + canon('text') + chr(44) + quote('‘’‛ʼ') + chr(44) + quote(chr(39) * 4) + ')') + ',2000)', _PLACE_TERMS)} AS placed FROM conversations WHERE role='user'")
def _(t):
    rows = t.spread(t.conversations.filter("role = 'user'")).select("conv_id", "turn", F.lit("profile_bio").alias("geography_evidence"),
                                                                   F.lit(None).cast("string").alias("place_excerpt"), F.col("text").alias("bio"))
    out = decisions.rebuilt_place(rows, _PLACE_TERMS)
    return out.select("conv_id", "turn", F.col("place_excerpt").isNotNull().alias("placed"))


@query("jn22_redo", "SELECT id FROM finals WHERE c_mktsegment='AUTOMOBILE' OR id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus='F')", ctes="finals")
def _(t):
    drafts = t.finals.select("id", F.concat(F.lit("camp:"), "id").alias("lead_id"), F.when(F.col("product_type") == "MOTOR", " approved").otherwise("").alias("approved"))
    ids = t.orders.filter("o_orderstatus = 'F'").select(F.concat(F.lit("camp:"), "o_orderkey").alias("lead_id"))
    return companies.redo(drafts, ids).select("id")


_LINES = """l AS (SELECT event_id AS pos, 'camp:'||user_id AS lead_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n, user_id, event_type FROM events)"""


@query("jn23_import_lines", "WITH " + _LINES + """, p AS (SELECT id, c_mktsegment FROM finals WHERE c_nationkey <> 9)
    SELECT lead_id, CASE WHEN event_type='error' THEN '' ELSE 'We see '||c_mktsegment||'.' END AS line, CASE WHEN event_type='error' THEN 'NEEDS_MANUAL' ELSE 'PENDING_REVIEW' END AS status FROM l JOIN p ON p.id=l.user_id WHERE n=1""", ctes="finals")
def _(t):
    return _imported(t)[0].select("lead_id", F.col("personal_line").alias("line"), "status")


@query("jn23_skipped_lines", "WITH " + _LINES + ", p AS (SELECT id FROM finals WHERE c_nationkey <> 9) SELECT lead_id, count(*) AS skipped FROM l LEFT JOIN p ON p.id=l.user_id WHERE n > 1 OR p.id IS NULL GROUP BY 1", ctes="finals")
def _(t):
    return _imported(t)[1].groupBy("lead_id").agg(F.count(F.lit(1)).alias("skipped"))


def _imported(t):
    waiting = t.customer.filter("c_nationkey <> 9").select(F.concat(F.lit("camp:"), F.col("c_custkey") + 1).alias("lead_id"), F.col("c_mktsegment").alias("business_name"),
                                                          F.lit("").alias("website"), F.lit("").alias("to_email"), F.lit("").alias("other_mailboxes"))
    name = waiting.select("lead_id", F.col("business_name").alias("name"))
    items = t.events.select(F.col("event_id").alias("pos"), F.concat(F.lit("camp:"), "user_id").alias("lead_id"), "event_type").join(name, "lead_id", "left")
    line = F.when(F.col("event_type") == "error", "Buy cover").otherwise(F.concat(F.lit("We see "), F.coalesce("name", F.lit("x"))))
    items = items.select("pos", "lead_id", "name", line.alias("line"), F.col("name").alias("excerpt"))
    return companies.import_lines(items, waiting)


# ---- set operations -----------------------------------------------------------------------------

@query("set3_placement_multisets", "SELECT 'expected' AS missing_in, id AS lead_id, row+1 AS row FROM placed WHERE c_nationkey=3 UNION ALL SELECT 'delivered', id, row FROM placed WHERE c_nationkey=3", ctes="placed")
def _(t):
    p = placed(t).select(F.lit("b").alias("batch_id"), F.col("id").alias("lead_id"), "tab", "row", "source")
    moved = p.withColumn("row", F.when(F.col("source") == "src3", F.col("row") + 1).otherwise(F.col("row")))
    return delivery.placement_mismatches(p, moved).select("missing_in", "lead_id", "row")


@query("set4_missing_per_tab", "WITH " + _SNAP + ", c AS (SELECT tab, count(DISTINCT row) AS n FROM placed GROUP BY tab) SELECT s.tab, s.n - c.n AS missing FROM s JOIN c USING (tab) WHERE s.n > c.n", ctes="placed")
def _(t):
    items = delivery.items(placed(t), "camp")
    tabs = items.groupBy("tab").agg((F.max("row") - 1).alias("rows"))
    tabs = tabs.withColumn("rows", F.col("rows") + F.when(F.col("tab").endswith("H_001"), 2).when(F.col("tab").endswith("M_002"), -1).otherwise(0))
    return recovery.missing_per_tab(recovery.coverage_ranges(items, tabs))


@query("set5_rebuilt_keys", "SELECT 'email:'||sha256(email) AS key FROM finals WHERE email IS NOT NULL AND validation_status <> 'SYNTHETIC_TEST' AND c_nationkey <> 6", ctes="finals")
def _(t):
    items = delivery.items(placed(t), "camp")
    held = t.finals.filter("source = 'src6' AND email IS NOT NULL").select(F.concat(F.lit("email:"), text.digest(F.col("email"))).alias("key"))
    return recovery.rebuilt_keys(items, held)
