"""Driver queries for filters (FLT), rules and ranking (RUL) and set unions of contacts (SET-1, SET-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog.common import (AS_OF, EMAIL_SQL, KEYWORDS, LOOKUPS, SQL_AS_OF, book, canon, hit, listed, query, quote)
from siftline.functions import emails, text
from siftline.operators import companies, decisions, delivery, matching, ranking, retention, scoring, validation
from siftline.plans.funnel import score_and_route
from siftline.rules import load_rules, rules_from_table, term_table
from siftline.session import durable
from siftline.sources.records import to_records, union_sources

_B = book()


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def _list(c):
    return F.array_join(c, "|")


def _scored(t):
    return scoring.rules_result(t.records, _B, AS_OF, bio=None)


def _scored_once(t):
    """Rules results without their texts, written: candidates and rules are two readers of them."""
    return durable(_scored(t).select("pos", "rules"), "rules")


def _ranked(t):
    rows = _scored(t)
    return rows.withColumn("ranking", ranking.rank_route(F.col("rules"), F.lit(False), _B.policy))


# ---- the flagship: records through matching, scoring and routing --------------------------------

@query("funnel_routes_by_source", """SELECT source, route, count(*) AS records, CAST(sum(score) AS BIGINT) AS score_total, CAST(sum(CAST(round(rank_score*1000) AS BIGINT)) AS BIGINT) AS rank_milli_total
    FROM ranked GROUP BY source, route""", ctes="ranked")
def _(t):
    rows = score_and_route(t.records, _B, AS_OF)
    return rows.groupBy("source", F.col("ranking.route").alias("route")).agg(
        F.count(F.lit(1)).alias("records"), F.sum("rules.score").alias("score_total"), F.sum(F.round(F.col("ranking.rank_score") * 1000).cast("long")).alias("rank_milli_total"))


# ---- filters ------------------------------------------------------------------------------------

@query("flt1_discovery", f"SELECT pos, {hit('mtext', _B.discovery_terms())} AS found FROM texts", ctes="texts")
def _(t):
    return t.records.select("pos", matching.discovery_match(text.matching_text(F.col("text")), _B).alias("found"))


@query("flt2_recency", f"SELECT event_id, ({SQL_AS_OF}-epoch_us(ts))/86400e6 <= 30 AND ({SQL_AS_OF}-epoch_us(ts))/86400e6 >= -1 AS recent FROM events")
def _(t):
    return t.log.select("event_id", scoring.recent(F.col("ts"), as_of(), 30).alias("recent"))


@query("flt3_relevance", "SELECT pos, product <> 'UNKNOWN' OR relevance AS relevant FROM signalled", ctes="signalled")
def _(t):
    rows = matching.with_matches(t.records.withColumn("match_text", text.matching_text(F.col("text"))), _B)
    return rows.select("pos", scoring.relevant(scoring.product_of(F.col("matched"), _B), F.col("matched")).alias("relevant"))


_EACH = f"""WITH e AS (SELECT doc_id, unnest(regexp_extract_all({canon('text')}, '{EMAIL_SQL}')) AS email FROM documents),
    d AS (SELECT doc_id, email, split_part(email,'@',1) AS local, split_part(email,'@',2) AS domain FROM (SELECT DISTINCT doc_id, email FROM e))"""


def _each_email(t):
    found = t.docs.select("doc_id", F.explode(emails.found_emails(text.canonical_text(F.col("text")))).alias("email"))
    return found.select("doc_id", "email", emails.local_part(F.col("email")).alias("local"), emails.domain_part(F.col("email")).alias("domain"))


@query("flt4_disposable", _EACH + " SELECT doc_id, email, " + " OR ".join(f"domain={quote(x)} OR ends_with(domain,'.{x}')" for x in LOOKUPS["disposable_domains"]) + " AS disposable FROM d")
def _(t):
    return _each_email(t).select("doc_id", "email", validation.disposable(F.col("domain"), _B.lookups).alias("disposable"))


@query("flt5_role_account", _EACH + f" SELECT doc_id, email, list_contains({listed(LOOKUPS['role_accounts'])}, local) AS role FROM d")
def _(t):
    return _each_email(t).select("doc_id", "email", F.col("local").isin(_B.lookups["role_accounts"]).alias("role"))


@query("flt6_national_address", r"SELECT pos, regexp_matches(mtext,'@[a-z0-9.-]+\.com(?:[^\p{L}\p{N}_.-]|$)') AS national FROM texts", ctes="texts")
def _(t):
    return t.records.select("pos", scoring.national_address(text.matching_text(F.col("text")), "com").alias("national"))


_WORK = """SELECT event_id, CASE event_type WHEN 'click' THEN 'VALIDATE' WHEN 'view' THEN 'CLASSIFY' WHEN 'signup' THEN 'DEFERRED' WHEN 'error' THEN 'REVIEW' ELSE 'REJECTED' END AS status,
    ts AS created_at, ts + INTERVAL 36 HOUR AS available_at, 'u'||user_id AS identity_hash, CAST(floor(value) AS INTEGER) AS score, round(value/50,3) AS rank_score FROM events"""


def work(t, *more):
    """events as candidate rows, with further columns of the same events."""
    kind = F.col("event_type")
    status = (F.when(kind == "click", "VALIDATE").when(kind == "view", "CLASSIFY").when(kind == "signup", "DEFERRED").when(kind == "error", "REVIEW")
              .otherwise("REJECTED"))
    return t.log.select(F.col("event_id").alias("candidate_id"), F.col("event_id").alias("id"), status.alias("status"), F.col("ts").alias("created_at"),
                        (F.col("ts") + F.expr("INTERVAL 36 HOURS")).alias("available_at"), F.concat(F.lit("u"), "user_id").alias("identity_hash"),
                        F.floor("value").cast("int").alias("score"), F.round(F.col("value") / 50, 3).alias("rank_score"), *more)


@query("flt7_work_due", f"WITH w AS ({_WORK}) SELECT event_id AS candidate_id FROM w WHERE status='CLASSIFY' AND epoch_us(available_at) <= epoch_us(TIMESTAMP '2024-01-20 00:00:00')")
def _(t):
    return retention.due(work(t), "CLASSIFY", F.lit("2024-01-20 00:00:00").cast("timestamp")).select("candidate_id")


@query("flt8_qualified", "SELECT id, coalesce(email,'') <> '' AND validation_status NOT IN ('NO_EMAIL','SYNTHETIC_TEST') AS qualified FROM finals", ctes="finals")
def _(t):
    return t.finals.select("id", delivery.qualified(F.col("email"), F.col("validation_status")).alias("qualified"))


@query("flt9_usable_contacts", """SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-17 00:00:00' AND event_type='click' THEN 1 ELSE 0 END + CASE WHEN ts > TIMESTAMP '2024-01-17 00:00:00' THEN 1 ELSE 0 END AS usable FROM events""")
def _(t):
    stamp = lambda zone: F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))
    one = lambda status, zone: F.struct(F.lit("a@b.c").alias("email"), status.alias("status"), stamp(zone).alias("validated_at"))
    good = F.lit("DELIVERABLE_DOMAIN")
    held = F.array(one(F.when(F.col("event_type") == "click", good).otherwise("RISKY"), "+00:00"), one(good, "Z"), one(good, ""))
    return t.log.select("event_id", F.size(validation.usable_contacts(held, F.lit("2024-01-20 00:00:00").cast("timestamp"))).alias("usable"))


@query("flt10_page_flags", """SELECT page_id, regexp_matches(html,'(?i)\\b(?:cheap|pills|casino)\\b') AS spam, regexp_matches(html,'(?i)article[^.]{0,40}the') AS trade FROM pages""".replace("\\\\", "\\"))
def _(t):
    rows = t.spread(t.pages)
    return rows.select("page_id", F.col("html").rlike(r"(?i)\b(?:cheap|pills|casino)\b").alias("spam"), F.col("html").rlike(r"(?i)article[^.]{0,40}the").alias("trade"))


@query("flt11_raw_expiry", """SELECT doc_id FROM (SELECT d.doc_id, d.lang, e.ts FROM documents d JOIN events e ON d.doc_id=e.event_id) WHERE lang <> 'en' AND ts < TIMESTAMP '2024-01-02 12:00:00'""")
def _(t):
    rows = t.records.withColumn("status", F.when(F.col("lang") == "en", "PENDING").otherwise("PROCESSED")).withColumn("created_at", F.col("published_at"))
    return retention.raw_expired(rows, F.lit("2024-01-03 12:00:00").cast("timestamp"), 1).select(F.col("pos").alias("doc_id"))


@query("flt11_candidate_expiry", f"""WITH w AS ({_WORK}), f AS (SELECT DISTINCT 'u'||c_custkey AS identity_hash FROM customer WHERE c_mktsegment='BUILDING'),
    x AS (SELECT * FROM w WHERE (status IN ('NO_CONTACT','CONTACT_REVIEW','DEFERRED','REVIEW') AND available_at < TIMESTAMP '2024-01-18 00:00:00')
      OR (status='REJECTED' AND created_at < TIMESTAMP '2024-01-13 00:00:00') OR (status='CLASSIFY' AND score > 300))
    SELECT event_id AS candidate_id, status FROM x WHERE identity_hash NOT IN (SELECT identity_hash FROM f)""")
def _(t):
    w = work(t)
    route = w.select("candidate_id", F.when(F.col("score") > 300, "SEMANTIC").otherwise("DEFERRED").alias("route"))
    kept = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.concat(F.lit("u"), "c_custkey").alias("identity_hash"))
    gone = retention.candidates_expired(w, route, kept, F.lit("2024-01-20 00:00:00").cast("timestamp"), 48, 7, semantic_due=True)
    return gone.select("candidate_id", "status")


@query("flt12_row_reasons", """WITH i AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority='1-URGENT' THEN 'BAD_1' WHEN o_orderstatus='P' THEN 'VALIDATED_A_001' ELSE 'PROSPECTS_001' END AS tab,
      o_orderkey % 130 AS row, o_orderstatus, o_orderpriority FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey < 1 THEN 'lead_id' WHEN tab='BAD_1' THEN 'tab' WHEN row < 2 OR row > 101 THEN 'row' WHEN o_orderpriority='2-HIGH' THEN 'values'
      WHEN o_orderpriority='5-LOW' THEN 'identifier_mismatch' WHEN tab LIKE 'VALIDATED%' THEN 'prospect_in_email_dataset' END AS reason FROM i""")
def _(t):
    from siftline.functions.values import FIELDS

    pr = F.col("o_orderpriority")
    tab = F.when(pr == "1-URGENT", "BAD_1").when(F.col("o_orderstatus") == "P", "VALIDATED_A_001").otherwise("PROSPECTS_001")
    lead = F.when(pr == "5-LOW", "camp:x").otherwise(F.concat(F.lit("camp:"), "o_orderkey"))
    given = {"lead_id": lead, "campaign_id": F.lit("camp"), "validation_status": F.lit("NO_EMAIL")}
    cells = F.array(*[given.get(f, F.lit("")) for f in FIELDS])
    rows = t.orders.select("o_orderkey", F.col("o_orderkey").alias("lead_id"), tab.alias("tab"), (F.col("o_orderkey") % 130).cast("int").alias("row"),
                           F.when(pr == "2-HIGH", F.slice(cells, 1, 5)).otherwise(cells).alias("values"))
    return rows.select("o_orderkey", delivery.row_reason(F.lit("camp"), F.lit(100)).alias("reason"))


@query("flt13_row_checks", """SELECT id, true AS ok_lead_id, true AS ok_source_url, length(excerpt) > 0 AS ok_evidence, product_type='MOTOR' AS ok_product, c_nationkey <> 7 AS ok_salutation,
    email IS NOT NULL OR validation_status='NO_EMAIL' AS ok_email FROM finals""", ctes="finals")
def _(t):
    rows = t.finals.select("id", F.concat(F.lit("camp:"), "id").alias("lead_id"), "source_url", F.col("excerpt").alias("source_evidence"),
                           F.when(F.col("product_type") == "MOTOR", "MOTOR").otherwise("BOATS").alias("product_type"),
                           F.when(F.col("source") == "src7", "Hi").otherwise("Good day Thandi,").alias("salutation"), "email", "validation_status")
    return delivery.row_checks(rows).select("id", "ok_lead_id", "ok_source_url", "ok_evidence", "ok_product", "ok_salutation", "ok_email")


@query("flt14_trade_text", f"SELECT pos, {hit('mtext', ['thha', 'and of'])} AS trade FROM texts", ctes="texts")
def _(t):
    return t.records.select("pos", scoring.trade_text(text.matching_text(F.col("text")), _B.policy["business_contact"]).alias("trade"))


@query("flt15_erasure", "SELECT source, count(*) AS left_rows FROM documents WHERE NOT (source='src3') GROUP BY source")
def _(t):
    from siftline.operators.samples import erase

    rows = t.documents.select("source", F.col("doc_id").cast("string").alias("source_record_id"))
    return erase(rows, source="src3").groupBy("source").agg(F.count(F.lit(1)).alias("left_rows"))


# ---- rule classification ------------------------------------------------------------------------

_NAMES = [f"product:{n}" for n in KEYWORDS["products"]] + [f"signal:{n}" for n in KEYWORDS["signals"]] + ["relevance"]
_MATCHED = ("array_to_string(list_concat(list_concat(list_transform(products, lambda x: 'product:'||x), list_transform(posted, lambda x: 'signal:'||x)), "
            "CASE WHEN relevance THEN ['relevance'] ELSE [] END),'|')")


@query("rul1_dictionary_match", f"SELECT pos, {_MATCHED} AS matched FROM matched", ctes="matched")
def _(t):
    rows = matching.with_matches(t.records.withColumn("match_text", text.matching_text(F.col("text"))), _B)
    return rows.select("pos", _list("matched").alias("matched"))


@query("rul1_match_by_join", f"SELECT pos, {_MATCHED} AS matched FROM matched WHERE len(products)+len(posted) > 0 OR relevance", ctes="matched")
def _(t):
    rows = t.records.select("pos", text.matching_text(F.col("text")).alias("match_text"))
    hits = matching.match_by_join(rows, term_table(t.spark, _B), "pos")
    return hits.select("pos", _list("matched").alias("matched"))


@query("rul1_phrases_of_benchmark", r"""WITH w AS (SELECT item_id, string_split(trim(regexp_replace(replace(lower(text),'ß','ss'),'[^\p{L}\p{N}_]+',' ','g')),' ') AS l FROM benchmark),
    p AS (SELECT DISTINCT unnest(list_transform(range(1, len(l)), lambda i: l[i]||' '||l[i+1])) AS term FROM w WHERE len(l) >= 2), d AS (SELECT conv_id, turn, regexp_split_to_array(REPLACETEXT,'[^\p{L}\p{N}_ ]+') AS runs FROM conversations),
    r AS (SELECT conv_id, turn, unnest(list_transform(runs, lambda r: list_filter(string_split(r,' '), lambda x: x <> ''))) AS ws FROM d),
    g AS (SELECT DISTINCT conv_id, turn, unnest(list_transform(range(1, greatest(len(ws),1)), lambda i: ws[i]||' '||ws[i+1])) AS term FROM r)
    SELECT conv_id, turn, count(*) AS hits FROM g JOIN p USING (term) GROUP BY 1,2""".replace("REPLACETEXT", canon("text")))
def _(t):
    words = F.split(F.trim(F.regexp_replace(text.canonical_text(F.col("text")), r"[^\p{L}\p{N}_]+", " ")), " ")
    pairs = F.transform(F.sequence(F.lit(0), F.size("w") - 2), lambda i: F.concat_ws(" ", F.get("w", i), F.get("w", i + 1)))
    phrases = t.benchmark.select(words.alias("w")).filter(F.size("w") >= 2).select(F.explode(F.array_distinct(pairs)).alias("term")).distinct()
    terms = phrases.select(F.col("term").alias("grp"), F.lit(0).alias("ord"), "term")
    rows = t.spread(t.conversations).select(F.struct("conv_id", "turn").alias("key"), text.matching_text(F.col("text")).alias("match_text"))
    hits = matching.match_by_join(rows, terms, "key")
    return hits.select("key.conv_id", "key.turn", F.size("matched").cast("long").alias("hits"))


@query("rul2_product", "SELECT pos, product FROM signalled", ctes="signalled")
def _(t):
    rows = matching.with_matches(t.records.withColumn("match_text", text.matching_text(F.col("text"))), _B)
    return rows.select("pos", scoring.product_of(F.col("matched"), _B).alias("product"))


_BIO = f"""bios AS (SELECT 'u'||conv_id AS identity, text AS bio FROM conversations WHERE turn=(SELECT min(turn) FROM conversations)),
    b AS MATERIALIZED (SELECT c.*, coalesce(bio,'') AS bio, {hit("left(translate(" + canon('bio') + ", '‘’‛ʼ', ''''''''''),2000)", KEYWORDS['signals']['nearby'])} AS bio_hit FROM signalled c LEFT JOIN bios USING (identity)),
    x AS (SELECT *, NOT list_contains(posted,'nearby') AND bio_hit AS from_bio FROM b)"""


def with_bio(t):
    """records with the first turn of a conversation as the author's bio."""
    from siftline.sources.posts import with_bios

    first = t.conversations.groupBy("conv_id").agg(F.min_by("text", "turn").alias("bio"), F.min("turn").alias("turn"))
    first = first.filter(F.col("turn") == 0)
    return with_bios(t.records, first.select(F.concat(F.lit("u"), "conv_id").alias("identity"), "bio"), limit=None)


@query("rul3_signals_with_bio", "SELECT pos, array_to_string(CASE WHEN from_bio THEN list_concat(signals,['nearby']) ELSE signals END,'|') AS signals, "
       "CASE WHEN list_contains(posted,'nearby') THEN 'post' WHEN from_bio THEN 'profile_bio' END AS evidence FROM x WHERE source <> 'src7'", ctes="signalled", more=_BIO)
def _(t):
    rows = scoring.rules_result(with_bio(t), _B, AS_OF).filter("source <> 'src7'")
    return rows.select("pos", _list("rules.signals").alias("signals"), F.col("rules.geography_evidence").alias("evidence"))


@query("rul4_overrides", "SELECT pos, array_to_string(cancelled,'|') AS cancelled FROM signalled", ctes="signalled")
def _(t):
    rows = matching.with_matches(t.records.withColumn("match_text", text.matching_text(F.col("text"))), _B)
    signals = scoring.signals_of(F.col("matched"), _B)
    return rows.select("pos", _list(scoring.overridden(signals, _B.policy)).alias("cancelled"))


@query("rul5_conflicts", "SELECT pos, array_to_string(conflicting_signals,'|') AS conflicts FROM scored", ctes="scored")
def _(t):
    return _scored(t).select("pos", _list("rules.conflicting_signals").alias("conflicts"))


@query("rul6_score", "SELECT pos, score FROM consumer WHERE source <> 'src7'", ctes="consumer")
def _(t):
    return _scored(t).filter("source <> 'src7'").select("pos", F.col("rules.score").alias("score"))


@query("rul7_rejected", "SELECT pos, rejected FROM scored", ctes="scored")
def _(t):
    return _scored(t).select("pos", F.col("rules.rejected").alias("rejected"))


@query("rul8_confident", "SELECT pos, confident FROM scored", ctes="scored")
def _(t):
    return _scored(t).select("pos", F.col("rules.confident").alias("confident"))


@query("rul9_business_score", f"""WITH c AS (SELECT doc_id, source, {canon('text')} AS mtext FROM (SELECT doc_id, source, 'Business website. Contact: info@shop'||doc_id||CASE WHEN lang='en' THEN '.com' ELSE '.org' END
    ||CASE WHEN n_chars % 3 = 0 THEN ' thha' ELSE '' END AS text FROM documents))
    SELECT doc_id, 50 AS score, 'BUSINESS_CONTACT' AS product, array_to_string(list_concat(list_concat(['business_contact'], CASE WHEN mtext LIKE '%.com%' THEN ['nearby'] ELSE [] END),
      CASE WHEN mtext LIKE '% thha' THEN ['trade'] ELSE [] END),'|') AS signals, mtext NOT LIKE '%.com%' OR mtext LIKE '% thha' AS rejected FROM c""")
def _(t):
    made = F.concat(F.lit("Business website. Contact: info@shop"), "doc_id", F.when(F.col("lang") == "en", ".com").otherwise(".org"),
                    F.when(F.col("n_chars") % 3 == 0, " thha").otherwise(""))
    rows = t.documents.select("doc_id", F.lit("src7").alias("source"), made.alias("text"), as_of().alias("published_at"))
    rows = scoring.rules_result(rows, _B, AS_OF, bio=None)
    return rows.select("doc_id", "rules.score", F.col("rules.product_type").alias("product"), _list("rules.signals").alias("signals"), "rules.rejected")


@query("rul10_rank", "SELECT pos, rank_score FROM ranked", ctes="ranked")
def _(t):
    return _ranked(t).select("pos", "ranking.rank_score")


@query("rul11_route", "SELECT pos, route FROM ranked", ctes="ranked")
def _(t):
    return _ranked(t).select("pos", "ranking.route")


@query("rul12_gates", "SELECT pos, NOT biz AS contact, on_target OR biz AS product, placed AS geography, placed AS geography_signal, review_route FROM ranked", ctes="ranked")
def _(t):
    return _ranked(t).select("pos", "ranking.hard_gates.*", "ranking.review_route")


@query("rul13_business_route", "SELECT pos, CASE WHEN list_contains(signals,'nearby') AND NOT rejected THEN 'DIRECT_FINAL' ELSE 'REJECT' END AS route, CAST(5.0 AS DOUBLE) AS rank_score FROM scored WHERE source='src7'", ctes="scored")
def _(t):
    rows = _scored(t).filter("source = 'src7'").withColumn("ranking", ranking.rank_route(F.col("rules"), F.lit(True), _B.policy))
    return rows.select("pos", "ranking.route", "ranking.rank_score")


_FACTS = """f AS (SELECT 'mail'||n_nationkey||'.example.com' AS domain, CASE n_nationkey % 5 WHEN 0 THEN 'answer' WHEN 1 THEN 'answer' WHEN 2 THEN 'nxdomain' WHEN 3 THEN 'no_answer' ELSE 'timeout' END AS outcome,
    CASE n_nationkey % 5 WHEN 0 THEN 'mx.example.com.' WHEN 1 THEN '.' END AS exchange FROM nation)"""


def mx_facts(t):
    k = F.col("n_nationkey") % 5
    return t.nation.select(F.concat(F.lit("mail"), "n_nationkey", F.lit(".example.com")).alias("domain"),
                           F.when(k.isin(0, 1), "answer").when(k == 2, "nxdomain").when(k == 3, "no_answer").otherwise("timeout").alias("outcome"),
                           F.when(k == 0, "mx.example.com.").when(k == 1, ".").alias("exchange"))


_VERDICT = """CASE WHEN email IS NULL THEN 'invalid_syntax' WHEN domain='mail1.example.com' OR ends_with(domain,'.mail1.example.com') THEN 'disposable_domain' WHEN outcome='answer' AND exchange <> '.' THEN 'syntax_and_mx_passed'
    WHEN outcome='answer' THEN 'null_mx' WHEN outcome='nxdomain' THEN 'nxdomain' WHEN outcome='no_answer' THEN 'no_mx' ELSE 'dns_temporary' END"""


@query("rul14_contact_verdict", f"""WITH {_FACTS}, v AS (SELECT c.id, c.email, {_VERDICT} AS reason FROM (SELECT *, split_part(email,'@',2) AS domain FROM finals) c LEFT JOIN f USING (domain))
    SELECT id, reason, CASE reason WHEN 'invalid_syntax' THEN 'INVALID' WHEN 'disposable_domain' THEN 'RISKY' WHEN 'syntax_and_mx_passed' THEN 'DELIVERABLE_DOMAIN' WHEN 'null_mx' THEN 'NO_MX'
      WHEN 'nxdomain' THEN 'NO_DOMAIN' WHEN 'no_mx' THEN 'NO_MX' ELSE 'RISKY' END AS status FROM v""", ctes="finals")
def _(t):
    return validation.contact_verdicts(t.finals.select("id", "email"), mx_facts(t), _B.lookups).select("id", "status", "reason")


def semantic_json(t):
    """Result texts made from events: one in five kinds is malformed in its own way."""
    k = F.col("event_type")
    flag = lambda c: F.when(c, "true").otherwise("false")
    even = F.col("user_id") % 2 == 0
    score = F.when(k == "error", F.lit("101")).otherwise((F.col("event_id") % 101).cast("string"))
    relevant = F.when(k == "signup", F.lit('"true"')).otherwise(F.lit("true"))
    intent = F.when(k == "view", F.lit("VERY")).otherwise(F.lit("HIGH"))
    tail = F.when(k == "purchase", F.lit(',"extra":1}')).otherwise(F.lit("}"))
    body = F.concat(F.lit('{"is_insurance_relevant":'), relevant, F.lit(',"is_consumer":'), flag(even), F.lit(
        ',"is_advertisement":false,"is_broker_or_agent":false,"south_africa_signal":true,"intent_level":"'), intent, F.lit('","product_type":"MOTOR","score":'), score,
        F.lit(',"reason":"asks"'), tail)
    return t.events.select("event_id", "event_type", "user_id", body.alias("body"))


@query("rul15_semantic_parse", """SELECT event_id, CASE event_type WHEN 'error' THEN 'score' WHEN 'signup' THEN 'flag_type' WHEN 'view' THEN 'intent' WHEN 'purchase' THEN 'fields' END AS refused,
    CASE WHEN event_type='click' THEN CAST(event_id % 101 AS INTEGER) END AS score FROM events""")
def _(t):
    return decisions.parse_semantic(semantic_json(t)).select("event_id", "refused", "semantic.score")


@query("rul16_semantic_accept", "SELECT event_id, event_type='click' AND user_id % 2 = 0 AND event_id % 101 >= 80 AS accepted FROM events")
def _(t):
    rows = decisions.parse_semantic(semantic_json(t))
    return rows.select("event_id", ranking.semantic_accepted(F.col("semantic"), _B.policy).alias("accepted"))


@query("rul17_decision", """SELECT r.pos, r.route, CASE WHEN r.biz THEN 'VALIDATE' WHEN route='DIRECT_FINAL' THEN 'FINALISE' WHEN route='SEMANTIC' AND e.event_type <> 'click' THEN 'WAIT'
      WHEN route='SEMANTIC' AND user_id % 2 = 0 AND event_id % 101 >= 80 THEN 'FINALISE' WHEN route='DEFERRED' THEN 'DEFERRED' ELSE 'REJECT' END AS decision,
      CASE WHEN route='SEMANTIC' AND e.event_type='click' THEN CAST(event_id % 101 AS INTEGER) ELSE r.score END AS score
    FROM ranked r JOIN events e ON r.pos=e.event_id""", ctes="ranked")
def _(t):
    rows = _scored_once(t)
    none = F.array().cast("array<struct<email:string,source_url:string,status:string,validated_at:string>>")
    cand = rows.select(F.col("pos").alias("candidate_id"), none.alias("contacts"), F.col("rules.product_type").alias("product_type"), F.col("rules.score").alias("score"))
    semantic = decisions.parse_semantic(semantic_json(t)).filter("refused IS NULL").select(F.col("event_id").alias("candidate_id"), "semantic")
    out = decisions.decide(cand, rows.select(F.col("pos").alias("candidate_id"), "rules"), semantic, _B, as_of())
    return out.select(F.col("candidate_id").alias("pos"), "route", "decision", "score")


@query("rul17_second_look", """WITH c AS (SELECT r.pos, r.route, r.biz, f.email, f.identity_hash, f.id, f.c_nationkey FROM ranked r JOIN finals f ON f.candidate_id = r.pos),
    l AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus='P' AND o_orderdate >= DATE '1995-06-01'),
    j AS (SELECT c.*, email IS NOT NULL AND c.id IN (SELECT id FROM l) AS mailed, c_nationkey = 7 AS led FROM c)
    SELECT pos, CASE WHEN email IS NULL AND biz THEN NULL WHEN led THEN 'identity_duplicates' WHEN mailed THEN 'email_duplicates' END AS duplicate,
      CASE WHEN email IS NULL AND biz THEN 'VALIDATE' WHEN led OR mailed THEN 'REJECT' WHEN route='DIRECT_FINAL' OR (biz AND direct) THEN 'FINALISE' WHEN route='SEMANTIC' THEN 'WAIT' WHEN route='DEFERRED' THEN 'DEFERRED' ELSE 'REJECT' END AS decision,
      CASE WHEN email IS NULL OR (mailed AND NOT (email IS NULL AND biz)) THEN 0 ELSE 1 END AS n_contacts
    FROM (SELECT j.*, list_contains(s.signals,'nearby') AND NOT s.rejected AS direct FROM j JOIN scored s USING (pos))""", ctes="ranked finals")
def _(t):
    """Keys that were taken since the snapshot: addresses of some customers, identities of one nation."""
    rows = _scored_once(t)
    contact = F.struct("email", F.col("source_url"), F.lit(validation.USABLE).alias("status"), F.lit(AS_OF.replace(" ", "T") + "+00:00").alias("validated_at"))
    none = F.array().cast("array<struct<email:string,source_url:string,status:string,validated_at:string>>")
    people = t.finals.select(F.col("candidate_id").alias("pos"), "id", "email", "identity_hash", F.when(F.col("email").isNotNull(), F.array(contact)).otherwise(none).alias("contacts"))
    cand = rows.join(people, "pos").select(F.col("pos").alias("candidate_id"), "identity_hash", "contacts", F.col("rules.product_type").alias("product_type"), F.col("rules.score").alias("score"))
    late = t.orders.filter("o_orderstatus = 'P' AND o_orderdate >= '1995-06-01'").select(F.col("o_orderkey").alias("id"))
    mailed = people.join(late, "id", "left_semi").filter("email IS NOT NULL").select(F.concat(F.lit("email:"), text.digest(F.col("email"))).alias("key"))
    led = t.customer.filter("c_nationkey = 7").select(F.concat(F.lit("lead:"), F.sha2("c_name", 256)).alias("key"))
    old = people.select(F.concat(F.lit("lead:"), "identity_hash").alias("key"))
    table = mailed.unionByName(led).withColumn("created_at", as_of()).unionByName(old.withColumn("created_at", F.lit("2024-01-01").cast("timestamp")))
    answers = t.spark.createDataFrame([], semantic_json(t).schema)
    semantic = decisions.parse_semantic(answers).select(F.lit(0).cast("long").alias("candidate_id"), "semantic")
    added = decisions.keys_since(table, F.lit("2024-01-15").cast("timestamp"))
    out = decisions.decide(cand, rows.select(F.col("pos").alias("candidate_id"), "rules"), semantic, _B, as_of(), added=added)
    return out.select(F.col("candidate_id").alias("pos"), "duplicate", "decision", F.size("contacts").alias("n_contacts"))


@query("rul18_validation_stage", f"""WITH {_FACTS}, c AS (SELECT *, split_part(email,'@',2) AS domain, product_type='MOTOR' AS required FROM finals),
    v AS (SELECT c.*, {_VERDICT} AS reason, email IS NOT NULL AND c.id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus='P') AS claimed FROM c LEFT JOIN f USING (domain))
    SELECT id, CASE WHEN email IS NULL THEN 'no_contact_allowed' WHEN reason='syntax_and_mx_passed' AND NOT claimed THEN 'contacts_validated' WHEN reason='dns_temporary' AND NOT claimed THEN 'retry'
      WHEN claimed THEN 'duplicate' ELSE 'contact_dropped' END AS outcome,
      CASE WHEN email IS NULL THEN 'CLASSIFY' WHEN reason='syntax_and_mx_passed' AND NOT claimed THEN 'CLASSIFY' WHEN reason='dns_temporary' AND NOT claimed THEN 'VALIDATE' WHEN claimed THEN 'REJECTED' ELSE 'CLASSIFY' END AS status,
      CASE WHEN email IS NOT NULL AND reason='dns_temporary' AND NOT claimed THEN 1 ELSE 0 END AS attempts FROM v""", ctes="finals")
def _(t):
    return _staged(t).select(F.col("candidate_id").alias("id"), "outcome", "status", "attempts")


def _staged(t, rules=None):
    contact = F.struct(F.col("email").alias("email"), F.col("source_url").alias("source_url"))
    none = F.array().cast("array<struct<email:string,source_url:string>>")
    cand = t.finals.select(F.col("id").alias("candidate_id"), "identity_hash", "product_type", "score", F.lit(0).alias("attempts"), F.lit("VALIDATE").alias("status"),
                           F.col("created_at").alias("available_at"), F.when(F.col("email").isNotNull(), F.array(contact)).otherwise(none).alias("contacts"))
    taken = t.finals.join(t.orders.filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id")), "id", "left_semi").filter("email IS NOT NULL")
    claimed = taken.select(F.concat(F.lit("email:"), text.digest(F.col("email"))).alias("key"))
    cache = t.spark.createDataFrame([], "email_hash string, status string, reason string, checked_at timestamp")
    checked = validation.checked_contacts(cand, claimed, cache, mx_facts(t), _B, as_of())
    return validation.validation_stage(cand, checked, _B, as_of(), rules=rules)


@query("rul18_stored_rank", f"""WITH {_FACTS}, c AS (SELECT *, split_part(email,'@',2) AS domain FROM finals),
    v AS (SELECT c.*, {_VERDICT} AS reason, email IS NOT NULL AND c.id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus='P') AS claimed FROM c LEFT JOIN f USING (domain))
    SELECT v.id, CASE WHEN r.pos IS NOT NULL AND (email IS NULL OR (reason='syntax_and_mx_passed' AND NOT claimed)) THEN r.rank_score ELSE 0.0 END AS rank_score
    FROM v LEFT JOIN ranked r ON r.pos + 1 = v.id""", ctes="finals ranked")
def _(t):
    rules = _scored(t).select((F.col("pos") + 1).alias("candidate_id"), "rules")
    return _staged(t, rules).select(F.col("candidate_id").alias("id"), "rank_score")


@query("rul19_best_mailbox", """WITH m AS (SELECT c_custkey, c_nationkey % 4 AS k FROM customer) SELECT c_custkey,
    CASE k WHEN 0 THEN 'accounts@x.example.com' WHEN 1 THEN 'info@x.example.com' WHEN 2 THEN 'sales@x.example.com' ELSE 'jane@x.example.com' END AS best FROM m""")
def _(t):
    k = F.col("c_nationkey") % 4
    at = lambda *n: F.array(*[F.lit(x + "@x.example.com") for x in n])
    boxes = F.when(k == 0, at("info", "sales", "accounts")).when(k == 1, at("sales", "info")).when(k == 2, at("jane", "sales")).otherwise(at("jane", "joe"))
    rows = t.customer.select("c_custkey", boxes.alias("mailboxes"))
    return companies.best_mailbox(rows, _B.lookups).select("c_custkey", F.col("best_email").alias("best"))


@query("rul20_review_rows", """WITH c AS (SELECT id, c_nationkey, c_nationkey % 8 AS k, c_mktsegment AS business FROM finals)
    SELECT 'camp:'||id AS lead_id, CASE k WHEN 0 THEN 'page_unavailable' WHEN 1 THEN 'looks_like_insurer_or_broker' WHEN 2 THEN 'page_too_thin' WHEN 3 THEN 'page_looks_compromised'
      WHEN 4 THEN 'line_failed_validation' WHEN 5 THEN 'low_confidence' ELSE '' END AS reviewer_notes, CASE WHEN k >= 5 THEN 'PENDING_REVIEW' ELSE 'NEEDS_MANUAL' END AS status,
      'A quick one for '||business AS subject, CASE WHEN k >= 5 THEN 'We noticed '||business||' sells paint.' ELSE '' END AS line FROM c""", ctes="finals")
def _(t):
    k = F.regexp_extract("source", r"(\d+)", 1).cast("int") % 8
    made = t.finals.join(t.customer.select(F.col("c_custkey").alias("candidate_id"), "c_mktsegment"), "candidate_id")
    leads = made.select(F.concat(F.lit("camp:"), "id").alias("lead_id"), F.col("c_mktsegment").alias("business_name"), F.col("source_url").alias("website"),
                            F.col("email").alias("to_email"), F.lit("").alias("other_mailboxes"), k.alias("k"))
    page = (F.when(F.col("k") == 1, F.lit("an insurance broker")).when(F.col("k") == 3, F.lit("casino"))
            .otherwise(F.concat(F.lit("Title: "), "business_name")))
    seen = leads.filter("k <> 0").select("website", page.alias("excerpt"), (F.col("k") == 2).alias("thin"))
    line = F.when(F.col("k") == 4, F.lit("Buy now")).otherwise(F.concat(F.lit("We noticed "), "business_name", F.lit(" sells paint")))
    lines = leads.select("lead_id", F.col("business_name").alias("name"), line.alias("line"), F.when(F.col("k") == 5, "low").otherwise("high").alias("confidence"))
    out = companies.draft_rows(leads.drop("k"), seen, lines)
    return out.select("lead_id", "reviewer_notes", "status", "subject", F.col("personal_line").alias("line"))


@query("rul21_sample_outcome", """SELECT pos, o AS outcome, CASE o WHEN 'candidate' THEN 2 WHEN 'rejected_relevant' THEN 1 ELSE 0 END AS priority FROM
    (SELECT pos, CASE WHEN rejected AND (product_type <> 'UNKNOWN' OR len(signals) > 0) THEN 'rejected_relevant' WHEN rejected THEN 'rejected' ELSE 'candidate' END AS o FROM scored)""", ctes="scored")
def _(t):
    outcome = decisions.normalise_outcome(F.col("rules"))
    return _scored(t).select("pos", outcome.alias("outcome"), decisions.sample_priority(outcome).alias("priority"))


# ---- rules as data, set unions ------------------------------------------------------------------

@query("src8_rules_from_table", f"SELECT pos, array_to_string(list_filter([CASE WHEN {hit('mtext', ['of the', 'in the'])} THEN 'product:MOTOR' END, CASE WHEN {hit('mtext', ['la'])} THEN 'signal:quote' END], lambda x: x IS NOT NULL),'|') AS matched FROM texts", ctes="texts")
def _(t):
    small = load_rules({"products": {"MOTOR": ["OF  THE", "in the"]}, "signals": {"quote": ["La"]}, "relevance_terms": []})
    again = rules_from_table(term_table(t.spark, small))
    rows = matching.with_matches(t.records.withColumn("match_text", text.matching_text(F.col("text"))), again)
    return rows.select("pos", _list("matched").alias("matched"))


@query("set1_contact_union", """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'a@x.com|b@x.com|c@x.com' ELSE 'a@x.com|b@x.com|d'||c_custkey||'@x.com' END AS emails,
    CASE WHEN c_nationkey % 2 = 0 THEN 'post|post|bio' ELSE 'post|post|bio' END AS places FROM customer""")
def _(t):
    one = lambda e, p: F.struct(e.alias("email"), F.lit(p).alias("source_url"))
    post = F.array(one(F.lit("a@x.com"), "post"), one(F.lit("b@x.com"), "post"))
    other = F.when(F.col("c_nationkey") % 2 == 0, F.lit("c@x.com")).otherwise(F.concat(F.lit("d"), "c_custkey", F.lit("@x.com")))
    merged = emails.merge_contacts(post, F.array(one(F.lit("b@x.com"), "bio"), one(other, "bio")))
    rows = t.customer.select("c_custkey", merged.alias("m"))
    return rows.select("c_custkey", _list(F.transform("m", lambda x: x["email"])).alias("emails"), _list(F.transform("m", lambda x: x["source_url"])).alias("places"))


@query("set2_source_union", """SELECT source, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS chars FROM (SELECT source, text FROM documents UNION ALL
    SELECT 'turns' AS source, text FROM conversations UNION ALL SELECT 'pages' AS source, url FROM pages) GROUP BY source""")
def _(t):
    parts = [to_records(t.docs.select("source", "text")), to_records(t.conversations.select(F.lit("turns").alias("source"), "text")),
             to_records(t.pages.select(F.lit("pages").alias("source"), F.col("url").alias("text")))]
    return union_sources(parts).groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("text")).alias("chars"))


