"""Driver queries over the whole chain from records to finals."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftline.catalog.common import AS_OF, EMAIL_SQL, book, query
from siftline.catalog.rules import _FACTS, mx_facts, semantic_json
from siftline.operators import decisions
from siftline.plans import funnel

_B = book()


def ran(t):
    semantic = decisions.parse_semantic(semantic_json(t)).filter("refused IS NULL").select(F.col("event_id").alias("candidate_id"), "semantic")
    claimed = t.spark.createDataFrame([], "key string")
    cache = t.spark.createDataFrame([], "email_hash string, status string, reason string, checked_at timestamp")
    return funnel.run(_records(t), _B, AS_OF, claimed, cache, mx_facts(t), semantic)


def _records(t):
    from siftline.sources.records import to_records

    return to_records(t.records)


# The contract cuts a record's text before anything else; the twin starts from the cut text as well.
_CHAIN = f"""{_FACTS}, st AS MATERIALIZED (SELECT pos, identity_hash, text AS stored_text FROM keyed QUALIFY row_number() OVER (PARTITION BY content_key ORDER BY pos) = 1),
    ca AS MATERIALIZED (SELECT r.*, st.identity_hash, st.stored_text FROM ranked r JOIN st USING (pos) WHERE NOT rejected QUALIFY row_number() OVER (PARTITION BY st.identity_hash ORDER BY pos) = 1),
    em AS MATERIALIZED (SELECT pos, any_value(email) AS email, bool_or(ok) AS ok, bool_or(tmp) AS tmp FROM (SELECT x.pos, x.email, coalesce(f.outcome='answer' AND f.exchange <> '.', false) AND d.domain <> 'mail1.example.com' AND NOT x.local='hein.19' AS ok,
        (f.outcome IS NULL OR f.outcome='timeout') AND d.domain <> 'mail1.example.com' AND NOT x.local='hein.19' AS tmp
      FROM (SELECT pos, email, split_part(email,'@',1) AS local, split_part(email,'@',2) AS domain FROM (SELECT pos, unnest(regexp_extract_all(stored_text, '{EMAIL_SQL}')) AS email FROM ca)) x
      JOIN (SELECT DISTINCT split_part(email,'@',2) AS domain FROM (SELECT unnest(regexp_extract_all(stored_text, '{EMAIL_SQL}')) AS email FROM ca)) d ON d.domain=x.domain LEFT JOIN f ON f.domain=x.domain) GROUP BY pos),
    va AS MATERIALIZED (SELECT ca.*, CASE WHEN em.pos IS NULL AND biz THEN 'NO_CONTACT' WHEN em.pos IS NULL OR em.ok THEN 'CLASSIFY' WHEN em.tmp THEN 'VALIDATE' WHEN biz THEN 'CONTACT_REVIEW' ELSE 'CLASSIFY' END AS status FROM ca LEFT JOIN em USING (pos)),
    de AS MATERIALIZED (SELECT va.*, CASE WHEN biz THEN CASE WHEN list_contains(signals,'nearby') THEN 'FINALISE' ELSE 'REJECT' END WHEN route='DIRECT_FINAL' THEN 'FINALISE' WHEN route='SEMANTIC' AND e.event_type <> 'click' THEN 'WAIT'
      WHEN route='SEMANTIC' AND user_id % 2 = 0 AND event_id % 101 >= 80 THEN 'FINALISE' WHEN route='DEFERRED' THEN 'DEFERRED' ELSE 'REJECT' END AS decision FROM va JOIN events e ON e.event_id=va.pos WHERE status='CLASSIFY')"""


@query("funnel_stage_counts", """SELECT 'stored' AS stage, '' AS state, count(*) AS n FROM st UNION ALL SELECT 'candidate', '', count(*) FROM ca UNION ALL SELECT 'validated', status, count(*) FROM va GROUP BY status
    UNION ALL SELECT 'decided', decision, count(*) FROM de GROUP BY decision""", ctes="keyed ranked", more=_CHAIN)
def _(t):
    f = ran(t)
    count = lambda df, stage, state: df.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "state", "n")
    return (count(f.records, "stored", F.lit("")).unionByName(count(f.candidates, "candidate", F.lit("")))
            .unionByName(count(f.validated, "validated", F.col("status"))).unionByName(count(f.decided, "decided", F.col("decision"))))


@query("funnel_finals", "SELECT de.pos AS candidate_id, CASE WHEN route='SEMANTIC' AND NOT biz THEN 'MOTOR' ELSE de.product_type END AS product_type, coalesce(em.email,'') AS email FROM de LEFT JOIN em ON em.pos=de.pos AND em.ok WHERE decision='FINALISE'", ctes="keyed ranked", more=_CHAIN)
def _(t):
    f = ran(t)
    return f.finals.select("candidate_id", "product_type", F.coalesce("email", F.lit("")).alias("email"))
