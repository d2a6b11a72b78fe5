"""Tables of the driver queries and the SQL twins of the derived tables.

The supplied tables hold invented words, so the rules bundle here is made of words that occur in them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftline.rules import RuleBook, load_rules
from siftline.session import text_batches

AS_OF = "2024-02-01 00:00:00"

KEYWORDS = {
    "products": {"MOTOR": ["of the", "in the"], "HOME": ["de la", "der"], "CONTENTS": ["la"], "TRAVEL": ["the"]},
    "signals": {
        "asks": ["that", "to the"], "hints": ["this", "est"], "moves": ["was"], "costs": ["by"],
        "wheels": ["with"], "walls": ["sur", "mit"], "wants_agent": ["una", "is the"],
        "nearby": ["en", "thon"], "agent": ["thth the", "eau"], "trader": ["thnt the"], "vacancy": ["ther is"],
        "pitch": ["es"],
    },
    "relevance_terms": ["is", "le", "a"],
}
SCORING = {
    "weights": {"asks": 33, "hints": 28, "moves": 24, "costs": 22, "wheels": 14, "walls": 17,
                "wants_agent": 31, "nearby": 18, "agent": -55, "trader": -75, "vacancy": -45},
    "location_signal": "nearby",
    "source_weights": {"src1": 5, "src2": -5},
    "negative_signals": ["agent", "trader", "vacancy"],
    "negative_overrides": {"agent": "wants_agent"},
    "review_only_signals": ["wants_agent", "pitch"],
    "ranking": {"semantic_review": {"intent_signals": ["asks", "hints", "moves", "wants_agent"]}},
    "target_products": ["MOTOR", "HOME", "CONTENTS"],
    "business_contact": {"sources": ["src7"], "product_type": "BUSINESS_CONTACT", "max_age_days": 400, "score": 50,
                         "rank_score": 5.0, "tld": "com", "reject_signals": ["agent"], "reject_terms": ["thha", "and of"],
                         "reject_label": "trade"},
}
LOOKUPS = {
    "disposable_domains": ["mail1.example.com", "yopmail.com"], "public_suffixes": ["com", "net", "org", "example.com", "example.net"],
    "mailbox_tld": "com", "role_accounts": ["info", "sales", "hein.19"],
    "mailbox_roles": {"info": "General", "sales": "Sales", "accounts": "Accounts", "erschzu.50": "General",
                      "that.92": "Accounts", "thtion.52": "Sales", "el.00": "Administration"},
}


def book() -> RuleBook:
    return load_rules(KEYWORDS, SCORING, LOOKUPS)


class Tables:
    """The supplied tables as DataFrames, and the record tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def spread(self, df: DataFrame, *columns: str) -> DataFrame:
        """Rows of a file with fewer row groups than cores go to all cores before text work.  A table of many
        files has enough splits and is left as it is."""
        text_batches(self.spark)
        df = df.select(*columns) if columns else df
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    @property
    def log(self) -> DataFrame:
        """events with a zoned time."""
        return self.events.withColumn("ts", F.col("ts").cast("timestamp"))

    @property
    def docs(self) -> DataFrame:
        return self.spread(self.documents, "doc_id", "text", "lang", "source", "n_chars")

    @property
    def records(self) -> DataFrame:
        """documents as records: author and time come from the event with the same number."""
        seen = self.log.select(F.col("event_id").alias("doc_id"), "user_id", "ts")
        rows = self.docs.join(seen, "doc_id")
        return rows.select(
            F.col("doc_id").alias("pos"), "source", F.col("doc_id").cast("string").alias("source_record_id"),
            F.concat(F.lit("u"), "user_id").alias("identity"), "text", "lang",
            F.concat(F.lit("https://posts.example.com/"), "source", F.lit("/"), "doc_id").alias("url"), F.col("ts").alias("published_at"))

    @property
    def finals(self) -> DataFrame:
        """customers as finals: one in five without an address."""
        email = F.when(F.col("c_mktsegment") != "BUILDING", F.concat(
            F.lower("c_mktsegment"), F.lit("."), F.col("c_custkey"), F.lit("@mail"), F.col("c_nationkey"), F.lit(".example.com")))
        # Spark rounds the shortest decimal of a double; the twin rounds the double itself, so 8.495, stored a little lower, is 8.49
        cents = F.round(F.abs("c_acctbal") / 1000 * 100) / 100
        return self.customer.select(
            (F.col("c_custkey") + 1).alias("id"), F.col("c_custkey").alias("candidate_id"), email.alias("email"),
            F.sha2(F.col("c_name"), 256).alias("identity_hash"), F.concat(F.lit("src"), "c_nationkey").alias("source"),
            F.concat(F.lit("https://posts.example.com/"), "c_custkey").alias("source_url"), F.lit("").alias("email_source_url"),
            F.col("c_name").alias("excerpt"), F.when(F.col("c_mktsegment") == "AUTOMOBILE", "MOTOR").otherwise("HOME").alias("product_type"),
            F.floor(F.abs("c_acctbal") / 100).cast("int").alias("score"), cents.alias("rank_score"),
            F.when(email.isNull(), "NO_EMAIL").when(F.col("c_nationkey") == 3, "SYNTHETIC_TEST").otherwise("DELIVERABLE_DOMAIN").alias("validation_status"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("c_custkey")).alias("created_at"),
            F.struct(F.col("c_name").alias("display_name"), F.lit("Thandi").alias("first_name"), (F.col("c_nationkey") % 2 == 0).alias("name_reliable"),
                     F.lit("operator_verified").alias("name_source"), F.lit("").alias("username"),
                     F.when(F.col("c_nationkey") == 4, "Shop").otherwise("").alias("business_name"),
                     F.struct(F.when(F.col("c_nationkey") == 5, "near the sea").alias("excerpt"), F.lit("https://p.example.com").alias("source_url")).alias("geography"),
                     ).alias("profile"))


# ---- SQL side -----------------------------------------------------------------------------------

def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canon(x: str) -> str:
    return f"replace(lower(trim(regexp_replace(coalesce({x},''),'\\s+',' ','g'))),'ß','ss')"


def digest(x: str) -> str:
    return f"sha256({canon(x)})"


def hit(x: str, terms: list[str]) -> str:
    body = "|".join(re.sub(r"([.+*?()\[\]{}|^$\\])", r"\\\1", t) for t in terms)
    pattern = r"(?:^|[^\p{L}\p{N}_])(?:" + body + r")(?:$|[^\p{L}\p{N}_])"
    return f"regexp_matches({x}, {quote(pattern)})"


def compact(items: list[str]) -> str:
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def listed(names) -> str:
    return "[" + ", ".join(quote(n) for n in names) + "]"


EMAIL_SQL = r"[a-zA-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,63}"
SQL_AS_OF = f"epoch_us(TIMESTAMP {quote(AS_OF)})"


def redact_sql(x: str) -> str:
    x = f"regexp_replace({x}, '{EMAIL_SQL}', '[EMAIL]', 'g')"
    x = f"regexp_replace({x}, 'https?://\\S+', '[URL]', 'g')"
    x = f"regexp_replace({x}, '(^|[^\\p{{L}}\\p{{N}}_])@[\\p{{L}}\\p{{N}}_]+', '\\1[HANDLE]', 'g')"
    x = f"regexp_replace({x}, '(^|[^\\p{{L}}\\p{{N}}_])\\+?\\d[\\d\\s().-]{{7,}}\\d', '\\1[PHONE]', 'g')"
    return x


_B = book()
_P = _B.policy
_BIZ = _P["business_contact"]


def _signals() -> str:
    return compact([f"CASE WHEN {hit('mtext', t)} THEN {quote(n)} END" for n, t in _B.signals.items()])


def _score() -> str:
    parts = [f"CASE WHEN list_contains(signals,{quote(n)}) AND NOT list_contains(cancelled,{quote(n)}) THEN {w} ELSE 0 END"
             for n, w in _P["weights"].items()]
    parts += [f"CASE WHEN source={quote(n)} THEN {w} ELSE 0 END" for n, w in _P["source_weights"].items()]
    return f"CAST(least(100, greatest(0, {' + '.join(parts)})) AS INTEGER)"


def _rank_value(contact: str) -> str:
    r = _P["ranking"]
    return (f"round(least(10.0, greatest(0.0, score/10.0*{r['rules_weight']} + {contact} + "
            f"CASE WHEN on_target THEN 1.0 ELSE 0.0 END + CASE WHEN placed THEN 1.0 ELSE 0.0 END)),3)")


_DAYS = f"(({SQL_AS_OF} - epoch_us(published_at))/86400e6)"
_INTENTS = listed(_P["ranking"]["semantic_review"]["intent_signals"])

CTES = {
    "records": ([], """SELECT d.doc_id AS pos, d.source, CAST(d.doc_id AS VARCHAR) AS source_record_id, 'u'||e.user_id AS identity,
        d.text, d.lang, 'https://posts.example.com/'||d.source||'/'||d.doc_id AS url, e.ts AS published_at
        FROM documents d JOIN events e ON d.doc_id = e.event_id"""),
    "keyed": (["records"], f"""SELECT *, 'record:'||{digest("source||':'||source_record_id")} AS record_key,
        'content:'||{digest('text')} AS content_key, {digest("source||':'||identity")} AS identity_hash FROM
        (SELECT * REPLACE ({canon('text')} AS text) FROM records)"""),
    "texts": (["records"], f"SELECT *, translate({canon('text')}, '‘’‛ʼ', '''''''''') AS mtext FROM records"),
    "matched": (["texts"], f"""SELECT *, {compact([f"CASE WHEN {hit('mtext', t)} THEN {quote(n)} END" for n, t in _B.products.items()])} AS products,
        {_signals()} AS posted, {hit('mtext', _B.relevance)} AS relevance FROM texts"""),
    "signalled": (["matched"], f"""SELECT *, posted AS signals, coalesce(products[1],'UNKNOWN') AS product,
        {compact([f"CASE WHEN list_contains(posted,{quote(n)}) AND list_contains(posted,{quote(o)}) THEN {quote(n)} END" for n, o in _P['negative_overrides'].items()])} AS cancelled
        FROM matched"""),
    "consumer": (["signalled"], f"""SELECT *, {_score()} AS score,
        len(list_filter(signals, lambda s: list_contains({listed(_P['negative_signals'])}, s) AND NOT list_contains(cancelled, s))) > 0 AS negative,
        list_sort(list_distinct(list_concat(cancelled, list_filter(signals, lambda s: list_contains({listed(_P['review_only_signals'])}, s))))) AS conflicting
        FROM signalled"""),
    "scored": (["consumer"], f"""SELECT pos, source, identity, url, text, mtext, published_at,
        CASE WHEN biz THEN {_BIZ['score']} ELSE score END AS score,
        CASE WHEN biz THEN 'BUSINESS_CONTACT' ELSE product END AS product_type,
        CASE WHEN biz THEN list_concat(list_concat(['business_contact'], CASE WHEN national THEN ['nearby'] ELSE [] END), hits) ELSE signals END AS signals,
        CASE WHEN biz THEN len(hits) > 0 OR NOT national OR {_DAYS} > {_BIZ['max_age_days']} OR {_DAYS} < -1
          ELSE (product='UNKNOWN' AND NOT relevance) OR negative OR {_DAYS} > {_P['max_age_days']} OR {_DAYS} < -1 OR score < {_P['discard_below']} END AS rejected,
        CASE WHEN biz THEN false ELSE score >= {_P['accept_without_llm_above']} AND product <> 'UNKNOWN' AND list_contains(signals,'nearby') END AS confident,
        CASE WHEN biz THEN CASE WHEN national THEN 'email_domain' END WHEN list_contains(signals,'nearby') THEN 'post' END AS geography_evidence,
        CASE WHEN biz THEN [] ELSE conflicting END AS conflicting_signals
        FROM (SELECT *, source='src7' AS biz, regexp_matches(mtext,'@[a-z0-9.-]+\\.com(?:[^\\p{{L}}\\p{{N}}_.-]|$)') AS national,
          {compact(["CASE WHEN list_contains(signals,'agent') THEN 'agent' END", f"CASE WHEN {hit('mtext', _BIZ['reject_terms'])} THEN 'trade' END"])} AS hits FROM consumer)"""),
    "gated": (["scored"], f"""SELECT *, product_type IN ('MOTOR','HOME','CONTENTS') AS on_target, list_contains(signals,'nearby') AS placed,
        product_type='BUSINESS_CONTACT' AS biz FROM scored"""),
    "valued": (["gated"], f"SELECT *, {_rank_value('1.0')} AS value FROM gated"),
    "ranked": (["valued"], f"""SELECT *, CASE WHEN biz THEN 5.0 ELSE value END AS rank_score,
        CASE WHEN biz THEN 'REJECT'
          WHEN reviewable AND value < 8.0 THEN 'SEMANTIC' WHEN rejected OR value < 6.0 THEN 'REJECT'
          WHEN value >= 9.5 AND on_target AND placed AND len(conflicting_signals)=0 THEN 'DIRECT_FINAL'
          WHEN value >= 8.0 THEN 'SEMANTIC' ELSE 'DEFERRED' END AS route,
        NOT biz AND reviewable AND value < 8.0 AS review_route
        FROM (SELECT *, NOT rejected AND on_target AND placed AND list_has_any(signals, {_INTENTS}) AS reviewable FROM valued)"""),
    "finals": ([], """SELECT c_custkey+1 AS id, c_custkey AS candidate_id,
        CASE WHEN c_mktsegment <> 'BUILDING' THEN lower(c_mktsegment)||'.'||c_custkey||'@mail'||c_nationkey||'.example.com' END AS email,
        sha256(c_name) AS identity_hash, 'src'||c_nationkey AS source, 'https://posts.example.com/'||c_custkey AS source_url, '' AS email_source_url,
        c_name AS excerpt, CASE WHEN c_mktsegment='AUTOMOBILE' THEN 'MOTOR' ELSE 'HOME' END AS product_type,
        CAST(floor(abs(c_acctbal)/100) AS INTEGER) AS score, round(abs(c_acctbal)/1000,2) AS rank_score,
        CASE WHEN c_mktsegment='BUILDING' THEN 'NO_EMAIL' WHEN c_nationkey=3 THEN 'SYNTHETIC_TEST' ELSE 'DELIVERABLE_DOMAIN' END AS validation_status,
        TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS created_at, c_nationkey, c_mktsegment FROM customer"""),
    "bucketed": (["finals"], """SELECT *, CASE WHEN email IS NULL THEN 'PROSPECTS' WHEN regexp_matches(left(email,1),'^[a-z]$') THEN upper(left(email,1)) ELSE 'OTHER' END AS bucket FROM finals"""),
    "placed": (["bucketed"], """SELECT *, CASE WHEN bucket='PROSPECTS' THEN 'PROSPECTS_' ELSE 'VALIDATED_'||bucket||'_' END || printf('%03d', (position // 100)+1) AS tab,
        CAST(position % 100 + 2 AS INTEGER) AS row FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY id) - 1 AS position FROM bucketed)"""),
}


def with_ctes(names: str, select: str, more: str = "") -> str:
    """``WITH`` clause of the named derived tables and all they need, followed by ``select``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        visit(name)
    tables = [f"{n} AS MATERIALIZED ({CTES[n][1]})" for n in order] + ([more] if more else [])
    head = "WITH " + ",\n".join(tables)
    # a twin that brings its own tables continues the same clause
    return head + ",\n" + select[5:] if select.startswith("WITH ") else head + "\n" + select


# ---- registry -----------------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = "", more: str = ""):
    """Registers ``fn(tables)`` under ``name`` with its SQL twin."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = with_ctes(ctes, sql, more) if ctes else sql
        return fn

    return register
