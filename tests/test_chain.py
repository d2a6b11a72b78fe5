"""The funnel over fourteen records with every way to fail, and plans that must keep their shape."""

from datetime import datetime

from bundle import book
from pyspark.sql import functions as F

from siftline.operators.keys import positions
from siftline.plans import funnel
from siftline.sources import captures
from siftline.sources.records import to_records

STRONG = "Need a quote for {what} in {place}, premium increased, changing insurer. {mail}"
ROWS = [
    ("motor", STRONG.format(what="car insurance", place="Johannesburg", mail="ann@good.org")),
    ("home", "Need a quote and can you recommend home insurance in Cape Town, changing insurer. home@good.org"),
    ("broker", "Insurance broker here, write me about insurance in Johannesburg sell@good.org"),
    ("job", "Hiring for an insurance job in Johannesburg jobs@good.org"),
    ("news", "Insurance press release in Johannesburg news@good.org"),
    ("weak", "Heard about insurance yesterday in Johannesburg"),
    ("repeat", "Need car insurance in Johannesburg; premium increased. again@good.org"),
    ("repeat", "Need a quote for vehicle insurance in Johannesburg. other@good.org"),
    ("same-a", STRONG.format(what="car insurance", place="Johannesburg", mail="shared@good.org")),
    ("same-b", STRONG.format(what="home insurance", place="Cape Town", mail="shared@good.org")),
    ("bad-mail", STRONG.format(what="car insurance", place="Johannesburg", mail="person@@bad")),
    ("no-mx", STRONG.format(what="contents insurance", place="Pretoria", mail="person@none.org")),
    ("irrelevant", "Lovely weather and football today"),
    ("unsure", "Car insurance in Durban is too expensive, thoughts? unsure@good.org"),
]


def run(spark, claimed, answered=14):
    rows = spark.createDataFrame([(i, "posts", str(i), who, text, f"https://x.example.org/{i}", datetime(2024, 1, 31)) for i, (who, text) in enumerate(ROWS)],
                                 "pos long, source string, source_record_id string, identity string, text string, url string, published_at timestamp")
    yes = ('{"is_insurance_relevant":true,"is_consumer":true,"is_advertisement":false,"is_broker_or_agent":false,"south_africa_signal":true,"intent_level":"HIGH",'
           '"product_type":"MOTOR","score":90,"reason":"asks"}')
    from siftline.operators.decisions import parse_semantic

    semantic = parse_semantic(spark.range(answered).select(F.col("id").alias("candidate_id"), F.lit(yes).alias("body"))).select("candidate_id", "semantic")
    cache = spark.createDataFrame([], "email_hash string, status string, reason string, checked_at timestamp")
    mx = spark.createDataFrame([("good.org", "answer", "mx.good.org."), ("none.org", "no_answer", None)], "domain string, outcome string, exchange string")
    return funnel.run(to_records(rows), book(require_contact=True), "2024-02-01 00:00:00", claimed, cache, mx, semantic)


def test_funnel_and_replay(spark):
    out = run(spark, spark.createDataFrame([], "key string"))
    finals = {r.email for r in out.finals.collect()}
    assert len(finals) == 4 and {"ann@good.org", "home@good.org", "again@good.org", "shared@good.org"} == finals
    left = {r.status for r in out.validated.filter("status <> 'CLASSIFY'").collect()}
    assert left == {"NO_CONTACT", "CONTACT_REVIEW"} and out.validated.filter("status <> 'CLASSIFY'").count() == 2
    assert "unsure@good.org" not in finals
    keys = funnel.claimed_after(out)
    assert keys.filter("key LIKE 'email:%'").count() == 4 and keys.filter("key LIKE 'lead:%'").count() == 4
    again = run(spark, keys)
    assert again.records.count() == 0 and again.finals.count() == 0


def test_a_waiting_identity_is_not_admitted_again(spark):
    first = run(spark, spark.createDataFrame([], "key string"), answered=0)
    waiting = {r.identity_hash for r in first.decided.filter("decision = 'WAIT'").collect()}
    assert waiting
    keys = funnel.claimed_after(first).filter("key LIKE 'candidate:%'")
    refused = {r.identity_hash for r in first.decided.filter("decision = 'REJECT'").collect()}
    again = {r.identity_hash for r in run(spark, keys, answered=0).candidates.collect()}
    assert not waiting & again and refused <= again


def test_claims_follow_the_stored_score(spark):
    """A higher semantic score of a younger candidate does not take an address from an older one."""
    from siftline.operators.admission import finalise

    contact = [("x@good.org", "u")]
    rows = spark.createDataFrame([(1, "a", 6.5, 82, 6.5, 50, 1, contact), (2, "b", 6.5, 95, 6.5, 50, 2, contact)],
                                 "candidate_id long, identity_hash string, rank_score double, score int, claim_rank double, claim_score int, created_at long,"
                                 " contacts array<struct<email:string,source_url:string>>")
    won = finalise(rows, spark.createDataFrame([], "key string"), F.lit(True)).collect()
    assert [r.candidate_id for r in won] == [1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_needs_no_shuffle_and_one_match(spark):
    rows = spark.range(10).select(F.col("id").alias("pos"), F.lit("posts").alias("source"), F.col("id").cast("string").alias("text"), F.current_timestamp().alias("published_at"))
    out = funnel.score_and_route(rows, book(), "2024-02-01 00:00:00").filter("NOT rules.rejected").select("pos", "ranking.route")
    plan = plan_of(out)
    assert "Exchange" not in plan and plan.count("regexp_extract_all") == 1


def test_key_range_reaches_the_scan(spark):
    from siftline.session import fresh_path

    path = fresh_path(spark, "index")
    index = spark.range(100).select(F.concat(F.lit("za,"), "id").alias("surt"), F.lit("u").alias("url"))
    other = spark.range(1000).select(F.concat(F.lit("com,"), F.lpad("id", 4, "0")).alias("surt"), F.lit("u").alias("url"))
    captures.write_index(index.unionByName(other), path, 100)
    found = captures.key_range(spark, path, "za")
    plan = plan_of(found.select("surt"))
    assert "GreaterThanOrEqual(surt,za,)" in plan and "LessThan(surt,za-)" in plan and "url" not in plan.split("ReadSchema")[1]
    assert found.count() == 100 and captures.key_range(spark, path, "com").count() == 1000 and captures.key_range(spark, path, "net").count() == 0
    files = spark.read.parquet(f"{path}/captures").inputFiles()
    assert len(files) >= 10 and 1 <= len(found.inputFiles()) <= 3
    captures.write_index(index.limit(0), f"{path}-empty")
    assert captures.key_range(spark, f"{path}-empty", "za").count() == 0


def test_positions_never_bring_all_rows_to_one_task(spark, monkeypatch):
    """Rows are numbered inside sampled ranges and written; only a row per piece meets in one place."""
    from siftline.operators import keys

    written, durable = {}, keys.durable

    def kept(df, name):
        written[name] = (plan_of(df), durable(df, name))
        return written[name][1]

    monkeypatch.setattr(keys, "durable", kept)
    out = positions(spark.range(1000).withColumnRenamed("id", "k"), "k", pieces=8)
    assert "SinglePartition" not in plan_of(out) and "SinglePartition" not in written["numbered"][0] and "rangepartitioning" in written["numbered"][0]
    assert written["offsets"][1].count() == 8
    sizes = [r["count"] for r in written["numbered"][1].groupBy(F.shiftright("_pos_at", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 300


def test_results_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(i, f"s{i % 3}", t, datetime(2024, 1, 31)) for i, (_, t) in enumerate(ROWS)], "pos long, source string, text string, published_at timestamp")
    route = lambda n: sorted(map(tuple, funnel.score_and_route(rows.repartition(n), book(), "2024-02-01 00:00:00").select("pos", "ranking.route", "ranking.rank_score").collect()))
    assert route(1) == route(7)


def test_keys_taken_meanwhile_are_seen_before_the_decision(spark):
    from siftline.operators import decisions

    first = run(spark, spark.createDataFrame([], "key string"))
    due = first.validated.filter("status = 'CLASSIFY'")
    assert due.filter("rank_score > 0").count() == due.count()  # stored by the validation
    rules = first.candidates.select("candidate_id", "rules")
    none = spark.createDataFrame([], first.decided.select("candidate_id", "semantic").schema)
    moment = F.lit("2024-02-01 00:00:00").cast("timestamp")
    look = lambda added: {r.candidate_id: r for r in decisions.decide(due, rules, none, book(require_contact=True), moment, added=added).collect()}
    before = look(spark.createDataFrame([], "key string"))
    mailed = due.select("candidate_id", F.explode("contacts.email").alias("e")).orderBy("candidate_id").first()
    led = due.filter(F.col("candidate_id") != mailed.candidate_id).orderBy(F.desc("candidate_id")).first()
    from siftline.functions.text import digest

    table = spark.createDataFrame([(mailed.e,)], "e string").select(F.concat(F.lit("email:"), digest(F.col("e"))).alias("key"), F.lit("2024-01-31").cast("timestamp").alias("created_at"))
    table = table.unionByName(spark.createDataFrame([("lead:" + led.identity_hash,)], "key string").withColumn("created_at", F.lit("2024-01-31").cast("timestamp")))
    seen = look(decisions.keys_since(table, F.lit("2024-01-30").cast("timestamp")))
    assert (seen[mailed.candidate_id].decision, seen[mailed.candidate_id].duplicate, seen[mailed.candidate_id].contacts) == ("REJECT", "email_duplicates", [])
    assert (seen[led.candidate_id].decision, seen[led.candidate_id].duplicate) == ("REJECT", "identity_duplicates")
    others = [i for i in before if i not in (mailed.candidate_id, led.candidate_id) and mailed.e not in [c.email for c in before[i].contacts]]
    assert others and all(seen[i].decision == before[i].decision != "REJECT" or before[i].decision == "REJECT" for i in others)
    old = look(decisions.keys_since(table, F.lit("2024-02-01").cast("timestamp")))  # the snapshot had them already
    assert {i: r.decision for i, r in old.items()} == {i: r.decision for i, r in before.items()}
    # an address that is left decides with the rank on what is left
    two = due.filter(F.col("candidate_id") == mailed.candidate_id).withColumn("contacts", F.concat("contacts", F.transform("contacts", lambda c: c.withField("email", F.lit("second@good.org")))))
    left = decisions.decide(two, rules, none, book(require_contact=True), moment, added=decisions.keys_since(table, F.lit("2024-01-30").cast("timestamp"))).first()
    assert [c.email for c in left.contacts] == ["second@good.org"] and left.duplicate is None and left.decision == before[mailed.candidate_id].decision
