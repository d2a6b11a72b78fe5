from datetime import datetime, timedelta

import pytest
from bundle import book
from pyspark.sql import functions as F

from siftline.functions.text import matching_text
from siftline.operators import decisions, matching, ranking, scoring, validation
from siftline.rules import load_rules, rules_from_table, term_table

NOW = datetime(2024, 2, 1)


def judge(spark, rows, rules=None, contact=True, ml=None):
    rules = rules or book()
    rows = [r if isinstance(r, tuple) else (r,) for r in rows]
    full = [(i, r[0], r[1] if len(r) > 1 else "bluesky", r[2] if len(r) > 2 else NOW, r[3] if len(r) > 3 else "") for i, r in enumerate(rows)]
    df = spark.createDataFrame(full, "i int, text string, source string, published_at timestamp, bio string")
    out = scoring.rules_result(df, rules, "2024-02-01 00:00:00")
    label, confidence = (F.lit(ml[0]), F.lit(ml[1])) if ml else (None, None)
    out = out.withColumn("r", ranking.rank_route(F.col("rules"), F.lit(contact), rules.policy, label, confidence))
    return out.orderBy("i").select("rules", "r").collect()


def test_request_with_place_in_bio(spark):
    row, = judge(spark, [("Need a quote for car insurance", "bluesky", NOW, "Living in Cape Town")])
    assert row.rules.signals == ["quote", "south_africa"] and row.rules.geography_evidence == "profile_bio"
    assert row.rules.score == 50 and row.rules.geography_excerpt == "living in cape town"
    assert (row.r.rank_score, row.r.route, row.r.review_route) == (6.5, "SEMANTIC", True)


def test_place_in_post_wins_over_bio(spark):
    row, = judge(spark, [("Need a quote for car insurance in Durban", "bluesky", NOW, "Cape Town")])
    assert row.rules.geography_evidence == "post" and row.rules.geography_excerpt is None and row.rules.score == 50


def test_consumer_asking_for_a_broker_is_kept_but_conflicting(spark):
    row, = judge(spark, [("Looking for a broker, need a quote for car insurance in Durban, premium increased, changing insurer, can you recommend")])
    assert not row.rules.rejected and row.rules.conflicting_signals == ["broker", "broker_request"]
    assert row.r.route == "SEMANTIC"


def test_seller_with_curly_apostrophe_is_rejected(spark):
    row, = judge(spark, [("I’m a broker, looking for a broker? car insurance in Durban")])
    assert "seller" in row.rules.signals and row.rules.rejected and row.r.route == "REJECT"


def test_age_limits(spark):
    text = "Need a quote for car insurance in Durban"
    old, fresh, ahead, far = judge(spark, [(text, "x", NOW - timedelta(days=60)), (text, "x", NOW - timedelta(days=30)), (text, "x", NOW + timedelta(hours=23)),
                                           (text, "x", NOW + timedelta(days=2))])
    assert [r.rules.rejected for r in (old, fresh, ahead, far)] == [True, False, False, True]
    assert old.r.route == "REJECT"


@pytest.mark.parametrize("score, route", [(20, "REJECT"), (50, "DEFERRED"), (80, "SEMANTIC"), (100, "DIRECT_FINAL")])
def test_routes_by_score(spark, score, route):
    rules = book()
    row = spark.range(1).select(F.struct(
        F.lit(score).alias("score"), F.lit("MOTOR").alias("product_type"), F.array(F.lit("premium"), F.lit("south_africa")).alias("signals"), F.lit(score < 25).alias("rejected"),
        F.array().cast("array<string>").alias("conflicting_signals"), F.lit("rules-v4").alias("version")).alias("rules"))
    rank = lambda df, *ml: df.select(ranking.rank_route(F.col("rules"), F.lit(True), rules.policy, *ml).alias("r")).first().r
    assert rank(row).route == route
    assert rank(row, F.lit("NEWS"), F.lit(0.9)).route == "REJECT"
    assert rank(row, F.lit("NEWS"), F.lit(0.5)).route == route
    old = row.withColumn("rules", F.col("rules").withField("version", F.lit("rules-v3")))
    assert rank(old).route == ("SEMANTIC" if score == 100 else route)


def test_missing_contact_needs_review_only_when_required(spark):
    line = ("Need a quote for car insurance in Durban, premium increased, changing insurer, can you recommend",)
    free, = judge(spark, [line], contact=False)
    strict, = judge(spark, [line], book(require_contact=True), contact=False)
    assert free.r.hard_gates.contact and free.r.route == "DIRECT_FINAL"
    assert not strict.r.hard_gates.contact and strict.r.route == "CONTACT_REVIEW"


def test_business_records(spark):
    good, trade, foreign = judge(spark, [("Business website x. Published contact: info@shop.co.za", "commoncrawl"),
                                         ("Business website (Acme brokers). Published contact: info@shop.co.za", "commoncrawl"),
                                         ("Business website x. Published contact: info@shop.com", "commoncrawl")])
    assert good.rules.signals == ["business_contact", "south_africa"] and good.r.route == "DIRECT_FINAL" and good.r.rank_score == 5.0
    assert trade.rules.rejected and "insurance_trade" in trade.rules.signals and trade.r.route == "REJECT"
    assert foreign.rules.rejected and foreign.rules.geography_evidence is None


def test_join_form_equals_expression_form(spark):
    rules = book()
    texts = ["need a quote for car insurance", "press release: contents insurance", "cars insurance", "car  insurance", "nothing", "broker broker, hiring", "car, insurance"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, match_text string")
    a = {r.i: r.matched for r in matching.with_matches(df, rules).collect() if r.matched}
    joined = matching.match_by_join(df, term_table(spark, rules).filter(~F.col("term").contains("'")), "i")
    assert a == {r.i: r.matched for r in joined.collect()}


def test_bundle_round_trip(spark):
    rules = book()
    again = rules_from_table(term_table(spark, rules))
    assert list(again.groups()) == list(rules.groups()) and again.groups()["product:MOTOR"] == ["car insurance", "vehicle insurance"]
    assert load_rules({"products": {}, "signals": {}}, {"require_south_africa": False}).policy["require_location"] is False


@pytest.mark.parametrize("email, status", [("bad", "INVALID"), ("x@mailinator.com", "RISKY"), ("x@sub.mailinator.com", "RISKY"), ("info@good.org", "RISKY"), ("x@gone.org", "NO_DOMAIN"),
                                           ("x@none.org", "NO_MX"), ("x@null.org", "NO_MX"), ("x@good.org", "DELIVERABLE_DOMAIN"), ("x@slow.org", "RISKY"), ("x@unknown.org", "RISKY")])
def test_contact_verdicts(spark, email, status):
    mx = spark.createDataFrame([("good.org", "answer", "mx.good.org."), ("null.org", "answer", "."), ("gone.org", "nxdomain", None), ("none.org", "no_answer", None), ("slow.org", "timeout", None)],
                               "domain string, outcome string, exchange string")
    row = spark.createDataFrame([(email,)], "email string")
    assert validation.contact_verdicts(row, mx, book().lookups).first().status == status


def test_semantic_results_are_parsed_strictly(spark):
    good = ('{"is_insurance_relevant":true,"is_consumer":true,"is_advertisement":false,"is_broker_or_agent":false,"south_africa_signal":true,'
            '"intent_level":"HIGH","product_type":"MOTOR","score":90,"reason":"asks"}')
    bodies = [good, good.replace("90", "101"), good.replace('"HIGH"', '"VERY"'), good.replace('"is_consumer":true', '"is_consumer":"true"'), good[:-1] + ',"x":1}', "[]", "nope",
              good.replace('"asks"', '"' + "a" * 501 + '"')]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    out = [r.refused for r in decisions.parse_semantic(df).orderBy("i").collect()]
    assert out == [None, "score", "intent", "flag_type", "fields", "not_an_object", "not_an_object", "reason"]


def test_join_form_finds_terms_with_punctuation(spark):
    terms = ["i'm a broker", "e-mail", "c++", "cover", "co.za", "???", "a  b", "\\\\e x"]
    texts = ["so i'm a broker, yes", "im a broker", "send e-mail", "e mail", "ae-mails", "c++ and cover", "c+", "shop.co.za", "what ???", "a  b", "a b", "by \\\\e x", "e x"]
    table = spark.createDataFrame([(t, i, t) for i, t in enumerate(terms)], "grp string, ord int, term string")
    df = spark.createDataFrame(list(enumerate(texts)), "i int, match_text string")
    got = {r.i: r.matched for r in matching.match_by_join(df, table, "i").collect()}
    assert got == {0: ["i'm a broker"], 2: ["e-mail"], 5: ["c++", "cover"], 7: ["co.za"], 8: ["???"], 9: ["a  b"], 11: ["\\\\e x"]}


def test_a_text_is_joined_by_its_words_however_long_the_terms(spark):
    long = " ".join(f"w{i}" for i in range(40))
    texts = [(0, f"the {long} end"), (1, long.replace("w7 ", "w7  ")), (2, "the end of the end"), (3, "the"), (4, None), (5, "")]
    df = spark.createDataFrame(texts, "i int, match_text string")
    table = spark.createDataFrame([("long", 0, long), ("end", 1, "the end"), ("none", 2, "the nowhere"), ("end", 3, "end of the")], "grp string, ord int, term string")
    got = {r.i: r.matched for r in matching.match_by_join(df, table, "i").collect()}
    assert got == {0: ["long"], 2: ["end", "end"]}
    listed = {r.term: r["_word"] for r in matching.anchors(df, table, "match_text", True).collect()}
    assert listed.keys() == {long, "the end", "end of the"} and listed["the end"] == "end" and listed["end of the"] == "of"
    assert matching.match_by_join(df.limit(0), table, "i").count() == 0 and matching.match_by_join(df, table.limit(0), "i").count() == 0


def test_every_phrase_of_a_benchmark_text_is_looked_for(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(1, "one two three, four one two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    turns = [(1, 0, "u", "so three four then one two one two"), (1, 1, "u", "two one"), (2, 0, "u", "One  two three")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = entry.queries()["rul1_phrases_of_benchmark"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.turn, r.hits) for r in rows) == [(1, 0, 2), (2, 0, 2)]
