"""RUL-15, RUL-17, RUL-21, JN-5, JN-21: semantic results, stage decisions and sample outcomes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import digest, place_window, redact
from siftline.operators.pin import pinned
from siftline.operators.ranking import rank_route, semantic_accepted
from siftline.operators.validation import usable_contacts
from siftline.schemas import SEMANTIC

# The accepted enumerations of a semantic result and the sample priorities.
INTENTS = ["HIGH", "MEDIUM", "LOW", "NONE"]
PRODUCTS = ["MOTOR", "HOME", "CONTENTS", "LIFE", "FUNERAL", "DISABILITY", "OTHER", "UNKNOWN"]
PRIORITY = {"rejected": 0, "rejected_relevant": 1, "candidate": 2, "no_contact": 2, "contact_review": 2,
            "rejected_late": 2, "deferred": 3, "review": 3, "semantic_rejected": 3, "final": 4}


def parse_semantic(rows: DataFrame, body: str = "body", intents: list[str] | None = None,
                   products: list[str] | None = None) -> DataFrame:
    """RUL-15: adds ``semantic`` (null when refused) and ``refused`` (why)."""
    names = F.array(*[F.lit(f.name) for f in SEMANTIC.fields])
    keys = F.json_object_keys(body)
    parsed = F.from_json(F.col(body), SEMANTIC, {"mode": "PERMISSIVE"})
    staged = pinned(rows, _keys=keys, _p=parsed)
    p = F.col("_p")
    flags = [f.name for f in SEMANTIC.fields if f.dataType.typeName() == "boolean"]
    missing_flag = F.lit(False)
    for name in flags:
        missing_flag = missing_flag | p[name].isNull()
    refused = (F.when(F.col("_keys").isNull(), F.lit("not_an_object"))
               .when((F.size("_keys") != F.size(names)) | (F.size(F.array_except(F.col("_keys"), names)) > 0), F.lit("fields"))
               .when(missing_flag, F.lit("flag_type"))
               .when(~F.coalesce(p["intent_level"].isin(intents or INTENTS), F.lit(False)), F.lit("intent"))
               .when(~F.coalesce(p["product_type"].isin(products or PRODUCTS), F.lit(False)), F.lit("product"))
               .when(~F.coalesce(p["score"].between(0, 100), F.lit(False)), F.lit("score"))
               .when(~F.coalesce(F.length(p["reason"]) <= 500, F.lit(False)), F.lit("reason")))
    clean = p.withField("reason", F.left(redact(p["reason"]), F.lit(500)))
    staged = pinned(staged, refused=refused)
    return staged.withColumn("semantic", F.when(F.col("refused").isNull(), clean)).drop("_keys", "_p")


def keys_since(claimed: DataFrame, since: Column) -> DataFrame:
    """The part of the key table that a reader of the snapshot taken at ``since`` has not seen."""
    return claimed.filter(F.col("created_at") > since).select("key").distinct()


def second_look(staged: DataFrame, added: DataFrame) -> DataFrame:
    """RUL-17: what was taken since the snapshot.  Adds ``_fresh``, the usable contacts that are still free, and ``duplicate``:
    ``identity_duplicates`` or ``email_duplicates`` where the identity, or every usable address, is taken."""
    leads = added.filter(F.col("key").startswith("lead:")).select(F.substring_index("key", ":", -1).alias("identity_hash"), F.lit(True).alias("_lead")).distinct()
    each = staged.select("candidate_id", F.explode("_usable").alias("c")).select("candidate_id", F.col("c.email").alias("email"))
    each = each.select("candidate_id", "email", F.concat(F.lit("email:"), digest(F.col("email"))).alias("key"))
    # at most five contacts per candidate, so this list is bounded
    taken = each.join(added.select("key").distinct(), "key", "left_semi").groupBy("candidate_id").agg(F.collect_set("email").alias("_taken"))
    staged = staged.join(leads, "identity_hash", "left").join(taken, "candidate_id", "left")
    fresh = F.filter("_usable", lambda c: ~F.coalesce(F.array_contains("_taken", c["email"]), F.lit(False)))
    staged = staged.withColumn("_fresh", fresh)
    duplicate = (F.when(F.col("_lead"), F.lit("identity_duplicates"))
                 .when((F.size("_usable") > 0) & (F.size("_fresh") == 0), F.lit("email_duplicates")))
    return staged.withColumn("duplicate", duplicate).drop("_lead", "_taken")


def decide(candidates: DataFrame, rules: DataFrame, semantic: DataFrame, book, as_of: Column,
           semantic_expired: Column | None = None, model: DataFrame | None = None, added: DataFrame | None = None) -> DataFrame:
    """JN-5, RUL-17: decision, route and final score of every due candidate.

    ``rules`` holds ``(candidate_id, rules)``, ``semantic`` ``(candidate_id, semantic)``; a candidate whose
    result was refused or is still missing waits or goes to review.  ``added`` has the keys that were claimed since
    the validation read the key table (:func:`keys_since`): a candidate whose identity or whose last address is among them goes,
    and the rank is that on the addresses left.  A ``rank_score`` that the validation stored orders the claims.
    """
    policy = book.policy
    expired = semantic_expired if semantic_expired is not None else F.lit(False)
    business = (policy.get("business_contact") or {}).get("product_type")
    company = F.col("product_type") == F.lit(business) if business else F.lit(False)
    required = company | F.lit(bool(policy["require_contact"]))
    staged = candidates.join(rules, "candidate_id", "left").join(semantic, "candidate_id", "left")
    label = confidence = None
    if model is not None:
        staged = staged.join(model.select("candidate_id", "label", "confidence"), "candidate_id", "left")
        label, confidence = F.col("label"), F.col("confidence")
    staged = pinned(staged, _usable=usable_contacts(F.col("contacts"), as_of))
    if added is not None:
        staged = second_look(staged, added)
    else:
        staged = staged.withColumns({"_fresh": F.col("_usable"), "duplicate": F.lit(None).cast("string")})
    held = F.size("_fresh") > 0
    staged = pinned(staged, ranking=F.when(F.col("rules").isNotNull(), rank_route(F.col("rules"), held, policy, label, confidence)))
    route, accepted = F.col("ranking.route"), semantic_accepted(F.col("semantic"), policy)
    unchecked = (F.size("_usable") == 0) & ((F.size("contacts") > 0) | required)
    decision = (F.when(unchecked, F.lit("VALIDATE"))
                .when(F.col("duplicate").isNotNull(), F.lit("REJECT"))
                .when(F.col("rules").isNull(), F.lit("REVIEW"))
                .when(route == "DIRECT_FINAL", F.lit("FINALISE"))
                .when((route == "SEMANTIC") & expired, F.lit("REVIEW"))
                .when((route == "SEMANTIC") & F.col("semantic").isNull(), F.lit("WAIT"))
                .when((route == "SEMANTIC") & accepted, F.lit("FINALISE"))
                .when(route == "DEFERRED", F.lit("DEFERRED"))
                .otherwise(F.lit("REJECT")))
    judged = (route == "SEMANTIC") & F.col("semantic").isNotNull() & ~expired
    known = "rank_score" in candidates.columns
    stored_rank = F.col("rank_score") if known else F.when(F.col("rules").isNotNull(), rank_route(F.col("rules"), held, policy)["rank_score"])
    return staged.withColumns({
        "decision": decision,
        "duplicate": F.when(~unchecked, F.col("duplicate")),
        "route": route,
        # claims are ordered by what was stored before this decision, not by a model's or a semantic score
        "claim_rank": stored_rank if known or model is not None else F.col("ranking.rank_score"),
        "claim_score": F.col("score"),
        "rank_score": F.col("ranking.rank_score"),
        "score": F.when(judged, F.col("semantic.score")).otherwise(F.col("score")),
        "product_type": F.when(judged, F.col("semantic.product_type")).otherwise(F.col("product_type")),
        "contacts": F.when(unchecked, F.col("contacts")).otherwise(F.col("_fresh")),
    }).drop("_usable", "_fresh", *(["label", "confidence"] if model is not None else []))


def rebuilt_place(rows: DataFrame, terms: list[str], stored: str = "place_excerpt", evidence: str = "geography_evidence",
                  bio: str = "bio") -> DataFrame:
    """JN-21: older results without a stored place excerpt get it again from the stored bio."""
    missing = (F.col(evidence) == "profile_bio") & F.col(stored).isNull() & (F.coalesce(F.col(bio), F.lit("")) != "")
    again = place_window(F.when(missing, F.col(bio)), terms)
    return rows.withColumn(stored, F.coalesce(F.col(stored), F.when(again != "", again)))


def sample_priority(outcome: Column) -> Column:
    """RUL-21: priority 0..4 of a sample outcome."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(PRIORITY.items())])
    return F.coalesce(F.try_element_at(table, outcome), F.lit(0))


def normalise_outcome(rules: Column) -> Column:
    """RUL-21: outcome label after the rules stage."""
    seen = (rules["product_type"] != "UNKNOWN") | (F.size(rules["signals"]) > 0)
    return (F.when(rules["rejected"] & seen, F.lit("rejected_relevant")).when(rules["rejected"], F.lit("rejected"))
            .otherwise(F.lit("candidate")))
