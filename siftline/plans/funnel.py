"""The chain from records to finals as one job over tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.emails import contacts, merge_contacts
from siftline.functions.profile import profile
from siftline.functions.text import redact, text_or_empty
from siftline.operators.admission import admit, finalise, first_identities, stored, with_known_contacts, with_record_keys
from siftline.operators.decisions import decide
from siftline.operators.pin import pinned
from siftline.operators.ranking import rank_route
from siftline.operators.scoring import rules_result
from siftline.operators.validation import checked_contacts, validation_stage
from siftline.session import durable


@dataclass
class Funnel:
    records: DataFrame
    scored: DataFrame
    candidates: DataFrame
    validated: DataFrame
    decided: DataFrame
    finals: DataFrame


def score_and_route(records: DataFrame, book, as_of) -> DataFrame:
    """Records with ``rules`` and ``ranking`` structs; no shuffle, one scan."""
    scored = rules_result(records, book, as_of, bio="bio" if "bio" in records.columns else None)
    return pinned(scored, ranking=rank_route(F.col("rules"), F.lit(False), book.policy))


def to_candidates(records: DataFrame, book, as_of, claimed: DataFrame, order: str = "pos") -> DataFrame:
    """Qualified records with contacts, one per identity, as candidates."""
    scored = rules_result(records, book, as_of).filter(~F.col("rules.rejected"))
    own = contacts(F.col("text"), F.col("url"))
    bio_url = F.when(text_or_empty(F.col("profile_url")) != "", F.col("profile_url")).otherwise(F.col("url"))
    scored = pinned(scored, _own=own, _bio=contacts(F.col("bio"), bio_url))
    scored = pinned(scored, contacts=merge_contacts(F.col("_own"), F.col("_bio"))).drop("_own", "_bio")
    # the texts are scored once; the joins below read the written result
    scored = durable(scored, "qualified")
    fresh = with_known_contacts(scored, claimed, order).filter(~F.col("all_known")).drop("all_known")
    firsts = first_identities(fresh, claimed, order)
    place = F.when(F.col("rules.geography_evidence") == "profile_bio", F.struct(
        F.lit("profile_bio").alias("provenance"), F.col("rules.geography_excerpt").alias("excerpt"), bio_url.alias("source_url")))
    return firsts.select(
        F.col(order).alias("candidate_id"), F.col("record_key").alias("record_id"), "source", F.col("url").alias("source_url"),
        "identity_hash", redact(F.col("text")).alias("excerpt"), "contacts", profile().withField("geography", place).alias("profile"),
        F.col("rules.product_type").alias("product_type"), F.col("rules.score").alias("score"), F.lit("VALIDATE").alias("status"),
        F.lit(0).alias("attempts"), F.lit(as_of).cast("timestamp").alias("available_at"), F.col("published_at").alias("created_at"), "rules")


def run(records: DataFrame, book, as_of, claimed: DataFrame, cache: DataFrame, mx: DataFrame, semantic: DataFrame,
        order: str = "pos", max_attempts: int = 5, added: DataFrame | None = None) -> Funnel:
    """Admission, rules, contacts, validation, decision and final claims for one batch of records.

    ``added`` has the keys that others claimed after ``claimed`` was read; it is looked at again before the decision.
    """
    moment: Column = F.lit(as_of).cast("timestamp")
    keyed = with_record_keys(records)
    keyed = durable(keyed, "records")
    admitted = durable(stored(keyed, admit(keyed, claimed, order), order), "stored")
    candidates = durable(to_candidates(admitted, book, as_of, claimed, order), "candidates")
    rules = candidates.select("candidate_id", "rules")
    waiting = candidates.drop("rules")
    checked = checked_contacts(waiting, claimed, cache, mx, book, moment)
    validated = durable(validation_stage(waiting, checked, book, moment, max_attempts, rules), "validated")
    due = validated.filter(F.col("status") == "CLASSIFY")
    decided = durable(decide(due, rules, semantic, book, moment, added=added), "decided")
    chosen = decided.filter(F.col("decision") == "FINALISE")
    business = (book.policy.get("business_contact") or {}).get("product_type")
    required = (F.col("product_type") == F.lit(business)) | F.lit(bool(book.policy["require_contact"])) if business else F.lit(
        bool(book.policy["require_contact"]))
    taken = claimed.select("key") if added is None else claimed.select("key").unionByName(added.select("key"))
    won = finalise(chosen, taken, required)
    finals = chosen.drop("contacts").join(won, "candidate_id").withColumn(
        "validation_status", F.when(F.col("email").isNull(), "NO_EMAIL").otherwise("DELIVERABLE_DOMAIN"))
    finals = finals.withColumn("email_source_url", F.coalesce("email_source_url", "profile.profile_url"))
    return Funnel(admitted, keyed, candidates, validated, decided, finals)


def open_identities(funnel: Funnel) -> DataFrame:
    """JN-4: identity keys of the candidates that were not rejected; an expiry releases them with ``released_keys``."""
    refused = funnel.validated.filter(F.col("status") == "REJECTED").select("candidate_id")
    refused = refused.unionByName(funnel.decided.filter(F.col("decision") == "REJECT").select("candidate_id"))
    lost = funnel.decided.filter(F.col("decision") == "FINALISE").select("candidate_id").join(funnel.finals.select("candidate_id"), "candidate_id", "left_anti")
    held = funnel.candidates.select("candidate_id", "identity_hash").join(refused.unionByName(lost), "candidate_id", "left_anti")
    return held.select(F.concat(F.lit("candidate:"), "identity_hash").alias("key"))


def claimed_after(funnel: Funnel) -> DataFrame:
    """Keys a run adds: record and content of stored records, e-mail and lead of finals, and open identities."""
    first = funnel.records.select(F.explode(F.array("record_key", "content_key")).alias("key"))
    mail = funnel.finals.filter("email_hash IS NOT NULL").select(F.concat(F.lit("email:"), "email_hash").alias("key"))
    lead = funnel.finals.select(F.concat(F.lit("lead:"), "identity_hash").alias("key"))
    return first.unionByName(mail).unionByName(lead).unionByName(open_identities(funnel))
