"""RUL-2..9, FLT-2, FLT-3, FLT-6, FLT-14: the rules result of a record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import matching_text, place_window
from siftline.operators.matching import hits_any, with_matches
from siftline.operators.pin import pinned
from siftline.rules import RuleBook

DAY_SECONDS = 86_400.0


def age_days(published_at: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(published_at)) / F.lit(DAY_SECONDS * 1e6)


def recent(published_at: Column, as_of: Column, max_days: float) -> Column:
    """FLT-2: not older than ``max_days`` and at most a day ahead of ``as_of``."""
    return age_days(published_at, as_of).between(-1, max_days)


def product_of(matched: Column, book: RuleBook) -> Column:
    """RUL-2: first product in bundle order, else UNKNOWN."""
    tests = [F.when(F.array_contains(matched, f"product:{p}"), F.lit(p)) for p in book.products]
    return F.coalesce(*tests, F.lit("UNKNOWN"))


def signals_of(matched: Column, book: RuleBook) -> Column:
    """RUL-3, text part: hit signals in bundle order."""
    kept = F.filter(matched, lambda g: g.startswith("signal:"))
    return F.transform(kept, lambda g: F.substring(g, 8, 10_000))


def relevant(product: Column, matched: Column) -> Column:
    """FLT-3."""
    return (product != "UNKNOWN") | F.array_contains(matched, "relevance")


def overridden(signals: Column, policy: dict) -> Column:
    """RUL-4: negative signals cancelled by the presence of their overriding signal."""
    pairs = [F.when(F.array_contains(signals, neg) & F.array_contains(signals, over), F.lit(neg))
             for neg, over in policy["negative_overrides"].items()]
    if not pairs:
        return F.array().cast("array<string>")
    return F.filter(F.array(*pairs), lambda s: s.isNotNull())


def conflicts(signals: Column, cancelled: Column, policy: dict) -> Column:
    """RUL-5: cancelled and review-only signals, sorted."""
    review = F.array(*[F.lit(s) for s in policy["review_only_signals"]]).cast("array<string>")
    return F.array_sort(F.array_union(cancelled, F.array_intersect(signals, review)))


def weighted_score(signals: Column, cancelled: Column, source: Column, policy: dict) -> Column:
    """RUL-6: clamped sum of the weights of the signals that still count, plus the source weight."""
    parts = [F.when(F.array_contains(signals, s) & ~F.array_contains(cancelled, s), F.lit(int(w))).otherwise(F.lit(0))
             for s, w in policy["weights"].items()]
    for name, weight in policy["source_weights"].items():
        parts.append(F.when(source == name, F.lit(int(weight))).otherwise(F.lit(0)))
    total = reduce(lambda a, b: a + b, parts, F.lit(0))
    return F.least(F.lit(100), F.greatest(F.lit(0), total)).cast("int")


def national_address(text: Column, tld: str) -> Column:
    """FLT-6: an address below the configured top-level domain."""
    return text.rlike(rf"@[a-z0-9.-]+\.{tld}(?![\p{{L}}\p{{N}}_.-])")


def trade_text(text: Column, business: dict) -> Column:
    """FLT-14: trade words in the record text."""
    return hits_any(text, business.get("reject_terms", []))


def rules_result(df: DataFrame, book: RuleBook, as_of, text: str = "text", bio: str | None = "bio",
                 matched: str | None = None, out: str = "rules") -> DataFrame:
    """Adds the rules result struct.  ``as_of`` is an argument, never the clock.

    ``matched`` names a column of already verified matches; without it the text is matched here.
    """
    policy = book.policy
    moment = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    business = policy.get("business_contact") or {}
    place = policy["location_signal"]

    # whatever may leave generated code depends on source columns only: an Arrow batch above the matching step would have
    # the matching expressions copied into its input
    has_bio = bio is not None and bio in df.columns and bool(book.location_terms())
    spot = place_window(F.col(bio), book.location_terms()) if has_bio else F.lit(None).cast("string")
    staged = df.withColumns({"_text": matching_text(F.col(text)), "_spot": spot})
    if matched is None:
        staged = with_matches(staged, book, text="_text", out="_matched")
    else:
        staged = staged.withColumn("_matched", F.col(matched))
    staged = staged.withColumn("_product", product_of(F.col("_matched"), book))
    staged = staged.withColumn("_posted", signals_of(F.col("_matched"), book))

    in_post = F.array_contains("_posted", place)
    staged = staged.withColumn("_place", F.when(~in_post & (F.col("_spot") != ""), F.col("_spot")))
    added = F.when(F.col("_place").isNotNull(), F.array(F.lit(place))).otherwise(F.array().cast("array<string>"))
    staged = staged.withColumn("_signals", F.concat(F.col("_posted"), added))
    staged = staged.withColumn("_cancelled", overridden(F.col("_signals"), policy))

    signals, cancelled = F.col("_signals"), F.col("_cancelled")
    staged = staged.withColumn("_score", weighted_score(signals, cancelled, F.col("source"), policy))
    negatives = F.array(*[F.lit(s) for s in policy["negative_signals"]]).cast("array<string>")
    negative = F.size(F.array_except(F.array_intersect(signals, negatives), cancelled)) > 0
    rejected = (~relevant(F.col("_product"), F.col("_matched")) | negative
                | ~recent(F.col("published_at"), moment, policy["max_age_days"])
                | (F.col("_score") < policy["discard_below"]))
    confident = (F.col("_score") >= policy["accept_without_llm_above"]) & (F.col("_product") != "UNKNOWN")
    if policy["require_location"]:
        confident = confident & F.array_contains(signals, place)
    evidence = F.when(in_post, F.lit("post")).when(F.col("_place").isNotNull(), F.lit("profile_bio"))
    fields = {
        "score": F.col("_score"), "product_type": F.col("_product"), "signals": signals, "rejected": rejected,
        "confident": confident, "geography_evidence": evidence, "geography_excerpt": F.col("_place"),
        "conflicting_signals": conflicts(signals, cancelled, policy), "version": F.lit(policy["version"])}
    if business.get("sources"):
        company = F.col("source").isin(list(business["sources"]))
        judged = _business(business, policy, place, moment)
        fields = {name: F.when(company, judged[name]).otherwise(value) for name, value in fields.items()}
    staged = pinned(staged, **{f"_r_{name}": value for name, value in fields.items()})
    result = F.struct(*[F.col(f"_r_{name}").alias(name) for name in fields])
    helpers = ["_text", "_spot", "_matched", "_product", "_posted", "_place", "_signals", "_cancelled", "_score"]
    return staged.withColumn(out, result).drop(*helpers, *[f"_r_{name}" for name in fields])


def _business(business: dict, policy: dict, place: str, moment: Column) -> dict[str, Column]:
    """RUL-9: a business record has a fixed score and is judged by address, trade terms and age only."""
    marks = [F.when(F.array_contains("_matched", f"signal:{s}"), F.lit(s)) for s in business.get("reject_signals", [])]
    marks.append(F.when(trade_text(F.col("_text"), business), F.lit(business.get("reject_label", "insurance_trade"))))
    hits = F.filter(F.array(*marks), lambda m: m.isNotNull())
    national = national_address(F.col("_text"), business.get("tld", "za"))
    none = F.array().cast("array<string>")
    signals = F.concat(F.array(F.lit("business_contact")), F.when(national, F.array(F.lit(place))).otherwise(none), hits)
    rejected = (F.size(hits) > 0) | ~national | ~recent(F.col("published_at"), moment, business.get("max_age_days", 400))
    return {
        "score": F.lit(int(business.get("score", 50))), "product_type": F.lit(business["product_type"]), "signals": signals,
        "rejected": rejected, "confident": F.lit(False), "geography_evidence": F.when(national, F.lit("email_domain")),
        "geography_excerpt": F.lit(None).cast("string"), "conflicting_signals": none, "version": F.lit(policy["version"])}
