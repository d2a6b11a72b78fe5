"""RUL-10..13, RUL-16, ML-7: rank, route and gates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftline.functions.values import outdated

ROUTES = ("DIRECT_FINAL", "SEMANTIC", "CONTACT_REVIEW", "DEFERRED", "REJECT")


def _flag(c: Column) -> Column:
    return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))


def conflicting(rules: Column, policy: dict) -> Column:
    """Conflicting evidence, or a result of another rules version."""
    return (F.size(rules["conflicting_signals"]) > 0) | outdated(rules["version"], policy["version"])


def rank_route(rules: Column, has_contact: Column, policy: dict, label: Column | None = None,
               confidence: Column | None = None) -> Column:
    """Ranking result struct.  The value is rounded before any threshold is looked at."""
    ranking = policy["ranking"]
    review = ranking.get("semantic_review", {})
    business = policy.get("business_contact") or {}
    signals = rules["signals"]

    on_target = rules["product_type"].isin(list(policy["target_products"]))
    contact = has_contact if policy["require_contact"] else F.lit(True)
    placed = F.array_contains(signals, policy["location_signal"])
    place_gate = placed if policy["require_location"] else F.lit(True)
    if label is None:
        sure_positive = sure_negative = F.lit(False)
    else:
        sure = F.coalesce(confidence >= policy["local_confidence"], F.lit(False))
        positive = F.coalesce(label.isin(list(policy["positive_labels"])), F.lit(False))
        sure_positive, sure_negative = sure & positive, sure & ~positive

    value = (rules["score"] / F.lit(10.0) * F.lit(float(ranking["rules_weight"]))
             + F.lit(float(ranking["contact_points"])) * _flag(contact)
             + F.lit(float(ranking["product_points"])) * _flag(on_target)
             + F.lit(float(ranking["geography_points"])) * _flag(placed)
             + F.lit(float(ranking["local_positive_bonus"])) * _flag(sure_positive))
    value = F.round(F.least(F.lit(10.0), F.greatest(F.lit(0.0), value)), 3)

    wanted = F.array(*[F.lit(s) for s in review.get("intent_signals", [])]).cast("array<string>")
    reviewable = F.lit(bool(review.get("enabled")))
    reviewable = (reviewable & ~rules["rejected"] & ~sure_negative & contact & on_target & placed
                  & F.arrays_overlap(signals, wanted))
    low = value < ranking["semantic_at"]
    route = (F.when(reviewable & low, F.lit("SEMANTIC"))
             .when(rules["rejected"] | sure_negative | (value < ranking["defer_at"]), F.lit("REJECT"))
             .when(~contact, F.lit("CONTACT_REVIEW"))
             .when((value >= ranking["direct_at"]) & on_target & place_gate & ~conflicting(rules, policy),
                   F.lit("DIRECT_FINAL"))
             .when(~low, F.lit("SEMANTIC"))
             .otherwise(F.lit("DEFERRED")))

    fields = {"rank_score": value, "route": route, "review_route": reviewable & low}
    gates = {"contact": contact, "product": on_target, "geography": place_gate, "geography_signal": placed}
    if business:
        company = rules["product_type"] == business["product_type"]
        direct = has_contact & placed & ~rules["rejected"] & ~conflicting(rules, policy)
        theirs = {"rank_score": F.lit(float(business.get("rank_score", 5.0))),
                  "route": F.when(direct, F.lit("DIRECT_FINAL")).otherwise(F.lit("REJECT")), "review_route": F.lit(False),
                  "contact": has_contact, "product": F.lit(True), "geography": placed, "geography_signal": placed}
        pick = lambda name, mine: F.when(company, theirs[name]).otherwise(mine)
        fields = {name: pick(name, c) for name, c in fields.items()}
        gates = {name: pick(name, c) for name, c in gates.items()}
    return F.struct(*[c.alias(n) for n, c in fields.items()], F.lit(ranking["version"]).alias("version"),
                    F.struct(*[c.alias(n) for n, c in gates.items()]).alias("hard_gates"))


def semantic_accepted(result: Column, policy: dict) -> Column:
    """RUL-16: all eight conditions on a semantic result."""
    placed = result["south_africa_signal"] if policy["require_location"] else F.lit(True)
    return F.coalesce(
        result["is_insurance_relevant"] & result["is_consumer"] & ~result["is_advertisement"]
        & ~result["is_broker_or_agent"] & result["intent_level"].isin("HIGH", "MEDIUM")
        & result["product_type"].isin(list(policy["target_products"]))
        & (result["score"] >= policy["ranking"]["semantic_accept_score"]) & placed, F.lit(False))
