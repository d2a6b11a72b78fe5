"""The rules bundle: ordered term groups, scoring policy and lookup lists, all supplied as data."""

from __future__ import annotations

import json
from collections.abc import Mapping
from copy import deepcopy
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftline.functions.text import matching_text
from siftline.schemas import TERMS

MAX_BUNDLE_TERMS = 20_000

# Operating weights, gates and thresholds of the scoring policy.
DEFAULT_POLICY = {
    "version": "rules-v4",
    "weights": {
        "quote": 35, "recommendation": 30, "switch": 25, "premium": 20, "vehicle": 15, "property": 15,
        "family": 10, "broker_request": 30, "south_africa": 15, "insurer": 10, "broker": -60, "seller": -80,
        "job": -50, "advertisement": -50, "news": -40, "non_target": -70,
    },
    "source_weights": {"bluesky": 0, "youtube": 0, "commoncrawl": 0},
    "location_signal": "south_africa",
    "require_location": True,
    "require_contact": False,
    "discard_below": 25,
    "accept_without_llm_above": 85,
    "local_confidence": 0.85,
    "max_age_days": 30,
    "negative_signals": ["broker", "seller", "job", "advertisement", "news", "non_target"],
    "target_products": ["MOTOR", "HOME", "CONTENTS", "LIFE", "FUNERAL", "DISABILITY"],
    "negative_overrides": {"broker": "broker_request"},
    "review_only_signals": ["broker_request", "solicitation"],
    "positive_labels": ["HIGH_INTENT", "MEDIUM_INTENT"],
    "ranking": {
        "version": "ordinal-rank-v2", "rules_weight": 0.7, "contact_points": 1.0, "product_points": 1.0,
        "geography_points": 1.0, "local_positive_bonus": 0.5, "defer_at": 6.0, "semantic_at": 8.0,
        "direct_at": 9.5, "semantic_accept_score": 80,
        "semantic_review": {"enabled": True,
                            "intent_signals": ["quote", "recommendation", "switch", "broker_request"]},
    },
    "business_contact": {
        "sources": ["commoncrawl"], "product_type": "BUSINESS_CONTACT", "max_age_days": 400, "score": 50,
        "rank_score": 5.0, "tld": "za", "reject_signals": ["broker", "seller"],
        "reject_terms": ["insurance broker", "insurance brokers", "brokers", "brokerage", "insurer", "insurers",
                         "insurance company", "insurance group", "assurance", "underwriting", "underwriters"],
        "reject_label": "insurance_trade",
    },
}

# Lookup lists for contact validation and page mailboxes.
DEFAULT_LOOKUPS = {
    "disposable_domains": ["mailinator.com", "guerrillamail.com", "temp-mail.org", "10minutemail.com",
                           "yopmail.com", "sharklasers.com"],
    "role_accounts": ["info", "sales", "admin", "support", "noreply", "no-reply", "contact"],
    "public_suffixes": ["za", "co.za", "org.za", "ac.za", "gov.za", "net.za", "web.za", "nom.za", "edu.za",
                        "law.za", "mil.za", "school.za", "alt.za", "ngo.za", "nis.za", "tm.za", "grondar.za",
                        "agric.za"],
    "mailbox_tld": "za",
    "mailbox_roles": {
        "info": "General", "general": "General", "contact": "General", "contactus": "General",
        "hello": "General", "mail": "General", "enquiries": "Enquiries", "enquiry": "Enquiries",
        "enquire": "Enquiries", "accounts": "Accounts", "admin": "Administration",
        "office": "Administration", "reception": "Reception", "sales": "Sales", "orders": "Sales",
        "quotes": "Sales", "marketing": "Marketing", "bookings": "Bookings", "reservations": "Bookings",
        "service": "Service", "support": "Service",
    },
    "role_priority": ["Accounts", "Administration", "Enquiries", "General", "Reception", "Sales", "Bookings",
                      "Service", "Marketing"],
}


def _merged(base: Mapping, given: Mapping) -> dict:
    out = deepcopy(dict(base))
    for key, value in given.items():
        nested = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        # weights and overrides are whole tables: a bundle that names them replaces them
        out[key] = _merged(out[key], value) if nested and key in {"ranking", "semantic_review"} else deepcopy(value)
    return out


def _document(value) -> dict:
    if isinstance(value, Mapping):
        return dict(value)
    text = Path(value).read_text(encoding="utf-8")
    if str(value).endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:
        raise RuntimeError("install a YAML reader or pass the bundle as JSON") from exc
    return yaml.safe_load(text)


@dataclass(frozen=True)
class RuleBook:
    """``products`` and ``signals`` keep the order they were written in: order decides ties."""

    products: dict[str, list[str]]
    signals: dict[str, list[str]]
    relevance: list[str]
    policy: dict = field(default_factory=lambda: deepcopy(DEFAULT_POLICY))
    lookups: dict = field(default_factory=lambda: deepcopy(DEFAULT_LOOKUPS))

    def groups(self) -> dict[str, list[str]]:
        named = {f"product:{name}": terms for name, terms in self.products.items()}
        named |= {f"signal:{name}": terms for name, terms in self.signals.items()}
        return named | {"relevance": self.relevance}

    def discovery_terms(self) -> list[str]:
        negative = set(self.policy["negative_signals"])
        return [t for terms in self.products.values() for t in terms] + [
            t for name, terms in self.signals.items() if name not in negative for t in terms]

    def location_terms(self) -> list[str]:
        return self.signals.get(self.policy["location_signal"], [])


def load_rules(keywords, scoring=None, lookups=None) -> RuleBook:
    """Bundle from mappings or files.  ``scoring`` and ``lookups`` override the defaults key by key."""
    words = _document(keywords)
    given = dict(_document(scoring)) if scoring is not None else {}
    if "require_south_africa" in given:  # spelling of this gate in the original policy files
        given["require_location"] = given.pop("require_south_africa")
    business = given.get("business_contact")
    if business:
        given["business_contact"] = {"tld": "za", "reject_label": "insurance_trade", **business}
    extra = dict(_document(lookups)) if lookups is not None else {}
    if "domains" in extra:
        extra["disposable_domains"] = extra.pop("domains")
    return RuleBook(
        products={k: list(v) for k, v in words["products"].items()},
        signals={k: list(v) for k, v in words["signals"].items()},
        relevance=list(words.get("relevance_terms", [])),
        policy=_merged(DEFAULT_POLICY, given),
        lookups=_merged(DEFAULT_LOOKUPS, extra),
    )


def term_table(spark: SparkSession, book: RuleBook) -> DataFrame:
    """SRC-8: the dictionary as a table ``(grp, kind, ord, term)`` with terms folded for matching."""
    rows, order = [], 0
    for name, terms in book.groups().items():
        kind = name.split(":", 1)[0]
        for term in terms:
            rows.append((name, kind, order, term))
        order += 1
    raw = spark.createDataFrame(rows, TERMS)
    return raw.withColumn("term", matching_text(F.col("term")))


def rules_from_table(terms: DataFrame, scoring=None, lookups=None) -> RuleBook:
    """SRC-8 the other way round: a bundle from a terms table in group order.

    A bundle is compiled into expressions, so it has to be small; larger dictionaries stay tables and
    go through :func:`siftline.operators.matching.match_by_join`.
    """
    if terms.limit(MAX_BUNDLE_TERMS + 1).count() > MAX_BUNDLE_TERMS:
        raise ValueError("too many terms for a bundle: keep them as a table and match by join")
    products: dict[str, list[str]] = {}
    signals: dict[str, list[str]] = {}
    relevance: list[str] = []
    for row in terms.select("grp", "kind", "ord", "term").orderBy("ord").toLocalIterator():
        name = row.grp.split(":", 1)[-1]
        target = {"product": products, "signal": signals}.get(row.kind)
        (relevance if target is None else target.setdefault(name, [])).append(row.term)
    return load_rules({"products": products, "signals": signals, "relevance_terms": relevance}, scoring, lookups)
