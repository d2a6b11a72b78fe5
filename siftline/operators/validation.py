"""RUL-14, RUL-18, JN-6..JN-8, FLT-4, FLT-5, FLT-9: contact verdicts and the validation stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.emails import domain_part, local_part, normal_email
from siftline.functions.text import digest
from siftline.functions.values import backoff
from siftline.operators.keys import lookup
from siftline.operators.pin import pinned
from siftline.operators.ranking import rank_route

FRESH_DAYS = 3
USABLE = "DELIVERABLE_DOMAIN"
TEMPORARY = "dns_temporary"


def domain_suffixes(domain: Column) -> Column:
    """The domain and all its parent domains."""
    labels = F.split(domain, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def disposable(domain: Column, lookups: dict) -> Column:
    """FLT-4 for the configured list: the domain or one of its parents is listed."""
    listed = F.array(*[F.lit(d) for d in lookups["disposable_domains"]]).cast("array<string>")
    return F.arrays_overlap(domain_suffixes(domain), listed)


def listed_domains(rows: DataFrame, listed: DataFrame, domain: str = "domain") -> DataFrame:
    """JN-8 for a list kept as a table: rows whose domain or a parent of it is listed.

    Distinct domains are expanded, not rows, so a domain shared by a third of the rows is tested once.
    """
    names = rows.select(domain).distinct()
    hit = (names.select(domain, F.explode(domain_suffixes(F.col(domain))).alias("suffix"))
           .join(listed.select(F.col(listed.columns[0]).alias("suffix")).distinct(), "suffix", "left_semi")
           .select(domain).distinct())
    return rows.join(hit, domain, "left_semi")


def domain_facts(mx: DataFrame) -> DataFrame:
    """JN-7: one row per domain from supplied facts ``(domain, outcome, exchange)``."""
    exchange = F.regexp_replace(F.coalesce("exchange", F.lit("")), r"\.+$", "")
    answered = F.col("outcome") == "answer"
    return mx.groupBy("domain").agg(
        F.bool_or(answered & (exchange != "")).alias("has_mx"), F.bool_or(answered).alias("answered"),
        F.bool_or(F.col("outcome") == "nxdomain").alias("no_domain"),
        F.bool_or(F.col("outcome") == "no_answer").alias("no_answer"))


def contact_verdicts(rows: DataFrame, mx: DataFrame, lookups: dict, email: str = "email",
                     allow_role: Column | None = None) -> DataFrame:
    """RUL-14: adds ``status`` and ``reason``; the first test that fails decides."""
    allow = allow_role if allow_role is not None else F.lit(False)
    staged = pinned(rows, _email=normal_email(F.col(email))).withColumn("domain", domain_part(F.col("_email")))
    staged = lookup(staged, domain_facts(mx), "domain")
    role = local_part(F.col("_email")).isin(list(lookups["role_accounts"])) & ~allow
    ladder = [
        (F.col("_email").isNull(), "INVALID", "invalid_syntax"),
        (disposable(F.col("domain"), lookups), "RISKY", "disposable_domain"),
        (role, "RISKY", "role_account"),
        (F.col("has_mx"), USABLE, "syntax_and_mx_passed"),
        (F.col("answered"), "NO_MX", "null_mx"),
        (F.col("no_domain"), "NO_DOMAIN", "nxdomain"),
        (F.col("no_answer"), "NO_MX", "no_mx"),
    ]
    pair = lambda status, reason: F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))
    verdict = pair("RISKY", TEMPORARY)
    for test, status, reason in reversed(ladder):
        verdict = F.when(F.coalesce(test, F.lit(False)), pair(status, reason)).otherwise(verdict)
    staged = pinned(staged, _v=verdict)
    return staged.select(*rows.columns, F.col("_v.status").alias("status"), F.col("_v.reason").alias("reason"))


def usable_contacts(contacts: Column, as_of: Column) -> Column:
    """FLT-9: deliverable contacts whose zoned check time is younger than three days."""
    limit = as_of - F.expr(f"INTERVAL {FRESH_DAYS} DAYS")

    def fresh(c: Column) -> Column:
        zoned = c["validated_at"].rlike(r"(?:Z|[+-]\d{2}:?\d{2})$")
        return F.coalesce(zoned & (F.try_to_timestamp(c["validated_at"]) > limit) & (c["status"] == USABLE), F.lit(False))

    return F.filter(contacts, fresh)


def reuse_or_compute(rows: DataFrame, cache: DataFrame, as_of: Column, bypass: Column) -> DataFrame:
    """JN-6: adds ``cached_status``/``cached_reason`` where a fresh, not temporary result may be reused."""
    limit = as_of - F.expr(f"INTERVAL {FRESH_DAYS} DAYS")
    fresh = cache.filter((F.col("checked_at") > limit) & (F.col("reason") != TEMPORARY))
    fresh = fresh.select("email_hash", F.col("status").alias("cached_status"), F.col("reason").alias("cached_reason"))
    joined = rows.join(fresh, "email_hash", "left")
    return (joined.withColumn("cached_status", F.when(~bypass, F.col("cached_status")))
            .withColumn("cached_reason", F.when(~bypass, F.col("cached_reason"))))


def checked_contacts(candidates: DataFrame, claimed: DataFrame, cache: DataFrame, mx: DataFrame, book, as_of: Column) -> DataFrame:
    """One row per candidate contact with its verdict and whether the address is already claimed."""
    business = (book.policy.get("business_contact") or {}).get("product_type")
    company = F.col("product_type") == F.lit(business) if business else F.lit(False)
    each = candidates.select("candidate_id", company.alias("company"), F.posexplode("contacts").alias("slot", "contact"))
    each = each.withColumn("email", F.col("contact.email")).withColumn("email_hash", digest(F.col("email")))
    emails = claimed.filter(F.col("key").startswith("email:"))
    emails = emails.select(F.substring_index("key", ":", -1).alias("email_hash"), F.lit(True).alias("_claimed"))
    each = each.join(emails, "email_hash", "left")
    each = reuse_or_compute(each, cache, as_of, F.col("company"))
    each = contact_verdicts(each, mx, book.lookups, allow_role=F.col("company"))
    return each.select(
        "candidate_id", "slot", "contact", "email_hash", "company", F.col("_claimed").isNotNull().alias("claimed"),
        F.col("cached_status").isNotNull().alias("from_cache"),
        F.coalesce("cached_status", "status").alias("status"), F.coalesce("cached_reason", "reason").alias("reason"))


def validation_stage(candidates: DataFrame, checked: DataFrame, book, as_of: Column, max_attempts: int = 5, rules: DataFrame | None = None) -> DataFrame:
    """RUL-18: next status, contacts, attempts and due time of every candidate, with the counter it adds to.

    With ``rules`` ``(candidate_id, rules)`` the rank is stored as well: with a contact where one was validated, without one
    where none is needed; otherwise ``rank_score`` stays what it was (0 without such a column).
    """
    business = (book.policy.get("business_contact") or {}).get("product_type")
    company = F.col("product_type") == F.lit(business) if business else F.lit(False)
    required = company | F.lit(bool(book.policy["require_contact"]))
    from siftline.functions.values import iso_time

    stamp = iso_time(as_of)
    good = ~F.col("claimed") & (F.col("status") == USABLE)
    accepted = F.struct("slot", F.col("contact.email").alias("email"), F.col("contact.source_url").alias("source_url"),
                        F.col("status").alias("status"), stamp.alias("validated_at"))
    # at most five contacts per candidate, so this list is bounded
    per = checked.groupBy("candidate_id").agg(
        F.array_sort(F.collect_list(F.when(good, accepted))).alias("_ok"),
        F.bool_or(~F.col("claimed") & (F.col("reason") == TEMPORARY)).alias("_temporary"),
        F.bool_or("claimed").alias("_duplicate"))
    staged = candidates.join(per, "candidate_id", "left")
    had = F.size("contacts") > 0
    ok = F.coalesce(F.size("_ok") > 0, F.lit(False))
    retry = F.coalesce(F.col("_temporary"), F.lit(False)) & (F.col("attempts") < max_attempts)
    duplicate = F.coalesce(F.col("_duplicate"), F.lit(False))
    outcome = (F.when(~had & required, F.lit("no_contact")).when(~had, F.lit("no_contact_allowed"))
               .when(ok, F.lit("contacts_validated")).when(retry, F.lit("retry")).when(duplicate, F.lit("duplicate"))
               .when(~required, F.lit("contact_dropped")).otherwise(F.lit("contact_review")))
    staged = staged.withColumn("outcome", outcome)
    onward = F.col("outcome").isin("no_contact_allowed", "contacts_validated", "contact_dropped")
    status = (F.when(onward, F.lit("CLASSIFY")).when(F.col("outcome") == "retry", F.lit("VALIDATE"))
              .when(F.col("outcome") == "duplicate", F.lit("REJECTED"))
              .when(F.col("outcome") == "no_contact", F.lit("NO_CONTACT")).otherwise(F.lit("CONTACT_REVIEW")))
    strip = F.transform("_ok", lambda c: F.struct(c["email"].alias("email"), c["source_url"].alias("source_url"),
                                                 c["status"].alias("status"), c["validated_at"].alias("validated_at")))
    as_given = F.transform("contacts", lambda c: F.struct(
        c["email"].alias("email"), c["source_url"].alias("source_url"), F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("validated_at")))
    attempts = F.when(F.col("outcome") == "retry", F.col("attempts") + 1).when(onward, F.lit(0)).otherwise(F.col("attempts"))
    due = F.when(F.col("outcome") == "retry", backoff(as_of, F.col("attempts") + 1, "minutes")).otherwise(as_of)
    if rules is not None:
        before = F.col("rank_score") if "rank_score" in candidates.columns else F.lit(0.0)
        staged = pinned(staged.join(rules.select("candidate_id", F.col("rules").alias("_rules")), "candidate_id", "left"), _valid=F.col("outcome") == "contacts_validated")
        ranked = F.when(F.col("outcome").isin("contacts_validated", "no_contact_allowed") & F.col("_rules").isNotNull(),
                        rank_route(F.col("_rules"), F.col("_valid"), book.policy)["rank_score"])
        staged = staged.withColumn("rank_score", F.coalesce(ranked, before)).drop("_rules", "_valid")
    return staged.withColumns({
        "status": status, "attempts": attempts.cast("int"), "available_at": due,
        "contacts": F.when(ok, strip).when(F.col("outcome") == "contact_dropped", F.slice(as_given, 1, 0)).otherwise(as_given),
    }).drop("_ok", "_temporary", "_duplicate")


def refreshed_cache(cache: DataFrame, checked: DataFrame, as_of: Column) -> DataFrame:
    """Validation cache after the stage: newly computed consumer results replace older rows."""
    fresh = (checked.filter(~F.col("claimed") & ~F.col("from_cache") & ~F.col("company"))
             .groupBy("email_hash").agg(F.min(F.struct("status", "reason")).alias("_r"))
             .select("email_hash", "_r.status", "_r.reason", as_of.alias("checked_at")))
    kept = cache.select("email_hash", "status", "reason", "checked_at").join(fresh, "email_hash", "left_anti")
    return kept.unionByName(fresh)
