"""AGG-18, WIN-1, RUL-19, RUL-20, JN-15, JN-16, JN-20, JN-22, JN-23: company pages, roles and drafts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftline.functions.drafts import SPAM_PAGE, TRADE_PAGE, clean_line, short_name, subject
from siftline.functions.emails import mailbox_role, page_mailboxes, role_rank
from siftline.functions.pages import page_title
from siftline.functions.text import ascii_punctuation, text_or_empty
from siftline.functions.urls import host_of, url_part
from siftline.functions.values import token_valid
from siftline.operators.keys import first_by
from siftline.session import durable

# Fixed value: path words of pages that carry contact details.
CONTACT_PATH = r"(?i)contact|about|kontak|enquir|get-in-touch|reach-us"
RESPONSE_KINDS = {"interest": ("", "interested"), "unsubscribe": ("unsub:", "unsubscribed")}


def top_captures(captures: DataFrame, per_host: int, suffix: str | None = None, url: str = "url", pos: str = "pos",
                 contact_path: str = CONTACT_PATH) -> DataFrame:
    """WIN-1: best captures per host: home page, then contact-like paths, shorter first."""
    path = F.coalesce(url_part(F.col(url), "PATH"), F.lit(""))
    path = F.when(path == "", F.lit("/")).otherwise(path)
    staged = captures.withColumn("host", host_of(F.col(url))).withColumn("_path", path)
    if suffix:
        staged = staged.filter(F.col("host").endswith(suffix))
    cls = F.when(F.col("_path") == "/", 0).when(F.col("_path").rlike(contact_path), 1).otherwise(2)
    staged = staged.withColumn("cls", cls).filter((F.col("cls") < 2) & (F.col("host") != ""))
    best = Window.partitionBy("host").orderBy("cls", F.length("_path"), pos)
    return staged.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= per_host).drop("_path")


def company_records(pages: DataFrame, lookups: dict, limit: int = 3, pos: str = "pos") -> DataFrame:
    """AGG-18: one record per host from its pages.

    Nothing is collected per host: mailboxes are reduced to (host, address) first, and only the first
    ``limit`` of a host meet in one row.
    """
    staged = pages.withColumn("host", host_of(F.col("url"))).filter(F.col("host") != "")
    staged = staged.withColumn("mailboxes", page_mailboxes(F.col("html"), F.col("host"), lookups))
    staged = staged.withColumn("title", page_title(F.col("html")))
    # every page is parsed once; both branches below read the narrow result and no page text is shuffled
    staged = durable(staged.select("host", pos, "url", "fetched_at", "mailboxes", "title"), "parsed")
    each = staged.select("host", pos, F.posexplode("mailboxes").alias("i", "email"))
    distinct = each.groupBy("host", "email").agg(F.min(F.struct(pos, "i")).alias("at"))
    order = Window.partitionBy("host").orderBy("at")
    first = distinct.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= limit)
    emails = first.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("rn", "email"))).alias("e"))
    facts = staged.groupBy("host").agg(
        F.min_by("url", F.when(F.size("mailboxes") > 0, F.col(pos))).alias("url"),
        F.min_by("title", F.when(F.col("title") != "", F.col(pos))).alias("title"),
        F.min_by("fetched_at", F.when(F.col("fetched_at").isNotNull(), F.col(pos))).alias("published_at"))
    joined = facts.join(emails, "host")
    name = F.when(text_or_empty(F.col("title")) == "", F.col("host")).otherwise(F.col("title"))
    listed = F.transform("e", lambda x: x["email"])
    text = F.concat(F.lit("Business website "), F.col("host"), F.lit(" ("), name, F.lit("). Published contact: "), F.array_join(listed, ", "))
    return joined.select("host", F.col("host").alias("source_record_id"), F.col("host").alias("identity"), "url", text.alias("text"),
                         "published_at", name.alias("display_name"), name.alias("business_name"),
                         F.array(F.concat(F.lit("https://"), "host", F.lit("/"))).alias("urls"), listed.alias("emails"))


def best_mailbox(rows: DataFrame, lookups: dict, mailboxes: str = "mailboxes") -> DataFrame:
    """RUL-19: mailbox of the most relevant role, page order breaks ties (arrays of at most eleven)."""
    ranked = F.transform(mailboxes, lambda m, i: F.struct(role_rank(m, lookups).alias("p"), i.alias("i"), m.alias("m")))
    return rows.withColumn("best_email", F.try_element_at(F.array_sort(ranked), F.lit(1))["m"])


def contact_roles(leads: DataFrame, pages: DataFrame, lookups: dict, limit: int = 10) -> DataFrame:
    """JN-20: role row per delivered company from the page it was published on.

    Pages are cut down to their mailboxes before the join, so no page text is shuffled.
    """
    seen = pages.withColumn("_host", host_of(F.col("url"))).select(
        F.col("url").alias("source_url"), page_mailboxes(F.col("html"), F.col("_host"), lookups, limit).alias("_page"))
    seen = seen.groupBy("source_url").agg(F.min("_page").alias("_page"))
    staged = leads.join(seen, "source_url", "left")
    others = F.filter(F.coalesce("_page", F.array().cast("array<string>")), lambda m: m != F.col("email"))
    staged = staged.withColumn("mailboxes", F.concat(F.array("email"), others))
    staged = best_mailbox(staged, lookups)
    host = host_of(F.col("source_url"))
    return staged.select(
        "lead_id", "business_name", F.when(host != "", F.concat(F.lit("https://"), host, F.lit("/"))).otherwise("").alias("website"),
        F.col("email").alias("delivered_email"), mailbox_role(F.col("email"), lookups).alias("delivered_role"), "best_email",
        mailbox_role(F.col("best_email"), lookups).alias("best_role"),
        F.array_join(F.filter("mailboxes", lambda m: m != F.col("best_email")), ", ").alias("other_mailboxes"),
        F.col("source_url").alias("checked_url"),
        F.when(F.col("_page").isNotNull(), "checked").otherwise("page_unavailable").alias("status"))


def pending(rows: DataFrame, done: DataFrame, suppressed: DataFrame | None = None, key: str = "lead_id") -> DataFrame:
    """JN-15: rows without an output yet that are not suppressed."""
    rows = rows.filter(text_or_empty(F.col(key)) != "").join(done.select(key).distinct(), key, "left_anti")
    return rows if suppressed is None else rows.join(suppressed.select(key).distinct(), key, "left_anti")


def draft_rows(leads: DataFrame, pages: DataFrame, lines: DataFrame, trade: str = TRADE_PAGE, spam: str = SPAM_PAGE) -> DataFrame:
    """RUL-20: review row per company from its page excerpt (``website, excerpt, thin``) and a supplied line
    (``lead_id, name, line, confidence``); the first failing test names the reason."""
    staged = leads.join(pages.select("website", "excerpt", "thin", F.lit(True).alias("_page")), "website", "left")
    staged = staged.join(lines.select("lead_id", F.col("name").alias("_name"), F.col("line").alias("_line"), "confidence"), "lead_id", "left")
    excerpt = text_or_empty(F.col("excerpt"))
    early = (F.when(F.col("_page").isNull(), "page_unavailable").when(excerpt.rlike(trade), "looks_like_insurer_or_broker")
             .when(F.col("thin"), "page_too_thin").when(excerpt.rlike(spam), "page_looks_compromised"))
    staged = staged.withColumn("_early", early)
    proposed = F.when(F.col("_early").isNull(), F.col("_name"))
    staged = staged.withColumn("short_name", short_name(proposed, F.col("business_name"), F.col("excerpt")))
    staged = staged.withColumn("personal_line", F.when(F.col("_early").isNull(), clean_line(F.col("_line"), F.col("short_name"))).otherwise(""))
    fine = F.col("personal_line") != ""
    note = F.coalesce("_early", F.when(~fine, F.lit("line_failed_validation")), F.when(F.col("confidence") == "low", F.lit("low_confidence")), F.lit(""))
    # a company that no line was supplied for yet stays pending
    staged = staged.filter(F.col("_early").isNotNull() | F.col("_line").isNotNull())
    return staged.select("lead_id", ascii_punctuation(F.col("business_name")).alias("business_name"), "to_email", "other_mailboxes",
                         subject(F.col("short_name")).alias("subject"), "personal_line", "website",
                         F.left(excerpt, F.lit(500)).alias("source_excerpt"),
                         F.when(fine, "PENDING_REVIEW").otherwise("NEEDS_MANUAL").alias("status"), F.lit("").alias("approved"),
                         note.alias("reviewer_notes"), "short_name")


def import_lines(items: DataFrame, waiting: DataFrame, pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """JN-23: rows for the first line of every pending id, and the ids that were skipped.

    A repeat of an id is skipped like an unknown one: the id is no longer pending by then.
    """
    first = items.join(first_by(items, ["lead_id"], [pos], [pos]).select(pos), pos, "left_semi")
    known = first.join(waiting.select("lead_id", "business_name", "website", "to_email", "other_mailboxes"), "lead_id")
    name = short_name(F.col("name"), F.col("business_name"), F.coalesce(F.nullif(text_or_empty(F.col("excerpt")), F.lit("")), F.col("name")))
    staged = known.withColumn("short_name", name)
    staged = staged.withColumn("personal_line", clean_line(F.col("line"), F.col("short_name")))
    fine = F.col("personal_line") != ""
    rows = staged.select("lead_id", "short_name", "personal_line", F.when(fine, "PENDING_REVIEW").otherwise("NEEDS_MANUAL").alias("status"),
                         F.when(fine, "").otherwise("line_failed_validation").alias("reviewer_notes"))
    skipped = items.join(known.select(pos), pos, "left_anti").select("lead_id", pos)
    return rows, skipped


def redo(drafts: DataFrame, ids: DataFrame) -> DataFrame:
    """JN-22: drafts that stay when the given ids are drafted again; approved ones always stay."""
    approved = F.upper(F.trim(text_or_empty(F.col("approved")))).isin("YES", "APPROVED")
    asked = ids.select("lead_id", F.lit(True).alias("_asked")).distinct()
    return drafts.join(asked, "lead_id", "left").filter(F.col("_asked").isNull() | approved).drop("_asked")


def responses(log: DataFrame, delivered: DataFrame, secret: str) -> DataFrame:
    """JN-16: first valid response per lead and kind with the delivered company beside it."""
    valid = F.lit(False)
    status = F.lit(None).cast("string")
    for kind, (prefix, word) in RESPONSE_KINDS.items():
        valid = valid | ((F.col("kind") == kind) & token_valid(F.col("lead_id"), F.col("token"), secret, prefix))
        status = F.when(F.col("kind") == kind, F.lit(word)).otherwise(status)
    good = log.withColumn("_ok", valid).filter("_ok")
    first = good.groupBy("lead_id", "kind").agg(F.min("ts").alias("at"))
    found = delivered.select("lead_id", "business_name", "email", F.col("source_url").alias("_u")).dropDuplicates(["lead_id"])
    joined = first.join(found, "lead_id", "left")
    host = host_of(F.col("_u"))
    email = text_or_empty(F.col("email"))
    return joined.select("lead_id", "kind", text_or_empty(F.col("business_name")).alias("business_name"), email.alias("email"),
                         F.when(host != "", F.concat(F.lit("https://"), host, F.lit("/"))).otherwise("").alias("website"), "at",
                         F.concat(status, F.when(email == "", F.lit("_lead_not_found")).otherwise(F.lit(""))).alias("status"))

