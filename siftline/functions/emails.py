"""Address projections: extraction, syntax, buckets and mailbox roles."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from siftline.functions.text import EMAIL, text_or_empty
from siftline.functions.urls import own_domain

# Syntax subset that is accepted: dot-atom local part, host-name domain.  Quoted local parts, address
# literals and internationalised domains are refused.
_LOCAL = r"[a-z0-9!#$%&'*+/=?^_`{|}~-]+(?:\.[a-z0-9!#$%&'*+/=?^_`{|}~-]+)*"
_LABEL = r"[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
SYNTAX = rf"^(?=.{{1,64}}@)(?=.{{3,254}}$){_LOCAL}@(?:{_LABEL}\.)+(?=[a-z0-9-]*[a-z]){_LABEL}$"
# Top-level names that never hold a public mailbox.
RESERVED = r"\.(?:arpa|invalid|local|localhost|onion|test)$"

# Fixed value: the pattern of mailboxes on web pages.
PAGE_MAILBOX = (r"(?<![\p{L}\p{N}_.+-])([A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24})"
                r"(?![\p{L}\p{N}_-])")


def normal_email(c: Column) -> Column:
    """TXT-12: trimmed and lower-case address, null when the syntax is not accepted."""
    address = F.lower(F.trim(c))
    return F.when(address.rlike(SYNTAX) & ~address.rlike(RESERVED), address)


def found_emails(text: Column) -> Column:
    """Addresses in order of appearance: distinct as written, then normalised, invalid ones dropped."""
    raw = F.array_distinct(F.regexp_extract_all(text_or_empty(text), F.lit(EMAIL), F.lit(0)))
    clean = F.transform(raw, lambda a: normal_email(F.regexp_replace(a, r"\.+$", "")))
    return F.filter(clean, lambda a: a.isNotNull())


def contacts(text: Column, source_url: Column) -> Column:
    """TXT-11: the first five addresses, each with the place it was published."""
    return F.transform(F.slice(found_emails(text), 1, 5),
                       lambda a: F.struct(a.alias("email"), text_or_empty(source_url).alias("source_url")))


def merge_contacts(post: Column, bio: Column) -> Column:
    """SET-1: post contacts, then bio contacts with an unseen address, five in all."""
    seen = F.transform(post, lambda c: c["email"])
    return F.slice(F.concat(post, F.filter(bio, lambda c: ~F.array_contains(seen, c["email"]))), 1, 5)


def local_part(email: Column) -> Column:
    return F.substring_index(email, "@", 1)


def domain_part(email: Column) -> Column:
    return F.substring_index(email, "@", -1)


def page_mailboxes(html: Column, host: Column, lookups: dict, limit: int | None = None) -> Column:
    """TXT-15: allowed generic mailboxes on the site's own domain, each once in page order."""
    found = F.transform(F.regexp_extract_all(text_or_empty(html), F.lit(PAGE_MAILBOX), F.lit(1)),
                        lambda a: F.regexp_replace(F.lower(a), r"\.+$", ""))
    allowed = list(lookups["mailbox_roles"])
    tld = lookups.get("mailbox_tld")

    def fits(address: Column) -> Column:
        domain = domain_part(address)
        fine = local_part(address).isin(allowed) & own_domain(domain, host, lookups["public_suffixes"])
        return fine & domain.endswith("." + tld) if tld else fine

    kept = F.array_distinct(F.filter(found, fits))
    return F.slice(kept, 1, limit) if limit else kept


def bucket(email: Column) -> Column:
    """TXT-28: A..Z by first letter, OTHER for everything else, PROSPECTS without an address."""
    first = F.left(F.lower(F.trim(text_or_empty(email))), F.lit(1))
    lettered = F.when(first.rlike("^[a-z]$"), F.upper(first)).otherwise(F.lit("OTHER"))
    return F.when(text_or_empty(email) == "", F.lit("PROSPECTS")).otherwise(lettered)


def mailbox_role(email: Column, lookups: dict) -> Column:
    """TXT-34: role of a generic mailbox by its local part, '' when it has none."""
    roles = lookups["mailbox_roles"]
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(roles.items())])
    return F.coalesce(F.try_element_at(table, F.lower(local_part(text_or_empty(email)))), F.lit(""))


def role_rank(email: Column, lookups: dict) -> Column:
    """Position of the mailbox role in the priority list; unknown roles come last."""
    place = F.array_position(F.array(*[F.lit(r) for r in lookups["role_priority"]]), mailbox_role(email, lookups))
    return F.when(place == 0, F.lit(99)).otherwise(place - 1).cast("int")
