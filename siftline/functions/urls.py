"""URL projections: public-link guard, hosts, own-domain test."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftline.functions.text import text_or_empty

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def url_part(url: Column, part: str, key: str | None = None) -> Column:
    args = [url, F.lit(part)] + ([F.lit(key)] if key else [])
    return F.call_function("try_parse_url", *args)


def _host(url: Column) -> Column:
    """Host without user info and port; '' when the text is no absolute URL."""
    authority = F.regexp_extract(text_or_empty(url), _AUTHORITY, 1)
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?(\[[^\]]*\]|[^:@]*)", 1))


def public_url(c: Column) -> Column:
    """TXT-6: the link itself when it is http(s) with a host, no user name and at most 1000 characters."""
    c = text_or_empty(c)
    scheme = F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    user = F.regexp_extract(F.regexp_extract(c, _AUTHORITY, 1), r"^([^:@]*)(?::[^@]*)?@", 1)
    fine = scheme.isin("http", "https") & (_host(c) != "") & (user == "") & (F.length(c) <= 1000)
    return F.when(fine, c).otherwise(F.lit(""))


def public_urls(urls: Column) -> Column:
    """TXT-7: the first ten, those that are public, each once in order, the first five."""
    first = F.slice(F.coalesce(urls, F.array().cast("array<string>")), 1, 10)
    shown = F.filter(F.transform(first, public_url), lambda u: u != "")
    return F.slice(F.array_distinct(shown), 1, 5)


def host_of(url: Column) -> Column:
    """TXT-13: lower-case host without its last dot and without ``www.``."""
    host = F.regexp_replace(_host(url), r"\.+$", "")
    return F.regexp_replace(host, r"^www\.", "")


def own_domain(domain: Column, host: Column, public_suffixes: list[str]) -> Column:
    """TXT-14: the mailbox domain belongs to the site: equal or one a sub-domain of the other."""
    related = ((domain == host) | host.endswith(F.concat(F.lit("."), domain))
               | domain.endswith(F.concat(F.lit("."), host)))
    return ~domain.isin(list(public_suffixes)) & related
