import hashlib
import html
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from siftline.functions import drafts, emails, profile, text, urls, values
from siftline.functions.phrases import implied, longest_phrase_pattern, phrase_pattern
from siftline.rules import DEFAULT_LOOKUPS


def canonical(value):
    return " ".join(unicodedata.normalize("NFKC", html.unescape(value or "")).split()).casefold()


def test_canonical_vectors(one):
    assert one(text.canonical_text, a="  CAR\n Insurance &amp; HOME ") == "car insurance & home"
    assert one(text.digest, a="USER@EXAMPLE.COM ") == one(text.digest, a="user@example.com")
    assert one(text.matching_text, a="I’m a Broker") == "i'm a broker"


def test_canonical_equals_definition_on_odd_texts(spark):
    alphabet = list("aZ9 &;#x\t\n\x0b\x0c\x1c\x1f\x85\xa0ßŒéÅıİſ½…™ 　’ﬁ") + ["&amp;", "&#233;", "&nbsp;", "&lt", "é"]
    rng = random.Random(5)
    samples = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(400)] + [None]
    rows = spark.createDataFrame(list(enumerate(samples)), "i int, a string")
    out = rows.select("a", text.canonical_text(F.col("a")).alias("c"), text.clean_label(F.col("a")).alias("l")).collect()
    assert all(r.c == canonical(r.a) for r in out)
    assert all(r.l == " ".join(unicodedata.normalize("NFKC", html.unescape(r.a or "")).split())[:160] for r in out)


def test_redaction_leaves_no_contact_data(one):
    out = one(text.redact, a="Write ann@example.org or +27 82 555 1234, @handle, https://x.example.org/a?b")
    assert out == "Write [EMAIL] or [PHONE], [HANDLE], [URL]"


def test_contacts(spark):
    rows = spark.createDataFrame([("Write person@example.com.",), ("a@-bad.com x@@y b..c@d.com ok@d.co.za OK@d.co.za",), (None,)], "t string")
    out = [[tuple(c) for c in r.c] for r in rows.select(emails.contacts(F.col("t"), F.lit("u")).alias("c")).collect()]
    assert out[0] == [("person@example.com", "u")]
    assert out[1] == [("ok@d.co.za", "u"), ("ok@d.co.za", "u")]  # distinct as written, then lower case
    assert out[2] == []


def test_first_five_addresses_in_order(one):
    line = " ".join(f"p{i}@example.org" for i in range(8))
    assert [c.email for c in one(lambda a: emails.contacts(a, F.lit("")), a=line)] == [f"p{i}@example.org" for i in range(5)]


@pytest.mark.parametrize("shown, seconds", [("1h2m3.5s", 3723.5), ("20ms", 0.02), ("nan", None), ("inf", None), ("bad", None), ("-1", None), ("7", 7.0), ("8d", None), ("", None)])
def test_durations(one, shown, seconds):
    assert one(values.duration_seconds, a=shown) == seconds


@pytest.mark.parametrize("shown, seconds", [("2m3.5s", 123.5), ("7s", 7.0), ("x", 60.0), ("", 0.0)])
def test_reset_header(one, shown, seconds):
    assert one(values.reset_seconds, a=shown) == seconds


@pytest.mark.parametrize("email, bucket", [("alice@x.y", "A"), ("Zed@x.y", "Z"), ("9lives@x.y", "OTHER"), ("_x@x.y", "OTHER"), ("élan@x.y", "OTHER"), ("", "PROSPECTS")])
def test_buckets(one, email, bucket):
    assert one(emails.bucket, a=email) == bucket


def test_placement_names(spark):
    rows = spark.createDataFrame([("K", 4999), ("K", 5000), (None, 5000), ("PROSPECTS", 0), ("K", 5_000_000)], "b string, p long")
    out = rows.select(values.tab_name(F.col("b"), F.col("p"), 5000).alias("t"), values.tab_row(F.col("p"), 5000).alias("r")).collect()
    assert [tuple(x) for x in out] == [("VALIDATED_K_001", 5001), ("VALIDATED_K_002", 2), ("VALIDATED_002", 2), ("PROSPECTS_001", 2), ("VALIDATED_K_1001", 2)]


@pytest.mark.parametrize("given, safe", [('=HYPERLINK("bad")', '\'=HYPERLINK("bad")'), ("  +1", "'  +1"), ("\tx", "'\tx"), ("a=b", "a=b"), ("-", "'-"), ("@x", "'@x")])
def test_formula_guard(one, given, safe):
    assert one(text.formula_safe, a=given) == safe


def test_given_names(spark):
    rows = spark.createDataFrame([
        ("Thandi", True, "explicit_given_name", ""), ("Thandi", True, "operator_verified", ""), ("", True, "operator_verified", ""), ("Thandi", False, "operator_verified", ""),
        ("Thandi", True, "guessed", ""), ("=Thandi", True, "operator_verified", ""), ("Thandi", True, "operator_verified", "Shop")], "n string, r boolean, s string, b string")
    out = [r.v for r in rows.select(profile.greeting_name(*[F.col(c) for c in "nrsb"]).alias("v")).collect()]
    assert out == ["Thandi", "Thandi", "", "", "", "", ""]


def test_place_window(one):
    look = lambda a: text.place_window(a, ["cape town", "sandton"])
    bio = "Mother of two who enjoys long walks on the beach and gardening in Sandton, mail me at joe@sandton.example.org or call +27 82 555 1234 @joe"
    out = one(look, a=bio)
    assert "sandton" in out and "@" not in out and "555" not in out and not out.startswith("f two")
    assert one(look, a="joe@capetown.example.org https://sandton.example.org") is None
    assert one(look, a="I love Cape  Town") == "i love cape town"


def test_hosts_and_links(one):
    assert one(urls.host_of, a="https://WWW.Shop.example.org.:80/x?y") == "shop.example.org"
    assert one(urls.public_url, a="https://me:pw@x.example.org/") == ""
    assert one(urls.public_url, a="ftp://x.example.org/") == ""
    assert one(urls.public_url, a="https://x.example.org/" + "a" * 1000) == ""
    own = lambda d, h: urls.own_domain(d, h, DEFAULT_LOOKUPS["public_suffixes"])
    assert one(own, d="mail.shop.co.za", h="shop.co.za") and one(own, d="shop.co.za", h="www2.shop.co.za")
    assert not one(own, d="co.za", h="shop.co.za") and not one(own, d="shop.co.za", h="myshop.co.za")


def test_page_mailboxes(one):
    page = "INFO@shop.co.za <b>jane@shop.co.za</b> sales@designer.co.za info@shop.com info@shop.co.za, accounts@mail.shop.co.za."
    out = one(lambda a: emails.page_mailboxes(a, F.lit("shop.co.za"), DEFAULT_LOOKUPS), a=page)
    assert out == ["info@shop.co.za", "accounts@mail.shop.co.za"]


def test_tokens(one):
    import hmac

    sign = lambda a: values.signed_token(a, "key", "unsub:")
    assert one(sign, a="c:1") == hmac.new(b"key", b"unsub:c:1", hashlib.sha256).hexdigest()[:32]


def test_lines_and_names(one):
    assert one(drafts.clean_line, line="We see Acme — paints  homes", name="Acme Paint") == "We see Acme - paints homes."
    for bad in ("Hello Acme", "We see Acme at a@b.c", "We see Acme insurance", "We see somebody", "We see Acme 082 555 1234", ""):
        assert one(drafts.clean_line, line=bad, name="Acme Paint") == ""
    assert one(drafts.short_name, p='"Acme".', b="Acme Paint | Home", e="Title: ACME paints") == "Acme"
    assert one(drafts.short_name, p="Nope", b="Welcome to Acme | Acme", e="x") == "Acme"
    assert one(drafts.short_name, p="", b="Shop 000", e="") == "Shop 000"


def test_phrase_tree_finds_what_single_patterns_find(spark):
    rng = random.Random(3)
    words = ["car", "car cover", "cover", "car-x", "a & b", "übung", "in", "in the", "the"]
    texts = [" ".join(rng.choices(["car", "cover", "x", "a", "&", "b", "übung", "in", "the", "car-x", "cars", "in,"], k=6)) for _ in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    means = implied(words)
    out = rows.select("t", F.regexp_extract_all("t", F.lit(longest_phrase_pattern(words)), F.lit(1)).alias("f"),
                      *[F.col("t").rlike(phrase_pattern([w])).alias(f"w{i}") for i, w in enumerate(words)]).collect()
    for r in out:
        implied_hits = {p for f in r.f for p in means[f]}
        assert implied_hits == {w for i, w in enumerate(words) if r[f"w{i}"]}, r.t
