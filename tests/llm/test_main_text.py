"""Main text of pages: the cut against all labellings, pages with known articles, and the defined odd cases."""

import random
import re
import time
from html import unescape
from itertools import product

import pytest
from pyspark.sql import functions as F

from siftline.llm import main_text


def test_cut_against_all_labellings():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 9)
        gains = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 8)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]

        def cost(kept):
            wrong = sum(max(g, 0) if not k else max(-g, 0) for g, k in zip(gains, kept, strict=True))
            return wrong + sum(c for a, b, c in edges if kept[a] != kept[b])

        got = main_text.cut(gains, edges)
        least = min(cost(k) for k in product((False, True), repeat=n))
        assert cost(got) == least
        # of equally good labellings the one with most content
        assert sum(got) == max(sum(k) for k in product((False, True), repeat=n) if cost(k) == least)


def test_long_pages_are_cut_in_time():
    rng = random.Random(1)
    gains = [rng.choice([-1, 1]) * rng.randint(1, 4000) for _ in range(40_000)]
    start = time.time()
    main_text.cut(gains, main_text.links([rng.randrange(200) for _ in gains], [2] * len(gains)))
    assert time.time() - start < 60


def test_broken_pages_are_read_in_time():
    start = time.time()
    for piece in ("<", "<a", "<div ", "<div>", "</p>", "<!--", "<svg>", "<script>", "&", "&#", "<p a=\"", "<b x='", "<ul><li>", "</article>", "<a href=x>y", "<div></span>"):
        main_text.read(piece * 60_000)
    assert time.time() - start < 60


ARTICLE = """<h1>The long way home</h1><p>It was late when the last train left the station, and nobody had thought of a ticket.</p>
<h2>Morning</h2><p>Short one.</p><ul><li>bread and butter</li><li>two cups of tea</li></ul><p>See <a href="/x">the old map</a> of the&nbsp;town &amp; its walls,
which was drawn in 1790.</p><blockquote>Nobody reads it.</blockquote><p><a href="/more">The whole map</a></p><p>In the end they walked, as they always had, along the river.</p>"""
WANT = ["The long way home", "It was late when the last train left the station, and nobody had thought of a ticket.", "Morning", "Short one.", "bread and butter", "two cups of tea",
        "See the old map of the town & its walls, which was drawn in 1790.", "Nobody reads it.", "The whole map", "In the end they walked, as they always had, along the river."]
HEAD = "<!DOCTYPE html><html><head><title>Site</title><style>p{}</style><script>var a='<p>no</p>';</script></head>"
AROUND = {
    "article": f"{HEAD}<body><header><h1>Site name</h1></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><!-- <p>gone</p> --><article>{ARTICLE}</article><footer>&copy; all rights</footer></body></html>",
    "main": f"{HEAD}<body><div class=header>Daily paper</div><div id=menu><a href=a>News</a> <a href=b>Sport</a></div><main>{ARTICLE}</main><aside><p>Most read this week, a long list of things.</p></aside></body>",
    "plain": f"{HEAD}<body><div><a href=a>News</a> | <a href=b>Sport</a> | <a href=c>Mail</a></div><div>{ARTICLE}</div><div><a href=d>Imprint</a> <a href=e>Privacy</a></div></body>",
    "comments": f"{HEAD}<body class='has-sidebar'><article>{ARTICLE}<div id='comments'><h3>3 comments</h3><article class='comment'><p>I liked this one very much, thank you for writing it down.</p></article></div></article></body>",
    "notice": f"{HEAD}<body><div class='cookie-notice'><p>We use cookies to make this site better for you, and for those who pay us.</p><button>Accept</button></div><article>{ARTICLE}</article></body>",
    "advert": f"{HEAD}<body><article>{ARTICLE}<div class='ad-slot'>Buy two shoes, get one more for free, only this week.</div></article><div class=sponsored><p>The best shoes in town are sold here, come and see.</p></div></body>",
    "form": f"{HEAD}<body><form action=/><div id=menu>Home</div><article>{ARTICLE}<form><label>Your mail</label><input><select><option>weekly</select></form></article></form><noscript>Turn it on</noscript></body>",
    "unclosed": f"{HEAD}<body><nav><a href=a>One<a href=b>Two</nav><article>{ARTICLE}",
    "role": f"{HEAD}<body><div role=navigation>Start here</div><div role=main><div class=article-body>{ARTICLE}</div></div><div style='display: none'>Hidden words stand here.</div><p hidden>Also hidden words.</p></body>",
}


@pytest.mark.parametrize("name", AROUND)
def test_known_articles(spark, name):
    pages = spark.createDataFrame([(1, "u", AROUND[name])], "page_id long, url string, html string")
    assert main_text.report(pages).first().text.split("\n\n") == WANT


def test_pages_of_the_given_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in main_text.report(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id].text == "\n\n".join(b for b in blocks if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (3, "u", "<p>"), (None, "u", "<article><p>Only this, nothing else.</article>"), (4, "u", "just words without any tag, a whole sentence of them."),
            (5, "u", "<article><p>a &lt;b&gt; &#233;&#xe9; &amp &am &zzz; x</p></article>"), (6, "u", "<script>never closed <p>Words</p>"), (7, "u", "<!-- never closed <p>Words</p>"),
            (8, "u", "<nav><p>Only a menu stands here, a long one, with words.</p></nav>"), (9, "u", "<article>" + "<p>The same long sentence, again and again and again.</p>" * 30_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own")).withColumn("blocks", F.lit(1)).withColumn("_html", F.lit(2))
    got = {r.page_id: r.text for r in main_text.report(pages).collect()}
    assert [got[i] for i in (1, 2, 3, 6, 7, 8)] == [""] * 6 and got[None] == "Only this, nothing else." and got[4].startswith("just words")
    assert got[5] == "a <b> éé & &am &zzz; x" and len(got[9].split("\n\n")) == 30_000
    assert main_text.report(pages).count() == len(rows) and main_text.report(pages.limit(0)).count() == 0
    assert {r["text"] for r in main_text.extracted(pages).select("_doc.text").collect()} == {"own"}
