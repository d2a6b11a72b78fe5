"""Main text of web pages by a minimum cut between content and boilerplate.

*Blocks.*  A page is read once, tag by tag, into blocks: runs of text between the starts and ends of block elements, with
character references decoded and white space inside a block as one space.  Of every block the table keeps the text, the region
it stands in (evidence of the elements around it: article and main speak for content; menus, headers, footers, asides,
forms, hidden parts, and names such as ``cookie`` or ``comments`` against it, and what lies in those stays so), the shape of its text, the
element that holds it, and how many elements are left and entered between the block before and this one.  Scripts, styles, comments,
the head and form controls are no text.

*Classifier.*  Naive Bayes over the shape of a block (words, share of words in links, closing mark, kind of element),
trained on the blocks of all pages whose region is known, as counts in one aggregate of bounded size, on top of fixed prior
counts.  Its log odds, bounded by feature and in all, plus the evidence of the region are the cost of the wrong label.

*Cut.*  Costs are capacities from the source (content) and to the sink (boilerplate).  Blocks that follow each other are
joined by an edge that weakens with the elements between them, blocks with one parent by another.  The maximum flow is
found by shortest augmenting paths in layers (blocking flows); blocks that cannot reach the sink any more are content, so
ties are.

Defined cases: a null html is empty; a page without text, or with no content, has the empty text; unclosed comments, tags and scripts
run to the end of the page; unclosed elements end with their parents; a page of any length is read in full; repeated
rows get equal results; an empty table gives an empty result; other columns are kept by ``extracted``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from siftline.llm.common import Scratch

# Elements of HTML by their part in a page.
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr caption ul""".split())
SPACE = frozenset("br td th img wbr input hr".split())
NO_TEXT = frozenset("script style title noscript template svg math iframe object textarea select button datalist canvas audio video noframes noembed".split())
TO_THE_END = frozenset("script style textarea title".split())
OUTSIDE = frozenset("nav aside footer dialog menu".split())
ROLES_OUTSIDE = frozenset("navigation contentinfo complementary search dialog alertdialog alert status menu menubar toolbar tablist form".split())
# Names in classes and ids of parts that are not the article.
NAMES_OUTSIDE = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright
 disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup popular promo promotion
 recommendations recommended related replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar trending widget""".split())
NAMES_OF_REPLIES = frozenset("comment comments disqus replies reply respond".split())
NOT_A_PART = frozenset("has with no without is js".split())
WHOLE, BODY, CENTRE = frozenset("article post entry story".split()), frozenset("body content text".split()), frozenset("content main page site".split())

# Evidence of regions in nats.
ARTICLE, MAIN, NAMED_OUT, FORM, OUT = 4, 2, -5, -6, -8
# Counts of the shape before any page is read: (content, boilerplate) by value.
PRIOR = {
    "words": [(1, 6), (2, 5), (4, 5), (6, 4), (8, 2), (6, 1)],
    "links": [(18, 6), (6, 2), (2, 4), (1, 14)],
    "ends": [(8, 18), (18, 6)],
    "kind": [(5, 2), (16, 5), (3, 12), (4, 9), (6, 4)],  # heading, paragraph, linked item, other, item with words of its own
}
WORDS = (3, 6, 11, 21, 51)  # bounds of the classes of word counts
LINKS = (1, 30, 80)  # bounds of the classes of per cent of words in links
FEATURE, LEAST, MOST = 1.5, -4.5, 3.0  # bounds of one feature and of their sum
ADJACENT, SIBLING, UNIT = 2.0, 0.75, 1000  # capacities are whole numbers of 1/UNIT nat

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # comment
    r"|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"  # declaration
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"?|'[^']*+'?)?+)*+)(?:>|\Z)", re.S)  # tag
_END_OF = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in NO_TEXT}
_HEADINGS, _ITEMS = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("li dt dd td th tr".split())

FEATURES = list(PRIOR)
NUMBERS = ["region", *FEATURES, "parent", "between"]
BLOCKS = ArrayType(StructType([StructField("text", StringType()), *[StructField(n, IntegerType()) for n in NUMBERS]]))


def region(around: int, tag: str, attributes: str) -> int:
    """Evidence of an element inside a region."""
    if around <= NAMED_OUT and not (around > OUT and tag == "main" or around == FORM and tag == "article"):
        return around
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    around = max(around, 0)
    inside = around >= MAIN
    style = found.get("style", "").replace(" ", "").lower()
    role = found.get("role", "").lower()
    if tag in OUTSIDE or role in ROLES_OUTSIDE or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return OUT
    if (tag == "header" or role == "banner") and not inside:
        return OUT
    if tag in ("form", "search"):
        return FORM
    bad = NAMES_OF_REPLIES if tag == "article" else NAMES_OUTSIDE if tag not in ("html", "body", "main") else frozenset()
    main = tag == "main" or role == "main"
    whole = tag == "article" or role == "article" or found.get("itemprop") == "articleBody"
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [p.lower() for p in _NAME.findall(name)]
        if parts and parts[0] not in NOT_A_PART:
            if not bad.isdisjoint(parts):
                return NAMED_OUT
            if "header" in parts and not inside and bad is NAMES_OUTSIDE and WHOLE.isdisjoint(parts):
                return NAMED_OUT
            whole = whole or len(parts) > 1 and parts[0] in WHOLE and parts[-1] in BODY
            main = main or parts == ["main"] or parts[0] in CENTRE and parts[-1] == "content"
    return max(around, ARTICLE if whole else MAIN if main else 0)


class Page:
    """The blocks of one page, gathered while its tags go by."""

    def __init__(self) -> None:
        self.blocks: list[tuple] = []
        self.stack: list[tuple[str, int, int]] = [("", 0, 0)]  # name, region, number
        self.open: dict[str, int] = {}
        self.made = 0
        self.lowest = 0  # fewest elements open since the last block
        self.before = 0  # elements open at the last block
        self.linked = False
        self.parts: list[tuple[str, bool]] = []

    def say(self, text: str) -> None:
        self.parts.append((text, self.linked))

    def flush(self) -> None:
        parts, self.parts = self.parts, []
        words = "".join(t for t, _ in parts).split()
        if not words:
            return
        linked = sum(len(t.split()) for t, link in parts if link)
        name, evidence, own = self.stack[-1]
        parent = self.stack[-2][2] if name in ("p", "li", "dt", "dd", "tr") or name in _HEADINGS else own
        share = min(100, 100 * linked // len(words))
        shape = (sum(len(words) >= w for w in WORDS), sum(share >= s for s in LINKS), int(words[-1].rstrip("\"'”’»)]")[-1:] in tuple(".!?…:;。！？")),
                 0 if name in _HEADINGS else 1 if name in ("p", "blockquote", "pre") else 3 if name not in _ITEMS else 2 if share >= LINKS[-1] else 4)
        between = (self.before - self.lowest) + (len(self.stack) - self.lowest)
        self.blocks.append((" ".join(words), evidence, *shape, parent, min(between, 1000)))
        self.before = self.lowest = len(self.stack)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.linked = True
        elif tag in SPACE:
            self.parts.append((" ", False))
        if tag not in BLOCK or tag == "hr":
            if tag == "hr":
                self.flush()
            return
        self.flush()
        if self.stack[-1][0] == "p":
            self.pop()
        self.made += 1
        self.stack.append((tag, region(self.stack[-1][1], tag, attributes), self.made))
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.linked = False
        elif tag in SPACE:
            self.parts.append((" ", False))
        if tag in BLOCK:
            self.flush()
            self.linked = False
            if self.open.get(tag):
                while self.pop() != tag:
                    pass

    def pop(self) -> str:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        self.lowest = min(self.lowest, len(self.stack))
        return tag


def read(html: str) -> list[tuple]:
    """The blocks of a page: text, region, shape, parent, elements between it and the block before."""
    page = Page()
    at, head, unclosed = 0, False, set()
    while True:
        found = _TOKEN.search(html, at)
        upto = found.start() if found else len(html)
        if upto > at and not head:
            page.say(unescape(html[at:upto]))
        if found is None:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag == "head" or tag == "body":
            head = tag == "head" and not found[1]
        if tag in NO_TEXT:
            if found[1] or tag in unclosed or tag in ("svg", "math") and found[3].endswith("/"):
                continue
            close = _END_OF[tag].search(html, at)
            if close:
                at = close.end()
            elif tag in TO_THE_END:
                at = len(html)
            else:
                unclosed.add(tag)  # no later one of these is closed either
        elif found[1]:
            page.end(tag)
        else:
            head = head and tag not in BLOCK
            page.start(tag, found[3])
    page.flush()
    return page.blocks


def odds(counts: dict[tuple[str, int, bool], int]) -> dict[str, list[float]]:
    """Per feature and value the log of its share among content over that among boilerplate."""
    out = {}
    for feature, prior in PRIOR.items():
        both = [[p[side] + counts.get((feature, value, side == 0), 0) for value, p in enumerate(prior)] for side in (0, 1)]
        sums = [sum(b) for b in both]
        out[feature] = [max(-FEATURE, min(FEATURE, math.log(c / sums[0]) - math.log(o / sums[1]))) for c, o in zip(*both, strict=True)]
    return out


def links(parents: list[int], between: list[int]) -> list[tuple[int, int, int]]:
    """Edges between blocks with their capacities: neighbours in the page, and nearest blocks of one parent."""
    made, last = [], {}
    for i, (parent, steps) in enumerate(zip(parents, between, strict=True)):
        if i:
            made.append((i - 1, i, round(UNIT * ADJACENT / (1 + max(steps - 2, 0) / 2))))
        if last.get(parent, i - 1) != i - 1:
            made.append((last[parent], i, round(UNIT * SIBLING)))
        last[parent] = i
    return made


def cut(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Content or not, by a minimum cut: positive gains are capacities from the source, negative ones to the sink, edges hold both ways."""
    n = len(gains)
    near: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for a, b, capacity in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += (b, a)
        room += (capacity, capacity)
    supply, demand = [max(g, 0) for g in gains], [max(-g, 0) for g in gains]
    while True:
        # layers from all blocks that have something left to send
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i])
        for i in queue:
            level[i] = 0
        met = False
        while queue:
            i = queue.popleft()
            met = met or demand[i] > 0
            for e in near[i]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not met:
            break
        following = [0] * n
        for start in range(n):
            path: list[int] = []
            i = start
            while supply[start] and level[start] == 0:
                if demand[i]:
                    sent = min(supply[start], demand[i], *(room[e] for e in path)) if path else min(supply[start], demand[i])
                    supply[start] -= sent
                    demand[i] -= sent
                    for e in path:
                        room[e] -= sent
                        room[e ^ 1] += sent
                    # go on from the first edge that is full now
                    full = next((k for k, e in enumerate(path) if not room[e]), None)
                    if full is not None:
                        i = to[path[full] ^ 1]
                        del path[full:]
                    continue
                while following[i] < len(near[i]):
                    e = near[i][following[i]]
                    if room[e] and level[to[e]] == level[i] + 1:
                        break
                    following[i] += 1
                else:
                    if not path:
                        break
                    i = to[path.pop() ^ 1]
                    following[i] += 1
                    continue
                path.append(e)
                i = to[e]
    # what can still reach the sink is boilerplate
    lost = [d > 0 for d in demand]
    queue = deque(i for i in range(n) if lost[i])
    while queue:
        i = queue.popleft()
        for e in near[i]:
            if room[e ^ 1] and not lost[to[e]]:
                lost[to[e]] = True
                queue.append(to[e])
    return [not x for x in lost]


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("text", pa.string()), *[(n, pa.int32()) for n in NUMBERS]])
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            pages = [read(h.decode("utf-8", "replace")) for h in part.column("_html").cast(pa.binary()).to_pylist()]
            rows = [b for page in pages for b in page]
            columns = list(zip(*rows, strict=True)) or [()] * (1 + len(NUMBERS))
            flat = pa.StructArray.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int32()) for c in columns[1:]]], fields=list(kind))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in pages])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("_doc"), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["_doc", "blocks"])


def shape_counts(blocks: DataFrame) -> dict[tuple[str, int, bool], int]:
    """How often every value of a feature stands inside and outside of articles, over all pages: a few dozen rows."""
    seen = blocks.select(F.explode(F.filter("blocks", lambda b: (b["region"] >= ARTICLE) | (b["region"] <= NAMED_OUT))).alias("b"))
    seen = seen.groupBy((F.col("b.region") >= ARTICLE).alias("inside"), *[F.col(f"b.{f}").alias(f) for f in FEATURES]).agg(F.count(F.lit(1)).alias("n"))
    counts: dict[tuple[str, int, bool], int] = {}
    for row in seen.collect():  # at most 2 * 6 * 4 * 2 * 5 rows
        for f in FEATURES:
            key = (f, row[f], row["inside"])
            counts[key] = counts.get(key, 0) + row["n"]
    return counts


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows of ``pages`` without the html packed as ``_doc``, with ``text``."""
    spark = pages.sparkSession
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html]).alias("_doc"), F.coalesce(F.col(html), F.lit("")).alias("_html"))
    blocks = Scratch(spark).keep(rows.mapInArrow(_blocks_of, StructType([rows.schema["_doc"], StructField("blocks", BLOCKS)])), "blocks")
    weights = odds(shape_counts(blocks))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("blocks")
            flat, ends = column.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]).tolist()
            own = {n: flat.field(n).to_numpy(zero_copy_only=False) for n in NUMBERS}
            shape = sum(np.asarray(weights[f])[own[f]] for f in FEATURES)
            gains = np.rint(UNIT * (own["region"] + np.clip(shape, LEAST, MOST))).astype(np.int64).tolist()
            parents, between = own["parent"].tolist(), own["between"].tolist()
            texts = []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                kept = cut(gains[a:b], links(parents[a:b], between[a:b]))
                own_texts = flat.field("text").slice(a, b - a).to_pylist()
                texts.append("\n\n".join(t for t, keep in zip(own_texts, kept, strict=True) if keep))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(texts, pa.string())], names=["_doc", "text"])

    return blocks.mapInArrow(labelled, StructType([rows.schema["_doc"], StructField("text", StringType())]))


def report(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text and its code points."""
    rows = extracted(pages.select("page_id", "url", "html"))
    return rows.select("_doc.page_id", "_doc.url", "text", F.length("text").cast("long").alias("n_chars"))
