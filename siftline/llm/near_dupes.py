"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

Words are lower-cased (A-Z) runs without white space; the set of a document has its distinct five-word shingles as 64-bit
hashes, or the whole sequence as one where there are fewer words.  Documents are linked if 100 * |A & B| >= 75 * |A | B|.

1. *Sketch.*  One pass over the texts gives a key of the set (64 bits), a signature of ``BANDS * ROWS`` minima cut into
   band keys, and four bits of every minimum for the comparison.  Equal sets share the key and are one class from here on.
2. *Buckets.*  A bucket holds the classes of one band key; only buckets with two classes or more go on.
3. *Stars instead of pairs.*  Each bucket compares its members with one centre, the member that meets most others.
   Members known to be connected need no further comparison with each other.  What is left, members of a bucket
   without a known connection, is counted exactly.  While that is much more than the bucket rows and a round at least
   halves it, the next centre is taken, one outside the largest connected part; then the rest is compared.  Nothing is
   capped: every two members of a bucket are compared or already connected.
4. *Verification.*  The minima are compared by their bits, in batches, inside the join that brings the members together.
   Four bits agree with chance (1 + 15 * similarity) / 16; with a uniform prior for that chance it is Beta(m+1, n-m+1)
   after m of n agreed.  A pair is dropped as soon as the chance of a similarity of 0.75 or more falls below its share of ``MISS``
   and at most that share of the pairs at 0.75 would be lost with it: all checks together lose at most ``MISS`` of these.  So
   pairs without a future never become rows.  In the last join a pair becomes a row only in the first bucket that it
   shares.  Survivors are confirmed on the full sets.
5. *Components* over confirmed links; the smallest doc_id of a component stays.

With 64 bands of 7 rows a pair at similarity 0.75 shares a bucket with probability 0.9999, at 0.8 with 0.9999999.

Defined cases: a null or wordless text has n_shingles 0 and is linked with nothing; repeated rows are linked and get equal
results; a null id is never a component's smallest one, unless it has no other (then component_id is null and kept true);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from siftline.llm.common import Scratch, mixed, text_batches, whole, word_hashes
from siftline.llm.components import components

SHINGLE = 5
SHARE = 75  # per cent
BANDS, ROWS = 64, 7
PLANES = 4  # bits of a minimum that are compared
BATCHES = BANDS * ROWS // 64  # of 64 minima
CHECKS = (64, 128, 256, 448)  # compared minima after which a pair may be dropped
MISS = 1e-4
PAIRS_PER_ROW = 16  # left-over comparisons per bucket row from which another star round is cheaper
_BLOCK = 32
_BITS = [f"_b{i}" for i in range(BATCHES * PLANES)]
_FACTORS = (mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLACES = mixed(np.arange(101, 101 + SHINGLE, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ROW_FACTORS = mixed(np.arange(301, 301 + ROWS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BAND_SEEDS = mixed(np.arange(501, 501 + BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of hashed words."""
    if words.size == 0:
        return words
    if words.size < SHINGLE:
        rest = words * _PLACES[: words.size]
        return mixed(rest.sum(dtype=np.uint64, keepdims=True) ^ np.uint64(words.size))
    n = words.size - SHINGLE + 1
    total = words[:n] * _PLACES[0]
    for i in range(1, SHINGLE):
        total += words[i : n + i] * _PLACES[i]
    return np.unique(mixed(total))


def minima(items: np.ndarray) -> np.ndarray:
    low = (items >> np.uint64(32)).astype(np.uint32)
    best = np.full(_FACTORS.size, np.iinfo(np.uint32).max, dtype=np.uint32)
    product = np.empty((_BLOCK, _FACTORS.size), dtype=np.uint32)
    for start in range(0, low.size, _BLOCK):
        part = low[start : start + _BLOCK]
        np.multiply(part[:, None], _FACTORS, out=product[: part.size])
        np.minimum(best, product[: part.size].min(axis=0), out=best)
    return best


def bands(best: np.ndarray) -> np.ndarray:
    rows = best.astype(np.uint64).reshape(BANDS, ROWS) + np.uint64(1)
    return mixed((rows * _ROW_FACTORS).sum(axis=1, dtype=np.uint64) + _BAND_SEEDS)


def bits(best: np.ndarray) -> np.ndarray:
    """For every batch of 64 minima a word of their first bits, one of their second bits, and so on."""
    planes = (mixed(best.astype(np.uint64)) >> np.arange(PLANES, dtype=np.uint64)[:, None]) & np.uint64(1)
    return np.packbits(planes.astype(bool), axis=1).view(np.int64).T.reshape(-1)


def set_key(items: np.ndarray) -> int:
    """64-bit key of a set: equal sets have equal keys."""
    total = mixed(items.copy()).sum(dtype=np.uint64, keepdims=True) ^ mixed(np.array([items.size], dtype=np.uint64))
    return int(mixed(total).view(np.int64)[0])


_ROWS_OUT = 128


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [(t or b"").lower() for t in batch.column(name).cast(pa.binary()).to_pylist()]


def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, _ROWS_OUT):
            batch = whole_batch.slice(at, _ROWS_OUT)
            n, key, bit, band = [], [], [], []
            for words in word_hashes(_texts(batch, "_t")):
                items = shingles(words)
                n.append(items.size)
                if items.size == 0:
                    key.append(None), bit.append([0] * len(_BITS)), band.append(None)
                    continue
                best = minima(items)
                key.append(set_key(items))
                bit.append(bits(best))
                band.append(bands(best).view(np.int64))
            columns = np.array(bit, dtype=np.int64).reshape(-1, len(_BITS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_h"), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(band, pa.list_(pa.int64())),
                 *[pa.array(np.ascontiguousarray(c)) for c in columns]], names=["doc_id", "_h", "n", "key", "bands", *_BITS])


def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, _ROWS_OUT):
            batch = whole_batch.slice(at, _ROWS_OUT)
            found = [shingles(words) for words in word_hashes(_texts(batch, "_t"))]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(x) for x in found], pa.int64()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))],
                                             names=["key", "items"])


def bounds(share: int = SHARE, miss: float = MISS, checks: tuple[int, ...] = CHECKS) -> list[tuple[int, int]]:
    """For each number n of compared minima the largest number of differing ones with which a pair goes on.

    The chance of more than t under Beta(m+1, n-m+1) is that of at most m successes in n+1 trials of chance t; here t is
    the chance of the bits to agree, given that it is at least that of unrelated minima.
    """
    def at_most(m: int, trials: int, t: float) -> float:
        return sum(comb(trials, i) * t**i * (1 - t) ** (trials - i) for i in range(m + 1))

    by_chance, all_checks = 0.5**PLANES, miss
    t, out = by_chance + (1 - by_chance) * share / 100, []
    for n in checks:
        # the last check decides what is confirmed; the earlier ones, which only save work, lose a twentieth each
        miss = all_checks / 20 if n != checks[-1] else all_checks * (1 - (len(checks) - 1) / 20)
        m = n
        while m and (at_most(m - 1, n + 1, t) >= miss * at_most(m - 1, n + 1, by_chance) or at_most(m - 1, n, t) > miss):
            m -= 1
        out.append((n, n - m))
    return out


def plausible(left: str, right: str, share: int, miss: float) -> Column:
    """Sequential test of two members in one expression: each batch of bits is looked at only if the ones before allow it."""
    def differing(batch: int) -> Column:
        words = [F.col(f"{left}._b{i}").bitwiseXOR(F.col(f"{right}._b{i}")) for i in range(batch * PLANES, (batch + 1) * PLANES)]
        return F.bit_count(reduce(Column.bitwiseOR, words))

    total, done, test = F.lit(0), 0, F.lit(True)
    for n, most in bounds(share, miss):
        total = reduce(Column.__add__, [differing(i) for i in range(done, n // 64)], total)
        done, test = n // 64, test & (total <= most)
    return test


def first_shared(left: str, right: str) -> Column:
    """Whether the bucket of two members is the first that they share."""
    same = F.zip_with(F.col(f"{left}.bands"), F.col(f"{right}.bands"), lambda p, q: p == q)
    return F.element_at(F.col(f"{left}.bands"), F.array_position(same, True).cast("int")) == F.col(f"{left}.bucket")


def near_duplicates(docs: DataFrame, share: int = SHARE, miss: float = MISS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    text_batches(spark)
    scratch = Scratch(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("_t")).withColumn("_h", F.xxhash64("_t"))
    sketch = scratch.keep(texts.mapInArrow(sketched, "doc_id long, _h long, n long, key long, bands array<long>, " + ", ".join(f"{b} long" for b in _BITS)), "sketch")
    keyed = sketch.filter("key is not null")
    same = [F.first(c).alias(c) for c in ("bands", *_BITS)]  # equal in all documents of a class
    classes = scratch.keep(keyed.groupBy("key").agg(*same, F.min(F.struct("doc_id", "_h")).alias("_r"), F.min("doc_id").alias("first")), "classes")

    placed = classes.select("key", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("key").alias("_a"), F.max("key").alias("_b"), F.count(F.lit(1)).alias("_m"))
    members = scratch.keep(placed.join(shared.filter("_a <> _b").select("bucket", "_m"), "bucket"), "members")
    weight = members.groupBy("key").agg(F.sum("_m").alias("w"))
    nodes = scratch.keep(classes.select("key", "_r", "bands", *_BITS).join(weight, "key"), "nodes")
    links = _confirmed_links(members.select("bucket", "key"), nodes, _full_sets(texts, nodes, scratch), scratch, share, miss)
    labels = scratch.keep(components(links, scratch), "labels")

    rooted = classes.select("key", "first").join(labels, F.col("key") == F.col("node"), "left").select("key", "first", F.coalesce("label", "key").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    resolved = scratch.keep(rooted.join(smallest, "root").select(F.col("key").alias("_key"), "component_id"), "resolved")
    scratch.drop("classes", "members", "nodes", "sets", "links", "labels", "edges")
    out = sketch.select("doc_id", F.col("n").alias("n_shingles"), "key").join(resolved, F.col("key") == F.col("_key"), "left")
    out = out.withColumn("component_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document per group; rows that repeat an id are one document."""
    stay = near_duplicates(docs, **settings).filter("kept").select(F.col("doc_id").alias("_stay")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    return packed.join(stay, F.col("_doc.doc_id").cast("long").eqNullSafe(F.col("_stay")), "left_semi").select("_doc.*")


def _full_sets(texts: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """The full sets of the classes in buckets.  One row stands for a class; its text is found by id and text hash."""
    wanted = nodes.select(F.col("_r.doc_id").alias("_id"), F.col("_r._h").alias("_rh"))
    found = texts.join(wanted.hint("merge"), (F.col("_h") == F.col("_rh")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("_t")
    return scratch.keep(found.mapInArrow(sets, "key long, items array<long>"), "sets")


def _confirmed_links(members: DataFrame, nodes: DataFrame, full: DataFrame, scratch: Scratch, share: int, miss: float) -> DataFrame:
    bits_of = nodes.select("key", *_BITS)
    links = tested = members.sparkSession.createDataFrame([], "a long, b long")
    ranked = scratch.keep(members.join(nodes.select("key", F.struct("w", "key").alias("rank")), "key"), "ranked")
    rows = ranked.withColumn("label", F.col("key"))
    last = before = None
    while True:
        # a bucket is open while it has members without a known connection
        parts = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("_c"))
        per = (parts.groupBy("bucket").agg(F.sum("_c").alias("_m"), F.sum(F.col("_c") * F.col("_c")).alias("_q"), F.max(F.struct("_c", "label")).alias("_top"))
               .filter("_m * _m > _q").select("bucket", F.col("_top.label").alias("_major"), ((F.col("_m") * F.col("_m") - F.col("_q")) / 2).alias("_left"), "_m"))
        per = scratch.keep(per, "open")
        left, open_rows = per.agg(F.coalesce(F.sum("_left"), F.lit(0)), F.coalesce(F.sum("_m"), F.lit(0))).first()
        if not left:
            break
        finish = before is not None and (left <= PAIRS_PER_ROW * open_rows or 2 * left > before)
        before = left
        x = rows.join(per.select("bucket", "_major"), "bucket")
        if finish:
            x = x.join(nodes.select("key", "bands", *_BITS), "key")
            y = x.filter("label <> _major")
            once = (F.col("x.label") == F.col("x._major")) | (F.col("x.key") < F.col("y.key"))
            pairs = x.alias("x").join(y.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.label") != F.col("y.label")) & once
                                      & plausible("x", "y", share, miss) & first_shared("x", "y"))
        else:
            # at first any member may be the centre, then one that the largest connected part has not reached
            eligible = x if last is None else x.filter("label <> _major").join(last, "bucket", "left").filter("_last is null or rank < _last")
            centre = eligible.groupBy("bucket").agg(F.max(F.struct("rank", "label")).alias("_centre")).select("bucket", F.col("_centre.rank").alias("_last"), F.col("_centre.label").alias("_own"))
            centre = scratch.keep(centre, "centre" if last is None else "next centre")
            last = centre.select("bucket", "_last")
            met = x.select("bucket", "key", "label").join(centre, "bucket").filter("label <> _own").select("key", F.col("_last.key").alias("other")).distinct()
            x, y = bits_of.alias("x"), bits_of.alias("y")
            pairs = met.join(x, met["key"] == F.col("x.key")).join(y, (F.col("other") == F.col("y.key")) & plausible("x", "y", share, miss))
        pairs = pairs.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
        pairs = scratch.keep(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        links = scratch.keep(links.unionByName(_confirmed(pairs, full, share)), "links")
        if finish:
            break
        tested = scratch.keep(tested.unionByName(pairs).distinct(), "tested")
        rows = scratch.keep(ranked.join(_connected(links), "key", "left").withColumn("label", F.coalesce("label", "key")), "rows")
    scratch.drop("open", "ranked", "rows", "centre", "next centre", "pairs", "tested")
    return links


def _connected(links: DataFrame, hops: int = 3) -> DataFrame:
    """``key`` and ``label``, the smallest class within some hops and what that class has found.

    Equal labels mean a connection.  Connected classes may still have different labels and are then compared again."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("key"), F.least("a", "label").alias("label"))
    for _ in range(hops - 1):
        near = labels.select(F.col("key").alias("b"), "label")
        reached = both.join(near, "b").groupBy("a").agg(F.min("label").alias("_m"))
        labels = labels.join(reached, F.col("key") == F.col("a")).select("key", F.least("label", "_m").alias("label"))
    ends = labels.select(F.col("key").alias("_k"), F.col("label").alias("_l"))
    return labels.join(ends, F.col("label") == F.col("_k")).select("key", F.col("_l").alias("label"))


def _confirmed(pairs: DataFrame, full: DataFrame, share: int) -> DataFrame:
    """Pairs that hold on the full sets."""
    a, b = full.select(F.col("key").alias("a"), F.col("items").alias("_ia")), full.select(F.col("key").alias("b"), F.col("items").alias("_ib"))
    both = pairs.join(b, "b").join(a, "a")
    common = F.size(F.array_intersect("_ia", "_ib"))
    counted = both.select("a", "b", common.alias("_c"), (F.size("_ia") + F.size("_ib")).alias("_n"))
    return counted.filter(100 * F.col("_c") >= share * (F.col("_n") - F.col("_c"))).select("a", "b").distinct()


SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w)=0 THEN [] WHEN len(w)<5 THEN [array_to_string(w,' ')]
  ELSE list_transform(range(1, len(w)-3), lambda i: array_to_string(w[i:i+4],' ')) END) AS g FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g=y.g AND x.doc_id<y.doc_id GROUP BY 1,2),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n p ON p.doc_id=a JOIN n q ON q.doc_id=b WHERE 100*c >= 75*(p.n+q.n-c)),
u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, root) AS (SELECT DISTINCT a, a FROM u UNION SELECT u.b, r.root FROM r JOIN u ON u.a=r.doc_id),
m AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n,0)::BIGINT AS n_shingles, coalesce(m.root, w.doc_id) AS component_id, coalesce(m.root, w.doc_id)=w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""
