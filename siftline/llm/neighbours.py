"""Approximate nearest neighbours by a permutation index.

A bounded sample of vectors are the pivots.  Every vector is represented by its ``PREFIX`` nearest pivots in order; equal
vectors are one entry.  Entries are dealt to shards of about ``SHARD``; within a shard each pivot has an inverted file
with the entries that name it and the place where they do.  A query reads the files of its own pivots and adds up how
much nearer each place is than an absent one, which ranks all entries by footrule distance.  The best
``RERANK`` share of every shard (at least ``LEAST`` entries overall) is reranked by the cosine of the original vectors in
double precision, and the best of all shards are merged.

Queries meet shards in blocks: a group is one block of queries and one shard, so memory does not depend on the size of
either table.

Nothing is left out of the index.  Recall is that of the reranked share: on the test vectors, which have no clusters,
512 pivots, prefixes of 128 and a share of 0.15 find 0.97 to 0.99 of the five nearest.

Defined cases: vectors that are null, zero, hold null or non-finite components, have a null id or another length than most
take no part; rows with equal id count once, with the smallest vector; equal vectors tie and the smaller id comes first;
with fewer candidates than wanted all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from siftline.llm.common import Scratch

PIVOTS, PREFIX = 512, 128
SHARD, BLOCK = 1024, 1024
RERANK, LEAST = 0.15, 1000
NEAREST, EVERY = 5, 50
SALTS = 64


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part, one per id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sizes = rows.groupBy(F.size("embedding").alias("_n")).count().orderBy(F.desc("count"), "_n").limit(1).select("_n")
    length = sizes.first()
    return rows.filter(F.size("embedding") == (length["_n"] if length else 0))


def permutations(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots in order, by cosine; ties to the smaller number."""
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.argsort(-(units @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


class InvertedFiles:
    """For every pivot the entries of a shard that name it, and at which place."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.size, self.prefix = orders.shape
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.entry, self.place = (by_pivot // self.prefix).astype(np.int64), by_pivot % self.prefix
        self.starts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def nearness(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of all entries to a query, as the amount by which it falls short of having no pivot in common."""
        spans = [(self.starts[p], self.starts[p + 1]) for p in order]
        read = np.concatenate([np.arange(a, b) for a, b in spans])
        own = np.repeat(np.arange(self.prefix), [b - a for a, b in spans])
        return np.bincount(self.entry[read], weights=self.prefix - np.abs(own - self.place[read]), minlength=self.size)


def cosines(query: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.clip((others * query).sum(axis=1) / (np.sqrt((query * query).sum()) * np.sqrt((others * others).sum(axis=1))), -1.0, 1.0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.chunked_array([column]).combine_chunks() if isinstance(column, pa.Array) else column.combine_chunks()
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


def _searched(pivots: np.ndarray, least: int, rerank: float, keep: int):
    prefix = min(PREFIX, len(pivots))

    def search(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "entry": [], "score": []}
        if entries.num_rows and queries.num_rows:
            entries, queries = entries.sort_by("entry"), queries.sort_by("entry")
            ids, vectors = np.asarray(entries.column("entry")), _matrix(entries.column("embedding"))
            files = InvertedFiles(permutations(vectors, pivots, prefix), len(pivots))
            names, asked = np.asarray(queries.column("entry")), _matrix(queries.column("embedding"))
            orders = permutations(asked, pivots, prefix)
            n = min(len(ids), max(least, int(np.ceil(rerank * len(ids)))))
            for name, vector, order in zip(names, asked, orders, strict=True):
                near = np.arange(len(ids)) if n == len(ids) else np.argpartition(-files.nearness(order), n - 1)[:n]
                score = cosines(vector, vectors[near])
                best = np.lexsort((ids[near], -score))[:keep]
                out["query"] += [name] * len(best)
                out["entry"] += ids[near][best].tolist()
                out["score"] += score[best].tolist()
        return pa.table({"query": pa.array(out["query"], pa.int64()), "entry": pa.array(out["entry"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    return search


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, rerank: float = RERANK, shard: int = SHARD, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every id divisible by ``every``."""
    scratch = Scratch(vectors.sparkSession)
    same = F.struct(F.xxhash64("embedding").alias("a"), F.xxhash64(F.lit(1), "embedding").alias("b"))
    rows = scratch.keep(usable(vectors).withColumn("_same", same), "usable")
    # equal vectors are one entry; of its ids the k + 1 smallest can be among the nearest of anybody
    salted = Window.partitionBy("_same", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).orderBy("vec_id")
    first = rows.select("_same", "vec_id", F.row_number().over(salted).alias("_r")).filter(F.col("_r") <= k + 1)
    first = first.withColumn("_r", F.row_number().over(Window.partitionBy("_same").orderBy("vec_id"))).filter(F.col("_r") <= k + 1)
    ids = first.groupBy("_same").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = scratch.keep(rows.groupBy("_same").agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("entry")), "entries")
    n = entries.count()
    sample = entries.orderBy(F.xxhash64(F.lit(7), "entry"), "entry").limit(PIVOTS).select("embedding").collect()
    if not sample:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    pivots = np.array([r["embedding"] for r in sample], dtype=np.float64)
    pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)

    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "_same")
    classes = entries.join(asked.select("_same").distinct(), "_same", "left_semi").select(F.col("entry").alias("entry"), F.col("embedding").alias("embedding"))
    shards = -(-n // shard)
    blocks = max(1, -(-classes.count() // BLOCK))
    # both numbers are int on both sides: groups of unlike types would be hashed to unlike partitions and never meet
    spread = lambda df, own, n_own, other, n_other: df.withColumn(own, F.pmod(F.xxhash64("entry"), F.lit(n_own)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))
    indexed = spread(entries.select("entry", "embedding"), "_shard", shards, "_block", blocks)
    posed = spread(classes, "_block", blocks, "_shard", shards)
    search = _searched(pivots, -(-least // shards), rerank, k + 1)
    found = indexed.groupBy("_shard", "_block").cogroup(posed.groupBy("_shard", "_block")).applyInArrow(search, "query long, entry long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    found = found.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k + 1).drop("_r")
    found = scratch.keep(found, "found")

    own = asked.join(entries.select("_same", F.col("entry").alias("query")), "_same").select("query_id", "query")
    spelled = found.join(ids.select("entry", "ids"), "entry").select("query", F.explode("ids").alias("vec_id"), "score")
    met = own.join(spelled, "query").filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
