"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siftline.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of ``edges`` (a, b).

    Alternating star steps: every node hangs its larger neighbours, then its smaller ones, on its smallest neighbour,
    until the edges stop changing.  A step is one aggregate with map-side minima and one join, so a hub costs no more
    than its edges.  Each round starts from a written table.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = scratch.keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        pairs = both(now)
        low = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = pairs.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        large = scratch.keep(large, "large")
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        hung = large.join(down, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
        own = down.select(F.col("m").alias("x"), F.col("b").alias("y"))
        now = scratch.keep(hung.unionByName(own).filter("x <> y")
                           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    scratch.drop("large")
    roots = now.groupBy("b").agg(F.min("a").alias("label")).withColumnRenamed("b", "node")
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
