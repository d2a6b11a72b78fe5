"""Mixing sources to target weights by capped water-filling.

Sizes are words.  Sources in code point order, null last, weigh 1, 2, 3, repeating, and share all words of the input.
A source is never asked for more than ``CAP`` times its size; what it cannot give is shared among the others by weight
until nobody is above its cap.  Every document is taken ``floor(target / size)`` times; the missing fraction is one more
repetition of the first documents in a seeded hash order, cut where the sum comes nearest to the target, so that a source
misses its target by half a document at most.  The hash depends on the seed and the id alone: reruns agree.

Defined cases: a null text has size 0; a null source is a source of its own; documents with equal id and size are taken
alike; a null id hashes as the empty text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window

from siftline.llm.common import WORD, Scratch, whole

CAP = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
BUCKET_DIGITS = 3  # hexadecimal digits of the hash that name a bucket: 4,096 buckets a source
BROADCAST_SOURCES = 10_000  # a table of sources with at most so many rows is broadcast


def words_in(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def order_hash(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


@dataclass
class Plan:
    """``sized``: doc_id, source, size, hash of every row.  ``shares``: a row per source with its target and its cut."""

    sized: DataFrame
    shares: DataFrame
    few: bool

    def shared(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_copies``, ``source_size`` and ``target``; rows bring source, doc_id, ``_size`` and ``_hash``."""
        shares = F.broadcast(self.shares) if self.few else self.shares
        joined = rows.join(shares, rows["source"].eqNullSafe(shares["_source"]), "left")
        place = F.struct(F.col("_hash"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("_size"))
        return joined.withColumn("_copies", F.col("_whole") + F.when(place <= F.col("_cut"), 1).otherwise(0)).drop("_source", "_whole", "_cut")


def weighted(sources: DataFrame, scratch: Scratch, weights: tuple[int, ...]) -> DataFrame:
    """Adds the weight by rank in code point order, null last.  Ranks are counted per range of names."""
    ranged = scratch.keep(sources.withColumn("_last", F.col("_source").isNull()).repartitionByRange("_last", "_source")
                          .withColumn("_part", F.spark_partition_id()), "ranges")
    offsets, total = [], 0
    for row in ranged.groupBy("_part").count().orderBy("_part").collect():  # a row per task
        offsets += [F.lit(row["_part"]), F.lit(total)]
        total += row["count"]
    if not offsets:
        return ranged.withColumn("weight", F.lit(weights[0])).drop("_part", "_last")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_last", "_source")) - 1
    rank = inside + F.element_at(F.create_map(*offsets), F.col("_part"))
    return ranged.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))).drop("_part", "_last")


def water_level(sources: DataFrame, cap: int) -> float:
    """Words per unit of weight once every source above its cap has been clamped."""
    level, clamped = 0.0, -1
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while True:
        above = F.col("weight") * F.lit(level) > cap * F.col("source_size")
        n, given, rest = sources.agg(F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(above, cap * F.col("source_size"))), F.lit(0)),
                                     F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if rest == 0:
            return level
        if n == clamped:
            return level
        clamped, level = n, (total - given) / rest


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> Plan:
    """Targets per source and the place in the hash order where the last, fractional repetition ends."""
    scratch = Scratch(docs.sparkSession)
    sized = scratch.keep(docs.select("doc_id", "source", words_in().alias("_size"), order_hash(seed).alias("_hash")), "sized")
    bucket = F.substring("_hash", 1, BUCKET_DIGITS)
    buckets = scratch.keep(sized.groupBy(F.col("source").alias("_source"), bucket.alias("_bucket")).agg(F.sum("_size").alias("_words")), "buckets")
    sources = scratch.keep(weighted(buckets.groupBy("_source").agg(F.sum("_words").alias("source_size")), scratch, weights), "sources")
    level = water_level(sources, cap)
    wanted = F.col("weight") * F.lit(level)
    target = F.when(wanted > cap * F.col("source_size"), (cap * F.col("source_size")).cast("double")).otherwise(wanted.cast("double"))
    targets = (sources.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(target))
               .withColumn("_whole", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("long"))
               .withColumn("_more", F.col("target") - F.col("_whole") * F.col("source_size")))
    # the bucket of each source in which the fraction ends, and what the buckets before it hold
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = (buckets.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
            .join(targets.select(F.col("_source").alias("_s"), "_more"), F.col("_source").eqNullSafe(F.col("_s")))
            .filter(F.col("_before") <= F.col("_more")))
    last = scratch.keep(ends.groupBy("_source").agg(F.max(F.struct("_bucket", "_before", "_more")).alias("_e")).select("_source", "_e.*"), "last")
    place = F.struct(F.col("_hash"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("_size"))
    inside = (sized.withColumn("_b", bucket).join(last, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_b") == F.col("_bucket")))
              .withColumn("_place", place))
    running = Window.partitionBy("_source").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("_sum", F.col("_before") + F.sum("_size").over(running))
    taken = F.max(F.when(2 * F.col("_sum") - F.col("_size") <= 2 * F.col("_more"), F.col("_place"))).alias("_cut")
    # nothing of the bucket fits: the cut lies before it
    floor = F.struct(F.first("_bucket").alias("_hash"), F.lit("").alias("id"), F.lit(-1).cast("long").alias("_size"))
    cuts = reached.groupBy("_source").agg(F.coalesce(taken, floor).alias("_cut")).withColumnRenamed("_source", "_s")
    shares = scratch.keep(targets.join(cuts, F.col("_source").eqNullSafe(F.col("_s")), "left")
                          .select("_source", "source_size", "target", "_whole", "_cut"), "shares")
    few = shares.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    scratch.drop("buckets", "sources", "last", "ranges")
    return Plan(sized, shares, few)


def decisions(docs: DataFrame, **settings) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target of its source, and the words that the mix takes of it."""
    made = plan(docs, **settings)
    return made.shared(made.sized).select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                                          (F.col("_copies") * F.col("_size")).cast("long").alias("taken"))


def mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixture itself: every document as often as it is taken, with the columns of ``docs``."""
    made = plan(docs, **settings)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", "source",
                         words_in().alias("_size"), order_hash(settings.get("seed", SEED)).alias("_hash"))
    copies = made.shared(packed).filter(F.col("_copies") > 0)
    return copies.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_doc.*")


SQL = r"""WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text,''),'[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5('mix:'||coalesce(CAST(doc_id AS VARCHAR),'')) AS h FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS s, 1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) AS w FROM sized GROUP BY source),
steps AS (SELECT *, row_number() OVER o AS k, (sum(s) OVER () - coalesce(sum(3*s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
  FROM sources WINDOW o AS (ORDER BY 3.0*s/w, source NULLS LAST)),
level AS (SELECT arg_min(level, k) AS level FROM steps WHERE level * w <= 3*s),
targets AS (SELECT source, s, CASE WHEN w*level > 3*s THEN (3*s)::DOUBLE ELSE w*level END AS target FROM sources, level),
shares AS (SELECT *, CASE WHEN s = 0 THEN 0 ELSE floor(target/s)::BIGINT END AS n FROM targets),
placed AS (SELECT d.doc_id, d.size, x.s, x.target, x.n, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, CAST(d.doc_id AS VARCHAR), d.size
  ROWS UNBOUNDED PRECEDING) AS upto FROM sized d JOIN shares x ON d.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, size, s AS source_size, target, (size * (n + CASE WHEN 2*upto - size <= 2*(target - n*s) THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed"""
