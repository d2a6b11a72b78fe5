"""H-3, JN-19, FLT-15, SRT-5: the bounded per-source sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftline.operators.decisions import PRIORITY, sample_priority

LEVELS = max(PRIORITY.values())


def bounded_sample(captures: DataFrame, cap: int, order: str = "pos", source: str = "source", level: str = "priority",
                   held: DataFrame | None = None, record: str | None = None, latest: tuple[str, ...] = ()) -> DataFrame:
    """H-3 without a fold: the rows a full sample still holds after all captures in ``order``.

    With capacity N the number of held rows of level >= k is always min(N, captures of level >= k so
    far).  So a row of level k enters exactly when it is among the first N of level >= k, and at the end
    the newest min(N, C_k) - min(N, C_k+1) entrants of level k remain, because eviction takes the oldest.
    Both are ranks with a limit, which Spark cuts map-side: a hot source never meets in one task.

    ``held`` is an earlier sample of the same shape; only its rows count as already captured.  With ``record``, the column
    that names a record within its source, repeats take no place of their own (:func:`without_repeats`).
    """
    if record:
        captures, held = without_repeats(captures, held, record, order, source, level, latest)
    rows = captures if held is None else held.unionByName(captures.select(*held.columns))
    floors = rows.select(source, order, level, F.explode(F.sequence(F.lit(0), F.col(level))).alias("_k"))
    first = Window.partitionBy(source, "_k").orderBy(order)
    ranked = floors.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= cap)
    entered = ranked.filter(F.col("_k") == F.col(level)).select(source, order, level)
    per = ranked.groupBy(source, "_k").agg(F.count(F.lit(1)).alias("_c"))
    upper = per.select(source, (F.col("_k") - 1).alias("_k"), F.col("_c").alias("_up"))
    room = per.join(upper, [source, "_k"], "left").select(
        source, F.col("_k").alias(level), (F.col("_c") - F.coalesce("_up", F.lit(0))).alias("_stay"))
    newest = Window.partitionBy(source, level).orderBy(F.col(order).desc())
    kept = (entered.join(room, [source, level]).withColumn("_n", F.row_number().over(newest))
            .filter(F.col("_n") <= F.col("_stay")).select(source, order))
    return rows.join(kept, [source, order], "left_semi")


def without_repeats(captures: DataFrame, held: DataFrame | None, record: str, order: str = "pos", source: str = "source",
                    level: str = "priority", latest: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame | None]:
    """Captures of records that are not held, one row each, and the held rows updated by the other captures.

    A row keeps its place and the columns of its first capture, takes the highest level, and the columns ``latest`` from the newest
    capture.  Captures of one call are merged before they meet the sample; a record without an id is never a repeat.
    """
    ids = [source, record]
    rest = [c for c in captures.columns if c not in (*ids, level, *latest)]
    first, newest = F.min_by(F.struct(*rest), F.col(order)), F.max_by(F.struct(F.lit(0).alias("_"), *latest), F.col(order))
    one = (captures.filter(F.col(record).isNotNull()).groupBy(*ids).agg(first.alias("_f"), newest.alias("_n"), F.max(level).alias(level))
           .select(*ids, level, "_f.*", *[f"_n.{c}" for c in latest]).select(*captures.columns))
    unnamed = captures.filter(F.col(record).isNull())
    if held is None:
        return one.unionByName(unnamed), None
    on = lambda a, b: a[source].eqNullSafe(b[source]) & (a[record] == b[record])
    again = one.select(*ids, F.struct(F.col(level).alias("level"), *latest).alias("_new"))
    met = held.join(again, on(held, again), "left").select(*[held[c] for c in held.columns], again["_new"].alias("_new"))
    updated = met.withColumns({level: F.greatest(level, "_new.level"), **{c: F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")) for c in latest}})
    return one.join(held, on(one, held), "left_anti").unionByName(unnamed), updated.drop("_new")


def capture_rows(records: DataFrame, outcome: Column, text_limit: int | None = None) -> DataFrame:
    rows = records.withColumn("outcome", outcome).withColumn("priority", sample_priority(F.col("outcome")))
    return rows.withColumn("text", F.left("text", F.lit(text_limit))) if text_limit else rows


def update_samples(samples: DataFrame, changes: DataFrame) -> DataFrame:
    """JN-19: outcome, merged detail and highest priority per candidate; a null outcome only adds detail."""
    c = changes.select("candidate_id", F.col("outcome").alias("_o"), F.col("detail").alias("_d"))
    staged = samples.join(c, "candidate_id", "left")
    none = F.create_map().cast("map<string,string>")
    old, new = F.coalesce("detail", none), F.coalesce("_d", none)
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)
    outcome = F.coalesce("_o", "outcome")
    level = F.when(F.col("_o").isNull(), F.col("priority")).otherwise(F.greatest("priority", sample_priority(outcome)))
    return staged.withColumns({"detail": merged, "priority": level, "outcome": outcome}).drop("_o", "_d")


def erase(samples: DataFrame, source: str | None = None, source_record_id: str | None = None) -> DataFrame:
    """FLT-15: rows that stay after an erasure by source and/or record id."""
    hit = F.lit(True)
    if source:
        hit = hit & (F.col("source") == source)
    if source_record_id:
        hit = hit & (F.col("source_record_id") == source_record_id)
    return samples.filter(~F.coalesce(hit, F.lit(False)))


def listing(samples: DataFrame, source: str | None = None, limit: int = 200) -> DataFrame:
    """SRT-5."""
    rows = samples.filter(F.col("source") == source) if source else samples
    return rows.orderBy("source", F.col("priority").desc(), "captured_at").limit(limit)
