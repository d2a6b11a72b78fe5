"""STR-9 (headers), STR-12, STR-13: rate headers of a provider's answers, circuits of workers, phases of campaigns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.values import duration_seconds
from siftline.operators.pin import pinned
from siftline.operators.scans import streaks


def with_observed_headers(log: DataFrame, headers: str = "headers") -> DataFrame:
    """STR-9, reading part: adds the numbers of a response's rate headers (a map with names in any case)."""
    lower = pinned(log, _lower=F.transform_keys(F.col(headers), lambda k, _: F.lower(k)))
    names = {"retry_after": "retry-after"}
    for kind in ("requests", "tokens"):
        for part in ("limit", "remaining", "reset"):
            names[f"{part}_{kind}"] = f"x-ratelimit-{part}-{kind}"
    raw = pinned(lower, **{f"_{n}": F.try_element_at("_lower", F.lit(h)) for n, h in names.items()})
    told = {n: duration_seconds(F.col(f"_{n}")) if n.startswith(("retry", "reset")) else F.col(f"_{n}").try_cast("bigint").cast("double")
            for n in names}
    return raw.withColumns(told).drop("_lower", *[f"_{n}" for n in names])


def circuit_states(calls: DataFrame, key: str, order: list[str], ts: str, ok: Column, mismatch: Column, threshold: int,
                   cooldown_seconds: int, pieces: int | None = None) -> DataFrame:
    """STR-13: failures in a row, openings and the open-until time after every call of a worker."""
    good = ok & ~mismatch
    staged = calls.withColumn("_good", good).withColumn("_mismatch", mismatch)
    code = F.when(F.col("_good"), 0).otherwise(1)
    done = streaks(staged, key, order, code, threshold, forced=F.col("_mismatch"), payload=F.unix_micros(ts), pieces=pieces)
    opens = ~F.col("_good") & (F.col("_mismatch") | (F.col("bad_run") >= threshold))
    until = F.timestamp_micros(F.col("event_at") + cooldown_seconds * 1_000_000)
    return done.withColumns({"consecutive_failures": F.col("bad_run"), "opens": opens, "open_until": until}).drop(
        "_good", "_mismatch", "bad_run", "good_run", "event", "event_at")


def worker_day(circuits: DataFrame, key: str, ts: str, ok: Column, mismatch: Column, items: Column) -> DataFrame:
    """STR-13, daily counters per worker."""
    return circuits.groupBy(key, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("calls"), F.sum(items).alias("items"), F.count_if(~(ok & ~mismatch)).alias("failures"),
        F.count_if(mismatch).alias("mismatches"), F.count_if("opens").alias("circuit_opens"))


def campaign_phases(samples: DataFrame, key: str, ts: str, closing: Column, idle: Column, drain_hours: float) -> DataFrame:
    """STR-12: times a campaign leaves RUNNING, DRAINING and FINALIZING, one step per sample.

    Phases only move forward, so each time is a minimum over the samples after the previous one: three
    aggregates instead of a pass over an ordered series.
    """
    marked = samples.select(key, F.col(ts).alias("_t"), closing.alias("_closing"), idle.alias("_idle"))
    draining = marked.groupBy(key).agg(F.min(F.when(F.col("_closing"), F.col("_t"))).alias("draining_at"))
    idle_rows = marked.filter("_idle").select(key, "_t")
    after = lambda prior, name: (idle_rows.join(prior, key).filter(F.col("_t") > F.col(prior.columns[1]))
                                 .groupBy(key).agg(F.min("_t").alias(name)))
    finalizing = after(draining, "finalizing_at")
    complete = after(finalizing, "completed_at")
    both = draining.join(finalizing, key, "left").join(complete, key, "left")
    phase = (F.when(F.col("completed_at").isNotNull(), "COMPLETE").when(F.col("finalizing_at").isNotNull(), "FINALIZING")
             .when(F.col("draining_at").isNotNull(), "DRAINING").otherwise("RUNNING"))
    deadline = F.timestamp_micros(F.unix_micros("draining_at") + int(drain_hours * 3600 * 1_000_000))
    return both.withColumn("phase", phase).withColumn("semantic_deadline", deadline)
