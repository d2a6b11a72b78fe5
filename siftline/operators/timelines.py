"""WIN-7..WIN-9, WIN-11, WIN-12, STR-11: ordered state over a log.

A plain window per key puts a whole series into one task.  Runs and the states that follow from them are segmented scans
(:mod:`siftline.operators.scans`), cut by rows.  Rolling totals are windows over chunks of time, each with the rows that reach into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from siftline.operators.scans import streaks

CHUNK_SECONDS = 3600


def with_chunk(df: DataFrame, ts: str, seconds: int = CHUNK_SECONDS) -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.unix_micros(F.col(ts)) / F.lit(seconds * 1_000_000)))


def rolling_minute(log: DataFrame, key: str, ts: str, amounts: dict[str, Column], seconds: int = 60,
                   chunk_seconds: int = CHUNK_SECONDS) -> DataFrame:
    """WIN-7: totals over the open interval (t - seconds, t] per key.

    Rows of the last ``seconds`` of a chunk are also sent to the next chunk as context and removed again.  Every row enters the
    running total of its chunk at its time and leaves it when the interval is over, so a dense minute costs no more than a
    sparse one.  Only amounts of floating type, whose differences are not exact, are added again for every row.
    """
    micros = F.unix_micros(F.col(ts))
    staged = with_chunk(log, ts, chunk_seconds).withColumn("_t", micros)
    for name, amount in amounts.items():
        staged = staged.withColumn(f"_a_{name}", amount)
    exact = {n for n in amounts if not isinstance(staged.schema[f"_a_{n}"].dataType, T.FractionalType) or isinstance(staged.schema[f"_a_{n}"].dataType, T.DecimalType)}
    late = F.floor((F.col("_t") + seconds * 1_000_000 - 1) / F.lit(chunk_seconds * 1_000_000)) > F.col("_chunk")
    targets = F.when(late, F.array(F.col("_chunk"), F.col("_chunk") + 1)).otherwise(F.array("_chunk"))
    spread = staged.withColumn("_to", F.explode(targets))
    reach = Window.partitionBy(key, "_to").orderBy("_t").rangeBetween(-(seconds * 1_000_000 - 1), 0)
    for name in amounts.keys() - exact:
        spread = spread.withColumn(name, F.sum(f"_a_{name}").over(reach))
    if exact:
        steps = F.array(F.struct(F.lit(1).alias("sign"), F.col("_t").alias("at")), F.struct(F.lit(-1).alias("sign"), (F.col("_t") + seconds * 1_000_000).alias("at")))
        spread = spread.select("*", F.inline(steps).alias("_sign", "_at"))
        upto = Window.partitionBy(key, "_to").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
        for name in exact:
            # a null amount is no amount: a total is null only where the interval holds nothing else
            held = F.sum(F.when(F.col(f"_a_{name}").isNotNull(), F.col("_sign"))).over(upto)
            spread = spread.withColumn(name, F.when(held > 0, F.sum(F.when(F.col("_sign") > 0, F.col(f"_a_{name}")).otherwise(-F.col(f"_a_{name}"))).over(upto)))
        spread = spread.filter("_sign = 1").drop("_sign", "_at")
    helpers = ["_t", "_chunk", "_to", *[f"_a_{n}" for n in amounts]]
    names = [*[c for c in log.columns if c not in amounts], *amounts]
    return spread.filter(F.col("_to") == F.col("_chunk")).drop(*helpers).select(*[F.col(f"`{c}`") for c in names])


def hysteresis(samples: DataFrame, key: str, ts: str, value: str, high: float, low: float, out: str = "draining",
               pieces: int | None = None) -> DataFrame:
    """WIN-8: on at or above ``high``, off at or below ``low``, unchanged between them."""
    if not low < high:
        raise ValueError("low threshold must be below the high one")
    mark = F.when(F.col(value) >= high, 1).when(F.col(value) <= low, 0)
    done = streaks(samples, key, [ts], mark, 1, 1, pieces=pieces)
    return done.withColumn(out, F.coalesce(F.col("event") == 1, F.lit(False))).drop("bad_run", "good_run", "event", "event_at")


def streak_state(samples: DataFrame, key: str, order: list[str], ts: str, bad: Column, to_bad: int, to_good: int,
                 names: tuple[str, str] = ("cloud", "device"), pieces: int | None = None) -> DataFrame:
    """WIN-9: switch after ``to_bad`` bad samples in a row, back after ``to_good`` good ones.

    Samples whose ``bad`` is null are unknown: they keep the state and do not break a run.
    """
    done = streaks(samples.withColumn("_known", bad.isNotNull()), key, order, bad.cast("int"), to_bad, to_good, pieces=pieces)
    return done.withColumns({"bad_run": F.when(F.col("_known"), F.col("bad_run")), "good_run": F.when(F.col("_known"), F.col("good_run")),
                             "mode": F.when(F.col("event") == 1, F.lit(names[1])).otherwise(F.lit(names[0]))}).drop("_known", "event", "event_at")


def failure_streak(runs: DataFrame, key: str, order: list[str], ts: str, failed: Column, limit: int, pieces: int | None = None) -> DataFrame:
    """WIN-11: failures in a row at each run, and whether the source is switched off by then.

    A source that reached the limit stays off: nothing in the log switches it on again.
    """
    done = streaks(runs, key, order, failed.cast("int"), limit, pieces=pieces)
    return done.withColumns({"failures": F.col("bad_run"), "disabled": F.col("event").isNotNull()}).drop("bad_run", "good_run", "event", "event_at")


def heartbeat(beats: DataFrame, role: str, ts: str, ok: Column, as_of: Column, stall_seconds: float) -> DataFrame:
    """WIN-12: age of the newest heartbeat per role and the assessment that follows from it."""
    latest = beats.groupBy(role).agg(F.max(ts).alias("last_at"), F.max_by(ok, F.col(ts)).alias("http_ok"))
    age = F.greatest(F.lit(0.0), (F.unix_micros(as_of) - F.unix_micros("last_at")) / 1e6)
    state = (F.when(~F.col("http_ok"), "render_unreachable").when(F.col("age") > stall_seconds, "scheduler_stalled")
             .otherwise("cloud_healthy"))
    return latest.withColumn("age", age).withColumn("assessment", state)


def mode_ladder(metrics: DataFrame) -> DataFrame:
    """STR-11: collection mode of every sample from its flags
    (pressure, paused, campaign_status, draining)."""
    closing = F.col("campaign_status").isin("DRAINING", "FINALIZING")
    mode = (F.when(F.col("pressure"), "storage_pressure")
            .when(F.col("paused") & (F.col("campaign_status") != "COMPLETE"), "paused")
            .when(F.col("campaign_status") == "COMPLETE", "campaign_complete")
            .when(closing | F.col("draining"), "drain").otherwise("collect"))
    return metrics.withColumn("mode", mode)
