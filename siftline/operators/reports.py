"""AGG-1..8, 13..17, 19..23, WIN-6, WIN-10: counters, usage, quality and funnel reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftline.functions.text import fold_case
from siftline.operators.delivery import qualified

TICKS = 10_000_000_000


def daily_counters(events: DataFrame) -> DataFrame:
    """AGG-1: additive counters ``(day, source, name, value)`` from ``(ts, source, name, amount)``."""
    return events.groupBy(F.to_date("ts").alias("day"), "source", "name").agg(F.sum("amount").alias("value"))


def merge_counters(stored: DataFrame, added: DataFrame) -> DataFrame:
    """AGG-1 upsert: the stored table and new amounts summed again."""
    return stored.unionByName(added).groupBy("day", "source", "name").agg(F.sum("value").alias("value"))


def day_totals(counters: DataFrame, day: Column) -> DataFrame:
    """AGG-2: totals by name for a day, without the source ``all``."""
    return counters.filter((F.col("day") == day) & (F.col("source") != "all")).groupBy("name").agg(F.sum("value").alias("value"))


def source_stats(counters: DataFrame, names: list[str]) -> DataFrame:
    """AGG-3: counters as columns per source with the conversion rate."""
    wide = counters.groupBy("source").pivot("name", names).agg(F.sum("value")).na.fill(0, names)
    scanned = F.col("raw_scanned") if "raw_scanned" in names else F.lit(0)
    valid = F.col("validated") if "validated" in names else F.lit(0)
    return wide.withColumn("conversion_rate", valid / F.greatest(F.lit(1), scanned))


def status_counts(rows: DataFrame, kind: str, column: str = "status") -> DataFrame:
    """AGG-4, AGG-20."""
    return rows.groupBy(F.col(column).alias("status")).agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))


def backlog(records: DataFrame) -> DataFrame:
    """AGG-5."""
    return records.filter(F.col("status") == "PENDING").agg(F.count(F.lit(1)).alias("pending"), F.min("created_at").alias("oldest"))


def accepted(finals: DataFrame, batches: DataFrame, campaign_id: str, started_at: Column) -> DataFrame:
    """AGG-6, AGG-7: qualified finals and other rows, pending plus acknowledged since the campaign start."""
    mine = batches.filter((F.col("status") == "ACKNOWLEDGED") & (F.col("campaign_id") == campaign_id) & (F.col("created_at") >= started_at))
    done = mine.agg(F.coalesce(F.sum("qualified_count"), F.lit(0)).alias("dq"),
                    F.coalesce(F.sum(F.col("count") - F.col("qualified_count")), F.lit(0)).alias("dn"))
    waiting = finals.agg(F.count_if(qualified(F.col("email"), F.col("validation_status"))).alias("pq"),
                         F.count_if(F.col("validation_status") == "NO_EMAIL").alias("pn"))
    # two one-row tables side by side
    return waiting.crossJoin(done).select((F.col("pq") + F.col("dq")).alias("accepted_finals"),
                                          (F.col("pn") + F.col("dn")).alias("non_qualified_rows"))


def progress(accepted_row: DataFrame, final_target: int, raw_target: int, raw_scanned: Column) -> DataFrame:
    """AGG-8."""
    done = F.col("accepted_finals")
    return accepted_row.select(
        F.lit(final_target).cast("long").alias("final_target"), done, F.greatest(F.lit(0), F.lit(final_target) - done).alias("finals_remaining"),
        (done >= final_target).alias("final_target_reached"), F.lit(raw_target).cast("long").alias("raw_target"),
        raw_scanned.alias("raw_scanned"), F.greatest(F.lit(0), F.lit(raw_target) - raw_scanned).alias("raw_remaining"))


def usage(log: DataFrame, zone: Column, price_in: float, price_out: float) -> DataFrame:
    """AGG-13: requests, tokens and cost per provider and the provider's own day; billed ticks win over the estimate."""
    estimate = (F.col("input_tokens") * price_in + F.col("output_tokens") * price_out) / 1e6
    billed = F.when(F.col("ticks") >= 0, F.col("ticks") / TICKS)
    day = F.to_date(F.from_utc_timestamp("ts", zone))
    return log.groupBy(day.alias("day"), "provider").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.sum(F.coalesce(billed, estimate)).alias("cost"))


def allowances(log: DataFrame, as_of: Column, request_cap: int, token_cap: int) -> DataFrame:
    """AGG-14: today's use, rest, cooldown, 429s and deferrals per organisation, one pass over the log
    ``(org, ts, code, status, tokens, next_allowed_at)``."""
    today = F.to_date("ts") == F.to_date(as_of)
    ok = today & (F.col("code") == "ok")
    per = log.groupBy("org").agg(
        F.count_if(ok).alias("requests_today"), F.coalesce(F.sum(F.when(ok, F.col("tokens"))), F.lit(0)).alias("reserved_tokens_today"),
        F.count_if(F.col("status") == 429).alias("responses_429"),
        F.count_if((F.col("status") >= 400) & (F.col("status") != 429)).alias("error_responses"),
        F.count_if((F.col("code") != "ok") & (F.col("status") != 429)).alias("admission_deferrals"),
        F.coalesce(F.max("next_allowed_at") > as_of, F.lit(False)).alias("cooling_down"))
    return per.withColumns({
        "requests_remaining": F.greatest(F.lit(0), F.lit(request_cap) - F.col("requests_today")),
        "tokens_remaining": F.greatest(F.lit(0), F.lit(token_cap) - F.col("reserved_tokens_today"))})


def precision_at(scored: DataFrame, k: int, order: list[Column], positive: Column) -> DataFrame:
    """WIN-6: precision of the best k rows; a top-k sort, never a window over the whole table."""
    return scored.select(positive.alias("p"), *[c.alias(f"o{i}") for i, c in enumerate(order)]).orderBy(
        *[f"o{i}" for i in range(len(order))]).limit(k).agg(F.avg(F.col("p").cast("double")).alias("precision"))


def quality(scored: DataFrame, positive: Column, predicted: Column) -> DataFrame:
    """AGG-15: precision, false positive rate and accuracy."""
    c = scored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives"),
        F.count_if(positive & predicted).alias("tp"), F.count_if(~positive & predicted).alias("fp"),
        F.count_if(~positive & ~predicted).alias("tn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return c.select("rows", "positives", "negatives", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("positive_precision"),
                    ratio(F.col("fp"), F.col("negatives")).alias("negative_false_positive_rate"),
                    ratio(F.col("tp") + F.col("tn"), F.col("rows")).alias("accuracy"))


def classification_report(rows: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """AGG-16: precision, recall, F1 and support per label; a zero denominator gives zero."""
    cells = rows.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))
    side = lambda col: cells.groupBy(F.col(col).alias("label")).agg(F.sum("n").alias(f"_{col}"))
    hits = cells.filter(F.col(label) == F.col(predicted)).select(F.col(label).alias("label"), F.col("n").alias("_hit"))
    both = side(label).join(side(predicted), "label", "full_outer").join(hits, "label", "left").na.fill(0)
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    precision, recall = ratio(F.col("_hit"), F.col(f"_{predicted}")), ratio(F.col("_hit"), F.col(f"_{label}"))
    both = both.withColumn("precision", precision).withColumn("recall", recall)
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return both.select("label", "precision", "recall", f1.alias("f1"), F.col(f"_{label}").alias("support"))


def report_averages(report: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of a classification report."""
    parts = [F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")]
    parts += [(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")]
    return report.agg(*parts, F.sum("support").alias("support"))


def shares(rows: DataFrame, column: str) -> DataFrame:
    """AGG-17: count and percentage per value; the total is taken over the few grouped rows."""
    per = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def identity_seen(rows: DataFrame, at: str = "seen_at") -> DataFrame:
    """AGG-19: first and last time of an identity and its latest address hash."""
    return rows.groupBy("identity_hash").agg(
        F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"),
        F.max_by("email_hash", F.when(F.col("email_hash").isNotNull(), F.col(at))).alias("email_hash"))


def duplicate_accounting(verdicts: DataFrame, scanned: DataFrame | None = None) -> DataFrame:
    """AGG-21: stored, duplicates and discovery rejects per source."""
    per = verdicts.groupBy("source").agg(F.count_if(F.col("verdict") == "stored").alias("stored"),
                                         F.count_if(F.col("verdict") == "duplicate").alias("duplicates"))
    if scanned is None:
        return per
    joined = scanned.join(per, "source", "left").na.fill(0, ["stored", "duplicates"])
    return joined.withColumn("discovery_rejected", F.greatest(F.lit(0), F.col("scanned") - F.col("stored") - F.col("duplicates")))


def provider_counters(results: DataFrame) -> DataFrame:
    """AGG-22."""
    return results.groupBy("source", "provider", "org").agg(F.count(F.lit(1)).alias("classified"))


def funnel(stages: DataFrame, names: list[str], by: str = "source") -> DataFrame:
    """AGG-23: rows per stage and source in one pass; ``stages`` has one boolean column per stage."""
    return stages.groupBy(by).agg(F.count(F.lit(1)).alias("scanned"), *[F.count_if(F.col(n)).alias(n) for n in names])


def last_wins(rows: DataFrame, text: str = "text", pos: str = "pos") -> DataFrame:
    """WIN-10: one row per trimmed folded text: the content of the last, at the position of the first."""
    keyed = rows.filter(F.trim(F.col(text)) != "").withColumn("_k", F.sha2(fold_case(F.trim(F.col(text))), 256))
    others = [c for c in rows.columns if c != pos]
    picked = keyed.groupBy("_k").agg(F.min(pos).alias("first_pos"), F.max(pos).alias(pos))
    return keyed.select(pos, *others).join(picked.select(pos, "first_pos"), pos).select(F.col("first_pos").alias(pos), *others)
