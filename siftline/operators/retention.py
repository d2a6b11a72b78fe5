"""FLT-7, FLT-11, JN-10, JN-11, SRT-1..SRT-4: work selection and expiry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TERMINAL = ["NO_CONTACT", "CONTACT_REVIEW", "DEFERRED", "REVIEW"]
OPEN = ["VALIDATE", "CLASSIFY"]


def before(as_of: Column, **span: float) -> Column:
    seconds = span.get("days", 0) * 86_400 + span.get("hours", 0) * 3_600
    return F.timestamp_micros(F.unix_micros(as_of) - int(seconds * 1_000_000))


def due(rows: DataFrame, stage: str, as_of: Column) -> DataFrame:
    """FLT-7."""
    return rows.filter((F.col("status") == stage) & (F.col("available_at") <= as_of))


def ranked_work(rows: DataFrame, limit: int) -> DataFrame:
    """SRT-1."""
    return rows.orderBy(F.col("rank_score").desc(), F.col("score").desc(), "created_at", "candidate_id").limit(limit)


def oldest(rows: DataFrame, limit: int, at: str = "created_at", tie: str = "id") -> DataFrame:
    """SRT-2, SRT-3."""
    return rows.orderBy(at, tie).limit(limit)


def newest(rows: DataFrame, limit: int, at: str = "created_at", tie: str = "id") -> DataFrame:
    """SRT-4, SRT-7."""
    return rows.orderBy(F.col(at).desc(), F.col(tie).desc()).limit(limit)


def raw_expired(records: DataFrame, as_of: Column, days: float) -> DataFrame:
    """FLT-11: processed raw rows past their age; pending rows never expire."""
    return records.filter((F.col("status") != "PENDING") & (F.col("created_at") < before(as_of, days=days)))


def semantic_pending(candidates: DataFrame, ranking: DataFrame) -> DataFrame:
    """JN-11: candidates waiting for a semantic result."""
    waiting = ranking.filter(F.col("route") == "SEMANTIC").select("candidate_id").distinct()
    return candidates.filter(F.col("status") == "CLASSIFY").join(waiting, "candidate_id", "left_semi")


def candidates_expired(candidates: DataFrame, ranking: DataFrame, finals: DataFrame, as_of: Column, review_hours: float,
                       candidate_days: float, pressure: bool = False, semantic_due: bool = False) -> DataFrame:
    """FLT-11 with JN-10 and JN-11: expired candidates that have no undelivered final."""
    late = F.lit(pressure) | (F.col("available_at") < before(as_of, hours=review_hours))
    old = ~F.col("status").isin(OPEN + TERMINAL) & (F.col("created_at") < before(as_of, days=candidate_days))
    expired = candidates.filter((F.col("status").isin(TERMINAL) & late) | old)
    if semantic_due:
        expired = expired.unionByName(semantic_pending(candidates, ranking))
    return expired.join(finals.select("identity_hash").distinct(), "identity_hash", "left_anti")


def log_expired(rows: DataFrame, as_of: Column, days: float, at: str = "created_at", closed: list[str] | None = None) -> DataFrame:
    """FLT-11 for logs and the validation cache."""
    old = F.col(at) < before(as_of, days=days)
    return rows.filter(old & F.col("status").isin(closed)) if closed else rows.filter(old)


def released_keys(expired: DataFrame) -> DataFrame:
    """Temporary identity keys that an expiry gives back."""
    return expired.select(F.concat(F.lit("candidate:"), "identity_hash").alias("key")).distinct()
