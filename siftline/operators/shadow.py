"""JN-17, JN-18, TXT-36: checking match results that were computed elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import text_or_empty


def batch_keys(rows: DataFrame, batch: str, row: str) -> DataFrame:
    """TXT-36 per batch.  A request batch is small by contract; its ids are sorted before hashing."""
    ids = F.array_join(F.array_sort(F.collect_list(F.col(row).cast("string"))), "\n")
    return rows.groupBy(batch).agg(F.left(F.sha2(ids, 256), F.lit(32)).alias("batch_key"))


def contract_problems(request: DataFrame, result: DataFrame, groups: list[str], batch: str = "batch", row: str = "id") -> DataFrame:
    """JN-18: problem counts per batch: unexpected, repeated and missing ids, unknown or repeated groups."""
    known = F.array(*[F.lit(g) for g in groups])
    answers = result.groupBy(batch, row).agg(
        F.count(F.lit(1)).alias("_times"),
        F.bool_or((F.size(F.array_except("matched", known)) > 0) | (F.size(F.array_distinct("matched")) != F.size("matched"))).alias("_bad"))
    both = request.select(batch, row, F.lit(True).alias("_asked")).join(answers, [batch, row], "full_outer")
    return both.groupBy(batch).agg(
        F.count_if(F.col("_asked").isNull()).alias("unexpected"), F.count_if(F.col("_times") > 1).alias("repeated"),
        F.count_if(F.col("_times").isNull()).alias("missing"), F.count_if("_bad").alias("unknown_group"))


def verified(local: DataFrame, remote: DataFrame, rate: float, batch: str = "batch", row: str = "id", seed: int = 42) -> DataFrame:
    """JN-17: verdict per batch; one difference in the verified share rejects the whole batch.

    The share is chosen by a hash of the id, so a repeated run verifies the same rows.
    """
    picked = F.pmod(F.xxhash64(F.col(row), F.lit(seed)), F.lit(1_000_000)) < int(rate * 1_000_000)
    a = local.filter(picked).select(batch, row, F.array_sort("matched").alias("_l"))
    b = remote.filter(picked).select(batch, row, F.array_sort("matched").alias("_r"))
    both = a.join(b, [batch, row], "full_outer")
    differs = ~F.coalesce(F.col("_l") == F.col("_r"), F.lit(False))
    checked = both.groupBy(batch).agg(F.count(F.lit(1)).alias("checked"), F.count_if(differs).alias("mismatches"))
    batches = remote.groupBy(batch).agg(F.count(F.lit(1)).alias("items"))
    joined = batches.join(checked, batch, "left").na.fill(0, ["checked", "mismatches"])
    return joined.withColumn("accepted", F.col("mismatches") == 0)


def verified_matches(local: DataFrame, remote: DataFrame, rate: float, **names) -> DataFrame:
    """Remote results of accepted batches."""
    batch = names.get("batch", "batch")
    return remote.join(verified(local, remote, rate, **names).filter("accepted").select(batch), batch, "left_semi")


def fingerprint(values: Column) -> Column:
    """Fingerprint of a list kept in configuration (order-free)."""
    return F.left(F.sha2(F.array_join(F.array_sort(F.transform(values, text_or_empty)), "\n"), 256), F.lit(32))
