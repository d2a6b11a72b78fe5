"""SRC-9, SRC-10: delivered envelope files and destination snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftline.functions.values import TAB
from siftline.schemas import ENVELOPE, SNAPSHOT


def read_envelopes(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-9: one envelope per file."""
    return spark.read.schema(ENVELOPE).json(glob, multiLine=True)


def exploded_items(envelopes: DataFrame) -> DataFrame:
    """SRC-9: one row per delivered item with its batch columns."""
    return envelopes.select("batch_id", "campaign_id", "checksum", "shard_rows", F.explode("items").alias("i")).select(
        "batch_id", "campaign_id", "checksum", "shard_rows", "i.*")


def snapshot_tabs(snapshots: DataFrame, destination: str, as_of: Column, body: str = "body") -> DataFrame:
    """SRC-10: ``(tab, rows, problem)`` of a snapshot.

    ``problem`` names a wrong destination, an unreadable time or an age outside -5..30 minutes.
    """
    parsed = snapshots.select(F.from_json(body, SNAPSHOT).alias("s")).select("s.*")
    zoned = F.when(F.col("captured_at").rlike(r"(?:Z|[+-]\d{2}:\d{2})$"), F.try_to_timestamp("captured_at"))
    age = (F.unix_micros(as_of) - F.unix_micros(zoned)) / 60e6
    problem = (F.when(F.col("tabs").isNull(), "no_destination_snapshot")
               .when(~F.coalesce(F.col("spreadsheet_sha256") == F.sha2(F.lit(destination), 256), F.lit(False)), "snapshot_destination_mismatch")
               .when(F.try_to_timestamp("captured_at").isNull(), "snapshot_time_invalid")
               .when(~F.coalesce(age.between(-5, 30), F.lit(False)), "snapshot_not_current"))
    rows = parsed.withColumn("problem", problem).select(F.explode_outer("tabs").alias("tab", "rows"), "problem")
    return rows.filter(F.col("problem").isNotNull() | (F.col("tab").rlike(TAB) & (F.col("rows") > 0)))
