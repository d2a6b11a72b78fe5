"""TXT-37, SNK-4, JN-12, JN-13, FLT-8, FLT-12, FLT-13, SNK-10: delivery items, checks and receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import text_or_empty
from siftline.functions.values import FIELDS, MAX_EXACT_INTEGER, TAB, delivered_values
from siftline.operators.keys import first_by, positions

# Statuses that never count as qualified, batch size bound, value length bound, product names.
NOT_QUALIFIED = ("NO_EMAIL", "SYNTHETIC_TEST")
MAX_ITEMS, MAX_VALUE, MAX_SHARD_ROWS = 200, 2048, 5000
DELIVERED_PRODUCTS = ["MOTOR", "HOME", "CONTENTS", "LIFE", "FUNERAL", "DISABILITY", "OTHER", "UNKNOWN", "BUSINESS_CONTACT"]
_CONTROL = "[\\x00-\\x1f\\x7f]"


def qualified(email: Column, validation_status: Column) -> Column:
    """FLT-8."""
    return (text_or_empty(email) != "") & ~text_or_empty(validation_status).isin(*NOT_QUALIFIED)


def items(placed: DataFrame, campaign_id: str) -> DataFrame:
    """Delivery items of placed finals: ``(lead_id, tab, row, values, qualified, created_at)``."""
    values = F.transform(delivered_values(campaign_id), lambda v: F.regexp_replace(v, _CONTROL, " "))
    return placed.select(F.col("id").alias("lead_id"), "tab", "row", values.alias("values"),
                         qualified(F.col("email"), F.col("validation_status")).alias("qualified"), "created_at")


def batched(rows: DataFrame, order: str = "lead_id", size: int = MAX_ITEMS) -> DataFrame:
    """Adds ``batch_no``: consecutive ids, at most ``size`` items in a batch."""
    return positions(rows, order).withColumn("batch_no", F.floor(F.col("position") / size)).drop("position")


def canonical_items(array: Column) -> Column:
    """Compact JSON of the items in id order; byte-equal to the agreed serialisation."""
    return F.to_json(array)


def envelopes(batched_items: DataFrame, campaign_id: str, spreadsheet_id: str, folder_id: str, shard_rows: int) -> DataFrame:
    """SNK-4: one immutable envelope per batch with the checksum of its items.  A batch is at most 200 items."""
    item = F.struct("lead_id", "tab", "row", "values")
    per = batched_items.groupBy("batch_no").agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.count(F.lit(1)).alias("count"),
        F.count_if("qualified").alias("qualified_count"))
    checksum = F.sha2(canonical_items(F.col("items")), 256)
    batch_id = F.regexp_replace(F.left(checksum, F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return per.select("batch_no", batch_id.alias("batch_id"), F.lit(campaign_id).alias("campaign_id"), checksum.alias("checksum"),
                      F.lit(spreadsheet_id).alias("spreadsheet_id"), F.lit(folder_id).alias("drive_folder_id"),
                      F.lit(shard_rows).alias("shard_rows"),
                      F.array(*[F.lit(f) for f in FIELDS]).alias("fields"), "items", "count", "qualified_count")


def envelope_reasons(env: DataFrame) -> DataFrame:
    """FLT-12, envelope part: first failing reason per envelope, null when it is accepted."""
    wanted = F.array(*[F.lit(f) for f in FIELDS])
    reason = (F.when(~F.coalesce(F.col("batch_id").rlike("^[0-9a-fA-F]{8}-?([0-9a-fA-F]{4}-?){3}[0-9a-fA-F]{12}$"), F.lit(False)), "batch_id")
              .when(~F.coalesce(F.col("campaign_id").rlike("^[A-Za-z0-9_-]{1,64}$"), F.lit(False)), "campaign_id")
              .when(~F.coalesce(F.col("fields") == wanted, F.lit(False)), "fields")
              .when(~F.coalesce(F.col("shard_rows").between(1, MAX_SHARD_ROWS), F.lit(False)), "shard_rows")
              .when(~F.coalesce(F.size("items").between(1, MAX_ITEMS), F.lit(False)), "items")
              .when(~F.coalesce(F.sha2(canonical_items(F.col("items")), 256) == F.col("checksum"), F.lit(False)), "checksum"))
    return env.withColumn("reason", reason)


def row_reason(campaign_id: Column, shard_rows: Column) -> Column:
    """FLT-12, item part: first failing reason of ``(lead_id, tab, row, values)``."""
    at = lambda name: F.get("values", FIELDS.index(name))
    bad_values = (F.size("values") != len(FIELDS)) | F.exists("values", lambda v: v.isNull() | (F.length(v) > MAX_VALUE))
    no = lambda test: ~F.coalesce(test, F.lit(False))
    return (F.when(no(F.col("lead_id").between(1, MAX_EXACT_INTEGER)), "lead_id")
            .when(no(F.col("tab").rlike(TAB)), "tab")
            .when(no(F.col("row").between(2, shard_rows + 1)), "row")
            .when(F.coalesce(bad_values, F.lit(True)), "values")
            .when((at("lead_id") != F.concat(campaign_id, F.lit(":"), F.col("lead_id").cast("string"))) | (at("campaign_id") != campaign_id),
                  "identifier_mismatch")
            .when((at("email") == "") & ~F.col("tab").startswith("PROSPECTS_") & (at("validation_status") == "NO_EMAIL"),
                  "prospect_in_email_dataset"))


def row_checks(delivered: DataFrame) -> DataFrame:
    """FLT-13: six boolean checks of delivered rows held as columns."""
    return delivered.withColumns({
        "ok_lead_id": text_or_empty(F.col("lead_id")).rlike(r"^[A-Za-z0-9_-]+:\d+$"),
        "ok_source_url": text_or_empty(F.col("source_url")).startswith("https://"),
        "ok_evidence": F.length(text_or_empty(F.col("source_evidence"))) > 0,
        "ok_product": F.coalesce(F.col("product_type").isin(DELIVERED_PRODUCTS), F.lit(False)),
        "ok_salutation": text_or_empty(F.col("salutation")).rlike(r"^Good day( [^,]+)?,$"),
        "ok_email": (text_or_empty(F.col("email")) != "") | (text_or_empty(F.col("validation_status")) == "NO_EMAIL"),
    })


_PLACEMENT = ["batch_id", "lead_id", "tab", "row"]


def batch_sums(rows: DataFrame) -> DataFrame:
    """Order-free digest of the placements of a batch: ``(batch_id, n, upper, lower)``.

    The halves of a 128-bit hash of every placement are added up, so a batch is one small row before the shuffle, and
    equal multisets have equal sums in any order.  Nulls count as values of their own.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in _PLACEMENT[1:]])
    half = lambda at: F.sum(F.conv(F.substring("_h", at, 16), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")
    return rows.select("batch_id", F.md5(text).alias("_h")).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), half(1).alias("upper"), half(17).alias("lower"))


def differing_batches(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """Batches whose multisets of placements differ: ``(batch_id)``."""
    both = (batch_sums(expected).withColumn("_side", F.lit(1)).unionByName(batch_sums(delivered).withColumn("_side", F.lit(-1)))
            .groupBy("batch_id").agg(*[F.sum(F.col(c) * F.col("_side")).alias(c) for c in ("n", "upper", "lower")]))
    return both.filter("n <> 0 OR upper <> 0 OR lower <> 0").select("batch_id")


def placement_mismatches(expected: DataFrame, delivered: DataFrame) -> DataFrame:
    """SET-3: placements of a batch that differ as multisets, with the side they are missing on.

    Rows are compared only in batches whose sums differ.
    """
    off = differing_batches(expected, delivered)
    left, right = (df.select(*_PLACEMENT).join(off, off["batch_id"].eqNullSafe(df["batch_id"]), "left_semi") for df in (expected, delivered))
    weighed = (left.withColumn("w", F.lit(1)).unionByName(right.withColumn("w", F.lit(-1)))
               .groupBy(*_PLACEMENT).agg(F.sum("w").alias("w")).filter("w <> 0"))
    side = F.when(F.col("w") > 0, "delivered").otherwise("expected")
    return weighed.select(*_PLACEMENT, F.explode(F.array_repeat(side, F.abs("w").cast("int"))).alias("missing_in"))


def acknowledge(batches: DataFrame, expected: DataFrame, receipts: DataFrame, delivered: DataFrame, finals: DataFrame) -> DataFrame:
    """JN-12: verdict per acknowledged batch; the first difference names it.

    ``batches``: batch_id, checksum, spreadsheet_id, drive_folder_id, count, status, ack_digest;
    ``receipts``: batch_id, checksum, drive_checksum, spreadsheet_id, drive_folder_id, digest.
    """
    off = differing_batches(expected, delivered).withColumn("_off", F.lit(True))
    present = (expected.join(finals.select(F.col("id").alias("lead_id")), "lead_id", "left_semi")
               .groupBy("batch_id").agg(F.count(F.lit(1)).alias("_present")))
    r = receipts.select("batch_id", F.col("checksum").alias("r_checksum"), "drive_checksum",
                        F.col("spreadsheet_id").alias("r_sheet"), F.col("drive_folder_id").alias("r_folder"), "digest")
    staged = r.join(batches, "batch_id", "left").join(off, "batch_id", "left").join(present, "batch_id", "left")
    same = ((F.col("checksum") == F.col("r_checksum")) & (F.col("checksum") == F.col("drive_checksum"))
            & (F.col("spreadsheet_id") == F.col("r_sheet")) & (F.col("drive_folder_id") == F.col("r_folder")))
    done = F.col("status") == "ACKNOWLEDGED"
    verdict = (F.when(F.col("status").isNull(), "export_batch_not_found")
               .when(done & (F.col("ack_digest") != F.col("digest")), "acknowledgement_conflict")
               .when(done, "replayed")
               .when(~F.coalesce(same, F.lit(False)), "export_receipt_mismatch")
               .when(F.coalesce("_off", F.lit(False)), "export_placement_mismatch")
               .when(F.coalesce("_present", F.lit(0)) != F.col("count"), "export_pending_data_missing")
               .otherwise("acknowledged"))
    return staged.select("batch_id", verdict.alias("verdict"))


def cascade(acknowledged: DataFrame, finals: DataFrame, candidates: DataFrame, records: DataFrame, claimed: DataFrame) -> dict[str, DataFrame]:
    """JN-13: the four tables after the acknowledged lead ids are gone; permanent keys stay."""
    gone = finals.join(acknowledged.select(F.col("lead_id").alias("id")).distinct(), "id", "left_semi")
    by_id = candidates.join(gone.filter("candidate_id IS NOT NULL").select("candidate_id").distinct(), "candidate_id", "left_semi")
    fallback = gone.join(candidates.select("candidate_id"), "candidate_id", "left_anti").select("identity_hash").distinct()
    legacy = candidates.filter(F.col("status") == "VALIDATED").join(fallback, "identity_hash", "left_semi")
    legacy = first_by(legacy, ["identity_hash"], ["candidate_id"], ["candidate_id"])
    closed = by_id.select("candidate_id", "identity_hash", "record_id").unionByName(
        candidates.join(legacy.select("candidate_id"), "candidate_id", "left_semi").select("candidate_id", "identity_hash", "record_id")).distinct()
    temporary = closed.select(F.concat(F.lit("candidate:"), "identity_hash").alias("key")).distinct()
    return {
        "finals": finals.join(acknowledged.select(F.col("lead_id").alias("id")).distinct(), "id", "left_anti"),
        "candidates": candidates.join(closed.select("candidate_id"), "candidate_id", "left_anti"),
        "records": records.join(closed.select("record_id").filter("record_id IS NOT NULL").distinct(), "record_id", "left_anti"),
        "claimed": claimed.join(temporary, "key", "left_anti"),
    }


def latest_receipts(history: DataFrame, updates: DataFrame) -> DataFrame:
    """SNK-10: one receipt per batch, the newest state wins, CLAIMED never replaces ACKNOWLEDGED."""
    both = history.unionByName(updates).withColumn("_done", (F.col("status") == "ACKNOWLEDGED").cast("int"))
    newest = F.max_by(F.struct(*history.columns), F.struct("_done", "at"))
    return both.groupBy("batch_id").agg(newest.alias("r")).select("r.*")
