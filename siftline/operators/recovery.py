"""JN-14, AGG-10..12, AGG-24, SET-4, SET-5: the recovery plan from delivered files and a snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftline.functions.values import FIELDS, TAB, delivered_keys
from siftline.operators.delivery import envelope_reasons, qualified, row_reason
from siftline.operators.placement import next_positions
from siftline.sources.deliveries import exploded_items

BLOCK = 4096  # rows of a tab that are looked at together
# The names under which problems of the coverage refuse a recovery.
PROBLEMS = {"missing": "incomplete_coverage", "outside": "placement_outside_sheet", "conflicting": "conflicting_placement"}


def field(name: str) -> Column:
    return F.get("values", FIELDS.index(name))


def delivered_runs(placements: DataFrame) -> DataFrame:
    """Delivered rows as runs: ``(tab, first, last, conflicts)``, the rows of a run that hold more than one value in ``conflicts``.

    Equal placements are merged before the shuffle.  Runs are cut at multiples of ``BLOCK`` rows, so neither a run nor the
    group it is made in grows with the tab.
    """
    digest = F.sha2(F.to_json("values"), 256)
    seen = placements.groupBy("tab", "row").agg((F.min(digest) != F.max(digest)).alias("_two"))
    block = F.floor(F.col("row") / BLOCK)
    island = F.col("row") - F.row_number().over(Window.partitionBy("tab", "_block").orderBy("row"))
    return (seen.withColumn("_block", block).withColumn("_island", island).groupBy("tab", "_block", "_island")
            .agg(F.min("row").alias("first"), F.max("row").alias("last"), F.collect_list(F.when(F.col("_two"), F.col("row"))).alias("conflicts"))
            .drop("_block", "_island"))


def coverage_ranges(placements: DataFrame, tab_rows: DataFrame) -> DataFrame:
    """JN-14: rows 2..n+1 of every snapshot tab against the delivered placements, as ranges ``(tab, problem, first, last)``.

    ``missing``: rows no run covers; ``outside``: delivered rows the snapshot does not have, whole runs of unknown tabs included;
    ``conflicting``: a row inside that was delivered with different values.  Delivered runs are subtracted from the range of
    their tab, so no expected row is made.
    """
    both = delivered_runs(placements).join(tab_rows.select("tab", "rows"), "tab", "full_outer")
    in_tab = Window.partitionBy("tab").orderBy("first")
    end = F.col("rows") + 1
    both = both.withColumns({"_before": F.coalesce(F.lag("last").over(in_tab), F.lit(1)), "_final": F.lead("first").over(in_tab).isNull()})
    span = lambda problem, first, last: F.struct(F.lit(problem).alias("problem"), first.cast("long").alias("first"), last.cast("long").alias("last"))
    low, high = F.lit(2), F.col("rows") + 2
    known = F.array(
        span("missing", F.greatest(F.col("_before") + 1, low), F.when(F.col("first").isNotNull(), F.least(F.col("first") - 1, end))),
        span("missing", F.when(F.col("_final"), F.greatest(F.coalesce("last", F.lit(1)) + 1, low)), end),
        span("outside", F.col("first"), F.least("last", low - 1)),
        span("outside", F.greatest("first", high), F.col("last")))
    inside = F.filter(F.coalesce("conflicts", F.array()), lambda r: r.between(low, end))
    found = F.when(F.col("rows").isNull(), F.array(span("outside", F.col("first"), F.col("last")))).otherwise(
        F.concat(known, F.transform(inside, lambda r: span("conflicting", r, r))))
    return (both.select("tab", "first", "last", F.inline(F.filter(found, lambda x: x["first"] <= x["last"])).alias("problem", "from", "to"))
            .select("tab", "problem", F.col("from").alias("first"), F.col("to").alias("last")))


def coverage(placements: DataFrame, tab_rows: DataFrame) -> DataFrame:
    """JN-14 by row: one row per problem; only the ranges with a problem are spread out."""
    rows = F.transform(F.sequence("first", "last"), lambda r: r.cast("int"))
    return coverage_ranges(placements, tab_rows).select("tab", F.explode(rows).alias("row"), "problem")


def missing_per_tab(problems: DataFrame) -> DataFrame:
    """SET-4 as counts, from the ranges of :func:`coverage_ranges`."""
    return (problems.filter("problem = 'missing'").groupBy("tab")
            .agg(F.sum(F.col("last") - F.col("first") + 1).alias("missing")))


def receipts(items: DataFrame) -> DataFrame:
    """AGG-10: compact receipt of every delivered batch."""
    lettered = F.regexp_extract("tab", TAB, 1) != ""
    return items.groupBy("batch_id", "campaign_id").agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(qualified(field("email"), field("validation_status"))).alias("qualified_count"),
        F.when(F.bool_or(lettered), "alphabetical").otherwise("sequential").alias("layout"),
        F.min(field("created_at")).alias("created_at"), F.max(field("created_at")).alias("acknowledged_at"))


def totals(items: DataFrame) -> DataFrame:
    """AGG-12: highest id, distinct placements and qualified rows per campaign."""
    return items.groupBy("campaign_id").agg(
        F.max("lead_id").alias("max_lead_id"), F.count_distinct("tab", "row").alias("rows"),
        F.count_if(qualified(field("email"), field("validation_status"))).alias("qualified"))


def rebuilt_keys(items: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """SET-5: distinct keys of the delivered rows that the key table does not hold yet."""
    keys = items.select(F.explode(delivered_keys(field("source"), field("source_url"), field("email"), field("validation_status"))).alias("key")).distinct()
    return keys if claimed is None else keys.join(claimed.select("key"), "key", "left_anti")


def snapshot_of(placed: DataFrame, destination: str, captured_at: Column) -> DataFrame:
    """AGG-24: rows per tab with the capture time and the hash of the destination id."""
    return placed.groupBy("tab").agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"spreadsheet_sha256": F.sha2(F.lit(destination), 256), "captured_at": captured_at})


def refusals(envelopes: DataFrame, snapshot: DataFrame, destination: tuple[str, str, int]) -> DataFrame:
    """Every reason not to restore: ``(reason, place, cases)``; no row means that the plan may be used.

    ``envelopes`` are read envelopes, ``snapshot`` is ``(tab, rows, problem)`` and ``destination`` the configured spreadsheet,
    folder and rows of a shard.  Named are files that were changed (their checksum), malformed items, several destinations or
    another one than configured, snapshots that cannot be used, placements in conflict or outside and rows nobody delivered.
    """
    checked = envelope_reasons(envelopes)
    spreadsheet, folder, shard_rows = destination
    target = F.struct("spreadsheet_id", "drive_folder_id", "shard_rows")
    other = ~(F.col("spreadsheet_id").eqNullSafe(F.lit(spreadsheet)) & F.col("drive_folder_id").eqNullSafe(F.lit(folder)))
    whole = envelopes.agg(F.count(F.lit(1)).alias("n"), F.min(target).alias("lo"), F.max(target).alias("hi"), F.count_if(other).alias("other"),
                          F.count_if(~F.col("shard_rows").eqNullSafe(F.lit(shard_rows))).alias("sizes"))
    case = lambda test, reason, n: F.when(test, F.struct(F.lit(reason).alias("reason"), F.lit("").alias("place"), n.cast("long").alias("cases")))
    whole = whole.select(F.inline(F.array_compact(F.array(
        case(F.col("n") == 0, "no_delivery_inputs", F.lit(0)), case(~F.col("lo").eqNullSafe(F.col("hi")), "mixed_destinations", F.col("n")),
        case(F.col("other") > 0, "destination_differs_from_configuration", F.col("other")),
        case(F.col("sizes") > 0, "shard_rows_differs_from_configuration", F.col("sizes"))))))
    rows = exploded_items(checked.filter("reason IS NULL"))
    bad = rows.withColumn("reason", row_reason(F.col("campaign_id"), F.col("shard_rows"))).filter("reason IS NOT NULL")
    named = checked.filter("reason IS NOT NULL").select("reason", F.col("batch_id").alias("place")).unionByName(
        bad.select("reason", F.col("batch_id").alias("place")))
    stale = snapshot.filter("problem IS NOT NULL").select(F.col("problem").alias("reason"), F.lit("").alias("place"))
    tabs = snapshot.filter("problem IS NULL AND tab IS NOT NULL").select("tab", "rows")
    gaps = coverage_ranges(exploded_items(envelopes), tabs).select(
        F.element_at(F.create_map(*[F.lit(x) for pair in PROBLEMS.items() for x in pair]), F.col("problem")).alias("reason"),
        F.col("tab").alias("place"), (F.col("last") - F.col("first") + 1).alias("n"))
    counted = named.unionByName(stale).withColumn("n", F.lit(1).cast("long")).unionByName(gaps)
    return counted.groupBy("reason", F.coalesce("place", F.lit("")).alias("place")).agg(F.sum("n").alias("cases")).unionByName(whole)


def recovery_plan(envelopes: DataFrame, snapshot: DataFrame, destination: tuple[str, str, int], claimed: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables to restore; raises when :func:`refusals` names a reason."""
    found = refusals(envelopes, snapshot, destination).orderBy("reason", "place").limit(20).collect()  # the first reasons, for the message
    if found:
        raise ValueError("recovery refused: " + ", ".join(f"{r.reason} {r.place} ({r.cases})" for r in found))
    items, tabs = exploded_items(envelopes), snapshot.select("tab", "rows")
    return {"receipts": receipts(items), "totals": totals(items), "next_positions": next_positions(tabs, destination[2]),
            "keys": rebuilt_keys(items, claimed)}
