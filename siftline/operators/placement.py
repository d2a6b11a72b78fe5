"""WIN-3..WIN-5, TXT-28/29, AGG-9, AGG-11, AGG-25, SNK-7: where delivered rows go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftline.functions.values import FIELDS, bucket_for, tab_bucket, tab_name, tab_row, tab_shard
from siftline.operators.keys import positions

# Cells of a destination and the share of them that may be used.
CELL_LIMIT, USABLE_SHARE = 10_000_000, 0.9


def place(finals: DataFrame, layout: str, shard_rows: int, starts: DataFrame | None = None,
          order: str = "id") -> DataFrame:
    """WIN-3/WIN-4: tab and row of every final in id order, after the durable start of its bucket.

    ``starts`` is ``(bucket, start)`` with bucket ``SEQUENTIAL`` for the sequential layout; there is at most
    one row per letter.
    """
    group = F.coalesce(bucket_for(layout, F.col("email")), F.lit("SEQUENTIAL"))
    numbered = positions(finals.withColumn("bucket", group), order, "bucket")
    if starts is not None:
        numbered = numbered.join(F.broadcast(starts), "bucket", "left")
        numbered = numbered.withColumn("position", F.col("position") + F.coalesce("start", F.lit(0))).drop("start")
    named = F.when(F.col("bucket") != "SEQUENTIAL", F.col("bucket"))
    return (numbered.withColumn("tab", tab_name(named, F.col("position"), shard_rows))
            .withColumn("row", tab_row(F.col("position"), shard_rows)))


def next_starts(placed: DataFrame) -> DataFrame:
    """Durable next position per bucket after a placement."""
    return placed.groupBy("bucket").agg((F.max("position") + 1).alias("start"))


def capacity_plan(rows_per_group: DataFrame, shard_rows: int, fields: int = len(FIELDS), existing_cells: int = 0,
                  limit: int = CELL_LIMIT) -> DataFrame:
    """AGG-9: tabs and cells of ``(bucket, rows)`` when every tab is sized exactly."""
    tabs = F.ceil(F.col("rows") / F.lit(shard_rows))
    total = rows_per_group.agg(
        F.coalesce(F.sum(tabs), F.lit(0)).alias("tabs"),
        F.coalesce(F.sum((F.col("rows") + tabs) * fields), F.lit(0)).alias("delivery_cells"))
    cells = F.col("delivery_cells") + existing_cells
    return total.select("tabs", "delivery_cells", F.lit(existing_cells).cast("long").alias("existing_cells"),
                        cells.alias("total_cells"), F.lit(limit).cast("long").alias("cell_limit"),
                        (cells <= limit).alias("within_limit"),
                        F.greatest(F.lit(0), F.lit(limit) - cells).alias("headroom_cells"))


def runs(placed: DataFrame) -> DataFrame:
    """WIN-5: contiguous runs of rows per tab.  A tab holds at most one shard of rows, so the window is bounded."""
    island = F.col("row") - F.row_number().over(Window.partitionBy("tab").orderBy("row"))
    return (placed.withColumn("_i", island).groupBy("tab", "_i")
            .agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("items")).drop("_i"))


def next_positions(tab_rows: DataFrame, shard_rows: int) -> DataFrame:
    """AGG-11: next free position per bucket from ``(tab, rows)``."""
    end = (tab_shard(F.col("tab")) - 1) * shard_rows + F.col("rows")
    return (tab_rows.filter(tab_bucket(F.col("tab")).isNotNull())
            .groupBy(tab_bucket(F.col("tab")).alias("bucket")).agg(F.max(end).alias("next_position")))


def planned_growth(current: DataFrame, needed: DataFrame, columns: int = len(FIELDS), limit: int = CELL_LIMIT) -> DataFrame:
    """AGG-25: cells a write adds, from current ``(tab, rows, cols)`` and needed runs ``(tab, row, items)``."""
    want = needed.groupBy("tab").agg(F.max(F.col("row") + F.col("items") - 1).alias("want_rows"))
    both = current.join(want, "tab", "full_outer")
    rows, cols = F.coalesce("rows", F.lit(0)), F.coalesce("cols", F.lit(0))
    touched = F.col("want_rows").isNotNull()
    after = F.greatest(rows, F.coalesce("want_rows", F.lit(0))) * F.greatest(cols, F.lit(columns))
    total = both.agg(F.coalesce(F.sum(rows * cols), F.lit(0)).alias("allocated_cells"),
                     F.coalesce(F.sum(F.when(touched, after - rows * cols)), F.lit(0)).alias("growth_cells"))
    usable = int(limit * USABLE_SHARE)
    return total.select("allocated_cells", "growth_cells", F.lit(usable).cast("long").alias("usable_cells"),
                        (F.col("allocated_cells") + F.col("growth_cells") <= usable).alias("fits"))


def shard_index(placed: DataFrame, shard_rows: int, columns: int = len(FIELDS), limit: int = CELL_LIMIT) -> DataFrame:
    """SNK-7: rows, capacity and rest per tab, with one total row."""
    per = placed.groupBy("tab").agg(F.max(F.col("row") - 1).cast("long").alias("data_rows"))
    per = per.select("tab", tab_bucket(F.col("tab")).alias("bucket"), "data_rows", F.lit(shard_rows).cast("long").alias("capacity"),
                     F.greatest(F.lit(0), F.lit(shard_rows) - F.col("data_rows")).cast("long").alias("remaining"),
                     ((F.col("data_rows") + 1) * columns).alias("allocated_cells"))
    total = per.agg(F.sum("data_rows").alias("data_rows"), F.sum("allocated_cells").alias("allocated_cells"))
    total = total.select(F.lit("WORKBOOK_TOTAL").alias("tab"), F.lit("").alias("bucket"), "data_rows",
                         F.lit(int(limit * USABLE_SHARE)).cast("long").alias("capacity"),
                         F.lit(None).cast("long").alias("remaining"), "allocated_cells")
    return per.unionByName(total)


def natural_order(tab: Column) -> list[Column]:
    """SRT-6: e-mail tabs by letter and shard number, sequential ones first, prospects last."""
    named = tab_bucket(tab)
    return [F.when(named == "PROSPECTS", 1).otherwise(0), F.when(named.isin("SEQUENTIAL", "PROSPECTS"), "").otherwise(named),
            tab_shard(tab)]
