"""SNK-1..SNK-10: partitioned tabs, CSV dialects, backups, report tables, pages and receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftline.functions.text import formula_safe, quoted_cell, text_or_empty
from siftline.functions.values import FIELDS, TAB
from siftline.operators.samples import listing

PART_ROWS = 1000


def write_tabs(items: DataFrame, path: str) -> None:
    """SNK-1: one partition per tab.  Rows of a tab meet in one task; a tab is at most one shard."""
    items.repartition("tab").sortWithinPartitions("tab", "row").write.mode("errorifexists").partitionBy("tab").parquet(path)


def safe_columns(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.select(*[formula_safe(F.col(f)).alias(f) for f in fields])


def write_csv(rows: DataFrame, fields: list[str], path: str) -> None:
    """SNK-2: header, CRLF and the formula guard on every cell."""
    safe_columns(rows, fields).write.mode("errorifexists").option("header", True).option("lineSep", "\r\n").option(
        "escape", '"').option("emptyValue", "").csv(path)


def quoted_line(cells: Column) -> Column:
    """SNK-3: one line of the all-quoted dialect from an array of cells."""
    return F.array_join(F.transform(cells, quoted_cell), ",")


def write_quoted(rows: DataFrame, cells: Column, path: str) -> None:
    rows.select(quoted_line(cells).alias("value")).write.mode("errorifexists").option("lineSep", "\r\n").text(path)


def backup_parts(items: DataFrame) -> DataFrame:
    """Items with their backup part: at most 1000 rows of a tab."""
    return items.withColumn("part", F.floor((F.col("row") - 2) / PART_ROWS).cast("int"))


def backup_manifest(items: DataFrame) -> DataFrame:
    """SNK-5: per part the row range, count, SHA-256 of its lines and whether it has a gap.

    A part is at most 1000 rows, which bounds the collected list.
    """
    line = F.struct("row", quoted_line(F.col("values")).alias("line"))
    parts = backup_parts(items).groupBy("tab", "part").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.count(F.lit(1)).alias("count"),
        F.bool_or(text_or_empty(F.get("values", F.lit(0))) == "").alias("gap"), F.array_sort(F.collect_list(line)).alias("_l"))
    header = ",".join(f'"{f}"' for f in FIELDS)
    body = F.concat(F.lit(header + "\r\n"), F.array_join(F.transform("_l", lambda x: x["line"]), "\r\n"), F.lit("\r\n"))
    return parts.withColumn("sha256", F.sha2(body, 256)).drop("_l")


def write_backup(items: DataFrame, path: str) -> DataFrame:
    """SNK-5: writes the parts and returns the manifest; refuses a table with gaps."""
    manifest = backup_manifest(items)
    if not manifest.filter("gap").isEmpty():
        raise ValueError("a delivered row has an empty first column")
    lines = backup_parts(items).select("tab", "part", "row", quoted_line(F.col("values")).alias("value"))
    (lines.repartition("tab", "part").sortWithinPartitions("tab", "part", "row").drop("row")
     .write.mode("errorifexists").option("lineSep", "\r\n").partitionBy("tab", "part").text(path))
    return manifest


def replace_report(tables: list[DataFrame], name: str, path: str) -> None:
    """SNK-6: replaces a report table by rows with the union of their columns; delivered tabs are refused."""
    import re

    if re.match(TAB, name) or name == "EXPORT_INDEX":
        raise ValueError("delivered tables are append-only")
    report_rows(tables).write.mode("overwrite").parquet(f"{path}/{name}")


def report_rows(tables: list[DataFrame]) -> DataFrame:
    rows = tables[0]
    for other in tables[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    return rows


def sample_export(samples: DataFrame, source: str | None = None, limit: int | None = None) -> DataFrame:
    """SNK-8: samples with nested columns as JSON text, of one source or all; with ``limit`` the first in listing order."""
    rows = samples.filter(F.col("source") == source) if source else samples
    rows = rows if limit is None else listing(rows, limit=limit)
    return rows.withColumn("profile", F.to_json("profile")).withColumn("detail", F.to_json("detail"))


def page_after(rows: DataFrame, after: int, through: int | None, limit: int, key: str = "id") -> tuple[DataFrame, int, int | None]:
    """SNK-9: one page of rows by key, the pinned upper bound, and where the next page starts.

    The key bounds reach the scan; only the page and one more row are sorted out of it.
    """
    if through is None:
        through = rows.agg(F.max(key)).first()[0] or 0
    window = rows.filter((F.col(key) > after) & (F.col(key) <= through))
    page = window.orderBy(key).limit(limit + 1)
    ends = page.select(key).orderBy(key).collect()  # at most limit + 1 keys
    more = len(ends) > limit
    return page.orderBy(key).limit(limit), through, (ends[limit - 1][0] if more else None)
