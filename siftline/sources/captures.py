"""SRC-5, SRC-6: the capture index of a crawl."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftline.schemas import CAPTURE
from siftline.session import durable

ROWS_PER_FILE = 1_000_000
COLUMNS = ("url", "status", "mime", "mime-detected", "filename", "offset", "length")


def parse_captures(lines: DataFrame, value: str = "value") -> DataFrame:
    """SRC-5: ``surt timestamp {json}`` lines; successful HTML captures only."""
    parts = F.split(F.col(value), " ", 3)
    rows = lines.withColumn("surt", F.get(parts, 0)).withColumn("stamp", F.get(parts, 1))
    rows = rows.withColumn("_j", F.from_json(F.get(parts, 2), CAPTURE))
    mime = F.coalesce(F.nullif(F.col("_j")["mime-detected"], F.lit("")), F.col("_j")["mime"], F.lit(""))
    rows = rows.filter((F.col("_j")["status"] == "200") & F.contains(mime, F.lit("html")))
    fields = [F.col("_j")[name].alias(name.replace("-", "_")) for name in COLUMNS]
    return rows.select(*[c for c in lines.columns if c != value], "surt", "stamp", *fields)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    return parse_captures(spark.read.text(path))


def write_index(captures: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The index sorted by key in as many files as it needs, and a directory of the first and last key of every file.

    ``path/captures`` holds the rows, cut at keys sampled from the data (captures of one key may lie in several files);
    ``path/directory`` is one row a file.
    """
    rows = durable(captures, "captures")
    order = ["surt", *[c for c in ("stamp", "filename", "offset") if c in rows.columns]]
    files = max(1, -(-rows.count() // rows_per_file))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(f"{path}/captures")
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/captures")
    per = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("surt").alias("first"), F.max("surt").alias("last"), F.count(F.lit(1)).alias("rows"))
    per.coalesce(1).sortWithinPartitions("first").write.mode("errorifexists").parquet(f"{path}/directory")


def between(surt: Column, prefix: str) -> Column:
    return (surt >= f"{prefix},") & (surt < f"{prefix}-")


def key_range(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """SRC-6: keys of one registry, ``prefix,`` up to but without ``prefix-``.

    The directory names the files that can hold such keys, and only these are opened; both bounds reach their scan.
    """
    directory = spark.read.parquet(f"{path}/directory")
    held = directory.filter((F.col("last") >= f"{prefix},") & (F.col("first") < f"{prefix}-"))
    files = [f"{path}/captures/{r.file}" for r in held.select("file").collect()]  # names of the files to open
    schema = spark.read.parquet(f"{path}/captures").schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows.filter(between(F.col("surt"), prefix))


def surt_of(host):
    """Reversed host labels followed by ')'."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"))
