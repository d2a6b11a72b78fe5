"""SRC-1, SRC-7, SET-2: the record contract and labelled files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from siftline.schemas import RECORD

# Fixed value: the bound collectors put on a record's text.
TEXT_LIMIT = 16_000


def read_records(spark: SparkSession, path: str, fmt: str = "parquet", text_limit: int | None = None) -> DataFrame:
    """SRC-1 from files with the record schema; texts stay whole unless a bound (collectors use ``TEXT_LIMIT``) is asked for."""
    return to_records(spark.read.schema(RECORD).format(fmt).load(path), text_limit)


def to_records(rows: DataFrame, text_limit: int | None = None) -> DataFrame:
    """SRC-1: any table with some of the record columns, with defaults for the others.

    Texts stay whole unless a bound is asked for.
    """
    have = set(rows.columns)
    columns = []
    for field in RECORD.fields:
        given = F.col(field.name).cast(field.dataType) if field.name in have else F.lit(None).cast(field.dataType)
        kind = field.dataType
        if isinstance(kind, T.StringType):
            given = F.coalesce(given, F.lit(""))
        elif isinstance(kind, T.BooleanType):
            given = F.coalesce(given, F.lit(False))
        elif isinstance(kind, T.ArrayType):
            given = F.coalesce(given, F.array().cast(kind))
        elif isinstance(kind, T.MapType):
            given = F.coalesce(given, F.create_map().cast(kind))
        if field.name == "text" and text_limit:
            given = F.left(given, F.lit(text_limit))
        columns.append(given.alias(field.name))
    others = [c for c in rows.columns if c not in RECORD.names]
    return rows.select(*others, *columns)


def union_sources(tables: list[DataFrame]) -> DataFrame:
    """SET-2."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_labelled(spark: SparkSession, path: str, first: str = "text", second: str = "label") -> DataFrame:
    """SRC-7: CSV with a header; quoted line breaks and a byte order mark are accepted."""
    schema = T.StructType([T.StructField(first, T.StringType()), T.StructField(second, T.StringType())])
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=True)
