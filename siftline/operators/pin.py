"""Expensive columns that are computed once per row, whatever is built on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a one-row generator.

    The optimizer moves a filter on a computed column below the projection by copying the whole expression, and copies
    expressions into the inputs of Arrow batches.  For a dictionary match that means many scans of the same text.  It
    does neither across a generator, so the value is computed once and read as a plain column from there on.
    """
    packed = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline_outer(packed).alias(*columns))
