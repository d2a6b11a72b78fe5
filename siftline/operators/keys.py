"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from siftline.session import durable

# A key is hot above this share of the rows, so there are at most 1 / HOT_SHARE hot keys: that bound
# is what makes their broadcast safe whatever the size of the data.
HOT_SHARE = 0.001
HOT_FLOOR = 100_000


def attach(rows: DataFrame, keyed: DataFrame, key: str, total: int, weight: str = "n") -> DataFrame:
    """Left join of ``rows`` with one row per key, where ``keyed`` counts its rows in ``weight``.

    Hot keys (at most ``1 / HOT_SHARE`` of them) are broadcast and never shuffled with their rows; the
    other keys take a plain shuffled join.
    """
    limit = max(HOT_FLOOR, int(total * HOT_SHARE))
    if total <= limit:
        return rows.join(keyed.drop(weight), key, "left")
    hot = keyed.filter(F.col(weight) > limit).drop(weight)
    names = hot.select(key)
    cold = keyed.filter(F.col(weight) <= limit).drop(weight)
    at_hot = rows.join(F.broadcast(hot), key, "inner")
    at_cold = rows.join(F.broadcast(names), key, "left_anti").join(cold, key, "left")
    return at_hot.unionByName(at_cold)


def first_by(df: DataFrame, keys: list[str], order: list[str], carry: list[str]) -> DataFrame:
    """First row per key in ``order``, as an aggregate: map tasks send one row per key, so a hot key
    costs no more than a cold one."""
    picked = F.min_by(F.struct(*carry), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("_first")).select(*keys, "_first.*")


def positions(df: DataFrame, order: str, group: str | None = None, out: str = "position", pieces: int | None = None) -> DataFrame:
    """0-based position by a unique ``order``, per ``group`` when given (H-4, WIN-3, WIN-4).

    Rows are range-partitioned by group and order with bounds sampled from the data, so neither the gaps between ids nor a group
    that holds everything matters, and written.  The number that a row got while it was written holds its piece and its
    place there; what a group has in the pieces before is one row per piece and group.
    """
    g = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    staged = df.withColumn("_pos_g", g)
    by = [F.col("_pos_g"), F.col(order)] if group else [F.col(order)]
    dealt = staged.repartitionByRange(pieces, *by) if pieces else staged.repartitionByRange(*by)
    numbered = durable(dealt.sortWithinPartitions(*by).withColumn("_pos_at", F.monotonically_increasing_id()), "numbered")
    numbered = numbered.withColumn("_pos_piece", F.shiftright("_pos_at", 33))
    held = numbered.groupBy("_pos_piece", "_pos_g").agg(F.min("_pos_at").alias("_pos_first"), F.count(F.lit(1)).alias("_pos_n"))
    earlier = Window.partitionBy("_pos_g").orderBy("_pos_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = durable(held.select("_pos_piece", "_pos_g", "_pos_first", F.coalesce(F.sum("_pos_n").over(earlier), F.lit(0)).alias("_pos_off")), "offsets")
    placed = numbered.join(offsets, ["_pos_piece", "_pos_g"])
    return placed.withColumn(out, (F.col("_pos_off") + F.col("_pos_at") - F.col("_pos_first")).cast("long")).select(*[F.col(f"`{c}`") for c in df.columns], out)


BROADCAST_ROWS = 500_000


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left", bound: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a table that has one row per key: broadcast when its size was checked, otherwise the
    hot keys of ``rows`` are split off first."""
    if table.limit(bound + 1).count() <= bound:
        return rows.join(F.broadcast(table), key, how)
    if how != "left":
        return rows.join(table, key, how)
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(table, key, "left")
    return attach(rows, counted, key, rows.count())
