"""Segmented scan over ordered logs: runs in a row and the last event they made, whatever the number of rows of a key.

Rows are range-partitioned by key and order (the one shuffle) and sorted, so a piece is a range of rows and a hot key, or a hot
hour of it, is cut into as many pieces as it needs.  Each piece is scanned on its own, a batch at a time.  Only its first key
can go on from the piece before; for that key the scan notes what depends on the unknown start: the length of the first
run, until a row of the other kind closes it.  The last row of a piece thus is its transition from any start to an end.  These,
one small row a piece, are composed in order, and every piece gets its start back by a broadcast of as many rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from siftline.session import durable

# Columns of a row that tell how its state follows from the state before the piece (nullable longs, and flags).
LOCAL = ["_scan_bad", "_scan_good", "_scan_prefix", "_scan_length", "_scan_at", "_scan_forced_at", "_scan_kind", "_scan_kind_at"]
FLAGS = ["_scan_open_bad", "_scan_open_good", "_scan_first"]


def _last(valid: np.ndarray, values: np.ndarray, first: np.ndarray, carried: np.ndarray, before: float) -> np.ndarray:
    """Last valid value of the segment at or before every row (NaN without one); ``before`` holds for the carried segment."""
    at = np.maximum.accumulate(np.where(valid, np.arange(valid.size), -1))
    out = np.where(at >= first, values[np.maximum(at, 0)], np.nan)
    return np.where(carried & (at < first), before, out)


class _Piece:
    """State of a scan between two batches of a piece."""

    def __init__(self, to_bad: int, to_good: int | None):
        self.to_bad, self.to_good = to_bad, to_good
        self.key, self.begun, self.on_first = None, False, True
        self.bad = self.good = 0
        self.open = (True, True)
        self.kept = dict.fromkeys(("_scan_prefix", "_scan_length", "_scan_at", "_scan_forced_at", "_scan_kind", "_scan_kind_at"), np.nan)

    def _run(self, counts: np.ndarray, resets: np.ndarray, first: np.ndarray, carried: np.ndarray, before: int, was_open: bool, new_open: np.ndarray):
        """Rows counted since the last reset, and whether none was seen yet in a segment with an unknown start."""
        total = np.cumsum(counts)
        at = np.maximum.accumulate(np.where(resets, np.arange(resets.size), -1))
        closed = at >= first
        run = np.where(closed, total - total[np.maximum(at, 0)], total - total[first] + counts[first] + np.where(carried, before, 0))
        return run, ~closed & np.where(carried, was_open, new_open)

    def scan(self, keys: pa.Array, code: np.ndarray, forced: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        n = len(keys)
        names = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        begins = np.concatenate([[True], names[1:] != names[:-1]])
        head = keys[0].as_py()
        goes_on = self.begun and head == self.key
        first = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
        segment = np.cumsum(begins) - 1
        carried = (segment == 0) & goes_on
        # the first key of a piece is the only one whose start is unknown
        unknown = (segment == 0) & (self.on_first if goes_on else not self.begun)
        bad, open_bad = self._run((code == 1).astype(np.int64), code == 0, first, carried, self.bad, self.open[0], unknown)
        good, open_good = self._run((code == 0).astype(np.int64), code == 1, first, carried, self.good, self.open[1], unknown)
        in_bad, in_good = open_bad & (code == 1), open_good & (code == 0)
        prefix = in_bad | in_good
        event = ~prefix & (((code == 1) & ((bad >= self.to_bad) | forced)) | ((code == 0) & (good >= self.to_good if self.to_good else False)))
        kept = {
            "_scan_prefix": (prefix, code.astype(float)), "_scan_length": (prefix, np.where(in_bad, bad, good).astype(float)), "_scan_at": (prefix, at),
            "_scan_forced_at": (in_bad & forced, at), "_scan_kind": (event, code.astype(float)), "_scan_kind_at": (event, at)}
        out = {name: _last(valid, values, first, carried, self.kept[name]) for name, (valid, values) in kept.items()}
        self.key, self.begun = keys[n - 1].as_py(), True
        self.on_first = bool(unknown[-1])
        self.bad, self.good, self.open = int(bad[-1]), int(good[-1]), (bool(open_bad[-1]), bool(open_good[-1]))
        self.kept = {name: values[-1] for name, values in out.items()}
        return {"_scan_bad": bad, "_scan_good": good, "_scan_open_bad": open_bad, "_scan_open_good": open_good, "_scan_first": unknown, **out}


def _scanned(key: str, to_bad: int, to_good: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece, place, state = TaskContext.get().partitionId(), 0, _Piece(to_bad, to_good)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            code = batch.column("_scan_code").fill_null(-1).to_numpy(zero_copy_only=False)
            forced = batch.column("_scan_force").fill_null(False).to_numpy(zero_copy_only=False)
            payload = batch.column("_scan_payload").fill_null(0).to_numpy(zero_copy_only=False).astype(float)  # exact below 2 ** 53
            out = state.scan(batch.column(key), code, forced, payload)
            arrays = [pa.array(out[c], pa.int64(), mask=np.isnan(out[c])) if out[c].dtype.kind == "f" else pa.array(out[c], pa.int64()) for c in LOCAL]
            flags = [pa.array(out[c], pa.bool_()) for c in FLAGS]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays, *flags, pa.array(np.full(n, piece), pa.int64()), pa.array(np.arange(place, place + n), pa.int64())],
                                             names=[*batch.schema.names, *LOCAL, *FLAGS, "_scan_piece", "_scan_place"])
            place += n

    return run


def _ended(start: tuple, row, to_bad: int, to_good: int | None) -> tuple:
    """State after a row, given the state before its piece: runs, kind of the last event, its payload."""
    bad, good, kind, at = start if row["_scan_first"] else (0, 0, None, None)
    run_bad, run_good = row["_scan_bad"] + (bad if row["_scan_open_bad"] else 0), row["_scan_good"] + (good if row["_scan_open_good"] else 0)
    reached = (row["_scan_prefix"] == 1 and bad + row["_scan_length"] >= to_bad) or (row["_scan_prefix"] == 0 and bool(to_good) and good + row["_scan_length"] >= to_good)
    if row["_scan_kind"] is not None:
        return run_bad, run_good, row["_scan_kind"], row["_scan_kind_at"]
    if reached:
        return run_bad, run_good, row["_scan_prefix"], row["_scan_at"]
    if row["_scan_forced_at"] is not None:
        return run_bad, run_good, 1, row["_scan_forced_at"]
    return run_bad, run_good, kind, at


def streaks(rows: DataFrame, key: str, order: list[str], code: Column, to_bad: int = 1, to_good: int | None = None,
            forced: Column | None = None, payload: Column | None = None, pieces: int | None = None) -> DataFrame:
    """Adds ``bad_run`` and ``good_run``, the rows in a row whose ``code`` is 1 and 0 up to each row, and ``event`` with ``event_at``:
    the kind of the last event and the payload of its row.

    A bad row (1) makes an event when its run has ``to_bad`` rows or it is ``forced``, a good one (0) when its run has
    ``to_good`` rows (never without that).  Rows with a null code change nothing.  ``pieces`` is the number of ranges;
    without it that of the session's shuffles.
    """
    given = {"_scan_code": code.cast("int"), "_scan_force": forced if forced is not None else F.lit(False), "_scan_payload": (payload if payload is not None else F.lit(0)).cast("long")}
    staged = rows.withColumns(given)
    by = [F.col(key), *[F.col(o) for o in order]]
    dealt = staged.repartitionByRange(pieces, *by) if pieces else staged.repartitionByRange(*by)
    schema = StructType([*staged.schema.fields, *[StructField(c, LongType()) for c in LOCAL], *[StructField(c, BooleanType()) for c in FLAGS],
                         StructField("_scan_piece", LongType()), StructField("_scan_place", LongType())])
    local = durable(dealt.sortWithinPartitions(*by).mapInArrow(_scanned(key, to_bad, to_good), schema), "scan")

    ends = local.groupBy("_scan_piece").agg(F.min_by(F.struct(key), "_scan_place").alias("head"), F.max_by(F.struct(F.col(key).alias("_key"), *LOCAL, *FLAGS), "_scan_place").alias("tail"))
    starts, state, before = [], (0, 0, None, None), None
    for row in sorted(ends.collect(), key=lambda r: r["_scan_piece"]):  # a row a task
        if before is None or before["tail"]["_key"] != row["head"][key]:
            state = (0, 0, None, None)
        starts.append((row["_scan_piece"], *state))
        state, before = _ended(state, row["tail"], to_bad, to_good), row
    table = rows.sparkSession.createDataFrame(starts, "_scan_of long, _scan_s_bad long, _scan_s_good long, _scan_s_kind long, _scan_s_at long")
    met = local.join(F.broadcast(table), F.col("_scan_piece") == F.col("_scan_of"), "left")
    known = lambda c: F.when(F.col("_scan_first"), F.col(c))
    s_bad, s_good = F.coalesce(known("_scan_s_bad"), F.lit(0)), F.coalesce(known("_scan_s_good"), F.lit(0))
    reached = F.when(F.col("_scan_prefix") == 1, s_bad + F.col("_scan_length") >= to_bad).when(F.col("_scan_prefix") == 0, (s_good + F.col("_scan_length") >= to_good) if to_good else F.lit(False))
    event = F.when(F.col("_scan_kind").isNotNull(), F.col("_scan_kind")).when(reached, F.col("_scan_prefix")).when(F.col("_scan_forced_at").isNotNull(), 1).otherwise(known("_scan_s_kind"))
    at = F.when(F.col("_scan_kind").isNotNull(), F.col("_scan_kind_at")).when(reached, F.col("_scan_at")).when(F.col("_scan_forced_at").isNotNull(), F.col("_scan_forced_at")).otherwise(known("_scan_s_at"))
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_scan_bad") + F.when(F.col("_scan_open_bad"), s_bad).otherwise(0)).alias("bad_run"),
                      (F.col("_scan_good") + F.when(F.col("_scan_open_good"), s_good).otherwise(0)).alias("good_run"), event.cast("int").alias("event"), at.alias("event_at"))
