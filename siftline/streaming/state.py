"""STR-6, STR-7, STR-10: keyed state on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siftline.operators.samples import bounded_sample
from siftline.operators.validation import FRESH_DAYS, TEMPORARY
from siftline.streaming.runs import run_folder, subfolders

CACHE_STATE = "status string, reason string, checked_at double"
CACHE_OUT = "email_hash string, seq long, status string, reason string, reused boolean"


def cached_results(results: DataFrame, keep_seconds: float = FRESH_DAYS * 86_400.0) -> DataFrame:
    """STR-6: per address hash, reuse a result younger than three days; temporary results are not kept.

    Input ``(email_hash, seq, ts, status, reason)``: what a check would give at that time.  State is one small
    row per address; an address that is not seen for ``keep_seconds`` of processing time leaves it, which changes no answer of a
    stream that keeps up, since its result is too old by then.  There is no watermark, so a row is answered however late it
    comes; a late row meets the newest result.  The rows of an address are read in the batches in which they arrive, each in
    the order of time: a hot address never is one frame.
    """
    span = FRESH_DAYS * 86_400.0

    def each(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else None
        for part in parts:
            out = []
            for row in part.sort_values(["t", "seq"]).itertuples(index=False):
                reuse = held is not None and held[2] > row.t - span
                status, reason = (held[0], held[1]) if reuse else (row.status, row.reason)
                if not reuse:
                    held = None if reason == TEMPORARY else (status, reason, float(row.t))
                out.append((key[0], row.seq, status, reason, reuse))
            yield pd.DataFrame(out, columns=["email_hash", "seq", "status", "reason", "reused"])
        if held is not None:
            state.update(held)
            state.setTimeoutDuration(max(1, int(keep_seconds * 1000)))
        elif state.exists:
            state.remove()

    rows = results.withColumn("t", F.unix_micros("ts") / 1e6)
    return rows.groupBy("email_hash").applyInPandasWithState(each, CACHE_OUT, CACHE_STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def sample_stream(captures: DataFrame, path: str, cap: int, order: str = "pos", run: str = "sample", after: str | None = None,
                  record: str | None = None, latest: tuple[str, ...] = ()):
    """STR-7: writer that keeps the bounded sample of every source as a table per run and batch id.

    The held sample is all the memory the rule needs, so each micro-batch merges it with the new rows.  The table of
    batch n is written from that of batch n-1, which makes a repeated batch harmless.  A new checkpoint needs a new run; it goes
    on from the last table of the run ``after``.  With ``record``, repeated captures update the row that is held.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = run_folder(batch, path, run, batch_id)
        before = f"{path}/run={run}/batch_id={batch_id - 1}" if batch_id > 0 else last_table(spark, f"{path}/run={after}") if after else None
        held = spark.read.schema(batch.schema).parquet(before) if before else None
        bounded_sample(batch, cap, order, held=held, record=record, latest=latest).write.mode("overwrite").parquet(f"{path}/{folder}")

    return captures.writeStream.foreachBatch(each)


def last_table(spark: SparkSession, path: str) -> str | None:
    """The folder of the last micro-batch of a run."""
    numbers = [int(name.removeprefix("batch_id=")) for name in subfolders(spark, path)]
    return f"{path}/batch_id={max(numbers)}" if numbers else None


def deliver_stream(items: DataFrame, path: str, run: str = "delivery", key: str = "lead_id"):
    """STR-10: writer that stores the items of a micro-batch in a folder of its run and batch id; a repeated batch writes the same folder.

    A new checkpoint under the same name is refused.  Under a name of its own it reads everything again and delivers what
    no other run has delivered.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = run_folder(batch, path, run, batch_id)
        others = [f"{path}/{name}" for name in subfolders(spark, path) if name.startswith("run=") and name != f"run={run}"]
        for other in others:
            batch = batch.join(spark.read.schema(items.schema).parquet(other).select(key), key, "left_anti")
        batch.select(*items.columns).write.mode("overwrite").parquet(f"{path}/{folder}")

    return items.writeStream.foreachBatch(each)
