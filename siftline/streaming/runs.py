"""Runs: whose folders are whose when a stream is started again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_id(spark: SparkSession) -> str:
    """Id of the running stream: it lives in the checkpoint, so a restart keeps it and a new checkpoint has another."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none if it does not exist."""
    fs, where = _folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()) if fs.exists(where) else []


def removed(spark: SparkSession, path: str) -> None:
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def run_folder(batch: DataFrame, path: str, run: str | None, batch_id: int) -> str:
    """Folder of a micro-batch below ``path``.

    Without a name a run is named after its stream.  A name belongs to the checkpoint that used it first: batch ids start
    again with a new checkpoint, which would overwrite what the first one wrote, so it is refused.
    """
    spark = batch.sparkSession
    own = query_id(spark)
    name = run or own
    owners = f"{path}/_runs/{name}"
    if own not in subfolders(spark, owners):
        fs, owner = _folder(spark, f"{owners}/{own}")
        fs.mkdirs(owner)
        if len(subfolders(spark, owners)) > 1:
            fs.delete(owner, True)
            raise ValueError(f"run {name!r} of {path} belongs to another checkpoint; give this one a name of its own")
    return f"run={name}/batch_id={batch_id}"
