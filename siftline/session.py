"""Session defaults and the one way this package cuts lineage.

Every iterative or re-used intermediate goes through :func:`durable`, which writes a table below the
shared folder named by ``spark.checkpoint.dir``.  Nothing is pinned to an executor, so a lost executor
costs a re-read and not a wrong or failed result.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "siftline", master: str | None = None, cores: int | None = None) -> SparkSession:
    """Session with the settings the operators are written for; cluster settings win where present."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if cores:
        settings["spark.sql.shuffle.partitions"] = str(cores)
    if master and master.startswith("local"):
        settings["spark.driver.memory"] = "8g"  # the local master runs everything inside the driver
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds the rows of a batch between Spark and Python: whole texts are long, and a batch is held on both sides."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut tables: the cluster's setting, or a temporary folder on a local master only."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = os.environ.get("SIFTLINE_LOCAL_FOLDER") or tempfile.mkdtemp(prefix="siftline-")
    os.environ["SIFTLINE_LOCAL_FOLDER"] = folder
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/siftline-{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from that table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
