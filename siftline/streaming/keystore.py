"""STR-1: the permanent key table as files that a micro-batch can skip.

Keys are stored by the leading bits of their hash (``part``), a segment per micro-batch.  Beside every segment lies a
blocked Bloom filter: of each part ``words`` numbers of 64 bits, of which a key sets ``BITS`` in one.  A batch asks the filters
first, collects the parts that may hold one of its keys (at most ``parts`` numbers), and reads only those.  A filter that
is too small for its keys prunes less and is never wrong.

``compacted`` merges all segments into one.  Rows keep the run and the batch that wrote them, so a batch that is run
again after a failure still finds every key but its own.  One writer at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftline.streaming.runs import removed, subfolders

BITS = 4
KEYS = "key string, created_at timestamp, run string, batch_id bigint, seg string, part int"
FILTER = "part int, word int, bits bigint, run string, batch_id bigint, seg string"


class KeyStore:
    def __init__(self, spark: SparkSession, path: str, parts: int = 256, words: int = 1024):
        """``parts`` is a power of two; 64 * ``parts`` * ``words`` bits serve about a sixteenth of that number of keys well."""
        if parts < 2 or parts & (parts - 1):
            raise ValueError("the number of parts must be a power of two")
        self.spark, self.path, self.parts, self.words = spark, path, parts, words
        layout = f"parts-{parts}-words-{words}"
        known = subfolders(spark, f"{path}/_layout")
        if known and known != [layout]:
            raise ValueError(f"{path} was made with {known[0]}")
        if not known:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_layout/{layout}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)

    def placed(self, key: str = "key") -> dict[str, Column]:
        """Part, word and bits of a key."""
        other = F.xxhash64(F.lit(1), F.col(key))
        more = F.xxhash64(F.lit(2), F.col(key))
        # shifts take the lowest six bits of their count
        one = [F.expr("1L").cast("long")] * BITS
        bits = [F.call_function("shiftleft", o, F.shiftrightunsigned(more, 6 * i).bitwiseAND(63).cast("int")) for i, o in enumerate(one)]
        return {"part": F.shiftrightunsigned(F.xxhash64(key), 65 - self.parts.bit_length()).cast("int"),
                "word": F.pmod(other, F.lit(self.words)).cast("int"), "bits": reduce(Column.bitwiseOR, bits)}

    def _earlier(self, kind: str, schema: str, run: str | None, batch_id: int | None) -> DataFrame:
        if not subfolders(self.spark, f"{self.path}/{kind}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        return rows if run is None else rows.filter((F.col("run") != run) | (F.col("batch_id") < batch_id))

    def possible(self, keys: DataFrame, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """The distinct keys that the filters do not rule out, with their part."""
        filters = self._earlier("filters", FILTER, run, batch_id).groupBy("part", "word").agg(F.bit_or("bits").alias("_set"))
        asked = keys.select("key").distinct().withColumns(self.placed())
        met = asked.join(filters, ["part", "word"])
        return met.filter(F.col("_set").bitwiseAND(F.col("bits")) == F.col("bits")).select("key", "part")

    def known(self, keys: DataFrame, run: str | None = None, batch_id: int | None = None) -> DataFrame:
        """``key`` and ``created_at`` of those of ``keys`` that are stored; a batch does not see itself and later ones of its run."""
        possible = self.possible(keys, run, batch_id)
        hit = sorted(r["part"] for r in possible.select("part").distinct().collect())  # at most ``parts`` numbers
        rows = self._earlier("keys", KEYS, run, batch_id).filter(F.col("part").isin(hit) if hit else F.lit(False))
        return rows.join(possible.select("key"), "key", "left_semi").select("key", "created_at")

    def _written(self, rows: DataFrame, seg: str) -> None:
        """Rows with key, created_at, run and batch_id as one segment: the filter first, so that no stored key is ever ruled out."""
        placed = rows.withColumns(self.placed())
        filters = placed.groupBy("run", "batch_id", "part", "word").agg(F.bit_or("bits").alias("bits"))
        filters.select("part", "word", "bits", "run", "batch_id").write.mode("overwrite").parquet(f"{self.path}/filters/seg={seg}")
        stored = placed.select("key", "created_at", "run", "batch_id", "part")
        stored.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/keys/seg={seg}")

    def add(self, keys: DataFrame, run: str, batch_id: int) -> None:
        """Stores the keys of a batch; a repeated batch replaces its own segment."""
        rows = keys.select("key", "created_at", F.lit(run).alias("run"), F.lit(batch_id).cast("long").alias("batch_id"))
        self._written(rows, f"{run}-{batch_id}")

    def all(self) -> DataFrame:
        return self._earlier("keys", KEYS, None, None).select("key", "created_at", "run", "batch_id")

    def compacted(self) -> int:
        """Merges all segments into a new one and removes them; their number.

        Until the old ones are gone keys are there twice, which no reader minds."""
        old = subfolders(self.spark, f"{self.path}/keys")
        if len(old) > 1:
            self._written(self.all().groupBy("key", "run", "batch_id").agg(F.min("created_at").alias("created_at")), f"merged-{uuid.uuid4().hex}")
            for seg in old:
                removed(self.spark, f"{self.path}/keys/{seg}")
                removed(self.spark, f"{self.path}/filters/{seg}")
        return len(old)
