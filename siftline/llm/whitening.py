"""Embedding whitening with MLlib block matrices.

Every entry ``c`` becomes the whole number ``floor(SCALE * c) + OFFSET``, so sums and squared deviations are exact.  The rows
minus their mean are indexed without gaps and become a :class:`BlockMatrix`; its transpose times itself is the scatter
matrix, as large as the vectors are long, whatever the number of rows.  The middle dimension of that product is split, so
that its blocks meet in many tasks and only sums of the size of the scatter matrix meet in one.  Eigenvectors of the
covariance are found on the driver (``eigh``); blocks times the whitening matrix (eigenvectors over the
roots of their eigenvalues) project all rows.  The covariance of what comes out is measured by the same product and
compared with the identity.

Nothing grows with the rows on the driver but the offsets of the written parts (one number a part) and MLlib's list of blocks.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries take no part, nor do those with an
entry of 2 ** 40 or more, whose whole number has no exact double, or with another length than most rows (ties: the shorter
length); a zero vector does.  A null id takes part as any other.  A component without variance (an eigenvalue at
the rounding error of the largest) has no direction: its ``whitened`` is null and it is left out of ``identity_error``, which is
null if none is left.  ``explained`` is 0 if all rows are equal.  Repeated rows each count and get equal results; an empty
table gives an empty result; other columns are ignored.  The sign of a component makes its largest entry positive.
``deviation`` is a decimal of 38 digits; the query gives it as a long, null where it needs more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftline.llm.common import Scratch

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
ROWS, COLUMNS = 1024, 1024  # of a block
SPLITS = 4096  # most tasks that multiply; their sums meet in one task per block of the scatter matrix
LARGEST = float(1 << 40)


@dataclass
class Fit:
    """What is known of all rows: ``vectors`` has a unit eigenvector a column, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def usable(self, k: int) -> np.ndarray:
        """Which of the first ``k`` components have variance."""
        floor = max(self.values[0], 0.0) * len(self.values) * np.finfo(float).eps
        return self.values[:k] > floor


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and ``x`` of the rows that take part."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("c")).filter(F.col("c").isNotNull() & (F.size("c") > 0))
    rows = rows.filter(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)))
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE) + F.lit(OFFSET).cast("long")).alias("x"))


def indexed(rows: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, int]:
    """The rows with an ``index`` from 0 without gaps, and their number.

    Parts are numbered by the task that writes them and rows inside a part by their order, both fixed by writing; the
    sizes of the parts before give the offset.
    """
    kept = scratch.keep(rows.withColumn("_at", F.monotonically_increasing_id()), name)
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["p"], r["n"]) for r in kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # a number for each part
    starts, n = [], 0
    for p, size in sizes:
        starts.append((p, n))
        n += size
    offsets = kept.sparkSession.createDataFrame(starts, "_p long, _start long")
    placed = kept.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    return placed.withColumn("index", F.col("_start") + inside).drop("_p", "_start", "_at"), n


def blocks(rows: DataFrame, n: int, width: int, vector: str) -> BlockMatrix:
    """``index`` and an array of doubles as a matrix in blocks."""
    frame = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(vector).alias("vector")), "vector")
    return IndexedRowMatrix(frame, n, width).toBlockMatrix(ROWS, COLUMNS)


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left`` times ``right`` with the middle dimension cut into ``splits``, which PySpark's own method does not pass on."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times matrix, as a local array of the width of the matrix."""
    return product(matrix.transpose(), matrix, max(1, min(SPLITS, -(-n // ROWS)))).toLocalMatrix().toArray()


def fitted(rows: DataFrame, n: int, width: int) -> tuple[Fit, DataFrame, BlockMatrix]:
    """Sums and eigenvectors of all rows, the centred rows and their blocks."""
    sums = rows.select(F.posexplode("x").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).orderBy("d").collect()
    sums = [int(r["s"]) for r in sums]
    means = F.array(*[F.lit(s / n) for s in sums])
    centred = rows.withColumn("centred", F.zip_with("x", means, lambda x, m: x.cast("double") - m))
    matrix = blocks(centred, n, width, "centred")
    covariance = scatter(matrix, n) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(width)])
    return Fit(n, sums, values, vectors, float(np.trace(covariance))), centred, matrix


def projected(spark: SparkSession, matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """``index`` and ``y``: all rows times ``weights``."""
    width, k = weights.shape
    parts = [((i, 0), DenseMatrix(len(w), k, w.ravel(order="F").tolist())) for i, w in ((i, weights[at : at + COLUMNS]) for i, at in enumerate(range(0, width, COLUMNS)))]
    right = BlockMatrix(spark.sparkContext.parallelize(parts, 1), COLUMNS, COLUMNS, width, k)
    made = product(matrix, right).toIndexedRowMatrix()
    return callMLlibFunc("getIndexedRows", made._java_matrix_wrapper._java_model).select("index", vector_to_array("vector").alias("y"))


def deviation(x: str, fit: Fit) -> Column:
    """Sum of (n * x - S) ** 2 in whole numbers."""
    sums = F.array(*[F.lit(s).cast("decimal(38,0)") for s in fit.sums])
    square = F.zip_with(x, sums, lambda v, s: (v.cast("decimal(19,0)") * F.lit(fit.n).cast("decimal(18,0)") - s).cast("decimal(19,0)"))
    return F.aggregate(square, F.lit(0).cast("decimal(38,0)"), lambda a, d: (a + d * d).cast("decimal(38,0)"))


def whitened(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per remaining row: vec_id, ``y`` (its whitened components), ``deviation`` (decimal), n, ``explained`` and identity_error."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = whole_numbers(vectors, vec_id, vector)
    lengths = rows.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).first()
    if lengths is None:
        return spark.createDataFrame([], "vec_id long, y array<double>, deviation decimal(38,0), n long, explained array<double>, identity_error double")
    width = lengths["w"]
    rows, n = indexed(rows.filter(F.size("x") == width), scratch, "whole-numbers")
    fit, centred, matrix = fitted(rows, n, width)
    k = min(components, width)
    good = fit.usable(k)
    roots = np.where(good, np.sqrt(np.where(good, fit.values[:k], 1.0)), np.inf)
    found = scratch.keep(projected(spark, matrix, fit.vectors[:, :k] / roots), "projected")

    # the covariance of the result, about its own mean
    means = found.agg(*[F.avg(F.get("y", F.lit(i))) for i in range(k)]).first()
    about = found.withColumn("z", F.zip_with("y", F.array(*[F.lit(m) for m in means]), lambda y, m: y - m))
    spread = scatter(blocks(about, n, k, "z"), n)[np.ix_(good, good)] / n
    error = float(np.abs(spread - np.eye(len(spread))).max()) if len(spread) else None

    shares = [float(v) / fit.trace if fit.trace > 0 else 0.0 for v in fit.values[:k]]
    y = F.array(*[F.get("y", F.lit(i)) if good[i] else F.lit(None).cast("double") for i in range(k)])
    out = rows.select("index", "vec_id", deviation("x", fit).alias("deviation")).join(found, "index")
    return out.select("vec_id", y.alias("y"), "deviation", F.lit(n).cast("long").alias("n"), F.array(*[F.lit(s) for s in shares]).alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component; ``deviation`` is null where it does not fit a long."""
    rows = whitened(vectors, components)
    rows = rows.select("vec_id", F.posexplode(F.arrays_zip("y", "explained")).alias("c", "v"), "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error")
    return rows.select("vec_id", (F.col("c") + 1).cast("int").alias("component"), "n", "deviation", F.col("v.y").alias("whitened"), F.col("v.explained").alias("explained"), "identity_error")
