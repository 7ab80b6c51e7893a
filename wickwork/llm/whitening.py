"""Whitening of embeddings with MLlib's distributed BlockMatrix.

Entries become whole numbers x = floor(64 c) + 1000000, so that sums are exact in any order. Rows get consecutive
numbers from the counts of their partitions, are centred with the exact sums and cut into blocks; the transpose times
the blocks is the scatter matrix, in ``splits`` parts along the rows, so that no task meets more than its share of
blocks and only d x d parts are added. Its eigenvectors are found on the driver (d x d numbers, d at most MOST_DIMS).
The blocks times the whitening matrix are the whitened rows, whose own scatter matrix gives identity_error.

A block has BLOCK_ROWS rows, more from 4,096 blocks on and at most BLOCK_VALUES numbers: MLlib plans a product on the
driver from the blocks' numbers, and so that list stays short (12 million for 4e11 rows of 64).

Defined results: vectors that are null or hold null or non-finite entries are dropped, and so are those of another
length than most rows have (the longer one if two are as common). Repeated rows and ids are rows of their own; a null
id stays null. Entries beyond 2^60 either way count as 2^60. deviation is null where it exceeds a long. Components whose
eigenvalue is 0 in double precision can't be whitened and are left out, so equal vectors, a single one or none give
no rows. Other columns are ignored. A vector is held by one task; long ones only mean fewer rows a block.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wickwork.llm.base import cut, table

COMPONENTS, MOST_DIMS = 32, 8192
BLOCK_ROWS, BLOCK_COLUMNS, BLOCK_VALUES, BLOCKS, SPLITS = 4096, 1024, 1 << 21, 4096, 1000
SCALE, OFFSET, MOST = 64, 1_000_000, 2**60
LEAST = 1e-10


def indexed(df: DataFrame) -> DataFrame:
    """df with a column index: consecutive from 0, by the counts of the partitions before. The rows are written once."""
    rows = cut(df.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))  # a row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "part").withColumn("index", F.col("start") + F.col("place")).drop("part", "place", "start")


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the rows that can be used, as whole numbers."""
    finite = ~F.exists("embedding", lambda c: ~F.coalesce(F.abs(c.cast("double")) < math.inf, F.lit(False)))
    good = embeddings.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & finite)
    size = good.groupBy(F.size("embedding").alias("d")).count().agg(F.max(F.struct("count", "d")).alias("m")).first().m
    x = F.transform("embedding", lambda c: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(c.cast("double") * SCALE))) + OFFSET)
    return good.where(F.size("embedding") == (size.d if size else 0)).select("vec_id", x.alias("x"))


def _matrix(rows: DataFrame, vector: Column, n: int, d: int) -> BlockMatrix:
    """rows (index) and their vectors as blocks, all in the JVM."""
    ready = MLUtils.convertVectorColumnsFromML(rows.select(F.col("index").cast("long").alias("index"), array_to_vector(vector).alias("vector")), "vector")
    height = max(BLOCK_ROWS, min(max(1, BLOCK_VALUES // d), -(-n // BLOCKS)))
    # kept for the matrix, its transpose and their plans; a lost executor's blocks are made again from the rows' files
    return IndexedRowMatrix(ready, n, d).toBlockMatrix(height, BLOCK_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)


def _freed(m: BlockMatrix) -> None:
    m._java_matrix_wrapper._java_model.blocks().unpersist(False)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a b; the inner dimension in so many parts, which Python's multiply doesn't offer."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(m: BlockMatrix, n: int) -> np.ndarray:
    """The transpose times m: d x d numbers."""
    return _times(m.transpose(), m, min(SPLITS, -(-n // m.rowsPerBlock))).toLocalMatrix().toArray()


@dataclass
class Whitening:
    """sums: exact, by dimension. matrix: d x k, a column a component. explained: eigenvalues over their sum. identity_error: of the fitted rows."""

    n: int
    sums: list[int]
    matrix: np.ndarray
    explained: list[float]
    identity_error: float


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling, without those that are 0 beside the largest."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(values.max(), 0) * LEAST]
    return values[order], vectors[:, order]


def _deviation(n: int, sums: list[int], low: list[int], high: list[int]) -> Column:
    """Sum of (n x - S)^2: in longs where no vector can exceed them, else in decimals of 38 digits."""
    widest = [max(abs(n * a - s), abs(n * b - s)) for s, a, b in zip(sums, low, high, strict=True)]
    if max(n * max(abs(a), abs(b)) for a, b in zip(low, high, strict=True)) < 2**62 and sum(w * w for w in widest) < 2**63:
        squares = F.zip_with("x", F.array(*map(F.lit, sums)), lambda x, s: (x * n - s) * (x * n - s))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda a, b: a + b)
    wide = "decimal(38,0)"
    away = F.zip_with("x", F.array(*(F.lit(Decimal(s)).cast(wide) for s in sums)), lambda x, s: (x.cast("decimal(20,0)") * F.lit(Decimal(n)).cast("decimal(13,0)") - s).cast(wide))
    return F.aggregate(away, F.lit(Decimal(0)).cast(wide), lambda a, b: F.try_add(a, F.try_multiply(b, b).cast(wide)).cast(wide)).try_cast("long")


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> tuple[DataFrame, Whitening] | None:
    """(vec_id, deviation, whitened as an array) of every row that can be used, and what was fitted; None if there is nothing to whiten."""
    rows = indexed(whole_vectors(embeddings))
    about = rows.select(F.posexplode("x").alias("dim", "x")).groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high"))
    about = about.orderBy("dim").limit(MOST_DIMS + 1).collect()  # a row a dimension
    if not about:
        return None
    n, d, sums = about[0].n, len(about), [int(r.s) for r in about]
    if d > MOST_DIMS:
        raise ValueError(f"vectors have more than {MOST_DIMS} dimensions")
    mean = F.array(*(F.lit(s / n) for s in sums))
    blocks = _matrix(rows, F.zip_with("x", mean, lambda x, m: x.cast("double") - m), n, d)
    covariance = scatter(blocks, n) / n
    values, vectors = components(covariance, most)
    if not len(values):
        _freed(blocks)
        return None
    k, w = len(values), vectors / np.sqrt(values)
    spark = rows.sparkSession
    matrix = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(w)], "index long, w array<double>")
    right = MLUtils.convertVectorColumnsFromML(matrix.select("index", array_to_vector("w").alias("vector")), "vector")
    product = _times(blocks, IndexedRowMatrix(right, d, k).toBlockMatrix(BLOCK_COLUMNS, BLOCK_COLUMNS))
    found = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    white = cut(found.select("index", vector_to_array("vector").alias("w")))
    _freed(blocks)
    means = white.select(F.posexplode("w").alias("c", "w")).groupBy("c").agg(F.avg("w").alias("m")).orderBy("c").collect()  # a row a component
    centred = _matrix(white, F.zip_with("w", F.array(*(F.lit(r.m) for r in means)), lambda x, m: x - m), n, k)
    error = float(np.abs(scatter(centred, n) / n - np.eye(k)).max())
    _freed(centred)
    out = rows.select("index", "vec_id", _deviation(n, sums, [r.low for r in about], [r.high for r in about]).alias("deviation")).join(white, "index")
    return out.select("vec_id", "deviation", F.col("w").alias("whitened")), Whitening(n, sums, w, [float(v) for v in values / np.trace(covariance)], error)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whiten(table(spark, sf_dir, "embeddings"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if done is None:
        return spark.createDataFrame([], schema)
    rows, fit = done
    long = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.get(F.array(*map(F.lit, fit.explained)), F.col("at"))
    return long.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(fit.identity_error).alias("identity_error"))
