"""Whitening of embeddings with block matrices.

Distinct vectors are the fit list. Its centred rows are indexed and dealt into blocks; the scatter is
the transposed block matrix times itself, with the long dimension cut into many splits; the small
covariance is solved on the driver; another block product with the whitening matrix projects rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnbook.session import ensure_checkpoint_dir

#: Rows of a block, and blocks whose product is summed up by one task.
BLOCK_ROWS, BLOCKS_A_SPLIT = 1024, 64
#: The covariance and the whitening matrix are held by the driver.
MOST_DIMS = 4096
#: Components below this share of the trace have no direction of their own.
LEAST_SHARE = 1e-12
_ONE = 1 << 63


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, x array<bigint>: floor(scale * entry) of the vectors whose entries are all there and finite.

    Null and empty vectors, null or non-finite entries and entries beyond a long are left out. Vectors of
    another length than the most common one (of equally common ones the longest) have no place in one
    covariance and are left out too."""
    raw = F.col("embedding").cast("array<double>")
    scaled = F.transform(raw, lambda c: F.floor(c * F.lit(float(scale)) + F.lit(0.0)))
    fine = (F.size(raw) > 0) & F.forall(raw, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(float(_ONE))))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<bigint>").alias("x"))


def _numbered(rows: DataFrame) -> DataFrame:
    """`rows` (a checkpoint) with a dense `row` from 0: the place in its partition after the rows of those before it."""
    placed = rows.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33).cast("int"))
    sizes = sorted((r.part, r["count"]) for r in placed.groupBy("part").count().collect())
    begins = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    offsets = rows.sparkSession.createDataFrame([(part, begin) for (part, _), begin in zip(sizes, begins)], "part int, begin long")
    return placed.join(F.broadcast(offsets), "part").withColumn("row", F.col("begin") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "at", "begin")


def _blocks(numbered: DataFrame, n: int, mean: list[float]) -> BlockMatrix:
    """Centred rows (row, x) as blocks of BLOCK_ROWS rows; nothing leaves the JVM."""
    centre = F.array(*map(F.lit, mean))
    rows = numbered.select("row", array_to_vector(F.zip_with(F.col("x").cast("array<double>"), centre, lambda a, b: a - b)).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector"), n, len(mean)).toBlockMatrix(BLOCK_ROWS, len(mean))


def _gram(blocks: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times itself. The splits of the long dimension are multiplied apart and summed, so no task meets all blocks."""
    splits = max(-(-n // (BLOCK_ROWS * BLOCKS_A_SPLIT)), min(-(-n // BLOCK_ROWS), SparkContext.getOrCreate().defaultParallelism))
    flipped = blocks.transpose()
    product = flipped._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, flipped.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _times(blocks: BlockMatrix, matrix: np.ndarray) -> BlockMatrix:
    d, k = matrix.shape
    right = BlockMatrix(SparkContext.getOrCreate().parallelize([((0, 0), DenseMatrix(d, k, matrix.ravel(order="F")))], 1), d, k, d, k)
    return blocks.multiply(right)


def _rows(blocks: BlockMatrix) -> DataFrame:
    """row, whitened array<double>."""
    found = callMLlibFunc("getIndexedRows", blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(found, "vector").select(F.col("index").alias("row"), vector_to_array("vector").alias("whitened"))


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over dimensions of (n * x - S)^2, null where a long does not hold it."""
    if any(abs(s) >= _ONE for s in sums):
        return F.lit(None).cast("long")
    each = F.zip_with("x", F.array(*(F.lit(s).cast("long") for s in sums)), lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(n).cast("long")), s))
    return F.aggregate(each, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def whiten(vectors: DataFrame, *, components: int = 4, scale: int = 256) -> DataFrame:
    """row, vec_id, n, deviation, whitened and explained (arrays by component), identity_error of every remaining row of `vectors` (vec_id, embedding).

    The fit list holds each distinct vector once, so copies weigh nothing. Components without variance (and
    those that the dimensions do not have) are not returned: one distinct vector, or none, gives no rows.
    Null ids and repeated rows are rows of their own; other columns are ignored. A deviation beyond a long is null."""
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    none = spark.createDataFrame([], "row long, vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    remaining = integer_vectors(vectors, scale).checkpoint()
    lengths = remaining.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return none
    dims = lengths.dims
    if dims > MOST_DIMS:
        raise ValueError(f"vectors of {dims} entries: the covariance is solved on the driver up to {MOST_DIMS}")
    rows = _numbered(remaining).where(F.size("x") == dims)
    # Row numbers may have gaps where other lengths stood: empty places of a block add nothing.
    top = rows.agg(F.max("row")).first()[0] + 1
    distinct = remaining.where(F.size("x") == dims).select("x").distinct().checkpoint()
    total = distinct.agg(F.count("*").alias("n"), *(F.sum(F.col("x")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims))).first()
    n, sums = total.n, [int(total[f"s{d}"]) for d in range(dims)]
    mean = [s / n for s in sums]

    fit = _blocks(_numbered(distinct), n, mean)
    covariance = _gram(fit, n) / n
    trace = float(np.trace(covariance))
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    order = [i for i in np.argsort(values)[::-1][:components].tolist() if trace > 0 and values[i] > LEAST_SHARE * trace]
    if not order:
        return none
    matrix = directions[:, order] / np.sqrt(values[order])
    error = float(np.abs(_gram(_times(fit, matrix), n) / n - np.eye(len(order))).max())
    projected = _rows(_times(_blocks(rows, top, mean), matrix))
    told = rows.select("row", "vec_id", F.lit(n).cast("long").alias("n"), _deviation(n, sums).alias("deviation"))
    return told.join(projected, "row").select("row", "vec_id", "n", "deviation", "whitened", F.array(*(F.lit(float(values[i] / trace)) for i in order)).alias("explained"), F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    each = whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("pair.whitened").alias("whitened"), F.col("pair.explained").alias("explained"), "identity_error")
