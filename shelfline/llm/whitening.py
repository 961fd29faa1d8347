"""Whitening of embeddings on distributed block matrices.

The distinct rows are centred, indexed and dealt into the blocks of an MLlib ``BlockMatrix``; the transpose times the
matrix is the scatter matrix, of which the driver takes the eigenvectors (a square of the dimensions, whatever the
number of rows), and the matrix times the whitening matrix gives the projected rows, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import flat
from shelfline.llm.columns import Numbered, free
from shelfline.session import materialize

SCALE = 64
OFFSET = 1_000_000
# Entries beyond this leave the exact integers.
LARGEST = float(1 << 61)
# Rows of a block: at least LEAST_ROWS, at most what BLOCK_VALUES doubles hold.
LEAST_ROWS = 256
BLOCK_VALUES = 1 << 20
COLS = 1024
# Directions with less than this share of the largest eigenvalue are constant in double precision.
FLAT = 1e-12


def quantised(vector: Column) -> Column:
    """Whole numbers ``floor(64 * c) + 1000000`` of a vector; null if an entry is null, not finite or too large."""
    c = F.transform(vector, lambda v: v.cast("double") * SCALE)
    good = vector.isNotNull() & (F.size(vector) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    return F.when(good, F.transform(c, lambda v: F.floor(v) + OFFSET))


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum by position of the vectors of a partition, exact in two halves of 32 bits."""
    high = low = None
    for batch in batches:
        column = batch.column(0)
        if not len(column):
            continue
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        a, b = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        high, low = (a, b) if high is None else (high + a, low + b)
    if high is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high)), pa.int64()), pa.array(high), pa.array(low)], names=["pos", "high", "low"])


def column_sums(fit: DataFrame, x: str) -> list[int]:
    """Exact sum of every dimension, one row a partition and dimension shuffled."""
    flat.reachable(fit.sparkSession)
    parts = fit.select(x).mapInArrow(_sum_batches, "pos long, high long, low long")
    rows = parts.groupBy("pos").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    return [(int(r.high) << 32) + int(r.low) for r in rows.orderBy("pos").collect()]


def block_rows(n: int, width: int, parallelism: int) -> int:
    """Rows of a block: enough blocks for all cores, none larger than ``BLOCK_VALUES`` values."""
    return max(1, min(BLOCK_VALUES // width, max(LEAST_ROWS, n // (2 * parallelism))))


def indexed(stored: DataFrame, place: str, per_block: int) -> tuple[DataFrame, int]:
    """``stored`` with ``index``, and one more than the largest index.

    ``place`` holds the partition that wrote a row and its number there. Each partition fills blocks of its own, so
    rows are indexed without a sort or a count of all before them; the rest of a block stays zero.
    """
    part, row = F.shiftright(place, 33), F.col(place).bitwiseAND((1 << 33) - 1)
    most = stored.agg(F.max(part).alias("parts"), F.max(row).alias("rows")).first()
    stride = (most.rows or 0) // per_block + 1
    return stored.withColumn("index", part * (stride * per_block) + row), ((most.parts or 0) + 1) * stride * per_block


def block_matrix(rows: DataFrame, values: str, size: int, per_block: int, width: int) -> BlockMatrix:
    """Blocks of the matrix of ``size`` rows with ``values`` (array of doubles) in row ``index``, the others zero."""
    vectors = rows.select("index", array_to_vector(values).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), size, width).toBlockMatrix(per_block, min(width, COLS))


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """Product whose inner dimension is worked through in ``splits`` parts, added up afterwards."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def gram(a: BlockMatrix, splits: int) -> np.ndarray:
    """Transpose times matrix, on the driver: as large as the square of the columns."""
    return times(a.transpose(), a, splits).toLocalMatrix().toArray()


def small_matrix(like: DataFrame, values: np.ndarray) -> BlockMatrix:
    """A matrix of the driver in blocks, to be multiplied from the left by one with ``COLS`` columns a block."""
    height = min(COLS, values.shape[0])
    blocks = [((i, 0), Matrices.dense(len(part), part.shape[1], part.ravel(order="F").tolist()))
              for i, part in enumerate(values[at : at + height] for at in range(0, values.shape[0], height))]
    return BlockMatrix(like.sparkSession.sparkContext.parallelize(blocks, 1), height, values.shape[1], *values.shape)


def rows_of(a: BlockMatrix) -> DataFrame:
    """``index, values`` of a block matrix, kept in the JVM."""
    rows = callMLlibFunc("getIndexedRows", a.toIndexedRowMatrix()._java_matrix_wrapper._java_model).toDF("index", "vector")
    return rows.select("index", vector_to_array("vector").alias("values"))


def whiten(vectors: DataFrame, vector_col: str = "embedding", components: int = 16) -> DataFrame:
    """Rows of ``vectors`` with their place on the leading principal components, each of variance one.

    Entries become whole numbers ``floor(64 * c) + 1000000``; mean, covariance and components are those of the distinct
    whole-number vectors (divisor: their count). Added columns: ``_n`` (that count), ``_deviation`` (sum over the
    dimensions of ``(n * x - sum) ** 2``, exact; null beyond 64 bits), ``_whitened`` and ``_explained`` (arrays by
    component, falling eigenvalue) and ``_identity_error`` (how far the covariance of the whitened distinct vectors is
    from the identity). The sign of a component is that of its largest entry.

    Rows whose vector is null, empty or holds null, non-finite or unrepresentable entries go; of vectors of several
    lengths the most frequent length stays (ties: the longer). Repeated rows stay and count once in the fit; ids are not
    looked at and may be null. Components without variance are left out, so there may be fewer than ``components``,
    and none at all (empty arrays) if all vectors are equal. An empty table gives an empty table. Other columns stay
    as they are, whatever their names. Texts play no part. Memory: one block a task, the square of the
    dimensions on the driver.
    """
    spark, own = vectors.sparkSession, Numbered(vectors)
    rows = own.df.withColumn("_x", quantised(F.col(own.at(vector_col)))).where("_x is not null")
    names = {name: free(f"_{name}", own.names) for name in ("n", "deviation", "whitened", "explained", "identity_error")}
    fit = rows.groupBy("_x").agg(F.count(F.lit(1)).alias("_copies"))
    fit = materialize(fit.withColumn("_place", F.monotonically_increasing_id()), "whitening-fit")
    lengths = fit.groupBy(F.size("_x").alias("width")).agg(F.sum("_copies").alias("rows"), F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("rows"), F.desc("width")).limit(1).collect()
    if not common:
        nothing = rows.limit(0).withColumns({"_deviation": F.lit(None).cast("long"), "_w": F.array().cast("array<double>")})
        return _named(own, nothing, names, 0, [], 0.0)
    width, n = common[0].width, common[0].n
    fit = fit.where(F.size("_x") == width)
    per_block = block_rows(n, width, spark.sparkContext.defaultParallelism)
    fit, size = indexed(fit, "_place", per_block)
    sums = column_sums(fit, "_x")
    # With sum = n * whole + rest, n * x - sum is n * (x - whole) - rest, and x - sum / n is (x - whole) - rest / n.
    means = F.array(*[F.struct(F.lit(s // n).cast("long").alias("whole"), F.lit(s % n).cast("long").alias("rest")) for s in sums])
    gap = F.zip_with("_x", means, lambda x, m: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), x - m["whole"]), m["rest"]))
    centred = fit.select(
        "index", *_keys("_x"),
        F.aggregate(gap, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d))).alias("_deviation"),
        F.zip_with("_x", means, lambda x, m: (x - m["whole"]).cast("double") - m["rest"] / F.lit(float(n))).alias("_centred"))
    matrix = block_matrix(centred, "_centred", size, per_block, width)
    splits = min(-(-n // per_block), spark.sparkContext.defaultParallelism)
    covariance = gram(matrix, splits) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > max(values[0], 0) * FLAT).sum()))
    if not k:
        placed = centred.select("_key", "_key2", "_deviation", F.array().cast("array<double>").alias("_w"))
        return _named(own, _placed(rows, placed), names, n, [], 0.0)
    axes = axes[:, :k] * np.sign(axes[np.abs(axes[:, :k]).argmax(axis=0), np.arange(k)])
    whitened = times(matrix, small_matrix(vectors, axes / np.sqrt(values[:k])))
    error = float(np.abs(gram(whitened, splits) / n - np.eye(k)).max())
    placed = centred.select("index", "_key", "_key2", "_deviation").join(rows_of(whitened).withColumnRenamed("values", "_w"), "index")
    return _named(own, _placed(rows, placed), names, n, [float(v / values.sum()) for v in values[:k]], error)


def _keys(x: str) -> list[Column]:
    """128 bits that stand for a vector where rows are joined."""
    return [F.xxhash64(x).alias("_key"), F.xxhash64(F.lit(SCALE), x).alias("_key2")]


def _placed(rows: DataFrame, placed: DataFrame) -> DataFrame:
    return rows.select("*", *_keys("_x")).drop("_x").join(placed, ["_key", "_key2"])


def _named(own: Numbered, rows: DataFrame, names: dict[str, str], n: int, explained: list[float], error: float) -> DataFrame:
    shares = F.array(*[F.lit(v) for v in explained]).cast("array<double>")
    new = {"n": F.lit(n).cast("long"), "deviation": F.col("_deviation"), "whitened": F.col("_w"), "explained": shares, "identity_error": F.lit(error)}
    return own.back(rows, **{names[k]: c for k, c in new.items()})
