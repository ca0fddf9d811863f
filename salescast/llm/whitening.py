"""Embedding whitening on MLlib's BlockMatrix.

The distinct code vectors are the fit list. Their centred rows get consecutive numbers and are cut into row blocks of a
BlockMatrix Y; Y'Y, multiplied over many splits of the row blocks and added up, is the scatter matrix. Its d x d entries go
to the driver, whose eigh gives the components; a second BlockMatrix product takes the centred rows of the whole table to
the whitened ones, and a third one, over the fit list, measures how far their covariance is from the identity. Rows never
leave the executors; the driver holds d sums and matrices of d x d.

Cases: a vector that is null, empty or holds null or non-finite entries is dropped; vectors of another length than the most
common one (ties: the longest) have no place in the matrix and are dropped; repeated rows and rows without an id are
projected each; components whose eigenvalue is not above rounding (1e-11 of the largest) can't be scaled to one and are left
out, so that a table of one distinct vector gives no rows; an empty table gives no rows. `deviation` is exact in 64 bits;
beyond them (a long fit list of long vectors) the job fails with an overflow instead of wrapping round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm.common import finite, stage

SCALE, COMPONENTS = 256, 4
#: Bytes of a block, and the share of the largest eigenvalue below which a component counts as rounding.
BLOCK_BYTES, LEAST_SHARE = 4 << 20, 1e-11


def rows_a_block(dim: int) -> int:
    return max(16, BLOCK_BYTES // (8 * dim))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df as a staged table with the column i: 0, 1, 2 ... over all rows."""
    staged = stage(df.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    counts = sorted(tuple(r) for r in staged.groupBy(part.alias("part")).count().collect())  # a row for each written part
    before = np.concatenate(([0], np.cumsum([n for _, n in counts])))[:-1].tolist() if counts else []
    offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before, strict=True)], "part long, before long")
    i = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return staged.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("i", i).drop("part", "at", "before")


def blocks(rows: DataFrame, n: int, dim: int) -> BlockMatrix:
    """rows(i, y array<double>) as a matrix of n x dim, in row blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("i", array_to_vector("y").alias("y")), "y")
    return IndexedRowMatrix(vectors, n, dim).toBlockMatrix(rows_a_block(dim), dim)


def squared(m: BlockMatrix) -> np.ndarray:
    """m'm, a local matrix. The row blocks are multiplied in many splits, whose products are then added."""
    splits = max(1, min(m.numRowBlocks, 4 * SparkSession.active().sparkContext.defaultParallelism))
    product = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def times(m: BlockMatrix, local: np.ndarray) -> BlockMatrix:
    """m times a local matrix of few columns."""
    rows = SparkSession.active().createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(local)], "i long, y array<double>")
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("i", array_to_vector("y").alias("y")), "y")
    return m.multiply(IndexedRowMatrix(vectors, *local.shape).toBlockMatrix(*local.shape))


def rows_of(m: BlockMatrix) -> DataFrame:
    """(i, w array<double>) of the rows of m."""
    rows = callMLlibFunc("getIndexedRows", m.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").cast("long").alias("i"), vector_to_array("vector").alias("w"))


@dataclass
class Whitening:
    """Sums of the fit list and the whitening matrix: dim x components, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    matrix: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: Column) -> Column:
        mean = F.array(*[F.lit(s / self.n) for s in self.sums])
        return F.zip_with(x, mean, lambda a, m: a.cast("double") - m)


def fit(codes: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """codes(x array<long>), one row for each vector of the fit list -> its whitening; None without rows."""
    rows = numbered(codes.select("x"), "whitening-fit")
    n = rows.count()
    if not n:
        return None
    sums = [int(r["s"]) for r in rows.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("s")).orderBy("k").collect()]  # a row for each dimension
    out = Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, 0.0)
    y = blocks(rows.select("i", out.centred(F.col("x")).alias("y")), n, len(sums))
    covariance = squared(y) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [k for k in range(min(components, len(values))) if values[k] > LEAST_SHARE * max(values[0], 0.0)]
    out.values, out.trace = values[keep], float(np.trace(covariance))
    out.matrix = vectors[:, keep] / np.sqrt(out.values)
    if keep:
        out.identity_error = float(np.abs(squared(times(y, out.matrix)) / n - np.eye(len(keep))).max())
    return out


def transform(rows: DataFrame, w: Whitening) -> DataFrame:
    """rows(i, x, ...) numbered without gaps -> with the column w, the whitened vector."""
    y = blocks(rows.select("i", w.centred(F.col("x")).alias("y")), rows.count(), len(w.sums))
    return rows.join(rows_of(times(y, w.matrix)), "i")


def whitening_query(embeddings: DataFrame) -> DataFrame:
    """The contract's rows: one for each kept row and component."""
    x = F.transform("embedding", lambda c: F.floor(SCALE * c.cast("double")).cast("long"))
    rows = embeddings.where(finite("embedding")).where(F.size("embedding") > 0).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = stage(rows, "whitening-codes")
    empty = rows.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return empty
    rows = numbered(rows.where(F.size("x") == lengths["d"]), "whitening-rows")
    w = fit(rows.select("x").distinct())
    if not len(w.values):
        return empty
    sums = F.array(*[F.lit(s).cast("long") for s in w.sums])
    gap = F.zip_with("x", sums, lambda a, s: (F.lit(w.n).cast("long") * a - s) * (F.lit(w.n).cast("long") * a - s))
    deviation = F.aggregate(gap, F.lit(0).cast("long"), lambda a, b: a + b)
    done = transform(rows.withColumn("deviation", deviation), w)
    share = F.array(*[F.lit(float(v) / w.trace) for v in w.values])
    return done.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("k") + 1).alias("explained"), F.lit(w.identity_error).alias("identity_error"))
