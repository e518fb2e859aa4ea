"""Embedding whitening with distributed block matrices.

Centred rows get consecutive indices and become a ``BlockMatrix`` of row blocks. Its
transpose times itself is the scatter, whose eigenvectors are found on the driver; the
rows times the whitening matrix are the projections. The middle dimension of the scatter
is dealt out over tasks, so no task sees more than a share of the row blocks; the driver
sees sums per dimension, square matrices of the dimension, and block coordinates.

Centring is exact: rows are long integers, and n x - S is taken before the one division.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billweave.llm.mixing import _block_starts
from billweave.staging import staged

COMPONENTS = 32
#: Rows of a block of the matrices.
BLOCK_ROWS = 2048
#: Fixed values of the integer form: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest are rounding, not variance.
_NOISE = 1e-12


def integer_rows(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x array of long, part, place) of the rows whose vector is whole.

    Vectors that are NULL or hold NULL, NaN or infinite entries are left out, and so are
    those shorter or longer than most are (ties: than the longer kind); empty ones, too.
    ``part`` and ``place`` say where a row stands in the table as it is read.
    """
    entries = F.col(vector)
    number = F.monotonically_increasing_id()
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    whole = embeddings.where(entries.isNotNull() & (F.size(entries) > 0) & F.forall(entries, finite))
    x = F.transform(entries, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = staged(
        whole.select(
            "vec_id", x.alias("x"), F.shiftright(number, 33).alias("part"),
            number.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        ),
        "whitening-rows",
    )
    length = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head(1)
    if not length:
        return rows
    if rows.where(F.size("x") != length[0]["size"]).isEmpty():
        return rows
    kept = rows.where(F.size("x") == length[0]["size"])
    return staged(kept, "whitening-rows")


def _indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with consecutive ``index`` from 0, numbered by running totals over parts."""
    places = F.row_number().over(Window.partitionBy("part").orderBy("place"))
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    starts = _block_starts(counts, [], "part", "rows").drop("rows")
    return rows.join(starts, "part").withColumn("index", F.col("start") + places - 1).drop("start")


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def block_matrix(rows: DataFrame, index: str, vector: Column, n_rows: int, n_cols: int) -> BlockMatrix:
    """Rows (index, array of double) as a matrix of row blocks, each as wide as the rows."""
    vectors = rows.select(F.col(index).cast("long").alias("index"), array_to_vector(vector).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n_rows, n_cols)
    return matrix.toBlockMatrix(BLOCK_ROWS, n_cols)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times itself, on the driver.

    The product is a single block. Spark would send all row blocks to the task of that
    block; dealt out over splits of the middle dimension, each task multiplies the row
    blocks of its split, and only square blocks are added up.
    """
    splits = -(-matrix.numRows() // matrix.rowsPerBlock)
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper
    product = left.call("multiply", right._java_model, int(splits))
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _rows_of(matrix: BlockMatrix, spark: SparkSession, name: str) -> DataFrame:
    """(index, name array of double) of a matrix."""

    def plain(rows: Iterator) -> Iterator[tuple[int, list[float]]]:
        for row in rows:
            yield int(row.index), row.vector.toArray().tolist()

    found = matrix.toIndexedRowMatrix().rows.mapPartitions(plain)
    return spark.createDataFrame(found, f"index long, {name} array<double>")


def whitened(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """One row per whole vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions (an error beyond the
    range of a long). Components are numbered from 1 by falling variance; there are at most
    as many as dimensions. A component without variance, which rounding cannot tell from
    none, has ``whitened`` NULL and ``explained`` 0, and does not count in
    ``identity_error``; a single vector, or equal ones, has only such. Rows that repeat,
    also their ids, are rows of their own; NULL ids stay. Without whole vectors there are no
    rows. Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = integer_rows(embeddings, vector)
    first = rows.select(F.size("x").alias("size")).head(1)
    kind = dict(embeddings.dtypes)["vec_id"]
    if not first:
        return spark.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    size = first[0]["size"]
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(size)]).first()
    n = sums["n"]
    totals = _numbers([sums[f"s{i}"] for i in range(size)])
    apart = F.zip_with("x", totals, lambda x, s: x * n - s)
    squares = F.aggregate(apart, F.lit(0).cast("decimal(38,0)"), lambda a, d: (a + d.cast("decimal(19,0)") * d).cast("decimal(38,0)"))
    centred = staged(
        _indexed(rows).select(
            "index", "vec_id", squares.cast("long").alias("deviation"),
            F.transform(apart, lambda d: d.cast("double") / n).alias("c"),
        ),
        "whitening-centred",
    )
    matrix = block_matrix(centred, "index", F.col("c"), n, size)
    covariance = scatter(matrix) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    kept = min(components, size)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    alive = int(np.count_nonzero(values[:kept] > _NOISE * max(values[0], 0)))
    result = centred.select("vec_id", "deviation", "index")
    error = 0.0
    if alive:
        whitening = vectors[:, :alive] / np.sqrt(values[:alive])
        block = ((0, 0), Matrices.dense(size, alive, whitening.ravel(order="F").tolist()))
        projector = BlockMatrix(spark.sparkContext.parallelize([block], 1), size, alive, size, alive)
        projected = staged(_rows_of(matrix.multiply(projector), spark, "w"), "whitening-projected")
        again = block_matrix(_recentred(projected, n, alive), "index", F.col("w"), n, alive)
        error = float(np.abs(scatter(again) / n - np.eye(alive)).max())
        result = result.join(projected, "index")
    else:
        result = result.withColumn("w", F.array().cast("array<double>"))
    shares = F.array(*[F.lit(float(v / trace) if i < alive else 0.0) for i, v in enumerate(values[:kept])])
    numbers = F.sequence(F.lit(1), F.lit(kept))
    return result.select("vec_id", "deviation", "w", F.explode(numbers).alias("component")).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation",
        F.get("w", F.col("component") - 1).alias("whitened"),
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _recentred(projected: DataFrame, n: int, size: int) -> DataFrame:
    """The projections less their means, which are zero but for rounding."""
    sums = projected.agg(*[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(size)]).first()
    means = F.array(*[F.lit(float(sums[f"s{i}"]) / n) for i in range(size)])
    return projected.select("index", F.zip_with("w", means, lambda w, m: w - m).alias("w"))
