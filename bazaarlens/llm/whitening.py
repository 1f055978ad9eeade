"""Embedding whitening with MLlib's BlockMatrix.

Vectors become whole numbers, ``floor(64 * c) + 1000000``, so that sums and means are exact. Rows are numbered
and the centred rows stand in blocks of ``BLOCK_ROWS`` rows. The scatter is the sum of the blocks' transposes
times the blocks; its eigenvectors are found on the driver (dimension by dimension, the only thing collected),
and a second BlockMatrix multiplication by the whitening matrix projects all rows.

BlockMatrix gathers a product by cells of its result. For the scatter, which is one cell, the inner dimension
is split, so that each task multiplies a few blocks and passes one small matrix on. For the projection the
result's grid decides the tasks, and MLlib lays a grid by the square root of the partitions: the other factor
comes in as many (mostly empty) partitions as spread the rows over enough tasks. Rows are worked on in bands
of ``BAND_BLOCKS`` blocks, so that lists of blocks on the driver and blocks in a task stay bounded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import numbered
from ..session import shared_dir, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_ROWS = 1024
# Blocks of a band, and those one task multiplies.
BAND_BLOCKS, TASK_BLOCKS = 256, 8
# Eigenvalues below this part of the largest are zero: such a component has no spread to divide by.
_NO_SPREAD = 1e-12
_MATRIX = MatrixUDT.sqlType()
_BLOCK = T.StructType(
    [
        T.StructField("place", T.StructType([T.StructField("row", T.LongType()), T.StructField("col", T.LongType())])),
        T.StructField("matrix", _MATRIX),
    ]
)


def whole_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``: rows whose vector is null or has null or non-finite entries go.

    All vectors must have one length to have a covariance: the most frequent one (of equally frequent ones the
    longest). Vectors of other lengths go too, and empty vectors have no components.
    """
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)))
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    rows = rows.select("vec_id", x.alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == (common["d"] if common else 0))


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows, and the exact sum of every dimension: one small row each."""
    found = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    found = found.orderBy("i").collect()
    return (found[0]["n"] if found else 0), [r["s"] for r in found]


def _as_matrix(rows: Column, height: Column, width: int) -> Column:
    """An array of row arrays as MLlib stores a dense matrix by rows."""
    none = F.lit(None).cast("array<int>")
    values = {
        "type": F.lit(1).cast("tinyint"),
        "numRows": height.cast("int"),
        "numCols": F.lit(width),
        "colPtrs": none,
        "rowIndices": none,
        "values": F.flatten(rows),
        "isTransposed": F.lit(True),
    }
    return F.struct(*[values[f.name].alias(f.name) for f in _MATRIX.fields])


def _matrix(blocks: DataFrame, block_rows: int, height: int, width: int) -> BlockMatrix:
    """A BlockMatrix of written blocks; MLlib reads the matrix column as its own type."""
    own = T.StructType([_BLOCK["place"], T.StructField("matrix", MatrixUDT())])
    path = shared_dir(blocks.sparkSession, "blocks")
    blocks.write.parquet(path)
    typed = blocks.sparkSession.read.schema(own).parquet(path)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", typed, block_rows, width, height, width), block_rows, width)


def _blocks_of(matrix: BlockMatrix) -> DataFrame:
    """The blocks as plain columns: ``block``, ``height`` and ``rows``, an array of row arrays."""
    found = callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model).toDF("place", "matrix")
    found = found.withColumn("place", F.col("place").cast(_BLOCK["place"].dataType))  # by position
    path = shared_dir(found.sparkSession, "product")
    found.write.parquet(path)
    m = F.col("matrix")
    across = F.when(m["isTransposed"], m["numCols"]).otherwise(1)
    down = F.when(m["isTransposed"], 1).otherwise(m["numRows"])
    to = F.sequence(F.lit(0), m["numCols"] - 1)
    rows = F.transform(F.sequence(F.lit(0), m["numRows"] - 1), lambda r: F.transform(to, lambda c: F.get(m["values"], r * across + c * down)))
    plain = found.sparkSession.read.schema(_BLOCK).parquet(path)
    return plain.select(F.col("place.row").alias("block"), rows.alias("rows"))


def _scatter(matrix: BlockMatrix, blocks: int) -> np.ndarray:
    """Transpose times matrix, summed over blocks of rows."""
    splits = max(1, -(-blocks // TASK_BLOCKS))
    turned = matrix.transpose()._java_matrix_wrapper
    product = turned.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _projected(matrix: BlockMatrix, factor: np.ndarray, blocks: int) -> BlockMatrix:
    height, width = factor.shape
    local = DenseMatrix(height, width, factor.reshape(-1, order="F").tolist())
    spark = SparkSession.getActiveSession()
    parts = max(1, -(-blocks // TASK_BLOCKS)) ** 2
    right = spark.sparkContext.parallelize([((0, 0), local)], 1).toDF(["place", "matrix"]).repartition(parts)
    return matrix.multiply(BlockMatrix(callMLlibFunc("createBlockMatrix", right, height, width, height, width), height, width))


def _band(rows: DataFrame, low: int, high: int, vector: Column, width: int, block_rows: int) -> Band:
    within = rows.filter((F.col("at") >= low) & (F.col("at") < high))
    block = F.expr(f"(at - {low}) div {block_rows}").alias("block")
    listed = F.sort_array(F.collect_list(F.struct("at", vector.alias("v"))))  # block_rows at most
    grouped = within.groupBy(block).agg(listed.alias("own"))
    values = F.transform("own", lambda r: r["v"])
    place = F.struct(F.col("block").alias("row"), F.lit(0).cast("long").alias("col"))
    blocks = grouped.select(place.alias("place"), _as_matrix(values, F.size("own"), width).alias("matrix"))
    return Band(low, _matrix(blocks, block_rows, high - low, width), -(-(high - low) // block_rows))


@dataclass
class Whitening:
    """What was fitted: whole-number sums over ``n`` rows, the whitening matrix and each component's share."""

    n: int
    sums: list[int]
    factor: np.ndarray  # dimensions x components
    explained: list[float]

    @property
    def live(self) -> list[bool]:
        """Components with a spread; the others whiten to zero."""
        return [bool(np.any(self.factor[:, i])) for i in range(self.factor.shape[1])]


def _centred(fit_n: int, sums: list[int]) -> tuple[Column, Column]:
    """``n * x - S`` exactly, and the same over ``n``."""
    literal = F.array(*[F.lit(s).cast("long") for s in sums])
    exact = F.zip_with("x", literal, lambda x, s: x * fit_n - s)
    return exact, F.transform(exact, lambda v: v.cast("double") / float(fit_n))


@dataclass
class Band:
    """Consecutive rows, from number ``first`` on, as a distributed matrix of ``blocks`` blocks."""

    first: int
    matrix: BlockMatrix
    blocks: int


def bands_of(rows: DataFrame, count: int, vector: Column, width: int, block_rows: int = BLOCK_ROWS) -> list[Band]:
    """``rows`` (``at`` = 0, 1, ..) in bands, each written once."""
    step = BAND_BLOCKS * block_rows
    return [_band(rows, at, min(at + step, count), vector, width, block_rows) for at in range(0, count, step)]


def scatter(bands: list[Band], width: int) -> np.ndarray:
    return sum((_scatter(b.matrix, b.blocks) for b in bands), np.zeros((width, width)))


def fit(bands: list[Band], n: int, sums: list[int], components: int) -> Whitening:
    """Eigenvectors of the centred rows' covariance, by falling eigenvalue."""
    width = len(sums)
    total = scatter(bands, width)
    values, vectors = np.linalg.eigh((total + total.T) / (2 * n))
    order = np.argsort(-values, kind="stable")[: min(components, width)]
    trace = float(values.sum())
    spread = np.where(values[order] > _NO_SPREAD * max(values.max(), 0), values[order], 0.0)
    factor = np.where(spread > 0, vectors[:, order] / np.sqrt(np.where(spread > 0, spread, 1.0)), 0.0)
    return Whitening(n, sums, factor, [float(v / trace) if trace > 0 else 0.0 for v in spread])


def project(bands: list[Band], fitted: Whitening) -> DataFrame:
    """``at`` and ``whitened`` (one value per component) of every row."""
    parts = []
    for band in bands:
        found = _blocks_of(_projected(band.matrix, fitted.factor, band.blocks))
        found = found.select("block", F.posexplode("rows").alias("i", "whitened"))
        at = F.col("block") * band.matrix.rowsPerBlock + F.col("i") + band.first
        parts.append(found.select(at.alias("at"), "whitened"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def identity_error(projected: DataFrame, fitted: Whitening, block_rows: int = BLOCK_ROWS) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over components with a spread."""
    width = fitted.factor.shape[1]
    means = projected.select(F.posexplode("whitened").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m")).orderBy("i").collect()
    literal = F.array(*[F.lit(float(r["m"])) for r in means])
    centred = F.zip_with("whitened", literal, lambda v, m: v - m)
    total = scatter(bands_of(projected, fitted.n, centred, width, block_rows), width)
    live = np.array(fitted.live, dtype=float)
    return float(np.abs(total / fitted.n - np.diag(live)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per remaining vector and component, numbered from 1 by falling eigenvalue.

    Columns: ``vec_id``, ``component``, ``n``, ``deviation`` (null beyond a long), ``whitened``, ``explained``,
    ``identity_error``. There are as many components as dimensions at most. A component without spread, as of
    equal vectors, whitens to zero, explains nothing and does not count in ``identity_error``. Repeated rows
    and null ids are rows. A table without a remaining vector gives no rows.
    """
    x = written(whole_vectors(embeddings), "vectors")
    rows = written(numbered(x, [F.asc("vec_id"), F.asc("x")], "at").withColumn("at", F.col("at") - 1), "numbered")
    n, sums = _sums(rows)
    if not n:
        return embeddings.sparkSession.createDataFrame([], _OUT)
    exact, centred = _centred(n, sums)
    bands = bands_of(rows, n, centred, len(sums), block_rows)
    fitted = fit(bands, n, sums, components)
    projected = written(project(bands, fitted), "whitened")
    error = identity_error(projected, fitted, block_rows)
    squares = F.aggregate(
        exact,
        F.lit(0).cast("decimal(38,0)"),
        lambda a, v: (a + (v.cast("decimal(19,0)") * v.cast("decimal(19,0)")).cast("decimal(38,0)")).cast("decimal(38,0)"),
    )
    listed = rows.select("at", "vec_id", squares.try_cast("long").alias("deviation")).join(projected, "at")
    explained = F.array(*[F.lit(e) for e in fitted.explained])
    return listed.select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id",
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("i")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
