"""Shared helpers: reading tables, mapping Arrow batches, words of a text."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows and bytes of an Arrow batch. Texts may be long, so batches are far below Spark's defaults.
BATCH_ROWS = 500
BATCH_BYTES = 16 * 1024 * 1024
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_REST = "_row"


def sealed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all columns but the text in one, so that no name of theirs meets one of an operator."""
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias(_REST))


def opened(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``sealed(docs)`` with the columns of ``docs`` again; the text is that of ``rows``."""
    return rows.select(*[F.col("text") if c == "text" else F.col(_REST).getField(c).alias(c) for c in docs.columns])


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: they may not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def arrow_map(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, rows: int = BATCH_ROWS
) -> DataFrame:
    """``mapInArrow`` over small batches; ``schema`` is DDL or a StructType.

    The sizes hold for what runs next: with more ``rows`` (of numbers, not texts) the result is to be written before
    the next call.
    """
    ship_code(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 texts of a batch; null is the empty text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [value or b"" for value in values.to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: ``bytes.split`` parts at exactly these characters."""
    return text.split()
