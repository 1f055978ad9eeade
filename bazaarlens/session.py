"""Session settings, shared scratch storage and the size check behind every broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The last duplicate of a JSON key wins, as in the catalog filter's JSON reader.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles a method beyond 8000 bytes; Spark then better generates smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# A lookup side is broadcast only when it was counted and stays under both limits.
MAX_LOOKUP_ROWS = 1_000_000
MAX_LOOKUP_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, name: str = "bazaarlens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach, below ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = os.path.join(tempfile.gettempdir(), "bazaarlens")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back, so that it is not recomputed."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = MAX_LOOKUP_ROWS, max_bytes: int = MAX_LOOKUP_BYTES) -> bool:
    """Count ``df`` up to ``max_rows`` and measure its texts and nested values; one small aggregate comes back."""
    size = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column)
        elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
            continue
        size = size + F.coalesce(F.octet_length(column), F.lit(0))
    row = (
        df.limit(max_rows + 1)
        .agg(F.count("*").alias("n"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("b"))
        .first()
    )
    return row["n"] <= max_rows and row["b"] <= max_bytes


def lookup_join(
    left: DataFrame, lookup: DataFrame, on: list[str], how: str, max_rows: int = MAX_LOOKUP_ROWS
) -> DataFrame:
    """Join against a lookup: broadcast if it was measured small, else a shuffle join.

    In the shuffle join adaptive execution splits a hot key of the left side.
    """
    if is_small(lookup.select(*on) if how in ("left_semi", "left_anti") else lookup, max_rows):
        lookup = F.broadcast(lookup)
    return left.join(lookup, on, how)
