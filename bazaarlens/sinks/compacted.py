"""Upkeep of the request archive: many small files become few, bucketed and sorted, one row per archive file name.

A compacted archive is a folder of versions, each the files of a bucketed table. Rows are in buckets of the
record's id and second, so that new writes meet the archive bucket by bucket: merging shuffles the new writes
only, never the archive. The number of buckets is part of a version's name and grows with the rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from . import versions

# Rows of a bucket that a version is laid out for; a bucket with four times as many splits.
BUCKET_ROWS = 2_000_000
_GROWTH = 4
# Readers of a whole archive may take this long; the version they read stays as long.
KEPT_HOURS = 24
_NOTE = re.compile(r"-b(\d+)$")


def _table(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The files of a version as a bucketed table of this session."""
    name, buckets = f"archive_{uuid.uuid4().hex}", _NOTE.search(path).group(1)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    listed = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({listed}) sorted by ({listed}) "
        f"into {buckets} buckets location '{path}'"
    )
    found = spark.table(name)
    spark.sql(f"drop table {name}")  # the plan knows the files and their buckets by now
    return found


def read(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """The archive's current version; None before the first one."""
    current = versions.current(spark, path)
    return None if current is None else _table(spark, current, keys)


def reduced(records: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last record per key in ``order``, and how many there were as ``writes``; copies meet before the shuffle."""
    rest = [c for c in records.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("_row")
    kept = records.groupBy(*keys).agg(newest, F.count("*").alias("writes"))
    return kept.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order + rest], "writes")


def merged(archive: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Two reduced tables as one: per key the later record, writes added up.

    With two tables in the same buckets nothing is shuffled.
    """
    columns = archive.columns
    rows = lambda df, name: df.select(*keys, F.struct(*columns).alias(name))
    both = rows(archive, "_old").join(rows(new.select(*columns), "_new"), keys, "full_outer")
    of = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order])
    newer = F.col("_old").isNull() | (F.col("_new").isNotNull() & (of("_new") >= of("_old")))
    writes = F.coalesce(F.col("_old.writes"), F.lit(0)) + F.coalesce(F.col("_new.writes"), F.lit(0))
    picked = [F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in columns if c not in (*keys, "writes")]
    return both.select(*keys, *picked, writes.alias("writes"))


def _write(rows: DataFrame, path: str, keys: list[str], buckets: int) -> str:
    spark = rows.sparkSession
    folder, name = versions.next_path(spark, path, f"-b{buckets}"), f"archive_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).format("parquet").saveAsTable(name)
    spark.sql(f"drop table {name}")  # the files stay: the table is external
    return folder


def add(records: DataFrame, path: str, keys: list[str], order: list[str], bucket_rows: int = BUCKET_ROWS) -> None:
    """Merge records, such as all small files since the last time, into the archive at ``path``.

    ``order`` tells which of several records of a key is the last one; equal ones are told apart by the other
    columns. Keys must not be null. The version before stays until it is old.
    """
    spark = records.sparkSession
    new = written(reduced(records, keys, order), "archive")
    current = versions.current(spark, path)
    if current is None:
        rows, count, buckets = new, new.count(), 0
    else:
        archive, buckets = _table(spark, current, keys), int(_NOTE.search(current).group(1))
        rows, count = merged(archive, new.repartition(buckets, *keys), keys, order), archive.count()
    if not buckets or count > _GROWTH * bucket_rows * buckets:
        buckets = max(1, -(-count // bucket_rows))
        rows = rows.repartition(buckets, *keys)
    _write(rows, path, keys, buckets)
    versions.tidy(spark, path, hours=KEPT_HOURS)
