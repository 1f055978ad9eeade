"""Search counts that are kept, not recounted: a refresh of the popular list reads new requests only.

Every micro-batch of requests leaves its counts per day and term in a folder of its own, replaced if the
batch is replayed. A late request adds to its day whenever it comes. ``fold`` merges the batches so far
into one table, a new version that says up to which batch it counts; batches after it are added when read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import day_of
from ..operators import popularity
from ..sinks import versions
from ..sinks.files import publish, write_batch, write_popular
from . import jobs

DAY, COUNTS = "day", popularity.term_schema("day")
_BATCH, _THROUGH = "batch_id", "through"


def _batches(base: str) -> str:
    return f"{base.rstrip('/')}/counts"


def _versions(base: str) -> str:
    return f"{base.rstrip('/')}/folded"


def count_new(stream: DataFrame, base: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Count the requests (``schemas.REQUEST``) that the stream has not brought before."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Copies of a term are reduced before the shuffle, so a busy term is no busy task.
        write_batch(popularity.term_counts(batch.withColumn(DAY, day_of("timestamp")), DAY), _batches(base), batch_id)

    return jobs.start(stream, handle, checkpoint, once, jobs.REFRESH)


def _with_number(spark: SparkSession, paths: list[str], name: str, **options: str) -> DataFrame:
    schema = T.StructType([*COUNTS.fields, T.StructField(name, T.LongType())])
    return spark.read.schema(schema).options(**options).parquet(*paths)


def _folded(spark: SparkSession, path: str | None) -> tuple[DataFrame, int]:
    """A merged table and the last batch it counts; -1 and no rows before the first one."""
    if path is None:
        return spark.createDataFrame([], COUNTS), -1
    rows = _with_number(spark, [path], _THROUGH)
    # The row without a count only says how far the table counts.
    return rows.filter("search_count is not null").select(*COUNTS.names), rows.agg(F.max(_THROUGH)).first()[0]


def _parts(spark: SparkSession, base: str) -> tuple[DataFrame, int]:
    """Counts to be added up, and the last batch among them. Half-written batches are not read: they will be replayed."""
    counts, through = _folded(spark, versions.current(spark, _versions(base)))
    batches = {int(name): path for name, (path, _) in versions.folders(spark, _batches(base), f"{_BATCH}=").items()}
    new = [batches[number] for number in sorted(batches) if number > through]
    if not new:
        return counts, through
    rows = _with_number(spark, new, _BATCH, basePath=_batches(base))
    return counts.unionByName(rows.select(*COUNTS.names)), max(batches)


def daily(spark: SparkSession, base: str) -> DataFrame:
    """Searches per day and term; a request without a readable day has a null day."""
    return popularity.merged(_parts(spark, base)[0], DAY)


def totals(spark: SparkSession, base: str, since: str | None = None) -> DataFrame:
    """Searches per term, of the days from ``since`` on if it is given."""
    parts, _ = _parts(spark, base)
    return popularity.merged(parts if since is None else parts.filter(F.col(DAY) >= F.lit(since).cast("date")))


def fold(spark: SparkSession, base: str) -> None:
    """Merge all batches so far; readers see the merged table when it is complete.

    Batches that the table before had merged already are deleted.
    """
    _, before = _folded(spark, versions.current(spark, _versions(base)))
    parts, last = _parts(spark, base)
    mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in COUNTS.fields])
    rows = popularity.merged(parts, DAY).unionByName(mark)
    publish(rows.withColumn(_THROUGH, F.lit(last).cast("long")), _versions(base), "parquet")
    for number, (path, _) in versions.folders(spark, _batches(base), f"{_BATCH}=").items():
        if int(number) <= before:
            versions.delete(spark, path)


def refresh(spark: SparkSession, stream: DataFrame, base: str, checkpoint: str, n: int | None = popularity.TOP_N) -> None:
    """Count what is new and publish the popular list of all requests."""
    count_new(stream, base, checkpoint).awaitTermination()
    write_popular(popularity.ranked(totals(spark, base), n), base)
