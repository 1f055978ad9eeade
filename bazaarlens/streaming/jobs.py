"""Continuous jobs.

Each job hands its micro-batches to the same transforms the batch jobs use. Lookups (allow-list,
popular list) are read anew for every batch, and every batch writes a folder of its own, replaced
if the batch is replayed: with the checkpoint's offsets that is exactly-once. Nothing here depends
on the source: a broker, a topic log or files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .. import schemas
from ..functions.text import day_of, rfc3339
from ..operators import catalog, popularity, recommend, requests, topics
from ..sinks.files import json_as_line, write_batch, write_popular
from ..sinks.topics import as_messages, log_writer, write_log
from ..sources import topic_log
from ..sources.files import read_popular, read_requests
from ..sources.topics import committed, read_log

# How long a consumer batch gathers, and how often popularity is refreshed.
TRIGGER = "1 second"
REFRESH = "6 hours"
# The topics of requests and of recommendations.
REQUESTS, RECOMMENDATIONS = "requests", "recommendations"
# The trigger for sources that gather a micro-batch themselves: the next one begins when one is done.
GATHERED = "0 seconds"
# How often a batch that fails is tried before it is set aside.
TRIES = 3
# The folder of archived requests whose timestamp is no date.
UNKNOWN_DAY = "unknown"


def run(writer: DataStreamWriter, checkpoint: str, once: bool, every: str = TRIGGER) -> StreamingQuery:
    """Start a writer; ``once`` works off what is there and ends."""
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool, every: str = TRIGGER
) -> StreamingQuery:
    """Run ``handle`` per micro-batch."""
    return run(stream.writeStream.foreachBatch(handle), checkpoint, once, every)


def drain(query: StreamingQuery) -> None:
    """Work off what a topic log has, then end. A query that starts anew spends its first trigger on finding its place."""
    try:
        query.processAllAvailable()
        query.processAllAvailable()
    finally:
        query.stop()


def set_aside(
    handle: Callable[[DataFrame, int], None], aside: str, tries: int = TRIES
) -> Callable[[DataFrame, int], None]:
    """``handle``, but a batch that fails ``tries`` times goes to ``aside`` with the error, and the stream goes on.

    A batch must be safe to handle again, as all sinks here are.
    """

    def handled(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, tries + 1):
            try:
                return handle(batch, batch_id)
            except Exception as error:
                if attempt == tries:
                    write_batch(batch.withColumn("error", F.lit(str(error)[:1000])), aside, batch_id)

    return handled


def filter_products(
    stream: DataFrame, load_list: Callable[[SparkSession], DataFrame], out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Products whose id is allowed, as ``{k=v, ..}`` lines below ``out``.

    ``stream`` has ``value``, a product as JSON. ``load_list`` reads the list, for each batch anew.
    Records the filter fails open on are written as they came.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        records = batch.select(F.col("value").cast("string").alias("value"))
        passed = catalog.filtered(records, load_list(batch.sparkSession))
        lines = passed.filter("value is not null").select(json_as_line(F.col("value")).alias("value"))
        write_batch(lines, out, batch_id, "text")

    return start(stream, handle, checkpoint, once)


def recommend_requests(
    stream: DataFrame,
    popular_base: str,
    out: str,
    quarantine: str,
    checkpoint: str,
    once: bool = False,
    at: str | None = None,
    write: Callable[[DataFrame, int], None] | None = None,
    every: str = TRIGGER,
) -> StreamingQuery:
    """One recommendation message per request message; what is no request goes to ``quarantine``.

    Messages go below ``out``, or to ``write``, which gets the batch's number too: a batch that fails is
    handled again, and ``sinks.topics.write_log`` takes each number once.

    The stored popular list is read again for each batch. ``at`` names a text column to stamp the
    recommendations with; the time of processing is used without it.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        popular = read_popular(batch.sparkSession, popular_base)
        # Decoded once for both sinks; the messages themselves are read once, too.
        decoded = requests.with_request(batch).persist()
        try:
            good, bad = requests.split(decoded)
            if at:
                found = recommend.recommend(good, popular, at=at)
            else:
                found = recommend.recommend_now(good, popular)
            if write is None:
                write_batch(as_messages(found), out, batch_id)
            else:
                write(as_messages(found), batch_id)
            write_batch(bad, quarantine, batch_id)
        finally:
            decoded.unpersist()

    return start(stream, handle, checkpoint, once, every)


def refresh_popular(
    stream: DataFrame, base: str, checkpoint: str, n: int | None = popularity.TOP_N, once: bool = False
) -> StreamingQuery:
    """Keep the stored popular list up to date from a stream of requests (column product_name)."""

    def handle(counts: DataFrame, batch_id: int) -> None:
        write_popular(popularity.ranked(counts, n), base)

    counts = popularity.term_counts(stream)
    return run(counts.writeStream.foreachBatch(handle).outputMode("complete"), checkpoint, once, REFRESH)


def archive_requests(
    stream: DataFrame, out: str, checkpoint: str, once: bool = False, every: str = TRIGGER
) -> StreamingQuery:
    """Request messages decoded and stored as JSON lines, one folder per day of ``timestamp``."""
    good, _ = requests.split_decoded(stream)
    # A text that is no date names no folder of its own.
    day = F.coalesce(day_of("timestamp").cast("string"), F.lit(UNKNOWN_DAY))
    rows = good.select("product_name", "timestamp", day.alias("dt"))
    writer = rows.writeStream.format("json").partitionBy("dt").option("path", out)
    return run(writer, checkpoint, once, every)


def replicate(stream: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Copy messages of all topics, names unchanged, to a folder per topic."""
    columns = [f.name for f in schemas.MESSAGE.fields if f.name in stream.columns]
    writer = stream.select(*columns).writeStream.format("parquet").partitionBy("topic").option("path", out)
    return run(writer, checkpoint, once)


def replicate_log(stream: DataFrame, log: str, writer: str, checkpoint: str) -> StreamingQuery:
    """Copy messages of all topics to another log: names, partitions, keys and order unchanged."""
    return run(log_writer(stream, log, writer), checkpoint, False, GATHERED)


def emit_requests(searches: DataFrame, topic: str = REQUESTS) -> DataFrame:
    """Search events (product_name, ts) as messages of the request topic."""
    return requests.request_envelope(searches).select("value", F.lit(topic).alias("topic"))


def publish_request(spark: SparkSession, name: str, log: str) -> None:
    """Send one search to the request topic."""
    search = spark.range(1).select(F.lit(name).alias("product_name"), F.current_timestamp().alias("ts"))
    write_log(emit_requests(search), log)


def next_recommendation(spark: SparkSession, log: str, group: str) -> DataFrame:
    """The next recommendation that ``group`` has not taken yet, if any; it is taken with this."""
    messages = read_log(spark, log, [RECOMMENDATIONS])
    unread = topics.next_message(messages, RECOMMENDATIONS, committed(spark, log, group))
    found = unread.select(*[f.name for f in schemas.MESSAGE.fields]).collect()
    for message in found:
        topic_log.take(log, group, message["topic"], message["partition"], message["offset"])
    return spark.createDataFrame(found, schemas.MESSAGE).withColumn("value", F.col("value").cast("string"))


def log_request(spark: SparkSession, name: str, base: str) -> None:
    """Add one search to the archive that popularity is counted from."""
    request = spark.range(1).select(F.lit(name).alias("product_name"), rfc3339(F.current_timestamp()).alias("timestamp"))
    request.write.mode("append").json(f"{base.rstrip('/')}/requests")


def read_batches(spark: SparkSession, out: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """What a job has written so far, with the batch id of each row."""
    whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(whole).format(fmt).load(out)


def refresh_once(spark: SparkSession, base: str, n: int = popularity.TOP_N) -> DataFrame:
    """The scheduled popularity job: archive in, popular list out."""
    popular = popularity.popular_products(read_requests(spark, base), n)
    write_popular(popular, base)
    return read_popular(spark, base)

