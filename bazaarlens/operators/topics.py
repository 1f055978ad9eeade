"""Topic messages: offsets, next unread message, agreement of replicas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import lookup_join


def offset_summary(messages: DataFrame) -> DataFrame:
    """Per topic and partition: first and last offset, the offset to commit, message count."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        (F.max("offset") + 1).alias("next_offset"),
        F.count("*").alias("message_count"),
    )


def next_message(messages: DataFrame, topic: str, committed: DataFrame | None = None) -> DataFrame:
    """The next message of a topic, lowest partition first; ``committed`` has one next_offset per
    (topic, partition) and hides what lies before it."""
    unread = messages.filter(F.col("topic") == topic)
    if committed is not None:
        done = committed.filter(F.col("topic") == topic).select("partition", "next_offset")
        # A topic has few partitions, each with a large part of the messages: no key to shuffle by.
        unread = lookup_join(unread, done, ["partition"], "left")
        seen = F.coalesce(F.col("offset") < F.col("next_offset"), F.lit(False))
        unread = unread.filter(~seen).drop("next_offset")
    return unread.orderBy("partition", "offset").limit(1)


def reconcile(source: DataFrame, replica: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that differ between two copies of a stream, with how many copies are missing in the
    replica and how many it has too many. One aggregate serves both directions."""
    signed = source.select(*columns, F.lit(1).alias("_n")).unionByName(
        replica.select(*columns, F.lit(-1).alias("_n"))
    )
    balance = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    zero = F.lit(0).cast("bigint")
    return balance.select(
        *columns,
        F.greatest(F.col("_n"), zero).alias("missing"),
        F.greatest(-F.col("_n"), zero).alias("extra"),
    )
