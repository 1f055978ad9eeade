"""Search requests: envelopes, decoding, archive semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import envelope, jsontext
from ..functions.text import archive_name, rfc3339


FIELDS = ["product_name", "timestamp"]
# A request just as producers write it, without escapes: its fields are read without a parser.
AS_WRITTEN = r'^\{"product_name":"([^"\\\x00-\x1f]*+)","timestamp":"([^"\\\x00-\x1f]*+)"\}$'


def request_json(name: Column, ts: Column) -> Column:
    fields = F.struct(name.alias("product_name"), rfc3339(ts).alias("timestamp"))
    return F.to_json(fields, {"ignoreNullFields": "false"})


def request_envelope(requests: DataFrame, name: str = "product_name", ts: str = "ts") -> DataFrame:
    """Adds ``value``, the message payload of a search request."""
    return requests.withColumn("value", envelope.encode(request_json(F.col(name), F.col(ts))))


def with_request(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``_request``, the fields of a decodable message, else null.

    A field must be text, null or absent; null and absent read as empty text.
    """
    space = F.lit(jsontext.JSON_SPACE)
    rows = messages.withColumn("_body", F.btrim(F.col(value).cast("string"), space))
    unpacked = F.btrim(envelope.unpack(envelope.string_content(F.col("_body"))), space)
    rows = rows.withColumn("_inner", F.coalesce(unpacked, "_body"))
    # A bare null is no request, but a null inside an envelope is an empty one.
    empty = (F.col("_inner") == "null") & (F.col("_body") != "null")
    rows = rows.withColumn("_plain", F.coalesce(F.rlike("_inner", F.lit(AS_WRITTEN)), F.lit(False)))
    whole = F.startswith("_inner", F.lit("{")) & jsontext.has_no_tail(F.col("_inner"))
    rows = rows.withColumn("_doc", F.when(~F.col("_plain") & whole, F.try_parse_json("_inner")))
    rows = rows.withColumns({f"_{key}": envelope.field_any_case(F.col("_doc"), key) for key in FIELDS})
    typed = F.lit(True)
    for key in FIELDS:
        node = F.col(f"_{key}")
        typed = typed & (node.isNull() | jsontext.kind(node).isin("STRING", "VOID"))

    def fields(text_of) -> Column:
        return F.struct(*[text_of(i, key).alias(key) for i, key in enumerate(FIELDS, start=1)])

    request = jsontext.first_case(
        [
            (F.col("_plain"), fields(lambda i, key: F.regexp_extract("_inner", AS_WRITTEN, i))),
            (empty, fields(lambda i, key: F.lit(""))),
            (
                F.col("_doc").isNotNull() & typed,
                fields(lambda i, key: F.coalesce(F.col(f"_{key}").cast("string"), F.lit(""))),
            ),
        ]
    )
    return rows.withColumn("_request", request).drop("_body", "_inner", "_plain", "_doc", *[f"_{k}" for k in FIELDS])


def decode_requests(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds product_name, timestamp and ``decoded``; undecodable messages stay, marked false."""
    columns = {key: F.col(f"_request.{key}") for key in FIELDS}
    rows = with_request(messages, value).withColumns({"decoded": F.col("_request").isNotNull(), **columns})
    return rows.drop("_request")


def split_decoded(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decoded requests, and the quarantined messages that are no requests."""
    return split(with_request(messages, value))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``split_decoded`` of messages that have their ``_request``.

    Rows are chosen by exploding: a filter would be moved below the decoding and repeat all of it.
    """
    good = rows.withColumn("_request", F.explode(F.array_compact(F.array("_request"))))
    good = good.withColumns({key: F.col(f"_request.{key}") for key in FIELDS}).drop("_request")
    bad = rows.withColumn("_request", F.explode(F.when(F.col("_request").isNull(), F.array(F.lit(1)))))
    return good, bad.drop("_request")


def last_write(records: DataFrame, record_id: str, ts: str, order: list[str], payload: list[str]) -> DataFrame:
    """The record that survives in each archive file: the last one per id and second.

    An aggregate, not a window: copies are reduced before the shuffle.
    """
    newest = F.max(F.struct(F.col(ts).alias("_at"), *order, *payload)).alias("_row")
    grouped = records.groupBy(
        F.col(record_id), F.date_trunc("second", F.col(ts)).alias("second")
    ).agg(newest, F.count("*").alias("writes"))
    return grouped.select(
        archive_name(F.col(record_id).cast("string"), F.col("second")).alias("file_name"),
        record_id,
        "second",
        "writes",
        *[F.col(f"_row.{name}").alias(name) for name in payload],
    )
