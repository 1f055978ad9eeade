"""File sources. Every reader states its schema, so nothing is scanned to guess one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import jsontext
from ..functions.filtered_line import parse_line
from ..functions.text import trim_space
from ..sinks import versions
from .json_array import read_array


def _or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_requests(spark: SparkSession, base: str) -> DataFrame:
    """The request archive below ``<base>/requests``; a missing archive has no rows."""
    path = f"{base.rstrip('/')}/requests"
    return _or_empty(spark, lambda: spark.read.schema(schemas.REQUEST).json(path), schemas.REQUEST)


def read_catalog(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Products from files that each hold a JSON array; one bad product fails the load.

    A missing id or name reads as empty text.

    An array file is read in as many tasks as its size asks for (``json_array``); ``lines`` reads JSON lines.
    """
    if lines:
        rows = spark.read.schema(schemas.PRODUCT).option("mode", "FAILFAST").json(path)
    else:
        rows = read_array(spark, path, schemas.PRODUCT)
    required = {name: F.coalesce(name, F.lit("")) for name in ("product_id", "name")}
    return rows.withColumns(required)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed text lines without blank ones; only a line feed ends a line."""
    lines = spark.read.option("lineSep", "\n").text(path).select(trim_space(F.col("value")).alias("value"))
    return lines.filter("value <> ''")


def read_filtered_products(spark: SparkSession, path: str) -> DataFrame:
    return read_lines(spark, path).select(*parse_line(F.col("value")))


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    """Rows (position, product_id) of a ``{"allowed_product_ids": [..]}`` file.

    A missing or unreadable file, or one without such a list, gives an empty list. An element that is an
    object or a list reads as empty text, null as ``null``.
    """
    whole = T.StructType([T.StructField("value", T.StringType())])
    rows = _or_empty(spark, lambda: spark.read.text(path, wholetext=True), whole)
    listed = jsontext.member(F.try_parse_json("value"), "allowed_product_ids")
    source = F.get_json_object("value", "$.allowed_product_ids")
    items = F.when(F.startswith(jsontext.kind(listed), F.lit("ARRAY")), listed.cast("array<variant>"))
    raw = F.from_json(source, T.ArrayType(T.StringType()))
    rows = rows.select(items.alias("items"), raw.alias("raw"))
    rows = rows.select(F.posexplode("items").alias("position", "item"), "raw")
    container = jsontext.kind(F.col("item")).rlike("^(ARRAY|OBJECT)")
    text = F.when(container, F.lit("")).otherwise(F.coalesce(F.get("raw", F.col("position")), F.lit("null")))
    return rows.select((F.col("position") + 1).cast("bigint").alias("position"), text.alias("product_id"))


def read_popular(spark: SparkSession, base: str) -> DataFrame:
    """The stored popular list; empty before the first popularity run."""
    path = versions.current(spark, f"{base.rstrip('/')}/recommendations")
    if path is None:
        return spark.createDataFrame([], schemas.POPULAR)
    return spark.read.schema(schemas.POPULAR).json(path)


def read_allow_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored allow-list table; empty before the first one."""
    current = versions.current(spark, path)
    if current is None:
        return spark.createDataFrame([], schemas.ALLOW_LIST)
    return spark.read.schema(schemas.ALLOW_LIST).parquet(current)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Plain files directly in a folder with their sizes; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as bytes: rows (path, content)."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
