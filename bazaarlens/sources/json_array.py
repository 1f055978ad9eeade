"""Reading one large JSON array in many tasks.

A file is read in pieces that end at a closing brace, wherever its splits lie. What a piece means depends on what
stands before it: running sums over the pieces tell whether it begins inside a text, how deep it ends, and which
element it belongs to. Sums run within a split first and are shifted by the sums of the splits before, one row
per split. An element's pieces are then put together and parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

_PLACE = ["file", "block"]


def _running(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all pieces of the file before the row."""
    rows = rows.withColumn("_value", value.cast("long"))
    before = Window.partitionBy(*_PLACE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy(*_PLACE).agg(F.sum("_value").alias("_sum"))
    shifts = splits.select(*_PLACE, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_shift"))
    within = F.coalesce(F.sum("_value").over(before), F.lit(0))
    summed = rows.withColumn(name, within).join(F.broadcast(shifts), _PLACE)  # one number per split
    return summed.withColumn(name, F.col(name) + F.col("_shift")).drop("_value", "_shift")


def _count(text: str, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(F.col(text), characters, ""))


def elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of the arrays in the files at ``path`` as JSON text: (file, number, value), numbered from 0.

    Elements are objects. Files that are no array of objects fail when they are read.
    """
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    read = spark.read.option("lineSep", "}").text(path)
    rows = written(read.select(*place, F.monotonically_increasing_id().alias("at"), "value"), "pieces")
    last = rows.groupBy("file").agg(F.max(F.struct("block", "at")).alias("last"))
    rows = rows.join(F.broadcast(last), "file")  # one row per file
    rows = rows.withColumn("tail", F.col("last") == F.struct("block", "at")).drop("last")
    # Without escaped characters each quote begins or ends a text.
    rows = rows.withColumn("bare", F.regexp_replace("value", r"(?s)\\.", ""))
    rows = _running(rows, _count("bare", '"'), "quotes")
    quoted = F.concat(F.when(F.col("quotes") % 2 == 1, F.lit('"')).otherwise(F.lit("")), "bare")
    rows = rows.withColumn("bare", F.regexp_replace(quoted, r'"[^"]*"', "")).withColumn("inside", F.contains("bare", F.lit('"')))
    rows = rows.withColumn("bare", F.regexp_replace("bare", r'"[^"]*\z', ""))
    closes = ~F.col("tail") & ~F.col("inside")
    rows = _running(rows, _count("bare", "{[") - _count("bare", "]") - closes.cast("int"), "depth")
    after = F.col("depth") + _count("bare", "{[") - _count("bare", "]") - 1
    rows = rows.withColumn("ends", closes & (after == 1))
    rows = _running(rows, F.col("ends").cast("int"), "number")
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    whole = rows.groupBy("file", "number").agg(parts.alias("parts"), F.max("ends").alias("ended"), F.max("depth").alias("deepest"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    first = F.when(F.col("number") == 0, F.lit(r"\A\s*\[\s*")).otherwise(F.lit(r"\A\s*,\s*"))
    element = F.concat(F.regexp_replace(text, first, F.lit("")), F.lit("}"))
    begins = F.regexp_like(text, F.concat(first, F.lit(r"\{")))
    finish = F.when(F.col("number") == 0, F.lit(r"\A\s*\[\s*\]\s*\z")).otherwise(F.lit(r"\A\s*\]\s*\z"))
    broken = F.raise_error(F.concat(F.lit("no JSON array of objects: "), F.col("file")))
    value = (
        F.when(F.col("ended") & begins, element)
        .when(~F.col("ended") & F.regexp_like(text, finish), F.lit(None).cast("string"))
        .otherwise(broken.cast("string"))
    )
    return whole.select("file", "number", value.alias("value")).filter("value is not null")


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The elements as rows of ``schema``; one that does not fit it fails the read."""
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    return elements(spark, path).select(parsed.alias("e")).select("e.*")
