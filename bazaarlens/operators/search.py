"""Product search by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_fold, fold, price_label
from . import containment


def search(products: DataFrame, needle: str) -> DataFrame:
    """Products whose name contains the needle, ignoring case; an empty needle matches all."""
    return products.filter(contains_fold(F.col("name"), F.lit(needle)))


def display(products: DataFrame) -> DataFrame:
    """The columns a result list shows, the price as ``12.50 RUB``."""
    return products.select(
        "product_id", "name", "category", price_label(F.col("price.amount"), F.col("price.currency")).alias("price")
    )


def _folded(terms: DataFrame) -> DataFrame:
    return terms.select("term", fold(F.col("term")).alias("folded_needle"))


def search_many(products: DataFrame, terms: DataFrame, inline: bool | None = None) -> DataFrame:
    """Each product once per distinct term found in its name, with the term as a column.

    A measured short list of terms is tested row by row without any shuffle. A longer list is
    matched once per distinct name and joined back by name.
    """
    terms = terms.select("term").filter("term is not null").distinct()
    if inline is None:
        inline = containment.inline(terms)
    if inline:
        rows = products.withColumn("_listed", _folded(terms).agg(F.collect_list(F.struct("*"))).scalar())
        rows = rows.withColumn("_name", fold(F.col("name")))
        hits = F.filter("_listed", lambda row: F.contains(F.col("_name"), row["folded_needle"]))
        return rows.withColumn("term", F.explode(hits["term"])).drop("_listed", "_name")
    names = products.filter("name is not null").select(fold(F.col("name")).alias("folded_text")).distinct()
    needles = _folded(terms)
    pairs = containment.containing_pairs(names, needles.select("folded_needle").distinct())
    hits = pairs.join(needles, "folded_needle").select("folded_text", "term")
    keyed = products.withColumn("folded_text", fold(F.col("name")))
    return keyed.join(hits, "folded_text").drop("folded_text")


def result_counts(products: DataFrame, terms: DataFrame, inline: bool | None = None) -> DataFrame:
    """How many products each distinct term finds, 0 included.

    Products are counted per distinct name before any matching.
    """
    terms = terms.select("term").filter("term is not null").distinct()
    names = products.groupBy("name").agg(F.count("*").alias("copies"))
    found = search_many(names, terms, inline).groupBy("term").agg(F.sum("copies").alias("copies"))
    return terms.join(found, "term", "left").select(
        "term", F.coalesce("copies", F.lit(0).cast("bigint")).alias("result_count")
    )
