"""Popularity of search terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbering import numbered

TOP_N = 10
# Lists up to this length are ranked as one array; longer ones by ranges.
FOLDED_N = 1000


def term_schema(period: str) -> T.StructType:
    """Counts per period (a date) and term."""
    columns = [(period, T.DateType()), ("search_term", T.StringType()), ("search_count", T.LongType())]
    return T.StructType([T.StructField(*column) for column in columns])


def term_counts(requests: DataFrame, *periods: str) -> DataFrame:
    """Requests per term, letter case kept; null terms are left out, empty ones are counted.

    With ``periods``, columns of ``requests``, counts are per period.
    """
    return (
        requests.select(*periods, F.col("product_name").alias("search_term"))
        .filter(F.col("search_term").isNotNull())
        .groupBy(*periods, "search_term")
        .agg(F.count("*").alias("search_count"))
    )


def merged(counts: DataFrame, *periods: str) -> DataFrame:
    """Partial counts of ``term_counts`` added up; counts of any batches in any order give the whole's."""
    return counts.groupBy(*periods, "search_term").agg(F.sum("search_count").alias("search_count"))


def ranked(counts: DataFrame, n: int | None = TOP_N) -> DataFrame:
    """The n most frequent terms with their rank, all without n; equal counts are ordered by term."""
    if n is not None and n < 1:
        raise ValueError("n must be at least 1")
    if n is None or n > FOLDED_N:
        rows = numbered(counts, [F.desc("search_count"), F.asc("search_term")], "rank")
        rows = rows.select(F.col("rank").cast("int").alias("rank"), F.col("search_term").alias("product_name"), "search_count")
        return rows if n is None else rows.filter(F.col("rank") <= n)
    top = counts.orderBy(F.desc("search_count"), "search_term").limit(n)
    # At most n rows are folded here, so that ranks come from array positions.
    row = F.struct((-F.col("search_count")).alias("minus"), "search_term", "search_count")
    folded = top.agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return folded.select(F.posexplode("rows").alias("position", "row")).select(
        (F.col("position") + 1).alias("rank"),
        F.col("row.search_term").alias("product_name"),
        F.col("row.search_count").alias("search_count"),
    )


def popular_products(requests: DataFrame, n: int | None = TOP_N) -> DataFrame:
    return ranked(term_counts(requests), n)
