"""One recommendation per request, from the ranked popular list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, rfc3339
from . import containment

# Fixed values of a recommendation.
POPULAR_SUFFIX = " - Popular"
TRENDING_SUFFIX = " - Trending"
DEFAULT_SUFFIX = " - Recommended"
ID_PREFIX = "rec_"
REASON = "Popular recommendation"
CONFIDENCE = 0.9
DEFAULT_ALTERNATIVES = ["alt_1", "alt_2", "alt_3"]
LEADERS = 3


def _names(popular: DataFrame) -> DataFrame:
    return popular.select("rank", F.coalesce("product_name", F.lit("")).alias("product_name"))


def _as_array(names: DataFrame) -> Column:
    """(rank, product_name, folded) in rank order as one array value of the plan; callers bound
    the rows."""
    row = F.struct("rank", "product_name", fold(F.col("product_name")).alias("folded"))
    return names.agg(F.array_sort(F.collect_list(row))).scalar()


def alternatives(term: Column, leaders: Column) -> Column:
    """The first three names but for the term itself (letter case counts), or fixed stand-ins."""
    others = F.filter(leaders, lambda name: name != term)
    return F.when(F.size(others) > 0, others).otherwise(F.array(*map(F.lit, DEFAULT_ALTERNATIVES)))


def _first_contained(requests: DataFrame, names: DataFrame) -> DataFrame:
    """Adds ``matched``: the best-ranked name contained in the term, for lists too long to inline."""
    needles = names.select(fold(F.col("product_name")).alias("folded_needle"), F.col("product_name").alias("matched"), "rank")
    texts = requests.select(fold(F.col("_term")).alias("folded_text")).distinct()
    found = containment.occurrences(texts, needles)
    best = found.groupBy("folded_text").agg(F.min_by("matched", "rank").alias("matched"))
    return requests.withColumn("folded_text", fold(F.col("_term"))).join(best, "folded_text", "left").drop("folded_text")


def recommend(
    requests: DataFrame,
    popular: DataFrame,
    term: str = "product_name",
    at: str = "timestamp",
    keep: list[str] | None = None,
    inline: bool | None = None,
) -> DataFrame:
    """Recommendations for ``requests``: a request whose term contains a popular name (best rank
    first, case ignored) gets it, any other the top name, or its own term if nothing is popular.

    ``popular`` has rank and product_name. A measured short list is one array inside the plan, so
    requests are not shuffled; a longer one is matched per distinct term by equality. ``keep`` lists
    request columns to carry along. ``at`` is text and becomes the timestamp of the result.
    """
    keep = keep or []
    names = _names(popular)
    if inline is None:
        inline = containment.inline(names)
    rows = requests.withColumn("_term", F.coalesce(F.col(term), F.lit("")))
    if inline:
        rows = rows.withColumn("_listed", _as_array(names)).withColumn("_folded", fold(F.col("_term")))
        hits = F.filter("_listed", lambda row: F.contains(F.col("_folded"), row["folded"]))
        rows = rows.withColumn("matched", F.get(hits, F.lit(0))["product_name"])
    else:
        rows = _first_contained(rows, names)
        rows = rows.withColumn("_listed", _as_array(names.orderBy("rank").limit(LEADERS)))
    leaders = F.slice("_listed", 1, LEADERS)["product_name"]
    top = F.get(leaders, F.lit(0))
    product = F.coalesce(
        F.concat("matched", F.lit(POPULAR_SUFFIX)),
        F.concat(top, F.lit(TRENDING_SUFFIX)),
        F.concat("_term", F.lit(DEFAULT_SUFFIX)),
    )
    return rows.select(
        *keep,
        F.concat(F.lit(ID_PREFIX), product).alias("product_id"),
        product.alias("product_name"),
        F.lit(REASON).alias("reason"),
        F.lit(CONFIDENCE).alias("confidence"),
        alternatives(F.col("_term"), leaders).alias("alternatives"),
        F.col(at).alias("timestamp"),
    )


def recommend_now(requests: DataFrame, popular: DataFrame, **options) -> DataFrame:
    """As ``recommend``, stamped with the time of processing."""
    stamped = requests.withColumn("_now", rfc3339(F.current_timestamp()))
    return recommend(stamped, popular, at="_now", **options)
