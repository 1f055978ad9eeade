"""Queries that write rows derived from the tables to shared files and read them with the file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import rfc3339
from ..operators import catalog, popularity
from ..session import shared_dir, written
from ..sinks.files import write_allow_list
from ..sources import files
from . import views
from .views import with_cte


def archive_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The popular list of an archive of JSON lines, the whole list."""
    base = shared_dir(spark, "archive")
    searches = views.searches(spark, sf_dir).select("product_name", rfc3339(F.col("ts")).alias("timestamp"))
    searches.write.json(f"{base}/requests")
    return popularity.popular_products(files.read_requests(spark, base), None)


def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products stored as JSON lines and read under the explicit schema, all fields."""
    path = shared_dir(spark, "catalog")
    views.products(spark, sf_dir).write.option("ignoreNullFields", "false").json(path)
    return _all_fields(files.read_catalog(spark, path, lines=True))


def _all_fields(read: DataFrame) -> DataFrame:
    flat = catalog.flat_products(read)
    more = ["description", "sku", "created_at", "updated_at", F.col("index").alias("search_index"), "store_id"]
    return flat.join(read.select("product_id", *more), "product_id")


# Products of a stored array.
ARRAY_PRODUCTS = 5000


def catalog_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products stored as JSON arrays, a file each, and read in splits."""
    path = shared_dir(spark, "arrays")
    products = views.products(spark, sf_dir)
    text = F.to_json(F.struct(*products.columns), {"ignoreNullFields": "false"})
    file = F.expr(f"cast(product_id as bigint) div {ARRAY_PRODUCTS}").alias("file")
    listed = products.groupBy(file).agg(F.concat_ws(",\n", F.collect_list(text)).alias("listed"))
    listed.select("file", F.concat(F.lit("["), "listed", F.lit("]")).alias("value")).write.partitionBy("file").text(path)
    return _all_fields(written(files.read_catalog(spark, path), "catalog"))


def allow_list_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list document with elements of every kind: a number, null, an object and a list after the ids."""
    path = shared_dir(spark, "document")
    ids = views.routed_ids(spark, sf_dir).agg(F.array_sort(F.collect_list("product_id")).alias("ids"))
    listed = F.concat_ws(",", F.transform("ids", lambda i: F.concat(F.lit('"'), i, F.lit('"'))))
    text = F.concat(F.lit('{"allowed_product_ids": ['), listed, F.lit(',7, null, {"a": 1}, [2]]}'))
    ids.select(text.alias("value")).write.text(path)
    return files.read_allow_list(spark, path)


def allow_list_clear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored list and the same list cleared: rows, and products that pass the filter."""
    path = shared_dir(spark, "allow-list")
    ids = views.allowed_ids(spark, sf_dir)
    write_allow_list(ids.select(F.col("product_id").cast("bigint").alias("position"), "product_id"), path)
    products = views.products(spark, sf_dir)

    def counted(name: str) -> DataFrame:
        listed = files.read_allow_table(spark, path)
        kept = catalog.allowed_only(products, listed).agg(F.count("*").alias("kept"))
        return kept.select(F.lit(name).alias("list"), F.lit(listed.count()).alias("ids"), "kept")

    before = counted("stored")
    write_allow_list(catalog.clear_ids(files.read_allow_table(spark, path)), path)
    return before.unionByName(counted("cleared"))


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of order lines' ids: how many, their sizes, and the lines in their contents."""
    path = shared_dir(spark, "listing")
    lines = views.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("value"))
    lines.repartition(3).write.text(path)
    listed = files.list_files(spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    whole = files.read_file(spark, path).select(F.decode("content", "UTF-8").alias("text"))
    ends = whole.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", ""))).cast("bigint").alias("lines"))
    return listed.select("files", "bytes", ends.select("lines").scalar().alias("lines"))


CATALOG = """
select cast(p_partkey as varchar) as product_id, p_name as name, p_retailprice as amount, 'RUB' as currency,
       p_type as category, p_brand as brand, p_size as available, p_size % 5 as reserved,
       replace(p_name, ' ', ',') as tags, case when p_size % 4 <> 0 then 1 end as image_count,
       case when p_size % 4 <> 0 then 'https://img.example/' || p_partkey end as first_image,
       'size=' || p_size || ',type=' || p_type as specifications,
       p_brand || ' ' || p_name as description, 'SKU-' || p_partkey as sku,
       '2024-01-01T00:00:00Z' as created_at, cast(null as varchar) as updated_at, 'products' as search_index,
       'store_' || p_partkey % 7 as store_id
from part
"""

QUERIES = {
    "archive_popular": (
        archive_popular,
        with_cte(
            views.SEARCHES,
            views.RANKED,
            body="select cast(rank as integer) as rank, product_name, search_count from ranked",
        ),
    ),
    "catalog_files": (catalog_files, CATALOG),
    "catalog_arrays": (catalog_arrays, CATALOG),
    "allow_list_document": (
        allow_list_document,
        with_cte(
            views.ROUTED,
            body="""
select row_number() over (order by product_id) as position, product_id from routed
union all
select (select count(*) from routed) + k, v from (values (1, '7'), (2, 'null'), (3, ''), (4, '')) t(k, v)
""",
        ),
    ),
    "allow_list_clear": (
        allow_list_clear,
        with_cte(
            views.ALLOWED,
            body="""
select 'stored' as list, (select count(*) from allowed) as ids, count(*) as kept
from part where cast(p_partkey as varchar) in (select product_id from allowed)
union all
select 'cleared', 0, 0
""",
        ),
    ),
    "file_listing": (
        file_listing,
        """
select 3 as files, cast(sum(length(cast(l_orderkey as varchar)) + 1) as bigint) as bytes, count(*) as lines from lineitem
""",
    ),
}
