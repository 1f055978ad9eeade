"""Queries over the product catalog: filter, lists, validation, text format, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.filtered_line import parse_line
from ..functions.text import price_label
from ..operators import catalog, search
from ..session import written
from ..sinks.files import as_lines
from . import views
from .views import with_cte


def _allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A list is a stored table: derived once, then measured and joined without reading it anew.
    return written(views.allowed_ids(spark, sf_dir), "allow-list")


def allow_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.products(spark, sf_dir).select("product_id", "name", "category", F.col("price.amount").alias("amount"))
    return catalog.allowed_only(rows, _allowed(spark, sf_dir))


def deny_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.products(spark, sf_dir).select("product_id", "name", "category", F.col("price.amount").alias("amount"))
    return catalog.without_denied(rows, _allowed(spark, sf_dir))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = views.allowed_ids(spark, sf_dir)
    return ids.select(F.col("product_id").cast("bigint").alias("position"), "product_id")


def allow_list_edit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add all parts of size 50, drop every id that ends in 3, list the rest with line numbers."""
    part = views.table(spark, sf_dir, "part")
    ids = part.select(F.col("p_partkey").alias("position"), F.col("p_partkey").cast("string").alias("product_id"))
    start = written(_listed(spark, sf_dir), "allow-list")
    added = catalog.add_ids(start, ids.join(part.filter("p_size = 50"), ids.position == part.p_partkey, "left_semi"))
    kept = catalog.remove_ids(added, ids.filter("product_id like '%3'"))
    return catalog.numbered(kept)


def _raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product messages, one in twelve of each odd kind."""
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pid, kind = F.col("p_partkey").cast("string"), F.col("p_partkey") % 12
    quoted = F.to_json(F.struct(pid.alias("product_id"), F.col("p_name").alias("name")))
    value = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.lit("not json"))
        .when(kind == 2, F.lit("  "))
        .when(kind == 3, F.to_json(F.struct(F.col("p_name").alias("name"))))
        .when(kind == 4, F.lit('{"product_id":null}'))
        .when(kind == 5, F.concat(F.lit('{"product_id":'), pid, F.lit("}")))
        .when(kind == 6, F.concat(F.lit('{"product_id":'), pid, F.lit(".0}")))
        .when(kind == 7, F.concat(quoted, F.lit(" tail")))
        .when(kind == 8, F.concat(F.lit("["), pid, F.lit("]")))
        .otherwise(quoted)
    )
    return part.select("p_partkey", value.alias("value"))


def filter_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = written(views.routed_ids(spark, sf_dir), "allow-list")
    return catalog.route_records(_raw_products(spark, sf_dir), listed).select("p_partkey", "route")


def filter_routing_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same behind a JSON converter; text that is no JSON is the converter's error."""
    rows = _raw_products(spark, sf_dir)
    listed = written(views.routed_ids(spark, sf_dir), "allow-list")
    return catalog.route_records(rows, listed, converted=True).select("p_partkey", "route")


ROUTES = """
select p_partkey,
  case p_partkey % 12
    when 0 then 'pass_null' when 1 then '{unparsed}' when 2 then '{blank}'
    when 3 then 'drop_no_id' when 4 then 'drop_not_allowed' when 6 then 'drop_not_allowed'
    when 8 then '{listed}'
    else case when cast(p_partkey as varchar) in (select product_id from routed)
         then 'keep' else 'drop_not_allowed' end
  end as route
from part
"""


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products through their JSON form and back under the explicit schema."""
    text = views.products(spark, sf_dir).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    parsed = text.select(F.from_json("value", schemas.PRODUCT, {"mode": "FAILFAST"}).alias("p")).select("p.*")
    return parsed.select(
        "product_id",
        "name",
        "description",
        F.col("price.amount").alias("amount"),
        F.col("price.currency").alias("currency"),
        "category",
        "brand",
        "sku",
        "created_at",
        "updated_at",
        F.col("index").alias("search_index"),
        "store_id",
    )


def product_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.flat_products(views.products(spark, sf_dir))


def product_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product messages with one kind of mistake per residue of the part key."""
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    head = F.concat(F.lit('{"product_id":"'), F.col("p_partkey").cast("string"), F.lit('",'))
    name = F.concat(F.lit('"name":"'), F.col("p_name"), F.lit('"'))
    price = F.concat(F.lit(',"price":{"amount":'), F.col("p_retailprice").cast("string"))
    kind = F.col("p_partkey") % 9
    value = (
        F.when(kind == 0, F.concat(F.lit("{"), name, F.lit("}")))
        .when(kind == 1, F.concat(head, name, price, F.lit("}}")))
        .when(kind == 2, F.concat(head, name, F.lit(',"stock":{"available":1.5}}')))
        .when(kind == 3, F.concat(head, name, F.lit(',"tags":["a",1],"images":[{"url":2}]}')))
        .when(kind == 4, F.concat(head, name, F.lit(',"brand":null}')))
        .when(kind == 5, F.lit("no json"))
        .when(kind == 6, F.concat(head, F.lit('"name":7,"specifications":[]}')))
        .otherwise(
            F.concat(
                head,
                name,
                price,
                F.lit(',"currency":"RUB"},"stock":{"available":'),
                F.col("p_size").cast("string"),
                F.lit('.0},"tags":["a"],"images":[{"alt":"b"}],"specifications":{"k":1},"more":null}'),
            )
        )
    )
    checked = catalog.validate_products(part.select("p_partkey", value.alias("value")))
    return checked.select("p_partkey", "valid", F.array_join("violations", ",").alias("violations"))


def _odd_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose lines do not all read back: negative and huge prices, commas in names."""
    kind = F.col("product_id").cast("bigint") % 10
    amount: Column = F.col("price.amount")
    return views.products(spark, sf_dir).select(
        "product_id",
        F.when(kind == 3, F.concat("name", F.lit(", extra"))).otherwise(F.col("name")).alias("name"),
        F.when(kind != 4, F.col("category")).alias("category"),
        F.when(
            kind != 5,
            F.struct(
                F.when(kind == 1, -amount).when(kind == 2, F.lit(12345678.0)).otherwise(amount).alias("amount"),
                F.col("price.currency").alias("currency"),
            ),
        ).alias("price"),
    )


def filtered_line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = as_lines(_odd_products(spark, sf_dir))
    parsed = lines.select("value", *parse_line(F.col("value")))
    return parsed.select(
        F.col("value").alias("line"),
        "product_id",
        "name",
        "category",
        F.col("price.amount").alias("amount"),
        F.col("price.currency").alias("currency"),
    )


def product_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.display(search.search(views.products(spark, sf_dir), "RING"))


def price_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = price_label(F.col("price.amount"), F.col("price.currency"))
    return views.products(spark, sf_dir).select("product_id", price.alias("price"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of part names in capitals."""
    part = views.table(spark, sf_dir, "part")
    return part.select(F.explode(F.split(F.upper("p_name"), " ")).alias("term")).distinct()


def _name_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All names, all endings of part keys and an unknown term: a list that grows with the parts."""
    part = views.table(spark, sf_dir, "part")
    return part.select(
        F.explode(
            F.array(
                F.initcap("p_name"),
                F.concat(F.lit("#"), F.col("p_partkey").cast("string")),
                F.lit("no such product"),
            )
        ).alias("term")
    ).distinct()


def product_search_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.products(spark, sf_dir).select("product_id", "name")
    return search.search_many(rows, _words(spark, sf_dir))


def product_search_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.products(spark, sf_dir).select("product_id", "name")
    return search.search_many(rows, _name_terms(spark, sf_dir), inline=False)


def product_search_any_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of many lengths, cut from the products' names and types: found by the index of pieces."""
    part = views.table(spark, sf_dir, "part")
    name = F.concat("p_name", F.lit(" "), F.lower("p_type"))
    cut = F.substring(name, (F.col("p_partkey") % 7 + 1).cast("int"), (F.col("p_partkey") % 23).cast("int"))
    terms = part.select(F.upper(cut).alias("term")).distinct()
    rows = part.select(F.col("p_partkey").cast("string").alias("product_id"), name.alias("name"))
    return search.search_many(rows, terms, inline=False)


def search_result_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.products(spark, sf_dir).select("product_id", "name")
    return search.result_counts(rows, _name_terms(spark, sf_dir))


NAME_TERMS = """
terms as (
  select distinct upper(p_name[1:1]) || p_name[2:strpos(p_name, ' ')]
         || upper(p_name[strpos(p_name, ' ') + 1:strpos(p_name, ' ') + 1])
         || p_name[strpos(p_name, ' ') + 2:] as term from part
  union select '#' || cast(p_partkey as varchar) from part
  union select 'no such product')
"""
WORDS = "terms as (select distinct unnest(string_split(upper(p_name), ' ')) as term from part)"
SEARCH_MANY = """
select cast(p_partkey as varchar) as product_id, p_name as name, t.term
from part join terms t on contains(lower(p_name), lower(t.term))
"""
FLAT = """
select cast(p_partkey as varchar) as product_id, p_name as name, p_type as category,
       p_retailprice as amount
from part
"""

QUERIES = {
    "allow_list_filter": (
        allow_list_filter,
        with_cte(views.ALLOWED, body=f"{FLAT} where cast(p_partkey as varchar) in (select product_id from allowed)"),
    ),
    "deny_list_filter": (
        deny_list_filter,
        with_cte(
            views.ALLOWED, body=f"{FLAT} where cast(p_partkey as varchar) not in (select product_id from allowed)"
        ),
    ),
    "allow_list_edit": (
        allow_list_edit,
        with_cte(
            views.ALLOWED,
            """
start as (select cast(product_id as bigint) as position, product_id from allowed),
extra as (select p_partkey as position, cast(p_partkey as varchar) as product_id from part where p_size = 50),
added as (
  select position, product_id from start
  union all
  select position - (select min(position) from extra) + 1 + (select max(position) from start), product_id
  from extra where product_id not in (select product_id from start)),
kept as (select * from added where product_id not like '%3')
""",
            body="select row_number() over (order by position) as line, product_id from kept",
        ),
    ),
    "filter_routing": (
        filter_routing,
        with_cte(views.ROUTED, body=ROUTES.format(unparsed="pass_unparsed", blank="drop_no_id", listed="drop_no_id")),
    ),
    "filter_routing_converted": (
        filter_routing_converted,
        with_cte(
            views.ROUTED,
            body=ROUTES.format(unparsed="converter_error", blank="converter_error", listed="pass_unsupported"),
        ),
    ),
    "product_catalog": (
        product_catalog,
        """
select cast(p_partkey as varchar) as product_id, p_name as name,
       p_brand || ' ' || p_name as description, p_retailprice as amount, 'RUB' as currency,
       p_type as category, p_brand as brand, 'SKU-' || cast(p_partkey as varchar) as sku,
       '2024-01-01T00:00:00Z' as created_at, cast(null as varchar) as updated_at,
       'products' as search_index, 'store_' || cast(p_partkey % 7 as varchar) as store_id
from part
""",
    ),
    "product_nested": (
        product_nested,
        """
select cast(p_partkey as varchar) as product_id, p_name as name, p_retailprice as amount,
       'RUB' as currency, p_type as category, p_brand as brand, p_size as available,
       p_size % 5 as reserved, replace(p_name, ' ', ',') as tags,
       case when p_size % 4 <> 0 then 1 end as image_count,
       case when p_size % 4 <> 0 then 'https://img.example/' || cast(p_partkey as varchar) end as first_image,
       'size=' || cast(p_size as varchar) || ',type=' || p_type as specifications
from part
""",
    ),
    "product_validate": (
        product_validate,
        """
select p_partkey, p_partkey % 9 in (7, 8) as valid,
  case p_partkey % 9 when 0 then 'product_id' when 1 then 'price' when 2 then 'stock'
    when 3 then 'tags,images' when 4 then 'brand' when 5 then 'object,product_id,name'
    when 6 then 'name,specifications' else '' end as violations
from part
""",
    ),
    "filtered_line_parse": (
        filtered_line_parse,
        with_cte(
            r"""
lines as (
  select '{price=' || case p_partkey % 10
           when 5 then 'null'
           else '{amount=' || case p_partkey % 10 when 1 then cast(-p_retailprice as varchar)
             when 2 then '1.2345678E7' else cast(p_retailprice as varchar) end || ', currency=RUB}' end
         || ', product_id=' || cast(p_partkey as varchar)
         || ', name=' || p_name || case when p_partkey % 10 = 3 then ', extra' else '' end
         || ', category=' || case when p_partkey % 10 = 4 then 'null' else p_type end || '}' as line
  from part),
priced as (
  select line, regexp_extract(regexp_extract(line, 'price=\{([^}]+)\}', 1),
                              'amount=([0-9.]+),\s*currency=(\w+)', ['a', 'c']) as price
  from lines)
""",
            body=r"""
select line, trim(regexp_extract(line, 'product_id=([^,}]+)', 1)) as product_id,
       trim(regexp_extract(line, 'name=([^,}]+)', 1)) as name,
       trim(regexp_extract(line, 'category=([^,}]+)', 1)) as category,
       coalesce(try_cast(price.a as double), 0) as amount, price.c as currency
from priced
""",
        ),
    ),
    "product_search": (
        product_search,
        """
select cast(p_partkey as varchar) as product_id, p_name as name, p_type as category,
       printf('%.2f RUB', p_retailprice) as price
from part where contains(lower(p_name), 'ring')
""",
    ),
    "price_display": (
        price_display,
        "select cast(p_partkey as varchar) as product_id, printf('%.2f RUB', p_retailprice) as price from part",
    ),
    "product_search_many": (product_search_many, with_cte(WORDS, body=SEARCH_MANY)),
    "product_search_long_list": (product_search_long_list, with_cte(NAME_TERMS, body=SEARCH_MANY)),
    "product_search_any_length": (
        product_search_any_length,
        """
with named as (select p_partkey, p_name || ' ' || lower(p_type) as name from part),
terms as (select distinct upper(substring(name, 1 + p_partkey % 7, p_partkey % 23)) as term from named)
select cast(p_partkey as varchar) as product_id, name, t.term
from named join terms t on contains(lower(name), lower(t.term))
""",
    ),
    "search_result_counts": (
        search_result_counts,
        with_cte(
            NAME_TERMS,
            body="""
select t.term, count(p.p_partkey) as result_count
from terms t left join part p on contains(lower(p.p_name), lower(t.term)) group by t.term
""",
        ),
    ),
}
