"""The product catalog: routing, allow-lists and deny-lists, list edits, validation, flat views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..session import lookup_join
from . import numbering

KEEP = "keep"
PASS_NULL = "pass_null"
PASS_UNPARSED = "pass_unparsed"
PASS_UNSUPPORTED = "pass_unsupported"
CONVERTER_ERROR = "converter_error"
DROP_NO_ID = "drop_no_id"
DROP_NOT_ALLOWED = "drop_not_allowed"


def allowed_only(products: DataFrame, allowed: DataFrame) -> DataFrame:
    return lookup_join(products, allowed.select("product_id"), ["product_id"], "left_semi")


def without_denied(products: DataFrame, denied: DataFrame) -> DataFrame:
    return lookup_join(products, denied.select("product_id"), ["product_id"], "left_anti")


def with_product_id(records: DataFrame, value: str = "value", converted: bool = False) -> DataFrame:
    """Adds ``product_id`` as text and ``_fixed``, the route of records that need no list.

    ``converted`` means the text was JSON-decoded once before the filter sees it: lists, numbers
    and booleans are then values the filter does not handle and passes on, and the content of a
    JSON string is read as JSON. Text that the converter cannot read never reaches the filter.
    """
    text = F.col(value).cast("string")
    branches = [(text.isNull(), F.lit(PASS_NULL))]
    if converted:
        outer = F.try_parse_json(text)
        kind = jsontext.kind(outer)
        handled = F.coalesce(kind.rlike("^(OBJECT|STRING)"), F.lit(True))
        branches += [
            (outer.isNull(), F.lit(CONVERTER_ERROR)),
            (kind == "VOID", F.lit(PASS_NULL)),
            (~handled, F.lit(PASS_UNSUPPORTED)),
        ]
        text = F.when(kind == "STRING", outer.cast("string")).otherwise(text)
    rows = records.withColumn("_text", text).withColumn("_doc", F.try_parse_json("_text"))
    rows = rows.withColumn("_id", jsontext.member(F.col("_doc"), "product_id"))
    rows = rows.withColumn("_kind", jsontext.kind(F.col("_id")))
    product_id = jsontext.text_of(F.col("_id"), F.col("_kind"), F.col("_text"), "product_id")
    rows = rows.withColumn("product_id", F.when(F.col("_id").isNotNull(), product_id))
    blank = F.btrim("_text", F.lit(jsontext.JSON_SPACE)) == ""
    fixed = jsontext.first_case(
        [
            *branches,
            (blank, F.lit(DROP_NO_ID)),
            (F.col("_doc").isNull(), F.lit(PASS_UNPARSED)),
            (F.col("_id").isNull(), F.lit(DROP_NO_ID)),
        ]
    )
    return rows.withColumn("_fixed", fixed).drop("_text", "_doc", "_id", "_kind")


def route_records(
    records: DataFrame, allowed: DataFrame, value: str = "value", converted: bool = False
) -> DataFrame:
    """Adds ``route``: what the fail-open catalog filter does with each record."""
    rows = with_product_id(records, value, converted)
    listed = allowed.select("product_id").distinct().withColumn("_listed", F.lit(True))
    rows = lookup_join(rows, listed, ["product_id"], "left")
    decided = F.when(F.col("_listed"), F.lit(KEEP)).otherwise(F.lit(DROP_NOT_ALLOWED))
    return rows.withColumn("route", F.coalesce("_fixed", decided)).drop("_fixed", "_listed")


def filtered(records: DataFrame, allowed: DataFrame, value: str = "value", converted: bool = False) -> DataFrame:
    """The records the catalog filter lets through: kept ones and those it fails open on."""
    routed = route_records(records, allowed, value, converted)
    return routed.filter(F.col("route").isin(KEEP, PASS_NULL, PASS_UNPARSED, PASS_UNSUPPORTED))


# --- allow-list edits: rows (position, product_id) ---


def add_ids(allow_list: DataFrame, new_ids: DataFrame) -> DataFrame:
    """Append the ids of (position, product_id) that are not yet listed, each once."""
    fresh = new_ids.groupBy("product_id").agg(F.min("position").alias("position"))
    fresh = fresh.join(allow_list, "product_id", "left_anti")
    last = F.coalesce(allow_list.agg(F.max("position")).scalar(), F.lit(0))
    first = F.coalesce(new_ids.agg(F.min("position")).scalar(), F.lit(0))
    fresh = fresh.select((F.col("position") - first + last + 1).alias("position"), "product_id")
    return allow_list.select("position", "product_id").unionByName(fresh)


def remove_ids(allow_list: DataFrame, old_ids: DataFrame, check: bool = False) -> DataFrame:
    """Drop all occurrences of the ids; with ``check`` an id that is not listed is an error."""
    if check:
        absent = old_ids.join(allow_list, "product_id", "left_anti").select("product_id").first()
        if absent is not None:
            raise ValueError(f"product id {absent['product_id']!r} is not in the list")
    return allow_list.join(old_ids, "product_id", "left_anti").select("position", "product_id")


def clear_ids(allow_list: DataFrame) -> DataFrame:
    return allow_list.limit(0)


def numbered(allow_list: DataFrame) -> DataFrame:
    """The list with dense line numbers in position order."""
    order = [F.asc("position"), F.asc("product_id")]
    return numbering.numbered(allow_list, order, "line").select("line", "product_id")


# --- validation against the product schema ---


def _optional_text(doc: Column, key: str) -> Column:
    node = jsontext.member(doc, key)
    return jsontext.is_absent_or(node, jsontext.is_text(node))


def _elements_ok(node: Column, test) -> Column:
    items = F.when(F.startswith(jsontext.kind(node), F.lit("ARRAY")), node.cast("array<variant>"))
    return F.coalesce(F.forall(items, test), F.lit(False))


def _optional_whole(doc: Column, key: str) -> Column:
    node = jsontext.member(doc, key)
    return jsontext.is_absent_or(node, jsontext.is_whole_number(node))


def _image_ok(item: Column) -> Column:
    return jsontext.is_object(item) & _optional_text(item, "url") & _optional_text(item, "alt")


# The fields of the product schema that hold optional text.
TEXT_FIELDS = [
    "description",
    "category",
    "brand",
    "sku",
    "created_at",
    "updated_at",
    "index",
    "store_id",
]


def product_rules(doc: Column) -> dict[str, Column]:
    """Rule name to condition; a record conforms if all hold. Optional fields may be absent."""
    price, stock = jsontext.member(doc, "price"), jsontext.member(doc, "stock")
    tags, images = jsontext.member(doc, "tags"), jsontext.member(doc, "images")
    specifications = jsontext.member(doc, "specifications")
    rules = {
        "object": jsontext.is_object(doc),
        "product_id": jsontext.is_text(jsontext.member(doc, "product_id")),
        "name": jsontext.is_text(jsontext.member(doc, "name")),
        "price": jsontext.is_absent_or(
            price,
            jsontext.is_object(price)
            & jsontext.is_number(jsontext.member(price, "amount"))
            & jsontext.is_text(jsontext.member(price, "currency")),
        ),
        "stock": jsontext.is_absent_or(
            stock,
            jsontext.is_object(stock) & _optional_whole(stock, "available") & _optional_whole(stock, "reserved"),
        ),
        "tags": jsontext.is_absent_or(tags, _elements_ok(tags, jsontext.is_text)),
        "images": jsontext.is_absent_or(images, _elements_ok(images, _image_ok)),
        "specifications": jsontext.is_absent_or(specifications, jsontext.is_object(specifications)),
    }
    for key in TEXT_FIELDS:
        rules[key] = _optional_text(doc, key)
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}


def validate_products(records: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``violations`` (names of broken rules) and ``valid`` to JSON product records."""
    rows = records.withColumn("_doc", F.try_parse_json(F.col(value).cast("string")))
    broken = [F.when(~rule, F.lit(name)) for name, rule in product_rules(F.col("_doc")).items()]
    rows = rows.withColumn("violations", F.array_compact(F.array(*broken)))
    return rows.withColumn("valid", F.size("violations") == 0).drop("_doc")


def flat_products(products: DataFrame) -> DataFrame:
    """Nested products as flat columns; lists and maps become text."""
    specifications = F.array_sort(F.map_entries("specifications"))
    return products.select(
        "product_id",
        "name",
        F.col("price.amount").alias("amount"),
        F.col("price.currency").alias("currency"),
        "category",
        "brand",
        F.col("stock.available").alias("available"),
        F.col("stock.reserved").alias("reserved"),
        F.array_join("tags", ",").alias("tags"),
        F.size("images").alias("image_count"),
        F.get("images", F.lit(0))["url"].alias("first_image"),
        F.array_join(
            F.transform(specifications, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
        ).alias("specifications"),
    )
