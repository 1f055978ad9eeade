"""The ``{price={amount=A, currency=C}, product_id=I, name=N, category=K}`` text format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import jsontext
from .text import trim_space

# The patterns of the line format. Its white space is spelled out: the vertical tab, which
# Java's \s also takes, does not count.
PRICE_PATTERN = r"price=\{([^}]+)\}"
AMOUNT_PATTERN = r"amount=([0-9.]+),[\t\n\f\r ]*currency=(\w+)"
PRODUCT_ID_PATTERN = r"product_id=([^,}]+)"
NAME_PATTERN = r"name=([^,}]+)"
CATEGORY_PATTERN = r"category=([^,}]+)"

NUMBER_PREFIX = r"^([0-9]*\.?[0-9]*)"


def render_value(value: Column, dtype: T.DataType) -> Column:
    """``{k=v, ..}`` for records and maps, ``[a, b]`` for lists, ``null`` for nulls."""
    if isinstance(dtype, T.StructType):
        text = render_fields([(f.name, value[f.name], f.dataType) for f in dtype.fields])
        return F.when(value.isNull(), F.lit("null")).otherwise(text)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: render_value(item, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
        return F.coalesce(text, F.lit("null"))
    if isinstance(dtype, T.MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda e: F.concat(e["key"].cast("string"), F.lit("="), render_value(e["value"], dtype.valueType)),
        )
        text = F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
        return F.coalesce(text, F.lit("null"))
    return F.coalesce(value.cast("string"), F.lit("null"))


def render_fields(fields: list[tuple[str, Column, T.DataType]]) -> Column:
    parts = [F.concat(F.lit(f"{name}="), render_value(value, dtype)) for name, value, dtype in fields]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def render_json_value(node: Column) -> Column:
    """A JSON scalar as text; numbers with a fraction or exponent as doubles print."""
    fractional = jsontext.kind(node).rlike("^(DECIMAL|DOUBLE)")
    number = F.try_variant_get(node, "$", "double").cast("string")
    return (
        F.when(jsontext.kind(node) == "VOID", F.lit("null"))
        .when(fractional, number)
        .otherwise(node.cast("string"))
    )


def render_json(doc: Column, fields: dict[str, list[str]]) -> Column:
    """The named members of a JSON object that are present, in that order, as ``{k=v, ..}``.

    A name with a list of inner names is a nested object.
    """
    parts = []
    for name, inner in fields.items():
        node = jsontext.member(doc, name)
        text = render_json_value(node)
        if inner:
            nested = render_json(node, {key: [] for key in inner})
            text = F.when(jsontext.is_object(node), nested).otherwise(text)
        parts.append(F.when(node.isNotNull(), F.concat(F.lit(f"{name}="), text)))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def _first(line: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(line, pattern, group)


def parse_price(line: Column) -> Column:
    """The price record; amount 0 and an empty currency unless both parts are readable."""
    inner = _first(line, PRICE_PATTERN)
    digits = _first(_first(inner, AMOUNT_PATTERN), NUMBER_PREFIX)
    amount = F.expr("cast(null as double)")
    amount = F.when(digits.rlike("[0-9]"), digits.try_cast("double")).otherwise(amount)
    amount = F.when(amount < F.lit(float("inf")), amount)
    return F.struct(
        F.coalesce(amount, F.lit(0.0)).alias("amount"),
        F.when(amount.isNotNull(), _first(inner, AMOUNT_PATTERN, 2)).otherwise(F.lit("")).alias("currency"),
    )


def parse_line(line: Column) -> list[Column]:
    """The four fields of a line; a field that is not found is empty, never null."""
    return [
        parse_price(line).alias("price"),
        trim_space(_first(line, PRODUCT_ID_PATTERN)).alias("product_id"),
        trim_space(_first(line, NAME_PATTERN)).alias("name"),
        trim_space(_first(line, CATEGORY_PATTERN)).alias("category"),
    ]
