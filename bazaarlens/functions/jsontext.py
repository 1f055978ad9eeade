"""JSON expressions that keep null, missing, wrong type and unreadable text apart."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_SPACE = " \t\n\r"


def first_case(branches: Iterable[tuple[Column, Column]]) -> Column:
    """One CASE over (condition, value) pairs in order; null if none holds."""
    (condition, value), *others = branches
    case = F.when(condition, value)
    for condition, value in others:
        case = case.when(condition, value)
    return case


def member(doc: Column, key: str) -> Column:
    """The member of a variant object: SQL null if absent, variant null if it is JSON null."""
    return F.try_variant_get(doc, f"$.{key}", "variant")


def kind(node: Column) -> Column:
    """VOID, STRING, BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, ARRAY<..>, OBJECT<..>; null if absent."""
    return F.schema_of_variant(node)


def is_object(doc: Column) -> Column:
    return F.startswith(kind(doc), F.lit("OBJECT"))


def is_text(node: Column) -> Column:
    return kind(node) == "STRING"


def is_absent_or(node: Column, test: Column) -> Column:
    return node.isNull() | test


def is_number(node: Column) -> Column:
    return kind(node).rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(.*)$")


def is_whole_number(node: Column) -> Column:
    value = F.try_variant_get(node, "$", "double")
    return F.coalesce(is_number(node) & (value == F.floor(value)), F.lit(False))


def text_of(node: Column, node_kind: Column, source: Column, key: str) -> Column:
    """A member as plain text: digits, true/false, ``null`` for JSON null, empty for containers.

    ``source`` is the JSON text, needed because a variant forgets the ``.0`` of ``10001.0``.
    """
    raw = F.get_json_object(source, f"$.{key}")
    return (
        F.when(node_kind.isin("STRING", "BIGINT", "BOOLEAN", "DOUBLE"), node.cast("string"))
        .when(node_kind == "VOID", F.lit("null"))
        .when(node_kind.rlike("^(ARRAY|OBJECT)"), F.lit(""))
        .when(F.contains(raw, F.lit(".")), raw.cast("double").cast("string"))
        .otherwise(raw)
    )


def has_no_tail(body: Column) -> Column:
    """Whether a trimmed JSON text is one value only; the variant reader ignores what follows it.

    An object whose first closing brace ends the text has no tail. Any other text must also be
    readable as the only element of a list and as a member, which no tail survives.
    """
    flat = F.startswith(body, F.lit("{")) & (F.locate("}", body) == F.length(body))
    listed = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    boxed = F.try_parse_json(F.concat(F.lit('{"v":'), body, F.lit("}")))
    single = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.when(flat, F.lit(True)).otherwise(F.coalesce(single & boxed.isNotNull(), F.lit(False)))
