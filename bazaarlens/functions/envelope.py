"""Request payloads: plain JSON, or a JSON string that holds base64 of JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import jsontext

# Repeated groups are possessive: these patterns never step back, and matching a long text must not
# nest one call per repetition.
BASE64 = r"^(?:[A-Za-z0-9+/]{4})*+(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"
PLAIN_STRING = r'^"[^"\\\x00-\x1f]*+"$'
JSON_STRING = r'^"(?:[^"\\\x00-\x1f]++|\\["\\/bfnrt]|\\u[0-9a-fA-F]{4})*+"$'


def encode(json_text: Column) -> Column:
    """Base64 of the text as a JSON string, without the line breaks Spark's encoder inserts."""
    packed = F.regexp_replace(F.base64(json_text.cast("binary")), "[\r\n]", "")
    return F.concat(F.lit('"'), packed, F.lit('"'))


def string_content(body: Column) -> Column:
    """What a JSON string says, null for any other text; one without escapes needs no parser."""
    return F.when(body.rlike(PLAIN_STRING), F.substring(body, F.lit(2), F.length(body) - 2)).when(
        body.rlike(JSON_STRING), F.try_parse_json(body).cast("string")
    )


def unpack(content: Column) -> Column:
    """The text inside strictly padded base64, null if it is not base64. Quotes around it and line
    breaks in it are ignored."""
    packed = F.regexp_replace(F.btrim(content, F.lit('"')), "[\r\n]", "")
    return F.make_valid_utf8(F.unbase64(F.when(packed.rlike(BASE64), packed)).cast("string"))


def field_any_case(doc: Column, name: str) -> Column:
    """An object member by name; another letter case is accepted if the exact name is absent."""
    members = F.try_variant_get(doc, "$", "map<string,variant>")
    others = F.map_filter(members, lambda key, _: F.lower(key) == name)
    exact = jsontext.member(doc, name)
    return F.when(exact.isNotNull(), exact).otherwise(F.get(F.map_values(others), F.lit(0)))
