"""Text expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a line or field is trimmed.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0            "
    "    　"
)


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def fold(text: Column) -> Column:
    """Lower case letter by letter: a capital sigma has one lower form wherever it stands."""
    return F.lower(F.translate(text, "\u03a3", "\u03c3"))


def contains_fold(text: Column, needle: Column) -> Column:
    """Case-insensitive substring test; an empty needle is contained in every text."""
    return F.contains(fold(text), fold(needle))


def nearest(value: Column, power: Column) -> Column:
    """The whole number next to the exact binary value times a power of ten, ties to even.

    The value is split in two halves whose products with the power are exact, which tells on
    which side of a tie it lies. Good for products below 1e15 and powers below 1e7.
    """
    high = value.cast("float").cast("double")
    near = F.rint(value * power)
    # Distance from the ties above and below ``near``; the signs are exact.
    above = (high * power - near - 0.5) + (value - high) * power
    below = (high * power - near + 0.5) + (value - high) * power
    odd = F.abs(near % 2) == 1
    return near + (
        F.when((above > 0) | ((above == 0) & odd), F.lit(1.0))
        .when((below < 0) | ((below == 0) & odd), F.lit(-1.0))
        .otherwise(F.lit(0.0))
    )


def fixed(value: Column, places: int) -> Column:
    """``%.<places>f`` of the number's exact binary value.

    Java's formatter rounds the shortest decimal form up instead: it prints 0.125 as 0.13 and 1.005
    as 1.01.
    """
    digits = nearest(value, F.lit(float(10**places))).cast("decimal(20,0)")
    text = (digits * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(28,{places})").cast("string")
    return F.when(F.abs(value) < 1e8, text).otherwise(F.format_string(f"%.{places}f", value))


def price_label(amount: Column, currency: Column) -> Column:
    return F.concat(fixed(amount, 2), F.lit(" "), currency)


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def day_of(text: str) -> Column:
    """The date that a column of texts begins with; null if that is none."""
    return F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def archive_name(record_id: Column, ts: Column) -> Column:
    return F.concat(record_id, F.lit("_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit("_000.json"))
