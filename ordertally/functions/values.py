"""Typed values out of message text, the same with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def customer_key(text: Column) -> Column:
    """Key of a customer as bigint; NULL for anything that is not a number.

    `1`, `1.0`, ` 1 ` and `1e0` are one key and large integers keep every digit.
    What is no plain integer goes through decimal(38,6), which costs more.
    """
    return F.coalesce(
        text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint")
    )


def text_key(text: Column) -> Column:
    """Key of a customer as text: a number in its shortest form, anything else trimmed.

    NULL for blanks and for the NaN, in quotes, that decoding makes of a missing number.
    """
    trimmed = F.trim(text)
    missing = (trimmed == "") | (trimmed == '"NaN"')
    return F.when(~missing, F.coalesce(customer_key(text).cast("string"), trimmed))


def has_id(text: Column) -> Column:
    """Whether an order's id tells it from others: no NULL, no blanks. Decoding has made
    NULL of a missing number."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def amount(text: Column) -> Column:
    """Money amount as double; NULL for text that is no finite number.

    NaN and infinities count as missing, since one of them would spoil a running
    total for good. JSON decoding leaves quotes around a bare NaN.
    """
    number = F.trim(text, F.lit('"')).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


# Amounts that add up to the same sum in any order: up to 28 digits before the point.
EXACT = "decimal(38,10)"


def exact_amount(text: Column) -> Column:
    """Money amount as a decimal, rounded to ten digits after the point.

    NULL for what is no finite number, or too large for the type.
    """
    return F.trim(text, F.lit('"')).try_cast(EXACT)
