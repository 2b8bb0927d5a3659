"""Rows to JSON messages and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.functions.values import has_id
from ordertally.schemas import ARRIVAL, ORDER, ORDER_FIELDS, strings

CORRUPT = "_corrupt_record"
# Why a message is refused; in the rejects with a blank for the underscore.
REASONS = ("empty", "malformed", "no_order_id")


def _arrival(df: DataFrame) -> list[str]:
    return [name for name in ARRIVAL if name in df.columns]


def encode(rows: DataFrame) -> DataFrame:
    """One JSON message per row; arrival columns are carried beside it.

    NULL fields are left out of the JSON. Without a `timestamp` column the
    messages are stamped with the current time.
    """
    carried = _arrival(rows)
    fields = [F.col(name) for name in rows.columns if name not in carried]
    value = F.to_json(F.struct(*fields)).cast("binary").alias("value")
    if "timestamp" in carried:
        stamp = F.col("timestamp").cast("timestamp").alias("timestamp")
    else:
        stamp = F.current_timestamp().alias("timestamp")
    others = [name for name in carried if name != "timestamp"]
    return rows.select(value, stamp, *others)


# An order_id that is text, the text "NaN" with its quotes.
_QUOTED = r'"order_id"\s*:\s*"\\"NaN\\""'


def _unfold(messages: DataFrame, schema: T.StructType, options: dict, *kept: str) -> DataFrame:
    # inline_outer over a one-element array instead of `from_json(...).*`: the
    # optimizer copies a plain from_json into every filter on its fields (such as
    # the NOT NULL a join infers) and the text would be parsed once per copy.
    order = F.from_json(F.col("value").cast("string"), schema, options)
    if "order_id" not in schema.names:
        return messages.select(F.inline_outer(F.array(order)), *kept)
    # Parsing makes the text "NaN", in quotes, of a number that is missing; the message
    # itself tells this from text. It is looked at only where that may be so.
    rows = messages.select(F.inline_outer(F.array(order)), "value", *(k for k in kept if k != "value"))
    missing = ~F.col("value").cast("string").rlike(_QUOTED)
    order_id = F.when((F.col("order_id") == '"NaN"') & missing, None).otherwise(F.col("order_id"))
    names = dict.fromkeys((*schema.names, *kept))
    return rows.withColumn("order_id", order_id).select(*names)


def decode(
    messages: DataFrame, fields: Sequence[str] = ORDER_FIELDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Message fields as text beside the arrival columns; all NULL if unreadable.

    Name only the fields needed: the others are then skipped while parsing.
    `keep` names further columns to take along.
    """
    return _unfold(messages, strings(*fields), {}, *_arrival(messages), *keep)


def screen(messages: DataFrame) -> DataFrame:
    """Decoded messages with `reason`: NULL if the archive can take the message.

    A message is refused when it is empty, is no JSON object, or has no usable order_id;
    what is refused has a NULL order_id.
    """
    schema = T.StructType([*ORDER.fields, T.StructField(CORRUPT, T.StringType())])
    blank = F.length(F.trim(F.coalesce(F.col("value").cast("string"), F.lit("")))) == 0
    reason = (
        F.when(blank, "empty")
        .when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(~has_id(F.col("order_id")), "no order_id")
    )
    options = {"columnNameOfCorruptRecord": CORRUPT}
    decoded = _unfold(messages, schema, options, "value", *_arrival(messages))
    screened = decoded.withColumn("reason", reason).drop(CORRUPT)
    kept = F.when(F.col("reason").isNull(), F.col("order_id"))
    return screened.withColumn("order_id", kept)


def rejects(messages: DataFrame) -> DataFrame:
    """The messages an archive refuses, whole, and why."""
    return screen(messages).where("reason IS NOT NULL").drop(*ORDER_FIELDS)
