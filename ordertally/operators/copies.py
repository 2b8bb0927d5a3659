"""Count a redelivered order once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.functions.values import has_id
from ordertally.operators.combine import drop_near_copies

_GAP = "_without_id"
_SEEN = "_seen_at"


def dedup(orders: DataFrame, within: str | None = None) -> DataFrame:
    """One row per order_id; rows without a usable id (see `has_id`) are all kept.

    Needs the columns `origin, position`, and drops them. Select the needed
    columns first: with fixed-width values a batch plan stays a hash aggregate.

    A stream keeps every id as state. With `within`, such as "2 days", it forgets
    an id that long after it was seen, and a later copy counts again. The time is
    that of the micro-batch, not of the message: no message is ever too late.
    """
    # Rows without an id get a name of their own instead.
    gap = F.when(~has_id(F.col("order_id")), F.concat_ws("@", "origin", "position"))
    keys = ["order_id", _GAP]
    named = orders.withColumn(_GAP, gap).drop("origin", "position")
    if orders.isStreaming:
        named = drop_near_copies(named, keys)
        if within is not None:
            named = named.withColumn(_SEEN, F.current_timestamp()).withWatermark(_SEEN, within)
            return named.dropDuplicatesWithinWatermark(keys).drop(_GAP, _SEEN)
    return named.dropDuplicates(keys).drop(_GAP)
