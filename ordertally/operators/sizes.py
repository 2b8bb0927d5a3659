"""Which tables are small enough to be sent to every executor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 2**20
ROW_BYTES = 64  # hash table entry, per row


def _bytes(table: DataFrame) -> Column:
    text = [name for name, kind in table.dtypes if kind in ("string", "binary")]
    size = F.count("*") * (ROW_BYTES + 8 * len(table.columns))
    for name in text:
        size = size + F.coalesce(F.sum(F.octet_length(name)), F.lit(0))
    return size


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the table's rows and text; one distributed aggregate, one row back."""
    if limit <= 0:
        return False
    return table.agg((_bytes(table) <= limit).alias("fits")).first()["fits"]


def is_small_lookup(table: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> bool:
    """The same, and no key occurs twice: a join to it gives no more rows than it takes.

    Keys are only compared, which shuffles them, if the size allows a broadcast.
    """
    if not fits_broadcast(table, limit):
        return False
    single = F.count(key) == F.count_distinct(key)
    return table.agg(single.alias("single")).first()["single"]
