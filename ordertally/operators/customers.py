"""Orders against the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.functions.values import customer_key, text_key
from ordertally.operators.sizes import BROADCAST_BYTES, fits_broadcast


def has_text_key(dimension: DataFrame, key: str = "customer_id") -> bool:
    return isinstance(dimension.schema[key].dataType, T.StringType)


def keyed(table: DataFrame, key: str = "customer_id", text: bool = False) -> DataFrame:
    """The table with its key as bigint, integer keys left alone; or as text, so that keys
    which are no numbers, or too long for a bigint, meet as well."""
    kind = table.schema[key].dataType
    if text:
        return table.withColumn(key, text_key(F.col(key).cast("string")))
    if isinstance(kind, T.LongType):
        return table
    if isinstance(kind, T.IntegralType):
        return table.withColumn(key, F.col(key).cast("bigint"))
    return table.withColumn(key, customer_key(F.col(key).cast("string")))


_SALT = "_salt"


def _join(orders: DataFrame, table: DataFrame, how: str, limit: int, ways: int) -> DataFrame:
    if fits_broadcast(table, limit):
        return orders.join(F.broadcast(table), "customer_id", how)
    if ways == 1:
        return orders.join(table.hint("merge"), "customer_id", how)
    # By content, not at random, so that a task that runs again sends rows the same way.
    salt = F.pmod(F.xxhash64(*orders.columns), F.lit(ways).cast("bigint"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(ways - 1).cast("bigint"))
    salted = orders.withColumn(_SALT, salt)
    copies = table.withColumn(_SALT, F.explode(every))
    return salted.join(copies.hint("merge"), ["customer_id", _SALT], how).drop(_SALT)


def enrich(
    orders: DataFrame,
    customers: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    ways: int = 1,
) -> DataFrame:
    """Orders with the columns of their customer; orders without one drop out.

    A customer listed twice gives two rows. Where the customers' key is text, numbers meet
    in their shortest form and other keys as they are. Beyond `broadcast_bytes` both sides
    are shuffled, and adaptive execution splits a customer with very many orders.
    Where it is not at work, as in streams, `ways` splits the orders of each
    customer, at the price of as many copies of the customers.
    """
    text = has_text_key(customers)
    orders, customers = keyed(orders, text=text), keyed(customers, text=text)
    return _join(orders, customers, "inner", broadcast_bytes, ways)


def unmatched(
    orders: DataFrame,
    customers: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    ways: int = 1,
) -> DataFrame:
    """The orders `enrich` drops, those without a usable key included."""
    text = has_text_key(customers)
    known = keyed(customers, text=text).select("customer_id")
    return _join(keyed(orders, text=text), known, "left_anti", broadcast_bytes, ways)
