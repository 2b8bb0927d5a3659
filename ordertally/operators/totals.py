"""Sums of order amounts by columns of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertally.functions.values import amount, exact_amount
from ordertally.operators.combine import partial_sums
from ordertally.operators.customers import has_text_key, keyed
from ordertally.operators.sizes import BROADCAST_BYTES, is_small_lookup


# Columns of a join that counts: whether a key was met, and how many facts a row stands for.
_KNOWN, COUNT = "_known", "_orders"


def _sum_by(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    groups: list[str],
    how: str,
    limit: int,
    join_partitions: int | None = None,
    measures: Sequence[str] = ("amount",),
    seed: DataFrame | None = None,
    counted: str | None = None,
) -> DataFrame:
    """`facts(key, measures)` joined to the dimension and summed by its groups.

    A dimension of checked size and single keys is broadcast: the facts are then
    never shuffled, only one partial sum per group and task. Any other is met by
    sums per key, so a key with very many facts reaches the join as a few partial
    sums, and the sums lie where the join needs them.

    `seed` holds sums by group from before, as further rows. `counted` names an
    observation of the facts: how many there are, and how many meet no key.
    """
    text = has_text_key(dimension, key)
    dimension = keyed(dimension, key, text).select(key, *groups)
    if text != has_text_key(facts, key):
        facts = keyed(facts, key, text)
    if counted is not None:
        dimension = dimension.withColumn(_KNOWN, F.lit(True))
        facts = facts.withColumn(COUNT, F.lit(1).cast("bigint"))
    own = [*measures, *([COUNT] if counted is not None else [])]
    kind = "left" if counted is not None else how
    if is_small_lookup(dimension, key, limit):
        joined = facts.join(F.broadcast(dimension), key, kind)
    elif facts.isStreaming:
        if kind == "inner":
            facts = facts.where(F.col(key).isNotNull())
        sums = partial_sums(facts, key, *own)
        if join_partitions is not None:
            sums = sums.repartition(join_partitions, key)
            dimension = dimension.repartition(join_partitions, key)
        joined = sums.join(dimension.hint("merge"), key, kind)
    else:
        sums = facts.groupBy(key).agg(*(F.sum(name).alias(name) for name in own))
        # Without the hint Spark may send sums or dimension to all executors after all.
        joined = sums.join(dimension.hint("merge"), key, kind)
    if counted is not None:
        lost = F.coalesce(F.sum(F.when(F.col(_KNOWN).isNull(), F.col(COUNT))), F.lit(0))
        joined = joined.observe(counted, lost.alias("unmatched"))
        if how == "inner":
            joined = joined.where(F.col(_KNOWN))
    joined = joined.select(*groups, *measures)
    if seed is not None:
        joined = joined.unionByName(seed.select(*groups, *measures))
    return joined.groupBy(*groups).agg(*(F.sum(name).alias(name) for name in measures))


def facts_of(
    orders: DataFrame,
    key: str,
    *others: str,
    text: bool = False,
    exact: bool = False,
    counted: str | None = None,
) -> DataFrame:
    """Decoded orders as (key bigint, or text, amount double, or decimal if `exact`).

    `counted` names an observation of the orders whose total is no amount.
    """
    total = F.col("total")
    value = exact_amount(total) if exact else amount(total)
    if counted is not None:
        strange = F.count_if(total.isNotNull() & value.isNull())
        orders = orders.observe(
            counted, F.count("*").alias("messages"), strange.alias("no_amount")
        )
    facts = orders.select(key, value.alias("amount"), *others)
    return keyed(facts, key, text)


def totals_by_source_state(
    facts: DataFrame,
    customers: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    join_partitions: int | None = None,
    seed: DataFrame | None = None,
    counted: str | None = None,
) -> DataFrame:
    """Sum of `amount` by source and state of the customer; running sums on a stream.

    Orders without a customer do not count. A group of NULL amounts only has a
    NULL sum. `join_partitions` is the width of a stream's join to customers that
    are not broadcast, apart from the number of state partitions. `seed` holds sums
    `source, state, amount` to go on from.
    """
    totals = _sum_by(
        facts,
        customers,
        "customer_id",
        ["source", "state"],
        "inner",
        broadcast_bytes,
        join_partitions,
        seed=seed,
        counted=counted,
    )
    return totals.withColumnRenamed("amount", "total_sum_amount")


def corrected_totals(
    changes: DataFrame,
    customers: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    join_partitions: int | None = None,
) -> DataFrame:
    """Totals out of what was added and taken back: `customer_id, amount, orders, amounts`.

    With the number of orders left in the group: one without orders is no group any more.
    A group whose orders all lack an amount has a NULL sum.
    """
    sums = _sum_by(
        changes,
        customers,
        "customer_id",
        ["source", "state"],
        "inner",
        broadcast_bytes,
        join_partitions,
        ("amount", "orders", "amounts"),
    )
    total = F.when(F.col("amounts") > 0, F.col("amount")).alias("total_sum_amount")
    return sums.select("source", "state", total, "orders")


def totals_by_category(
    facts: DataFrame, products: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sum of `amount` by product category; unknown products form the NULL group."""
    categories = products.select(
        F.col("ID").alias("product_id"), F.col("Category").alias("category")
    )
    totals = _sum_by(facts, categories, "product_id", ["category"], "left", broadcast_bytes)
    return totals.withColumnRenamed("amount", "total_sum_amount")
