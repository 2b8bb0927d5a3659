"""From messages to totals, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ordertally.functions.messages import decode
from ordertally.operators.copies import dedup
from ordertally.operators.customers import has_text_key
from ordertally.operators.sizes import BROADCAST_BYTES
from ordertally.operators.totals import facts_of, totals_by_source_state

# Names of the observations of a query that counts what it leaves out: messages and those
# whose total is no amount; orders (after `dedup`, those with a customer's key) that no
# customer was found for.
DECODED, MATCHED = "decoded", "matched"


def totals_from_messages(
    messages: DataFrame,
    customers: DataFrame,
    dedup_orders: bool = False,
    within: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    join_partitions: int | None = None,
    exact: bool = False,
    seed: DataFrame | None = None,
    counted: bool = False,
) -> DataFrame:
    """Sum of order totals by source and state of the customer.

    `exact` adds up decimals, whose sum does not depend on their order. `seed` holds
    sums to go on from. `counted` observes what does not count: `DECODED`, `MATCHED`.
    """
    text = has_text_key(customers)
    told = {"text": text, "exact": exact, "counted": DECODED if counted else None}
    if dedup_orders:
        orders = decode(messages, ["order_id", "customer_id", "total"])
        facts = facts_of(orders, "customer_id", "order_id", "origin", "position", **told)
        # Messages that cannot count must not fill the shuffle and the state.
        facts = dedup(facts.where("customer_id IS NOT NULL"), within)
    else:
        facts = facts_of(decode(messages, ["customer_id", "total"]), "customer_id", **told)
    return totals_by_source_state(
        facts, customers, broadcast_bytes, join_partitions, seed, MATCHED if counted else None
    )
