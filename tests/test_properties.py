"""Invariants over random messages, many per Spark job."""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordertally.functions import decode, screen
from ordertally.operators import enrich, facts_of, unmatched
from ordertally.plans.totals import totals_from_messages
from tests.helpers import customers, messages, tuples

SHOPPERS = {1: ("Google", "TX"), 2: ("Twitter", "CA"), 3: ("Google", "TX"), 4: (None, "NY")}

scalars = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-5, 10),
    st.floats(-100, 100),
    st.sampled_from([math.nan, math.inf, "1", "1.0", " 2 ", "3e0", "x", "", "é", '"', "\\"]),
    st.text(max_size=5),
)
noise = st.one_of(
    st.text(max_size=20),
    st.sampled_from(["[]", "{}", "null", "5", '"x"', '{"order_id": 1', "[{}]", "{'a': 1}"]),
)
orders = st.fixed_dictionaries(
    {}, optional={"order_id": scalars, "total": scalars, "customer_id": scalars, "other": scalars}
).map(json.dumps)
several = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def dimension(spark):
    return customers(spark, [(key, *groups) for key, groups in SHOPPERS.items()])


@several
@given(st.lists(st.one_of(orders, noise), min_size=50, max_size=200))
def test_every_message_is_accepted_or_rejected_once(spark, ansi, texts):
    screened = screen(messages(spark, *texts)).select("position", "reason", "order_id").collect()
    assert sorted(row["position"] for row in screened) == list(range(len(texts)))
    assert all((row["reason"] is None) == (row["order_id"] is not None) for row in screened)


@several
@given(st.lists(st.one_of(orders, noise), min_size=50, max_size=200))
def test_every_order_has_a_customer_or_none(spark, ansi, texts):
    decoded = decode(messages(spark, *texts))
    found = enrich(decoded, dimension(spark)).select("position")
    lost = unmatched(decoded, dimension(spark)).select("position")
    positions = sorted(row["position"] for row in found.union(lost).collect())
    assert positions == list(range(len(texts)))


def as_number(value):
    """What the rules make of a JSON scalar; None if it is no finite number."""
    if value is None or isinstance(value, bool):
        return None
    number = float(value)
    return number if math.isfinite(number) else None


plain = st.one_of(st.none(), st.integers(0, 6), st.sampled_from(["1", "2.0", " 3 ", "4e0"]))
amounts = st.one_of(
    st.none(), st.integers(-9, 9), st.sampled_from([0.5, math.nan, math.inf, "2.5", " 1 "])
)


@several
@given(st.lists(st.tuples(plain, amounts), min_size=50, max_size=200))
def test_totals_by_hand(spark, ansi, rows):
    texts = [json.dumps({"customer_id": c, "total": t}) for c, t in rows]
    expected = {}
    for customer, total in rows:
        key = as_number(customer)
        if key in SHOPPERS:
            group, value = SHOPPERS[key], as_number(total)
            before = expected.setdefault(group, None)
            if value is not None:
                expected[group] = (before or 0.0) + value
    wanted = sorted(((*group, total) for group, total in expected.items()), key=repr)
    stream = messages(spark, *texts)
    for limit in (0, 2**20):
        totals = totals_from_messages(stream, dimension(spark), broadcast_bytes=limit)
        assert tuples(totals) == wanted


def test_amounts_add_up_whatever_the_plan(spark):
    numbers = spark.range(0, 10_000, numPartitions=8).select(
        (F.col("id") % 5).cast("string").alias("customer_id"),
        (F.col("id") % 100).cast("string").alias("total"),
    )
    facts = facts_of(numbers, "customer_id")
    assert facts.agg(F.sum("amount")).first()[0] == sum(n % 100 for n in range(10_000))
