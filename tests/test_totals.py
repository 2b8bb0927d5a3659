import pytest
from pyspark.sql import functions as F

from ordertally.operators import (
    dedup,
    enrich,
    facts_of,
    fits_broadcast,
    totals_by_category,
    unmatched,
)
from ordertally.functions import decode
from ordertally.plans.totals import totals_from_messages
from tests.helpers import CUSTOMER_COLUMNS, customers, messages, order, tuples

GOOGLE, TWITTER, DUP = ("Google", "TX"), ("Twitter", "CA"), ("Dup", "NY")

# (total, customer_id) of each order, then the expected totals
CASES = {
    "fan out": ([(1.5, 1), (2, 2)], [(*DUP, 1.5), (*GOOGLE, 1.5), (*TWITTER, 2.0)]),
    "decimal key": ([(1.5, 1.0)], [(*DUP, 1.5), (*GOOGLE, 1.5)]),
    "text key": ([(1.5, "abc")], []),
    "no key": ([(1.5, None)], []),
    "NaN key": ([(1.5, float("nan"))], []),
    "text total": ([("x", 1), (2, 1)], [(*DUP, 2.0), (*GOOGLE, 2.0)]),
    "NaN total": ([(float("nan"), 1), (2, 1)], [(*DUP, 2.0), (*GOOGLE, 2.0)]),
    "infinite total": ([(float("inf"), 1), (2, 1)], [(*DUP, 2.0), (*GOOGLE, 2.0)]),
    "no total": ([(None, 2)], [(*TWITTER, None)]),
    "blanks": ([(" 3 ", " 2 ")], [(*TWITTER, 3.0)]),
    "unknown key": ([(1, 99)], []),
}


@pytest.mark.parametrize("limit", [0, 2**20], ids=["shuffled", "broadcast"])
@pytest.mark.parametrize("case", CASES)
def test_totals(spark, ansi, case, limit):
    orders, expected = CASES[case]
    stream = messages(spark, *(order(t, c) for t, c in orders))
    totals = totals_from_messages(stream, customers(spark), broadcast_bytes=limit)
    assert tuples(totals) == sorted(expected, key=repr)


def test_unreadable_messages_do_not_count(spark, ansi):
    stream = messages(spark, order(1, 2), "not json", "", None, "[]", '{"total": 1, "cust')
    assert tuples(totals_from_messages(stream, customers(spark))) == [(*TWITTER, 1.0)]


def test_null_source_and_state_are_a_group(spark):
    dimension = customers(spark, [(1, None, None), (2, None, None), (3, "a", None)])
    stream = messages(spark, order(1, 1), order(2, 2), order(4, 3))
    assert tuples(totals_from_messages(stream, dimension)) == [
        ("a", None, 4.0),
        (None, None, 3.0),
    ]


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "double"])
def test_customer_keys_of_any_type(spark, ansi, kind):
    dimension = customers(spark).withColumn("customer_id", F.col("customer_id").cast(kind))
    stream = messages(spark, order(1, 2))
    assert tuples(totals_from_messages(stream, dimension)) == [(*TWITTER, 1.0)]


def test_dedup_counts_an_order_once(spark, ansi):
    stream = messages(
        spark, order(1, 2, "a"), order(1, 2, "a"), order(5, 2, "b"), order(1, 2, "a")
    )
    totals = totals_from_messages(stream, customers(spark), dedup_orders=True)
    assert tuples(totals) == [(*TWITTER, 6.0)]


def test_dedup_keeps_every_order_without_id(spark):
    stream = messages(spark, order(1, 2), order(1, 2), order(1, 2, "a"), order(1, 2, "a"))
    totals = totals_from_messages(stream, customers(spark), dedup_orders=True)
    assert tuples(totals) == [(*TWITTER, 3.0)]


def test_dedup_keeps_whole_rows(spark):
    rows = [("a", n, n * 10, "f", n) for n in range(50)]
    columns = "order_id string, x int, y int, origin string, position long"
    (kept,) = dedup(spark.createDataFrame(rows, columns)).collect()
    assert kept["y"] == kept["x"] * 10


@pytest.mark.parametrize(
    "options",
    [{"broadcast_bytes": 2**20}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "ways": 3}],
    ids=["broadcast", "shuffled", "spread"],
)
def test_enriched_and_unmatched_orders_are_all_orders(spark, ansi, options):
    values = [order(1, 1, "a"), order(1, 2, "b"), order(1, 7, "c"), order(1, "x", "d")]
    orders = decode(messages(spark, *values, order(1, None, "e")))
    dimension = customers(spark)
    found = enrich(orders, dimension, **options)
    assert tuples(found.select("order_id", "state")) == [("a", "NY"), ("a", "TX"), ("b", "CA")]
    lost = unmatched(orders, dimension, **options)
    assert tuples(lost.select("order_id")) == [("c",), ("d",), ("e",)]
    assert found.columns.count("customer_id") == 1


@pytest.mark.parametrize("limit", [0, 2**20], ids=["shuffled", "broadcast"])
def test_totals_by_category(spark, limit):
    products = spark.createDataFrame([(1, "Gizmo"), (2, "Widget")], "ID int, Category string")
    lines = [(1, 10), (1, 5), (2, 1), (3, 7), (None, 2)]
    orders = spark.createDataFrame(
        [(None if p is None else str(p), str(t)) for p, t in lines],
        "product_id string, total string",
    )
    totals = totals_by_category(facts_of(orders, "product_id"), products, limit)
    assert tuples(totals) == [("Gizmo", 15.0), ("Widget", 1.0), (None, 9.0)]


def test_fits_broadcast(spark):
    small = customers(spark)
    assert fits_broadcast(small)
    assert not fits_broadcast(small, 0)
    assert not fits_broadcast(small, 100)
    assert fits_broadcast(spark.createDataFrame([], CUSTOMER_COLUMNS), 1)
    # The text is measured, not guessed from the number of rows.
    wide = spark.range(1).select(F.repeat(F.lit("é"), 1000).alias("t"))
    assert not fits_broadcast(wide, 2000)
    assert fits_broadcast(wide, 2100)
