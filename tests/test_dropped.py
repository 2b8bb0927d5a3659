"""Orders that must not be lost: text keys, ids that are none; joins that must be taken."""

import pytest

from ordertally.functions.messages import decode, rejects
from ordertally.operators.customers import enrich, unmatched
from ordertally.plans.totals import totals_from_messages
from ordertally.plans.queries import QUERIES
from ordertally.streaming.jobs import wait
from tests.helpers import messages, order, tuples

TEXT = [("C-001", "Google", "TX"), ("C-002", "Twitter", "CA"), ("1.0", "Ad", "NY")]


def named(spark):
    return spark.createDataFrame(TEXT, "customer_id string, source string, state string")


def test_text_keys(spark, ansi):
    sent = messages(spark, order(5, "C-001"), order(2, " C-001 "), order(1, 1), order(3, "1e0"))
    totals = totals_from_messages(sent, named(spark))
    assert tuples(totals) == [("Ad", "NY", 4.0), ("Google", "TX", 7.0)]


def test_text_keys_in_joins(spark):
    orders = decode(messages(spark, order(5, "C-001", "a"), order(2, "C-9", "b")))
    assert [r["source"] for r in enrich(orders, named(spark)).collect()] == ["Google"]
    assert [r["order_id"] for r in unmatched(orders, named(spark)).collect()] == ["b"]


@pytest.mark.parametrize("order_id", ["", "  ", '"NaN"'])
def test_ids_that_are_none(spark, order_id):
    raw = '{"order_id": NaN, "total": 5, "customer_id": 1}'
    one = raw if order_id == '"NaN"' else order(5, 1, order_id)
    dimension = spark.createDataFrame([(1, "G", "T")], "customer_id bigint, source string, state string")
    sent = messages(spark, one, one, order(1, 1, "x"), order(1, 1, "x"))
    totals = totals_from_messages(sent, dimension, dedup_orders=True)
    assert tuples(totals) == [("G", "T", 11.0)]
    assert [r["reason"] for r in rejects(sent).collect()] == ["no order_id"] * 2


def test_an_id_that_reads_like_a_missing_number(spark, ansi):
    """Text is an id, whatever it says; the copies of this one count once."""
    one = r'{"order_id": "\"NaN\"", "total": 5, "customer_id": 1}'
    dimension = spark.createDataFrame([(1, "G", "T")], "customer_id bigint, source string, state string")
    sent = messages(spark, one, one)
    assert tuples(totals_from_messages(sent, dimension, dedup_orders=True)) == [("G", "T", 5.0)]
    assert rejects(sent).count() == 0


@pytest.mark.parametrize(
    "name",
    [
        "kpi_large_dimension",
        "kpi_by_product_large_dimension",
        "enriched_orders_large_dimension",
        "enriched_orders_spread",
        "unmatched_orders_large_dimension",
        "unmatched_orders_spread",
    ],
)
def test_large_way_shuffles_with_default_settings(spark, name):
    result = QUERIES[name](spark, "/root/testdata/sf0.01")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "SortMergeJoin" in plan
    # The customers themselves are put together from two tables; no order is broadcast.
    for part in plan.split("BroadcastExchange")[1:]:
        assert "o_orderkey" not in part.split("Exchange")[0]


def test_wait_raises_what_has_failed_before(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)

    def fail(batch, batch_id):
        raise ValueError("refused")

    query = (
        spark.readStream.schema("id bigint")
        .parquet(path)
        .writeStream.foreachBatch(fail)
        .option("checkpointLocation", str(tmp_path / "c"))
        .start()
    )
    with pytest.raises(Exception, match="refused"):
        query.awaitTermination()
    with pytest.raises(Exception, match="refused"):
        wait(spark, [query])
