"""What the plans must look like to hold at scale, and that hot keys stay whole."""

import contextlib
import io
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordertally.functions import decode
from ordertally.operators import (
    archive_current,
    dedup,
    enrich,
    facts_of,
    kpi_current,
    unmatched,
)
from ordertally.operators.combine import drop_near_copies, partial_sums
from ordertally.plans.queries import customers as table_customers
from ordertally.plans.queries import order_messages
from ordertally.plans.totals import totals_from_messages
from ordertally.schemas import ARCHIVE, HISTORY
from ordertally.sources import file_batch, read_archive
from ordertally.streaming.sinks import archive_rows
from tests.helpers import customers, land, order, tuples

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def operators(df):
    """Names of the plan's operators from the result down."""
    found = (re.match(r"[\s:+\-*\d()]*([A-Z]\w+)", line) for line in plan(df).splitlines())
    return [m.group(1) for m in found if m]


@pytest.fixture
def messages(spark, tmp_path):
    land(spark, f"{tmp_path}/landing", order(1, 1, "a"))
    return file_batch(spark, f"{tmp_path}/landing")


def test_text_is_parsed_once(spark, messages):
    for dedup_orders in (False, True):
        text = plan(totals_from_messages(messages, customers(spark), dedup_orders))
        assert text.count("from_json") == 1
    assert plan(enrich(decode(messages), customers(spark))).count("from_json") == 1
    assert plan(archive_rows(messages)).count("from_json") == 1


def test_only_needed_fields_are_parsed(spark, tmp_path):
    land(spark, f"{tmp_path}/landing", order(1, 1, "a"))
    messages = file_batch(spark, f"{tmp_path}/landing", arrival=False)
    text = plan(totals_from_messages(messages, customers(spark)))
    assert set(re.findall(r"StructField\((\w+)", text)) == {"customer_id", "total"}
    assert "ReadSchema: struct<value:binary>" in text


def test_orders_are_not_shuffled_for_a_small_dimension(spark):
    totals = totals_from_messages(
        order_messages(spark, SF_DIR), table_customers(spark, SF_DIR)
    )
    # The one shuffle carries a partial sum per group and task.
    assert operators(totals).count("Exchange") == 1
    names = operators(totals)
    exchange = names.index("Exchange")
    assert names[exchange - 1] == names[exchange + 1] == "HashAggregate"
    assert "partial_sum" in plan(totals)
    assert "row_index" not in plan(totals)


def test_large_dimension_meets_sums_per_customer(spark, messages, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    totals = totals_from_messages(messages, customers(spark), broadcast_bytes=0)
    names = operators(totals)
    assert "SortMergeJoin" in names and "BroadcastHashJoin" not in names
    # Sums by customer, the dimension, sums by group: the join reuses the first.
    assert names.count("Exchange") == 3
    assert names.count("HashAggregate") == 4


def test_dedup_reduces_copies_before_the_shuffle(spark, messages):
    orders = decode(messages, ["order_id", "customer_id", "total"])
    facts = facts_of(orders, "customer_id", "order_id", "origin", "position")
    assert operators(dedup(facts))[1:4] == ["HashAggregate", "Exchange", "HashAggregate"]


def test_current_views_reduce_before_the_shuffle(spark, tmp_path):
    history = spark.createDataFrame([], HISTORY)
    assert "partial_max_by" in plan(kpi_current(history))
    assert "SortAggregate" not in operators(kpi_current(history))
    rows = spark.createDataFrame([(None,) * len(ARCHIVE)], ARCHIVE)
    rows.withColumn("batch_id", F.lit(0)).write.partitionBy("batch_id", "kind").parquet(
        f"{tmp_path}/archive"
    )
    names = operators(archive_current(read_archive(spark, f"{tmp_path}/archive")))
    before = names[names.index("Exchange") + 1 :]
    assert before[0] == "WindowGroupLimit"


def test_archive_scan_skips_the_rejects(spark, tmp_path):
    path = f"{tmp_path}/archive"
    blank = spark.createDataFrame([(None,) * len(ARCHIVE)], ARCHIVE)
    for kind in ("order", "reject"):
        rows = blank.withColumns({"kind": F.lit(kind), "batch_id": F.lit(0)})
        rows.write.mode("append").partitionBy("batch_id", "kind").parquet(path)
    text = plan(read_archive(spark, path).select("order_id"))
    assert re.search(r"PartitionFilters: \[.*kind.*= order", text)
    assert "ReadSchema: struct<order_id:string>" in text


def test_customers_listed_twice_are_not_joined_to_single_orders(spark, messages):
    single = customers(spark, [(1, "a", "b"), (2, "a", "b"), (None, "x", "y"), (None, "x", "y")])
    double = customers(spark, [(1, "a", "b"), (1, "a", "b")])
    assert operators(totals_from_messages(messages, single)).count("Exchange") == 1
    names = operators(totals_from_messages(messages, double))
    join = next(n for n, name in enumerate(names) if name.endswith("Join"))
    # Orders are summed by customer below the join.
    assert "HashAggregate" in names[join:]


# Hot keys: a third of all rows belong to one customer, order or group of copies.


def hot_orders(spark, rows=30_000):
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).otherwise(n % 1000)
    return spark.range(0, rows, numPartitions=8).select(
        key.cast("string").alias("customer_id"),
        F.lit("1.5").alias("total"),
        n.cast("string").alias("order_id"),
        F.repeat(F.lit("x"), 50).alias("padding"),
    )


def thousand_customers(spark):
    return spark.range(1000).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 5).cast("string").alias("source"),
        (F.col("id") % 3).cast("string").alias("state"),
    )


@pytest.mark.parametrize("operator", [enrich, unmatched])
def test_join_splits_a_hot_customer(spark, conf, operator):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__shuffle__partitions="16",
    )
    dimension = thousand_customers(spark)
    if operator is unmatched:
        dimension = dimension.where("customer_id <> 7")
    joined = operator(hot_orders(spark), dimension, broadcast_bytes=0)
    rows = joined.collect()
    expected = 30_000 if operator is enrich else 10_000
    assert len(rows) >= expected
    assert len({row["order_id"] for row in rows}) == len(rows)
    assert "skew=true" in plan(joined)


@pytest.mark.parametrize("operator", [enrich, unmatched])
def test_join_spreads_a_hot_customer_by_salt(spark, conf, operator):
    conf(
        spark__sql__adaptive__enabled="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
    )
    dimension = thousand_customers(spark)
    if operator is unmatched:
        dimension = dimension.where("customer_id <> 7")
    joined = operator(hot_orders(spark), dimension, broadcast_bytes=0, ways=16)
    rows = joined.withColumn("task", F.spark_partition_id()).collect()
    assert len({row["order_id"] for row in rows}) == len(rows) >= 10_000
    hot = Counter(row["task"] for row in rows if row["customer_id"] == 7)
    assert sum(hot.values()) >= 10_000 and max(hot.values()) < 5_000


def test_hot_customer_reaches_the_shuffle_as_partial_sums(spark):
    facts = facts_of(hot_orders(spark), "customer_id")
    folded = partial_sums(facts, "customer_id", "amount")
    hot = folded.where("customer_id = 7")
    assert hot.count() <= 8
    assert facts.where("customer_id = 7").count() >= 10_000
    assert folded.agg(F.sum("amount")).first()[0] == 45_000.0


def test_partial_sums_keep_nulls_apart(spark):
    facts = spark.createDataFrame(
        [(1, None), (1, None), (2, None), (2, 3.0), (None, 1.0), (None, 2.0)],
        "customer_id long, amount double",
    ).coalesce(1)
    assert tuples(partial_sums(facts, "customer_id", "amount")) == [
        (1, None), (2, 3.0), (None, 3.0),
    ]


def test_current_version_of_a_hot_order(spark):
    """A third of the archive are versions of one order."""
    n = F.col("id")
    rows = spark.range(0, 30_000, numPartitions=8).select(
        F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("order_id"),
        n.alias("total"),
        F.lit(0).alias("batch_id"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        n.alias("position"),
        F.lit("t-0").alias("origin"),
    )
    current = archive_current(rows)
    assert current.count() == 20_001
    assert current.where("order_id = 'hot'").first()["total"] == 29_997
    assert current.columns == rows.columns


def test_copies_reach_the_shuffle_as_few_rows(spark):
    copies = spark.range(0, 30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").alias("x"),
        (F.col("id") * 10).alias("y"),
    )
    left = drop_near_copies(copies, ["order_id"])
    assert left.where("order_id = 'a'").count() <= 8
    assert left.where("y <> x * 10").count() == 0
    assert left.select("order_id").distinct().count() == 20_001
