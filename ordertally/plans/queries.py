"""The package's operators over the driver's tables, one query each.

The `orders` table plays the message stream: its rows are encoded as JSON order
messages and then treated as if they had come from a topic.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.functions.messages import decode, encode
from ordertally.functions.values import exact_amount
from ordertally.operators.current import archive_current as current_orders
from ordertally.operators.current import corrected_current, kpi_current
from ordertally.operators.current_table import read_current
from ordertally.operators.customers import enrich, unmatched
from ordertally.operators.totals import corrected_totals, facts_of, totals_by_category
from ordertally.operators.versions import restated, valid_at
from ordertally.plans.handover import backfill_for_stream
from ordertally.plans.jobs import (
    backfill_totals,
    compact_history,
    current_totals,
    publish_files,
    publish_orders_csv,
)
from ordertally.plans.totals import totals_from_messages
from ordertally.plans.workspace import new_workspace
from ordertally.schemas import CORRECTED, ORDER_FIELDS
from ordertally.settings import Landing, Settings
from ordertally.sources.messages import file_batch, file_stream
from ordertally.sources.tables import (
    read_archive,
    read_customers,
    read_history,
    read_orders_csv,
    read_products,
    read_rejects,
)
from ordertally.streaming.corrections import keyed_changes, last_versions
from ordertally.streaming.jobs import (
    dropped,
    run,
    start_archive,
    start_corrections,
    start_totals,
    wait,
)
from ordertally.streaming.state import carry_over, totals_state
from ordertally.streaming.waiting import start_waiting

Query = Callable[[SparkSession, str], DataFrame]

# Dates that cut the orders into four landings; both ends are open.
CUTS = ("1996-09-01", "1998-05-01", "2000-01-01")

# Seconds that orders are spread over where they meet the versions of customers.
FIRST_SECOND, SECONDS = 1704067207, 2591825


def identity() -> list[Column]:
    """Which message a row is, for the queries that need to know."""
    return [
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.row_index").alias("position"),
    ]


def table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if stream:
        # As a glob, since a stream takes no path of a single file. A micro-batch is
        # bounded, so that one that fails does not start over on the whole table.
        reader = spark.readStream.schema(rows.schema).option("maxBytesPerTrigger", 2**40)
        rows = reader.parquet(f"{sf_dir}/{{{name}}}.parquet")
    return rows


def order_rows(
    spark: SparkSession, sf_dir: str, stream: bool = False, arrival: bool = False
) -> DataFrame:
    return table(spark, sf_dir, "orders", stream).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("total"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
        *(identity() if arrival else []),
    )


def order_messages(
    spark: SparkSession, sf_dir: str, stream: bool = False, arrival: bool = False
) -> DataFrame:
    return encode(order_rows(spark, sf_dir, stream, arrival))


def event_messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events", stream).select(
        F.col("event_id").alias("order_id"),
        F.col("value").alias("total"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
    )
    return encode(events)


def mixed_messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Orders among texts that are no orders."""
    messages = order_messages(spark, sf_dir, stream, arrival=True)
    for name in ("documents", "conversations"):
        stray = table(spark, sf_dir, name, stream).select(
            F.col("text").cast("binary").alias("value"),
            F.lit("2000-01-01").cast("timestamp").alias("timestamp"),
            *identity(),
        )
        messages = messages.unionByName(stray)
    return messages


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("source"),
        F.col("n_name").alias("state"),
    )


def customers_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = table(spark, sf_dir, "customer")
    return customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("source"),
        F.col("r_name").alias("state"),
    )


def solvent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that misses some customers: those in debt."""
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return solvent.select(F.col("c_custkey").alias("customer_id"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as orders with all nine fields; the supplier plays the customer."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_discount").alias("discount"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_tax").alias("tax"),
        (F.col("l_extendedprice") + F.col("l_tax")).alias("total"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_shipdate").alias("timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("ID"), F.col("p_brand").alias("Category"))


def cents(column: str) -> Column:
    """Sums of doubles depend on their order; compare them to the cent."""
    return F.round(column, 2).alias(column)


def rounded(totals: DataFrame) -> DataFrame:
    return totals.withColumn("total_sum_amount", cents("total_sum_amount"))


def typed(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("created_at").cast("date").cast("string").alias("created_at"),
        F.col("total").cast("double").alias("total"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
    )


def job(work: str, **options) -> Settings:
    """Settings of a stream that takes what is there and ends."""
    return Settings(
        checkpoint_root=f"{work}/checkpoints",
        archive_path=f"{work}/archive",
        history_path=f"{work}/history",
        trigger=None,
        **options,
    )


def run_totals(
    spark: SparkSession, messages: DataFrame, dimension: DataFrame, settings: Settings
) -> DataFrame:
    start_totals(messages, dimension, settings).awaitTermination()
    return read_history(spark, settings.history_path)


# Totals, batch


def kpi_by_source_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = order_messages(spark, sf_dir)
    return rounded(totals_from_messages(messages, customers(spark, sf_dir)))


def kpi_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the way taken when the customers are too many to broadcast."""
    messages = order_messages(spark, sf_dir)
    dimension = customers(spark, sf_dir)
    return rounded(totals_from_messages(messages, dimension, broadcast_bytes=0))


def kpi_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice, counted once."""
    messages = order_messages(spark, sf_dir, arrival=True)
    doubled = messages.unionByName(messages)
    return rounded(totals_from_messages(doubled, customers(spark, sf_dir), dedup_orders=True))


def kpi_untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys written as decimals, amounts padded with blanks, NaN or words."""
    padded = F.format_string("  %s ", F.col("o_totalprice").cast("string"))
    status = F.col("o_orderstatus")
    text = F.when(status == "P", "NaN").when(status == "F", "unknown").otherwise(padded)
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        text.alias("total"),
        F.col("o_custkey").cast("double").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
    )
    return rounded(totals_from_messages(encode(rows), customers(spark, sf_dir)))


def kpi_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose keys are no numbers."""
    name = F.concat(F.lit("C-"), F.col("customer_id")).alias("customer_id")
    orders = order_rows(spark, sf_dir).select("order_id", "total", name, "timestamp")
    named = customers(spark, sf_dir).select(name, "source", "state")
    return rounded(totals_from_messages(encode(orders), named))


def _missing_ids(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Orders of one status once, with ids that are none; the others delivered twice."""
    rows = table(spark, sf_dir, "orders", stream)
    key = F.col("o_orderkey")
    none = F.when(key % 3 == 0, "").when(key % 3 == 1, "  ")
    order_id = F.when(F.col("o_orderstatus") == "F", none).otherwise(key.cast("string"))
    messages = encode(
        rows.select(
            order_id.alias("order_id"),
            F.col("o_totalprice").alias("total"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("timestamp"),
            *identity(),
            "o_orderstatus",
        )
    )
    with_id = F.get_json_object(F.col("value").cast("string"), "$.order_id")
    again = messages.where(F.coalesce(F.trim(with_id) != "", F.lit(False)))
    return messages.unionByName(again)


def kpi_dedup_missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a usable id are all counted, copies of the others once."""
    messages = _missing_ids(spark, sf_dir)
    return rounded(totals_from_messages(messages, customers(spark, sf_dir), dedup_orders=True))


def kpi_mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts among the orders do not count."""
    messages = mixed_messages(spark, sf_dir)
    return rounded(totals_from_messages(messages, customers(spark, sf_dir)))


def kpi_customers_listed_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation and again by region: an order counts in both groups."""
    twice = customers(spark, sf_dir).unionByName(customers_by_region(spark, sf_dir))
    return rounded(totals_from_messages(order_messages(spark, sf_dir), twice))


def unrounded(totals: DataFrame) -> DataFrame:
    return totals.withColumn("total_sum_amount", F.col("total_sum_amount").cast("double"))


def kpi_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of decimals, compared to the last digit."""
    messages, dimension = order_messages(spark, sf_dir), customers(spark, sf_dir)
    return unrounded(totals_from_messages(messages, dimension, exact=True))


def kpi_exact_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, dimension = order_messages(spark, sf_dir), customers(spark, sf_dir)
    return unrounded(totals_from_messages(messages, dimension, broadcast_bytes=0, exact=True))


def events_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    return rounded(totals_from_messages(messages, customers(spark, sf_dir)))


def kpi_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published messages and a customer file, rebuilt into a history."""
    work = new_workspace(spark)
    publish_files(order_messages(spark, sf_dir), f"{work}/landing")
    customers(spark, sf_dir).write.csv(f"{work}/customers", header=True)
    landing = Landing(f"{work}/landing")
    backfill_totals(spark, landing, f"{work}/customers", f"{work}/history")
    return rounded(kpi_current(read_history(spark, f"{work}/history")))


def _by_product(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    sold = lines(spark, sf_dir).select("product_id", F.col("subtotal").alias("total"), "timestamp")
    facts = facts_of(decode(encode(sold), ["product_id", "total"]), "product_id")
    return rounded(totals_by_category(facts, products(spark, sf_dir), **options))


def kpi_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_product(spark, sf_dir)


def kpi_by_product_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_product(spark, sf_dir, broadcast_bytes=0)


# Totals, stream


def kpi_stream_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = order_messages(spark, sf_dir, stream=True)
    settings = job(new_workspace(spark))
    history = run_totals(spark, messages, customers(spark, sf_dir), settings)
    return rounded(kpi_current(history))


def kpi_stream_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = order_messages(spark, sf_dir, stream=True)
    settings = job(new_workspace(spark), broadcast_bytes=0)
    history = run_totals(spark, messages, customers(spark, sf_dir), settings)
    return rounded(kpi_current(history))


def kpi_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = order_messages(spark, sf_dir, stream=True, arrival=True)
    settings = job(new_workspace(spark), dedup=True)
    doubled = messages.unionByName(messages)
    history = run_totals(spark, doubled, customers(spark, sf_dir), settings)
    return rounded(kpi_current(history))


def events_kpi_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir, stream=True)
    settings = job(new_workspace(spark))
    history = run_totals(spark, messages, customers(spark, sf_dir), settings)
    return rounded(kpi_current(history))


def _land(orders: DataFrame, landing: str, part: int) -> None:
    if part > 0:
        orders = orders.where(F.col("created_at") >= F.lit(CUTS[part - 1]).cast("timestamp_ntz"))
    if part < len(CUTS):
        orders = orders.where(F.col("created_at") < F.lit(CUTS[part]).cast("timestamp_ntz"))
    publish_files(encode(orders), landing)


def kpi_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four landings, each read by a new start of the stream on the same checkpoint."""
    work = new_workspace(spark)
    landing = f"{work}/landing"
    settings = job(work)
    dimension = customers(spark, sf_dir)
    for part in range(len(CUTS) + 1):
        _land(order_rows(spark, sf_dir), landing, part)
        messages = file_stream(spark, Landing(landing), arrival=False)
        run_totals(spark, messages, dimension, settings)
    history = read_history(spark, settings.history_path)
    return rounded(history.drop("processed_at"))


def kpi_stream_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of decimals over four landings are those of one batch, to the last digit."""
    work = new_workspace(spark)
    settings = job(work, exact=True, broadcast_bytes=0)
    for part in range(len(CUTS) + 1):
        _land(order_rows(spark, sf_dir), f"{work}/landing", part)
    limited = Landing(f"{work}/landing", max_files_per_trigger=2)
    messages = file_stream(spark, limited, arrival=False)
    return kpi_current(run_totals(spark, messages, customers(spark, sf_dir), settings))


def kpi_backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings by a backfill, two more by the stream that goes on where it ended."""
    work = new_workspace(spark)
    landing, dimension = f"{work}/landing", customers(spark, sf_dir)
    settings = job(work, handover_path=f"{work}/handover", source=Landing(landing), exact=True)
    for part in range(len(CUTS) + 1):
        _land(order_rows(spark, sf_dir), landing, part)
        if part == 1:
            backfill_for_stream(spark, settings, dimension)
        elif part > 1:
            start_totals(file_stream(spark, settings.source), dimension, settings).awaitTermination()
    return kpi_current(read_history(spark, settings.history_path))


def _state_job(spark: SparkSession, sf_dir: str, parts: Sequence[int]) -> Settings:
    """A job that has read some landings, a batch for each, with sums in four partitions."""
    work = new_workspace(spark)
    settings = job(work, source=Landing(f"{work}/landing"), exact=True, state_partitions=4)
    for part in parts:
        _land(order_rows(spark, sf_dir), settings.source.path, part)
        messages = file_stream(spark, settings.source)
        start_totals(messages, customers(spark, sf_dir), settings).awaitTermination()
    return settings


def kpi_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running sums as they lie in the checkpoint of a job that has ended."""
    sums = totals_state(spark, _state_job(spark, sf_dir, range(len(CUTS) + 1)))
    return sums.select("source", "state", F.col("amount").cast("double").alias("total_sum_amount"))


def kpi_state_carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings with four state partitions, the rest by a job that goes on with sixteen."""
    before = _state_job(spark, sf_dir, (0, 1))
    work = new_workspace(spark)
    wider = replace(
        before,
        state_partitions=16,
        totals_checkpoint=f"{work}/totals",
        handover_path=f"{work}/handover",
        history_path=f"{work}/history",
    )
    carry_over(spark, before, wider)
    for part in range(2, len(CUTS) + 1):
        _land(order_rows(spark, sf_dir), wider.source.path, part)
        messages = file_stream(spark, wider.source)
        start_totals(messages, customers(spark, sf_dir), wider).awaitTermination()
    return kpi_current(read_history(spark, wider.history_path))


def _versions_of_orders(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """All orders; later versions of the urgent ones; of those in progress later ones still, for
    other customers; and versions of some, older than all these, that are delivered last."""
    rows = table(spark, sf_dir, "orders")

    def version(kept: Column | None, total: Column, customer: Column, days: int) -> DataFrame:
        at = (F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAYS")).alias("timestamp")
        some = rows if kept is None else rows.where(kept)
        return some.select(
            F.col("o_orderkey").alias("order_id"), total.alias("total"), customer.alias("customer_id"), at
        )

    total, customer = F.col("o_totalprice"), F.col("o_custkey")
    return [
        version(None, total, customer, 0),
        version(F.col("o_orderpriority") == "1-URGENT", total + 1, customer, 1),
        version(F.col("o_orderstatus") == "P", total * 2, customer % 100 + 1, 2),
        version(F.col("o_orderpriority") != "5-LOW", F.lit(0.0), customer, -1),
    ]


def kpi_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that come again with other amounts and customers; the last version counts."""
    work = new_workspace(spark)
    landing, dimension = f"{work}/landing", customers(spark, sf_dir)
    settings = job(work, corrections_path=f"{work}/changes", broadcast_bytes=0)
    deliveries = _versions_of_orders(spark, sf_dir)
    for some in (deliveries[:2], deliveries[2:]):
        for delivery in some:
            publish_files(encode(delivery), landing)
        messages = file_stream(spark, Landing(landing))
        wait(spark, start_corrections(messages, dimension, settings))
    return corrected_current(read_history(spark, settings.history_path, CORRECTED))


def kpi_last_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one batch."""
    work, dimension = new_workspace(spark), customers(spark, sf_dir)
    for delivery in _versions_of_orders(spark, sf_dir):
        publish_files(encode(delivery), f"{work}/landing")
    rows = last_versions(file_batch(spark, f"{work}/landing"))
    return unrounded(corrected_totals(keyed_changes(rows, dimension), dimension).drop("orders"))


def kpi_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before and after their customers, of whom some in debt never come."""
    work = new_workspace(spark)
    settings, landing = job(work), f"{work}/landing"
    solvent = solvent_customers(spark, sf_dir)
    known = customers(spark, sf_dir).select(F.col("customer_id").cast("string"), "source", "state")
    later = known.join(solvent, "customer_id", "left_anti").where("customer_id % 2 = 0")
    arrivals = (known.join(solvent, "customer_id", "left_semi"), later)
    for part, arrival in enumerate(arrivals):
        for one in (2 * part, 2 * part + 1):
            _land(order_rows(spark, sf_dir), landing, one)
        arrival.write.mode("append").parquet(f"{work}/customers")
        messages = file_stream(spark, Landing(landing), arrival=False)
        entries = spark.readStream.schema(known.schema).parquet(f"{work}/customers")
        queries = start_waiting(messages, entries, f"{work}/waited", settings, "1 DAY", ways=4)
        wait(spark, queries)
    return kpi_current(read_history(spark, settings.history_path))


def kpi_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job as it is set up in production: files of messages and customers, both queries."""
    work = new_workspace(spark)
    publish_files(order_messages(spark, sf_dir), f"{work}/landing")
    customers(spark, sf_dir).write.csv(f"{work}/customers", header=True)
    settings = job(work, source=Landing(f"{work}/landing"), customers_path=f"{work}/customers")
    wait(spark, run(spark, settings))
    totals = kpi_current(read_history(spark, settings.history_path))
    archived = read_archive(spark, settings.archive_path).agg(F.count("*").alias("archived"))
    return rounded(totals).join(F.broadcast(archived))


def _counts(spark: SparkSession, queries: list) -> DataFrame:
    sums: dict = {}
    for query in queries:
        for progress in query.recentProgress:
            for what, count in dropped(progress).items():
                sums[query.name, what] = sums.get((query.name, what), 0) + count
    rows = [(*names, count) for names, count in sums.items()]
    return spark.createDataFrame(rows, "query string, what string, messages bigint")


def dropped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What archive and totals leave out of orders, texts and orders without an amount or a
    known customer, as the queries themselves count it."""
    work = new_workspace(spark)
    known = customers(spark, sf_dir).join(solvent_customers(spark, sf_dir), "customer_id")
    padded = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_totalprice").cast("string"))
    rows = table(spark, sf_dir, "orders", stream=True).select(
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("order_id"),
        padded.alias("total"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
        *identity(),
    )
    texts = table(spark, sf_dir, "documents", stream=True).select(
        F.col("text").cast("binary").alias("value"),
        F.lit("2000-01-01").cast("timestamp").alias("timestamp"),
        *identity(),
    )
    messages = encode(rows).unionByName(texts)
    settings = job(work, counted=True)
    queries = [start_archive(messages, settings), start_totals(messages, known, settings)]
    wait(spark, queries)
    return _counts(spark, queries)


# Customers that change


def _customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's events as versions: the kind of the last one is the source."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.col("user_id").alias("customer_id"), F.col("ts").cast("timestamp").alias("valid_from")
    ).agg(
        F.max("event_type").alias("source"),
        F.concat(F.lit("day "), F.dayofmonth("valid_from").cast("string")).alias("state"),
    )


def _timed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders spread over the time of the events."""
    at = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.col("order_id") * 7919 % SECONDS)
    rows = order_rows(spark, sf_dir).withColumn("timestamp", at)
    orders = decode(encode(rows), ["order_id", "customer_id", "total"])
    return orders.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "customer_id",
        exact_amount(F.col("total")).alias("amount"),
        "timestamp",
    )


def orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with the version of its customer that was valid at its time, if any."""
    versions = _customer_versions(spark, sf_dir)
    found = valid_at(_timed_orders(spark, sf_dir), versions, new_workspace(spark), partitions=16)
    return found.select("order_id", "source", "state")


def kpi_as_of_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by versions, some of which became known late and are restated."""
    work = new_workspace(spark)
    versions, orders = _customer_versions(spark, sf_dir), _timed_orders(spark, sf_dir)
    late = versions.where("source = 'purchase' OR customer_id % 5 = 0")
    known = versions.where("source <> 'purchase' AND customer_id % 5 <> 0")
    met = valid_at(orders, known, f"{work}/known", how="inner")
    before = met.groupBy("source", "state").agg(
        F.sum("amount").alias("amount"), F.count("*").alias("orders")
    )
    changes = restated(orders, known, late, f"{work}/late")
    sums = before.unionByName(changes).groupBy("source", "state").agg(
        F.sum("amount").alias("total_sum_amount"), F.sum("orders").alias("orders")
    )
    return unrounded(sums.where("orders > 0"))


# Messages


def decoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(decode(order_messages(spark, sf_dir)))


def decoded_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine fields there and back."""
    orders = decode(encode(lines(spark, sf_dir)))
    numbers = ["discount", "quantity", "subtotal", "tax", "total"]
    return orders.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("created_at").cast("date").cast("string").alias("created_at"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        *(F.col(name).cast("double").alias(name) for name in numbers),
    )


def decode_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("props").cast("binary").alias("value"), "event_id"
    )
    props = decode(events, ["k"], keep=["event_id"])
    return props.select("event_id", F.col("k").cast("int").alias("k"))


def orders_csv_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders file to messages in a landing directory and back."""
    work = new_workspace(spark)
    rows = order_rows(spark, sf_dir)
    full = [F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in ORDER_FIELDS]
    texts = rows.select(*(c.cast("string") for c in full))
    texts.write.csv(f"{work}/orders", header=True)
    publish_orders_csv(spark, f"{work}/orders", f"{work}/landing")
    return typed(decode(file_batch(spark, f"{work}/landing")))


def orders_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark)
    lines(spark, sf_dir).drop("timestamp").write.csv(f"{work}/orders", header=True)
    orders = read_orders_csv(spark, f"{work}/orders")
    return orders.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("quantity").cast("double").alias("quantity"),
        F.col("tax").cast("double").alias("tax"),
    )


def customers_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = new_workspace(spark)
    customers(spark, sf_dir).write.csv(f"{work}/customers", header=True)
    found = read_customers(spark, f"{work}/customers")
    return found.withColumn("customer_id", F.col("customer_id").cast("bigint"))


def products_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with leading zeros and text with commas survive the file."""
    work = new_workspace(spark)
    table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID"),
        F.col("p_brand").alias("Category"),
        F.lit("2000-01-01T00:00:00.000+05:30").alias("Created At"),
        F.lpad(F.col("p_partkey").cast("string"), 13, "0").alias("Ean"),
        F.col("p_retailprice").alias("Price"),
        F.col("p_size").cast("double").alias("Rating"),
        F.col("p_name").alias("Title"),
        F.concat_ws(", ", "p_type", "p_brand").alias("Vendor"),
    ).write.csv(f"{work}/products", header=True)
    return read_products(spark, f"{work}/products").select(
        F.col("ID").alias("id"),
        F.col("Category").alias("category"),
        F.col("Ean").alias("ean"),
        F.col("Price").alias("price"),
        F.col("Rating").alias("rating"),
        F.col("Title").alias("title"),
        F.col("Vendor").alias("vendor"),
    )


# Join


def _enriched(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    orders = decode(order_messages(spark, sf_dir), ["order_id", "customer_id"])
    joined = enrich(orders, customers(spark, sf_dir), **options)
    return joined.select(F.col("order_id").cast("bigint").alias("order_id"), "source", "state")


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


def enriched_orders_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, broadcast_bytes=0)


def enriched_orders_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each customer split among several tasks."""
    return _enriched(spark, sf_dir, broadcast_bytes=0, ways=4)


def _unmatched(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    orders = decode(order_messages(spark, sf_dir), ["order_id", "customer_id"])
    lost = unmatched(orders, solvent_customers(spark, sf_dir), **options)
    return lost.select(F.col("order_id").cast("bigint").alias("order_id"))


def unmatched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unmatched(spark, sf_dir)


def unmatched_orders_large_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unmatched(spark, sf_dir, broadcast_bytes=0)


def unmatched_orders_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unmatched(spark, sf_dir, broadcast_bytes=0, ways=4)


# Archive


def _archived(spark: SparkSession, sf_dir: str) -> str:
    settings = job(new_workspace(spark))
    start_archive(mixed_messages(spark, sf_dir, stream=True), settings).awaitTermination()
    return settings.archive_path


def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(read_archive(spark, _archived(spark, sf_dir)))


def rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = read_rejects(spark, _archived(spark, sf_dir))
    return refused.select(F.col("value").cast("string").alias("text"), "reason")


def rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream refuses of orders without usable ids, some numbers among them, and texts."""
    lost = table(spark, sf_dir, "orders", stream=True).where("o_orderstatus = 'F'")
    bare = F.concat(
        F.lit('{"order_id": '),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("NaN")).otherwise(F.lit('" "')),
        F.lit(', "customer_id": '),
        F.col("o_custkey").cast("string"),
        F.lit("}"),
    )
    unnamed = lost.select(
        bare.cast("binary").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        *identity(),
    )
    settings = job(new_workspace(spark))
    messages = mixed_messages(spark, sf_dir, stream=True).unionByName(unnamed)
    start_archive(messages, settings).awaitTermination()
    refused = read_rejects(spark, settings.archive_path)
    named = decode(refused, ["customer_id"], keep=["reason"])
    customer = F.col("customer_id").try_cast("bigint").alias("customer_id")
    return named.groupBy("reason", customer).agg(F.count("*").alias("messages"))


def _corrected_archive(spark: SparkSession, sf_dir: str, **options) -> Settings:
    """All orders, then corrections of some, into an archive."""
    work = new_workspace(spark)
    landing = f"{work}/landing"
    settings = job(work, **{name: f"{work}/{path}" for name, path in options.items()})
    rows = order_rows(spark, sf_dir)
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_totalprice") + 1).alias("total"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
    )
    for delivery in (rows, urgent):
        publish_files(encode(delivery), landing)
        stream = file_stream(spark, Landing(landing))
        start_archive(stream, settings).awaitTermination()
    return settings


def archive_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then corrections of some: the corrections win."""
    settings = _corrected_archive(spark, sf_dir)
    current = current_orders(read_archive(spark, settings.archive_path))
    return typed(current).withColumn("total", cents("total"))


def archive_current_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table that the stream keeps."""
    settings = _corrected_archive(spark, sf_dir, current_path="current")
    return typed(read_current(spark, settings.current_path)).withColumn("total", cents("total"))


def kpi_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four landings, with a compaction of the history after the second and third."""
    work = new_workspace(spark)
    landing, dimension = f"{work}/landing", customers(spark, sf_dir)
    settings = job(work, exact=True)
    for part in range(len(CUTS) + 1):
        _land(order_rows(spark, sf_dir), landing, part)
        run_totals(spark, file_stream(spark, Landing(landing), arrival=False), dimension, settings)
        if part in (1, 2):
            compact_history(spark, settings.history_path)
    return current_totals(spark, settings.history_path)


def kpi_published_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every publish called twice: what has an id counts once."""
    work = new_workspace(spark)
    rows = table(spark, sf_dir, "orders")
    for name in ("O", "F", "P"):
        some = rows.where(F.col("o_orderstatus") == name).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_totalprice").alias("total"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("timestamp"),
        )
        for _ in range(2):
            publish_files(encode(some), f"{work}/landing", f"status-{name}")
    messages = file_batch(spark, f"{work}/landing", arrival=False)
    return unrounded(totals_from_messages(messages, customers(spark, sf_dir), exact=True))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        kpi_by_source_state,
        kpi_large_dimension,
        kpi_dedup,
        kpi_untidy,
        kpi_text_keys,
        kpi_dedup_missing_ids,
        kpi_mixed_messages,
        kpi_customers_listed_twice,
        events_kpi,
        kpi_backfill,
        kpi_by_product,
        kpi_by_product_large_dimension,
        kpi_stream_current,
        kpi_stream_large_dimension,
        kpi_stream_dedup,
        events_kpi_stream,
        kpi_history,
        kpi_exact,
        kpi_exact_large_dimension,
        kpi_stream_exact,
        kpi_backfill_then_stream,
        kpi_state,
        kpi_state_carried_over,
        kpi_corrections,
        kpi_last_versions,
        kpi_waiting,
        kpi_run,
        dropped_messages,
        orders_as_of,
        kpi_as_of_late,
        decoded_orders,
        decoded_order_lines,
        decode_event_props,
        orders_csv_messages,
        orders_csv_scan,
        customers_csv_scan,
        products_csv_scan,
        enriched_orders,
        enriched_orders_large_dimension,
        enriched_orders_spread,
        unmatched_orders,
        unmatched_orders_large_dimension,
        unmatched_orders_spread,
        archive_scan,
        rejected_messages,
        rejected_orders,
        archive_current,
        archive_current_table,
        kpi_compacted,
        kpi_published_once,
    )
}
