"""Orders that wait for their customer.

Orders and customers are two streams, joined as both arrive: an order counts when its
customer is known, whichever of the two came first. Customers are kept for good, an order for
as long as it may wait; an order that meets no customer in that time is listed as expired.

Time is that of arrival, by micro-batch, so no row is too old to be taken, and an order that
is read again after a failure is as old as it was. What is matched and what has expired goes
to one log, Spark's own file sink, each order once; totals are a second query over the log. An
order expires with the first batch after its time is up.

Orders of one customer are dealt over `ways` tasks by their content, at the price of as many
copies of each customer, so one with a third of all orders does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordertally.functions.messages import decode
from ordertally.functions.values import EXACT, exact_amount, text_key
from ordertally.settings import Settings
from ordertally.streaming.jobs import ROCKSDB, _start, _trigger, _width, session_conf
from ordertally.streaming.sinks import to_history

# No row is late: both streams are stamped by batch. The later of both clocks counts, so
# orders expire though no customer arrives, and the other way round.
_CLOCK = {"spark.sql.streaming.multipleWatermarkPolicy": "max"}
_SLACK = "1 second"
# One store for a partition of the join instead of four, each with its files in every batch.
# A checkpoint keeps the format of its first start.
_STORES = {"spark.sql.streaming.join.stateFormatVersion": "3"}
MATCHED, EXPIRED = "matched", "expired"
WAITED = (
    f"order_id string, customer_id string, amount {EXACT}, timestamp timestamp, "
    "source string, state string, kind string"
)


def _key(text: Column) -> Column:
    # Never NULL, so that the state has one schema, whether a batch has rows or none.
    return F.coalesce(text_key(text), F.lit(""))


def waited(messages: DataFrame, customers: DataFrame, wait: str, ways: int = 1) -> DataFrame:
    """Each order with each entry of its customer, and orders that had none for `wait`.

    `kind` tells the two apart. Messages that are no orders of a customer, and customers
    without a key, are left out. An order meets a customer's entries that arrive up to
    `wait` after it; entries that came before it, however old, count as well.
    """
    orders = decode(messages, ["order_id", "customer_id", "total"])
    orders = orders.select(
        "order_id",
        _key(F.col("customer_id")).alias("customer_id"),
        exact_amount(F.col("total")).alias("amount"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    ).where("customer_id <> ''")
    salt = F.pmod(F.xxhash64(*orders.columns), F.lit(ways).cast("bigint"))
    orders = orders.withColumn("salt", salt).withColumn("seen_at", F.current_timestamp())
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(ways - 1).cast("bigint"))
    known = customers.select(
        _key(F.col("customer_id").cast("string")).alias("known_id"),
        "source",
        "state",
        F.explode(every).alias("known_salt"),
    ).where("known_id <> ''")
    known = known.withColumn("known_at", F.current_timestamp())
    same = (F.col("customer_id") == F.col("known_id")) & (F.col("salt") == F.col("known_salt"))
    in_time = F.col("known_at") <= F.col("seen_at") + F.expr(f"INTERVAL {wait}")
    met = orders.withWatermark("seen_at", _SLACK).join(
        known.withWatermark("known_at", _SLACK), same & in_time, "left"
    )
    kind = F.when(F.col("known_id").isNull(), EXPIRED).otherwise(MATCHED)
    return met.withColumn("kind", kind).select(
        "order_id", "customer_id", "amount", "timestamp", "source", "state", "kind"
    )


def start_waiting(
    messages: DataFrame, customers: DataFrame, path: str, settings: Settings, wait: str, ways: int = 1
) -> list[StreamingQuery]:
    """The query that lets orders wait, with its log at `path`, and the one that adds up
    the matched ones. Without a trigger the first has ended when the second starts."""
    spark = messages.sparkSession
    rows = waited(messages, customers, wait, ways)
    with session_conf(spark, {**ROCKSDB, **_STORES, **_CLOCK, **_width(settings)}):
        writer = rows.writeStream.queryName("waiting").outputMode("append")
        writer = writer.format("parquet").option("path", path).partitionBy("kind")
        writer = writer.option("checkpointLocation", f"{settings.checkpoint_root}/waiting")
        first = _trigger(writer, settings).start()
    if settings.trigger is None:
        first.awaitTermination()
    log = spark.readStream.schema(WAITED).parquet(path).where(F.col("kind") == MATCHED)
    totals = log.groupBy("source", "state").agg(F.sum("amount").alias("total_sum_amount"))
    each_batch = to_history(settings.history_path, settings.console, settings.history_files)
    try:
        with session_conf(spark, _width(settings)):
            return [first, _start(totals, "totals", each_batch, settings)]
    except BaseException:
        first.stop()
        raise


def read_expired(spark, path: str) -> DataFrame:
    """The orders that have waited in vain."""
    rows = spark.read.schema(WAITED).parquet(path).where(F.col("kind") == EXPIRED)
    return rows.select("order_id", "customer_id", "amount", "timestamp")
