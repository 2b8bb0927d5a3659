"""Orders that are delivered again with other content: the last version counts.

Two queries and a log between them. The first keeps the last version of each order in a table
and adds to the log what a batch changes: what an order added so far, taken back, and what it
adds now. A batch joins the table's rows in the buckets of its own orders, and writes these
buckets anew. Its part of the log appears as a whole, by one rename, and once: a batch that
comes again goes on where it broke off. The second query adds the log up by source and state of
the customer.

Which version is the last is told by the messages, not by the order in which they are read:
the time of the message, then its position and origin. So totals do not depend on how the
messages are split into batches, and an old version that comes late changes nothing.

Of an order's versions in one task the last alone is sent, so an order that is delivered again
and again is no hot key. Orders without a usable id are all counted, and not dealt out. Amounts
are decimals: what is taken back leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.functions.messages import decode
from ordertally.functions.values import EXACT, exact_amount, has_id
from ordertally.operators.current_table import BUCKETS, bucket_of
from ordertally.operators.customers import keyed
from ordertally.sources.folders import delete, is_complete, move, names_in, numbered

_VERSION = ["stamp", "position", "origin"]
_CONTENT = ["customer_id", "amount"]
# `was` is what the order added before the batch that wrote the row, if `changed` there.
_ROWS = (
    f"order_id string, last struct<stamp bigint, position bigint, origin string, "
    f"customer_id string, amount {EXACT}>, "
    f"was struct<customer_id string, amount {EXACT}>, changed boolean, bucket int"
)
CHANGES = f"customer_id string, amount {EXACT}, orders bigint, amounts bigint"
_LIST = "bucket int, commit bigint"
_NAMELESS = -1


def versions_of(messages: DataFrame) -> DataFrame:
    """Messages as versions of orders. Needs `timestamp`, `origin` and `position`."""
    orders = decode(messages, ["order_id", "customer_id", "total"])
    return orders.select(
        "order_id",
        "customer_id",
        exact_amount(F.col("total")).alias("amount"),
        F.coalesce(F.unix_micros(F.col("timestamp").cast("timestamp")), F.lit(-(2**62))).alias("stamp"),
        F.coalesce("position", F.lit(-1)).cast("bigint").alias("position"),
        F.coalesce("origin", F.lit("")).alias("origin"),
    )


def _settled(last: DataFrame, before: DataFrame) -> DataFrame:
    """The last version of each order of a batch, or of the table before it, and what changes."""
    both = last.withColumnRenamed("last", "new").join(before, "order_id", "full")
    new, old = (F.struct(*(F.col(f"{side}.{name}") for name in _VERSION)) for side in ("new", "old"))
    later = F.col("new").isNotNull() & (F.col("old").isNull() | (new > old))
    same = [F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}")) for name in _CONTENT]
    changed = later & ~(F.col("old").isNotNull() & same[0] & same[1])
    content = F.struct(*(F.col(f"old.{name}") for name in _CONTENT))
    return both.select(
        "order_id",
        F.when(later, F.col("new")).otherwise(F.col("old")).alias("last"),
        F.when(changed & F.col("old").isNotNull(), content).alias("was"),
        changed.alias("changed"),
    )


def _write_rows(versions: DataFrame, path: str, batch_id: int, places: dict[int, int]) -> None:
    """The buckets of a batch's orders as they are after it, and its orders without an id."""
    spark = versions.sparkSession
    row = F.struct(*_VERSION, *_CONTENT)
    named = versions.where(has_id(F.col("order_id")))
    last = named.groupBy("order_id").agg(F.max(row).alias("last")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = [r["bucket"] for r in last.select(bucket_of(BUCKETS).alias("bucket")).distinct().collect()]
        folders = [f"{path}/rows/commit={places[b]}/bucket={b}" for b in sorted(touched) if b in places]
        reader = spark.read.schema(_ROWS)
        before = reader.parquet(*folders) if folders else spark.createDataFrame([], _ROWS)
        before = before.select("order_id", F.col("last").alias("old"))
        rows = _settled(last, before).withColumn("bucket", bucket_of(BUCKETS))
        rows = rows.repartition(max(len(touched), 1), "bucket")
        nameless = versions.where(~has_id(F.col("order_id"))).select(
            "order_id", row.alias("last"), F.lit(True).alias("changed"), F.lit(_NAMELESS).alias("bucket")
        )
        rows = rows.unionByName(nameless, allowMissingColumns=True)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("bucket").parquet(f"{path}/rows/commit={batch_id}")
    finally:
        last.unpersist()


def _changes(spark: SparkSession, rows: str) -> DataFrame:
    """What the batch that wrote these rows adds to the totals of customers, and takes back."""

    def entry(side: str, sign: int):
        return F.struct(*(F.col(f"{side}.{name}") for name in _CONTENT), F.lit(sign).alias("sign"))

    new, old = entry("last", 1), entry("was", -1)
    entries = F.when(F.col("was").isNull(), F.array(new)).otherwise(F.array(old, new))
    return _signed(spark.read.schema(_ROWS).parquet(rows).where("changed").select(F.inline(entries)))


def to_changes(
    log: str, path: str, finish: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """Takes a batch of `versions_of` messages into the table at `path`, and adds what it
    changes, as `finish` gives it, to the log.

    Every step is complete or absent, and none is done twice: rows, log, list of buckets.
    """

    def write(versions: DataFrame, batch_id: int) -> None:
        spark = versions.sparkSession
        lists = numbered(spark, f"{path}/lists", "commit")
        if lists and batch_id <= lists[-1]:
            return
        if batch_id != (lists[-1] + 1 if lists else 0):
            raise ValueError(f"{path} lacks the batch before {batch_id}: begin with a new checkpoint and log")
        places = {}
        if lists:
            listed = spark.read.schema(_LIST).parquet(f"{path}/lists/commit={lists[-1]}")
            places = {r["bucket"]: r["commit"] for r in listed.collect()}
        rows = f"{path}/rows/commit={batch_id}"
        if not is_complete(spark, rows):
            _write_rows(versions, path, batch_id, places)
        if f"batch_id={batch_id}" not in names_in(spark, log):
            staged = f"{log}/_staged"
            finish(_changes(spark, rows)).write.mode("overwrite").parquet(staged)
            move(spark, staged, f"{log}/batch_id={batch_id}")
        folders = [name.partition("=") for name in names_in(spark, rows)]
        touched = [int(number) for key, _, number in folders if key == "bucket" and int(number) != _NAMELESS]
        now = places | dict.fromkeys(touched, batch_id)
        listed = spark.createDataFrame(sorted(now.items()), _LIST).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{path}/lists/commit={batch_id}")
        _clear(spark, path, lists, places, touched, set(now.values()) | {batch_id})

    return write


def _clear(
    spark: SparkSession, path: str, lists: list[int], before: dict[int, int], touched: list[int], kept: set[int]
) -> None:
    """Delete what the last list no longer names; nothing reads it any more."""
    for bucket in touched:
        if before.get(bucket) in kept:
            delete(spark, f"{path}/rows/commit={before[bucket]}/bucket={bucket}")
    for commit in numbered(spark, f"{path}/rows", "commit"):
        if commit not in kept:
            delete(spark, f"{path}/rows/commit={commit}")
    delete(spark, f"{path}/rows/commit={max(kept)}/bucket={_NAMELESS}")
    for commit in lists:
        delete(spark, f"{path}/lists/commit={commit}")


def _signed(rows: DataFrame) -> DataFrame:
    sign = F.col("sign").cast("bigint")
    return rows.select(
        "customer_id",
        (F.col("amount").cast(EXACT) * F.col("sign")).cast(EXACT).alias("amount"),
        sign.alias("orders"),
        F.when(F.col("amount").isNotNull(), sign).otherwise(F.lit(0)).alias("amounts"),
    )


def last_versions(messages: DataFrame) -> DataFrame:
    """What a bounded table of messages adds to the totals: one row for each order, its last version.

    A hash aggregate over the versions; each task sends one of an order's.
    """
    versions = versions_of(messages)
    last = F.max_by(F.struct("customer_id", "amount"), F.struct(*_VERSION)).alias("last")
    named = versions.where(has_id(F.col("order_id"))).groupBy("order_id").agg(last)
    nameless = versions.where(~has_id(F.col("order_id"))).select("customer_id", "amount")
    rows = named.select("last.*").unionByName(nameless).withColumn("sign", F.lit(1))
    return _signed(rows)


def keyed_changes(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Changes with the key as the customers have theirs."""
    text = dict(customers.dtypes)["customer_id"] == "string"
    return keyed(rows, text=text)
