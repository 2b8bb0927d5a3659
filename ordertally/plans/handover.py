"""From a backfill to a stream that goes on exactly where it ended.

A backfill first writes down how far it reads: the files of a landing directory, or the next
offset of each Kafka partition. Then it adds up just these messages. The stream reads what
is not among them, and its running sums begin with the backfill's: these are one more source
of rows, taken in by the first batch, so state, offsets and totals are committed together
and no restart counts anything twice.

    backfill_for_stream(spark, settings)      # once
    run(spark, settings)                      # with the same handover_path, a new checkpoint
"""

from __future__ import annotations

import json
import re
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.functions.values import EXACT
from ordertally.plans.totals import totals_from_messages
from ordertally.schemas import HISTORY
from ordertally.settings import Kafka, Landing, Settings
from ordertally.sources.messages import file_list, kafka_batch, message_batch
from ordertally.sources.tables import read_customers

# The history's rows of a backfill; a stream's batches begin with 0.
BACKFILL_BATCH = -1
ENDS = "origin string, next bigint"
_NO_HOST = re.compile(r"^(\w[\w+.-]*):(?:///|/(?!/))")


def _ends(spark: SparkSession, source: Kafka | Landing) -> DataFrame:
    """What there is to read: each file, or each topic partition with its next offset."""
    if isinstance(source, Landing):
        return spark.createDataFrame([(name, None) for name in file_list(spark, source.path)], ENDS)
    messages = kafka_batch(spark, source)
    return messages.groupBy("origin").agg((F.max("position") + 1).alias("next"))


def offsets_of(topic: str, ends: dict[str, int]) -> str:
    """Kafka offsets to end a batch at, or to start a stream from, as JSON."""
    return json.dumps({topic: {name.rsplit("-", 1)[1]: at for name, at in sorted(ends.items())}})


def _up_to(spark: SparkSession, source: Kafka | Landing, ends: DataFrame) -> DataFrame | None:
    known = {row["origin"]: row["next"] for row in ends.collect()}  # a row for each file or partition
    if not known:
        return None
    if isinstance(source, Kafka):
        until = {"endingOffsets": offsets_of(source.topic, known)}
        return kafka_batch(spark, replace(source, options={**source.options, **until}))
    return message_batch(spark, source, arrival=False, files=sorted(known))


def backfill_for_stream(
    spark: SparkSession, settings: Settings, customers: DataFrame | None = None
) -> None:
    """Add up all messages there are, for a stream to go on from.

    The totals go to the history as batch -1 as well. A backfill that broke off is run
    again as a whole; until it is complete the stream refuses to start.
    """
    path, source = settings.handover_path, settings.source
    if path is None or source is None or settings.history_path is None:
        raise ValueError("a handover needs handover_path, source and history_path")
    if customers is None:
        customers = read_customers(spark, settings.customers_path)
    write_ends(_ends(spark, source), path)
    messages = _up_to(spark, source, spark.read.schema(ENDS).parquet(f"{path}/ends"))
    if messages is None:
        none = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("timestamp", T.TimestampType())])
        messages = spark.createDataFrame([], none)
    totals = totals_from_messages(
        messages, customers, broadcast_bytes=settings.broadcast_bytes, exact=settings.exact
    )
    rows = totals.select("source", "state", F.col("total_sum_amount").alias("amount"))
    write_totals(rows.coalesce(1), settings)


def write_ends(ends: DataFrame, path: str) -> None:
    """How far a handover reads; it is not complete until its sums are written as well."""
    _mark(ends.sparkSession, path, [])
    ends.coalesce(1).write.mode("overwrite").parquet(f"{path}/ends")


def _mark(spark: SparkSession, path: str, rows: list) -> None:
    done = spark.createDataFrame(rows, "complete boolean").coalesce(1)
    done.write.mode("overwrite").parquet(f"{path}/done")


def write_totals(rows: DataFrame, settings: Settings) -> None:
    """Sums `source, state, amount` for a stream to begin with, and as its history's first rows.

    Written last; then the handover is complete.
    """
    path = settings.handover_path
    rows.write.mode("overwrite").parquet(f"{path}/totals")
    shown = rows.sparkSession.read.parquet(f"{path}/totals").select(
        "source",
        "state",
        F.col("amount").cast("double").alias("total_sum_amount"),
        F.current_timestamp().alias("processed_at"),
    )
    shown = shown.select([f.name for f in HISTORY.fields if f.name != "batch_id"])
    shown.write.mode("overwrite").parquet(f"{settings.history_path}/batch_id={BACKFILL_BATCH}")
    _mark(rows.sparkSession, path, [(True,)])


def read_ends(spark: SparkSession, path: str) -> DataFrame:
    spark.read.parquet(f"{path}/totals")  # an error if there is none
    if spark.read.schema("complete boolean").parquet(f"{path}/done").isEmpty():
        raise ValueError(f"the totals in {path} are not complete")
    return spark.read.schema(ENDS).parquet(f"{path}/ends")


def source_after(spark: SparkSession, source: Kafka | Landing, path: str) -> Kafka | Landing:
    """The source, from where the backfill ended. Partitions that had no message then are
    read from their beginning. Files are told apart as messages, see `messages_after`."""
    if isinstance(source, Landing):
        read_ends(spark, path)
        return source
    ends = {row["origin"]: row["next"] for row in read_ends(spark, path).collect()}
    if not ends:
        return replace(source, starting_offsets="earliest")
    return replace(source, starting_offsets=offsets_of(source.topic, ends))


def messages_after(messages: DataFrame, path: str) -> DataFrame:
    """The messages that the backfill did not read, known by `origin`.

    The files it read are named in a filter on the scan, so they are listed by the stream,
    but not opened. Kafka partitions start behind what it read, which this then leaves alone.
    """
    ends = read_ends(messages.sparkSession, path)
    files = [row["origin"] for row in ends.where("next IS NULL").collect()]
    # Without a host, a scan and the log of a stream's source write one name in two ways.
    files = sorted({_NO_HOST.sub(rf"\1:{root}", file) for file in files for root in ("/", "///")})
    return messages.where(~F.col("origin").isin(files)) if files else messages


def seed_stream(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """The backfill's sums as a stream of rows `source, state, amount`, read once."""
    kind = EXACT if exact else "double"
    rows = spark.readStream.schema(f"source string, state string, amount {kind}")
    return rows.parquet(f"{path}/totals")
