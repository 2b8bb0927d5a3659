"""Batch jobs beside the stream."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.functions.messages import encode
from ordertally.operators.current import kpi_current
from ordertally.operators.sizes import BROADCAST_BYTES
from ordertally.plans.totals import totals_from_messages
from ordertally.schemas import HISTORY
from ordertally.settings import Kafka, Landing
from ordertally.sources.folders import is_complete, move, names_in, numbered
from ordertally.sources.messages import message_batch
from ordertally.sources.tables import read_customers, read_orders_csv
from ordertally.streaming.sinks import fit, with_lineage


def publish_files(messages: DataFrame, path: str, publish_id: str | None = None) -> None:
    """Add messages to a landing directory.

    With a `publish_id` they are added once, however often this is called and wherever it
    broke off: the files are written aside as a whole, then moved in one by one, and what
    has been moved is not written again. One call at a time for an id.
    """
    rows = messages.select("value", "timestamp")
    if publish_id is None:
        rows.write.mode("append").parquet(path)
        return
    if not re.fullmatch(r"[A-Za-z0-9-]+", publish_id):
        raise ValueError("a publish id has letters, digits and hyphens")
    spark, aside = messages.sparkSession, f"{path}/_publish-{publish_id}"
    if not is_complete(spark, aside):
        rows.write.mode("overwrite").parquet(aside)
    for name in names_in(spark, aside):
        if name.startswith("part-"):
            move(spark, f"{aside}/{name}", f"{path}/{publish_id}-{name}")


def publish_kafka(messages: DataFrame, kafka: Kafka) -> None:
    """Send messages to a topic. Needs the Kafka package at submit time."""
    client = {name: v for name, v in kafka.options.items() if name.startswith("kafka.")}
    target = {"kafka.bootstrap.servers": kafka.bootstrap_servers, "topic": kafka.topic}
    messages.select("value").write.format("kafka").options(**client, **target).save()


def publish_orders_csv(
    spark: SparkSession, orders_path: str, target: str | Kafka, publish_id: str | None = None
) -> None:
    """Every row of an orders file as a message; to a directory once for each `publish_id`."""
    messages = encode(read_orders_csv(spark, orders_path))
    if isinstance(target, Kafka):
        publish_kafka(messages, target)
    else:
        publish_files(messages, target, publish_id)


def backfill_totals(
    spark: SparkSession,
    source: Kafka | Landing,
    customers_path: str,
    history_path: str,
    dedup_orders: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> None:
    """Totals of all messages as batch 0, in place of whatever the history held.

    For a history of its own: a running stream goes on from its own state.
    """
    totals = totals_from_messages(
        message_batch(spark, source, arrival=dedup_orders),
        read_customers(spark, customers_path),
        dedup_orders,
        broadcast_bytes=broadcast_bytes,
    )
    rows = fit(with_lineage(totals, 0), HISTORY)
    # The whole history goes, whatever the session says of single partitions.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("batch_id").parquet(history_path)


def _snapshot(spark: SparkSession, history_path: str) -> tuple[str | None, int | None]:
    folder = f"{history_path.rstrip('/')}-snapshots"
    done = numbered(spark, folder, "upto")
    return (f"{folder}/upto={done[-1]}", done[-1]) if done else (None, None)


def _batches(spark: SparkSession, history_path: str, numbers: list[int]) -> DataFrame:
    """The rows of some batches; the files of the others are not even listed."""
    if not numbers:
        return spark.createDataFrame([], HISTORY)
    folders = [f"{history_path}/batch_id={number}" for number in numbers]
    return spark.read.schema(HISTORY).option("basePath", history_path).parquet(*folders)


def compact_history(spark: SparkSession, history_path: str) -> int | None:
    """Put down the latest total of each group, with its batch; the last batch in it.

    From the snapshot before and the batches since then, up to the last one that is
    complete with all before it. It counts once it is written as a whole; a compaction
    that broke off leaves nothing behind that a reader would see, and no batch is touched.
    """
    snapshot, last = _snapshot(spark, history_path)
    taken: list[int] = []
    for number in numbered(spark, history_path, "batch_id", last):
        before = taken[-1] if taken else last
        if before is not None and number > before + 1:
            break
        taken.append(number)
    if not taken:
        return last
    rows, upto = _batches(spark, history_path, taken), taken[-1]
    if snapshot is not None:
        rows = rows.unionByName(spark.read.schema(HISTORY).parquet(snapshot))
    own = F.max_by(F.struct("total_sum_amount", "processed_at", "batch_id"), "batch_id")
    latest = rows.groupBy("source", "state").agg(own.alias("last")).select("source", "state", "last.*")
    folder = f"{history_path.rstrip('/')}-snapshots/upto={upto}"
    latest.coalesce(4).write.mode("overwrite").parquet(folder)
    return upto


def current_totals(spark: SparkSession, history_path: str) -> DataFrame:
    """The latest total of each group: the last snapshot, and the batches after it alone."""
    snapshot, last = _snapshot(spark, history_path)
    rows = _batches(spark, history_path, numbered(spark, history_path, "batch_id", last))
    if snapshot is not None:
        rows = rows.unionByName(spark.read.schema(HISTORY).parquet(snapshot))
    return kpi_current(rows)
