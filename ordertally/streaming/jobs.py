"""Start, watch and end the streaming queries."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ordertally.operators.totals import corrected_totals
from ordertally.plans.handover import messages_after, seed_stream, source_after
from ordertally.plans.totals import totals_from_messages
from ordertally.schemas import CORRECTED
from ordertally.settings import Settings
from ordertally.sources.folders import make
from ordertally.sources.messages import message_stream
from ordertally.sources.tables import read_customers
from ordertally.streaming.corrections import CHANGES, keyed_changes, to_changes, versions_of
from ordertally.streaming.sinks import (
    BatchFunction,
    and_current,
    archive_rows,
    create_history_jdbc,
    to_archive,
    to_cassandra,
    to_history,
    to_history_jdbc,
)

log = logging.getLogger(__name__)

POOL = "spark.scheduler.pool"

# For state that grows with the number of orders instead of the number of groups.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One limit per executor instead of one per partition; see rocksdb.maxMemoryUsageMB.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Counting rows costs a lookup per new id.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside; they keep them afterwards."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _trigger(writer: DataStreamWriter, settings: Settings) -> DataStreamWriter:
    if settings.trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=settings.trigger)


def _width(settings: Settings) -> dict[str, str]:
    conf = dict(settings.conf)
    if settings.state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(settings.state_partitions)
    return conf


def checkpoint_of(settings: Settings, name: str) -> str:
    if name == "totals" and settings.totals_checkpoint is not None:
        return settings.totals_checkpoint
    return f"{settings.checkpoint_root}/{name}"


def _start(
    df: DataFrame, name: str, each_batch: BatchFunction, settings: Settings
) -> StreamingQuery:
    writer = (
        df.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_of(settings, name))
        .foreachBatch(each_batch)
    )
    writer = _trigger(writer, settings)
    # A pool of its own: with the FAIR scheduler no query waits for the other's tasks.
    context = df.sparkSession.sparkContext
    before = context.getLocalProperty(POOL)
    context.setLocalProperty(POOL, name)
    try:
        return writer.start()
    finally:
        context.setLocalProperty(POOL, before)


def start_archive(messages: DataFrame, settings: Settings) -> StreamingQuery:
    """Every message to the archive or, if it cannot be read, to the rejects."""
    if settings.cassandra is not None:
        each_batch = to_cassandra(settings.cassandra, settings.archive_path)
    else:
        each_batch = to_archive(settings.archive_path)
    if settings.current_path is not None:
        each_batch = and_current(each_batch, settings.current_path, settings.current_buckets)
    rows = archive_rows(messages, settings.keep_raw, settings.counted)
    return _start(rows, "archive", each_batch, settings)


def start_totals(
    messages: DataFrame, customers: DataFrame, settings: Settings
) -> StreamingQuery:
    """Running totals by source and state; each batch adds the groups it changed."""
    spark = messages.sparkSession
    seed = None
    if settings.handover_path is not None:
        messages = messages_after(messages, settings.handover_path)
        seed = seed_stream(spark, settings.handover_path, settings.exact)
    totals = totals_from_messages(
        messages,
        customers,
        dedup_orders=settings.dedup,
        within=settings.dedup_within,
        broadcast_bytes=settings.broadcast_bytes,
        join_partitions=settings.join_partitions,
        exact=settings.exact,
        seed=seed,
        counted=settings.counted,
    )
    if settings.jdbc is not None:
        create_history_jdbc(spark, settings.jdbc)
        each_batch = to_history_jdbc(settings.jdbc, settings.console)
    else:
        each_batch = to_history(
            settings.history_path, settings.console, settings.history_files
        )
    with session_conf(spark, {**(ROCKSDB if settings.dedup else {}), **_width(settings)}):
        return _start(totals, "totals", each_batch, settings)


def start_corrections(
    messages: DataFrame, customers: DataFrame, settings: Settings
) -> list[StreamingQuery]:
    """Totals of the last versions of orders: the query that finds what changes, and the one
    that adds the changes up. Without a trigger the first has ended when the second starts."""
    spark = messages.sparkSession
    changed = keyed_changes(spark.createDataFrame([], CHANGES), customers).schema
    make(spark, settings.corrections_path)
    to_log = to_changes(
        settings.corrections_path,
        f"{settings.checkpoint_root}/versions",
        lambda rows: keyed_changes(rows, customers),
    )
    with session_conf(spark, _width(settings)):
        first = _start(versions_of(messages), "corrections", to_log, settings)
    if settings.trigger is None:
        first.awaitTermination()
    # The folder of each batch is a partition.
    log = spark.readStream.schema(changed.add("batch_id", "long")).parquet(settings.corrections_path)
    log = log.drop("batch_id")
    totals = corrected_totals(
        log, customers, settings.broadcast_bytes, settings.join_partitions
    )
    each_batch = to_history(
        settings.history_path, settings.console, settings.history_files, CORRECTED
    )
    try:
        with session_conf(spark, _width(settings)):
            return [first, _start(totals, "totals", each_batch, settings)]
    except BaseException:
        first.stop()
        raise


def run(
    spark: SparkSession, settings: Settings, customers: DataFrame | None = None
) -> list[StreamingQuery]:
    """Start both queries on the configured source.

    Customers come from the configured file, or from any other table handed in.
    """
    if settings.source is None:
        raise ValueError("give source")
    if customers is None:
        if settings.customers_path is None:
            raise ValueError("give customers_path or customers")
        customers = read_customers(spark, settings.customers_path)
    archive = start_archive(message_stream(spark, settings.source), settings)
    try:
        known = settings.dedup or settings.corrections_path or settings.handover_path
        source = settings.source
        if settings.handover_path is not None:
            source = source_after(spark, source, settings.handover_path)
        messages = message_stream(spark, source, arrival=bool(known))
        if settings.corrections_path is not None:
            return [archive, *start_corrections(messages, customers, settings)]
        return [archive, start_totals(messages, customers, settings)]
    except BaseException:
        archive.stop()
        raise


def wait(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Until all have ended, or one fails: then stop the others and raise its error."""
    try:
        # Asks our own queries alone; one that has failed raises its error, now or before.
        while not all([query.awaitTermination(1) for query in queries]):
            pass
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def dropped(progress) -> dict[str, int]:
    """What a batch of a query with `counted` left out, from its progress: messages refused
    (archive), orders without a numeric amount or without a customer (totals)."""
    found = {}
    for row in progress.observedMetrics.values():
        found |= {name: count or 0 for name, count in row.asDict().items()}
    return found


class ProgressLog(StreamingQueryListener):
    """Log each batch: `spark.streams.addListener(ProgressLog())`."""

    def onQueryStarted(self, event):
        log.info("query %s started", event.name)

    def onQueryProgress(self, event):
        p = event.progress
        log.info(
            "query %s batch %s: %s rows in, %.0f rows/s",
            p.name,
            p.batchId,
            p.numInputRows,
            p.processedRowsPerSecond,
        )
        if left := dropped(p):
            counts = ", ".join(f"{count} {name}" for name, count in left.items())
            log.info("query %s batch %s: %s", p.name, p.batchId, counts)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("query %s ended: %s", event.id, event.exception or "no error")
