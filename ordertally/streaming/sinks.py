"""What each micro-batch does with its rows. Every target can take a batch twice."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.functions.messages import REASONS, screen
from ordertally.operators.current import archive_current
from ordertally.operators.current_table import update_current
from ordertally.schemas import ARCHIVE, HISTORY, ORDER_FIELDS
from ordertally.settings import HISTORY_FILES, Cassandra, Jdbc
from ordertally.sources.tables import read_history_jdbc

BatchFunction = Callable[[DataFrame, int], None]


def fit(df: DataFrame, contract: T.StructType, *left_out: str) -> DataFrame:
    """The contract's columns in its order and types."""
    fields = [f for f in contract.fields if f.name not in left_out]
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))


def with_lineage(totals: DataFrame, batch_id: int) -> DataFrame:
    """When and by which batch; one time for the whole batch."""
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    return totals.withColumns(
        {
            "processed_at": F.lit(now).cast("timestamp"),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )


# Name of the observation of an archive that counts what it refuses.
SCREENED = "screened"


def archive_rows(messages: DataFrame, keep_raw: bool = False, counted: bool = False) -> DataFrame:
    """Screened messages in the archive's layout, without the batch_id.

    `counted` observes the messages and those refused, by reason.
    """
    rows = screen(messages)
    if counted:
        why = {name: F.count_if(F.col("reason") == name.replace("_", " ", 1)) for name in REASONS}
        rows = rows.observe(
            SCREENED, F.count("*").alias("messages"), *(n.alias(name) for name, n in why.items())
        )
    refused = F.col("reason").isNotNull()
    rows = rows.withColumn("kind", F.when(refused, "reject").otherwise("order"))
    if not keep_raw:
        rows = rows.withColumn("value", F.when(refused, F.col("value")))
    return fit(rows, ARCHIVE, "batch_id")


def _write_batch(rows: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    # A folder per batch, replaced as a whole: writing a batch again changes nothing.
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/batch_id={batch_id}")


def to_archive(path: str) -> BatchFunction:
    """Accepted and rejected messages of a batch in one pass and one commit."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id, "kind")

    return write


def and_current(first: BatchFunction, path: str, buckets: int) -> BatchFunction:
    """What the archive does with a batch, and then its orders into the table of last versions."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            first(batch, batch_id)
            update_current(batch.where("kind = 'order'"), path, batch_id, buckets)
        finally:
            batch.unpersist()

    return write


def to_cassandra(cassandra: Cassandra, rejects_path: str) -> BatchFunction:
    """Upsert by order_id, which Cassandra does on its key; rejects go to files.

    Of an order that a batch holds more than once the last version alone is sent, as
    `archive_current` would choose it: tasks write in no order.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            orders = batch.where("kind = 'order'").withColumn("batch_id", F.lit(batch_id))
            orders = archive_current(orders)
            columns = [F.col(c).cast("string").alias(c) for c in (*ORDER_FIELDS, "timestamp")]
            orders.select(*columns).write.format("org.apache.spark.sql.cassandra").options(
                **cassandra.options()
            ).mode("append").save()
            _write_batch(batch.where("kind = 'reject'"), rejects_path, batch_id, "kind")
        finally:
            batch.unpersist()

    return write


def to_history(
    path: str,
    console: bool = False,
    files: int = HISTORY_FILES,
    contract: T.StructType = HISTORY,
) -> BatchFunction:
    """Changed totals of a batch in a few files, and on request on the console as well.

    One small shuffle, one row per changed group: the stage that keeps the state stays wide.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = fit(with_lineage(batch, batch_id), contract, "batch_id")
        _write_batch(rows.repartition(files, "source", "state"), path, batch_id)
        if console:
            # Read back: a second action on the batch would run its state again.
            written = batch.sparkSession.read.parquet(f"{path}/batch_id={batch_id}")
            _show(written, batch_id)

    return write


def not_yet_written(rows: DataFrame, written: DataFrame) -> DataFrame:
    """Rows whose group is not there yet, NULL groups included."""
    there = written.select(F.col("source").alias("_source"), F.col("state").alias("_state"))
    same = F.col("source").eqNullSafe(F.col("_source")) & F.col("state").eqNullSafe(
        F.col("_state")
    )
    return rows.join(there, same, "left_anti")


# Column types of the totals table.
HISTORY_COLUMN_TYPES = "source VARCHAR(100), state VARCHAR(100)"


def append_jdbc(rows: DataFrame, jdbc: Jdbc) -> None:
    rows.write.format("jdbc").options(
        url=jdbc.url,
        dbtable=jdbc.table,
        numPartitions=str(jdbc.max_connections),
        createTableColumnTypes=HISTORY_COLUMN_TYPES,
        **jdbc.properties(),
    ).mode("append").save()


def create_history_jdbc(spark: SparkSession, jdbc: Jdbc) -> None:
    """Create the totals table unless it is there: append no rows to it."""
    append_jdbc(spark.createDataFrame([], HISTORY), jdbc)


def to_history_jdbc(jdbc: Jdbc, console: bool = False) -> BatchFunction:
    """Append to the totals table the rows of this batch it lacks.

    Row by row, so a batch that failed half written is completed, and any number
    of connections may write.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = fit(with_lineage(batch, batch_id), HISTORY)
        table = read_history_jdbc(batch.sparkSession, jdbc)
        written = table.where(F.col("batch_id") == batch_id)
        missing = not_yet_written(rows, written)
        # Few connections, without narrowing the stage that keeps the state.
        append_jdbc(missing.repartition(jdbc.max_connections, "source", "state"), jdbc)
        if console:
            _show(written, batch_id)

    return write


def _show(rows: DataFrame, batch_id: int) -> None:
    print(f"batch {batch_id}")
    rows.show(truncate=False)
