"""Message sources. All give `value, timestamp, origin, position`.

File sources leave out `origin, position` on request: only dedup and the archive use
them, and the scan computes row numbers for every row even if they are dropped later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.schemas import MESSAGE_FILE
from ordertally.settings import Kafka, Landing


def kafka_options(kafka: Kafka) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": kafka.bootstrap_servers,
        "subscribe": kafka.topic,
        "startingOffsets": kafka.starting_offsets,
        "failOnDataLoss": str(kafka.fail_on_data_loss).lower(),
    }
    if kafka.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(kafka.max_offsets_per_trigger)
    if kafka.min_partitions is not None:
        options["minPartitions"] = str(kafka.min_partitions)
    return {**options, **kafka.options}


def kafka_stream(spark: SparkSession, kafka: Kafka) -> DataFrame:
    """Messages of a topic. Needs the Kafka package at submit time."""
    return from_records(spark.readStream.format("kafka").options(**kafka_options(kafka)).load())


def kafka_batch(spark: SparkSession, kafka: Kafka) -> DataFrame:
    """All messages the topic still holds, for backfills."""
    options = {**kafka_options(kafka), "startingOffsets": "earliest"}
    options.pop("maxOffsetsPerTrigger", None)
    return from_records(spark.read.format("kafka").options(**options).load())


def from_records(records: DataFrame) -> DataFrame:
    """Kafka records to messages, known by topic-partition and offset."""
    return records.select(
        "value",
        "timestamp",
        F.concat_ws("-", "topic", "partition").alias("origin"),
        F.col("offset").alias("position"),
    )


def _messages(files: DataFrame, arrival: bool) -> DataFrame:
    if not arrival:
        return files.select("value", "timestamp")
    return files.select(
        "value",
        "timestamp",
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.row_index").alias("position"),
    )


def file_stream(spark: SparkSession, landing: Landing, arrival: bool = True) -> DataFrame:
    """Messages of a directory of Parquet files, each new file read once."""
    reader = spark.readStream.schema(MESSAGE_FILE).options(**landing.options)
    if landing.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", landing.max_files_per_trigger)
    if landing.max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", landing.max_bytes_per_trigger)
    return _messages(reader.parquet(landing.path), arrival)


def file_list(spark: SparkSession, path: str) -> list[str]:
    """The message files that there are now, by the names that messages have as `origin`."""
    files = spark.read.schema(MESSAGE_FILE).parquet(path)
    names = files.select(F.col("_metadata.file_path").alias("origin")).distinct()
    return [row["origin"] for row in names.collect()]


def file_batch(
    spark: SparkSession, path: str, arrival: bool = True, files: Sequence[str] | None = None
) -> DataFrame:
    """The same files as one bounded table, for backfills; or some `files` alone."""
    there = spark.read.schema(MESSAGE_FILE).parquet(path)
    if files is not None:
        there = there.where(F.col("_metadata.file_path").isin(list(files)))
    return _messages(there, arrival)


def message_stream(
    spark: SparkSession, source: Kafka | Landing, arrival: bool = True
) -> DataFrame:
    if isinstance(source, Kafka):
        return kafka_stream(spark, source)
    return file_stream(spark, source, arrival)


def message_batch(
    spark: SparkSession,
    source: Kafka | Landing,
    arrival: bool = True,
    files: Sequence[str] | None = None,
) -> DataFrame:
    if isinstance(source, Kafka):
        return kafka_batch(spark, source)
    return file_batch(spark, source.path, arrival, files)
