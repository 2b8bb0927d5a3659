"""Readers of the tables around the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.functions.values import text_key
from ordertally.schemas import ARCHIVE, HISTORY, ORDER_FIELDS, PRODUCT
from ordertally.settings import Jdbc


def _csv_by_name(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    # A quote within quotes is doubled. A file with line breaks in quotes cannot be split.
    # Column names from the header, all text, no inference over the data.
    # enforceSchema off: a file whose header differs fails instead of shifting columns.
    return spark.read.csv(
        path, header=True, enforceSchema=False, escape='"', multiLine=multi_line
    )


def read_customers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Customer dimension from CSV: key as text, source and state, found by name."""
    table = _csv_by_name(spark, path, multi_line)
    return table.select(text_key(F.col("customer_id")).alias("customer_id"), "source", "state")


def read_orders_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Orders to publish, the nine fields as text in contract order; absent ones NULL."""
    table = _csv_by_name(spark, path, multi_line)
    return table.select(
        *(
            F.col(name) if name in table.columns else F.lit(None).cast("string").alias(name)
            for name in ORDER_FIELDS
        )
    )


def read_products(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(PRODUCT).csv(
        path, header=True, enforceSchema=False, escape='"', multiLine=multi_line
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every accepted order as written; `kind` prunes the rejects' files."""
    table = spark.read.schema(ARCHIVE).parquet(path)
    return table.where("kind = 'order'").drop("kind", "reason")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.schema(ARCHIVE).parquet(path)
    return table.where("kind = 'reject'").drop("kind", *ORDER_FIELDS)


def read_history(spark: SparkSession, path: str, contract: T.StructType = HISTORY) -> DataFrame:
    """Running totals of every batch; `CORRECTED` for those with corrections."""
    return spark.read.schema(contract).parquet(path)


def read_history_jdbc(spark: SparkSession, jdbc: Jdbc, **options: str) -> DataFrame:
    """The same from a database; `options` may split the read on batch_id."""
    reader = spark.read.format("jdbc").options(
        url=jdbc.url, dbtable=jdbc.table, **jdbc.properties(), **options
    )
    return reader.load().select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in HISTORY.fields)
    )
