"""Small message tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import types as T

MESSAGES = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("origin", T.StringType()),
        T.StructField("position", T.LongType()),
    ]
)
NOON = datetime(2024, 1, 1, 12)

# Key 1 is listed twice.
CUSTOMERS = [(1, "Google", "TX"), (2, "Twitter", "CA"), (1, "Dup", "NY")]
CUSTOMER_COLUMNS = "customer_id bigint, source string, state string"


def messages(spark, *values, timestamp=NOON):
    """Raw texts (or bytes, or None) as messages."""
    rows = [
        (v.encode() if isinstance(v, str) else v, timestamp, "t-0", n)
        for n, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, MESSAGES)


def order(total=None, customer_id=None, order_id=None):
    fields = {"order_id": order_id, "total": total, "customer_id": customer_id}
    return json.dumps({k: v for k, v in fields.items() if v is not None})


def customers(spark, rows=CUSTOMERS):
    return spark.createDataFrame(rows, CUSTOMER_COLUMNS)


def land(spark, path, *values, timestamp=NOON):
    """Add messages to a landing directory, as one file."""
    batch = messages(spark, *values, timestamp=timestamp).select("value", "timestamp")
    batch.coalesce(1).write.mode("append").parquet(path)


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
