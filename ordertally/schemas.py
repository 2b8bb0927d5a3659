"""Column contracts of every table and message the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The nine fields of an order message.
ORDER_FIELDS = (
    "order_id",
    "created_at",
    "discount",
    "product_id",
    "quantity",
    "subtotal",
    "tax",
    "total",
    "customer_id",
)

# Columns that travel beside a message: when it was received, and which message
# it was. (origin, position) is unique per message and the same on a replay:
# topic-partition and offset for Kafka, file and row number for files.
ARRIVAL = ("timestamp", "origin", "position")


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


ORDER = strings(*ORDER_FIELDS)

MESSAGE_FILE = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("state", T.StringType()),
    ]
)

# Ean stays text: it has leading zeros.
PRODUCT = T.StructType(
    [
        T.StructField("ID", T.IntegerType()),
        T.StructField("Category", T.StringType()),
        T.StructField("Created At", T.TimestampType()),
        T.StructField("Ean", T.StringType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Rating", T.DoubleType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Vendor", T.StringType()),
    ]
)

# Accepted and rejected messages share one table, told apart by `kind`, so that a
# micro-batch is decoded and committed once. `value` holds the raw bytes of a
# rejected message (and of accepted ones on request), `reason` why it was rejected.
ARCHIVE = T.StructType(
    list(ORDER.fields)
    + [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("origin", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("total_sum_amount", T.DoubleType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Totals that orders can be taken out of again, with the orders that are left in a group.
CORRECTED = T.StructType([*HISTORY.fields, T.StructField("orders", T.LongType())])
