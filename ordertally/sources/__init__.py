from ordertally.sources.messages import (
    file_batch,
    file_stream,
    kafka_batch,
    kafka_stream,
    message_batch,
    message_stream,
)
from ordertally.sources.tables import (
    read_archive,
    read_customers,
    read_history,
    read_history_jdbc,
    read_orders_csv,
    read_products,
    read_rejects,
)

__all__ = [
    "file_batch",
    "file_stream",
    "kafka_batch",
    "kafka_stream",
    "message_batch",
    "message_stream",
    "read_archive",
    "read_customers",
    "read_history",
    "read_history_jdbc",
    "read_orders_csv",
    "read_products",
    "read_rejects",
]
