import json

from pyspark.sql import functions as F

from ordertally.functions import decode, encode, rejects, screen
from ordertally.schemas import ORDER_FIELDS
from ordertally.sources.messages import from_records, kafka_options
from ordertally.settings import Kafka
from tests.helpers import NOON, messages, tuples

# message, then order_id, total, customer_id, reason
CASES = [
    ('{"order_id": 1, "total": NaN, "customer_id": 10.50}', "1", '"NaN"', "10.5", None),
    ('{"order_id": 2, "total": 1e2, "customer_id": 2.0}', "2", "100.0", "2.0", None),
    ('{"order_id": 3, "total": null, "customer_id": "1"}', "3", None, "1", None),
    ('{"order_id": 4, "total": 1E400}', "4", '"Infinity"', None, None),
    ('{"order_id":1,"order_id":2}', "2", None, None, None),
    ('{"order_id": {"a": 1}, "total": [1, 2], "customer_id": true}',
     '{"a":1}', "[1,2]", "true", None),
    ('{"order_id": 9007199254740993}', "9007199254740993", None, None, None),
    ("not json", None, None, None, "malformed"),
    ('{"order_id": 9, "total": 5', None, None, None, "malformed"),
    ('[{"order_id": 7}]', None, None, None, "malformed"),
    ("[]", None, None, None, "malformed"),
    ("5", None, None, None, "malformed"),
    ('"x"', None, None, None, "malformed"),
    ('{"ORDER_ID": 8}', None, None, None, "no order_id"),
    ("{}", None, None, None, "no order_id"),
    ('{"total": 5, "customer_id": 1}', None, "5", "1", "no order_id"),
    ('{"order_id": NaN, "total": 5}', None, "5", None, "no order_id"),
    ('{"order_id": " ", "total": 5}', None, "5", None, "no order_id"),
    (r'{"order_id": "\"NaN\"", "total": 5}', '"NaN"', "5", None, None),
    ('{"order_id": "NaN", "total": 5}', "NaN", "5", None, None),
    ("", None, None, None, "empty"),
    ("  ", None, None, None, "empty"),
    (None, None, None, None, "empty"),
]


def test_screen(spark, ansi):
    screened = screen(messages(spark, *(case[0] for case in CASES)))
    rows = screened.orderBy("position").collect()
    got = [(r["order_id"], r["total"], r["customer_id"], r["reason"]) for r in rows]
    assert got == [case[1:] for case in CASES]


def test_decode_gives_one_row_per_message(spark, ansi):
    decoded = decode(messages(spark, *(case[0] for case in CASES)), ["total", "customer_id"])
    assert decoded.columns == ["total", "customer_id", "timestamp", "origin", "position"]
    rows = decoded.orderBy("position").collect()
    assert [(r["total"], r["customer_id"]) for r in rows] == [case[2:4] for case in CASES]


def test_decode_takes_all_fields(spark):
    assert decode(messages(spark, "{}")).columns[:9] == list(ORDER_FIELDS)


def test_invalid_utf8_is_replaced(spark):
    raw = b'{"order_id": "a\xffb"}'
    assert decode(messages(spark, raw)).first()["order_id"] == "a�b"


def test_rejects_keep_the_whole_message(spark):
    text = "word " * 20_000
    raw = b"\xff\xfe not text"
    refused = rejects(messages(spark, text, '{"order_id": 1}', raw))
    got = {(bytes(r["value"]), r["reason"]) for r in refused.collect()}
    assert got == {(text.encode(), "malformed"), (raw, "malformed")}


def test_encode(spark):
    rows = spark.createDataFrame(
        [(1, "é", None, float("nan"), NOON)],
        "order_id int, created_at string, discount double, total double, timestamp timestamp",
    )
    message = encode(rows).first()
    assert message["timestamp"] == NOON
    fields = json.loads(bytes(message["value"]).decode())
    assert fields == {"order_id": 1, "created_at": "é", "total": "NaN"}


def test_encode_stamps_messages_without_a_time(spark):
    rows = spark.createDataFrame([("1",)], "order_id string")
    message = encode(rows)
    assert message.columns == ["value", "timestamp"]
    assert message.first()["timestamp"] is not None


def test_encode_then_decode(spark):
    rows = spark.range(100).select(
        *((F.col("id") + n).cast("string").alias(f) for n, f in enumerate(ORDER_FIELDS))
    )
    assert tuples(decode(encode(rows)).select(*ORDER_FIELDS)) == tuples(rows)


def test_kafka_records(spark):
    records = spark.createDataFrame(
        [(None, b"{}", "orders", 3, 17, NOON, 0)],
        "key binary, value binary, topic string, partition int, offset long,"
        " timestamp timestamp, timestampType int",
    )
    row = from_records(records).first()
    assert (bytes(row["value"]), row["origin"], row["position"]) == (b"{}", "orders-3", 17)


def test_kafka_options():
    assert kafka_options(Kafka("host:9092", "orders")) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "orders",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
    }
    limited = kafka_options(
        Kafka("h:1", "t", "earliest", max_offsets_per_trigger=10, min_partitions=4)
    )
    assert limited["startingOffsets"] == "earliest"
    assert limited["maxOffsetsPerTrigger"] == "10"
    assert limited["minPartitions"] == "4"
    secured = kafka_options(Kafka("h:1", "t", options={"kafka.security.protocol": "SSL"}))
    assert secured["kafka.security.protocol"] == "SSL"
