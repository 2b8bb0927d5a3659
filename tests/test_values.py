import pytest
from pyspark.sql import functions as F

from ordertally.functions import amount, customer_key

KEYS = [
    ("1", 1),
    ("1.0", 1),
    (" 2 ", 2),
    ("1e3", 1000),
    ("-1.7", -1),
    ("9007199254740993", 9007199254740993),
    ("99999999999999999999", None),
    ("abc", None),
    ('"NaN"', None),
    ("true", None),
    ("", None),
    (None, None),
]

AMOUNTS = [
    ("1.5", 1.5),
    (" 3 ", 3.0),
    ("100.0", 100.0),
    ("-2", -2.0),
    ("x", None),
    ("NaN", None),
    ('"NaN"', None),
    ("Infinity", None),
    ('"Infinity"', None),
    ("-Infinity", None),
    ("1E400", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize(
    "convert, cases", [(customer_key, KEYS), (amount, AMOUNTS)], ids=["key", "amount"]
)
def test_conversion(spark, ansi, convert, cases):
    texts = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(cases)], "n int, t string")
    rows = texts.select("n", convert(F.col("t")).alias("v")).orderBy("n").collect()
    assert [row["v"] for row in rows] == [expected for _, expected in cases]
