from datetime import datetime

import pytest

from ordertally.operators import archive_current, kpi_current
from ordertally.plans.jobs import publish_orders_csv
from ordertally.schemas import ARCHIVE, HISTORY, ORDER_FIELDS
from ordertally.sources import file_batch, read_customers, read_orders_csv, read_products
from ordertally.functions import decode
from tests.helpers import NOON, tuples


def write(path, text):
    path.write_text(text)
    return str(path)


def test_read_customers(spark, tmp_path):
    path = write(
        tmp_path / "customers.csv",
        "name,state,customer_id,source\nAnn,TX,1,Google\nBob,CA,2.0,\nCy,,x,Twitter\n",
    )
    table = read_customers(spark, path)
    assert tuples(table) == [("1", "Google", "TX"), ("2", None, "CA"), ("x", "Twitter", None)]
    assert dict(table.dtypes)["customer_id"] == "string"


def test_csv_with_other_header_fails(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    write(folder / "a.csv", "customer_id,source,state\n" + "1,a,b\n" * 50)
    write(folder / "b.csv", "source,customer_id,state\na,1,b\n")
    with pytest.raises(Exception, match="header"):
        read_customers(spark, str(folder)).collect()


def test_read_products(spark, tmp_path):
    path = write(
        tmp_path / "products.csv",
        "ID,Category,Created At,Ean,Price,Rating,Title,Vendor\n"
        '7,Gizmo,2020-01-02T05:30:00.500+05:30,0012345678905,9.5,4.0,A Thing,"One, Two and Co"\n',
    )
    (row,) = read_products(spark, path).collect()
    assert row["Ean"] == "0012345678905"
    assert row["Vendor"] == "One, Two and Co"
    assert row["Created At"] == datetime(2020, 1, 2, 0, 0, 0, 500000)


def test_publish_orders_csv(spark, tmp_path):
    header = ",".join(reversed(ORDER_FIELDS))
    path = write(tmp_path / "orders.csv", f"extra,{header}\nz,9,8,7,6,5,4,,2,1\n")
    assert tuple(read_orders_csv(spark, path).first()) == (
        "1", "2", None, "4", "5", "6", "7", "8", "9",
    )
    landing = str(tmp_path / "landing")
    publish_orders_csv(spark, path, landing)
    publish_orders_csv(spark, path, landing)
    decoded = decode(file_batch(spark, landing))
    assert decoded.count() == 2
    assert tuple(decoded.select(*ORDER_FIELDS).first()) == (
        "1", "2", None, "4", "5", "6", "7", "8", "9",
    )
    assert decoded.select("origin", "position").distinct().count() == 2


def test_orders_csv_without_some_fields(spark, tmp_path):
    path = write(tmp_path / "orders.csv", "total,customer_id\n1.5,7\n")
    (row,) = read_orders_csv(spark, path).collect()
    assert (row["total"], row["customer_id"], row["order_id"]) == ("1.5", "7", None)


def archived(spark, rows):
    blank = {f.name: None for f in ARCHIVE.fields}
    full = [tuple({**blank, "timestamp": NOON, "origin": "t-0", **row}.values()) for row in rows]
    return spark.createDataFrame(full, ARCHIVE)


def test_archive_current_takes_the_last_write(spark):
    rows = [
        {"order_id": "a", "total": "1", "batch_id": 0, "position": 9},
        {"order_id": "a", "total": "2", "batch_id": 2, "position": 1},
        {"order_id": "a", "total": "3", "batch_id": 1, "position": 5},
        {"order_id": "b", "total": "4", "batch_id": 0, "position": 1},
        {"order_id": "b", "total": None, "batch_id": 0, "position": 2},
    ]
    current = archive_current(archived(spark, rows))
    assert tuples(current.select("order_id", "total")) == [("a", "2"), ("b", None)]
    assert set(current.columns) == {f.name for f in ARCHIVE.fields}


def test_kpi_current(spark):
    later = datetime(2024, 1, 2)
    rows = [
        ("g", "TX", 1.0, NOON, 0),
        ("g", "TX", 3.0, NOON, 1),
        (None, None, 5.0, NOON, 0),
        ("n", "CA", 2.0, NOON, 0),
        ("n", "CA", None, NOON, 3),
    ]
    history = spark.createDataFrame(rows, HISTORY)
    assert tuples(kpi_current(history)) == [
        ("g", "TX", 3.0), ("n", "CA", None), (None, None, 5.0),
    ]
    # A job without checkpoint started again: batch 0 is the latest.
    again = history.union(spark.createDataFrame([("g", "TX", 0.5, later, 0)], HISTORY))
    assert ("g", "TX", 0.5) in tuples(kpi_current(again, by_time=True))


def test_quotes_and_line_breaks_in_csv(spark, tmp_path):
    path = write(
        tmp_path / "orders.csv",
        'order_id,created_at,total,customer_id\n1,"he said ""hi"", ok",5,1\n',
    )
    row = read_orders_csv(spark, path).first()
    assert (row["created_at"], row["total"], row["customer_id"]) == ('he said "hi", ok', "5", "1")
    path = write(
        tmp_path / "lines.csv", 'order_id,created_at,total,customer_id\n1,"a\nb",5,1\n'
    )
    rows = read_orders_csv(spark, path, multi_line=True).collect()
    assert [(r["order_id"], r["created_at"], r["total"]) for r in rows] == [("1", "a\nb", "5")]
