"""Database targets without a database: what would be read and written."""

import json
from datetime import datetime

import pytest

from ordertally.plans.jobs import publish_kafka
from ordertally.schemas import HISTORY, ORDER_FIELDS
from ordertally.settings import (
    Cassandra,
    Jdbc,
    Kafka,
    Landing,
    Settings,
    from_mapping,
    read_settings,
)
from ordertally.sources import read_rejects
from ordertally.streaming import sinks
from tests.helpers import messages, order, tuples

JDBC = Jdbc("jdbc:x:y", "totals", "a.Driver")


@pytest.fixture
def table(spark, tmp_path, monkeypatch):
    """A Parquet table in the place of the database table."""
    path = f"{tmp_path}/table"

    def append(rows, _):
        rows.write.mode("append").parquet(path)

    def read(*_):
        return spark.read.schema(HISTORY).parquet(path)

    monkeypatch.setattr(sinks, "append_jdbc", append)
    monkeypatch.setattr(sinks, "read_history_jdbc", read)
    sinks.create_history_jdbc(spark, JDBC)
    return read


def totals(spark, *rows):
    return spark.createDataFrame(rows, "source string, state string, total_sum_amount double")


def test_history_takes_a_batch_twice(spark, table):
    write = sinks.to_history_jdbc(JDBC)
    batch = totals(spark, ("g", "TX", 1.0), (None, None, 2.0), ("n", None, None))
    write(batch, 0)
    write(batch, 0)
    write(totals(spark, ("g", "TX", 3.0)), 1)
    rows = table().drop("processed_at")
    assert tuples(rows) == [
        ("g", "TX", 1.0, 0), ("g", "TX", 3.0, 1), ("n", None, None, 0), (None, None, 2.0, 0),
    ]
    assert table().where("processed_at IS NULL").count() == 0


def test_history_completes_a_batch_written_in_part(spark, table):
    half = sinks.fit(sinks.with_lineage(totals(spark, ("g", "TX", 1.0)), 4), HISTORY)
    sinks.append_jdbc(half, JDBC)
    sinks.to_history_jdbc(JDBC)(totals(spark, ("g", "TX", 1.0), ("h", "TX", 2.0)), 4)
    assert tuples(table().drop("processed_at")) == [("g", "TX", 1.0, 4), ("h", "TX", 2.0, 4)]


def test_lineage_columns(spark):
    rows = sinks.with_lineage(totals(spark, ("g", "TX", 1.0)), 2**40)
    assert dict(rows.dtypes)["processed_at"] == "timestamp"
    assert dict(rows.dtypes)["batch_id"] == "bigint"
    (row,) = rows.collect()
    assert row["batch_id"] == 2**40
    assert isinstance(row["processed_at"], datetime) and row["processed_at"].microsecond == 0


def test_cassandra_gets_accepted_orders_as_text(spark, tmp_path, monkeypatch):
    saved = []

    def save(self, *_):
        saved.append(self)

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.save", save)
    batch = sinks.archive_rows(messages(spark, order(1, 2, "a"), "not json"))
    sinks.to_cassandra(Cassandra("ks", "orders"), f"{tmp_path}/rejects")(batch, 3)
    (writer,) = saved
    written = writer._df
    assert written.columns == [*ORDER_FIELDS, "timestamp"]
    assert {kind for _, kind in written.dtypes} == {"string"}
    assert [row["order_id"] for row in written.collect()] == ["a"]
    refused = read_rejects(spark, f"{tmp_path}/rejects").collect()
    assert [(bytes(r["value"]), r["batch_id"]) for r in refused] == [(b"not json", 3)]


def test_cassandra_gets_the_last_version_of_an_order(spark, tmp_path, monkeypatch):
    saved = []
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameWriter.save", lambda self, *_: saved.append(self._df)
    )
    versions = [order(total, 2, "a") for total in (3.0, 1.0, 2.0)]
    batch = sinks.archive_rows(messages(spark, *versions, order(7.0, 2, "b")))
    # Whatever the order of the rows, the highest position wins.
    for rows in (batch, batch.orderBy("position"), batch.orderBy(batch.position.desc())):
        sinks.to_cassandra(Cassandra("ks", "orders"), f"{tmp_path}/rejects")(rows, 0)
        sent = saved[-1].select("order_id", "total").collect()
        assert sorted((row[0], float(row[1])) for row in sent) == [("a", 2.0), ("b", 7.0)]


def test_history_in_few_files(spark, tmp_path):
    rows = spark.range(500).selectExpr(
        "'s' || id AS source", "'TX' AS state", "CAST(id AS double) AS total_sum_amount"
    )
    spread = rows.repartition(200, "source")
    sinks.to_history(f"{tmp_path}/history", files=3)(spread, 0)
    assert 1 <= len(list(tmp_path.glob("history/batch_id=0/part-*.parquet"))) <= 3
    assert spark.read.parquet(f"{tmp_path}/history").count() == 500


def test_every_name_of_the_mysql_section(tmp_path):
    mysql = {"host": "db", "port": 1, "driver": "a.D", "database": "d", "table": "t"}
    given = mysql | {"max_connections": 2, "options": {"batchsize": "9"}}
    others = {"checkpoint_root": "/c", "archive_path": "/a"}
    jdbc = from_mapping({"mysql": given}, **others).jdbc
    assert (jdbc.url, jdbc.table, jdbc.max_connections) == ("jdbc:mysql://db:1/d", "t", 2)
    assert jdbc.properties()["batchsize"] == "9"
    with pytest.raises(TypeError):
        from_mapping({"mysql": mysql | {"tabel": "x"}}, **others)


def test_publish_kafka(spark, monkeypatch):
    saved = []
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameWriter.options",
        lambda self, **options: saved.append((self._df.columns, options)) or self,
    )
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.save", lambda self: None)
    kafka = Kafka("h:1", "orders", options={"kafka.security.protocol": "SSL", "groupIdPrefix": "x"})
    publish_kafka(messages(spark, "{}"), kafka)
    assert saved == [
        (
            ["value"],
            {
                "kafka.bootstrap.servers": "h:1",
                "topic": "orders",
                "kafka.security.protocol": "SSL",
            },
        )
    ]


def test_settings_from_a_config_file(monkeypatch):
    config = {
        "kafka": {"topic": "orders", "bootstrap_server": "localhost:9092"},
        "mysql": {
            "host": "db", "port": 3306, "driver": "a.Driver", "database": "d", "table": "t",
        },
        "cassandra": {"host": "c", "port": 9042, "keyspace": "ks", "table": "orders"},
        "jars": {"dir": "/somewhere"},
    }
    settings = from_mapping(
        config, checkpoint_root="/c", archive_path="/a", customers_path="/customers.csv"
    )
    assert settings.source == Kafka("localhost:9092", "orders")
    assert settings.jdbc.url == "jdbc:mysql://db:3306/d"
    assert settings.cassandra.options() == {
        "keyspace": "ks",
        "table": "orders",
        "spark.cassandra.connection.host": "c",
        "spark.cassandra.connection.port": "9042",
    }
    assert settings.trigger == "15 seconds"
    monkeypatch.setenv("MYSQL_USERNAME", "me")
    monkeypatch.delenv("MYSQL_PASSWORD", raising=False)
    assert settings.jdbc.properties() == {"driver": "a.Driver", "user": "me"}


def test_settings_from_json(tmp_path):
    config = {
        "landing": {"path": "/landing", "max_files_per_trigger": 5},
        "job": {
            "checkpoint_root": "/c",
            "archive_path": "/a",
            "history_path": "/h",
            "customers_path": "/customers.csv",
            "dedup": True,
        },
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config))
    settings = read_settings(str(path))
    assert settings.source == Landing("/landing", 5)
    assert settings.dedup and settings.jdbc is None and settings.history_path == "/h"


def test_totals_need_a_target():
    with pytest.raises(ValueError, match="history_path"):
        Settings(checkpoint_root="/c", archive_path="/a")


