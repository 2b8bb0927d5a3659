"""Tables that batches are taken into: current orders, snapshots of totals, publishes."""

import random

import pytest

from ordertally.operators import archive_current, kpi_current
from ordertally.operators import current_table
from ordertally.operators.current_table import read_current, update_current
from ordertally.plans import jobs
from ordertally.plans.jobs import compact_history, current_totals, publish_files
from ordertally.sources import file_batch, read_archive, read_history
from ordertally.sources.folders import names_in, numbered
from ordertally.streaming import start_archive
from tests.helpers import messages, order, tuples
from tests.test_streaming import Place

SHOWN = ("order_id", "total", "customer_id", "batch_id")


def test_current_table_follows_the_archive(spark, tmp_path):
    rng = random.Random(1)
    place = Place(spark, tmp_path, current_path=f"{tmp_path}/current", current_buckets=5)
    for part in range(3):
        sent = [order(rng.randrange(100), 1, f"id{rng.randrange(30)}") for _ in range(40)]
        place.land(*sent, "not json", order(1, 1))
        place.archive()
        expected = archive_current(read_archive(spark, place.settings.archive_path))
        found = read_current(spark, place.settings.current_path)
        assert tuples(found.select(*SHOWN)) == tuples(expected.select(*SHOWN))
        assert len({r["order_id"] for r in found.collect()}) == found.count()
    start_archive(place.stream(), place.settings).awaitTermination()  # nothing new


def orders(spark, *rows):
    frame = messages(spark, *(order(total, 1, name) for name, total in rows))
    from ordertally.functions import screen

    return screen(frame)


def test_only_buckets_of_the_batch_are_written(spark, tmp_path):
    path = f"{tmp_path}/current"
    names = [f"id{n}" for n in range(200)]
    update_current(orders(spark, *((n, 1) for n in names)), path, 0, 16)
    update_current(orders(spark, ("id7", 2), ("id7", 3)), path, 1, 16)
    assert len(names_in(spark, f"{path}/rows/commit=0")) >= 16
    written = [n for n in names_in(spark, f"{path}/rows/commit=1") if n.startswith("bucket=")]
    assert len(written) == 1
    found = {r["order_id"]: r["total"] for r in read_current(spark, path).collect()}
    assert found == {name: "3" if name == "id7" else "1" for name in names}
    update_current(orders(spark, ("id7", 9)), path, 1, 16)  # the batch comes again
    update_current(orders(spark, ("id7", 9)), path, 0, 16)
    assert {r["total"] for r in read_current(spark, path).where("order_id = 'id7'").collect()} == {"3"}
    update_current(orders(spark), path, 2, 16)  # an empty batch
    assert read_current(spark, path).count() == 200


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/current"
    update_current(orders(spark, ("a", 1), ("b", 1)), path, 0, 4)
    with monkeypatch.context() as broken:
        broken.setattr(current_table, "_LIST", "no schema at all")
        with pytest.raises(Exception):
            update_current(orders(spark, ("a", 2)), path, 1, 4)
    before = {r["order_id"]: r["total"] for r in read_current(spark, path).collect()}
    assert before == {"a": "1", "b": "1"}
    update_current(orders(spark, ("a", 2)), path, 1, 4)
    assert {r["order_id"]: r["total"] for r in read_current(spark, path).collect()} == {"a": "2", "b": "1"}


def test_nothing_there(spark, tmp_path):
    assert read_current(spark, f"{tmp_path}/none").collect() == []


def test_compaction(spark, tmp_path):
    place = Place(spark, tmp_path)
    path = place.settings.history_path
    rng = random.Random(2)
    for part in range(5):
        place.land(*(order(rng.randrange(9), rng.choice([1, 2, 3])) for _ in range(5)))
        place.totals()
        if part in (1, 3):
            assert compact_history(spark, path) == part
        assert tuples(current_totals(spark, path)) == tuples(kpi_current(read_history(spark, path)))
    files = current_totals(spark, path).inputFiles()
    assert all("upto=3" in name or "batch_id=4" in name for name in files) and len(files) <= 8
    assert compact_history(spark, path) == 4 and compact_history(spark, path) == 4


def test_compaction_takes_complete_batches_alone(spark, tmp_path):
    place = Place(spark, tmp_path)
    path = place.settings.history_path
    for total in (1, 2, 4):
        place.land(order(total, 1))
        place.totals()
    (tmp_path / "history" / "batch_id=1" / "_SUCCESS").unlink()  # still being written
    assert compact_history(spark, path) == 0
    assert tuples(current_totals(spark, path)) == [("Google", "TX", 7.0)]


def test_a_compaction_that_dies_is_not_seen(spark, tmp_path):
    place = Place(spark, tmp_path)
    path = place.settings.history_path
    place.land(order(1, 1))
    place.totals()
    compact_history(spark, path)
    (tmp_path / "history-snapshots" / "upto=0" / "_SUCCESS").unlink()
    assert numbered(spark, f"{path}-snapshots", "upto") == []
    assert tuples(current_totals(spark, path)) == [("Google", "TX", 1.0)]
    assert compact_history(spark, path) == 0


def published(spark, path):
    return sorted(bytes(r["value"]).decode() for r in file_batch(spark, path).collect())


def test_publish_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/landing"
    sent = [order(n, 1, f"id{n}") for n in range(40)]
    batch = messages(spark, *sent).repartition(4)
    moved = []

    def some(spark, source, target):
        if len(moved) == 2:
            raise OSError("broken off")
        moved.append(source)
        move(spark, source, target)

    move = jobs.move
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "move", some)
        with pytest.raises(OSError, match="broken off"):
            publish_files(batch, path, "day-1")
    assert 0 < len(published(spark, path)) < 40
    for _ in range(2):
        publish_files(batch.repartition(3), path, "day-1")
        assert published(spark, path) == sorted(sent)
    publish_files(messages(spark, "{}"), path, "day-2")
    publish_files(messages(spark, "{}"), path)
    assert len(published(spark, path)) == 42
    with pytest.raises(ValueError, match="publish id"):
        publish_files(batch, path, "a/b")
