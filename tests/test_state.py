"""Running sums in a checkpoint: looked at, and carried over to other state partitions."""

from dataclasses import replace

import pytest

from ordertally.functions.values import EXACT
from ordertally.operators import kpi_current
from ordertally.plans.handover import backfill_for_stream, read_ends, source_after
from ordertally.settings import Kafka, Landing, Settings
from ordertally.sources import read_archive, read_history
from ordertally.streaming import carry_over, run, totals_state, wait
from ordertally.streaming.jobs import session_conf
from ordertally.streaming.state import read_by
from tests.helpers import customers, land, order, tuples

SHOPPERS = [(1, "Google", "TX"), (2, "Twitter", "CA"), (3, "Google", "TX"), (4, None, "NY")]


def job(folder, **options):
    return Settings(
        checkpoint_root=f"{folder}/checkpoints",
        archive_path=f"{folder}/archive",
        history_path=f"{folder}/history",
        source=Landing(f"{folder}/landing of messages"),
        trigger=None,
        **{"state_partitions": 3, **options},
    )


def moved(settings, folder, **options):
    new = {name: f"{folder}/{name}" for name in ("totals_checkpoint", "handover_path", "history_path")}
    return replace(settings, **{"state_partitions": 5, **new, **options})


def sums(spark, settings, batch=None):
    return tuples(totals_state(spark, settings, batch).drop("state_partition"))


def widths(spark, settings):
    checkpoint = settings.totals_checkpoint or f"{settings.checkpoint_root}/totals"
    return {r["numPartitions"] for r in spark.read.format("state-metadata").load(checkpoint).collect()}


def current(spark, settings):
    return tuples(kpi_current(read_history(spark, settings.history_path)))


@pytest.mark.parametrize("options", [{}, {"exact": True}, {"broadcast_bytes": 0}], ids=["double", "exact", "join"])
def test_other_width(spark, tmp_path, options):
    settings, dimension = job(tmp_path, **options), customers(spark, SHOPPERS)
    landing = settings.source.path
    land(spark, landing, order(10.5, 1, "a"), order(None, 2, "b"), order(7, 4, "x"))
    wait(spark, run(spark, settings, dimension))
    land(spark, landing, order(2, 3, "c"))
    wait(spark, run(spark, settings, dimension))
    first = [("Google", "TX", 10.5), ("Twitter", "CA", None), (None, "NY", 7.0)]
    then = [("Google", "TX", 12.5), *first[1:]]
    assert [(a, b, c and float(c)) for a, b, c in sums(spark, settings, 0)] == first
    assert [(a, b, c and float(c)) for a, b, c in sums(spark, settings)] == then
    found = totals_state(spark, settings)
    assert found.schema["amount"].dataType.simpleString() == (EXACT if settings.exact else "double").replace(" ", "")
    assert {r["state_partition"] for r in found.collect()} <= set(range(3))

    wider = moved(settings, tmp_path / "wider")
    carry_over(spark, settings, wider)
    assert current(spark, wider) == then
    land(spark, landing, order(1, 2, "d"))
    for _ in range(2):  # a restart takes the sums no second time
        wait(spark, run(spark, wider, dimension))
        assert current(spark, wider) == [then[0], ("Twitter", "CA", 1.0), then[2]]
    assert (widths(spark, settings), widths(spark, wider)) == ({3}, {5})
    # Carried over once more, after a restart; the archive has gone on all the time.
    last = moved(wider, tmp_path / "last", state_partitions=2)
    carry_over(spark, wider, last)
    land(spark, landing, order(4, 4, "e"))
    wait(spark, run(spark, last, dimension))
    assert current(spark, last) == [then[0], ("Twitter", "CA", 1.0), (None, "NY", 11.0)]
    assert widths(spark, last) == {2}
    archived = [r["order_id"] for r in read_archive(spark, settings.archive_path).collect()]
    assert sorted(archived) == ["a", "b", "c", "d", "e", "x"]


def test_a_batch_that_was_not_committed_is_read_again(spark, tmp_path):
    settings, dimension = job(tmp_path), customers(spark, SHOPPERS)
    for n, amount in enumerate((1, 20)):
        land(spark, settings.source.path, order(amount, 1, f"{n}"))
        wait(spark, run(spark, settings, dimension))
    commits = tmp_path / "checkpoints" / "totals" / "commits"
    (commits / "1").unlink()
    (commits / ".1.crc").unlink(missing_ok=True)
    wider = moved(settings, tmp_path / "wider")
    carry_over(spark, settings, wider)
    assert sums(spark, settings) == [("Google", "TX", 1.0)]
    wait(spark, run(spark, wider, dimension))
    assert current(spark, wider) == [("Google", "TX", 21.0)]


def test_after_a_backfill_and_a_compacted_log(spark, tmp_path):
    settings = job(tmp_path, handover_path=f"{tmp_path}/backfill")
    dimension = customers(spark, SHOPPERS)
    land(spark, settings.source.path, order(100, 1, "a"))
    backfill_for_stream(spark, settings, dimension)
    with session_conf(spark, {"spark.sql.streaming.fileSource.log.compactInterval": "2"}):
        for n in range(3):
            land(spark, settings.source.path, order(1, 1, f"b{n}"))
            wait(spark, run(spark, settings, dimension))
        assert list((tmp_path / "checkpoints" / "totals" / "sources").glob("*/1.compact"))
        wider = moved(settings, tmp_path / "wider")
        carry_over(spark, settings, wider)
        land(spark, settings.source.path, order(1000, 2, "c"))
        wait(spark, run(spark, wider, dimension))
    assert current(spark, wider) == [("Google", "TX", 103.0), ("Twitter", "CA", 1000.0)]


def test_broken_off(spark, tmp_path, monkeypatch):
    settings, dimension = job(tmp_path), customers(spark, SHOPPERS)
    land(spark, settings.source.path, order(1, 1, "a"))
    wait(spark, run(spark, settings, dimension))
    wider = moved(settings, tmp_path / "wider")
    from ordertally.plans import handover

    mark = handover._mark
    with monkeypatch.context() as patched:
        patched.setattr(handover, "_mark", lambda spark, path, rows: mark(spark, path, []))
        carry_over(spark, settings, wider)
    with pytest.raises(ValueError, match="not complete"):
        run(spark, wider, dimension)
    assert spark.streams.active == []
    carry_over(spark, settings, wider)
    wait(spark, run(spark, wider, dimension))
    assert current(spark, wider) == [("Google", "TX", 1.0)]


def test_kafka_offsets_of_a_batch(spark, tmp_path):
    offsets = tmp_path / "checkpoints" / "totals" / "offsets"
    offsets.mkdir(parents=True)
    (offsets / "6").write_text('v1\n{"batchWatermarkMs":0}\n{"my-topic":{"0":8,"11":1}}\n-\n')
    kafka = Kafka("h:1", "my-topic", "latest")
    settings = replace(job(tmp_path), source=kafka)
    assert tuples(read_by(spark, settings, 6)) == [("my-topic-0", 8), ("my-topic-11", 1)]
    wider = moved(settings, tmp_path / "wider")
    from ordertally.plans.handover import write_ends, write_totals

    write_ends(read_by(spark, settings, 6), wider.handover_path)
    write_totals(spark.createDataFrame([("a", "b", 1.0)], "source string, state string, amount double"), wider)
    assert read_ends(spark, wider.handover_path).count() == 2
    assert source_after(spark, kafka, wider.handover_path).starting_offsets == '{"my-topic": {"0": 8, "11": 1}}'


def test_what_cannot_be_carried_over(spark, tmp_path):
    settings = job(tmp_path)
    good = moved(settings, tmp_path / "w")
    for before, after, message in (
        (settings, settings, "needs handover_path"),
        (replace(settings, dedup=True), good, "dedup"),
        (replace(settings, corrections_path="x"), good, "corrections"),
        (settings, replace(good, exact=True), "exact"),
        (settings, replace(good, totals_checkpoint=None), "new checkpoint"),
        (settings, replace(good, history_path=settings.history_path), "new checkpoint"),
        (replace(settings, handover_path=good.handover_path), good, "new checkpoint"),
    ):
        with pytest.raises(ValueError, match=message):
            carry_over(spark, before, after)
