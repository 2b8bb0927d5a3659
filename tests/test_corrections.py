"""Corrected orders: the last version counts, however the messages are cut and replayed."""

import json
import random
import shutil
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ordertally.operators import corrected_current, corrected_totals
from ordertally.schemas import CORRECTED
from ordertally.settings import Landing, Settings
from ordertally.sources import file_batch, file_stream, read_history
from ordertally.streaming import corrections, run, start_corrections, wait
from ordertally.streaming.corrections import keyed_changes, last_versions
from tests.helpers import CUSTOMER_COLUMNS, NOON, messages, order, tuples

SHOPPERS = [(1, "Google", "TX"), (2, "Twitter", "CA"), (3, "Google", "TX")]
GOOGLE, TWITTER = ("Google", "TX"), ("Twitter", "CA")


def shoppers(spark, rows=SHOPPERS):
    return spark.createDataFrame(rows, CUSTOMER_COLUMNS)


class Place:
    def __init__(self, spark, folder, **options):
        self.spark, self.folder = spark, folder
        self.landing = f"{folder}/landing"
        self.settings = Settings(
            checkpoint_root=f"{folder}/checkpoints",
            archive_path=f"{folder}/archive",
            history_path=f"{folder}/history",
            corrections_path=f"{folder}/changes",
            trigger=None,
            **options,
        )

    def land(self, *timed):
        """Messages with their times, as one file."""
        rows = [(text.encode(), at) for text, at in timed]
        frame = self.spark.createDataFrame(rows, "value binary, timestamp timestamp")
        frame.coalesce(1).write.mode("append").parquet(self.landing)

    def totals(self):
        stream = file_stream(self.spark, Landing(self.landing, max_files_per_trigger=1))
        wait(self.spark, start_corrections(stream, shoppers(self.spark), self.settings))
        return self.current()

    def current(self):
        history = read_history(self.spark, self.settings.history_path, CORRECTED)
        return tuples(corrected_current(history))

    def at_once(self):
        batch = file_batch(self.spark, self.landing)
        rows = keyed_changes(last_versions(batch), shoppers(self.spark))
        totals = corrected_totals(rows, shoppers(self.spark)).drop("orders")
        return tuples(totals.withColumn("total_sum_amount", F.col("total_sum_amount").cast("double")))


def at(minutes):
    return NOON + timedelta(minutes=minutes)


@pytest.mark.parametrize("limit", [0, 2**20], ids=["shuffled", "broadcast"])
def test_an_order_is_replaced(spark, tmp_path, limit):
    place = Place(spark, tmp_path, broadcast_bytes=limit)
    place.land((order(10.1, 1, "a"), at(0)), (order(5.5, 2, "b"), at(0)))
    assert place.totals() == [(*GOOGLE, 10.1), (*TWITTER, 5.5)]
    place.land((order(0.2, 1, "a"), at(1)), (order(1.25, 3, "c"), at(1)))
    assert place.totals() == [(*GOOGLE, 1.45), (*TWITTER, 5.5)]
    place.land((order(99, 1, "a"), at(-5)))  # an old version that comes late
    assert place.totals() == [(*GOOGLE, 1.45), (*TWITTER, 5.5)]
    place.land((order(7, 1, "b"), at(2)))  # another customer: the last of a group goes
    assert place.totals() == [(*GOOGLE, 8.45)]
    place.land((order("x", 1, "b"), at(3)), (order("x", 1, "a"), at(3)), (order("x", 3, "c"), at(3)))
    assert place.totals() == [(*GOOGLE, None)]
    place.land((order(2, 1), at(4)), (order(2, 1), at(4)), (order(2, 99, "a"), at(4)))
    assert place.totals() == [(*GOOGLE, 4.0)]
    assert place.at_once() == [(*GOOGLE, 4.0)]


def random_messages(rng, count):
    """Orders that come again with other amounts, customers and times, ids that are none."""
    out = []
    for n in range(count):
        name = rng.choice([f"id{rng.randrange(40)}", "hot", "hot", None, " "])
        total = rng.choice([rng.randrange(1000) / 100, rng.randrange(9), "x", None])
        text = order(total, rng.choice([1, 2, 3, 9, "y"]), name)
        out.append((rng.choice([text, text, text, "junk", "{}"]), at(rng.randrange(60))))
    return out


def by_hand(files):
    last, nameless = {}, []
    for number, (name, rows) in enumerate(files):
        for position, (text, time) in enumerate(rows):
            fields = json.loads(text) if text != "junk" else {}
            key, content = fields.get("order_id"), (fields.get("customer_id"), fields.get("total"))
            if key is None or not key.strip():
                nameless.append(content)
            elif key not in last or (time, position, name) > last[key][0]:
                last[key] = ((time, position, name), content)
    groups, sums = {key: group for key, *group in SHOPPERS}, {}
    for customer, total in [*nameless, *(content for _, content in last.values())]:
        if customer in groups:
            group = tuple(groups[customer])
            before = sums.setdefault(group, None)
            if total is not None and total != "x":
                sums[group] = (before or Decimal(0)) + Decimal(str(total))
    return sorted(((*g, None if s is None else float(s)) for g, s in sums.items()), key=repr)


@pytest.mark.parametrize("files", [1, 3])
def test_random_corrections(spark, tmp_path, files):
    rng = random.Random(files)
    rows = random_messages(rng, 400)
    place = Place(spark, tmp_path)
    for part in range(files):
        place.land(*rows[part::files])
    found = place.totals()
    read = file_batch(spark, place.landing).orderBy("origin", "position").collect()
    landed = {}
    for r in read:
        landed.setdefault(r["origin"], []).append((bytes(r["value"]).decode(), r["timestamp"]))
    assert found == by_hand(sorted(landed.items())) == place.at_once()


def test_replay_and_restart(spark, tmp_path):
    place = Place(spark, tmp_path)
    place.land((order(10, 1, "a"), at(0)))
    place.totals()
    place.land((order(4, 1, "a"), at(1)), (order(1, 2, "b"), at(1)))
    place.totals()
    # As after a crash between what a batch does and its commit, in both queries.
    for query in ("corrections", "totals"):
        folder = tmp_path / "checkpoints" / query / "commits"
        (folder / "1").unlink()
        (folder / ".1.crc").unlink(missing_ok=True)
    assert place.totals() == [(*GOOGLE, 4.0), (*TWITTER, 1.0)]
    place.land((order(5, 1, "a"), at(2)))
    assert place.totals() == [(*GOOGLE, 5.0), (*TWITTER, 1.0)]


def test_no_python_for_each_order(spark, tmp_path):
    """The last versions are joined as a table, not handed to a function order by order."""
    place = Place(spark, tmp_path)
    place.land(*((order(n, 1 + n % 3, f"id{n}"), at(n % 7)) for n in range(500)))
    stream = file_stream(spark, Landing(place.landing))
    queries = start_corrections(stream, shoppers(spark), place.settings)
    wait(spark, queries)
    assert queries[0].name == "corrections"
    assert [list(p.stateOperators) for p in queries[0].recentProgress] == [[]]


def folders(path, name):
    return sorted(f.name for f in path.glob(f"{name}/*=*"))


@pytest.mark.parametrize("step", ["_changes", "move", "names_in", "_clear"])
def test_broken_off(spark, tmp_path, monkeypatch, step):
    """A batch dies with its rows half there, before its log, before its list, or after it."""
    place, table = Place(spark, tmp_path), tmp_path / "checkpoints" / "versions"
    place.land((order(10, 1, "a"), at(0)), (order(3, 3), at(0)))
    place.totals()
    place.land((order(4, 1, "a"), at(1)), (order(1, 2, "b"), at(1)), (order(2, 3), at(1)))
    own = getattr(corrections, step)

    def dies(session, *others):
        if step == "names_in" and "/rows/" not in others[0]:
            return own(session, *others)
        raise OSError("dies here")

    with monkeypatch.context() as patched:
        patched.setattr(corrections, step, dies)
        with pytest.raises(StreamingQueryException, match="dies here"):
            place.totals()
    if step == "_changes":
        (table / "rows" / "commit=1" / "_SUCCESS").unlink()
        next((table / "rows" / "commit=1").glob("bucket=*/*.parquet")).unlink()
    assert place.totals() == [(*GOOGLE, 9.0), (*TWITTER, 1.0)]
    assert folders(tmp_path, "changes") == ["batch_id=0", "batch_id=1"]
    place.land((order(5, 1, "a"), at(2)))
    assert place.totals() == [(*GOOGLE, 10.0), (*TWITTER, 1.0)]


def test_table_holds_the_last_versions_alone(spark, tmp_path):
    place, table = Place(spark, tmp_path), tmp_path / "checkpoints" / "versions"
    for minute in range(4):
        place.land((order(minute, 1, "a"), at(minute)), (order(1, 1), at(minute)))
    place.totals()
    assert folders(table, "lists") == ["commit=3"] and folders(table, "rows") == ["commit=3"]
    rows = spark.read.parquet(f"{table}/rows").select("order_id", "last.stamp").collect()
    assert [r["order_id"] for r in rows] == ["a"]


def test_a_log_without_its_table(spark, tmp_path):
    place = Place(spark, tmp_path)
    place.land((order(10, 1, "a"), at(0)))
    place.totals()
    shutil.rmtree(tmp_path / "checkpoints" / "versions")
    place.land((order(4, 1, "a"), at(1)))
    with pytest.raises(StreamingQueryException, match="lacks the batch"):
        place.totals()


def test_through_run(spark, tmp_path):
    place = Place(spark, tmp_path, source=Landing(f"{tmp_path}/landing"))
    place.land((order(10, 1, "a"), at(0)), (order(4, 1, "a"), at(1)))
    wait(spark, run(spark, place.settings, shoppers(spark)))
    assert place.current() == [(*GOOGLE, 4.0)]


def test_last_versions_without_times(spark):
    rows = messages(spark, order(1, 1, "a"), order(2, 1, "a"), timestamp=None)
    assert [r["amount"] for r in last_versions(rows).collect()] == [Decimal("2.0000000000")]
    later = messages(spark, order(3, 1, "a"), timestamp=datetime(1960, 1, 1))
    assert [r["amount"] for r in last_versions(rows.union(later)).collect()] == [Decimal("3.0000000000")]


def test_settings(tmp_path):
    with pytest.raises(ValueError, match="history_path"):
        Settings("c", "a", jdbc="db", corrections_path="x")
    with pytest.raises(ValueError, match="dedup"):
        Settings("c", "a", "h", dedup=True, corrections_path="x")
