"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks. A source of weight w owes its j-th block
(from 0) to the window from floor(j/w) to ceil((j+1)/w) slots: the block's release time and
deadline. Earliest deadline first, among the blocks that are released, fills the slots; with
weights that add up to one, every block meets its window, so that after any number of slots
each source is within one block of its share.

Weights are taken as the exact fractions that they are written as, and brought to whole
numbers without a common divisor. Their sum is the period, after which the schedule repeats:
with equal weights, the number of sources. There is one schedule, that of sources without an
end; a source that has run out leaves its slots empty, and no document is dropped or repeated.

The slot of a block is worked out in two ways, which agree. Where the period is short, from
the block's number and a table of one period, at most `period` rows whatever the corpus.
Where it is long, in frames of slots, each of them a row for Spark to deal out: which blocks
are done when a frame begins follows from its first slot alone, see `done_before`, so frames
need not know each other. A frame is at least as long as the longest window. The work is one
step for each slot up to the one in which the last source runs out, and a task holds a frame.

A weight of less than one in 2^20 of all has windows that no frame holds. Then the driver goes
through the blocks that there are, one at a time, and writes their slots in parts. That walk
knows when a source has run out and gives the slot to the next, so that it leaves none empty.

A null source is a source of its own. Without given weights each source has the same. A
source that the weights do not name, or whose weight is 0, has a null slot: it comes after
all scheduled blocks, in the order of sources. Blocks are counted by document; ties
in the order within a source go by text. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice
from math import gcd, lcm

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.llm.common import read_table, stored, unused, work_folder
from ordertally.operators.sizes import fits_broadcast

# The longest period whose table is sent to all tasks.
PERIOD = 2**16
BLOCK_DOCUMENTS = 8
# Slots of a longer schedule that a task works out at a time, at least and at most.
FRAME, LONGEST_FRAME = 2**14, 2**20
# Slots that the driver holds at a time, for weights whose windows are longer still.
PART_SLOTS = 2**18
_SLOTS = "turn_source string, turn bigint, turn_slot bigint"


def exact_weights(weights: Mapping) -> dict:
    """The least whole numbers in proportion to the weights, of the sources that have one."""
    exact = {source: Fraction(str(weight)) for source, weight in weights.items()}
    if any(weight < 0 for weight in exact.values()):
        raise ValueError("a weight is negative")
    scale = lcm(*(weight.denominator for weight in exact.values()))
    whole = {source: int(weight * scale) for source, weight in exact.items() if weight}
    divisor = gcd(*whole.values())
    return {source: number // divisor for source, number in whole.items()}


def longest_window(slots: Mapping) -> int:
    return -(-sum(slots.values()) // min(slots.values())) + 1


def done_before(shares: Sequence[int], at: int) -> list[int]:
    """How many blocks of each source are done before slot `at`, earliest deadlines first.

    Blocks due by then are done, blocks released later are not, and of each source at most one
    is open. The open ones that are done are those which the schedule prefers, in the order of
    their deadlines, as long as those taken can still be held by the slots after their release:
    a set of blocks fits if, from every slot t on, no more of them are released than there are
    slots from t to `at`. No slot stays empty, so the number taken is known.
    """
    period = sum(shares)
    due = [share * at // period for share in shares]
    open_ = [s for s, share in enumerate(shares) if share * at % period]
    taken = at - sum(due)
    if not taken:
        return due
    releases = {s: due[s] * period // shares[s] for s in open_}
    low = min(releases.values())
    # Beyond 64 bits numpy goes on with Python's whole numbers.
    kind = np.int64 if period * (at + 1) < 2**62 else object
    steps = sorted(set(releases.values()))
    slots = np.arange(low, steps[-1] + 1).astype(kind)
    room = at - slots
    for share, count in zip(shares, due, strict=True):
        room = room - np.maximum(count + (-share * slots) // period, 0)
    # Taking a block uses room at its release and before: the least room between releases will do.
    room = np.minimum.reduceat(room, [0] + [step + 1 - low for step in steps[:-1]])
    last = {step: n + 1 for n, step in enumerate(steps)}
    deadline = {s: -(-(due[s] + 1) * period // shares[s]) for s in open_}
    for s in sorted(open_, key=lambda s: (deadline[s], s)):
        upto = last[releases[s]]
        if taken and room[:upto].min() > 0:
            room[:upto] -= 1
            due[s] += 1
            taken -= 1
    return due


def turns_from(shares: Sequence[int], at: int = 0) -> Iterator[tuple[int, int]]:
    """The source, by its place in `shares`, and the block of every slot from `at` on: of the
    released blocks the one with the earliest deadline. Without an end."""
    period = sum(shares)

    def block(s: int, j: int) -> tuple:
        return j * period // shares[s], -(-(j + 1) * period // shares[s]), s, j

    waiting = [block(s, j) for s, j in enumerate(done_before(shares, at))]
    heapq.heapify(waiting)  # (release, deadline, source, block)
    released: list = []  # (deadline, source, block)
    while True:
        while waiting and waiting[0][0] <= at:
            heapq.heappush(released, heapq.heappop(waiting)[1:])
        _, s, j = heapq.heappop(released)
        yield s, j
        heapq.heappush(waiting, block(s, j + 1))
        at += 1


def pfair(slots: Mapping) -> list:
    """The source of each slot of one period."""
    names = list(slots)
    turns = turns_from(list(slots.values())) if names else iter(())
    return [names[s] for s, _ in islice(turns, sum(slots.values()))]


def frame_slots(spark: SparkSession, slots: Mapping, blocks: Mapping, frame: int = FRAME) -> DataFrame:
    """The slot of every block there is, frame by frame; `blocks` says how many a source has."""
    names, shares = list(slots), list(slots.values())
    period = sum(shares)
    held = [blocks.get(name) or 0 for name in names]
    frame = max(frame, longest_window(slots))
    end = max(-(-count * period // share) for count, share in zip(held, shares, strict=True))

    def work_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in batch.column("id").to_pylist():
                found = [
                    (names[s], j, first * frame + n)
                    for n, (s, j) in enumerate(islice(turns_from(shares, first * frame), frame))
                    if j < held[s]
                ]
                columns = [
                    pa.array([name for name, _, _ in found], pa.string()),
                    pa.array([j for _, j, _ in found], pa.int64()),
                    pa.array([slot for _, _, slot in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["turn_source", "turn", "turn_slot"])

    frames = -(-end // frame)
    tasks = min(frames, 8 * spark.sparkContext.defaultParallelism)
    return spark.range(0, frames, 1, max(tasks, 1)).mapInArrow(work_out, _SLOTS)


def turns_of(slots: Mapping, blocks: Mapping) -> Iterator[tuple]:
    """Source and number of each block, by earliest deadline among released blocks.

    `slots` are whole weights; `blocks` says how many blocks a source has. A slot in which
    no block is released stays empty.
    """
    period = sum(slots.values())
    order = {source: k for k, source in enumerate(slots)}

    def block(source, j: int) -> tuple:
        release = j * period // slots[source]
        deadline = -(-(j + 1) * period // slots[source])
        return release, deadline, order[source], source, j

    waiting = [block(source, 0) for source, share in slots.items() if share and blocks.get(source)]
    heapq.heapify(waiting)  # (release, deadline, order, source, block)
    released: list = []  # (deadline, order, source, block)
    slot = 0
    while waiting or released:
        if not released:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            _, deadline, place, source, j = heapq.heappop(waiting)
            heapq.heappush(released, (deadline, place, source, j))
        _, _, source, j = heapq.heappop(released)
        yield source, j
        if j + 1 < blocks[source]:
            heapq.heappush(waiting, block(source, j + 1))
        slot += 1


def long_schedule(spark: SparkSession, slots: Mapping, blocks: Mapping, folder: str) -> DataFrame:
    """The slot of every block there is, stored part by part."""
    turns = turns_of(slots, blocks)
    first = 0
    while part := list(islice(turns, PART_SLOTS)):
        columns = [
            pa.array([source for source, _ in part], pa.string()),
            pa.array([turn for _, turn in part], pa.int64()),
            pa.array(range(first, first + len(part)), pa.int64()),
        ]
        table = pa.Table.from_arrays(columns, ["turn_source", "turn", "turn_slot"])
        spark.createDataFrame(table, _SLOTS).write.mode("append").parquet(folder)
        first += len(part)
    return spark.read.schema(_SLOTS).parquet(folder)


def mix(
    documents: DataFrame,
    folder: str,
    weights: Mapping[str | None, float] | None = None,
    block_documents: int = BLOCK_DOCUMENTS,
    period: int = PERIOD,
) -> DataFrame:
    """Key, source, block and slot of every row of `doc_id, source, text`.

    The rows of a source are numbered in ranges of keys: each range counts its own, and the
    counts of the ranges before it are added, so that a source with a third of all rows is
    spread over all tasks.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = rows.repartitionByRange("doc_id", "text_hash").withColumn(
        "part", F.spark_partition_id()
    )
    placed = stored(placed, f"{folder}/placed")
    within = W.partitionBy("part", "source").orderBy("doc_id", "text_hash")
    numbered = placed.withColumn("own", F.row_number().over(within) - 1)
    counts = placed.groupBy("source", "part").count()
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        F.col("part").alias("its_part"),
        F.col("source").alias("its_source"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"),
    )
    sizes = counts.groupBy("source").agg(F.sum("count").alias("size")).collect()
    if weights is None:
        names = [row["source"] for row in sizes]
        weights = {name: 1 for name in sorted(names, key=lambda n: (n is None, n or ""))}
    shares = exact_weights(weights)
    cycle = sum(shares.values())
    same = F.col("source").eqNullSafe(F.col("its_source")) & (F.col("part") == F.col("its_part"))
    ranked = numbered.join(before, same).select(
        "doc_id", "text_hash", "source", (F.col("before") + F.col("own")).alias("rank")
    )
    blocks = ranked.withColumn("block", F.floor(F.col("rank") / block_documents))
    own_turn = F.col("source").eqNullSafe(F.col("turn_source"))
    shown = ["doc_id", "source", "text_hash", "block", "rank"]
    if cycle > period:
        held = {row["source"]: -(-row["size"] // block_documents) for row in sizes}
        if not any(held.get(source) for source in shares):
            return blocks.select(*shown, F.lit(None).cast("bigint").alias("slot"))
        if longest_window(shares) <= LONGEST_FRAME:
            turns = frame_slots(spark, shares, held)
        else:
            turns = long_schedule(spark, shares, held, f"{folder}/schedule")
        timed = blocks.join(turns, own_turn & (F.col("block") == F.col("turn")), "left")
        return timed.select(*shown, F.col("turn_slot").alias("slot"))
    seen: dict = {}
    table = []
    for slot, source in enumerate(pfair(shares)):
        turn = seen.setdefault(source, 0)
        seen[source] = turn + 1
        table.append((source, turn, slot))
    turns = spark.createDataFrame(table, _SLOTS)
    known = spark.createDataFrame(list(shares.items()), "share_source string, share bigint")
    # Both tables have a row for each slot of a period at most.
    shared = blocks.join(
        F.broadcast(known), F.col("source").eqNullSafe(F.col("share_source")), "left"
    )
    own_turn &= F.col("block") % F.col("share") == F.col("turn")
    timed = shared.join(F.broadcast(turns), own_turn, "left")
    at = F.floor(F.col("block") / F.col("share")) * cycle + F.col("turn_slot")
    return timed.select(*shown, at.alias("slot"))


def in_order(
    documents: DataFrame, folder: str, weights: Mapping[str | None, float] | None = None
) -> DataFrame:
    """All rows, all their columns, whatever these are called, sorted by their place in the
    mixture from the first partition to the last; repeated rows stand together."""
    own_id, own_hash, at = (unused(name, documents) for name in ("own_id", "own_hash", "at"))
    own = [F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)]
    placed = mix(documents, folder, weights).groupBy(*own).agg(
        F.min(F.struct(F.col("slot").isNull().alias("late"), "slot", "source", "rank")).alias(at)
    )
    placed = stored(placed, f"{folder}/mixture")
    # Numbers for the rows; they are sent to the rows if they are few enough.
    known = F.broadcast(placed) if fits_broadcast(placed) else placed
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(own_hash) == F.xxhash64("text"))
    order = [f"{at}.{name}" for name in ("late", "slot", "source", "rank")]
    timed = documents.join(known, same).repartitionByRange(*order).sortWithinPartitions(*order)
    return timed.select(*(F.col(name) for name in documents.columns))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return mix(documents, work_folder(spark)).drop("text_hash")
