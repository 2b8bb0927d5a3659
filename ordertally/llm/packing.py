"""Best-fit decreasing: pieces of documents packed into sequences of fixed capacity.

Pieces of one length are interchangeable, so what best-fit decreasing does depends on the
number of pieces of each length alone: at most `capacity` numbers, however large the corpus.
The driver runs it on these, a whole run of equal pieces at a time; open bins are counted
by remaining capacity in a segment tree, which gives the tightest bin that takes a piece in
logarithmic time. The outcome is a table of runs, whose size depends on the capacity and
not on the corpus; each piece finds its bin in it by its rank among those of its length.

A null text is empty; every document has its end id, so none is empty and none is lost.
Repeated rows are packed each on its own. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.llm.common import BATCH_ROWS, read_table, slices, stored, texts_of, work_folder
from ordertally.llm.tokens import BRIEF_WORDS, END_ID, SLICE_BYTES, Encoder, encoder, public_path

CAPACITY = 1024
# Rows that go to Python at once where the memo lasts: few batches, few distinct words.
LASTING_ROWS = 10_000
# Text that is encoded at a time where it does not.
BRIEF_BYTES = 2**21
_PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "task string, place bigint"
)
_RUNS = (
    "run_length bigint, first_rank bigint, end_rank bigint, first_bin bigint, "
    "each bigint, base bigint"
)


class OpenBins:
    """Which remaining capacities have open bins: a segment tree over 0 to capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _add(self, room: int, count: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += count
            node //= 2

    def put(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.runs[room].append((first, count))
            self._add(room, count)

    def take(self, room: int) -> tuple[int, int]:
        """A run of bins with just so much room: the first, and how many."""
        first, count = self.runs[room].pop()
        self._add(room, -count)
        return first, count

    def tightest(self, length: int) -> int | None:
        """The least room that is length at least and that an open bin has."""
        node = length + self.leaves
        if self.counts[node]:
            return length
        while node > 1:  # up to the first right sibling that counts something, then down
            if node % 2 == 0 and self.counts[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.counts[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass(frozen=True)
class Run:
    """Pieces of a length, by rank, that fill consecutive bins with `each` pieces."""

    length: int
    first_rank: int
    end_rank: int
    first_bin: int
    each: int
    base: int  # offset of the first piece in each bin


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Run]:
    bins = OpenBins(capacity)
    opened = 0
    runs: list[Run] = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, count = opened, -(-left // (capacity // length))
                opened += count
            else:
                first, count = bins.take(room)
            # A bin stays the tightest until it takes no further piece of this length.
            each = room // length
            full = min(count, left // each)
            over = left - full * each if full < count else 0
            base = capacity - room
            if full:
                runs.append(Run(length, rank, rank + full * each, first, each, base))
                bins.put(room - each * length, first, full)
            rank += full * each
            if over:
                runs.append(Run(length, rank, rank + over, first + full, over, base))
                bins.put(room - over * length, first + full, 1)
                rank += over
            bins.put(room, first + full + bool(over), count - full - bool(over))
            left = counts[length] - rank
    return runs


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; the first takes what the others leave."""
    if size <= capacity:
        return [(0, size)]
    head = size % capacity or capacity
    starts = [0, *range(head, size, capacity)]
    return [(start, capacity if k else head) for k, start in enumerate(starts)]


def pieces(
    documents: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    as_stored: bool = False,
    lasting: bool = True,
) -> DataFrame:
    """Pieces of every document, numbered within their task and length.

    The memo of words lasts as long as the Python worker, or as the task if not `lasting`,
    which leaves the memory to the stages that follow.

    With `as_stored`, of documents read from files, a task names itself by the file and the
    row where it begins; then pieces of one length are packed in the order of the files.
    Further columns, whatever they are called, are left alone.
    """
    rows = texts_of(documents)
    if as_stored:
        place = documents.metadataColumn("_metadata")
        rows = texts_of(documents, more=[place[name].alias(name) for name in ("file_name", "row_index")])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary) if lasting else Encoder(vocabulary, BRIEF_WORDS)
        task, file = f"{TaskContext.get().partitionId():09d}", None
        end = np.array([end_id], dtype="<u4").tobytes()
        seen = [0] * (capacity + 1)
        for batch in slices(batches, limit=SLICE_BYTES if lasting else BRIEF_BYTES):
            rows: list[tuple] = []
            keys = batch.column("doc_id").to_pylist()
            places = [(None, 0)] * batch.num_rows
            if as_stored:
                columns = (batch.column(name).to_pylist() for name in ("file_name", "row_index"))
                places = list(zip(*columns, strict=True))
            found = tokens.encode(batch.column("text"))
            for key, ids, (name, row) in zip(keys, found, places, strict=True):
                if name != file:
                    task, file, seen = f"{name} {row:015d}", name, [0] * (capacity + 1)
                data = memoryview(ids + end)
                for number, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((key, number, start, length, crc, task, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, {1: pa.int32(), 5: pa.string()}.get(k, pa.int64()))
                    for k, column in enumerate(zip(*rows, strict=True))
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"],
            )

    return rows.mapInArrow(encode, _PIECES)


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of each piece. The pieces must be a stored table: their numbers
    within a task hold for one reading of the documents."""
    spark = cut_pieces.sparkSession
    counts = cut_pieces.groupBy("task", "length").count()
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        F.col("task").alias("its_task"),
        F.col("length").alias("its_length"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"),
    )
    # At most `capacity` rows.
    by_length = cut_pieces.groupBy("length").count().collect()
    runs = best_fit_decreasing({row["length"]: row["count"] for row in by_length}, capacity)
    table = spark.createDataFrame(
        [(r.length, r.first_rank, r.end_rank, r.first_bin, r.each, r.base) for r in runs], _RUNS
    )
    same = (F.col("task") == F.col("its_task")) & (F.col("length") == F.col("its_length"))
    ranked = cut_pieces.join(before, same).withColumn("rank", F.col("before") + F.col("place"))
    own = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("first_rank"))
    own &= F.col("rank") < F.col("end_rank")
    # The runs depend on the capacity alone, so they can be sent to every executor.
    placed = ranked.join(F.broadcast(table), own)
    step = F.col("rank") - F.col("first_rank")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_bin") + F.floor(step / F.col("each"))).alias("sequence_id"),
        (F.col("base") + step % F.col("each") * F.col("length")).alias("offset"),
    )


def pack_documents(
    documents: DataFrame,
    folder: str,
    vocabulary: str,
    capacity: int = CAPACITY,
    as_stored: bool = False,
    lasting: bool = True,
) -> DataFrame:
    found = pieces(documents, vocabulary, capacity, as_stored=as_stored, lasting=lasting)
    rows = LASTING_ROWS if lasting else BATCH_ROWS
    return pack(stored(found, f"{folder}/pieces", rows), capacity)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return pack_documents(documents, work_folder(spark), public_path("byte_bpe_50k.json"))
