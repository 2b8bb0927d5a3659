"""Names that occur more than once in the corpus, without a hot key.

A chunk of a task settles by itself what it holds twice: it sends one row for each name, and
a row for each further place, dealt by the place's key, not by the name. So a name that a
third of all documents hold gives one row for each chunk to the task that compares it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Names that a task compares by itself before it sends them.
CHUNK = 2**18
SENT = "route bigint, name bigint, key bigint, place int, sure boolean"
SENT_WIDE = "route bigint, name bigint, key bigint, place bigint, sure boolean"


class Chunk:
    """Names with their places, gathered from several batches."""

    def __init__(self, wide: bool = False):
        self.kind = np.int64 if wide else np.int32
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, names: np.ndarray, keys: np.ndarray, places: np.ndarray) -> bool:
        """True when it is time to close the chunk."""
        self.parts.append((names, keys, places))
        self.size += len(names)
        return self.size >= CHUNK

    def close(self) -> Iterator[pa.RecordBatch]:
        """One row for each name, and a sure one for each place of a name seen twice."""
        if not self.size:
            return
        names, keys, places = (np.concatenate(column) for column in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        _, index, inverse, counts = np.unique(
            names, return_index=True, return_inverse=True, return_counts=True
        )
        again = np.flatnonzero(counts[inverse] > 1)
        names = names.view(np.int64)
        columns = [
            np.concatenate((names[index], keys[again])),
            np.concatenate((names[index], names[again])),
            np.concatenate((keys[index], keys[again])),
            np.concatenate((places[index], places[again])).astype(self.kind),
            np.arange(len(index) + len(again)) >= len(index),
        ]
        whole = pa.RecordBatch.from_arrays(
            [pa.array(column) for column in columns], ["route", "name", "key", "place", "sure"]
        )
        for start in range(0, whole.num_rows, 2**16):
            yield whole.slice(start, 2**16)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of names that stand in two rows at least; rows are sorted, sure ones last."""
    held: tuple | None = None  # the last row, if it has not been passed on
    seen = None  # its name
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(name).to_numpy() for name in ("name", "key", "place")]
        names = columns[0]
        keep = batch.column("sure").to_numpy(zero_copy_only=False).copy()
        open_rows = ~keep
        equal = (names[1:] == names[:-1]) & open_rows[1:] & open_rows[:-1]
        keep[1:] |= equal
        keep[:-1] |= equal
        extra: list = []
        if open_rows[0] and seen == names[0]:
            keep[0] = True
            if held is not None:
                extra = [held]
        out = [
            np.concatenate((np.array([row[k] for row in extra], column.dtype), column[keep]))
            for k, column in enumerate(columns)
        ]
        seen = held = None
        if open_rows[-1]:
            seen = names[-1]
            held = None if keep[-1] else tuple(column[-1] for column in columns)
        yield pa.RecordBatch.from_arrays([pa.array(one) for one in out], ["name", "key", "place"])


def repeated(sent: DataFrame) -> DataFrame:
    """Name, key and place of what occurs more than once; a row may come twice."""
    dealt = sent.repartition("route").sortWithinPartitions("sure", "name")
    return dealt.mapInArrow(_matches, dealt.select("name", "key", "place").schema)
