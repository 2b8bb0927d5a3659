"""Conversations as sorted streams of rows.

A conversation is one sequence: what is decided or hashed at a turn depends on all turns
before it. So its rows go to one task, sorted by Spark, which spills; the task reads them
once as a stream and holds the open part alone, never the conversation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

OUT_ROWS, OUT_CHARS = 1000, 2**20


def in_sequence(rows: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one partition, by `order`; null keys are one conversation."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def tuples(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in columns), strict=True)


class Rows:
    """Rows to hand on in batches of bounded size; `texts` are the columns that can be long."""

    def __init__(self, schema: pa.Schema, texts: Sequence[int] = ()):
        self.schema, self.texts = schema, texts
        self.rows: list[tuple] = []
        self.chars = 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.chars += sum(len(row[k] or "") for k in self.texts)

    def ready(self) -> bool:
        return len(self.rows) >= OUT_ROWS or self.chars >= OUT_CHARS

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.schema)
        self.rows, self.chars = [], 0
