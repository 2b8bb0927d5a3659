"""Shrink a micro-batch before its shuffle.

A streaming plan cannot aggregate twice, so where a batch job would pre-aggregate,
a stream folds the rows of each Arrow batch in place. What is left of a key that
holds most rows is one row per Arrow batch. Batch jobs use `groupBy` instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema


def partial_sums(df: DataFrame, key: str, *values: str) -> DataFrame:
    """Rows (key, sums of some of its values); NULL if all of those are NULL."""
    slim = df.select(key, *values)
    kinds = to_arrow_schema(slim.schema)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One thread, so that a replay adds up in the same order.
            groups = pa.Table.from_batches([batch]).group_by(key, use_threads=False)
            sums = groups.aggregate([(value, "sum") for value in values])
            sums = sums.select([key, *(f"{value}_sum" for value in values)])
            yield from sums.rename_columns([key, *values]).cast(kinds).to_batches()

    return slim.mapInArrow(fold, slim.schema)


def drop_near_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key within each Arrow batch; later batches may repeat it."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            row = pa.array(np.arange(len(table)))
            numbered = table.select(keys).append_column("_row", row)
            first = numbered.group_by(keys, use_threads=False).aggregate([("_row", "min")])
            yield from table.take(first["_row_min"]).to_batches()

    return df.mapInArrow(fold, df.schema)
