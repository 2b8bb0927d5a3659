"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.operators.sizes import fits_broadcast
from ordertally.plans.workspace import new_workspace

# Text that a Python worker handles at a time; a longer text is a slice of its own.
SLICE_BYTES = 2**20
BATCH_ROWS = 500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(
    documents: DataFrame, key: str = "doc_id", text: str = "text", more: Sequence[str] = ()
) -> DataFrame:
    """Key and text alone, whatever else the table holds; a null text is empty."""
    return documents.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        *more,
    )


def unused(name: str, *tables: DataFrame) -> str:
    """The name, or one like it that no column of the tables has."""
    taken = {column.lower() for table in tables for column in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _named(rows: DataFrame, named: DataFrame, on: list[str], how: str) -> DataFrame:
    few = fits_broadcast(named)
    others = {name: unused(f"other_{name}", rows) for name in on}
    other = named.select(*(F.col(name).alias(others[name]) for name in on))
    same = [F.col(name).eqNullSafe(F.col(others[name])) for name in on]
    return rows.join(F.broadcast(other) if few else other, same, how)


def without(rows: DataFrame, dropped: DataFrame, on: list[str]) -> DataFrame:
    """The rows that are not dropped; they stay where they are if the others can be sent.
    A null key is a key like any other."""
    return _named(rows, dropped, on, "left_anti")


def one_of_each(rows: DataFrame, twice: DataFrame, on: list[str]) -> DataFrame:
    """The rows, but one alone for each of the keys of `twice`; a null key is one, too."""
    if twice.isEmpty():
        return rows
    once = _named(rows, twice, on, "left_semi").dropDuplicates(on)
    return without(rows, twice, on).unionByName(once)


def stored(table: DataFrame, path: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """The table written below the shared folder, and read from there: lineage ends here.

    While it is written, rows go to Python in batches of `batch_rows`, so that a batch of
    texts stays small.
    """
    conf, name = table.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(min(int(before), batch_rows)) if int(before) > 0 else str(batch_rows))
    try:
        table.write.parquet(path)
    finally:
        conf.set(name, before)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Ask the executors to give unused heap back to the system.

    A JVM keeps the heap that it once needed, beside what Python workers take. Between
    two jobs of different kind that is the larger part of an executor's memory.
    """
    tasks = 2 * spark.sparkContext.defaultParallelism
    asked = spark.range(0, tasks, 1, tasks).select(F.expr("reflect('java.lang.System', 'gc')"))
    asked.write.format("noop").mode("overwrite").save()


def marked_copies(documents: DataFrame, folder: str) -> DataFrame:
    """Key and text; `whole` if another row has the same text, `first` if none of these has
    a smaller key. Texts stay where they are unless the groups are too many to be sent."""
    rows = texts_of(documents).withColumn("digest", F.sha1("text"))
    groups = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies")
    )
    copied = groups.where("copies > 1").select("digest", "first_id")
    copied = stored(copied, f"{folder}/copied")
    known = F.broadcast(copied) if fits_broadcast(copied) else copied
    return rows.join(known, "digest", "left").select(
        "doc_id",
        "text",
        F.col("first_id").isNotNull().alias("whole"),
        F.col("doc_id").eqNullSafe(F.col("first_id")).alias("first"),
    )


def work_folder(spark: SparkSession) -> str:
    return new_workspace(spark)


def give_back() -> None:
    """Unused memory of a worker to the system: an idle one keeps no more than it must."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no piece holds much more text than the limit."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(
            zero_copy_only=False
        )
        step = np.cumsum(lengths.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(step)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(start), int(end) - int(start))
    give_back()


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """A shared folder as Python tasks reach it."""
    return fs.FileSystem.from_uri(uri)
