"""The running sums in a checkpoint: looked at, and carried over to another number of partitions.

A checkpoint fixes the number of its state partitions when it is first started. To change it,
stop the job, carry its sums over, and start it with the settings that they were carried to:

    wider = replace(settings, state_partitions=400, totals_checkpoint=..., handover_path=...,
                    history_path=...)
    carry_over(spark, settings, wider)
    run(spark, wider)

The sums are those of the last committed batch, and the stream goes on with what that batch had
not read, in the way it goes on from a backfill (see plans.handover): sums, offsets and totals
are committed together by the first batch. A batch that was begun but not committed is read
again as a whole. The archive's query keeps its own checkpoint and is not touched.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.functions.values import EXACT
from ordertally.plans.handover import ENDS, read_ends, write_ends, write_totals
from ordertally.settings import Settings
from ordertally.streaming.jobs import checkpoint_of

# The operator that keeps the sums of an aggregation.
_SUMS = "stateStoreSave"
_ENTRY = "path string, batchId bigint"


def _committed(spark: SparkSession, checkpoint: str) -> tuple[int, int]:
    """The operator that holds the sums, and the last batch it has committed."""
    operators = spark.read.format("state-metadata").load(checkpoint)
    rows = operators.where(F.col("operatorName") == _SUMS).collect()  # a row for each operator
    if len(rows) != 1:
        raise ValueError(f"{checkpoint} has no running sums, or more than one kind")
    if rows[0]["maxBatchId"] < 0:
        raise ValueError(f"{checkpoint} has no committed batch")
    return rows[0]["operatorId"], rows[0]["maxBatchId"]


def totals_state(spark: SparkSession, settings: Settings, batch: int | None = None) -> DataFrame:
    """The running sums after a batch, the last committed one if none is named: `source, state,
    amount` and the state partition that each lies in.

    The job may be running; a batch can be named as long as Spark keeps its state. A group of
    amounts that are all missing has a NULL one.
    """
    checkpoint = checkpoint_of(settings, "totals")
    operator, last = _committed(spark, checkpoint)
    reader = spark.read.format("statestore").option("operatorId", operator)
    rows = reader.option("batchId", last if batch is None else batch).load(checkpoint)
    amount = F.col("value.sum")
    if "isEmpty" in rows.schema["value"].dataType.names:  # sums of decimals begin with 0
        amount = F.when(~F.col("value.isEmpty"), amount)
    kind = EXACT if settings.exact else "double"
    return rows.select(
        "key.source",
        "key.state",
        amount.cast(kind).alias("amount"),
        F.col("partition_id").alias("state_partition"),
    )


def read_by(spark: SparkSession, settings: Settings, batch: int) -> DataFrame:
    """What the totals' query had read after a batch: files, or Kafka partitions with the next
    offset of each. Files come from the log that the source keeps in the checkpoint."""
    checkpoint = checkpoint_of(settings, "totals")
    offsets = spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).first()[0]
    found = spark.createDataFrame([], ENDS)
    # A version, the batch's own settings, then one line for each source.
    for number, line in enumerate(offsets.splitlines()[2:]):
        offset = json.loads(line) if line.startswith("{") else None
        if offset is None:  # a source that had nothing yet
            continue
        if "logOffset" in offset:
            log = spark.read.text(f"{checkpoint}/sources/{number}")
            entry = F.from_json("value", _ENTRY).alias("entry")
            entries = log.where(F.col("value").startswith("{")).select(entry).select("entry.*")
            files = entries.where(F.col("batchId") <= offset["logOffset"])
            none = F.lit(None).cast("bigint").alias("next")
            found = found.union(files.select("path", none).distinct())
        else:
            ends = [(f"{topic}-{n}", at) for topic, own in offset.items() for n, at in own.items()]
            found = found.union(spark.createDataFrame(ends, ENDS))
    if settings.handover_path is not None:
        found = found.union(read_ends(spark, settings.handover_path))
    return found.groupBy("origin").agg(F.max("next").alias("next"))


def carry_over(spark: SparkSession, settings: Settings, to: Settings) -> None:
    """Write the sums of a stopped job, and how far it read, for a job with other settings.

    `to` has its own `totals_checkpoint` or `checkpoint_root`, `handover_path` and
    `history_path`: batches are numbered anew, so the history begins anew as well, with the sums
    carried over as batch -1. What broke off is run again as a whole; until it is complete the
    job refuses to start.
    """
    if to.handover_path is None or to.history_path is None:
        raise ValueError("carrying over needs handover_path and history_path")
    if settings.dedup or settings.corrections_path is not None:
        raise ValueError("the ids of dedup and corrections are not carried over")
    if settings.exact != to.exact:
        raise ValueError("sums are carried over as they are: give both the same `exact`")
    own = [
        (checkpoint_of(s, "totals"), s.history_path, s.handover_path) for s in (settings, to)
    ]
    if any(before is not None and before == after for before, after in zip(*own, strict=True)):
        raise ValueError("the job needs a new checkpoint, history_path and handover_path")
    _, batch = _committed(spark, own[0][0])
    write_ends(read_by(spark, settings, batch), to.handover_path)
    write_totals(totals_state(spark, settings, batch).drop("state_partition"), to)
