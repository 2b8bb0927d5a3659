"""Current state out of the append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# From the last write to the first; the last two tell messages of one moment apart.
LAST_FIRST = ("batch_id", "timestamp", "position", "origin")


def archive_current(archive: DataFrame) -> DataFrame:
    """The last written version of each order.

    As the first of a ranking: each task keeps one version of an order before the
    shuffle, however many there are, and sorts plain rows (an aggregate of whole
    rows sorts and copies structs).
    """
    ranked = Window.partitionBy("order_id").orderBy(*(F.desc(name) for name in LAST_FIRST))
    rank = F.row_number().over(ranked)
    return archive.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def kpi_current(history: DataFrame, by_time: bool = False) -> DataFrame:
    """The latest running total of each group. Totals must never be added up over batches.

    `by_time` is for histories of jobs that started again from batch 0.
    """
    last = F.struct("processed_at", "batch_id") if by_time else F.col("batch_id")
    latest = F.max_by("total_sum_amount", last).alias("total_sum_amount")
    return history.groupBy("source", "state").agg(latest)


def corrected_current(history: DataFrame) -> DataFrame:
    """The same for totals that orders can be taken out of: groups that have orders left."""
    latest = F.max_by(F.struct("total_sum_amount", "orders"), "batch_id").alias("last")
    groups = history.groupBy("source", "state").agg(latest)
    return groups.where("last.orders > 0").select("source", "state", "last.total_sum_amount")
