"""Orders against customers that change: each meets the version that was valid at its time.

Orders and versions are put in one sequence by customer and time, which is cut into ranges
of like size: a customer with very many orders, or versions, is spread over several. Within
a range each order takes the last version before it. What is valid where a range begins is
carried over from the ranges before: a row for each range and customer that goes on in it,
so at most two rows for each range, sent to all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.operators.customers import has_text_key, keyed
from ordertally.operators.sizes import BROADCAST_BYTES, fits_broadcast

KINDS = ("left", "inner")


def valid_at(
    orders: DataFrame,
    versions: DataFrame,
    folder: str,
    time: str = "timestamp",
    since: str = "valid_from",
    how: str = "left",
    partitions: int | None = None,
) -> DataFrame:
    """Orders with the columns of the version of their customer that was valid at `time`.

    A version is valid from `since` on, that moment included, until the customer's next
    one; of two of one moment the one whose columns are greater. An order before its
    customer's first version, without a usable key or without a time has NULLs, or drops
    out if `how` is "inner". A version without a key or a time is never valid. The cut
    sequence is stored below `folder`.
    """
    if how not in KINDS:
        raise ValueError(f"how is one of {KINDS}")
    text = has_text_key(versions)
    given, spark = orders.columns, orders.sparkSession
    shown = [name for name in versions.columns if name not in ("customer_id", since)]
    orders, versions = keyed(orders, text=text), keyed(versions, text=text)
    kinds = versions.schema
    row = F.struct(*(F.col(name).alias(f"_{k}") for k, name in enumerate(given)))
    version = F.struct(F.lit(True).alias("_there"), *(F.col(name).alias(f"_{k}") for k, name in enumerate(shown)))
    at_once = (F.col("customer_id").isNotNull(), F.col(since).isNotNull())
    told = versions.where(at_once[0] & at_once[1]).select(
        F.col("customer_id").alias("_key"),
        F.col(since).cast("timestamp").alias("_at"),
        F.lit(0).alias("_kind"),
        version.alias("_version"),
        F.lit(0).cast("bigint").alias("_spread"),
    )
    asked = orders.select(
        F.col("customer_id").alias("_key"),
        F.col(time).cast("timestamp").alias("_at"),
        F.lit(1).alias("_kind"),
        row.alias("_row"),
        # Orders of one customer and moment, or without either, can be cut as well.
        F.xxhash64(*(F.col(name) for name in given)).alias("_spread"),
    )
    both = told.unionByName(asked, allowMissingColumns=True)
    order = ("_key", "_at", "_kind", "_spread")
    ranges = both.repartitionByRange(*([partitions] if partitions else []), *order)
    path = f"{folder}/sequence"
    ranges.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.schema(ranges.withColumn("_part", F.lit(0)).schema).parquet(path)

    within = W.partitionBy("_part", "_key").orderBy("_at", "_kind", "_version")
    so_far = within.rowsBetween(W.unboundedPreceding, W.currentRow)
    met = placed.withColumn("_own", F.last("_version", ignorenulls=True).over(so_far))
    met = met.where("_kind = 1").select("_part", "_key", "_at", "_row", "_own")

    # Customers that go on from one range to the next, and the last version in each.
    spans = placed.where("_key IS NOT NULL").groupBy("_key").agg(
        F.min("_part").alias("_first"), F.max("_part").alias("_last")
    )
    spans = spans.where("_first < _last").select("_key")
    version_at = F.when(F.col("_kind") == 0, F.struct("_at", "_version"))
    ends = placed.join(F.broadcast(spans), "_key", "left_semi").groupBy("_key", "_part").agg(
        F.max_by("_version", version_at).alias("_end")
    )
    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_key").alias("_its_key"),
        F.col("_part").alias("_its_part"),
        F.last("_end", ignorenulls=True).over(earlier).alias("_carried"),
    )
    here = (F.col("_key") == F.col("_its_key")) & (F.col("_part") == F.col("_its_part"))
    found = met.join(F.broadcast(carried), here, "left")
    valid = F.when(F.col("_at").isNotNull(), F.coalesce("_own", "_carried"))
    found = found.withColumn("_valid", valid)
    if how == "inner":
        found = found.where("_valid IS NOT NULL")
    columns = [F.col(f"_row._{k}").alias(name) for k, name in enumerate(given)]
    columns += [F.col(f"_valid._{k}").cast(kinds[name].dataType).alias(name) for k, name in enumerate(shown)]
    return found.select(*columns)


def restated(
    facts: DataFrame,
    versions: DataFrame,
    late: DataFrame,
    folder: str,
    time: str = "timestamp",
    since: str = "valid_from",
) -> DataFrame:
    """What versions that became known late change in the totals by source and state.

    `facts` are orders with their `amount`. Only those of customers with late versions are
    looked at: each is taken out of the group that it was counted in and added to the one
    that it belongs to now. Columns `source, state, amount, orders`, changes alone.
    """
    changed = keyed(late, text=has_text_key(late)).select("customer_id").distinct()
    facts = keyed(facts, text=has_text_key(late))
    small = fits_broadcast(changed, BROADCAST_BYTES)
    known = F.broadcast(changed) if small else changed.hint("merge")
    touched = facts.join(known, "customer_id", "left_semi")
    parts = []
    for name, table, sign in (("before", versions, -1), ("after", versions.unionByName(late), 1)):
        met = valid_at(touched, table, f"{folder}/{name}", time, since, how="inner")
        parts.append(met.select("source", "state", (F.col("amount") * sign).alias("amount"), F.lit(sign).alias("orders")))
    sums = parts[0].unionByName(parts[1]).groupBy("source", "state").agg(
        F.sum("amount").alias("amount"), F.sum("orders").alias("orders")
    )
    return sums.where((F.coalesce("amount", F.lit(0)) != 0) | (F.col("orders") != 0))
