"""The current version of every order, kept as a table.

Rows lie in buckets by hash of the order. A batch reads and writes the buckets of its own
orders alone and lists where each bucket lies now. The list is written last and as a whole, so
a reader sees the table before a batch or after it, whatever fails in between; a batch that
comes again is left alone. Folders that the lists no longer name can be deleted once no
reader is at work on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertally.operators.current import archive_current
from ordertally.schemas import ARCHIVE
from ordertally.sources.folders import numbered

BUCKETS = 256
_LIST = "bucket int, commit bigint"
ROWS = T.StructType([f for f in ARCHIVE.fields if f.name not in ("kind", "reason")])


def bucket_of(buckets: int) -> Column:
    """The bucket of an order; a table keeps the number of its first batch."""
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets).cast("bigint")).cast("int")


def _places(spark: SparkSession, path: str, commits: list[int]) -> dict[int, int]:
    """The batch that wrote each bucket last: a row for each bucket there is."""
    if not commits:
        return {}
    rows = spark.read.schema(_LIST).parquet(f"{path}/lists/commit={commits[-1]}").collect()
    return {row["bucket"]: row["commit"] for row in rows}


def _rows(spark: SparkSession, path: str, places: dict[int, int]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], ROWS)
    folders = [f"{path}/rows/commit={commit}/bucket={bucket}" for bucket, commit in sorted(places.items())]
    return spark.read.schema(ROWS).parquet(*folders)


def update_current(changes: DataFrame, path: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Take a batch of accepted orders into the table; of an order the last version stays.

    A batch that the table has, or one that is older, changes nothing.
    """
    spark = changes.sparkSession
    commits = numbered(spark, f"{path}/lists", "commit")
    if commits and batch_id <= commits[-1]:
        return
    kinds = {f.name: f.dataType for f in ROWS.fields}
    own = changes.withColumn("batch_id", F.lit(batch_id))
    own = own.select(*(F.col(name).cast(kind).alias(name) for name, kind in kinds.items()))
    own = own.where("order_id IS NOT NULL").withColumn("bucket", bucket_of(buckets))
    touched = [row["bucket"] for row in own.select("bucket").distinct().collect()]
    places = _places(spark, path, commits)
    before = {bucket: places[bucket] for bucket in touched if bucket in places}
    both = _rows(spark, path, before).withColumn("bucket", bucket_of(buckets)).unionByName(own)
    rows = archive_current(both)
    if touched:
        # The bucket follows from the order, so what is dealt by order is dealt by bucket again.
        dealt = rows.repartition(len(touched), "bucket")
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("bucket").parquet(f"{path}/rows/commit={batch_id}")
    places |= dict.fromkeys(touched, batch_id)
    listed = spark.createDataFrame(sorted(places.items()), _LIST).coalesce(1)
    listed.write.mode("overwrite").parquet(f"{path}/lists/commit={batch_id}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last complete batch."""
    return _rows(spark, path, _places(spark, path, numbered(spark, f"{path}/lists", "commit")))
