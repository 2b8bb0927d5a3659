"""Exact deduplication with a streaming, disk-backed keyed state that never expires.

Arrivals are a log of (digest, identifier, size), without texts. A stream reads the log as it
grows and keeps for each digest the smallest identifier, the number of rows and the content
locator of the text that stands for the digest; the state lives in RocksDB on the executors'
disks and in the checkpoint folder, and holds for as long as the checkpoint does, so that a
row that arrives later still meets the earlier ones. Rows of a batch are summed before they
are shuffled, so that a digest which a third of all rows share is no hot key.

Digests that occur more than once are hits. For these the texts themselves are compared
with the one that the locator names, byte for byte; rows that differ from it are grouped by
their whole text instead.

Texts are equal when they are the same after each run of ASCII white space has become one
blank; a null text is empty. The row with the smallest identifier stays; a null identifier
comes last, and of rows that repeat an identifier and a text, the group has one `keep_id`
and all rows with it are kept. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertally.llm.common import (
    one_of_each,
    read_table,
    stored,
    texts_of,
    unused,
    without,
    work_folder,
)
from ordertally.operators.sizes import fits_broadcast

# Each state partition is a small store of its own, so none sets disk space or much memory
# aside.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # One limit for all stores of an executor; stores that have been closed go soon.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
_LOG = "digest binary, size bigint, doc_id bigint"
_STATE = "digest binary, size bigint, keep_id bigint, group_size bigint"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")


def with_digest(documents: DataFrame) -> DataFrame:
    """Key, normalised text, and its SHA-256 in binary."""
    rows = texts_of(documents).select("doc_id", normalised(F.col("text")).alias("text"))
    return rows.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))


def deliver(documents: DataFrame, folder: str) -> None:
    """Append rows to the log that the stream reads."""
    arrivals = with_digest(documents).select(
        "digest", F.octet_length("text").cast("bigint").alias("size"), "doc_id"
    )
    arrivals.write.mode("append").parquet(f"{folder}/log")


def update_state(spark: SparkSession, folder: str) -> None:
    """Take what has been delivered since the last call into the state, then stop.

    What a batch changes is appended to a log of versions; of a digest the one with the
    most rows is the last, since a group only grows.
    """
    log = spark.readStream.schema(_LOG).parquet(f"{folder}/log")
    groups = log.groupBy("digest").agg(
        F.max("size").alias("size"),
        F.min("doc_id").alias("keep_id"),
        F.count("*").alias("group_size"),
    )

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/versions/batch={batch_id}")

    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        query = (
            groups.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(append)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def state(spark: SparkSession, folder: str) -> DataFrame:
    """Digest, size, smallest identifier and number of rows, as of the last batch."""
    versions = spark.read.schema(_STATE).parquet(f"{folder}/versions/batch=*")
    last = F.max(F.struct("group_size", "keep_id", "size")).alias("last")
    return versions.groupBy("digest").agg(last).select("digest", "last.*")


def _same(one: str, other: str) -> Column:
    return F.col(one).eqNullSafe(F.col(other))


# Tasks that the rows of one digest are dealt over where the contents cannot be sent.
WAYS = 32


def _beside(members: DataFrame, content: DataFrame) -> DataFrame:
    """Each row with the content of its digest. The contents are sent to the rows if they are
    few enough; else the rows of a digest are dealt over several tasks, by key and text, each
    of which gets the content."""
    if fits_broadcast(content):
        return members.join(F.broadcast(content), "digest")
    salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(WAYS).cast("bigint"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(WAYS - 1).cast("bigint")))
    dealt, copies = members.withColumn("way", salt), content.withColumn("way", every)
    return dealt.join(copies.hint("merge"), ["digest", "way"]).drop("way")


def decide(documents: DataFrame, folder: str) -> DataFrame:
    """For each row the one that stays, after a comparison of the texts of all hits."""
    spark = documents.sparkSession
    groups = stored(state(spark, folder), f"{folder}/groups")
    log = spark.read.schema(_LOG).parquet(f"{folder}/log").select("digest", "doc_id")
    hits = groups.where("group_size > 1").select("digest", "keep_id", "group_size")
    # Texts of hits alone are moved: the others stay where the hits can be sent to them.
    known = F.broadcast(hits) if fits_broadcast(hits) else hits
    members = with_digest(documents).join(known, "digest")
    # The locator leads to one text for each digest.
    standing = members.where(_same("doc_id", "keep_id")).groupBy("digest")
    content = stored(standing.agg(F.min("text").alias("content")), f"{folder}/content")
    compared = _beside(members, content).withColumn("equal", _same("text", "content"))
    checked = stored(
        compared.select(
            "doc_id",
            "digest",
            "keep_id",
            "group_size",
            "equal",
            F.when(~F.col("equal"), F.col("text")).alias("text"),
        ),
        f"{folder}/checked",
    )
    odd = checked.where("not equal")
    regrouped = odd.groupBy("digest", "text").agg(
        F.min("doc_id").alias("own_id"), F.count("*").alias("own_size")
    )
    shape = ["doc_id", "digest", "keep_id", "group_size"]
    single = log.join(known.select("digest"), "digest", "left_anti").select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint")
    )
    # Rows that only shared the digest are not in the group they were counted in.
    strays = stored(odd.groupBy("digest").agg(F.count("*").alias("strays")), f"{folder}/strays")
    few = F.broadcast(strays) if fits_broadcast(strays) else strays
    equal = checked.where("equal").join(few, "digest", "left").select(
        "doc_id",
        "digest",
        "keep_id",
        (F.col("group_size") - F.coalesce("strays", F.lit(0))).alias("group_size"),
    )
    differing = odd.select("doc_id", "digest", "text").join(regrouped, ["digest", "text"]).select(
        "doc_id", "digest", F.col("own_id").alias("keep_id"), F.col("own_size").alias("group_size")
    )
    found = single.toDF(*shape).union(equal).union(differing)
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        _same("doc_id", "keep_id").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup_documents(documents: DataFrame, folder: str) -> DataFrame:
    deliver(documents, folder)
    update_state(documents.sparkSession, folder)
    return decide(documents, folder)


def keep_first(documents: DataFrame, folder: str) -> DataFrame:
    """The rows that stay, with all their columns, whatever these are called, one for each
    text; of repeated rows one, as of rows without a key. A null text is empty, and an empty
    text is a text like any other. An empty table gives no rows."""
    decided = stored(dedup_documents(documents, folder), f"{folder}/decided")
    text = normalised(F.coalesce(F.col("text").cast("string"), F.lit("")))
    digest = unused("text_sha256", documents)
    rows = documents.withColumn(digest, F.sha2(text, 256))
    on = ["doc_id", digest]
    decided = decided.withColumnRenamed("text_sha256", digest)
    kept = without(rows, decided.where("not kept").select(*on).distinct(), on)
    twice = decided.where("kept").groupBy(*on).agg(F.count("*").alias("times"))
    return one_of_each(kept, twice.where("times > 1").select(*on), on).select(*documents.columns)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return dedup_documents(documents, f"{work_folder(spark)}/dedup")


OP3_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
