"""A corpus made ready for training, stage by stage.

Quality decides which documents are left, exact and near copies go but for one of each
group, the sources are mixed to equal weights, which is the order of the rows from then on,
and the documents are packed into sequences; of pieces of equal length the earlier in the
mixture come into the earlier bins. Each stage works on all rows that the one before it
left, and all but the last return the columns of documents, and further ones that the rows
have, whatever these are called.

A null text is empty: it is scored, it is a text like any other to exact copies, has no near
copies, and is packed as its end id alone. Texts of any length are taken whole. Of rows that
tie or repeat, the one with the least key stays, null keys last; a row is judged by its key
and its text. A null source is a source of its own. An empty table gives no rows.

Each stage begins by asking the executors for the heap that the one before it left unused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordertally.llm import exact_dedup, mixing, packing, quality, similarity
from ordertally.llm.common import collect_garbage, read_table, stored, work_folder
from ordertally.llm.tokens import public_path

VOCABULARY = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_garbage(spark)
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_garbage(spark)
    return exact_dedup.keep_first(docs, f"{work_folder(spark)}/dedup")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_garbage(spark)
    return similarity.keep_one(docs, f"{work_folder(spark)}/similarity")


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_garbage(spark)
    return mixing.in_order(docs, work_folder(spark))


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    collect_garbage(spark)
    return packing.pack_documents(
        docs, work_folder(spark), public_path(VOCABULARY), as_stored=True, lasting=False
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("source_mixture", source_mixture),
    ("best_fit_packing", best_fit),
]

# SQL cannot express the classifier and the packing; the tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
