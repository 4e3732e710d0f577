"""A corpus pipeline: quality rules, exact and near de-duplication, removal of personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet in the shared checkpoint
folder and read again as the next stage's ``docs``. All but the last return the columns of ``documents``, whatever else a
table has; an empty table gives an empty one at every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import pii, rules
from waymark.llm.cluster import documents, frozen, prepare
from waymark.llm.exact import deduplicated
from waymark.llm.minhash import near_duplicates
from waymark.llm.packing import packed
from waymark.llm.queries import labels
from waymark.llm.skew import without


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that fail the base rules or leave the fertility band of their language (of their script, where
    the table has no languages). Null and empty texts fail the base rules; repeated rows are judged alike."""
    prepare(spark)
    return rules.passing(docs, labels(spark, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each text, the one with the largest id (a null id is the smallest); null texts count as empty."""
    prepare(spark)
    return deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group linked at a similarity of 0.8 on five-word shingles.

    Rows without words or without an id stay; rows that share an id stay or go together.
    """
    prepare(spark)
    dropped = frozen(near_duplicates(docs, k=5, percent=80).filter("not kept").select("doc_id").distinct())
    return without(docs, dropped, dropped.count())


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the text by its kind; n_chars is the new length. Null texts stay null, with a null length."""
    prepare(spark)
    names = docs.columns
    found = frozen(pii.candidates(docs, pii.trained(docs)))
    return pii.replaced(found, pii.least_margins(found)).withColumn("n_chars", F.length("text").cast("long")).select(*names)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 4096 tokens: one row per piece. A null text is its end token alone."""
    prepare(spark)
    return packed(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("pii", private), ("packing", packing)]

#: Token ids, trained tagger and signatures have no SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``. What a stage wrote is removed once the next one is written."""
    prepare(spark)
    sc = spark.sparkContext
    docs, folder = documents(spark, sf_dir), f"{sc.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            last = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/{i - 1}")
            last.getFileSystem(sc._jsc.hadoopConfiguration()).delete(last, True)
    return docs
