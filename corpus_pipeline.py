"""A corpus pipeline: drop poor texts, drop toxic texts, keep one text of each
group of near duplicates, and pack what is left into sequences.

Every stage takes the documents its predecessor kept, and is written as Parquet
before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm.jaccard_join import one_of_each
from tallywatch.llm.packing import pieces, place
from tallywatch.llm.quality import good_texts
from tallywatch.llm.tables import read, stored
from tallywatch.llm.toxicity import civil_texts

END_ID = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return good_texts(docs, read(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't take for toxic ones."""
    return civil_texts(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    cut = pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return place(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]
# No SQL for fitted classifiers and packing; the tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
