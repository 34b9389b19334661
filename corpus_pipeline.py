"""A corpus pipeline: each stage takes the documents that the one before it kept, as a table that was written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walloom.llm import language_id, ngram_join, packing, pii, quality
from walloom.llm.common import checkpoint_folder, table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; what has no letters, or no language that was learned from the labelled ones, goes."""
    return language_id.keep_identified(docs, language_id.train(docs))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers judge good."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of their five-word shingles."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars that of the new text."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents' token sequences, packed."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_languages),
    ("quality", keep_quality),
    ("ngram_join", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Learned models and tokenizers can't be said in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
