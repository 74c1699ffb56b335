"""From raw documents to token ids: what is kept, how often, in which order, and its encoding.

Each stage takes the table that the stage before wrote, and works on all of it.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import bpe, exact, jaccard, mixing, quality
from cohortloom.llm.common import documents, durable_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and are more likely good than not."""
    return quality.good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, that with the largest doc_id."""
    return exact.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, 0.8), that with the smallest doc_id."""
    return jaccard.representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, as often as their source's weight asks for."""
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: Votes weighed by EM, hashes and encoding are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; each stage's rows are written and read again."""
    folder = f"{durable_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{folder}/{number}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
