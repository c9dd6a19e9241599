"""The corpus pipeline: documents to packed sequences, each stage written as Parquet before the next reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from speedloom.llm import classifier, decontam, neardup, packing, pii
from speedloom.llm.common import shared_folder, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scores = classifier.quality_classifier(docs, table(spark, sf_dir, "labels"))
    return docs.join(scores.where("predicted = 0").select("doc_id").distinct().hint("merge"), "doc_id", "left_anti").select(docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8): the smallest doc_id."""
    groups = neardup.near_duplicates(docs, n=5)
    return docs.join(groups.where("not kept").select("doc_id").distinct().hint("merge"), "doc_id", "left_anti").select(docs.columns)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    marks = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(marks.where("contaminated").select("doc_id").distinct().hint("merge"), "doc_id", "left_anti").select(docs.columns)


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data and what reveals it replaced."""
    return pii.redact(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", good_documents),
    ("MinHash near-dedup", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("PII", private_documents),
    ("packing", packed_documents),
]

#: Compression, MinHash and tokenizers have no SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        result.write.parquet(f"{folder}/{number}")
        docs = spark.read.schema(result.schema).parquet(f"{folder}/{number}")
    return docs
