"""From raw documents to encoded training texts, in stages that are written one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import bpe, decontamination, near_dedup, quality, secrets
from starloom.llm.queries import coded_digests, tokenizer_file
from starloom.sources.staging import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.one_of_each(docs)


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def free_of_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets blanked."""
    return secrets.without_secrets(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of each document."""
    return coded_digests(bpe.encode_texts(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", good_quality),
    ("near_dedup", first_of_near_duplicates),
    ("decontamination", free_of_benchmark),
    ("secret_scan", free_of_secrets),
    ("bpe", encoded),
]

#: No stage but the choice of documents can be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each result is written as Parquet and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs)
    return docs
