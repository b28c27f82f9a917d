"""Corpus pipeline: drop toxic documents, near duplicates and benchmark leaks, then encode.

Every stage takes any table with the columns of documents, empty ones too, and
keeps rows with null ids or texts unless it says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacancylake.llm import bpe, decontaminate, ngram_join, toxicity
from vacancylake.llm.shared import prepare
from vacancylake.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not judged toxic; null and empty texts hold no evidence and stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; texts without a word are no copies and stay."""
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; null and empty texts hold none."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, intact) of each document; null texts are empty."""
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: Fitted weights and merge rounds are no SQL; tests/llm/test_pipeline.py compares with a plain run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the documents, each written as Parquet and read again."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
