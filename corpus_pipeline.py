"""Cleaning and mixing of a corpus, stage by stage, with the training-text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import decontaminate, mixing, secrets, simhash, toxicity
from tidecast.llm.common import table
from tidecast.session import fresh_path

TOXIC = 0.3  # score from which a document goes


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC; the labels are those of the corpus."""
    scored = toxicity.toxic_texts(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("toxicity.score") < TOXIC).select(*[F.col(f"item.`{c}`") for c in docs.columns])


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.deduplicate(docs)


def no_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secrets.redact(docs, fresh_path(spark, "ledger"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, with the number of the copy."""
    number = "copy"
    while number in docs.columns:
        number += "_no"
    return mixing.emit(mixing.mix(docs)).select(*[F.col(f"item.`{c}`") for c in docs.columns], F.col("copy").alias(number))


STAGES = [
    ("toxicity", not_toxic),
    ("simhash", no_copies),
    ("decontamination", no_benchmarks),
    ("secrets", no_secrets),
    ("mixing", mixed),
]
ORACLE_SQL = None  # scores and near-duplicate groups have no SQL form; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that the one before kept, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
