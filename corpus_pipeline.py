"""Cleaning a corpus: five stages, each over everything that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of ``documents``; the last returns the mix: which documents it takes how often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.llm import credentials, decontaminate, importance, mixing, ngram_join
from sward.session import materialise, work_path

#: Sampling has no SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or score below the threshold go."""
    return importance.keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates the document with the smallest id stays."""
    return ngram_join.one_per_class(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out; a document with more than a hundredth of such words goes."""
    return measured(decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets."""
    return measured(credentials.redact_documents(docs, work_path(spark, "secret-ledger")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, and the words of that."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
