"""Token counts through a cache of content digests: only texts that no run has counted before are encoded."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.llm.content import addressed, distinct_digests, owned_texts
from sward.session import materialise

CACHE = "digest binary, tokenizer string, n_tokens long"


@functools.lru_cache(maxsize=2)
def piece_model(path: str):
    """The sentencepiece model at ``path``, loaded once in a Python worker."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def model_version(path: str) -> str:
    """Names a tokenizer by its content, so that a changed file never meets counts of the old one."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """``(digest, n_tokens)`` stored for one tokenizer; an absent folder is an empty cache."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    stored = spark.read.schema(CACHE).parquet(folder).where(F.col("tokenizer") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            counts = [len(model.encode(text, num_threads=1)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return count


def count_tokens(docs: DataFrame, model_path: str, cache: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    Counts are those of the sentencepiece model without begin or end tokens, over the whole text. A null text counts as
    empty (0 bytes, 0 tokens). Repeated rows and null keys are kept. Other columns are not read. No rows give no rows.

    The content is normalised no further than null to empty, since any other change could change the count. Misses are
    appended to ``cache`` (a Parquet folder that all executors reach) under the model's digest before the result is
    read from it, so a run that dies leaves either none or all of its counts; duplicates of concurrent runs agree. Counts
    are written once more without duplicates, so that AQE can split the last join at a digest with many rows.
    """
    spark = docs.sparkSession
    version = model_version(model_path)
    rows = addressed(docs, key, text)
    misses = distinct_digests(rows).join(read_cache(spark, cache, version).select("digest"), "digest", "left_anti")
    fresh = owned_texts(rows, misses).mapInArrow(_counter(model_path), "digest binary, n_tokens long")
    fresh.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = materialise(read_cache(spark, cache, version), "token-counts-read")
    narrow = rows.select(F.col("key").alias(key), "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return narrow.join(counts, "digest").select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
