"""Content addresses: one digest per distinct text, and one row that stands for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(column, UPPER, LOWER)


def addressed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text, digest)``: whole texts with their SHA-256; a null text counts as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).alias("key"), whole.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """``(digest, owner)``: every digest once with the smallest key that has it.

    Only 40 bytes a row are shuffled, and map tasks combine them first, so thousands of copies cost one row a task.
    """
    return rows.groupBy("digest").agg(F.min("key").alias("owner"))


def owned_texts(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """``(digest, text)`` of the rows that stand for the given digests.

    The join key holds the owner's key too, so that copies spread over the cluster instead of meeting in one task.
    Several rows may share key and text; callers combine what they derive by digest.
    """
    keep = owners.select(F.col("digest").alias("_d"), F.col("owner").alias("_k"))
    return rows.join(keep, (F.col("digest") == F.col("_d")) & F.col("key").eqNullSafe(F.col("_k")), "left_semi").select("digest", "text")
