"""Scans with explicit schemas, image listings and stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import FOLD, KEY, TARGETS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, NUMBER = T.StringType(), T.DoubleType()
SAMPLES = _struct(image_path=TEXT, State=TEXT, Species=TEXT, Pre_GSHH_NDVI=NUMBER, Height_Ave_cm=NUMBER)
RAW_TRAINING = T.StructType([*SAMPLES.fields, T.StructField("target_name", TEXT), T.StructField("target", NUMBER)])
FOLD_TABLE = T.StructType(
    [
        T.StructField(KEY, TEXT),
        T.StructField("processed_image_path", TEXT),
        T.StructField(FOLD, T.IntegerType()),
        *[T.StructField(t, NUMBER) for t in TARGETS],
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, never inferred. Columns follow the header; a malformed row is an error."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", enforceSchema=False)


def write_csv(df: DataFrame, path: str) -> None:
    """Report as CSV with a header, one part per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def image_files(spark: SparkSession, folder: str, pattern: str = "*.{jpg,jpeg,png}") -> DataFrame:
    """``(image_path, length, modified)`` of the files below a folder. Contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return listing.load(folder).select(
        F.col("path").alias(KEY), "length", F.col("modificationTime").alias("modified")
    )


def relative_to(path: Column | str, base: str) -> Column:
    """File path without its scheme and base folder."""
    return F.regexp_replace(path, f"^(file:)?/*{base.strip('/')}/", "")


def write_embeddings(df: DataFrame, path: str, key: str = KEY, embedding: str = "embedding") -> None:
    """Embedding cache: a keyed array column. Rows are found by key, never by position."""
    df.select(key, F.col(embedding).cast("array<float>").alias(embedding)).write.mode("overwrite").parquet(path)


def read_embeddings(spark: SparkSession, path: str, key: str = KEY, embedding: str = "embedding") -> DataFrame:
    schema = T.StructType([T.StructField(key, TEXT), T.StructField(embedding, T.ArrayType(T.FloatType()))])
    return spark.read.schema(schema).parquet(path)


def write_predictions(frame: DataFrame, path: str) -> None:
    """Out-of-fold predictions, laid out by configuration so that one experiment is one folder.

    Rows are gathered by configuration; AQE splits and joins the tasks by their size, so files have the advisory size
    whatever the number of rows.
    """
    (
        frame.hint("rebalance", "model", "feature_set")
        .write.mode("overwrite")
        .partitionBy("model", "feature_set")
        .parquet(path)
    )


def write_parameters(parameters: DataFrame, path: str) -> None:
    """Fold parameters as one small file."""
    parameters.coalesce(1).write.mode("overwrite").parquet(path)


def read_parameters(spark: SparkSession, path: str) -> DataFrame:
    schema = f"{FOLD} int, column string, median double, mean double, std double, mode string"
    return spark.read.schema(schema).parquet(path)
