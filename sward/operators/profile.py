"""Profiles of columns and of array-valued features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.functions.scalars import is_infinite, is_missing
from sward.operators.features import dimensions_long
from sward.operators.quantiles import exact_quantiles


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n_distinct)`` of non-null values.

    Values are deduplicated per column by a plain grouping first, which spreads one large column over all tasks.
    """
    text = [F.col(c).cast("string").alias(c) for c in columns]
    values = df.select(*text).unpivot([], list(columns), "column", "value").where("value IS NOT NULL")
    return values.groupBy("column", "value").agg(F.lit(1).alias("seen")).groupBy("column").agg(
        F.count("seen").alias("n_distinct")
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max of numeric columns, one row per column."""
    long = df.unpivot([], list(columns), "column", "value").where(~is_missing("value"))
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )

    def quartile(p: float, name: str) -> Column:
        return F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)

    quartiles = (
        exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column"])
        .groupBy("column")
        .agg(quartile(0.25, "p25"), quartile(0.5, "p50"), quartile(0.75, "p75"))
    )
    return moments.join(quartiles, on="column").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def matrix_profile(values: DataFrame, row_key: str, value: str = "value", dimension: str = "position") -> DataFrame:
    """One row about a feature or prediction matrix given as rows ``(row_key, dimension, value)``.

    Rows, dimensions, range, mean, population std, and counts of NaN or NULL, infinite and negative entries.
    ``n_samples`` counts distinct keys; ``ragged`` tells when some key doesn't have every dimension once.
    """
    per_row = values.groupBy(row_key, dimension).agg(F.count(F.lit(1)).alias("copies")).groupBy(row_key).agg(
        F.count(F.lit(1)).alias("dimensions"), F.max("copies").alias("copies")
    )
    shape = per_row.agg(
        F.count(F.lit(1)).alias("n_samples"), F.min("dimensions").alias("fewest"), F.max("copies").alias("copies")
    )
    v = F.col(value)
    usable = F.when(~is_missing(value) & ~is_infinite(value), v)
    per_dimension = values.groupBy(dimension).agg(
        F.count(usable).alias("n"),
        F.avg(usable).alias("mean"),
        F.coalesce(F.var_pop(usable), F.lit(0.0)).alias("variance"),
        F.min(usable).alias("low"),
        F.max(usable).alias("high"),
        F.count_if(is_missing(value)).alias("nan_count"),
        F.count_if(is_infinite(value)).alias("inf_count"),
        F.count_if(v < 0).alias("negative_count"),
    )
    mean = F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    square = F.sum(F.col("n") * (F.col("variance") + F.pow("mean", 2.0))) / F.sum("n")
    profile = per_dimension.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.min("low").alias("feature_min"),
        F.max("high").alias("feature_max"),
        mean.alias("feature_mean"),
        F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("feature_std"),
        F.sum("nan_count").alias("nan_count"),
        F.sum("inf_count").alias("inf_count"),
        F.sum("negative_count").alias("negative_count"),
        F.count_if(F.col("variance") == 0).alias("zero_variance_features"),
    )
    ragged = (F.col("fewest") != F.col("n_features")) | (F.col("copies") > 1)
    one = F.lit(1).alias("_one")
    return profile.select("*", one).join(shape.select("*", one), on="_one").select("n_samples", *profile.columns, F.coalesce(ragged, F.lit(False)).alias("ragged"))


def dimension_profile(df: DataFrame, column: str) -> DataFrame:
    """Mean, population std and variance of every position of an array column."""
    return (
        dimensions_long(df, column, [])
        .groupBy("position")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.var_pop("value").alias("variance"),
        )
        .withColumn("constant", F.col("variance") == 0)
    )


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """``(bin, lower, upper, n)`` over equal-width bins between the smallest and largest value; the last bin is closed.

    The bounds are one aggregate row, read as a scalar subquery. Empty bins are included.
    """
    v = F.col(value).cast("double")
    values = df.select(v.alias("v")).where(~is_missing("v") & ~is_infinite("v"))
    # As with the usual library histogram, a single value gets a range of width one around it.
    flat = F.min("v") == F.max("v")
    edges = F.struct(
        F.when(flat, F.min("v") - 0.5).otherwise(F.min("v")).alias("lo"),
        F.when(flat, F.max("v") + 0.5).otherwise(F.max("v")).alias("hi"),
    )
    bounds = values.agg(edges.alias("bounds"))
    placed = values.select("v", bounds.scalar().alias("at"))
    counted = placed.groupBy(
        F.least(F.width_bucket("v", "at.lo", "at.hi", F.lit(bins)), F.lit(bins)).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))
    frame = bounds.select("bounds.*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin")).where("lo IS NOT NULL")
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counted, on="bin", how="left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("lo") + F.col("bin") * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def dashboard(df: DataFrame, timestamp: str, tie: str, measures: Sequence[str], averaged: str) -> DataFrame:
    """Number of records, latest value of each measure and the average of one."""
    order = F.struct(F.col(timestamp), F.col(tie))
    return df.agg(
        F.count(F.lit(1)).alias("assessments"),
        *[F.max_by(m, order).alias(f"latest_{m}") for m in measures],
        F.avg(averaged).alias(f"average_{averaged}"),
    )
