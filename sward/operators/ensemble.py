"""Averages over fold models, blends of two prediction sets, and parity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.constants import BLEND_STEPS, FOLD, KEY, PARITY_ATOL, PARITY_RTOL
from sward.functions.scalars import clip_lower, even_grid, is_missing


def fold_mean(predictions: DataFrame, folds: int | None = None, key: str = KEY) -> DataFrame:
    """Mean over the fold models of the clipped predictions, clipped again.

    ``folds`` is the number of models; it is read from the data (eager) when the table has a fold column and the number
    is not given. A key with fewer or more predictions than that, or with an empty one, is an error.
    """
    if folds is None:
        folds = predictions.select(FOLD).distinct().count()
    missing = F.count_if(is_missing("pred")) + F.abs(F.count(F.lit(1)) - folds)
    return (
        predictions.groupBy(key, "target")
        .agg(missing.alias("missing"), F.avg(clip_lower("pred")).alias("pred"))
        .select(
            key,
            "target",
            F.when(F.col("missing") == 0, clip_lower("pred"))
            .otherwise(F.raise_error(F.lit("a fold gave no prediction")).cast("double"))
            .alias("pred"),
        )
    )


def paired(first: DataFrame, second: DataFrame, key: str = KEY) -> DataFrame:
    """``(key, target, y, a, b)`` from two long prediction tables, which must cover the same keys once each.

    Both tables meet in one counted union: one shuffle that also finds missing and repeated keys, which are errors.
    """
    nothing = F.lit(None).cast("double")
    left = first.select(key, "target", F.col("y").alias("y"), F.col("pred").alias("a"), nothing.alias("b"), F.lit(1).alias("l"), F.lit(0).alias("r"))
    right = second.select(key, "target", nothing.alias("y"), nothing.alias("a"), F.col("pred").alias("b"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    matched = left.unionByName(right).groupBy(key, "target").agg(
        F.max("y").alias("y"), F.max("a").alias("a"), F.max("b").alias("b"), F.sum("l").alias("l"), F.sum("r").alias("r")
    )
    problem = F.concat(F.lit("predictions do not align at "), F.col(key).cast("string"), F.lit(" / "), F.col("target"))
    once = F.when((F.col("l") == 1) & (F.col("r") == 1), F.col("a")).otherwise(F.raise_error(problem).cast("double"))
    return matched.select(key, "target", "y", once.alias("a"), "b")


def with_weight_grid(df: DataFrame, steps: int = BLEND_STEPS) -> DataFrame:
    """Every row under every weight from 0 to 1. Rows multiply inside their task, without a join."""
    return df.withColumn("weight", F.explode(even_grid(steps)))


def _error_sums(pairs: DataFrame) -> DataFrame:
    ea, eb = F.col("y") - F.col("a"), F.col("y") - F.col("b")
    return pairs.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(ea * ea).alias("aa"),
        F.sum(ea * eb).alias("ab"),
        F.sum(eb * eb).alias("bb"),
    )


def blend_search(pairs: DataFrame, steps: int = BLEND_STEPS) -> DataFrame:
    """Mean over targets of the RMSE of ``w * a + (1 - w) * b`` for every weight.

    The squared error is quadratic in ``w``, so three sums per target answer a grid of any size with one pass.
    """
    w = F.col("weight")
    # Rounding can push a perfect blend's sum a hair below zero.
    sse = F.greatest(w * w * F.col("aa") + 2.0 * w * (1.0 - w) * F.col("ab") + (1.0 - w) * (1.0 - w) * F.col("bb"), F.lit(0.0))
    per_target = with_weight_grid(_error_sums(pairs), steps).withColumn("rmse", F.sqrt(sse / F.col("n")))
    return per_target.groupBy("weight").agg(F.avg("rmse").alias("mean_rmse")).select(
        F.col("weight").alias("weight_a"), (1.0 - F.col("weight")).alias("weight_b"), "mean_rmse"
    )


def best_blend(search: DataFrame) -> DataFrame:
    """The weight with the lowest error, the smallest such weight on a tie."""
    from sward.operators.ranking import lowest_row

    return lowest_row(search, ["mean_rmse", "weight_a"])


def blended(weight: Column | float, a: str = "a", b: str = "b") -> Column:
    weight = F.lit(float(weight)) if isinstance(weight, (int, float)) else weight
    return weight * F.col(a) + (1.0 - weight) * F.col(b)


def parity(pairs: DataFrame, rtol: float = PARITY_RTOL, atol: float = PARITY_ATOL) -> DataFrame:
    """Largest and mean absolute difference, and whether ``|a - b| <= atol + rtol * |b|`` for every pair."""
    gap = F.abs(F.col("a") - F.col("b"))
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.max(gap).alias("max_abs_diff"),
        F.avg(gap).alias("mean_abs_diff"),
        F.bool_and(F.coalesce(gap <= atol + rtol * F.abs("b"), F.lit(False))).alias("within_tolerance"),
    )
