"""Regression metrics over long predictions, and the reports built on them.

Long predictions have one row per model, feature set, key and target, with columns ``y`` and ``pred``. Everything
after them is grouped aggregation that combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import KEY, TARGETS

CONFIGURATION = ("model", "feature_set")


def r_squared(y: str = "y", pred: str = "pred") -> Column:
    """1 - SSE / SST. With a constant target it is 1 for perfect predictions and 0 otherwise.

    Can be negative; it is not ``regr_r2``.
    """
    sse = F.sum(F.pow(F.col(y) - F.col(pred), 2.0))
    sst = F.count(F.lit(1)) * F.var_pop(y)
    return F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(1.0 - F.try_divide(sse, sst))


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    """MAE, RMSE and R2 per group in one pass. Missing predictions raise an error."""
    error = F.col("y") - F.col("pred")
    incomplete = F.count_if(F.col("y").isNull() | F.col("pred").isNull())
    measured = predictions.groupBy(*by).agg(
        incomplete.alias("incomplete"),
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        r_squared().alias("R2"),
    )
    complete = F.when(F.col("incomplete") == 0, F.col("MAE")).otherwise(
        F.raise_error(F.lit("metrics over missing values or predictions")).cast("double")
    )
    return measured.select(*by, complete.alias("MAE"), "RMSE", "R2")


def fold_metrics(predictions: DataFrame) -> DataFrame:
    return regression_metrics(predictions, (*CONFIGURATION, "fold", "target"))


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of every metric over the folds."""
    columns = []
    for name in ("MAE", "RMSE", "R2"):
        columns += [F.avg(name).alias(f"{name}_mean"), F.stddev_samp(name).alias(f"{name}_std")]
    return folds.groupBy(*CONFIGURATION, "target").agg(*columns)


def configuration_means(summary: DataFrame) -> DataFrame:
    """Mean over the targets of the per-target means, one row per configuration."""
    return summary.groupBy(*CONFIGURATION).agg(
        *[F.avg(f"{name}_mean").alias(f"mean_{name}") for name in ("MAE", "RMSE", "R2")]
    )


def pooled_metrics(predictions: DataFrame, by: Sequence[str] = CONFIGURATION) -> DataFrame:
    """MAE and RMSE over all targets together, and R2 as the plain mean over targets.

    Built from per-target sums so that the predictions are read once.
    """
    error = F.col("y") - F.col("pred")
    per_target = predictions.groupBy(*by, "target").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(error)).alias("abs_sum"),
        F.sum(error * error).alias("sq_sum"),
        r_squared().alias("R2"),
    )
    return per_target.groupBy(*by).agg(
        (F.sum("abs_sum") / F.sum("n")).alias("OOF_MAE"),
        F.sqrt(F.sum("sq_sum") / F.sum("n")).alias("OOF_RMSE"),
        F.avg("R2").alias("OOF_R2"),
    )


def numeric_means(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean of every numeric column that is not a grouping column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in by]
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in numeric])


def rounded_means(df: DataFrame, by: Sequence[str], columns: Sequence[str] = TARGETS, digits: int = 3) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.avg(c), digits).alias(c) for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Occurrences per value. Order the result only where it is shown: it is as small as the column's vocabulary."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def metric_pivot(summary: DataFrame, labels: Sequence[tuple[str, str]], measure: str = "RMSE_mean") -> DataFrame:
    """Targets by configuration. ``labels`` lists the configurations, so no extra job has to find them."""
    columns = [
        F.avg(F.when((F.col("model") == model) & (F.col("feature_set") == name), F.col(measure))).alias(
            f"{model} + {name}"
        )
        for model, name in labels
    ]
    return summary.groupBy("target").agg(*columns)


def widen_targets(long: DataFrame, key: str = KEY, targets: Sequence[str] = TARGETS, missing: float | None = None) -> DataFrame:
    """One row per key with a column per target; a target given twice for a key is an error."""

    def pick(target: str) -> Column:
        mine = F.col("target_name") == target
        value = F.max(F.when(mine, F.col("target")))
        if missing is not None:
            value = F.coalesce(value, F.lit(missing))
        return (
            F.when(F.count_if(mine) > 1, F.raise_error(F.lit(f"more than one {target} for a key")).cast("double"))
            .otherwise(value)
            .alias(target)
        )

    return long.groupBy(key).agg(*[pick(t) for t in targets])


def lengthen_targets(
    wide: DataFrame,
    ids: Sequence[str] = (KEY,),
    targets: Sequence[str] = TARGETS,
    name: str = "target_name",
    value: str = "target",
) -> DataFrame:
    return wide.unpivot(list(ids), list(targets), name, value)


def improvement_percentage(comparison: DataFrame) -> DataFrame:
    """Share of comparisons that the challenger wins, in percent."""
    return comparison.agg(
        F.count(F.lit(1)).alias("pairs"), (F.avg(F.col("improved").cast("int")) * 100.0).alias("improvement_pct")
    )


def mean_importances(importances: DataFrame) -> DataFrame:
    """Importance per feature: mean over the targets of a fold, then over the folds."""
    per_fold = importances.groupBy("fold", "feature").agg(F.avg("importance").alias("importance"))
    return per_fold.groupBy("feature").agg(F.avg("importance").alias("importance"))


def family_importances(means: DataFrame, family: Column) -> DataFrame:
    return (
        means.withColumn("feature_group", family)
        .groupBy("feature_group")
        .agg(F.sum("importance").alias("importance"))
    )


def experiment_size(metrics: DataFrame) -> DataFrame:
    """Rows present against experiments x folds x targets."""
    return metrics.agg(
        F.count(F.lit(1)).alias("actual"),
        (
            F.count_distinct(*[F.col(c) for c in CONFIGURATION])
            * F.count_distinct("fold")
            * F.count_distinct("target")
        ).alias("expected"),
    )


def prediction_frame(predictions: DataFrame, key: str = KEY, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Wide report: per key the actual value, prediction and residual of each target."""
    columns = []
    for target in targets:
        mine = F.col("target") == target
        actual, pred = F.max(F.when(mine, F.col("y"))), F.max(F.when(mine, F.col("pred")))
        columns += [
            actual.alias(f"actual_{target}"),
            pred.alias(f"pred_{target}"),
            (actual - pred).alias(f"residual_{target}"),
        ]
    return predictions.groupBy(key, "fold").agg(*columns)


def oof_frame(predictions: DataFrame, key: str = KEY, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Wide out-of-fold table: key, fold, ``pred_<target>`` and the configuration."""
    columns = [F.max(F.when(F.col("target") == t, F.col("pred"))).alias(f"pred_{t}") for t in targets]
    wide = predictions.groupBy(key, "fold", *CONFIGURATION).agg(*columns)
    return wide.select(key, "fold", *[f"pred_{t}" for t in targets], *CONFIGURATION)


def results_table(prediction: DataFrame, area: Column, targets: Sequence[str] = TARGETS, key: str = KEY) -> DataFrame:
    """One row per target: display label, grams and kilograms per hectare."""
    from sward.functions.scalars import density_kg_ha, lookup_label

    return (
        prediction.withColumn("area_m2", area)
        .unpivot([key, "area_m2"], list(targets), "target", "grams")
        .select(
            key,
            lookup_label("target").alias("component"),
            "grams",
            density_kg_ha("grams", "area_m2").alias("kg_ha"),
        )
    )
