"""Fold-safe metadata preprocessing.

Fitting gives a small parameter table, one row per held-out fold; transforming fetches it (the eager part) and is a join
on the fold followed by plain column expressions. No statistic of a fold is ever learned from that fold's own rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.constants import CATEGORICAL_METADATA, FOLD, KEY, N_FOLDS, NUMERIC_METADATA
from sward.functions.scalars import is_missing
from sward.operators.bounded import held
from sward.operators.folds import MAX_FOLDS, checked_folds, covered_folds, found_folds, list_folds  # noqa: F401
from sward.operators.quantiles import exact_quantiles

MAX_VOCABULARY = 2_000


def assign_folds(df: DataFrame, group: str, folds: int = N_FOLDS, hashed: bool = True) -> DataFrame:
    """Put all rows of a group into one fold, by hash (any type) or by remainder (integer groups)."""
    basis = F.xxhash64(group) if hashed else F.col(group)
    return df.withColumn(FOLD, F.pmod(basis, F.lit(folds)).cast("int"))


def vocabularies(df: DataFrame, columns: Sequence[str] = CATEGORICAL_METADATA) -> DataFrame:
    """``(column, vocabulary)``: sorted distinct non-null categories over all rows, as arrays."""
    pairs = df.unpivot([], list(columns), "column", "category").where("category IS NOT NULL").distinct()
    # The limit keeps a runaway column from filling a task; it can only be reached when the check below fails.
    bounded = pairs.limit(MAX_VOCABULARY * len(columns) + 1)
    words = F.array_sort(F.collect_list("category"))
    too_many = F.raise_error(F.concat("column", F.lit(f" has more than {MAX_VOCABULARY} categories"))).cast("array<string>")
    return bounded.groupBy("column").agg(
        F.when(F.count(F.lit(1)) > MAX_VOCABULARY, too_many).otherwise(words).alias("vocabulary")
    )


def collect_vocabularies(df: DataFrame, columns: Sequence[str] = CATEGORICAL_METADATA) -> dict[str, list[str]]:
    """Eager: vocabularies on the driver, where they become column names. Fails beyond MAX_VOCABULARY categories."""
    found = {}
    for column in columns:
        distinct = df.select(column).where(F.col(column).isNotNull()).distinct().limit(MAX_VOCABULARY + 1)
        values = sorted(r[0] for r in distinct.collect())
        if len(values) > MAX_VOCABULARY:
            raise ValueError(f"{column} has more than {MAX_VOCABULARY} categories, too many to one-hot encode")
        found[column] = values
    return found


def _other_folds(fold: str, folds: Sequence[int]) -> Column:
    """The folds whose training set a row of ``fold`` belongs to."""
    return F.explode(F.array_compact(F.array(*[F.when(F.col(fold) != int(k), int(k)) for k in folds])))


def training_medians(df: DataFrame, columns: Sequence[str], folds: Sequence[int], fold: str = FOLD) -> DataFrame:
    """``(fold, column, median)`` over the rows outside each fold, exact."""
    long = df.unpivot([fold], list(columns), "column", "value").where(~is_missing("value"))
    others = F.array_compact(F.array(*[F.when(F.col(fold) != int(k), int(k)) for k in folds]))
    return exact_quantiles(long, "value", [0.5], [fold, "column"], spread=(fold, others)).select(
        fold, "column", F.col("quantile").alias("median")
    )


def training_moments(df: DataFrame, columns: Sequence[str], folds: Sequence[int], fold: str = FOLD) -> DataFrame:
    """``(fold, column, n, n_missing, mean, m2)`` outside each fold, merged from per-fold moments.

    The rows are read once; only a handful of partial moments is combined per held-out fold.
    """
    long = df.unpivot([fold], list(columns), "column", "value")
    value = F.when(~is_missing("value"), F.col("value"))
    per_fold = long.groupBy(fold, "column").agg(
        F.count(value).alias("n"),
        F.count_if(is_missing("value")).alias("n_missing"),
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(value), F.lit(0.0)).alias("variance"),
    )
    parts = per_fold.select(_other_folds(fold, folds).alias(fold), "column", "n", "n_missing", "mean", "variance")
    merged = parts.groupBy(fold, "column").agg(
        F.sum("n").alias("n"),
        F.sum("n_missing").alias("n_missing"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"),
        F.collect_list(F.struct("n", "mean", "variance")).alias("parts"),
    )
    spread = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda acc, p: acc + p["n"] * (p["variance"] + F.pow(p["mean"] - F.col("mean"), 2.0)),
    )
    return merged.select(fold, "column", "n", "n_missing", "mean", spread.alias("m2"))


def training_modes(df: DataFrame, columns: Sequence[str], folds: Sequence[int], fold: str = FOLD) -> DataFrame:
    """``(fold, column, mode)`` outside each fold; the smallest category wins a tie."""
    counted = (
        df.unpivot([fold], list(columns), "column", "category")
        .where("category IS NOT NULL")
        .groupBy(fold, "column", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counted.select(_other_folds(fold, folds).alias(fold), "column", "category", "n")
        .groupBy(fold, "column", "category")
        .agg(F.sum("n").alias("n"))
        .groupBy(fold, "column")
        .agg(F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("mode"))
    )


def fit_fold_parameters(
    df: DataFrame,
    folds: Sequence[int] | None = None,
    numeric: Sequence[str] = NUMERIC_METADATA,
    categorical: Sequence[str] = CATEGORICAL_METADATA,
    fold: str = FOLD,
) -> DataFrame:
    """Long parameter table ``(fold, column, median, mean, std, mode)``, one row per held-out fold and column.

    Folds come from the data unless they are given; rows outside them, or without a fold, are an error.
    ``mean`` and population ``std`` describe the values after median imputation; a zero ``std`` becomes 1.
    """
    df = df.select(fold, *numeric, *categorical)
    folds = checked_folds(df, folds, fold)
    numbers = training_moments(df, numeric, folds, fold).join(
        training_medians(df, numeric, folds, fold), on=[fold, "column"], how="left"
    )
    rows = F.col("n") + F.col("n_missing")
    numbers = numbers.withColumn(
        "centre",
        F.when(F.col("n_missing") == 0, F.col("mean")).otherwise(
            (F.col("n") * F.col("mean") + F.col("n_missing") * F.col("median")) / rows
        ),
    )
    scatter = (
        F.col("m2")
        + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2.0)
        + F.col("n_missing") * F.pow(F.col("median") - F.col("centre"), 2.0)
    )
    std = F.sqrt(scatter / rows)
    numbers = numbers.select(
        fold,
        "column",
        "median",
        F.col("centre").alias("mean"),
        F.when(std == 0, 1.0).otherwise(std).alias("std"),
        F.lit(None).cast("string").alias("mode"),
    )
    nothing = F.lit(None).cast("double")
    if not categorical:
        return numbers
    modes = training_modes(df, categorical, folds, fold).select(
        fold, "column", nothing.alias("median"), nothing.alias("mean"), nothing.alias("std"), "mode"
    )
    return numbers.unionByName(modes)


def widen_parameters(
    parameters: DataFrame,
    numeric: Sequence[str] = NUMERIC_METADATA,
    categorical: Sequence[str] = CATEGORICAL_METADATA,
    fold: str = FOLD,
) -> DataFrame:
    """One row per fold with columns ``<column>__median`` and so on, ready to join."""

    def pick(column: str, what: str) -> Column:
        return F.max(F.when(F.col("column") == column, F.col(what))).alias(f"{column}__{what}")

    chosen = [pick(c, what) for c in numeric for what in ("median", "mean", "std")]
    chosen += [pick(c, "mode") for c in categorical]
    return parameters.groupBy(fold).agg(*chosen)


def feature_columns(
    vocabulary: Mapping[str, Sequence[str]], numeric: Sequence[str] = NUMERIC_METADATA
) -> list[tuple[str, Column]]:
    """Output features in order: scaled numerics, then one-hot columns. Unseen categories give all zeros."""
    features = []
    for c in numeric:
        filled = F.when(is_missing(c), F.col(f"{c}__median")).otherwise(F.col(c))
        features.append((c, (filled - F.col(f"{c}__mean")) / F.col(f"{c}__std")))
    for c, values in vocabulary.items():
        filled = F.coalesce(F.col(c), F.col(f"{c}__mode"))
        features += [
            (f"{c}_{v}", F.coalesce(F.when(filled == F.lit(v), 1.0), F.lit(0.0))) for v in values
        ]
    return features


def transform_with(
    df: DataFrame,
    parameters: DataFrame,
    vocabulary: Mapping[str, Sequence[str]],
    numeric: Sequence[str] = NUMERIC_METADATA,
    keep: Sequence[str] = (KEY,),
    fold: str = FOLD,
) -> DataFrame:
    """Apply each row's fold parameters. They are fetched once, one row per fold, and travel to the rows.

    A row whose fold has no parameters is an error.
    """
    wide = held(widen_parameters(parameters, numeric, list(vocabulary), fold), MAX_FOLDS, "fold parameters")
    covered_folds(found_folds(df, fold), [r[0] for r in wide.select(fold).collect()], fold)
    features = feature_columns(vocabulary, numeric)
    return df.join(wide, on=fold).select(*keep, fold, *[expr.alias(name) for name, expr in features])


def out_of_fold_features(
    df: DataFrame,
    vocabulary: Mapping[str, Sequence[str]] | None = None,
    folds: Sequence[int] | None = None,
    numeric: Sequence[str] = NUMERIC_METADATA,
    categorical: Sequence[str] = CATEGORICAL_METADATA,
    keep: Sequence[str] = (KEY,),
    fold: str = FOLD,
) -> DataFrame:
    """Every row transformed with parameters learned outside its own fold.

    Category names come from all rows, so every fold has the same columns; statistics do not. Folds come from the data
    unless they are given.
    """
    if vocabulary is None:
        vocabulary = collect_vocabularies(df, categorical)
    parameters = fit_fold_parameters(df, folds, numeric, categorical, fold)
    return transform_with(df, parameters, vocabulary, numeric, keep, fold)


def transform_new_rows(
    df: DataFrame,
    parameters: DataFrame,
    vocabulary: Mapping[str, Sequence[str]],
    folds: Sequence[int] | None = None,
    numeric: Sequence[str] = NUMERIC_METADATA,
    keep: Sequence[str] = (KEY,),
    fold: str = FOLD,
) -> DataFrame:
    """New rows under every fold's parameters: one output row per input row and fold that parameters exist for.

    A row without any metadata becomes the medians and modes.
    """
    parameters = held(parameters, what="fold parameters")
    known = found_folds(parameters, fold)
    if folds is None:
        folds = known
    covered_folds(folds, known, fold)
    copies = df.drop(fold).withColumn(fold, F.explode(F.array(*[F.lit(int(k)) for k in folds])))
    return transform_with(copies, parameters, vocabulary, numeric, keep, fold)
