"""Scoring of new rows with the models of all folds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import BATCH_SIZE, FOLD, KEY, NUMERIC_METADATA, TARGETS
from sward.functions.scalars import clip_lower, is_missing, sql_name, sql_text
from sward.operators.bounded import held
from sward.operators.folds import FoldError


def embed(column: str | Column, make_fn: Callable, size: int, batch_size: int = BATCH_SIZE) -> Column:
    """Embedding of an array column by the caller's model, in batches.

    ``make_fn`` is called once per worker and returns a function from a batch ``(rows, values)`` to ``(rows, outputs)``;
    ``size`` is the length of the input arrays. Any framework works that is present on the executors.
    """
    infer = predict_batch_udf(
        make_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size, input_tensor_shapes=[[size]]
    )
    return infer(column)


def linear_map(matrix: np.ndarray) -> Callable:
    """A fixed linear embedding, mainly for tests."""

    def make_fn():
        weights = np.asarray(matrix, dtype=np.float64)
        return lambda batch: (np.asarray(batch, dtype=np.float64) @ weights).astype(np.float32)

    return make_fn


def ensemble_predict(
    df: DataFrame,
    models: Mapping[tuple[int, str], Model],
    targets: Sequence[str] = TARGETS,
    key: str = KEY,
    features: str = "features",
) -> DataFrame:
    """Mean over the fold models, clipped before and after: ``(key, <targets>)``.

    A fold reads ``<features>_<fold>`` where the table has it (see ``fold_vectors``), else ``features``.

    Every model adds a column to the row, so a row meets all models in one task and nothing is shuffled.
    """
    folds = sorted({fold for fold, _ in models})
    for fold in folds:
        for target in targets:
            name = f"_{fold}_{target}"
            own = f"{features}_{fold}"
            model = models[fold, target].copy({}).setPredictionCol(name)
            df = model.setFeaturesCol(own if own in df.columns else features).transform(df)

    def mean(target: str) -> Column:
        parts = [F.col(f"_{fold}_{target}") for fold in folds]
        total = sum((clip_lower(p) for p in parts), F.lit(0.0))
        missing = F.lit(False)
        for p in parts:
            missing = missing | is_missing(p)
        broken = F.raise_error(F.lit(f"missing prediction for {target}")).cast("double")
        return F.when(missing, broken).otherwise(clip_lower(total / len(folds))).alias(target)

    return df.select(key, *[mean(t) for t in targets])


def fold_vectors(
    df: DataFrame,
    parameters: DataFrame,
    vocabulary: Mapping[str, Sequence[str]],
    folds: Sequence[int],
    numeric: Sequence[str] = NUMERIC_METADATA,
    static: Sequence[str] = (),
    keep: Sequence[str] = (KEY,),
) -> DataFrame:
    """New rows with one feature vector per fold, ``features_<k>``: metadata under that fold's parameters, then ``static``.

    The parameters (one row per fold and column) are fetched once and become constants of the projection, so the rows
    are neither joined nor multiplied. ``static`` columns, arrays or numbers, are the same for all folds.
    """
    fetched = {(r[FOLD], r["column"]): r for r in held(parameters).collect()}
    parts = [F.col(c) if isinstance(df.schema[c].dataType, T.ArrayType) else F.array(F.col(c)) for c in static]
    blocks = [p.cast("array<double>") for p in parts]

    def vector(k: int) -> Column:
        cells = []
        for c in numeric:
            row = fetched[k, c]
            filled = F.when(is_missing(c), F.lit(row["median"])).otherwise(F.col(c))
            cells.append((filled - F.lit(row["mean"])) / F.lit(row["std"]))
        for c, values in vocabulary.items():
            filled = F.coalesce(F.col(c), F.lit(fetched[k, c]["mode"]))
            cells += [F.when(filled == F.lit(v), 1.0).otherwise(0.0) for v in values]
        return array_to_vector(F.concat(F.array(*cells), *blocks)).alias(f"features_{k}")

    return df.select(*keep, *[vector(int(k)) for k in folds])


LinearModels = dict[tuple[str, str], list[dict[str, float]]]


def linear_models(fits: DataFrame, parameters: DataFrame, fold: str = FOLD) -> LinearModels:
    """Fitted one-feature ridge models: per feature and target the numbers of every fold.

    ``fits`` has ``(fold, feature, target, slope, intercept)`` and ``parameters`` ``(fold, column, median, mean, std)``.
    Eager; a few numbers per fold and target are fetched, with a checked limit.
    """
    numbers = parameters.select(fold, F.col("column").alias("feature"), "median", "mean", "std")
    rows = held(fits.join(numbers, on=[fold, "feature"], how="left"), what="linear models").collect()
    folds = {row[fold] for row in rows}
    models: LinearModels = {}
    for row in sorted(rows, key=lambda row: (row["feature"], row["target"], row[fold])):
        if row["std"] is None:
            raise FoldError(f"no parameters for {row['feature']} in fold {row[fold]}")
        fitted = {name: float(row[name]) for name in ("slope", "intercept", "median", "mean", "std")}
        models.setdefault((row["feature"], row["target"]), []).append(fitted)
    short = [name for name, fitted in models.items() if len(fitted) != len(folds)]
    if short:
        raise FoldError(f"{short[0]} is not fitted in every fold")
    return models


def score_with(df: DataFrame, models: LinearModels, key: str = KEY) -> DataFrame:
    """New rows through every fold's imputation, scaling and fit; mean over folds of the clipped predictions.

    Gives ``(key, feature, target, pred)``. The fitted numbers are constants of one projection, so there is no join and
    no shuffle of the rows, in batch and on a stream.
    """

    def of_fold(feature: str, m: dict[str, float]) -> str:
        x = f"double({sql_name(feature)})"
        filled = f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {m['median']!r}D ELSE {x} END"
        value = f"{m['slope']!r}D * ({filled} - {m['mean']!r}D) / {m['std']!r}D + {m['intercept']!r}D"
        return f"CASE WHEN {value} < 0 THEN 0D ELSE {value} END"

    cells = []
    for (feature, target), fitted in models.items():
        total = " + ".join(f"({of_fold(feature, m)})" for m in fitted)
        cells.append(f"struct({sql_text(feature)} AS feature, {sql_text(target)} AS target, ({total}) / {len(fitted)} AS pred)")
    return df.select(key, F.expr(f"inline(array({', '.join(cells)}))"))
