"""Ridge regression from sufficient statistics.

A ridge fit needs only sums of products. Those of every fold are gathered in one pass over the rows; the training set
of a held-out fold is the sum of the other folds. So cross-validation over k folds and several targets costs one scan
plus one scoring pass, instead of k x targets fits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.constants import FOLD, RIDGE_ALPHA, TARGETS
from sward.functions.scalars import sql_name, sql_text
from sward.operators.bounded import held
from sward.operators.folds import checked_folds, covered_folds, found_folds


def _outside(folds: Sequence[int], fold: str = FOLD) -> Column:
    return F.explode(F.array_compact(F.array(*[F.when(F.col(fold) != int(k), int(k)) for k in folds])))


def single_feature_fits(
    df: DataFrame,
    features: Sequence[str],
    alphas: Sequence[float] = (RIDGE_ALPHA,),
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    fold: str = FOLD,
) -> DataFrame:
    """One-feature ridge fits ``(fold, feature, target, alpha, slope, intercept)`` on the rows outside each fold.

    The intercept is not penalised. Moments are centred per fold and merged, so large offsets lose no digits. Folds come
    from the data unless they are given; a row outside them is an error.
    """
    folds = checked_folds(df, folds, fold)
    # Pairs are unfolded: few sums a row run far faster than one aggregate with five sums for every pair.
    cells = ", ".join(
        f"struct({sql_text(a)} AS feature, {sql_text(b)} AS target, {x} AS x, {y} AS y)"
        for a, x in ((c, f"double({sql_name(c)})") for c in features)
        for b, y in ((c, f"double({sql_name(c)})") for c in targets)
    )
    moments = (
        "count_if(x IS NOT NULL AND y IS NOT NULL) AS n",
        "avg(x) FILTER (WHERE y IS NOT NULL) AS mx",
        "avg(y) FILTER (WHERE x IS NOT NULL) AS my",
        "var_pop(x) FILTER (WHERE y IS NOT NULL) AS vx",
        "covar_pop(x, y) AS cxy",
    )
    per_fold = df.selectExpr(f"{sql_name(fold)} AS {sql_name(fold)}", f"inline(array({cells}))").groupBy(fold, "feature", "target").agg(*map(F.expr, moments))
    merged = (
        per_fold.select(_outside(folds, fold).alias(fold), "feature", "target", "n", "mx", "my", "vx", "cxy")
        .groupBy(fold, "feature", "target")
        .agg(
            F.expr("sum(n * mx) / sum(n)").alias("mx"),
            F.expr("sum(n * my) / sum(n)").alias("my"),
            F.expr("collect_list(struct(n, mx, my, vx, cxy))").alias("parts"),
        )
    )
    # Moments of the training set around its own means; a part is one fold.
    sxx = "aggregate(parts, 0D, (acc, p) -> acc + p.n * (p.vx + (p.mx - mx) * (p.mx - mx)))"
    sxy = "aggregate(parts, 0D, (acc, p) -> acc + p.n * (p.cxy + (p.mx - mx) * (p.my - my)))"
    penalties = ", ".join(f"{float(a)!r}D" for a in alphas)
    return (
        merged.selectExpr(fold, "feature", "target", "mx", "my", f"{sxx} AS sxx", f"{sxy} AS sxy", f"explode(array({penalties})) AS alpha")
        .selectExpr(fold, "feature", "target", "mx", "my", "alpha", "coalesce(try_divide(sxy, sxx + alpha), 0D) AS slope")
        .selectExpr(fold, "feature", "target", "alpha", "slope", "my - slope * mx AS intercept")
    )


def _design_rows(part: pd.DataFrame, features: str, targets: Sequence[str]) -> np.ndarray:
    x = np.stack(part[features].to_numpy()).astype(float)
    z = np.hstack([x, part[list(targets)].to_numpy(float)])
    if not np.isfinite(z).all():
        raise ValueError("features and targets must be finite")
    return z


def column_means(df: DataFrame, features: str, targets: Sequence[str] = TARGETS) -> np.ndarray:
    """Eager: means of the features and targets over all rows, one vector per partition merged by its row count."""

    def means(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, mean = 0, 0.0
        for batch in batches:
            if len(batch):
                z = _design_rows(batch, features, targets)
                n += len(z)
                mean = mean + (z.mean(axis=0) - mean) * (len(z) / n)
        if n:
            yield pd.DataFrame({"n": n, "i": np.arange(len(mean)), "mean": mean})

    columns = df.select(F.col(features).cast("array<double>").alias(features), *targets)
    parts = columns.mapInPandas(means, "n long, i int, mean double")
    merged = parts.groupBy("i").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"))
    found = {row["i"]: row["mean"] for row in merged.collect()}
    return np.array([found[i] for i in range(len(found))])


#: Groups in which matrices of partitions are added, from the widest level to the last.
LEVELS = (4096, 64, 1)


def product_sums(
    df: DataFrame, features: str, shift: np.ndarray, targets: Sequence[str] = TARGETS, fold: str = FOLD
) -> DataFrame:
    """``(fold, i, row)``: sums of products of ``(1, features, targets)`` minus ``shift`` per fold, row by row.

    Values are shifted before they are multiplied, so a large offset costs no digits. Each partition sends one matrix per
    fold; they are added in levels, so that no group grows with the number of partitions.
    """

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        part_of = 0
        for batch in batches:
            for (label, part_of), part in batch.groupby([fold, "part"], sort=False):
                z = np.hstack([np.ones((len(part), 1)), _design_rows(part, features, targets) - shift])
                product = z.T @ z
                sums[label] = sums[label] + product if label in sums else product
        for label, matrix in sums.items():
            yield pd.DataFrame({fold: label, "part": part_of, "i": np.arange(len(matrix)), "row": list(matrix)})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[:1].copy()
        first["row"] = [np.sum(np.stack(group["row"].to_numpy()), axis=0)]
        return first

    schema = f"{fold} int, part int, i int, row array<double>"
    values = F.col(features).cast("array<double>").alias(features)
    columns = df.select(F.col(fold).cast("int").alias(fold), F.spark_partition_id().alias("part"), values, *targets)
    sums = columns.mapInPandas(products, schema)
    for groups in LEVELS:
        sums = sums.withColumn("part", F.col("part") % groups).groupBy(fold, "part", "i").applyInPandas(add, schema)
    return sums.select(fold, "i", "row")


def multi_feature_fits(
    df: DataFrame,
    features: str,
    alpha: float = RIDGE_ALPHA,
    targets: Sequence[str] = TARGETS,
    folds: Sequence[int] | None = None,
    fold: str = FOLD,
) -> DataFrame:
    """Ridge fits on an array column: ``(fold, target, coefficients, intercept)`` from two passes over the rows.

    The systems to solve are as large as the feature vector, whatever the number of rows.
    """
    targets = list(targets)
    folds = checked_folds(df, folds, fold)
    shift = column_means(df, features, targets)

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        label = int(group["held_out"].iloc[0])
        size = int(group["i"].max()) + 1
        total = np.zeros((size, size))
        np.add.at(total, group["i"].to_numpy(), np.stack(group["row"].to_numpy()))
        n, p = total[0, 0], size - 1 - len(targets)
        x, y = slice(1, p + 1), slice(p + 1, size)
        mx, my = total[0, x] / n, total[0, y] / n
        gram = total[x, x] - n * np.outer(mx, mx) + alpha * np.eye(p)
        weights = np.linalg.solve(gram, total[x, y] - n * np.outer(mx, my))
        intercept = my + shift[p:] - (mx + shift[:p]) @ weights
        return pd.DataFrame({fold: label, "target": targets, "coefficients": list(weights.T), "intercept": intercept})

    sums = product_sums(df, features, shift, targets, fold)
    training = sums.select(_outside(folds, fold).alias("held_out"), "i", "row")
    return training.groupBy("held_out").applyInPandas(
        solve, f"{fold} int, target string, coefficients array<double>, intercept double"
    )


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda acc, v: acc + v)


def score_folds(df: DataFrame, fits: DataFrame, features: str, keep: Sequence[str], fold: str = FOLD) -> DataFrame:
    """Predict each row with the fit of its own fold: ``(keep..., fold, target, pred)``."""
    models = held(fits, what="fitted models")
    covered_folds(found_folds(df, fold), found_folds(models, fold), fold)
    return df.select(*keep, fold, features).join(models, on=fold).select(
        *keep, fold, "target", (dot(features, "coefficients") + F.col("intercept")).alias("pred")
    )
