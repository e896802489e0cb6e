"""Ready-made Spark ML estimators, one factory per model family.

Each factory returns a fresh estimator for one target, so any of them (or the caller's own) can go into the
cross-validation plans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import BOOSTING, EXTRA_TREES, FOLD, FOREST_TREES, RIDGE_ALPHA, SEED, STOCHASTIC_BOOSTING, TARGETS
from sward.operators.bounded import held
from sward.plans.forests import ForestRegressor

#: Spark's upper limit; the published models grow their trees without a limit.
DEEPEST = 30
#: Levels that Spark ML's forests grow here. Below, nodes are too many for histograms of each in every task.
SHALLOW = 10


def random_forest(trees: int = FOREST_TREES, depth: int = DEEPEST, min_leaf: int = 1, seed: int = SEED):
    """Bootstrap trees with all features at every split: Spark ML's down to ``SHALLOW``, deeper ones as in ``forests``."""
    if depth > SHALLOW:
        return lambda: ForestRegressor(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed)
    return lambda: RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy="all", seed=seed
    )


def extra_trees(trees: int = EXTRA_TREES, depth: int = DEEPEST, min_leaf: int = 1, seed: int = SEED):
    """Nearest Spark relative of extremely randomised trees.

    Spark has no random split thresholds. Trees see all rows (no bootstrap) and differ through a random third of the
    features per split; with all features they would be identical. Scores are not claimed to be equal.
    """
    return lambda: RandomForestRegressor(
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        bootstrap=False,
        featureSubsetStrategy="onethird",
        seed=seed,
    )


def boosting(depth: int = 5, seed: int = SEED, **settings):
    """Gradient boosting; the histogram variant of the published experiments is Spark's only variant."""
    return lambda: GBTRegressor(**{"maxDepth": depth, "seed": seed, **BOOSTING, **settings})


def stochastic_boosting(depth: int = 6, seed: int = SEED, **settings):
    """Boosting with row subsampling, standing in for the optional third-party boosters.

    ``featureSubsetStrategy`` takes the place of column sampling.
    """
    return lambda: GBTRegressor(
        **{"maxDepth": depth, "seed": seed, "featureSubsetStrategy": "0.8", **STOCHASTIC_BOOSTING, **settings}
    )


def huber_head(max_iterations: int = 100, epsilon: float = 1.35):
    """Robust linear head on frozen embeddings."""
    return lambda: LinearRegression(loss="huber", epsilon=epsilon, maxIter=max_iterations, solver="l-bfgs")


def ridge_per_fold(
    df: DataFrame, targets: Sequence[str] = TARGETS, alpha: float = RIDGE_ALPHA, fold: str = FOLD
) -> Callable[[int, str], LinearRegression]:
    """Ridge for each fold's training set: penalty ``alpha * |w|^2`` on the summed squared error, free intercept.

    Spark penalises the mean squared error of a target scaled by its standard deviation, so the same penalty is
    ``alpha * sigma / n`` there. The moments of all training sets come from one aggregate with a row per fold (eager).
    """
    moments = [f"struct(count({t}) AS n, avg({t}) AS mean, var_pop({t}) AS variance) AS {t}" for t in targets]
    rows = held(df.groupBy(fold).agg(*[F.expr(m) for m in moments]), what="folds").collect()

    def build(k: int, target: str) -> LinearRegression:
        parts = [r[target] for r in rows if r[fold] != k]
        n = sum(p["n"] for p in parts)
        mean = sum(p["n"] * p["mean"] for p in parts) / n
        variance = sum(p["n"] * (p["variance"] + (p["mean"] - mean) ** 2) for p in parts) / n
        return LinearRegression(
            elasticNetParam=0.0, standardization=False, solver="normal", regParam=alpha * variance**0.5 / n
        )

    return build


def importances(df: DataFrame, models: dict[tuple[int, str], Model], features: Sequence[str]) -> DataFrame:
    """Tree importances of fold models as rows ``(fold, target, feature, importance)``; zero ones included."""
    schema = T.StructType(
        [
            T.StructField("fold", T.IntegerType()),
            T.StructField("target", T.StringType()),
            T.StructField("feature", T.StringType()),
            T.StructField("importance", T.DoubleType()),
        ]
    )
    rows = [
        (fold, target, name, float(weight))
        for (fold, target), model in models.items()
        for name, weight in zip(features, model.featureImportances.toArray(), strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def training_history(df: DataFrame, models: dict[tuple[int, str], Model]) -> DataFrame:
    """Loss per iteration of every fold model, ``(fold, target, iteration, loss)``. Needs an iterative solver."""
    rows = [
        (fold, target, i, float(loss))
        for (fold, target), model in models.items()
        for i, loss in enumerate(model.summary.objectiveHistory)
    ]
    return df.sparkSession.createDataFrame(rows, "fold int, target string, iteration int, loss double")
