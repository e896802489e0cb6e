"""Model training, cross-validation and scoring with Spark ML."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import TARGETS, r, sql
from sward.catalog.reports import NEW_ROWS_SQL
from sward.constants import KEY, METADATA, NUMERIC_METADATA
from sward.functions import scalars
from sward.operators import metrics, preprocess, ranking
from sward.plans import cross_validation, dense_head, estimators, ridge, scoring, trees
from sward.session import is_stored, stored_once, work_path
from sward.sources import views

FOLDS = range(5)
#: Documented query parameters: smaller forests and fewer rounds than the library's defaults (constants.py), which don't
#: finish here for every fold and target. All rows, folds, targets and features take part.
TREES = {"trees": 10, "depth": 5}
BOOSTS = {"maxIter": 5, "depth": 3}


def ridge_table(spark, folder):
    return base.design(spark, folder).withColumn("features", array_to_vector(F.array("Height_Ave_cm")))


def ridge_models(spark, folder):
    table = ridge_table(spark, folder)
    per_job = estimators.ridge_per_fold(table)
    return table, cross_validation.fit_folds(table, None, TARGETS, per_job=per_job)


def image_table(spark, folder):
    """Embeddings and scaled metadata as vectors, with the targets; stored, as every fit reads it.

    Statistics are of all samples. Where no query has stored the design table yet, only its rows of images that have an
    embedding are made: these samples alone are transformed, and these components alone added up.
    """

    def build():
        embedded = views.embeddings(spark, folder).select(KEY, F.col("embedding").cast("array<double>").alias("embedding"))
        if is_stored(spark, f"{folder}/design"):
            table = base.design(spark, folder).join(embedded, on=KEY)
        else:
            wanted = embedded.select(KEY)
            samples = base.stored_samples(spark, folder).join(wanted, on=KEY, how="left_semi")
            scaled = preprocess.transform_with(samples, base.numeric_parameters(spark, folder), {})
            targets = views.wide_targets(spark, folder).join(wanted, on=KEY, how="left_semi")
            table = scaled.join(targets, on=KEY).join(embedded, on=KEY)
        metadata = F.array(*[F.col(c) for c in NUMERIC_METADATA])
        return table.select(
            KEY,
            "fold",
            *TARGETS,
            array_to_vector("embedding").alias("cnn"),
            array_to_vector(metadata).alias("metadata"),
            array_to_vector(F.concat("embedding", metadata)).alias("combined"),
        )

    return stored_once(spark, f"{folder}/image-table", build)


def _validated(spark, folder, factory, model, targets=TARGETS, clip=True):
    predictions, models = cross_validation.cross_validate(
        image_table(spark, folder), factory, model, "Combined", targets, FOLDS, "combined", clip=clip
    )
    return metrics.fold_metrics(predictions), models


@query(
    "k1_ridge",
    sql(f"SELECT k AS fold, target, {r('slope', 'slope')}, {r('intercept', 'intercept')} FROM fits WHERE model = 'Ridge' AND feature_set = 'Height'"),
)
def k1_ridge(spark, folder):
    """Coefficients of the ML ridge models against the closed form."""
    _, models = ridge_models(spark, folder)
    rows = [(fold, target, float(m.coefficients[0]), float(m.intercept)) for (fold, target), m in models.items()]
    return base.rounded(spark.createDataFrame(rows, "fold int, target string, slope double, intercept double"))


@query(
    "k1_ridge_products",
    sql(f"""SELECT k AS fold, target, {r('(c * sny - d * shy) / det', 'w_ndvi')}, {r('(a * shy - d * sny) / det', 'w_height')},
        {r('my - (c * sny - d * shy) / det * mn - (a * shy - d * sny) / det * mh', 'intercept')} FROM (
            SELECT *, a * c - d * d AS det FROM (
                SELECT k, target, avg(y) AS my, avg(z_n) AS mn, avg(z_h) AS mh, count(*) * var_pop(z_n) + 1 AS a,
                       count(*) * var_pop(z_h) + 1 AS c, count(*) * covar_pop(z_n, z_h) AS d,
                       count(*) * covar_pop(z_n, y) AS sny, count(*) * covar_pop(z_h, y) AS shy
                FROM folds JOIN scaled ON fold <> k JOIN targets_long USING (image_path) GROUP BY k, target))"""),
)
def k1_ridge_products(spark, folder):
    """Ridge on several features from one pass of product sums."""
    table = base.design(spark, folder).withColumn("x", F.array(*[F.col(c) for c in NUMERIC_METADATA]))
    fits = ridge.multi_feature_fits(table, "x")
    w = F.col("coefficients")
    return base.rounded(fits.select("fold", "target", w[0].alias("w_ndvi"), w[1].alias("w_height"), "intercept"))


@query("k1_ridge_embedding")
def k1_ridge_embedding(spark, folder):
    """Ridge on the whole embedding, scored out of fold and measured."""
    table = base.design(spark, folder).join(views.embeddings(spark, folder).select(KEY, "embedding"), on=KEY)
    fits = ridge.multi_feature_fits(table, "embedding")
    scored = ridge.score_folds(table, fits, "embedding", [KEY])
    actual = metrics.lengthen_targets(table.select(KEY, *TARGETS), name="target", value="y")
    return base.rounded(metrics.regression_metrics(scored.join(actual, on=[KEY, "target"]), ("fold", "target")), 4)


@query("k2_random_forest")
def k2_random_forest(spark, folder):
    return _validated(spark, folder, estimators.random_forest(**TREES), "RandomForest")[0]


#: Trees per fold of the query; 500 were published.
GROWN = 100


def combined_arrays(spark, folder):
    """The combined table with all features as one array ``x``."""
    table = base.combined(spark, folder)
    names = base.combined_features(table)
    return table.select(KEY, "fold", *TARGETS, F.array(*[F.col(f"`{c}`").cast("double") for c in names]).alias("x")), names


def tree_metrics(predictions, model):
    return metrics.fold_metrics(predictions.select(F.lit(model).alias("model"), F.lit("Combined").alias("feature_set"), "fold", KEY, "target", "y", "pred"))


@query("k3_extra_trees")
def k3_extra_trees(spark, folder):
    """Joint extremely randomised trees over all features of the combined table, unlimited as published but in number."""
    table, _ = combined_arrays(spark, folder)
    fitted = trees.extra_trees(table, "x", TARGETS, trees=GROWN)
    return tree_metrics(fitted.predict(table, "x"), "ExtraTrees")


#: The draw of a feature's threshold at a root, as in ``trees.draws``.
_DRAW = "(('0x' || substr(md5(name), 1, 8))::BIGINT + feature * ('0x' || substr(md5(name), 9, 8))::BIGINT) % 4294967296 / 4294967296.0"
_SUMS = ", ".join(f"sum({t}) FILTER (WHERE x <= cut) AS l_{t}, sum({t}) AS s_{t}" for t in TARGETS)
_GAIN = " + ".join(f"l_{t} * l_{t} / nl + (s_{t} - l_{t}) * (s_{t} - l_{t}) / (n - nl) - s_{t} * s_{t} / n" for t in TARGETS)
_LEFT = ", ".join(r(f"l_{t} / nl", f"left_{t}") + ", " + r(f"(s_{t} - l_{t}) / (n - nl)", f"right_{t}") for t in TARGETS)


@query(
    "k3_extra_stumps",
    sql(f"""SELECT k AS fold, tree, feature, {r('cut', 'threshold')}, nl AS n_left, n - nl AS n_right, {_LEFT} FROM (
        SELECT *, row_number() OVER (PARTITION BY k, tree ORDER BY round(gain, 3) DESC, feature) AS place FROM (
            SELECT *, {_GAIN} AS gain FROM (
                SELECT k, tree, feature, any_value(cut) AS cut, count(*) FILTER (WHERE x <= cut) AS nl, count(*) AS n, {_SUMS}
                FROM (SELECT k, tree, feature, low + {_DRAW} * (high - low) AS cut FROM (SELECT *, '42:' || k || ':' || tree || ':1' AS name FROM (
                    SELECT k, feature, min(x) AS low, max(x) AS high FROM folds
                    JOIN (SELECT image_path, fold, 0 AS feature, z_n AS x FROM scaled UNION ALL SELECT image_path, fold, 1, z_h FROM scaled) ON fold <> k
                    JOIN targets_wide USING (image_path) GROUP BY k, feature), range(4) AS r(tree))) cuts
                JOIN (SELECT image_path, fold, 0 AS f, z_n AS x FROM scaled UNION ALL SELECT image_path, fold, 1, z_h FROM scaled) v ON f = feature AND v.fold <> k
                JOIN targets_wide USING (image_path) GROUP BY k, tree, feature) WHERE nl > 0 AND nl < n)) WHERE place = 1"""),
)
def k3_extra_stumps(spark, folder):
    """Four one-split trees a fold on the numeric metadata of all samples: drawn thresholds, joint choice, leaf means."""
    table = base.design(spark, folder).withColumn("x", F.array(*[F.col(c).cast("double") for c in NUMERIC_METADATA]))
    nodes = trees.extra_trees(table, "x", TARGETS, trees=4, depth=1).table(spark)
    root = nodes.where("node = '1'").select("fold", "tree", "feature", "threshold")
    sides = nodes.where("node <> '1'").groupBy("fold", "tree").agg(
        *[F.max(F.when(F.col("node") == place, F.col("n"))).alias(f"n_{side}") for side, place in (("left", "2"), ("right", "3"))],
        *[
            F.max(F.when(F.col("node") == place, F.get("outputs", F.lit(i)))).alias(f"{side}_{t}")
            for i, t in enumerate(TARGETS)
            for side, place in (("left", "2"), ("right", "3"))
        ],
    )
    return base.rounded(root.join(sides, ["fold", "tree"]))


@query("k4_boosting")
def k4_boosting(spark, folder):
    """Histogram boosting over all features of the combined table with the published rounds, rate, leaf limit and L2."""
    table, _ = combined_arrays(spark, folder)
    fitted = trees.boosted_trees(table, "x", TARGETS, trees.Boosting())
    return tree_metrics(reduce(DataFrame.unionByName, [fitted[t].predict(table, "x") for t in TARGETS]), "Boosting")


@query(
    "k4_boosting_stumps",
    sql(f"""WITH s_v AS (SELECT image_path, fold, unnest([0, 1]) AS feature, unnest([round(z_n, 1), round(z_h, 1)]) AS x FROM scaled JOIN targets_wide USING (image_path)),
        s_grid AS (SELECT feature, x, (x + lead(x) OVER (PARTITION BY feature ORDER BY x)) / 2 AS cut FROM (SELECT DISTINCT feature, x FROM s_v)),
        s_means AS (SELECT k, target, avg(y) AS base FROM folds JOIN scaled ON fold <> k JOIN targets_long USING (image_path) GROUP BY k, target),
        s_cells AS (SELECT k, target, feature, x, count(*) AS n, sum(base - y) AS g FROM folds JOIN s_v ON fold <> k JOIN targets_long USING (image_path) JOIN s_means USING (k, target) GROUP BY ALL),
        s_runs AS (SELECT k, target, feature, x, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(n) OVER a AS n, sum(g) OVER a AS g FROM s_cells
            WINDOW w AS (PARTITION BY k, target, feature ORDER BY x), a AS (PARTITION BY k, target, feature)),
        s_best AS (SELECT *, row_number() OVER (PARTITION BY k, target ORDER BY round(gl * gl / (nl + 1) + (g - gl) * (g - gl) / (n - nl + 1) - g * g / (n + 1), 4) DESC, feature, x) AS place
            FROM s_runs WHERE nl >= 20 AND n - nl >= 20)
        SELECT k AS fold, target, feature, {r('cut', 'threshold')}, nl::BIGINT AS n_left, (n - nl)::BIGINT AS n_right,
            {r('-0.05 * gl / (nl + 1)', 'left_value')}, {r('-0.05 * (g - gl) / (n - nl + 1)', 'right_value')}
        FROM s_best JOIN s_grid USING (feature, x) WHERE place = 1""").replace("\nWITH s_v AS", ",\ns_v AS"),
)
def k4_boosting_stumps(spark, folder):
    """One round of two leaves on coarse numeric metadata of all samples: histograms, gains and shrunken values."""
    x = F.array(*[F.round(F.col(c).cast("double"), 1) for c in NUMERIC_METADATA])
    fitted = trees.boosted_trees(base.design(spark, folder).withColumn("x", x), "x", TARGETS, trees.Boosting(rounds=1, leaves=2))
    tables = [fitted[t].table(spark).withColumn("target", F.lit(t)) for t in TARGETS]
    nodes = reduce(DataFrame.unionByName, tables)
    root = nodes.where("node = '1'").select("fold", "target", "feature", "threshold")
    sides = nodes.where("node <> '1'").groupBy("fold", "target").agg(
        *[F.max(F.when(F.col("node") == place, F.col("n"))).alias(f"n_{side}") for side, place in (("left", "2"), ("right", "3"))],
        *[F.max(F.when(F.col("node") == place, F.get("outputs", F.lit(0)))).alias(f"{side}_value") for side, place in (("left", "2"), ("right", "3"))],
    )
    return base.rounded(root.join(sides, ["fold", "target"]))


@query("k5_stochastic_boosting")
def k5_stochastic_boosting(spark, folder):
    return _validated(spark, folder, estimators.stochastic_boosting(**BOOSTS), "StochasticBoosting")[0]


@query("k6_per_target_models")
def k6_per_target_models(spark, folder):
    """One model per target and fold, all five targets."""
    return _validated(spark, folder, estimators.random_forest(trees=3, depth=3), "RandomForest", TARGETS)[0]


@query(
    "k8_advanced_cv",
    sql(f"""SELECT fold, image_path, target, y, {r('pred', 'pred')} FROM oof WHERE model = 'Ridge' AND feature_set = 'Height'"""),
)
def k8_advanced_cv(spark, folder):
    """Fold models of every target, clipped out-of-fold predictions."""
    table, models = ridge_models(spark, folder)
    scored = cross_validation.predict_folds(table, models, TARGETS, clip=True)
    return base.rounded(scored.select("fold", KEY, "target", "y", "pred"), columns=["pred"])


@query("k9_experiment_grid")
def k9_experiment_grid(spark, folder):
    """Models x feature sets, ranked. Estimators are passed in as factories, built-in or the caller's own."""
    predictions, _ = cross_validation.experiment_grid(
        image_table(spark, folder),
        {"Forest": estimators.random_forest(), "Linear": lambda: LinearRegression(regParam=0.1, solver="normal")},
        {"CNN": "cnn", "Metadata": "metadata", "Combined": "combined"},
        TARGETS,
        FOLDS,
    )
    summary = metrics.cv_summary(metrics.fold_metrics(predictions))
    return ranking.rank_configurations(metrics.configuration_means(summary))


def ledger_run(spark, folder):
    factories = {"Forest": estimators.random_forest(), "Linear": lambda: LinearRegression(regParam=0.1, solver="normal")}
    sets = {"CNN": "cnn", "Metadata": "metadata", "Combined": "combined"}
    return cross_validation.restartable_grid(image_table(spark, folder), factories, sets, work_path(spark, "experiments"), TARGETS, FOLDS)


@query("k9_runtimes")
def k9_runtimes(spark, folder):
    """Seconds of every experiment beside its errors, from a ledger that a second run would find complete."""
    predictions, runtimes = ledger_run(spark, folder)
    means = metrics.configuration_means(metrics.cv_summary(metrics.fold_metrics(predictions)))
    seconds = runtimes.groupBy("model", "feature_set").agg(F.sum("seconds").alias("seconds"), F.count("*").alias("folds"))
    return ranking.rank_configurations(means).join(seconds, ["model", "feature_set"])


@query(
    "k11_batch_prediction",
    sql("SELECT image_path, " + ", ".join(r(f"max(CASE WHEN target = '{t}' THEN pred END)", t) for t in TARGETS) + f" FROM ({NEW_ROWS_SQL}) GROUP BY image_path"),
)
def k11_batch_prediction(spark, folder):
    """New rows under every fold's preprocessing and models; mean of the clipped predictions."""
    _, models = ridge_models(spark, folder)
    rows = base.stored_samples(spark, folder)
    vectors = scoring.fold_vectors(rows, base.numeric_parameters(spark, folder), {}, FOLDS, numeric=["Height_Ave_cm"])
    return base.rounded(scoring.ensemble_predict(vectors, models, TARGETS))


_MAP = [(0, 2.0), (7, -1.0), (21, 0.5), (63, 1.0)]


@query(
    "k14_embed",
    sql("SELECT image_path, " + ", ".join(f"CAST(embedding[{i + 1}] * {w} AS DOUBLE) AS out_{j}" for j, (i, w) in enumerate(_MAP)) + " FROM images"),
)
def k14_embed(spark, folder):
    """Batched inference with a model that the caller supplies; here a fixed linear map with exact results."""
    weights = np.zeros((64, len(_MAP)))
    for j, (i, w) in enumerate(_MAP):
        weights[i, j] = w
    rows = views.embeddings(spark, folder)
    out = rows.select(KEY, scoring.embed("embedding", scoring.linear_map(weights), 64).alias("out"))
    return out.select(KEY, *[F.get("out", F.lit(j)).cast("double").alias(f"out_{j}") for j in range(len(_MAP))])


@query("k15_huber_head")
def k15_huber_head(spark, folder):
    table = image_table(spark, folder)
    predictions, _ = cross_validation.cross_validate(
        table, estimators.huber_head(10), "Huber", "CNN", TARGETS, FOLDS, "cnn"
    )
    return metrics.fold_metrics(predictions)


@query("k16_training_history")
def k16_training_history(spark, folder):
    table = image_table(spark, folder)
    models = cross_validation.fit_folds(table, estimators.huber_head(10), TARGETS, FOLDS, "cnn")
    return estimators.training_history(table, models)


#: The published head with a rate that suits its ten epochs of few rows, and four mini-batches each.
HEAD = dense_head.Head(rate=0.01, rounds=4)


def fitted_heads(spark, folder):
    table = base.design(spark, folder).join(views.embeddings(spark, folder).select(KEY, "embedding"), on=KEY)
    return table, dense_head.fit_heads(table, "embedding", TARGETS, HEAD)


@query("k15_dense_head")
def k15_dense_head(spark, folder):
    """One hidden layer and five joint outputs on the embedding, Huber loss: out-of-fold metrics at the best epochs."""
    table, heads = fitted_heads(spark, folder)
    scored = heads.predict(table, "embedding")
    return metrics.fold_metrics(scored.select(F.lit("Dense").alias("model"), F.lit("CNN").alias("feature_set"), "fold", KEY, "target", "y", "pred"))


@query("k16_validation_history")
def k16_validation_history(spark, folder):
    """Training and validation loss and rate by epoch, with the epochs since the best one and whether it is the best."""
    _, heads = fitted_heads(spark, folder)
    history = heads.history(spark)
    order = Window.partitionBy("fold").orderBy("epoch")
    least = F.min("val_loss").over(order.rowsBetween(Window.unboundedPreceding, 0))
    best = F.min_by("epoch", F.struct("val_loss", "epoch")).over(Window.partitionBy("fold"))
    return history.withColumn("least_so_far", least).withColumn("is_best", F.col("epoch") == best)


@query("d19_model_importances")
def d19_model_importances(spark, folder):
    """Importances of forest models: mean over folds and targets, summed by family."""
    table = image_table(spark, folder)
    models = cross_validation.fit_folds(table, estimators.random_forest(trees=5, depth=4), TARGETS, FOLDS, "combined")
    names = [f"cnn_{i:04d}" for i in range(64)] + list(NUMERIC_METADATA)
    means = metrics.mean_importances(estimators.importances(table, models, names))
    return metrics.family_importances(means, scalars.feature_family("feature", METADATA))
