import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from sward.constants import TARGETS
from sward.operators import metrics, quality
from sward.plans import cross_validation, estimators, ridge, scoring
from sward.sources import models as model_store

T = list(TARGETS[:2])


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 4)) + [0, 5, -3, 100]
    y = np.stack([x @ [2, 0, 1, 0] + 30, x @ [0, -1, 0, 0.5] + 10], axis=1) + rng.normal(size=(300, 2)) * 0.1
    return x, y, np.arange(300) % 3


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, fold = data
    found = [(f"k{i}", int(fold[i]), [float(v) for v in x[i]], float(x[i, 0]), *map(float, y[i])) for i in range(300)]
    df = spark.createDataFrame(found, f"image_path string, fold int, x array<double>, x0 double, {T[0]} double, {T[1]} double")
    return df.withColumn("features", array_to_vector("x")).cache()


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean(0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean(0) - x.mean(0) @ w


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_from_product_sums(table, data, alpha):
    x, y, fold = data
    got = {(r["fold"], r["target"]): r for r in rows(ridge.multi_feature_fits(table.repartition(5), "x", alpha, T, range(3)))}
    assert len(got) == 6
    for k in range(3):
        w, b = closed_form(x[fold != k], y[fold != k], alpha)
        for i, t in enumerate(T):
            assert got[k, t]["coefficients"] == pytest.approx(w[:, i], rel=1e-8)
            assert got[k, t]["intercept"] == pytest.approx(b[i], rel=1e-8)


def test_ml_ridge_equals_the_closed_form(table, data):
    x, y, fold = data
    models = cross_validation.fit_folds(table, None, T, range(3), per_job=estimators.ridge_per_fold(table, T, 5.0))
    for k in range(3):
        w, b = closed_form(x[fold != k], y[fold != k], 5.0)
        for i, t in enumerate(T):
            assert models[k, t].coefficients.toArray() == pytest.approx(w[:, i], rel=1e-7)
            assert models[k, t].intercept == pytest.approx(b[i], rel=1e-6)


def test_one_feature_ridge_and_coverage(table, data):
    x, y, fold = data
    oof = cross_validation.ridge_oof(table, {"first": "x0"}, {"Ridge": 2.0}, T, range(3), clip=False)
    got = {(r["image_path"], r["target"]): r["pred"] for r in rows(oof)}
    assert len(got) == 600
    for k in range(3):
        w, b = closed_form(x[fold != k][:, :1], y[fold != k], 2.0)
        i = int(np.flatnonzero(fold == k)[0])
        assert got[f"k{i}", T[1]] == pytest.approx(x[i, 0] * w[0, 1] + b[1])
    report = quality.prediction_coverage(table, oof.where(F.col("target") == T[0]), ["image_path"])
    assert {r["status"] for r in rows(report)} == {"PASS"}


def test_models_beat_the_mean_on_a_planted_signal(table):
    for factory in (estimators.random_forest(10, 6), estimators.extra_trees(10, 6), estimators.boosting(3, maxIter=10), estimators.stochastic_boosting(3, maxIter=10), estimators.huber_head(50)):
        predictions, _ = cross_validation.cross_validate(table, factory, "m", "f", T[:1], range(3))
        assert rows(metrics.regression_metrics(predictions))[0]["R2"] > 0.4
        assert predictions.count() == 300


def test_extra_trees_differ_from_each_other(table):
    model = estimators.extra_trees(5, 5)().setLabelCol(T[0]).fit(table)
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) > 1


def test_grid_history_and_importances(table):
    predictions, seconds = cross_validation.experiment_grid(
        table, {"Linear": lambda: LinearRegression(solver="normal")}, {"All": "features"}, T, range(3)
    )
    assert predictions.count() == 600 and len(seconds) == 1 and seconds[0][2] > 0
    models = cross_validation.fit_folds(table, estimators.huber_head(5), T[:1], range(3))
    history = rows(estimators.training_history(table, models), "fold", "iteration")
    assert {r["fold"] for r in history} == {0, 1, 2} and history[0]["loss"] > history[5]["loss"]
    forest = cross_validation.fit_folds(table, estimators.random_forest(3, 4), T[:1], range(3))
    weights = rows(metrics.mean_importances(estimators.importances(table, forest, list("abcd"))))
    assert sum(r["importance"] for r in weights) == pytest.approx(1.0) and len(weights) == 4


def test_stored_models_score_the_same(spark, table, tmp_path):
    models = cross_validation.fit_folds(table, lambda: LinearRegression(solver="normal"), T, range(3))
    model_store.save_models(models, str(tmp_path), "Linear", "All")
    loaded = model_store.load_models(spark, str(tmp_path), "Linear", "All", range(3), T)
    first, second = (rows(scoring.ensemble_predict(table, m, T), "image_path") for m in (models, loaded))
    assert first == second
    with pytest.raises(Exception):
        model_store.load_models(spark, str(tmp_path), "Linear", "Other", [0], T)


def test_ensemble_is_the_mean_of_clipped_predictions(table):
    models = cross_validation.fit_folds(table, lambda: LinearRegression(solver="normal"), T, range(3))
    shifted = table.withColumn("features", array_to_vector(F.transform("x", lambda v: v - 20)))
    got = {r["image_path"]: r[T[0]] for r in rows(scoring.ensemble_predict(shifted, models, T))}
    row = shifted.orderBy("image_path").first()
    each = [max(models[k, T[0]].predict(row["features"]), 0.0) for k in range(3)]
    assert got[row["image_path"]] == pytest.approx(np.mean(each))


def test_embedding_in_batches(table, data):
    weights = np.random.default_rng(0).normal(size=(4, 3))
    got = {r["image_path"]: r["e"] for r in rows(table.select("image_path", scoring.embed("x", scoring.linear_map(weights), 4, batch_size=7).alias("e")))}
    for i in (0, 123, 299):
        assert got[f"k{i}"] == pytest.approx(data[0][i] @ weights, rel=1e-5)


def test_restartable_grid_fits_only_what_its_ledger_lacks(spark):

    from sward.session import work_path

    rows = [(f"i{i}", i % 3, float(i % 7), float(i % 5), 2.0 * (i % 7) + i % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "image_path string, fold int, p double, q double, t double")
    df = df.select("image_path", "fold", "t", array_to_vector(F.array("p")).alias("one"), array_to_vector(F.array("p", "q")).alias("both")).cache()
    fits = []

    def line(penalty):
        def build():
            fits.append(penalty)
            return LinearRegression(regParam=penalty, solver="normal")

        return build

    ledger, sets = work_path(spark, "ledger"), {"One": "one", "Both": "both"}
    run = lambda models, data="": cross_validation.restartable_grid(df, models, sets, ledger, ["t"], data=data)
    predictions, runtimes = run({"A": line(0.1)})
    assert predictions.count() == 120 and runtimes.count() == 6 and runtimes.where("seconds <= 0").count() == 0
    # Every factory is asked for its settings once per entry, and once more for a fit.
    assert len(fits) == 12
    direct, _ = cross_validation.experiment_grid(df, {"A": line(0.1)}, sets, ["t"])
    key = ("model", "feature_set", "fold", "image_path", "target", "y", "pred")
    assert predictions.select(*key).exceptAll(direct.select(*key)).count() == 0
    fits.clear()
    again, later = run({"A": line(0.1)})
    assert len(fits) == 6 and again.count() == 120
    assert sorted(map(str, later.collect())) == sorted(map(str, runtimes.collect()))
    fits.clear()
    run({"A": line(0.1), "B": line(0.5)})
    assert len(fits) == 12 + 6
    fits.clear()
    run({"A": line(0.1)}, "newer rows")
    assert len(fits) == 12
    # A run that dies after some entries leaves them whole.
    broken = work_path(spark, "ledger")

    def failing():
        if len(fits) > 15:
            raise RuntimeError("lost")
        return line(0.9)()

    with pytest.raises(RuntimeError):
        cross_validation.restartable_grid(df, {"C": failing}, sets, broken, ["t"], parallelism=1)
    left = cross_validation.read_ledger(spark, broken).count()
    fits.clear()
    cross_validation.restartable_grid(df, {"C": line(0.9)}, sets, broken, ["t"])
    assert len(fits) == 6 + 6 - left


def test_image_table_makes_the_design_rows_of_embedded_images_only(spark, tmp_path):
    """Orders without an embedding count for the statistics, but no design table of them is written for the fits."""
    from sward.catalog import base, learning
    from sward.session import is_stored

    folder = str(tmp_path)
    made = {
        "nation": [(0, "N0"), (1, "N1")],
        "customer": [(c, c % 2, None if c == 4 else c * 1.5, "M") for c in range(1, 11)],
        "orders": [(o, o % 10 + 1, o * 10.0) for o in range(1, 61)] + [(7, 3, 5.0)],
        "lineitem": [(o, "ANR"[o % 3], float(i + o)) for o in range(1, 61) if o != 12 for i in range(2)] + [(99, "A", 1.0), (3, None, None)],
        "embeddings": [(v, [float(v), 1.0], 0) for v in [*range(5, 20), 6, 99]] + [(None, [0.0, 0.0], 1)],
    }
    kinds = {
        "nation": "n_nationkey int, n_name string",
        "customer": "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string",
        "orders": "o_orderkey long, o_custkey long, o_totalprice double",
        "lineitem": "l_orderkey long, l_returnflag string, l_quantity double",
        "embeddings": "vec_id long, embedding array<float>, label int",
    }
    for name, rows in made.items():
        spark.createDataFrame(rows, kinds[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    def rounded(table):
        return sorted(str([round(v, 9) if isinstance(v, float) else [round(float(x), 9) for x in v] if hasattr(v, "toArray") else v for v in r]) for r in table.collect())

    alone = rounded(learning.image_table(spark, folder))
    assert not is_stored(spark, f"{folder}/design")
    embedded = base.views.embeddings(spark, folder).select("image_path")
    design = base.design(spark, folder).join(embedded, on="image_path")
    assert is_stored(spark, f"{folder}/design") and design.count() == len(alone) > 15
    # With the design table there, the image table reads it; a new file makes both outdated.
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{folder}/other.parquet")
    assert not is_stored(spark, f"{folder}/design")
    base.design(spark, folder)
    assert rounded(learning.image_table(spark, folder)) == alone
