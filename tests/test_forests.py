"""Forests of unlimited trees grown in tasks against plain recursion and Spark ML's estimator."""

import os

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from sward.catalog import learning
from sward.operators import metrics
from sward.plans import cross_validation, estimators, forests

TARGETS = ["a", "b"]


def plain(bins, y, w, min_leaf, depth):
    """``(mean,)`` of a leaf or ``(feature, bin, left, right)``, by recursion over all cuts."""
    whole = w.sum()
    mean = (w * y).sum() / whole
    best, split = 0.0, None
    if (w * (y - mean) ** 2).sum() > 1e-12 * max(1.0, (w * y * y).sum()) and depth:
        for f in range(bins.shape[1]):
            for b in range(bins.max() + 1):
                left = bins[:, f] <= b
                n = w[left].sum()
                if n < min_leaf or whole - n < min_leaf:
                    continue
                gain = (w * (y - mean))[left].sum() ** 2 * (1 / n + 1 / (whole - n))
                if gain > best * (1 + 1e-9):
                    best, split = gain, (f, b, left)
    if split is None:
        return (mean,)
    f, b, left = split
    return f, b, *(plain(bins[p], y[p], w[p], min_leaf, depth - 1) for p in (left, ~left))


def walked(pack, at):
    if pack.feature[at] < 0:
        return (pack.value[at],)
    return pack.feature[at], pack.bin[at], walked(pack, pack.left[at]), walked(pack, pack.left[at] + 1)


def same(a, b):
    if len(a) != len(b) or len(a) == 1:
        return len(a) == len(b) and a[0] == pytest.approx(b[0])
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("n, min_leaf, depth, cells, pairs", [(200, 1, 30, 1 << 18, 16), (200, 3, 4, 1 << 18, 16), (150, 1, 30, 500, 4), (60, 1, 30, 1 << 18, 0), (1, 1, 30, 1 << 18, 16)])
def test_packs_equal_plain_recursion(monkeypatch, n, min_leaf, depth, cells, pairs):
    monkeypatch.setattr(forests, "CELLS", cells)
    monkeypatch.setattr(forests, "PAIR_ROWS", pairs)
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 7, (n, 4)).astype(np.uint8), np.round(rng.normal(size=n), 1)
    pack = forests.Pack(bins, y, range(3, 8), 42, 7, min_leaf)
    pack.grow(depth)
    for i, t in enumerate(range(3, 8)):
        w = np.bincount(np.random.default_rng([42, t]).integers(0, n, n), minlength=n)
        assert w.sum() == n
        assert same(plain(bins[w > 0], y[w > 0], w[w > 0].astype(float), min_leaf, depth), walked(pack, i))


def table(spark, n=150):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    rows = [(f"k{i}" if i > 3 else "same", i % 3, x[i].tolist(), float(3 * x[i, 0] + (x[i, 1] > 0)), float(x[i, 2])) for i in range(n)]
    return spark.createDataFrame(rows, "image_path string, fold int, v array<double>, a double, b double").select("*", array_to_vector("v").alias("features")).repartition(3)


def test_unlimited_forests_score_like_spark_ml(spark):
    """Every row is scored once for every target by trees of the other folds, whatever keys repeat."""
    df = table(spark)
    own = estimators.random_forest(20)
    assert isinstance(own(), forests.ForestRegressor) and isinstance(estimators.random_forest(20, 5)(), RandomForestRegressor)
    scored, models = cross_validation.cross_validate(df, own, "Forest", "All", TARGETS, range(3))
    rows = scored.collect()
    assert len(rows) == 300 and sum(r["image_path"] == "same" for r in rows) == 8
    assert sorted((r["fold"], r["a"]) for r in df.collect()) == sorted((r["fold"], r["y"]) for r in rows if r["target"] == "a")
    ml = lambda: RandomForestRegressor(numTrees=20, maxDepth=30, featureSubsetStrategy="all", seed=42)
    theirs, others = cross_validation.cross_validate(df, ml, "Forest", "All", TARGETS, range(3))
    r2 = [{(r["fold"], r["target"]): r["R2"] for r in metrics.fold_metrics(p).collect()} for p in (scored, theirs)]
    assert all(abs(r2[0][job] - r2[1][job]) < 0.1 for job in r2[0]) and len(r2[0]) == 6
    for job, model in models.items():
        assert model.featureImportances.toArray() == pytest.approx(others[job].featureImportances.toArray(), abs=0.05)
    again, _ = cross_validation.cross_validate(df.repartition(5), own, "Forest", "All", TARGETS, range(3))
    assert sorted((r["y"], round(r["pred"], 9)) for r in rows) == sorted((r["y"], round(r["pred"], 9)) for r in again.collect())


def test_a_model_adds_its_column_to_any_rows(spark):
    df = table(spark, 60)
    model = estimators.random_forest(10)().setLabelCol("a").setPredictionCol("pred").fit(df)
    out = model.transform(df.drop("a", "fold"))
    assert out.columns == ["image_path", "v", "b", "features", "pred"] and out.count() == 60
    assert out.where("pred IS NULL").count() == 0


def test_trees_are_as_deep_and_as_many_as_asked(spark):
    """Rows of different targets end in leaves of their own: depth 3 would leave 8."""
    [model] = estimators.random_forest(7)().fit_targets(table(spark, 90), ["a"]).values()
    packs = model.packs.collect()
    assert sum(r["trees"] for r in packs) == 7
    leaves = [(np.frombuffer(r["feature"], np.int16) < 0).sum() / r["trees"] for r in packs]
    assert min(leaves) > 40


def test_training_rows_beyond_a_task_go_to_spark_ml(spark, monkeypatch):
    monkeypatch.setattr(forests, "FOREST_BYTES", 100)
    df = table(spark, 60)
    scored, models = cross_validation.cross_validate(df, estimators.random_forest(3, 11), "Forest", "All", TARGETS, range(3))
    assert all(isinstance(m, RandomForestRegressionModel) and m.getNumTrees == 3 for m in models.values())
    assert scored.count() == 120


def test_odd_rows(spark):
    df = table(spark, 30)
    forest = estimators.random_forest(2)
    with pytest.raises(Exception, match="gaps"):
        cross_validation.fit_folds(df.withColumn("a", F.when(F.col("b") > 0, F.col("a"))), forest, TARGETS, range(3))
    with pytest.raises(Exception, match="no training rows"):
        forest().setLabelCol("a").fit(df.where("fold = 9"))
    models = cross_validation.fit_folds(df, forest, TARGETS, range(3))
    with pytest.raises(Exception, match="(?i)fold"):
        cross_validation.predict_folds(df.withColumn("fold", F.lit(7)), models, TARGETS).collect()
    constant = forest().setLabelCol("a").setPredictionCol("pred").fit(df.withColumn("a", F.lit(2.0))).transform(df)
    assert {r["pred"] for r in constant.collect()} == {2.0}


def published(factory):
    chosen = factory()
    return [chosen.getOrDefault(c) for c in ("numTrees", "maxDepth", "minInstancesPerNode")] == [300, 30, 1]


def test_k9_grid_has_the_published_forest(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(learning, "image_table", lambda spark, folder: None)
    monkeypatch.setattr(cross_validation, "experiment_grid", lambda table, factories, *args: asked.append(factories) or {}[None])
    with pytest.raises(KeyError):
        learning.k9_experiment_grid(spark, "")
    assert set(asked[0]) == {"Forest", "Linear"} and published(asked[0]["Forest"])


def test_k9_ledger_has_the_published_forest(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(learning, "image_table", lambda spark, folder: None)
    monkeypatch.setattr(cross_validation, "restartable_grid", lambda table, factories, *args: asked.append(factories) or {}[None])
    with pytest.raises(KeyError):
        learning.ledger_run(spark, "")
    assert set(asked[0]) == {"Forest", "Linear"} and published(asked[0]["Forest"])


def test_a_ledger_of_forests_keeps_predictions_and_no_trees(spark, tmp_path):
    df = table(spark, 60)
    run = lambda: cross_validation.restartable_grid(df, {"Forest": estimators.random_forest(3)}, {"All": "features"}, str(tmp_path / "ledger"), TARGETS, range(3))
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {name for name in os.listdir(shared) if name.startswith("forest-")}
    predictions, runtimes = run()
    assert predictions.count() == 120 and runtimes.count() == 3
    assert {name for name in os.listdir(shared) if name.startswith("forest-")} == before
    direct, _ = cross_validation.cross_validate(df, estimators.random_forest(3), "Forest", "All", TARGETS, range(3))
    assert sorted((r["y"], round(r["pred"], 9)) for r in predictions.collect()) == sorted((r["y"], round(r["pred"], 9)) for r in direct.collect())
    assert run()[0].count() == 120


def test_large_forests_have_more_parts_and_the_same_predictions(spark, monkeypatch):
    df = table(spark, 60)
    seen = []
    for limit in (64 << 20, 20 * 40 * 3):
        monkeypatch.setattr(forests, "PART_BYTES", limit)
        scored, models = cross_validation.cross_validate(df, estimators.random_forest(60), "Forest", "All", TARGETS, range(3))
        assert {m.parts for m in models.values()} == {8 if limit > 1 << 20 else 20}
        seen.append(sorted((r["y"], round(r["pred"], 9)) for r in scored.collect()))
    assert seen[0] == seen[1]
