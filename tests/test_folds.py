"""No row may vanish: folds come from the data, and rows outside the fitted folds are an error."""

import pytest
from pyspark.sql import functions as F

from sward.operators import features, preprocess
from sward.operators.folds import FoldError, checked_folds, list_folds
from sward.plans import ridge, scoring
from sward.plans.cross_validation import fit_folds, predict_folds, ridge_oof

N = 100


@pytest.fixture(scope="module")
def ten(spark):
    x = F.col("id").cast("double")
    return spark.range(N).select(
        F.concat(F.lit("p"), "id").alias("image_path"),
        (F.col("id") % 10).cast("int").alias("fold"),
        x.alias("Pre_GSHH_NDVI"),
        (x * x).alias("Height_Ave_cm"),
        F.lit("a").alias("State"),
        F.lit("b").alias("Species"),
        (3 * x + 1).alias("GDM_g"),
        F.array(x, x * x).alias("v"),
    )


def without_fold(df):
    return df.withColumn("fold", F.when(F.col("image_path") != "p7", F.col("fold")))


def test_ten_folds_keep_every_row(ten):
    assert preprocess.out_of_fold_features(ten).count() == N
    assert ridge_oof(ten, {"N": "Pre_GSHH_NDVI"}, targets=["GDM_g"]).count() == N
    fits = ridge.multi_feature_fits(ten, "v", targets=["GDM_g"])
    assert fits.count() == 10
    assert ridge.score_folds(ten, fits, "v", ["image_path"]).count() == N


def test_a_missing_fold_is_an_error(ten):
    gap = without_fold(ten)
    with pytest.raises(FoldError, match="without fold"):
        preprocess.out_of_fold_features(gap)
    with pytest.raises(FoldError, match="without fold"):
        ridge_oof(gap, {"N": "Pre_GSHH_NDVI"}, targets=["GDM_g"])
    fits = ridge.multi_feature_fits(ten, "v", targets=["GDM_g"])
    with pytest.raises(FoldError, match="without fold"):
        ridge.score_folds(gap, fits, "v", ["image_path"])


def test_rows_of_an_unknown_fold_are_an_error(ten):
    with pytest.raises(FoldError, match="nothing was fitted"):
        preprocess.out_of_fold_features(ten, folds=range(5))
    parameters = preprocess.fit_fold_parameters(ten.where("fold < 5"), categorical=())
    with pytest.raises(FoldError, match="nothing was fitted"):
        preprocess.transform_with(ten, parameters, {})
    with pytest.raises(FoldError, match="nothing was fitted"):
        predict_folds(ten, {(0, "GDM_g"): None}, ["GDM_g"])
    with pytest.raises(FoldError, match="nothing was fitted"):
        fit_folds(ten, None, ["GDM_g"], folds=[0, 1])


def test_new_rows_meet_every_fitted_fold(ten):
    parameters = preprocess.fit_fold_parameters(ten, categorical=())
    assert preprocess.transform_new_rows(ten, parameters, {}).count() == 10 * N
    with pytest.raises(FoldError):
        preprocess.transform_new_rows(ten, parameters, {}, folds=[0, 99])


def test_linear_models_need_parameters_of_every_fold(ten):
    fits = ridge.single_feature_fits(ten, ["Pre_GSHH_NDVI"], targets=["GDM_g"])
    parameters = preprocess.fit_fold_parameters(ten, categorical=())
    assert len(next(iter(scoring.linear_models(fits, parameters).values()))) == 10
    with pytest.raises(FoldError, match="no parameters"):
        scoring.linear_models(fits, parameters.where("fold <> 3"))


def test_fold_lists(ten):
    assert list_folds(ten) == list(range(10))
    assert checked_folds(ten.limit(0)) == []
    with pytest.raises(FoldError):
        list_folds(ten.where("fold = 0"))


def test_only_the_exact_sentinel_leaves_a_column_unfiltered(spark):
    log = spark.createDataFrame([("All Clover", "Vic"), ("Ryegrass", "Tas")], "Species string, State string")
    assert features.filter_optional(log, Species="All Clover").count() == 1
    assert features.filter_optional(log, Species="All Species", State="All States").count() == 2
    assert features.filter_optional(log, State=None).count() == 2
    assert features.filter_optional(log, State="All Species").count() == 0


def test_ridge_keeps_its_digits_far_from_zero(spark):
    """A large offset of features and targets changes intercepts only."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    y = x @ [3.0, -1.0] + rng.normal(size=400) * 0.01
    table = [(i % 4, [float(a) + 1e7, float(b) - 1e7], float(t) + 1e7) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(table, "fold int, v array<double>, GDM_g double").repartition(7)
    fits = ridge.multi_feature_fits(df, "v", targets=["GDM_g"]).collect()
    assert len(fits) == 4
    for fit in fits:
        rows = np.arange(400) % 4 != fit["fold"]
        z, t = x[rows] - x[rows].mean(0), y[rows] - y[rows].mean()
        expected = np.linalg.solve(z.T @ z + np.eye(2), z.T @ t)
        assert fit["coefficients"] == pytest.approx(list(expected), abs=1e-6)


def test_names_with_quotes_and_backticks(ten):
    odd = ten.withColumnRenamed("Pre_GSHH_NDVI", "it's `x`")
    out = ridge_oof(odd, {"f's": "it's `x`"}, {"m\\'s": 1.0}, targets=["GDM_g"])
    assert out.select("model", "feature_set").distinct().collect() == [("m\\'s", "f's")]
    assert out.count() == N


def test_repeated_rows_make_a_matrix_ragged(spark):
    from sward.operators import profile

    table = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 0, 3.0), ("b", 1, 4.0)], "k string, position int, value double")
    whole, double = (profile.matrix_profile(t, "k").first() for t in (table, table.union(table)))
    assert (whole["n_samples"], whole["n_features"], whole["ragged"]) == (2, 2, False)
    assert (double["n_samples"], double["ragged"]) == (2, True)
    assert profile.matrix_profile(table.where("NOT (k = 'b' AND position = 1)"), "k").first()["ragged"]
