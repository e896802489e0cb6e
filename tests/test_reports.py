import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sward.operators import ensemble, joins, metrics, profile, quality, ranking
from sward.operators.bounded import held, small_side
from sward.operators.quantiles import exact_quantiles

NAN = float("nan")


def predictions(spark, data):
    return spark.createDataFrame(data, "model string, feature_set string, fold int, image_path string, target string, y double, pred double")


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("a", 5.0, 2.0)], "target string, y double, pred double")
    got = rows(metrics.regression_metrics(df))[0]
    assert got["MAE"] == pytest.approx(4 / 3) and got["RMSE"] == pytest.approx(math.sqrt(10 / 3)) and got["R2"] == pytest.approx(1 - 10 / 8)


def test_r2_of_a_constant_target(spark):
    df = spark.createDataFrame([("hit", 2.0, 2.0), ("hit", 2.0, 2.0), ("miss", 2.0, 1.0), ("miss", 2.0, 2.0)], "target string, y double, pred double")
    assert [r["R2"] for r in rows(metrics.regression_metrics(df), "target")] == [1.0, 0.0]


def test_missing_prediction_is_an_error(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "target string, y double, pred double")
    with pytest.raises(Exception, match="missing values"):
        metrics.regression_metrics(df).collect()


def test_summary_uses_sample_deviation_and_is_null_for_one_fold(spark):
    data = [("m", "f", k, "t", float(k), float(k), 0.5) for k in (1, 3)] + [("m", "g", 0, "t", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "model string, feature_set string, fold int, target string, MAE double, RMSE double, R2 double")
    first, second = rows(metrics.cv_summary(df), "feature_set")
    assert first["MAE_std"] == pytest.approx(math.sqrt(2)) and second["MAE_std"] is None


def test_pooled_and_fold_mean_errors_differ(spark):
    data = [("m", "f", 0, "a", "t", 0.0, 4.0), ("m", "f", 1, "b", "t", 0.0, 0.0), ("m", "f", 1, "c", "t", 1.0, 1.0)]
    df = predictions(spark, data)
    pooled = rows(metrics.pooled_metrics(df))[0]["OOF_RMSE"]
    per_fold = rows(metrics.cv_summary(metrics.fold_metrics(df)))[0]["RMSE_mean"]
    assert pooled == pytest.approx(math.sqrt(16 / 3)) and per_fold == pytest.approx(2.0)


def test_widen_targets_refuses_duplicates_and_fills(spark):
    df = spark.createDataFrame([("a", "Dry_Clover_g", 1.0), ("b", "GDM_g", 2.0)], "image_path string, target_name string, target double")
    wide = rows(metrics.widen_targets(df, missing=0.0), "image_path")
    assert wide[0]["Dry_Clover_g"] == 1.0 and wide[0]["GDM_g"] == 0.0
    with pytest.raises(Exception, match="more than one"):
        metrics.widen_targets(df.unionByName(df)).collect()


def test_ranking_ties_are_ordered_by_name(spark):
    df = spark.createDataFrame([("b", "x", 1.0, 2.0, 0.0), ("a", "x", 1.0, 2.0, 0.0), ("c", "x", 0.5, 2.0, 0.0)], "model string, feature_set string, mean_MAE double, mean_RMSE double, mean_R2 double")
    assert [r["model"] for r in rows(ranking.rank_configurations(df), "rank")] == ["c", "a", "b"]


def test_first_per_key_keeps_nulls_of_the_first_row(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, None), ("l", 5, "x")], "key string, ord int, v string")
    assert [(r["key"], r["v"]) for r in rows(ranking.first_per_key(df, ["key"], ["ord"]), "key")] == [("k", None), ("l", "x")]


def test_first_per_key_with_a_hot_key(spark):
    hot = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), (100_000 - F.col("id")).alias("ord"))
    got = ranking.first_per_key(hot, ["key"], ["ord"]).where("key = -1").first()
    assert got["ord"] == 1


def test_diverse_sample_prefers_new_kinds(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a"), (5, "c")], "ord int, kind string")
    assert [r["ord"] for r in ranking.diverse_sample(df, "kind", "ord", 4).collect()] == [1, 3, 5, 2]
    assert [r["ord"] for r in ranking.diverse_sample(df, "kind", "ord", 2).collect()] == [1, 3]
    assert len(ranking.diverse_sample(df, "kind", "ord", 50).collect()) == 5


def test_trend_needs_two_points(spark):
    df = spark.createDataFrame([(1, 2.0)], "ts int, v double")
    assert ranking.trend(df, "ts", ["v"]).count() == 0
    assert ranking.trend(df.unionByName(df), "ts", ["v"]).count() == 2


def test_stable_index_is_the_position_in_key_order(spark):
    df = spark.range(2000).select(F.format_string("k%05d", F.pmod(F.col("id") * 7919, F.lit(2000))).alias("key"))
    got = rows(ranking.with_stable_index(df, "key", parts=5), "key")
    assert [r["feature_index"] for r in got] == list(range(2000))


@pytest.mark.parametrize("values", ["uniform", "hot", "two", "one"])
def test_exact_quantiles_equal_numpy(spark, values):
    rng = np.random.default_rng(3)
    data = {
        "uniform": rng.normal(size=5001) * 1e3,
        "hot": np.where(rng.random(6000) < 0.5, 7.0, rng.random(6000) * 20),
        "two": np.array([1.0, 4.0]),
        "one": np.array([3.0]),
    }[values]
    df = spark.createDataFrame([("g", float(v)) for v in data] + [("g", NAN), ("g", None), ("other", 1.0)], "k string, v double")
    probs = [0.0, 0.02, 0.25, 0.5, 0.98, 1.0]
    got = {r["prob"]: r["quantile"] for r in rows(exact_quantiles(df, "v", probs, ["k"]).where("k = 'g'"))}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(data, p), rel=1e-12)


@pytest.mark.parametrize("size", [8, 200])
def test_narrowed_brackets_stay_exact(spark, size):
    """Many rounds with coarse sketches, ties and a hot value; brackets that miss their rank are not taken."""
    rng = np.random.default_rng(8)
    data = {"a": rng.normal(size=20_000), "b": np.where(rng.random(9000) < 0.6, 5.0, rng.random(9000) * 10), "c": np.full(3000, 2.0)}
    df = spark.createDataFrame([(k, float(v)) for k, values in data.items() for v in values], "k string, v double").repartition(6)
    for r in rows(exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.99], ["k"], few=100, size=size)):
        assert r["quantile"] == pytest.approx(np.quantile(data[r["k"]], r["prob"]), rel=1e-12)


@pytest.mark.parametrize("few", [50, 10**6])
def test_quantiles_of_training_sets(spark, few):
    rng = np.random.default_rng(1)
    data = [(int(f), float(v)) for f, v in zip(rng.integers(0, 3, 2000), rng.normal(size=2000))]
    df = spark.createDataFrame(data, "fold int, v double")
    others = F.array_compact(F.array(*[F.when(F.col("fold") != k, k) for k in range(3)]))
    for r in rows(exact_quantiles(df, "v", [0.25, 0.5], ["fold"], spread=("fold", others), few=few)):
        assert r["quantile"] == pytest.approx(np.quantile([v for f, v in data if f != r["fold"]], r["prob"]), rel=1e-12)


def test_small_tables_are_checked(spark):
    large = held(spark.range(6), 5)
    assert large.count() == 6 and "broadcast" not in spark.range(3).join(large, on="id")._jdf.queryExecution().analyzed().toString().lower()
    with pytest.raises(Exception, match="more than 5"):
        spark.range(3).join(small_side(spark.range(6), 5), on="id").collect()
    assert held(spark.range(5), 5).count() == 5


def test_profile_counts_odd_values(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, NAN), ("b", 0, -3.0), ("b", 1, float("inf"))], "k string, position int, value double")
    got = rows(profile.matrix_profile(df, "k"))[0]
    assert (got["n_samples"], got["n_features"], got["nan_count"], got["inf_count"], got["negative_count"], got["ragged"]) == (2, 2, 1, 1, 1, False)
    assert got["feature_mean"] == pytest.approx(-1.0) and got["feature_std"] == pytest.approx(2.0)


def test_histogram_matches_numpy_and_handles_one_value(spark):
    values = np.random.default_rng(0).normal(size=1000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = rows(profile.histogram(df, "v", 10), "bin")
    assert sorted((r["bin"], r["n"]) for r in got) == [(i + 1, int(n)) for i, n in enumerate(np.histogram(values, 10)[0])]
    flat = profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 4)
    assert sorted((r["bin"], r["n"]) for r in rows(flat)) == [(i + 1, int(n)) for i, n in enumerate(np.histogram([2.0, 2.0], 4)[0])]


def test_blend_search_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    y, a, b = rng.random((3, 60))
    df = spark.createDataFrame([(f"k{i}", f"t{i % 3}", float(y[i]), float(a[i]), float(b[i])) for i in range(60)], "image_path string, target string, y double, a double, b double")
    got = {round(r["weight_a"], 2): r["mean_rmse"] for r in rows(ensemble.blend_search(df))}
    for w in np.linspace(0, 1, 21):
        p = w * a + (1 - w) * b
        expected = np.mean([np.sqrt(np.mean((y - p)[np.arange(60) % 3 == t] ** 2)) for t in range(3)])
        assert got[round(float(w), 2)] == pytest.approx(expected)
    best = rows(ensemble.best_blend(ensemble.blend_search(df)))[0]
    assert best["mean_rmse"] == pytest.approx(min(got.values()))


def test_fold_mean_clips_before_and_refuses_gaps(spark):
    df = spark.createDataFrame([("a", "t", -4.0), ("a", "t", 2.0)], "image_path string, target string, pred double")
    assert rows(ensemble.fold_mean(df, 2))[0]["pred"] == 1.0
    gap = spark.createDataFrame([("a", "t", NAN)], "image_path string, target string, pred double")
    with pytest.raises(Exception, match="no prediction"):
        ensemble.fold_mean(gap, 1).collect()
    with pytest.raises(Exception, match="no prediction"):
        ensemble.fold_mean(df, 3).collect()
    with_folds = df.withColumn("fold", F.monotonically_increasing_id())
    assert rows(ensemble.fold_mean(with_folds))[0]["pred"] == 1.0


def test_pairs_must_align(spark):
    schema = "image_path string, target string, y double, pred double"
    first = spark.createDataFrame([("a", "t", 1.0, 2.0), ("b", "t", 3.0, 4.0)], schema)
    second = spark.createDataFrame([("b", "t", 3.0, 5.0), ("a", "t", 1.0, 6.0)], schema)
    assert [(r["y"], r["a"], r["b"]) for r in rows(ensemble.paired(first, second), "image_path")] == [(1.0, 2.0, 6.0), (3.0, 4.0, 5.0)]
    for other in (second.limit(1), second.unionByName(second.limit(1))):
        with pytest.raises(Exception, match="do not align"):
            ensemble.paired(first, other).collect()


def test_parity_tolerance(spark):
    df = spark.createDataFrame([(1.0, 1.0), (100.0, 100.0009)], "a double, b double")
    assert rows(ensemble.parity(df))[0]["within_tolerance"] is True
    assert rows(ensemble.parity(df.unionByName(spark.createDataFrame([(1.0, 2.0)], "a double, b double"))))[0]["within_tolerance"] is False


def test_joins_refuse_duplicates_and_mismatches(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "image_path string, l int")
    right = spark.createDataFrame([("a", 3)], "image_path string, r int")
    assert rows(joins.one_to_one(left, right), "image_path")[1] == {"image_path": "b", "l": 2, "r": None}
    with pytest.raises(joins.AlignmentError):
        joins.one_to_one(left, right.unionByName(right))
    with pytest.raises(joins.AlignmentError):
        joins.align(left, right, ["image_path"])
    assert [r["image_path"] for r in rows(joins.missing_rows(left, right, ["image_path"]))] == ["b"]


def test_rules_pass_and_fail(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None), ("b", 1, NAN)], "image_path string, fold int, v double")
    assert {r["column"]: r["n_missing"] for r in rows(quality.null_counts(df, ["image_path", "v"]))} == {"image_path": 0, "v": 2, "total": 2}
    assert rows(quality.duplicate_count(df, ["image_path"]))[0]["actual"] == 1
    assert all(r["status"] == "PASS" for r in rows(quality.fold_labels(df, 2)))
    report = quality.integrity_report(quality.row_count(df, 4), quality.row_count(df, 3))
    assert rows(quality.overall_status(report))[0] == {"checks": 2, "failed": 1, "status": "FAIL"}
    with pytest.raises(ValueError, match="row_count"):
        quality.require_pass(report)


def test_coverage_and_difference(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    predicted = spark.createDataFrame([("a",), ("a",), ("d",)], "k string")
    got = {r["check"]: r["actual"] for r in rows(quality.prediction_coverage(keys, predicted, ["k"]))}
    assert got == {"rows_without_prediction": 2, "rows_predicted_twice": 1, "predictions_without_row": 1}
    difference = {r["k"]: r["surplus"] for r in rows(quality.table_difference(keys, predicted))}
    assert difference == {"a": -1, "b": 1, "c": 1, "d": -1}
    assert quality.table_difference(keys, keys).count() == 0


def test_same_feature_names(spark):
    names = spark.createDataFrame([(0, "a"), (1, "a"), (0, "b")], "fold int, feature string")
    assert rows(quality.same_feature_names(names))[0]["status"] == "FAIL"


def test_listed_combinations_are_counted_in_one_row_per_key(spark):
    """The shuffle has the key alone, and unlisted, absent and repeated values count as they do by all keys."""
    kind = "k string, target string, model string"
    expected = [(k, t, m) for k in ("a", "b", None) for t in ("x", "y") for m in ("p", "q")] + [("a", "z", "p"), ("b", None, "q"), ("c", "z", "z")]
    predicted = expected[:9] + [("a", "x", "p"), ("a", "z", "p"), ("a", "z", "p"), ("none", "x", "p"), (None, None, None), ("c", "z", "p")]
    tables = [spark.createDataFrame(v, kind) for v in (expected, predicted)]
    plain = rows(quality.prediction_coverage(*tables, ["k", "target", "model"]), "check")
    listed = quality.prediction_coverage(*tables, ["k", "target", "model"], {"target": ["x", "y"], "model": ["p", "q"]})
    assert rows(listed, "check") == plain
    assert {r["check"]: r["actual"] for r in plain} == {"rows_without_prediction": 5, "rows_predicted_twice": 2, "predictions_without_row": 3}
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key_0" in plan and "hashpartitioning(k#" not in plan
    empty = quality.prediction_coverage(*[t.limit(0) for t in tables], ["k", "target", "model"], {"target": ["x"], "model": ["p"]})
    assert all(r["actual"] == 0 for r in empty.collect())


def test_both_predictions_of_a_row_are_paired_without_a_shuffle(spark, small, monkeypatch):
    from sward.catalog import base

    def by_key(long):
        of = lambda name: F.max(F.when(F.col("feature_set") == name, F.col("pred")))
        return long.groupBy("image_path", "target").agg(F.max("y").alias("y"), of("NDVI").alias("a"), of("Height").alias("b"))

    chosen = [("Ridge", "NDVI"), ("Ridge", "Height")]
    order = "image_path", "target"
    pairs = base.two_predictions(spark, small)
    assert "hashpartitioning" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert rows(pairs, *order) == rows(by_key(base.oof(spark, small, chosen)), *order)
    whole = base.design(spark, small)
    twice = whole.unionByName(whole.limit(5).withColumn("Height_Ave_cm", F.col("Height_Ave_cm") + 1))
    monkeypatch.setattr(base, "design", lambda spark, folder: twice)
    rounded = lambda df: rows(base.rounded(df, 9), *order)
    assert rounded(base.two_predictions(spark, small)) == rounded(by_key(base.oof(spark, small, chosen)))
