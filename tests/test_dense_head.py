"""The two-layer head: gradients against differences, the rules of its history, restarts, and a signal no line can fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sward.plans import dense_head
from sward.plans.dense_head import Head
from sward.session import work_path

TARGETS = ["a", "b"]


def table(spark, n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, size=(n, 3))
    y = np.column_stack([4 * np.abs(x[:, 0]) + x[:, 1] ** 2, 3 * (x[:, 0] * x[:, 1] > 0)])
    rows = [(f"k{i}", i % 3, x[i].tolist(), *map(float, y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "image_path string, fold int, v array<double>, a double, b double")


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(9, 4)), rng.normal(size=(9, 2)) * 3
    flat, keep = dense_head.first_weights(4, 5, 2, 3) + 0.01, rng.integers(0, 2, size=(9, 5)) * 2.0

    def loss(w):
        w1, b1, w2, b2 = dense_head.unpacked(w, 4, 5, 2)
        return dense_head.huber(np.maximum(x @ w1 + b1, 0) * keep @ w2 + b2 - y, 1.0).sum() / 2

    found = dense_head.gradient(flat, x, y, keep, 5, 1.0)
    assert found[-2:] == pytest.approx([9, loss(flat)])
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        assert found[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-5)


def test_dropout_depends_on_rows_and_keeps_the_mean():
    rows = np.random.default_rng(3).integers(0, 1 << 63, 2000).astype(np.uint64)
    keep = dense_head.kept_units(rows, 16, Head(), 5)
    assert set(np.unique(keep)) == {0.0, 1 / 0.7} and abs(keep.mean() - 1) < 0.02
    assert (dense_head.kept_units(rows[10:20], 16, Head(), 5) == keep[10:20]).all()


def test_history_rules():
    losses = [5, 4, 4.5, 4.2, 3.9, 3.99995, 3.95, 3.96]
    settings = Head(rate=1.0, patience=3, halve_after=2)
    states = [dense_head.decide([(i, 0.0, loss, 0.0) for i, loss in enumerate(losses[:n])], settings) for n in range(1, len(losses) + 1)]
    assert [s[0] for s in states] == [1, 1, 1, 0.5, 0.5, 0.5, 0.25, 0.25]
    assert [s[1] for s in states] == [False] * 7 + [True]
    assert [s[2] for s in states] == [0, 1, 1, 1, 4, 4, 4, 4]


def test_head_fits_what_no_line_fits_and_goes_on_where_it_stopped(spark):
    df, store = table(spark).repartition(3), work_path(spark, "head")
    settings = Head(hidden=32, epochs=40, rounds=3, rate=0.03, patience=40, halve_after=40, dropout=0.0)
    whole = dense_head.fit_heads(df, "v", TARGETS, settings)
    scored = whole.predict(df, "v").groupBy("target").agg((1 - F.sum((F.col("y") - F.col("pred")) ** 2) / (F.count("*") * F.var_pop("y"))).alias("r2"))
    # Both signals are even in every feature, so the best line explains next to nothing.
    assert all(r["r2"] > 0.5 for r in scored.collect())
    history = whole.history(spark)
    assert history.count() == 3 * 40
    best = history.groupBy("fold").agg(F.min_by("epoch", F.struct("val_loss", "epoch")).alias("best"), F.min("val_loss").alias("least"))
    measured = {r["fold"]: r for r in best.collect()}
    for fold, state in whole.folds.items():
        own = [(r["y"], r["pred"]) for r in whole.predict(df, "v").where(F.col("fold") == fold).collect()]
        assert dense_head.huber(np.array([p - y for y, p in own]), 1.0).mean() == pytest.approx(measured[fold]["least"])

    short = Head(**{**settings.__dict__, "epochs": 12})
    dense_head.fit_heads(df, "v", TARGETS, short, store=store)
    assert spark.read.parquet(store).count() == 36
    later = dense_head.fit_heads(df.repartition(5), "v", TARGETS, settings, store=store)
    assert spark.read.parquet(store).count() == 120
    for fold in whole.folds:
        assert [h[2] for h in later.folds[fold].history] == pytest.approx([h[2] for h in whole.folds[fold].history], rel=1e-6)
    again = dense_head.fit_heads(df, "v", TARGETS, settings, store=store)
    assert spark.read.parquet(store).count() == 120
    assert all((again.folds[f].best == later.folds[f].best).all() for f in whole.folds)


def test_odd_tables(spark):
    df = table(spark, 30)
    with pytest.raises(Exception, match="gaps"):
        dense_head.fit_heads(df.withColumn("a", F.lit(None).cast("double")), "v", TARGETS, Head(epochs=1, rounds=1))
    fitted = dense_head.fit_heads(df, "v", TARGETS, Head(hidden=4, epochs=1, rounds=1))
    with pytest.raises(Exception, match="no head for fold"):
        fitted.predict(df.withColumn("fold", F.lit(9)), "v").collect()
    stopped = dense_head.fit_heads(df, "v", TARGETS, Head(hidden=4, epochs=9, rounds=1, rate=0.0, least_rate=0.0, patience=2))
    assert stopped.history(spark).count() == 3 * 3
