import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sward.operators import features, preprocess
from sward.sources import tables

NAN = float("nan")
META = "image_path string, fold int, State string, Species string, Pre_GSHH_NDVI double, Height_Ave_cm double"


@pytest.fixture(scope="module")
def metadata(spark):
    return spark.createDataFrame(
        [
            ("a", 0, "NSW", "Clover", 0.1, 4.0),
            ("b", 0, "Tas", None, None, 4.0),
            ("c", 1, "Tas", "Clover", 0.5, 4.0),
            ("d", 1, None, "Fescue", NAN, 4.0),
            ("e", 2, "WA", "Fescue", 0.9, None),
        ],
        META,
    )


def expected_features(metadata, numeric):
    """The transform written with NumPy, fold by fold."""
    table = metadata.toPandas()
    out = {}
    for k in sorted(table.fold.unique()):
        train, valid = table[table.fold != k], table[table.fold == k]
        for c in numeric:
            median = train[c].median()
            filled = train[c].fillna(median)
            std = filled.std(ddof=0) or 1.0
            for key, v in zip(valid.image_path, valid[c].fillna(median)):
                out[key, c] = (v - filled.mean()) / std
    return out


def test_out_of_fold_features(spark, metadata):
    got = rows(preprocess.out_of_fold_features(metadata, folds=[0, 1, 2]), "image_path")
    numeric = ["Pre_GSHH_NDVI", "Height_Ave_cm"]
    expected = expected_features(metadata, numeric)
    assert [r["image_path"] for r in got] == list("abcde")
    for r in got:
        for c in numeric:
            assert r[c] == pytest.approx(expected[r["image_path"], c])
    assert list(got[0])[2:] == [*numeric, "State_NSW", "State_Tas", "State_WA", "Species_Clover", "Species_Fescue"]
    # b: species missing; outside fold 0 Fescue is the most frequent. d: state missing; a tie gives the smallest.
    by_key = {r["image_path"]: r for r in got}
    assert by_key["b"]["Species_Fescue"] == 1.0 and by_key["d"]["State_NSW"] == 1.0


def test_no_leak_from_the_held_out_fold(spark, metadata):
    changed = metadata.withColumn("Pre_GSHH_NDVI", F.when(F.col("fold") == 2, 1e9).otherwise(F.col("Pre_GSHH_NDVI")))
    before = preprocess.fit_fold_parameters(metadata, [0, 1, 2]).where("fold = 2")
    after = preprocess.fit_fold_parameters(changed, [0, 1, 2]).where("fold = 2")
    assert rows(before, "column") == rows(after, "column")


def test_unseen_category_is_all_zero_and_empty_rows_become_typical(spark, metadata):
    vocabulary = preprocess.collect_vocabularies(metadata)
    parameters = preprocess.fit_fold_parameters(metadata, [0, 1, 2])
    new = spark.createDataFrame([("x", "Mars", "Moss", 0.5, 4.0), ("y", None, None, None, None)], "image_path string, State string, Species string, Pre_GSHH_NDVI double, Height_Ave_cm double")
    got = rows(preprocess.transform_new_rows(new, parameters, vocabulary, [0, 1, 2]), "image_path", "fold")
    assert len(got) == 6
    assert all(sum(v for c, v in r.items() if c.startswith(("State_", "Species_"))) == 0 for r in got[:3])
    assert all(sum(v for c, v in r.items() if c.startswith(("State_", "Species_"))) == 2 for r in got[3:])


def test_results_do_not_depend_on_partitioning(spark, metadata):
    one = rows(preprocess.out_of_fold_features(metadata.coalesce(1), folds=[0, 1, 2]), "image_path")
    many = rows(preprocess.out_of_fold_features(metadata.repartition(5), folds=[0, 1, 2]), "image_path")
    for a, b in zip(one, many, strict=True):
        assert list(a.values())[2:] == pytest.approx(list(b.values())[2:])


def test_folds_keep_groups_together(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("string").alias("g"))
    folded = preprocess.assign_folds(df, "g")
    assert folded.groupBy("g").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert preprocess.list_folds(folded) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        preprocess.list_folds(folded.where("fold = 0"))


def test_vocabulary_limit(spark, monkeypatch):
    monkeypatch.setattr(preprocess, "MAX_VOCABULARY", 3)
    df = spark.createDataFrame([(str(i), "s") for i in range(5)], "State string, Species string")
    with pytest.raises(ValueError, match="more than 3"):
        preprocess.collect_vocabularies(df)
    with pytest.raises(Exception, match="more than 3"):
        preprocess.vocabularies(df).collect()


def test_feature_groups(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 2.0, 3.0, 4.0)], "image_path string, fold int, GDM_g double, cnn_0000 double, State_NSW double, hist_h_00 double")
    assert features.fused_groups(df)["all_features"] == ["cnn_0000", "State_NSW", "hist_h_00"]
    assert features.baseline_groups(df)["metadata"] == ["State_NSW", "hist_h_00"]
    with pytest.raises(ValueError, match="cnn"):
        features.baseline_groups(df.drop("cnn_0000"))
    with pytest.raises(ValueError, match="missing"):
        features.align_columns(df, ["cnn_0000", "cnn_0001"])


def test_spread_array_refuses_other_lengths(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])], "image_path string, embedding array<float>")
    assert rows(features.spread_array(df.where("image_path = 'a'"), "embedding", 2))[0]["cnn_0001"] == 2.0
    with pytest.raises(Exception, match="expected 2"):
        features.spread_array(df, "embedding", 2).collect()


def test_csv_is_read_with_its_schema(spark, tmp_path, metadata):
    path = str(tmp_path / "samples")
    tables.write_csv(metadata.select(*tables.SAMPLES.names), path)
    back = tables.read_csv(spark, path, tables.SAMPLES)
    assert back.count() == 5 and back.where("Species IS NULL").count() == 1
    assert np.isnan(rows(back.where("image_path = 'd'"))[0]["Pre_GSHH_NDVI"])


def test_whole_table_holds_every_column_of_its_parts(spark, small):
    import __spark_entry__ as entry
    from sward.constants import KEY, TARGETS
    from sward.sources import views

    queries = entry.queries()
    whole = {r[KEY]: r.asDict() for r in queries["i10_whole_table"](spark, small).collect()}
    visual = queries["j15_visual_features"](spark, small)
    hot = preprocess.out_of_fold_features(views.samples(spark, small)).drop("Pre_GSHH_NDVI", "Height_Ave_cm")
    parts = [visual, queries["b4_named_columns"](spark, small), queries["i4_standardise"](spark, small), hot, views.wide_targets(spark, small).select(KEY, *TARGETS)]
    names, keys = set(), []
    for part in parts:
        found = {r[KEY]: r.asDict() for r in part.collect()}
        keys.append(set(found))
        names |= set(part.columns)
        for k in set(found) & set(whole):
            for c, v in found[k].items():
                assert whole[k][c] == pytest.approx(v, abs=2e-6), (k, c)
    assert len(visual.columns) == 89 and len(hot.columns) > 3
    assert set(whole) == set.intersection(*keys) and whole
    assert all(set(r) == names for r in whole.values())
