"""Metadata preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import r, sql
from sward.catalog.storage import PARAMETERS_SQL
from sward.constants import CATEGORICAL_METADATA, KEY, NUMERIC_METADATA
from sward.operators import preprocess
from sward.sources import views

FOLDS = range(5)


@query(
    "i1_vocabulary",
    sql("""SELECT 'State' AS "column", list_sort(list(DISTINCT State)) AS vocabulary FROM samples WHERE State IS NOT NULL
        UNION ALL SELECT 'Species', list_sort(list(DISTINCT Species)) FROM samples WHERE Species IS NOT NULL"""),
)
def i1_vocabulary(spark, folder):
    return preprocess.vocabularies(views.samples(spark, folder))


@query(
    "i2_median_imputation",
    sql(f"""SELECT image_path, fold, {r('coalesce(Pre_GSHH_NDVI, med_n)', 'Pre_GSHH_NDVI')}, {r('coalesce(Height_Ave_cm, med_h)', 'Height_Ave_cm')}
        FROM samples JOIN medians ON fold = k"""),
)
def i2_median_imputation(spark, folder):
    from sward.operators.bounded import held

    samples = base.stored_samples(spark, folder)
    medians = preprocess.training_medians(samples, NUMERIC_METADATA, FOLDS)
    wide = held(
        medians.groupBy("fold").agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"{c}_median") for c in NUMERIC_METADATA])
    )
    filled = [F.coalesce(F.col(c), F.col(f"{c}_median")).alias(c) for c in NUMERIC_METADATA]
    return base.rounded(samples.join(wide, on="fold").select(KEY, "fold", *filled))


@query("i3_mode_imputation", sql('SELECT k AS fold, "column", mode FROM modes'))
def i3_mode_imputation(spark, folder):
    return preprocess.training_modes(views.samples(spark, folder), CATEGORICAL_METADATA, FOLDS)


@query("i4_standardise", sql(f"SELECT image_path, fold, {r('z_n', 'Pre_GSHH_NDVI')}, {r('z_h', 'Height_Ave_cm')} FROM scaled"))
def i4_standardise(spark, folder):
    return base.rounded(base.scaled_features(spark, folder))


@query(
    "i5_one_hot",
    sql("""SELECT image_path, "column", category, CAST(max(CASE WHEN filled = category THEN 1 ELSE 0 END) AS DOUBLE) AS hot FROM (
            SELECT image_path, 'State' AS "column", coalesce(State, mode_state) AS filled FROM samples JOIN mode_wide ON fold = k
            UNION ALL SELECT image_path, 'Species', coalesce(Species, mode_species) FROM samples JOIN mode_wide ON fold = k) s
        JOIN (SELECT DISTINCT State AS category, 'State' AS "column" FROM samples WHERE State IS NOT NULL
              UNION ALL SELECT DISTINCT Species, 'Species' FROM samples WHERE Species IS NOT NULL) v USING ("column")
        GROUP BY ALL"""),
)
def i5_one_hot(spark, folder):
    samples = base.stored_samples(spark, folder)
    vocabulary = preprocess.collect_vocabularies(samples)
    wide = preprocess.transform_with(samples, base.parameters(spark, folder), vocabulary)
    names = {f"{c}_{v}": (c, v) for c, values in vocabulary.items() for v in values}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(v).alias("category"), F.col(n).alias("hot")) for n, (c, v) in names.items()])
    return wide.select(KEY, F.inline(cells))


def _oof_sql(condition: str, extra: str = "") -> str:
    """Scaled numbers, and one-hot features summed against their position so that every one of them matters."""
    return f"""
        SELECT s.image_path, CAST(c.k AS INTEGER) AS fold, {r('(coalesce(Pre_GSHH_NDVI, med_n) - mean_n) / std_n', 'Pre_GSHH_NDVI')},
               {r('(coalesce(Height_Ave_cm, med_h) - mean_h) / std_h', 'Height_Ave_cm')},
               (SELECT count(DISTINCT v.State) FROM samples v WHERE v.State <= coalesce(s.State, mode_state)) AS state_code,
               (SELECT count(DISTINCT v.Species) FROM samples v WHERE v.Species <= coalesce(s.Species, mode_species)) AS species_code
        FROM samples s JOIN scales c ON {condition} JOIN mode_wide m ON m.k = c.k {extra}"""


def _codes(features, vocabulary):
    """One-hot columns folded back to the position of the hot one."""

    def code(column: str):
        terms = [F.col(f"`{column}_{v}`") * (i + 1) for i, v in enumerate(vocabulary[column])]
        return sum(terms[1:], terms[0]).cast("bigint").alias(f"{column.lower()}_code")

    return base.rounded(features.select(KEY, "fold", *NUMERIC_METADATA, code("State"), code("Species")))


@query("i7_oof_features", sql(_oof_sql("s.fold = c.k")))
def i7_oof_features(spark, folder):
    samples = base.stored_samples(spark, folder)
    vocabulary = preprocess.collect_vocabularies(samples)
    return _codes(preprocess.out_of_fold_features(samples, vocabulary), vocabulary)


@query("i6_output_order", sql(_oof_sql("s.fold = c.k")))
def i6_output_order(spark, folder):
    """The composed transform with its columns in the fixed order: numbers first, then one-hot columns."""
    samples = base.stored_samples(spark, folder)
    vocabulary = preprocess.collect_vocabularies(samples)
    features = preprocess.transform_with(samples, base.parameters(spark, folder), vocabulary)
    expected = [KEY, "fold", *NUMERIC_METADATA, *[f"{c}_{v}" for c in CATEGORICAL_METADATA for v in vocabulary[c]]]
    if features.columns != expected:
        raise AssertionError("feature order changed")
    return _codes(features, vocabulary)


@query("i8_new_rows", sql(_oof_sql("true")))
def i8_new_rows(spark, folder):
    samples = base.stored_samples(spark, folder)
    vocabulary = preprocess.collect_vocabularies(samples)
    features = preprocess.transform_new_rows(samples.drop("fold"), base.parameters(spark, folder), vocabulary)
    return _codes(features, vocabulary)


@query(
    "i9_group_folds",
    sql("""SELECT CAST(o_custkey % 5 AS INTEGER) AS fold, count(*) AS n, count(DISTINCT o_custkey) AS groups FROM orders GROUP BY 1"""),
)
def i9_group_folds(spark, folder):
    orders = views.read_table(spark, folder, "orders").select("o_custkey")
    folded = preprocess.assign_folds(orders, "o_custkey", hashed=False)
    per_group = folded.groupBy("fold", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("fold").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))


@query("i9_hashed_folds")
def i9_hashed_folds(spark, folder):
    orders = views.read_table(spark, folder, "orders").select("o_custkey")
    folded = preprocess.assign_folds(orders, "o_custkey")
    per_group = folded.groupBy("fold", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per_group.groupBy("fold").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))


@query("i4_fold_parameters", sql(PARAMETERS_SQL))
def i4_fold_parameters(spark, folder):
    return base.rounded(base.parameters(spark, folder), 4)
