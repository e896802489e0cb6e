"""Metrics, rankings, unions and ensembles over out-of-fold predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import TARGETS, r, sql
from sward.constants import KEY, METADATA, NUMERIC_METADATA
from sward.operators.folds import list_folds
from sward.operators import ensemble, joins, metrics, profile, ranking
from sward.operators.features import dimensions_long, harmonise, tag
from sward.functions import scalars
from sward.plans.cross_validation import ridge_oof
from sward.sources import views

METRICS = ", ".join([r("MAE", "MAE"), r("RMSE", "RMSE"), r("R2", "R2")])
SUMMARY = ", ".join(r(f"{m}_{s}", f"{m}_{s}") for m in ("MAE", "RMSE", "R2") for s in ("mean", "std"))
MEANS = ", ".join(r(f"mean_{m}", f"mean_{m}") for m in ("MAE", "RMSE", "R2"))


@query("k7_oof_ridge1", sql(f"SELECT model, feature_set, fold, image_path, target, y, {r('pred', 'pred')} FROM oof"))
def k7_oof_ridge1(spark, folder):
    return base.rounded(base.oof(spark, folder), columns=["pred"])


@query(
    "d1_metrics",
    sql(f"""SELECT target, {r('avg(abs(y - pred))', 'MAE')}, {r('sqrt(avg((y - pred) * (y - pred)))', 'RMSE')},
               {r('1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y))', 'R2')}
        FROM oof WHERE model = 'Ridge' AND feature_set = 'NDVI' GROUP BY target"""),
)
def d1_metrics(spark, folder):
    return base.rounded(metrics.regression_metrics(base.one_model(spark, folder)))


@query("d2_fold_metrics", sql(f"SELECT model, feature_set, fold, target, {METRICS} FROM fold_metrics"))
def d2_fold_metrics(spark, folder):
    return base.rounded(base.fold_metrics(spark, folder))


@query("d3_cv_summary", sql(f"SELECT model, feature_set, target, {SUMMARY} FROM cv_summary"))
def d3_cv_summary(spark, folder):
    return base.rounded(base.cv_summary(spark, folder))


@query("d4_configuration_means", sql(f"SELECT model, feature_set, {MEANS} FROM config_means"))
def d4_configuration_means(spark, folder):
    return base.rounded(base.config_means(spark, folder))


@query(
    "d5_pooled_metrics",
    sql(f"""SELECT o.model, o.feature_set, {r('avg(abs(y - pred))', 'OOF_MAE')}, {r('sqrt(avg((y - pred) * (y - pred)))', 'OOF_RMSE')},
               {r('any_value(m.r2)', 'OOF_R2')}
        FROM oof o JOIN (
            SELECT model, feature_set, avg(t) AS r2 FROM (
                SELECT model, feature_set, target, 1 - sum((y - pred) * (y - pred)) / (count(*) * var_pop(y)) AS t
                FROM oof GROUP BY model, feature_set, target) GROUP BY model, feature_set) m
          ON o.model = m.model AND o.feature_set = m.feature_set GROUP BY o.model, o.feature_set"""),
)
def d5_pooled_metrics(spark, folder):
    return base.rounded(metrics.pooled_metrics(base.oof(spark, folder)))


@query(
    "d6_numeric_means",
    sql(f"""SELECT model, {r('avg(fold)', 'fold')}, {r('avg(MAE)', 'MAE')}, {r('avg(RMSE)', 'RMSE')}, {r('avg(R2)', 'R2')}
        FROM fold_metrics GROUP BY model"""),
)
def d6_numeric_means(spark, folder):
    return base.rounded(metrics.numeric_means(base.fold_metrics(spark, folder), ["model"]))


@query(
    "d7_fold_target_means",
    sql("SELECT fold, " + ", ".join(r(f"avg({t})", t, 3) for t in TARGETS) + " FROM modelling GROUP BY fold"),
)
def d7_fold_target_means(spark, folder):
    return metrics.rounded_means(views.modelling_table(spark, folder), ["fold"])


@query("d8_value_counts", sql("SELECT fold, count(*) AS n FROM samples GROUP BY fold ORDER BY fold"))
def d8_value_counts(spark, folder):
    return metrics.value_counts(views.samples(spark, folder), "fold").orderBy("fold")


@query("d9_wins", sql("SELECT model, feature_set, count(*) AS wins FROM best GROUP BY model, feature_set"))
def d9_wins(spark, folder):
    return ranking.wins_per_configuration(ranking.best_per_target(base.cv_summary(spark, folder)))


@query(
    "d10_distinct",
    sql("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM samples" for c in METADATA) + ")"),
)
def d10_distinct(spark, folder):
    return profile.distinct_counts(views.samples(spark, folder), METADATA)


def _describe_sql(column: str) -> str:
    quartiles = ", ".join(r(f"quantile_cont({column}, {p})", n, 4) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return f"""SELECT '{column}' AS "column", count({column}) AS count, {r(f'avg({column})', 'mean', 4)},
        {r(f'stddev_samp({column})', 'std', 4)}, {r(f'min({column})', 'min', 4)}, {quartiles}, {r(f'max({column})', 'max', 4)} FROM samples"""


@query("d11_describe", sql("SELECT * FROM (" + " UNION ALL ".join(_describe_sql(c) for c in NUMERIC_METADATA) + ")"))
def d11_describe(spark, folder):
    return base.rounded(profile.describe(views.samples(spark, folder), NUMERIC_METADATA), 4)


@query(
    "d12_matrix_profile",
    sql(f"""SELECT count(DISTINCT image_path) AS n_samples, count(DISTINCT p) AS n_features, {r('min(e)', 'feature_min')},
               {r('max(e)', 'feature_max')}, {r('avg(e)', 'feature_mean')}, {r('stddev_pop(e)', 'feature_std')},
               CAST(count(*) FILTER (isnan(e)) AS BIGINT) AS nan_count, CAST(count(*) FILTER (isinf(e)) AS BIGINT) AS inf_count,
               CAST(count(*) FILTER (e < 0) AS BIGINT) AS negative_count,
               (SELECT count(*) FROM (SELECT p FROM cells GROUP BY p HAVING var_pop(e) = 0)) AS zero_variance_features,
               false AS ragged FROM cells"""),
)
def d12_matrix_profile(spark, folder):
    return base.rounded(profile.matrix_profile(dimensions_long(views.embeddings(spark, folder), "embedding", [KEY]), KEY))


@query(
    "d13_dimension_profile",
    sql(f"""SELECT p AS position, {r('avg(e)', 'mean')}, {r('stddev_pop(e)', 'std')}, {r('var_pop(e)', 'variance')},
               var_pop(e) = 0 AS constant FROM cells GROUP BY p"""),
)
def d13_dimension_profile(spark, folder):
    return base.rounded(profile.dimension_profile(views.embeddings(spark, folder), "embedding"))


NEW_ROWS_SQL = """
    SELECT n.image_path, f.target, avg(CASE WHEN v < 0 THEN 0 ELSE v END) AS pred FROM (
        SELECT s.image_path, f.target, f.slope * (coalesce(s.Height_Ave_cm, c.med_h) - c.mean_h) / c.std_h + f.intercept AS v
        FROM samples s, scales c JOIN fits f ON f.k = c.k WHERE f.model = 'Ridge' AND f.feature_set = 'Height') n(image_path, target, v)
    JOIN (SELECT DISTINCT target FROM fits) f ON f.target = n.target GROUP BY ALL"""


def fold_predictions(spark, folder):
    """Every sample under every fold's preprocessing and fit, one row per fold: the general form."""
    from sward.operators import preprocess
    from sward.plans import ridge
    from sward.operators.bounded import held

    fits = ridge.single_feature_fits(base.design(spark, folder), ["Height_Ave_cm"])
    rows = preprocess.transform_new_rows(
        views.samples(spark, folder), base.numeric_parameters(spark, folder), {}, keep=(KEY,)
    )
    models = held(fits.select("fold", "target", "slope", "intercept"), what="fits")
    return rows.join(models, on="fold").select(
        KEY, "fold", "target", (F.col("slope") * F.col("Height_Ave_cm") + F.col("intercept")).alias("pred")
    )


@query("d14_fold_mean", sql(f"SELECT image_path, target, {r('pred', 'pred')} FROM ({NEW_ROWS_SQL})"))
def d14_fold_mean(spark, folder):
    folds = len(list_folds(base.design(spark, folder)))
    return base.rounded(ensemble.fold_mean(fold_predictions(spark, folder), folds))


GRID_SQL = """SELECT i / 20.0::DOUBLE AS weight_a, 1.0 - i / 20.0::DOUBLE AS weight_b, avg(rmse) AS mean_rmse FROM (
    SELECT i, target, sqrt(avg(power(y - (i / 20.0::DOUBLE * a + (1.0 - i / 20.0::DOUBLE) * b), 2))) AS rmse
    FROM two, range(21) g(i) GROUP BY i, target) GROUP BY i"""


@query("d15_blend", sql(f"SELECT {r('weight_a', 'weight_a')}, {r('weight_b', 'weight_b')}, {r('mean_rmse', 'mean_rmse')} FROM ({GRID_SQL})"))
def d15_blend(spark, folder):
    return base.rounded(ensemble.blend_search(base.two_predictions(spark, folder)))


@query(
    "c6_weight_grid",
    sql(f"SELECT {r('weight_a', 'weight')}, {r('mean_rmse', 'mean_rmse')} FROM ({GRID_SQL})"),
)
def c6_weight_grid(spark, folder):
    grid = ensemble.with_weight_grid(base.two_predictions(spark, folder))
    error = F.col("y") - ensemble.blended(F.col("weight"))
    per_target = grid.groupBy("weight", "target").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    return base.rounded(per_target.groupBy("weight").agg(F.avg("rmse").alias("mean_rmse")))


@query(
    "d16_pivot",
    sql("SELECT target, " + ", ".join(
        r(f"avg(CASE WHEN model = '{m}' AND feature_set = '{f}' THEN RMSE_mean END)", f'"{m} + {f}"')
        for m, f in base.CONFIGURATIONS) + " FROM cv_summary GROUP BY target"),
)
def d16_pivot(spark, folder):
    return base.rounded(metrics.metric_pivot(base.cv_summary(spark, folder), base.CONFIGURATIONS))


@query(
    "d17_targets_wide",
    sql("SELECT image_path, " + ", ".join(
        f"coalesce(max(CASE WHEN target_name = '{t}' THEN target END), 0.0) AS {t}" for t in TARGETS[:3])
        + " FROM observed GROUP BY image_path"),
)
def d17_targets_wide(spark, folder):
    return metrics.widen_targets(views.observed_components(spark, folder), targets=TARGETS[:3], missing=0.0)


COMPARE_SQL = """SELECT a.model, a.target, a.RMSE_mean AS baseline, b.RMSE_mean AS challenger, b.RMSE_mean < a.RMSE_mean AS improved
    FROM cv_summary a JOIN cv_summary b ON a.model = b.model AND a.target = b.target
    WHERE a.feature_set = 'NDVI' AND b.feature_set = 'Height'"""


@query("c7_self_compare", sql(f"SELECT model, target, {r('baseline', 'baseline')}, {r('challenger', 'challenger')}, improved FROM ({COMPARE_SQL})"))
def c7_self_compare(spark, folder):
    return base.rounded(joins.compare_variants(base.cv_summary(spark, folder), "NDVI", "Height"))


@query("b18_improved", sql("""SELECT model, feature_set, fold, target, RMSE < MAE * 1.2 AS improved FROM fold_metrics"""))
def b18_improved(spark, folder):
    improved = F.col("RMSE") < F.col("MAE") * 1.2
    return base.fold_metrics(spark, folder).select("model", "feature_set", "fold", "target", improved.alias("improved"))


@query(
    "d18_improvement",
    sql(f"SELECT count(*) AS pairs, {r('avg(CASE WHEN improved THEN 1.0 ELSE 0.0 END) * 100', 'improvement_pct')} FROM ({COMPARE_SQL})"),
)
def d18_improvement(spark, folder):
    return base.rounded(metrics.improvement_percentage(joins.compare_variants(base.cv_summary(spark, folder), "NDVI", "Height")))


@query(
    "d20_histogram",
    sql(f"""WITH e AS (SELECT y - pred AS v FROM oof WHERE model = 'Ridge' AND feature_set = 'NDVI'),
               b AS (SELECT min(v) AS lo, max(v) AS hi FROM e),
               c AS (SELECT least(CAST(floor((v - lo) / ((hi - lo) / 40)) AS INTEGER) + 1, 40) AS bin, count(*) AS n FROM e, b GROUP BY 1)
        SELECT CAST(i AS INTEGER) AS bin, {r('lo + (i - 1) * (hi - lo) / 40', 'lower')}, {r('lo + i * (hi - lo) / 40', 'upper')},
               coalesce(n, 0) AS n FROM range(1, 41) g(i) CROSS JOIN b LEFT JOIN c ON c.bin = i""").replace("\nWITH e AS", ",\ne AS", 1),
)
def d20_histogram(spark, folder):
    errors = base.one_model(spark, folder).select(scalars.residual("y", "pred").alias("residual"))
    return base.rounded(profile.histogram(errors, "residual", 40))


@query(
    "d21_parity",
    sql(f"""SELECT count(*) AS pairs, {r('max(abs(a - b))', 'max_abs_diff')}, {r('avg(abs(a - b))', 'mean_abs_diff')},
               bool_and(abs(a - b) <= 1e-6 + 1e-5 * abs(b)) AS within_tolerance FROM two"""),
)
def d21_parity(spark, folder):
    return base.rounded(ensemble.parity(base.two_predictions(spark, folder)))


@query(
    "d22_dashboard",
    sql(f"""SELECT count(*) AS assessments, arg_max(Dry_Total_g, (ts, token)) AS latest_Dry_Total_g,
               arg_max(area_m2, (ts, token)) AS latest_area_m2, {r('avg(Dry_Total_g)', 'average_Dry_Total_g')} FROM monitor"""),
)
def d22_dashboard(spark, folder):
    log = views.monitor_table(spark, folder)
    return base.rounded(profile.dashboard(log, "ts", "token", ["Dry_Total_g", "area_m2"], "Dry_Total_g"))


@query(
    "d23_experiment_size",
    sql("""SELECT count(*) AS actual, count(DISTINCT (model, feature_set)) * count(DISTINCT fold) * count(DISTINCT target) AS expected
        FROM fold_metrics"""),
)
def d23_experiment_size(spark, folder):
    return metrics.experiment_size(base.fold_metrics(spark, folder))


# Ranking


@query("e1_ranking", sql(f"SELECT CAST(rank AS INTEGER) AS rank, model, feature_set, {MEANS} FROM ranking"))
def e1_ranking(spark, folder):
    return base.rounded(ranking.rank_configurations(base.config_means(spark, folder)))


@query("e2_best_per_target", sql(f"SELECT model, feature_set, target, {SUMMARY} FROM best"))
def e2_best_per_target(spark, folder):
    return base.rounded(ranking.best_per_target(base.cv_summary(spark, folder)))


@query("e4_argmin", sql(f"""SELECT {r('weight_a', 'weight_a')}, {r('weight_b', 'weight_b')}, {r('mean_rmse', 'mean_rmse')}
    FROM ({GRID_SQL}) ORDER BY mean_rmse, weight_a LIMIT 1"""))
def e4_argmin(spark, folder):
    return base.rounded(ensemble.best_blend(ensemble.blend_search(base.two_predictions(spark, folder))))


@query("e5_sorted", sql("""SELECT token, CASE WHEN token % 7 <> 0 THEN ts END AS ts, State, Dry_Total_g FROM monitor
    ORDER BY 2 DESC NULLS LAST, token"""))
def e5_sorted(spark, folder):
    log = views.monitor_table(spark, folder)
    with_gaps = log.select("token", F.when(F.col("token") % 7 != 0, F.col("ts").cast("timestamp_ntz")).alias("ts"), "State", "Dry_Total_g")
    return ranking.newest_first(with_gaps, "ts", "token")


@query("e6_dedup", sql("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) = 1"""))
def e6_dedup(spark, folder):
    items = views.read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ranking.first_per_key(items, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_quantity"])


@query("e7_diverse", sql("""SELECT image_path, State, Species FROM (
        SELECT *, row_number() OVER (PARTITION BY Species ORDER BY image_path) AS rn FROM samples
        WHERE State IS NOT NULL AND Species IS NOT NULL AND Pre_GSHH_NDVI IS NOT NULL AND Height_Ave_cm IS NOT NULL)
    ORDER BY rn > 1, image_path LIMIT 40"""))
def e7_diverse(spark, folder):
    complete = views.samples(spark, folder).dropna(subset=list(METADATA)).select(KEY, "State", "Species")
    return ranking.diverse_sample(complete, "Species", KEY, 40)


@query("e8_feature_index", sql("SELECT row_number() OVER (ORDER BY image_path) - 1 AS feature_index, image_path, fold FROM samples"))
def e8_feature_index(spark, folder):
    return ranking.with_stable_index(views.samples(spark, folder).select(KEY, "fold"), KEY)


@query(
    "e9_extremes",
    sql(f"""SELECT arg_min(target, (RMSE_mean, target)) AS easiest, {r('min(RMSE_mean)', 'easiest_value')},
        arg_max(target, (RMSE_mean, target)) AS hardest, {r('max(RMSE_mean)', 'hardest_value')} FROM best"""),
)
def e9_extremes(spark, folder):
    best = ranking.best_per_target(base.cv_summary(spark, folder))
    return base.rounded(ranking.extremes(best, "RMSE_mean", "target"))


@query("e10_trend", sql("SELECT ts, token, Dry_Total_g, round(Dry_Total_g / area_m2 * 10, 6) AS kg_ha FROM monitor ORDER BY ts, token"))
def e10_trend(spark, folder):
    log = views.monitor_table(spark, folder).withColumn("kg_ha", F.round(scalars.density_kg_ha("Dry_Total_g", "area_m2"), 6))
    return ranking.trend(log.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", ["Dry_Total_g", "kg_ha"], "token")


# Unions


@query("f1_union_all", sql(f"""SELECT model, feature_set, fold, target, {METRICS} FROM fold_metrics WHERE feature_set = 'NDVI'
    UNION ALL SELECT model, feature_set, fold, target, {METRICS} FROM fold_metrics WHERE feature_set = 'Height'"""))
def f1_union_all(spark, folder):
    table = base.design(spark, folder)
    parts = [
        metrics.fold_metrics(ridge_oof(table, {name: column}, base.MODELS)) for name, column in base.FEATURE_SETS.items()
    ]
    return base.rounded(parts[0].unionByName(parts[1]))


@query(
    "f2_union_missing",
    sql(f"""SELECT model, feature_set, {MEANS}, rank, source FROM (
        SELECT CAST(NULL AS INTEGER) AS rank, *, 'baseline' AS source FROM config_means WHERE model = 'Ridge'
        UNION ALL SELECT CAST(rank AS INTEGER) AS rank, model, feature_set, mean_MAE, mean_RMSE, mean_R2, 'advanced' FROM (
            SELECT row_number() OVER (ORDER BY mean_RMSE, mean_MAE, model, feature_set) AS rank, * FROM config_means
            WHERE model = 'Ridge_strong'))"""),
)
def f2_union_missing(spark, folder):
    means = base.config_means(spark, folder)
    plain = means.where("model = 'Ridge'").withColumn("source", F.lit("baseline"))
    ranked = ranking.rank_configurations(means.where("model = 'Ridge_strong'")).withColumn("source", F.lit("advanced"))
    return base.rounded(plain.unionByName(ranked, allowMissingColumns=True))


@query(
    "b7_rename",
    sql(f"SELECT model, feature_set, {r('mean_MAE', 'Mean_MAE')}, {r('mean_RMSE', 'Mean_RMSE')}, {r('mean_R2', 'Mean_R2')} FROM config_means"),
)
def b7_rename(spark, folder):
    names = {f"mean_{m}": f"Mean_{m}" for m in ("MAE", "RMSE", "R2")}
    return base.rounded(harmonise(base.config_means(spark, folder), names))


@query(
    "b6_tag",
    sql(f"""SELECT 'Dummy' AS model, 'All' AS feature_set, 0 AS fold, target, {r('avg(y)', 'y')} FROM targets_long GROUP BY target"""),
)
def b6_tag(spark, folder):
    means = views.long_targets(spark, folder).groupBy(F.col("target_name").alias("target")).agg(F.round(F.avg("target"), 6).alias("y"))
    return tag(means, model="Dummy", feature_set="All", fold=0)


# Ensembles and selection


@query("k10_select", sql(f"SELECT model, feature_set, {MEANS} FROM config_means ORDER BY mean_RMSE, mean_MAE, model, feature_set LIMIT 1"))
def k10_select(spark, folder):
    means = base.config_means(spark, folder)
    return base.rounded(ranking.lowest_row(means, ["mean_RMSE", "mean_MAE", "model", "feature_set"]))


@query(
    "k17_strategy",
    sql(f"""WITH g AS (SELECT * FROM ({GRID_SQL}) ORDER BY mean_rmse, weight_a LIMIT 1)
        SELECT target, {r('sqrt(avg(power(y - (weight_a * a + weight_b * b), 2)))', 'RMSE')}, {r('any_value(weight_a)', 'weight_a')},
               {r('any_value(mean_rmse)', 'expected_mean_rmse')} FROM two, g GROUP BY target""").replace("\nWITH g AS", ",\ng AS", 1),
)
def k17_strategy(spark, folder):
    pairs = base.two_predictions(spark, folder)
    best = ensemble.best_blend(ensemble.blend_search(pairs)).agg(F.first(F.struct("weight_a", "mean_rmse"))).scalar()
    scored = pairs.withColumn("best", best).withColumn("pred", ensemble.blended(F.col("best.weight_a")))
    error = F.col("y") - F.col("pred")
    return base.rounded(
        scored.groupBy("target").agg(
            F.sqrt(F.avg(error * error)).alias("RMSE"),
            F.first("best.weight_a").alias("weight_a"),
            F.first("best.mean_rmse").alias("expected_mean_rmse"),
        )
    )


@query("k18_blend", sql(f"SELECT image_path, target, {r('0.7 * a + (1.0 - 0.7) * b', 'pred')} FROM two"))
def k18_blend(spark, folder):
    first, second = base.one_model(spark, folder, "NDVI"), base.one_model(spark, folder, "Height")
    pairs = ensemble.paired(first, second)
    return base.rounded(pairs.select(KEY, "target", ensemble.blended(0.7).alias("pred")))


def _frame_sql() -> str:
    columns = []
    for t in TARGETS:
        columns.append(f"max(CASE WHEN target = '{t}' THEN y END) AS actual_{t}")
        columns.append(r(f"max(CASE WHEN target = '{t}' THEN pred END)", f"pred_{t}"))
        columns.append(r(f"max(CASE WHEN target = '{t}' THEN y - pred END)", f"residual_{t}"))
    return f"SELECT image_path, fold, {', '.join(columns)} FROM oof WHERE model = 'Ridge' AND feature_set = 'NDVI' GROUP BY ALL"


@query("k19_report_frame", sql(_frame_sql()))
def k19_report_frame(spark, folder):
    return base.rounded(metrics.prediction_frame(base.one_model(spark, folder)))
