"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import TARGETS, r, sql
from sward.constants import KEY, METADATA, TARGET_LABELS
from sward.functions import scalars
from sward.operators import features, metrics, pixels
from sward.sources import views

DIMENSIONS = 64
NAMES = [f"cnn_{i:04d}" for i in range(DIMENSIONS)]
VISUAL = ["rgb_r_mean", "exg_mean", "vegetation_coverage_ratio"]


def named_embeddings(spark, folder):
    return features.spread_array(views.embeddings(spark, folder).select(KEY, "embedding"), "embedding", DIMENSIONS)


def baseline_table(spark, folder):
    """Identifiers, targets, embeddings and scaled metadata under their canonical names."""
    return named_embeddings(spark, folder).join(base.design(spark, folder), on=KEY)


def fused_table(spark, folder):
    colour = pixels.colour_features(views.pixels(spark, folder)).select(KEY, *VISUAL)
    return baseline_table(spark, folder).join(colour, on=KEY)


def group_means(table, groups):
    """``(feature_group, feature, mean)``: the mean of every feature in every group that holds it, one pass."""
    everything = sorted({c for columns in groups.values() for c in columns})
    means = table.agg(*[F.avg(c).alias(c) for c in everything]).unpivot([], everything, "feature", "mean")
    member = F.array_compact(
        F.array(*[F.when(F.col("feature").isin(columns), F.lit(name)) for name, columns in groups.items()])
    )
    return base.rounded(means.select(F.explode(member).alias("feature_group"), "feature", "mean"))


_MEANS = """feature_means AS (
    SELECT 'cnn_' || lpad(CAST(p AS VARCHAR), 4, '0') AS feature, 'cnn' AS origin, avg(e) AS mean
    FROM cells JOIN modelling USING (image_path) GROUP BY p
    UNION ALL SELECT 'Pre_GSHH_NDVI', 'metadata', avg(z_n) FROM scaled JOIN targets_wide USING (image_path) JOIN images USING (image_path)
    UNION ALL SELECT 'Height_Ave_cm', 'metadata', avg(z_h) FROM scaled JOIN targets_wide USING (image_path) JOIN images USING (image_path)
    UNION ALL SELECT 'rgb_r_mean', 'visual', avg(v) FROM (SELECT avg(r) AS v FROM bands SEMI JOIN modelling USING (image_path) GROUP BY image_path)
    UNION ALL SELECT 'exg_mean', 'visual', avg(v) FROM (SELECT avg(exg) AS v FROM bands SEMI JOIN modelling USING (image_path) GROUP BY image_path)
    UNION ALL SELECT 'vegetation_coverage_ratio', 'visual', avg(v) FROM (
        SELECT avg(CASE WHEN veg THEN 1.0 ELSE 0.0 END) AS v FROM bands SEMI JOIN modelling USING (image_path) GROUP BY image_path))"""


def _groups_sql(groups: dict[str, str]) -> str:
    values = ", ".join(f"('{name}', '{origin}')" for name, origins in groups.items() for origin in origins.split())
    body = sql(f"""SELECT g.feature_group, feature, {r('mean', 'mean')} FROM feature_means
        JOIN (VALUES {values}) g(feature_group, origin) USING (origin)
        WHERE 'cells bands modelling scaled targets_wide images' <> ''""")
    head, tail = body.rsplit("\nSELECT g.feature_group", 1)
    return f"{head},\n{_MEANS}\nSELECT g.feature_group{tail}"


BASELINE_GROUPS = {"cnn": "cnn", "metadata": "metadata", "combined": "cnn metadata"}
FUSED_GROUPS = {
    "cnn": "cnn",
    "metadata": "metadata",
    "visual": "visual",
    "cnn_metadata": "cnn metadata",
    "cnn_visual": "cnn visual",
    "metadata_visual": "metadata visual",
    "all_features": "cnn metadata visual",
}


@query("b1_feature_groups", _groups_sql(BASELINE_GROUPS))
def b1_feature_groups(spark, folder):
    table = baseline_table(spark, folder)
    return group_means(table, features.baseline_groups(table))


@query("b2_fused_groups", _groups_sql(FUSED_GROUPS))
def b2_fused_groups(spark, folder):
    table = fused_table(spark, folder)
    return group_means(table, features.fused_groups(table))


@query(
    "b3_align",
    sql(f"SELECT image_path, CAST(embedding[3] AS DOUBLE) AS cnn_0002, CAST(embedding[1] AS DOUBLE) AS cnn_0000, {r('z_h', 'Height_Ave_cm')} "
        "FROM images JOIN scaled USING (image_path) JOIN targets_wide USING (image_path)"),
)
def b3_align(spark, folder):
    aligned = features.align_columns(baseline_table(spark, folder), ["cnn_0002", "cnn_0000", "Height_Ave_cm"], [KEY])
    return base.rounded(aligned, columns=["Height_Ave_cm"])


@query(
    "b4_named_columns",
    sql("SELECT image_path, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {n}" for i, n in enumerate(NAMES)) + " FROM images"),
)
def b4_named_columns(spark, folder):
    return named_embeddings(spark, folder)


@query(
    "b5_feature_matrix",
    sql(f"SELECT image_path, CAST(3 AS INTEGER) AS n, {r('Dry_Clover_g * 1 + Dry_Dead_g * 2 + Dry_Green_g * 3', 'dot')} FROM targets_wide"),
)
def b5_feature_matrix(spark, folder):
    wide = features.feature_vector(views.wide_targets(spark, folder), TARGETS[:3])
    values = vector_to_array("features")
    dot = values[0] * 1 + values[1] * 2 + values[2] * 3
    return base.rounded(wide.select(KEY, F.size(values).alias("n"), dot.alias("dot")))


@query(
    "b8_fold_split",
    sql(f"""SELECT k, count(*) FILTER (fold <> k) AS train_rows, count(*) FILTER (fold = k) AS validation_rows,
        {r('avg(Dry_Total_g) FILTER (fold <> k)', 'train_mean')}, {r('avg(Dry_Total_g) FILTER (fold = k)', 'validation_mean')}
        FROM folds, modelling GROUP BY k"""),
)
def b8_fold_split(spark, folder):
    """Training and validation side of every fold from one pass; model fits use the same predicates as row filters."""
    sides = [
        f"""struct({k} AS k, count_if(fold <> {k}) AS train_rows, count_if(fold = {k}) AS validation_rows,
            avg(Dry_Total_g) FILTER (WHERE fold <> {k}) AS train_mean, avg(Dry_Total_g) FILTER (WHERE fold = {k}) AS validation_mean)"""
        for k in range(5)
    ]
    split = base.design(spark, folder).agg(F.expr(f"array({', '.join(sides)})").alias("sides"))
    return base.rounded(split.select(F.inline("sides")))


@query("b9_filters", sql("SELECT token, State, Species, Dry_Total_g FROM monitor WHERE State = 'click'"))
def b9_filters(spark, folder):
    log = views.monitor_table(spark, folder)
    return features.filter_optional(log, State="click", Species="All Species").select("token", "State", "Species", "Dry_Total_g")


@query("b11_drop_helpers", sql("SELECT State, Species, Dry_Total_g, area_m2 FROM monitor"))
def b11_drop_helpers(spark, folder):
    return features.drop_present(views.monitor_table(spark, folder), ["token", "ts", "Timestamp_dt"])


@query(
    "b12_errors",
    sql(f"""SELECT image_path, target, {r('y - pred', 'residual')}, {r('abs(y - pred)', 'absolute_error')},
        {r('abs(y - pred) / nullif(y, 0) * 100', 'percentage_error', 4)} FROM oof WHERE model = 'Ridge' AND feature_set = 'NDVI'"""),
)
def b12_errors(spark, folder):
    table = base.one_model(spark, folder).select(
        KEY,
        "target",
        F.round(scalars.residual("y", "pred"), 6).alias("residual"),
        F.round(scalars.absolute_error("y", "pred"), 6).alias("absolute_error"),
        F.round(scalars.percentage_error("y", "pred"), 4).alias("percentage_error"),
    )
    return table


@query("b13_density", sql("SELECT token, " + r("Dry_Total_g / area_m2 * 10", "kg_ha") + " FROM monitor"))
def b13_density(spark, folder):
    log = views.monitor_table(spark, folder)
    return base.rounded(log.select("token", scalars.density_kg_ha("Dry_Total_g", "area_m2").alias("kg_ha")))


@query(
    "b14_clip",
    sql("""SELECT image_path, p, CASE WHEN e < 0 THEN 0.0 ELSE e END AS clipped, CASE WHEN p % 7 = 0 THEN NULL
        WHEN e < 0 THEN 0.0 ELSE e END AS with_gaps FROM cells"""),
)
def b14_clip(spark, folder):
    cells = features.dimensions_long(views.embeddings(spark, folder), "embedding", [KEY])
    gaps = F.when(F.col("position") % 7 != 0, F.col("value"))
    return cells.select(
        KEY, F.col("position").alias("p"), scalars.clip_lower("value").alias("clipped"), scalars.clip_lower(gaps).alias("with_gaps")
    )


def toy_importances(spark, folder):
    """An importance table derived from the data: variances of features per fold and target."""
    table = baseline_table(spark, folder)
    names = [*NAMES, "Pre_GSHH_NDVI", "Height_Ave_cm"]
    long = table.unpivot(["fold"], names, "feature", "value")
    spread = long.groupBy("fold", "feature").agg(F.var_pop("value").alias("importance"))
    return spread.select("fold", F.explode(F.array(*[F.lit(t) for t in TARGETS])).alias("target"), "feature", "importance")


_IMPORTANCE_SQL = """
    SELECT feature, avg(importance) AS importance FROM (
        SELECT fold, 'cnn_' || lpad(CAST(p AS VARCHAR), 4, '0') AS feature, var_pop(e) AS importance
        FROM cells JOIN modelling USING (image_path) GROUP BY fold, p
        UNION ALL SELECT fold, 'Pre_GSHH_NDVI', var_pop(z_n) FROM scaled JOIN images USING (image_path) JOIN targets_wide USING (image_path) GROUP BY fold
        UNION ALL SELECT fold, 'Height_Ave_cm', var_pop(z_h) FROM scaled JOIN images USING (image_path) JOIN targets_wide USING (image_path) GROUP BY fold)
    GROUP BY feature"""


@query("e3_top_importances", sql(f"SELECT feature, {r('importance', 'importance')} FROM ({_IMPORTANCE_SQL}) ORDER BY importance DESC, feature LIMIT 25"))
def e3_top_importances(spark, folder):
    from sward.operators.ranking import top_importances

    return base.rounded(top_importances(metrics.mean_importances(toy_importances(spark, folder))))


@query(
    "d19_importance_by_family",
    sql(f"""SELECT CASE WHEN feature LIKE 'cnn%' THEN 'CNN' ELSE 'Metadata' END AS feature_group, {r('sum(importance)', 'importance')}
        FROM ({_IMPORTANCE_SQL}) GROUP BY 1"""),
)
def d19_importance_by_family(spark, folder):
    means = metrics.mean_importances(toy_importances(spark, folder))
    return base.rounded(metrics.family_importances(means, scalars.feature_family("feature", METADATA)))


@query(
    "b15_feature_family",
    sql(f"""SELECT feature, CASE WHEN feature LIKE 'cnn%' THEN 'CNN' ELSE 'Metadata' END AS feature_group, {r('importance', 'importance')}
        FROM ({_IMPORTANCE_SQL})"""),
)
def b15_feature_family(spark, folder):
    means = metrics.mean_importances(toy_importances(spark, folder))
    return base.rounded(means.select("feature", scalars.feature_family("feature", METADATA).alias("feature_group"), "importance"))


_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TARGET_LABELS.items())


@query(
    "b16_labels",
    sql(f"""SELECT image_path, CASE target WHEN 'Nothing' THEN '' {_LABELS} END AS label,
        'Ridge + ' || target AS configuration, coalesce(State || ' · ' || replace(Species, '_', ' '), '') AS title
        FROM targets_long JOIN samples USING (image_path)"""),
)
def b16_labels(spark, folder):
    rows = views.long_targets(spark, folder).join(views.samples(spark, folder), on=KEY)
    return rows.select(
        KEY,
        scalars.lookup_label("target_name").alias("label"),
        scalars.configuration_label(F.lit("Ridge"), "target_name").alias("configuration"),
        scalars.sample_title().alias("title"),
    )


@query("b17_paths", sql("SELECT image_path, '/data/raw/' || image_path AS absolute_path FROM samples"))
def b17_paths(spark, folder):
    return views.samples(spark, folder).select(KEY, scalars.under_base("/data/raw", KEY).alias("absolute_path"))


@query(
    "b19_results_table",
    sql(f"""SELECT image_path, CASE target WHEN 'Nothing' THEN '' {_LABELS} END AS component, y AS grams, {r('y / 2.5 * 10', 'kg_ha')} FROM targets_long"""),
)
def b19_results_table(spark, folder):
    table = metrics.results_table(views.wide_targets(spark, folder), F.lit(2.5))
    return base.rounded(table, columns=["kg_ha"])


@query(
    "g_scalars",
    sql(f"""SELECT o_orderkey,
        {r('abs(o_totalprice - 250000)', 'g1_abs', 4)}, {r('sqrt(o_totalprice)', 'g1_sqrt')}, {r('power(o_totalprice / 1000, 2)', 'g1_square', 4)},
        least(greatest(o_totalprice, 100000.0), 300000.0) AS g2_clamped,
        {r('o_totalprice / nullif(o_custkey % 3, 0)', 'g3_ratio', 4)},
        CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS g3_choice,
        round(o_totalprice / 7, 3) AS g4_rounded,
        CAST(floor((o_orderkey % 256) / 255.0::DOUBLE * 31.0::DOUBLE) AS INTEGER) AS g5_level,
        starts_with(o_orderpriority, '1') AS g6_prefix, 'cnn_' || lpad(CAST(o_orderkey % 1280 AS VARCHAR), 4, '0') AS g6_name,
        lower(replace(o_orderpriority, '-', ' ')) AS g6_lower,
        CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS g7_time,
        CASE WHEN o_orderkey % 5 = 0 THEN false ELSE true END AS g8_finite,
        {r('o_orderkey % 21 / 20.0::DOUBLE', 'g9_grid')},
        CAST(o_orderkey % 4 * 2 AS BIGINT) AS g10_element, CAST(o_orderkey AS VARCHAR) AS g11_text
        FROM orders"""),
)
def g_scalars(spark, folder):
    """Every scalar family once, over all orders."""
    o = views.read_table(spark, folder, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    text = F.when(key % 3 == 0, F.lit("not a time")).otherwise(F.col("o_orderdate").cast("string"))
    odd = F.when(key % 10 == 0, F.lit(float("nan"))).when(key % 5 == 0, F.lit(float("inf"))).otherwise(price)
    return o.select(
        "o_orderkey",
        F.round(F.abs(price - 250000), 4).alias("g1_abs"),
        F.round(F.sqrt(price), 6).alias("g1_sqrt"),
        F.round(F.pow(price / 1000, 2), 4).alias("g1_square"),
        scalars.clamp(price, 100000.0, 300000.0).alias("g2_clamped"),
        F.round(scalars.ratio(price, F.col("o_custkey") % 3), 4).alias("g3_ratio"),
        F.when(key % 2 == 0, "even").otherwise("odd").alias("g3_choice"),
        F.round(price / 7, 3).alias("g4_rounded"),
        scalars.truncated_level(key % 256, 32).alias("g5_level"),
        F.col("o_orderpriority").startswith("1").alias("g6_prefix"),
        F.concat(F.lit("cnn_"), F.lpad((key % 1280).cast("string"), 4, "0")).alias("g6_name"),
        F.lower(F.replace("o_orderpriority", F.lit("-"), F.lit(" "))).alias("g6_lower"),
        scalars.iso_seconds(scalars.parse_timestamp(text)).alias("g7_time"),
        scalars.is_finite(odd).alias("g8_finite"),
        F.round(F.get(scalars.even_grid(), (key % 21).cast("int")), 6).alias("g9_grid"),
        F.get(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (i * 2).cast("bigint")), (key % 4).cast("int")).alias("g10_element"),
        key.cast("string").alias("g11_text"),
    )
