"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import sql
from sward.constants import KEY, METADATA, TARGETS
from sward.operators import pixels, quality
from sward.sources import views


def rules_sql(*rules: tuple[str, str, str], source: str = "") -> str:
    parts = [
        f"""SELECT '{name}' AS "check", CAST({expected} AS BIGINT) AS expected, CAST({actual} AS BIGINT) AS actual {source}"""
        for name, expected, actual in rules
    ]
    return sql(f"""SELECT *, CASE WHEN expected IS NOT DISTINCT FROM actual THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({' UNION ALL '.join(parts)})""")


@query(
    "h1_required",
    rules_sql(("required_columns_missing", "0", "1"), ("missing_column:Not_A_Column", "0", "1"), ("non_empty", "1", "(SELECT count(*) FROM (SELECT 1 FROM samples LIMIT 1))")),
)
def h1_required(spark, folder):
    return quality.required_columns(views.samples(spark, folder), [*METADATA, "Not_A_Column"])


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM samples" for c in METADATA
)


@query("h2_nulls", sql(f"SELECT * FROM ({_NULLS}) UNION ALL SELECT 'total', CAST(sum(n_missing) AS BIGINT) FROM ({_NULLS})"))
def h2_nulls(spark, folder):
    return quality.null_counts(views.samples(spark, folder), METADATA)


@query(
    "h3_nan",
    sql("""SELECT 'NDVI' AS "column", CAST(count(*) FILTER (o_orderkey % 10 = 0) AS BIGINT) AS nan_count,
            CAST(count(*) FILTER (o_orderkey % 10 = 5) AS BIGINT) AS inf_count FROM orders
        UNION ALL SELECT 'Height', 0, 0"""),
)
def h3_nan(spark, folder):
    orders = views.read_table(spark, folder, "orders")
    odd = (
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(float("nan")))
        .when(F.col("o_orderkey") % 10 == 5, F.lit(float("-inf")))
        .otherwise(F.col("o_totalprice"))
    )
    return quality.non_finite_counts(orders.select(odd.alias("NDVI"), F.col("o_totalprice").alias("Height")), ["NDVI", "Height"])


@query("h4_dups", rules_sql(("duplicate_keys", "0", "(SELECT count(*) - count(DISTINCT l_orderkey) FROM lineitem)")))
def h4_dups(spark, folder):
    return quality.duplicate_count(views.read_table(spark, folder, "lineitem"), ["l_orderkey"])


@query("h5_row_count", rules_sql(("row_count", "357", "(SELECT count(*) FROM samples)")))
def h5_row_count(spark, folder):
    return quality.row_count(views.samples(spark, folder), 357)


@query(
    "h6_folds",
    rules_sql(
        ("fold_count", "5", "(SELECT count(DISTINCT fold) FROM samples)"),
        ("fold_labels_in_range", "5", "(SELECT count(DISTINCT fold) FROM samples WHERE fold BETWEEN 0 AND 4)"),
        ("fold_missing", "0", "(SELECT count(*) FROM samples WHERE fold IS NULL)"),
        ("at_least_two_folds", "1", "(SELECT count(DISTINCT fold) >= 2 FROM samples)"),
    ),
)
def h6_folds(spark, folder):
    return quality.fold_labels(views.samples(spark, folder), 5)


@query(
    "h7_same_names",
    rules_sql((
        "features_not_in_every_fold", "0",
        "(SELECT count(*) FROM (SELECT Species FROM samples WHERE Species IS NOT NULL GROUP BY Species HAVING count(DISTINCT fold) <> 5))",
    )),
)
def h7_same_names(spark, folder):
    names = views.samples(spark, folder).where("Species IS NOT NULL").select("fold", F.col("Species").alias("feature"))
    return quality.same_feature_names(names)


#: The number in an image's path, on which faults are planted.
_NUMBER = "CAST(regexp_extract({}, '[0-9]+') AS BIGINT)"
_EXPECTED = f"""SELECT image_path, target, model, feature_set FROM samples,
    (VALUES {", ".join(f"('{t}')" for t in TARGETS)}) t(target),
    (VALUES {", ".join(f"('{m}', '{f}')" for m, f in base.CONFIGURATIONS)}) c(model, feature_set)"""
#: Predictions with gaps, repetitions and images that don't exist.
_FAULTY = f"""SELECT image_path, target, model, feature_set FROM oof WHERE NOT ({_NUMBER.format('image_path')} % 50 = 0 AND target = 'GDM_g')
    UNION ALL SELECT image_path, target, model, feature_set FROM oof WHERE {_NUMBER.format('image_path')} % 50 = 1
    UNION ALL SELECT 'none/' || image_path, target, model, feature_set FROM oof WHERE {_NUMBER.format('image_path')} % 50 = 2 AND model = 'Ridge'"""


def _coverage_rules(predictions: str) -> list[tuple[str, str, str]]:
    wanted = f"(SELECT *, true AS wanted FROM ({_EXPECTED}))"
    counted = f"""SELECT coalesce(p, 0) AS p, coalesce(wanted, false) AS wanted
        FROM (SELECT image_path, target, model, feature_set, count(*) AS p FROM ({predictions}) GROUP BY ALL)
        FULL JOIN {wanted} USING (image_path, target, model, feature_set)"""
    return [
        ("rows_without_prediction", "0", f"(SELECT count(*) FROM ({counted}) WHERE wanted AND p = 0)"),
        ("rows_predicted_twice", "0", f"(SELECT count(*) FROM ({counted}) WHERE wanted AND p > 1)"),
        ("predictions_without_row", "0", f"(SELECT count(*) FROM ({counted}) WHERE NOT wanted)"),
    ]


_CONFIGURED = [KEY, "target", "model", "feature_set"]
_VALUES = {"target": TARGETS, "model": list(base.MODELS), "feature_set": list(base.FEATURE_SETS)}


def _expected(spark, folder):
    """Every image under every target and configuration."""
    targets = F.explode(F.array(*[F.lit(t) for t in TARGETS])).alias("target")
    configurations = F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(f).alias("feature_set")) for m, f in base.CONFIGURATIONS]))
    return base.stored_samples(spark, folder).select(KEY, targets).select(KEY, "target", configurations)


def _number():
    return F.regexp_extract(KEY, "[0-9]+", 0).cast("bigint")


@query("h8_coverage", rules_sql(*_coverage_rules(_FAULTY)))
def h8_coverage(spark, folder):
    """All targets and configurations, with predictions that are absent, repeated or of no image."""
    whole = base.oof(spark, folder).select(*_CONFIGURED)
    faulty = (
        whole.where(~((_number() % 50 == 0) & (F.col("target") == "GDM_g")))
        .unionByName(whole.where(_number() % 50 == 1))
        .unionByName(whole.where((_number() % 50 == 2) & (F.col("model") == "Ridge")).withColumn(KEY, F.concat(F.lit("none/"), KEY)))
    )
    return quality.prediction_coverage(_expected(spark, folder), faulty, _CONFIGURED, _VALUES)


@query("h9_negative", rules_sql(("negative_predictions", "0", "(SELECT count(*) FROM cells WHERE e < 0)")))
def h9_negative(spark, folder):
    values = views.embeddings(spark, folder).select(F.explode("embedding").alias("pred"))
    return quality.negative_predictions(values)


def _report(spark, folder):
    predictions = base.oof(spark, folder)
    # Counts by fold and target first: distinct ones of the few groups need no copies of the predictions.
    counted = predictions.groupBy("fold", "target").agg(
        F.count_if(quality.missing_in(predictions, "pred")).alias("missing"),
        F.count_if(F.abs("pred") == float("inf")).alias("infinite"),
        F.count_if(F.col("pred") < 0).alias("negative"),
    )
    return quality.integrity_report(
        quality.rules_in_one_pass(
            counted,
            {
                "prediction_nan_count": (0, F.coalesce(F.sum("missing"), F.lit(0))),
                "prediction_inf_count": (0, F.coalesce(F.sum("infinite"), F.lit(0))),
                "negative_predictions": (0, F.coalesce(F.sum("negative"), F.lit(0))),
                "fold_count": (5, F.count_distinct("fold")),
                "target_count": (5, F.count_distinct("target")),
            },
        ),
        quality.prediction_coverage(_expected(spark, folder), predictions, _CONFIGURED, _VALUES),
        quality.fold_labels(base.stored_samples(spark, folder), 5),
    )


_REPORT = [
    ("prediction_nan_count", "0", "(SELECT count(*) FROM oof WHERE pred IS NULL OR isnan(pred))"),
    ("prediction_inf_count", "0", "(SELECT count(*) FROM oof WHERE isinf(pred))"),
    ("negative_predictions", "0", "(SELECT count(*) FROM oof WHERE pred < 0)"),
    ("fold_count", "5", "(SELECT count(DISTINCT fold) FROM oof)"),
    ("target_count", "5", "(SELECT count(DISTINCT target) FROM oof)"),
    *_coverage_rules("SELECT image_path, target, model, feature_set FROM oof"),
    ("fold_count", "5", "(SELECT count(DISTINCT fold) FROM samples)"),
    ("fold_labels_in_range", "5", "(SELECT count(DISTINCT fold) FROM samples WHERE fold BETWEEN 0 AND 4)"),
    ("fold_missing", "0", "(SELECT count(*) FROM samples WHERE fold IS NULL)"),
    ("at_least_two_folds", "1", "(SELECT count(DISTINCT fold) >= 2 FROM samples)"),
]


@query("h10_report", rules_sql(*_REPORT))
def h10_report(spark, folder):
    return _report(spark, folder)


@query(
    "h10_overall",
    f"""SELECT count(*) AS checks, CAST(count(*) FILTER (status = 'FAIL') AS BIGINT) AS failed,
        CASE WHEN count(*) FILTER (status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM ({rules_sql(*_REPORT)})""",
)
def h10_overall(spark, folder):
    return quality.overall_status(_report(spark, folder))


_TRIP = f"SELECT {_NUMBER.format('image_path')} % 1000 AS n, Height_Ave_cm AS v FROM samples"


@query(
    "h11_round_trip",
    rules_sql((
        "round_trip_differences", "0",
        f"(SELECT count(*) FILTER (n = 0) + 2 * count(*) FILTER (n = 1 AND v IS NOT NULL) + 2 * count(*) FILTER (n IN (2, 3)) + count(*) FILTER (n = 4) FROM ({_TRIP}))",
    )),
)
def h11_round_trip(spark, folder):
    """The stored table against a copy with repeated, changed, NaN, infinite and absent rows; all else must agree."""
    n, value = _number() % 1000, F.col("Height_Ave_cm")
    changed = (
        F.when(n == 1, value + 1).when(n == 2, F.lit(float("nan"))).when(n == 3, F.lit(float("inf"))).otherwise(value)
    )
    stored = base.stored_samples(spark, folder)
    damaged = stored.withColumn("Height_Ave_cm", changed).where(n != 4).unionByName(stored.where(n == 0))
    return quality.round_trip(views.samples(spark, folder), damaged)


@query(
    "h12_same_keys",
    rules_sql((
        "key_mismatches", "0",
        """(SELECT count(*) FROM (SELECT image_path FROM samples ANTI JOIN targets_wide USING (image_path)
            UNION ALL SELECT image_path FROM targets_wide ANTI JOIN samples USING (image_path)))""",
    )),
)
def h12_same_keys(spark, folder):
    return quality.same_keys(views.samples(spark, folder), views.wide_targets(spark, folder))


_DAMAGED = "(SELECT vec_id AS v FROM embeddings UNION ALL SELECT vec_id FROM embeddings WHERE vec_id < 10)"


@query(
    "j17_validate",
    rules_sql(
        ("missing_keys", "0", f"(SELECT count(*) FROM {_DAMAGED} WHERE v % 100 = 0)"),
        ("missing_values", "0", f"(SELECT count(*) FILTER (v % 7 = 0) + count(*) FILTER (v % 9 = 0) FROM {_DAMAGED})"),
        ("infinite_values", "0", f"(SELECT count(*) FROM {_DAMAGED} WHERE v % 11 = 0)"),
        ("row_count", "500", f"(SELECT count(*) FROM {_DAMAGED})"),
        ("duplicate_keys", "0", f"(SELECT count(*) - count(DISTINCT CASE WHEN v % 100 <> 0 THEN v ELSE -1 END) FROM {_DAMAGED})"),
    ),
)
def j17_validate(spark, folder):
    """All 88 features, with keys and values that are absent, infinite or repeated."""
    names = pixels.visual_feature_names()
    table, n = pixels.visual_features(views.pixels(spark, folder)), _number()
    damaged = table.unionByName(table.where(n < 10)).withColumns(
        {
            "texture_contrast": F.when(n % 7 == 0, F.lit(float("nan"))).otherwise(F.col("texture_contrast")),
            "edge_density": F.when(n % 9 != 0, F.col("edge_density")),
            "exg_mean": F.when(n % 11 == 0, F.lit(float("-inf"))).otherwise(F.col("exg_mean")),
            KEY: F.when(n % 100 != 0, F.col(KEY)),
        }
    )
    return quality.feature_table_checks(damaged, names, expected_rows=500)


@query(
    "h2_missing_text",
    sql("SELECT State IS NULL AS state_missing, Species IS NULL AS species_missing, count(*) AS n FROM samples GROUP BY ALL"),
)
def h2_missing_text(spark, folder):
    rows = views.samples(spark, folder)
    return rows.groupBy(
        quality.missing_in(rows, "State").alias("state_missing"), quality.missing_in(rows, "Species").alias("species_missing")
    ).agg(F.count(F.lit(1)).alias("n"))

