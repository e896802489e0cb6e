"""Scans, sinks and stores. Each query writes and reads back, and returns what came back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import TARGETS, r, sql
from sward.catalog.reports import SUMMARY
from sward.constants import KEY
from sward.operators import joins, metrics, quality
from sward.session import work_path
from sward.sources import models as model_store
from sward.sources import tables, views


@query("a1_csv_scan", sql("SELECT image_path, State, Species, Pre_GSHH_NDVI, Height_Ave_cm FROM samples"))
def a1_csv_scan(spark, folder):
    path = work_path(spark, "samples-csv")
    tables.write_csv(views.samples(spark, folder).select(*tables.SAMPLES.names), path)
    return tables.read_csv(spark, path, tables.SAMPLES)


@query(
    "a2_image_files",
    sql("SELECT 'label=' || label AS folder, true AS present, 'ok' AS note FROM (SELECT DISTINCT label FROM images) UNION ALL SELECT 'label=none', false, 'missing'"),
)
def a2_image_files(spark, folder):
    """Files below a folder against the folders that are expected to hold one."""
    path = work_path(spark, "image-folders")
    views.embeddings(spark, folder).write.mode("overwrite").partitionBy("label").parquet(path)
    found = tables.image_files(spark, path, "*.parquet").select(F.regexp_extract(KEY, "(label=[^/]+)/", 1).alias("folder"))
    # Every label's folder is expected, and one more that nobody wrote.
    names = F.explode(F.array(F.concat(F.lit("label="), "label"), F.lit("label=none")))
    expected = views.embeddings(spark, folder).select(names.alias("folder")).distinct()
    missing = joins.missing_rows(expected, found, ["folder"]).withColumn("missing", F.lit(True))
    present = joins.available_rows(expected, found, ["folder"], "folder").withColumn("missing", F.lit(False))
    return present.unionByName(missing).select(
        "folder", (~F.col("missing")).alias("present"), F.when(F.col("missing"), "missing").otherwise("ok").alias("note")
    )


@query("a3_embedding_cache", sql(f"SELECT image_path, CAST(len(embedding) AS INTEGER) AS dims, {r('list_sum(embedding::DOUBLE[])', 'total')} FROM images"))
def a3_embedding_cache(spark, folder):
    path = work_path(spark, "embedding-cache")
    source = views.embeddings(spark, folder).select(KEY, "embedding")
    tables.write_embeddings(source, path)
    cached = tables.read_embeddings(spark, path)
    quality.require_pass(quality.round_trip(source, cached))
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, e: acc + e.cast("double"))
    return base.rounded(cached.select(KEY, F.size("embedding").alias("dims"), total.alias("total")))


@query("a6_report_sink", sql(f"SELECT model, feature_set, target, {SUMMARY} FROM cv_summary"))
def a6_report_sink(spark, folder):
    path = work_path(spark, "report-csv")
    report = base.rounded(base.cv_summary(spark, folder))
    tables.write_csv(report, path)
    return tables.read_csv(spark, path, report.schema)


def _wide_oof(where: str) -> str:
    columns = ", ".join(r(f"max(CASE WHEN target = '{t}' THEN pred END)", f"pred_{t}") for t in TARGETS)
    return f"SELECT image_path, fold, {columns}, model, feature_set FROM oof {where} GROUP BY image_path, fold, model, feature_set"


@query("a8_oof_sink", sql(_wide_oof("")))
def a8_oof_sink(spark, folder):
    path = work_path(spark, "oof")
    frame = base.rounded(metrics.oof_frame(base.oof(spark, folder)))
    tables.write_predictions(frame, path)
    return spark.read.schema(frame.schema).parquet(path)


@query("a9_model_store", sql(_wide_oof("WHERE model = 'Ridge' AND feature_set = 'Height'")))
def a9_model_store(spark, folder):
    """Ridge models of every fold and target saved, loaded by path convention and used for scoring."""
    from sward.catalog.learning import ridge_models
    from sward.plans.cross_validation import predict_folds

    table, fitted = ridge_models(spark, folder)
    path = work_path(spark, "models")
    model_store.save_models(fitted, path, "Ridge", "Height")
    loaded = model_store.load_models(spark, path, "Ridge", "Height", range(5), TARGETS)
    scored = predict_folds(table, loaded, TARGETS, clip=True)
    tagged = scored.withColumns({"model": F.lit("Ridge"), "feature_set": F.lit("Height")})
    return base.rounded(metrics.oof_frame(tagged))


PARAMETERS_SQL = f"""
    SELECT CAST(k AS INTEGER) AS fold, 'Pre_GSHH_NDVI' AS "column", {r('med_n', 'median', 4)}, {r('mean_n', 'mean', 4)}, {r('std_n', 'std', 4)}, NULL AS mode FROM scales
    UNION ALL SELECT k, 'Height_Ave_cm', {r('med_h', 'median', 4)}, {r('mean_h', 'mean', 4)}, {r('std_h', 'std', 4)}, NULL FROM scales
    UNION ALL SELECT k, "column", NULL, NULL, NULL, mode FROM modes"""


@query("a10_params", sql(PARAMETERS_SQL))
def a10_params(spark, folder):
    path = work_path(spark, "parameters")
    tables.write_parameters(base.parameters(spark, folder), path)
    return base.rounded(tables.read_parameters(spark, path), 4)
