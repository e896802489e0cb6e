"""Streaming queries, run over everything available and compared with the same result in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import r, sql
from sward.catalog.reports import NEW_ROWS_SQL
from sward.constants import KEY
from sward.operators import features
from sward.plans import ridge, scoring
from sward.sources import views
from sward.streaming import assessments

LOG = "SELECT token, ts, State, Species, Dry_Total_g, area_m2 FROM monitor"


def _plain_time(df):
    """``ts`` without a time zone, as the SQL side has it."""
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _log(spark, folder):
    return views.monitor(assessments.event_stream(spark, folder))


@query("l1_append", sql(LOG))
def l1_append(spark, folder):
    return _plain_time(assessments.drain_appends(_log(spark, folder), "log"))


@query("l2_dedup_stream", sql(LOG))
def l2_dedup_stream(spark, folder):
    """Every event arrives twice; each token is committed once."""
    twice = _log(spark, folder).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return _plain_time(assessments.drain_appends(assessments.commit_once(twice, "2 days"), "log-once"))


@query("l3_running", sql(f"SELECT State, count(*) AS assessments, {r('avg(Dry_Total_g)', 'mean_value')} FROM monitor GROUP BY State"))
def l3_running(spark, folder):
    totals = assessments.running_totals(_log(spark, folder))
    return base.rounded(assessments.drain_updates(totals, "running", ["State"]))


@query("l4_latest", sql("SELECT State, token, ts, Species, Dry_Total_g, area_m2 FROM monitor QUALIFY row_number() OVER (PARTITION BY State ORDER BY ts DESC, token DESC) = 1"))
def l4_latest(spark, folder):
    newest = assessments.latest(_log(spark, folder))
    state = assessments.drain_updates(newest, "latest", ["State"])
    return _plain_time(state).select("State", "token", "ts", "Species", "Dry_Total_g", "area_m2")


@query(
    "l5_trend",
    sql(f"""SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS assessments,
        {r('avg(Dry_Total_g)', 'mean_value')}, {r('avg(Dry_Total_g / area_m2 * 10)', 'mean_kg_ha')} FROM monitor GROUP BY 1"""),
)
def l5_trend(spark, folder):
    trend = assessments.windowed_trend(_log(spark, folder))
    state = assessments.drain_updates(trend, "trend", ["window_start"])
    return base.rounded(state.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query(
    "l6_score_stream",
    sql(f"""SELECT token, target, {r('avg(CASE WHEN v < 0 THEN 0 ELSE v END)', 'pred', 4)} FROM (
        SELECT token, f.target, f.slope * (CASE WHEN token % 5 = 0 THEN c.med_h ELSE m.Dry_Total_g * 10000 END - c.mean_h) / c.std_h + f.intercept AS v
        FROM monitor m, scales c JOIN fits f ON f.k = c.k WHERE f.model = 'Ridge' AND f.feature_set = 'Height') GROUP BY token, target"""),
)
def l6_score_stream(spark, folder):
    """Arriving rows scored by the fold ensemble; every fifth one lacks its measurement and gets the medians."""
    fits = ridge.single_feature_fits(base.design(spark, folder), ["Height_Ave_cm"])
    log = _log(spark, folder)
    height = F.when(F.col("token") % 5 != 0, F.col("Dry_Total_g") * 10000).alias("Height_Ave_cm")
    models = scoring.linear_models(fits, base.numeric_parameters(spark, folder))
    scored = scoring.score_with(log.select("token", height), models, key="token")
    return base.rounded(assessments.drain_appends(scored, "scored").select("token", "target", "pred"), 4)


@query("l8_filter_stream", sql("SELECT token, ts, State, Species, Dry_Total_g, area_m2 FROM monitor WHERE State = 'error' AND Species = '7'"))
def l8_filter_stream(spark, folder):
    chosen = assessments.filtered(_log(spark, folder), state="error", species="7")
    return _plain_time(assessments.drain_appends(chosen, "filtered"))


@query("l8_unfiltered_stream", sql(LOG))
def l8_unfiltered_stream(spark, folder):
    chosen = features.filter_optional(_log(spark, folder), State="All States", Species=None)
    return _plain_time(assessments.drain_appends(chosen, "unfiltered"))


@query("k11_linear_batch", sql(f"SELECT image_path, target, {r('pred', 'pred')} FROM ({NEW_ROWS_SQL})"))
def k11_linear_batch(spark, folder):
    """The same scoring in batch, over all samples."""
    fits = ridge.single_feature_fits(base.design(spark, folder), ["Height_Ave_cm"])
    rows = base.stored_samples(spark, folder).select(KEY, "Height_Ave_cm")
    models = scoring.linear_models(fits, base.numeric_parameters(spark, folder))
    return base.rounded(scoring.score_with(rows, models).select(KEY, "target", "pred"))
