"""Joins and set differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import r, sql
from sward.constants import KEY, METADATA, TARGETS
from sward.functions import scalars
from sward.operators import joins, metrics, pixels
from sward.operators.ranking import first_per_key
from sward.sources import views


@query("c1_one_to_one", sql("SELECT image_path, fold, Dry_Total_g FROM samples LEFT JOIN targets_wide USING (image_path)"))
def c1_one_to_one(spark, folder):
    left = base.stored_samples(spark, folder).select(KEY, "fold")
    right = views.wide_targets(spark, folder).select(KEY, "Dry_Total_g")
    return joins.one_to_one(left, right)


@query(
    "c2_side_by_side",
    sql(f"""SELECT image_path, label, Dry_Total_g, {r('z_h', 'Height_Ave_cm')}, len(embedding) AS dims
        FROM images JOIN targets_wide USING (image_path) JOIN scaled USING (image_path)"""),
)
def c2_side_by_side(spark, folder):
    embedded = views.embeddings(spark, folder).select(KEY, "label", F.size("embedding").cast("bigint").alias("dims"))
    targets = views.wide_targets(spark, folder).select(KEY, "Dry_Total_g")
    metadata = base.scaled_features(spark, folder).select(KEY, "Height_Ave_cm")
    return base.rounded(joins.side_by_side([targets, metadata, embedded]))


@query("c3_align", sql(f"SELECT image_path, target, y, {r('a', 'a')}, {r('b', 'b')} FROM two"))
def c3_align(spark, folder):
    from sward.operators.ensemble import paired

    first, second = base.one_model(spark, folder, "NDVI"), base.one_model(spark, folder, "Height")
    return base.rounded(paired(first, second))


@query("c4_missing", sql("SELECT image_path, fold FROM samples ANTI JOIN images USING (image_path)"))
def c4_missing(spark, folder):
    return joins.missing_rows(views.samples(spark, folder).select(KEY, "fold"), views.embeddings(spark, folder), [KEY])


@query("f3_difference", sql("SELECT image_path FROM samples EXCEPT SELECT image_path FROM targets_wide"))
def f3_difference(spark, folder):
    return joins.missing_rows(views.samples(spark, folder).select(KEY), views.wide_targets(spark, folder), [KEY])


@query(
    "c5_actual_predicted",
    sql(f"""SELECT image_path, target, y AS actual, {r('pred', 'predicted')}, {r('abs(y - pred)', 'absolute_error')},
        {r('abs(y - pred) / nullif(y, 0) * 100', 'percentage_error', 4)}
        FROM targets_long JOIN (SELECT image_path, target, pred FROM oof WHERE model = 'Ridge' AND feature_set = 'NDVI') USING (image_path, target)"""),
)
def c5_actual_predicted(spark, folder):
    actual = views.long_targets(spark, folder).withColumnsRenamed({"target": "actual", "target_name": "target"})
    wide = metrics.oof_frame(base.one_model(spark, folder))
    names = {f"pred_{t}": t for t in metrics.TARGETS}
    predicted = metrics.lengthen_targets(wide.withColumnsRenamed(names), name="target", value="predicted")
    return actual.join(predicted, on=[KEY, "target"]).select(
        KEY,
        "target",
        "actual",
        F.round("predicted", 6).alias("predicted"),
        F.round(scalars.absolute_error("actual", "predicted"), 6).alias("absolute_error"),
        F.round(scalars.percentage_error("actual", "predicted"), 4).alias("percentage_error"),
    )


@query(
    "c8_all_folds",
    sql(f"""SELECT image_path, k AS fold, target,
        {r('slope * (coalesce(Height_Ave_cm, med_h) - mean_h) / std_h + intercept', 'pred')}
        FROM samples, scales JOIN fits USING (k) WHERE model = 'Ridge' AND feature_set = 'Height'"""),
)
def c8_all_folds(spark, folder):
    from sward.catalog.reports import fold_predictions

    return base.rounded(fold_predictions(spark, folder))


_OFFSETS = [(0, 1), (0, 3), (1, 0), (1, 1), (1, -1), (2, 3)]
_OFFSET_VALUES = ", ".join(f"({i}, {dy}, {dx})" for i, (dy, dx) in enumerate(_OFFSETS))


@query(
    "c9_neighbours",
    sql(f"""SELECT a.image_path, CAST(o.i AS INTEGER) AS "offset", count(*) AS pairs, CAST(sum(abs(a.grey - b.grey)) AS BIGINT) AS total_gap
        FROM grey a, (VALUES {_OFFSET_VALUES}) o(i, dy, dx), grey b
        WHERE a.image_path = b.image_path AND b.y = a.y + o.dy AND b.x = a.x + o.dx GROUP BY ALL"""),
)
def c9_neighbours(spark, folder):
    pairs = pixels.neighbour_pairs(pixels.grey_scanlines(views.pixels(spark, folder)), _OFFSETS)
    return pairs.groupBy(KEY, "offset").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum(F.abs(F.col("a") - F.col("b"))).alias("total_gap")
    )


@query(
    "b10_available",
    sql("""SELECT image_path, State, Species FROM samples SEMI JOIN images USING (image_path)
        WHERE State IS NOT NULL AND Species IS NOT NULL AND Pre_GSHH_NDVI IS NOT NULL AND Height_Ave_cm IS NOT NULL"""),
)
def b10_available(spark, folder):
    rows = joins.available_rows(views.samples(spark, folder), views.embeddings(spark, folder), METADATA)
    return rows.select(KEY, "State", "Species")


@query(
    "i10_combined_table",
    sql(f"""SELECT image_path, fold, Dry_Total_g, {r('list_sum(embedding::DOUBLE[])', 'embedding_sum')}, {r('z_n', 'Pre_GSHH_NDVI')}, {r('z_h', 'Height_Ave_cm')}
        FROM images JOIN targets_wide USING (image_path) JOIN scaled USING (image_path)"""),
)
def i10_combined_table(spark, folder):
    """Raw rows, one record per image, one-to-one join, fold-safe metadata, embeddings alongside."""
    samples = base.stored_samples(spark, folder)
    observed = views.observed_components(spark, folder).select(KEY)
    present = first_per_key(observed.withColumn("one", F.lit(1)), [KEY], ["one"]).drop("one")
    table = joins.side_by_side(
        [
            base.scaled_features(spark, folder),
            views.wide_targets(spark, folder).select(KEY, "Dry_Total_g"),
            present,
            views.embeddings(spark, folder).select(KEY, "embedding"),
        ]
    )
    joins.require_unique(samples, [KEY], "samples")
    total = F.aggregate(F.transform("embedding", lambda e: e.cast("double")), F.lit(0.0), lambda acc, e: acc + e)
    return base.rounded(table.select(KEY, "fold", "Dry_Total_g", total.alias("embedding_sum"), "Pre_GSHH_NDVI", "Height_Ave_cm"))


@query("i10_whole_table")
def i10_whole_table(spark, folder):
    """The combined table with every column: all targets, scaled and one-hot metadata, the embedding, all visual features.

    Images that lack a record, targets, an embedding or pixels are not in it. Its parts have SQL of their own.
    """
    return base.rounded(base.combined(spark, folder))
