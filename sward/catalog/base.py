"""Inputs shared by the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import KEY, NUMERIC_METADATA, TARGETS
from sward.operators import features, joins, metrics, pixels, preprocess
from sward.plans.cross_validation import ridge_oof, ridge_side_by_side
from sward.session import stored_once
from sward.sources import views

MODELS = {"Ridge": 1.0, "Ridge_strong": 1000.0}
FEATURE_SETS = {"NDVI": "Pre_GSHH_NDVI", "Height": "Height_Ave_cm"}
CONFIGURATIONS = [(m, f) for m in MODELS for f in FEATURE_SETS]


def rounded(df: DataFrame, digits: int = 6, columns: Sequence[str] | None = None) -> DataFrame:
    """Floating-point columns rounded, since engines add numbers in different orders."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def scaled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric metadata, imputed and scaled out of fold. Reads the stored samples three times."""
    return preprocess.out_of_fold_features(stored_samples(spark, folder), {}, categorical=())


def stored_samples(spark: SparkSession, folder: str) -> DataFrame:
    return stored_once(spark, f"{folder}/samples", lambda: views.samples(spark, folder))


def design(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled numeric features with the targets: the stored feature table that cross-validation reads."""

    def build() -> DataFrame:
        return scaled_features(spark, folder).join(views.wide_targets(spark, folder), on=KEY)

    return stored_once(spark, f"{folder}/design", build)


def combined(spark: SparkSession, folder: str) -> DataFrame:
    """The stored combined table: fold, all targets, scaled and one-hot metadata, embedding and all visual features.

    Images that lack a record, targets, an embedding or pixels are not in it.
    """

    def build() -> DataFrame:
        samples = stored_samples(spark, folder)
        joins.require_unique(samples, [KEY], "samples")
        embeddings = views.embeddings(spark, folder).select(KEY, F.col("embedding").cast("array<double>").alias("embedding"))
        return joins.side_by_side(
            [
                preprocess.out_of_fold_features(samples),
                views.wide_targets(spark, folder).select(KEY, *TARGETS),
                features.spread_array(embeddings, "embedding", 64),
                pixels.visual_features(views.pixels(spark, folder)),
            ]
        )

    return stored_once(spark, f"{folder}/combined", build)


def combined_features(table: DataFrame) -> list[str]:
    """The feature columns of the combined table, in its order."""
    return [c for c in table.columns if c not in (KEY, "fold", "group_id", *TARGETS)]


def oof(spark: SparkSession, folder: str, configurations: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Out-of-fold predictions of the chosen configurations (all four by default)."""
    chosen = configurations or CONFIGURATIONS
    models = {m: MODELS[m] for m, _ in chosen}
    sets = {f: FEATURE_SETS[f] for _, f in chosen}
    return ridge_oof(design(spark, folder), sets, models, TARGETS)


def one_model(spark: SparkSession, folder: str, feature_set: str = "NDVI") -> DataFrame:
    return oof(spark, folder, [("Ridge", feature_set)])


def two_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """``(image_path, target, y, a, b)``: both feature sets of one model.

    Both predictions come from one row, so pairing them takes no shuffle. Only where images repeat, which their names
    alone show, is a conditional aggregate per key needed.
    """
    table = design(spark, folder)
    pairs = ridge_side_by_side(table, {"a": FEATURE_SETS["NDVI"], "b": FEATURE_SETS["Height"]}, MODELS["Ridge"], TARGETS)
    pairs = pairs.select(KEY, "target", "y", "a", "b")
    if not joins.duplicate_keys(table, [KEY]).limit(1).count():
        return pairs
    return pairs.groupBy(KEY, "target").agg(*[F.max(c).alias(c) for c in ("y", "a", "b")])


def fold_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.fold_metrics(oof(spark, folder))


def cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.cv_summary(fold_metrics(spark, folder))


def config_means(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.configuration_means(cv_summary(spark, folder))


def parameters(spark: SparkSession, folder: str) -> DataFrame:
    return preprocess.fit_fold_parameters(stored_samples(spark, folder))


def numeric_parameters(spark: SparkSession, folder: str) -> DataFrame:
    return preprocess.fit_fold_parameters(stored_samples(spark, folder), numeric=NUMERIC_METADATA, categorical=())
