"""Ranking, best-of and ordering. Best-of queries are aggregates, so no group is ever sorted in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sward.constants import TOP_IMPORTANCES
from sward.operators.bounded import small_side


def rank_configurations(means: DataFrame) -> DataFrame:
    """Number configurations from best to worst by RMSE, then MAE, then name.

    The window has no partitions: there is one row per configuration, which the check bounds.
    """
    order = Window.orderBy("mean_RMSE", "mean_MAE", "model", "feature_set")
    return small_side(means, what="configurations").select(F.row_number().over(order).alias("rank"), *means.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], largest: bool = False) -> DataFrame:
    """The whole first (or last) row of every key under an explicit order.

    A ``min_by`` aggregate: each task keeps one row per key, so a key with a third of the rows costs no more than
    another, unlike ``row_number``.
    """
    others = [c for c in df.columns if c not in keys]
    position = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    pick = F.max_by if largest else F.min_by
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*others), position).alias("row"))
        .select(*keys, *[F.col("row")[c].alias(c) for c in others])
        .select(*df.columns)
    )


def best_per_target(summary: DataFrame, measure: str = "RMSE_mean") -> DataFrame:
    return first_per_key(summary, ["target"], [measure, "model", "feature_set"])


def wins_per_configuration(best: DataFrame) -> DataFrame:
    return best.groupBy("model", "feature_set").agg(F.count(F.lit(1)).alias("wins"))


def top_importances(means: DataFrame, k: int = TOP_IMPORTANCES) -> DataFrame:
    """The k most important features, ties by name. Each task keeps k rows."""
    return means.orderBy(F.desc("importance"), "feature").limit(k)


def lowest_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The single row that comes first under ``order``."""
    columns = df.columns
    return df.agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("row")).select("row.*")


def newest_first(df: DataFrame, timestamp: str, *ties: str) -> DataFrame:
    """Sorted by descending time, rows without a time last."""
    return df.orderBy(F.desc_nulls_last(timestamp), *ties)


def trend(df: DataFrame, timestamp: str, measures: Sequence[str], *ties: str, minimum: int = 2) -> DataFrame:
    """Measures in time order; empty when there are fewer than ``minimum`` points."""
    points = df.select(timestamp, *ties, *measures)
    enough = df.limit(minimum).agg((F.count(F.lit(1)) >= minimum).alias("enough"))
    return points.where(enough.scalar()).orderBy(F.asc_nulls_last(timestamp), *ties)


def diverse_sample(df: DataFrame, kind: str, order: str, size: int) -> DataFrame:
    """Up to ``size`` rows: first one row per kind in order of appearance, then the next rows of any kind.

    The first ``2 * size`` rows hold enough candidates for the fill, since at most ``size`` of them can be taken
    already. So nothing beyond a few ``size`` rows is ever sorted or joined.
    """
    columns = df.columns
    leaders = first_per_key(df, [kind], [order]).select(*columns).orderBy(order).limit(size)
    fill = df.orderBy(order).limit(2 * size).join(F.broadcast(leaders.select(order)), on=order, how="left_anti")
    both = leaders.withColumn("turn", F.lit(0)).unionByName(fill.select(*columns).withColumn("turn", F.lit(1)))
    return both.orderBy("turn", order).limit(size).select(*columns)


def extremes(df: DataFrame, measure: str, name: str) -> DataFrame:
    """Names and values of the smallest and largest measure (easiest and hardest target) in one pass."""
    order = F.struct(F.col(measure), F.col(name))
    return df.agg(
        F.min_by(name, order).alias("easiest"),
        F.min(measure).alias("easiest_value"),
        F.max_by(name, order).alias("hardest"),
        F.max(measure).alias("hardest_value"),
    )


def with_stable_index(df: DataFrame, key: str, name: str = "feature_index", parts: int | None = None) -> DataFrame:
    """0-based position of every row in the order of a unique key, without sorting in one task.

    Rows are range-partitioned by the key and stored with the number of their range, so that the sizes of the ranges
    and the positions inside them come from the same split even when a task is run again. The position is the size of
    all earlier ranges plus the rank within the row's own range.
    """
    from sward.session import materialise

    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = materialise(
        df.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()), "stable-index"
    )
    sizes = split.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        split.withColumn("_rank", within)
        .join(small_side(offsets, parts, "key ranges"), on="_range")
        .select((F.col("_before") + F.col("_rank") - 1).cast("bigint").alias(name), *df.columns)
    )
