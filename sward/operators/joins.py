"""Keyed joins with the guards that positional concatenation would need."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.constants import KEY


class AlignmentError(ValueError):
    """Two tables that must describe the same keys do not."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Combines before the shuffle, so hot keys stay cheap."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Eager check; brings at most five offending keys to the driver."""
    offending = duplicate_keys(df, keys).limit(5).collect()
    if offending:
        raise AlignmentError(f"{what} has duplicate keys, for example {[tuple(r)[:-1] for r in offending]}")


def one_to_one(left: DataFrame, right: DataFrame, key: str = KEY, how: str = "left") -> DataFrame:
    """Left equi-join that refuses duplicate keys on either side.

    No broadcast hint: both sides grow with the data, so the size decides through file statistics and AQE.
    """
    require_unique(left, [key], "left table")
    require_unique(right, [key], "right table")
    return left.join(right, on=key, how=how)


def side_by_side(tables: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """Column-wise concatenation by key. All joins use the one key, so each input is shuffled once."""
    return reduce(lambda a, b: a.join(b, on=key, how="inner"), tables)


def key_mismatches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose number of occurrences differs, with both counts. One combined shuffle of the keys only."""
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        both.groupBy(*keys)
        .agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
        .where(F.col("left_rows") != F.col("right_rows"))
    )


def align(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of two tables that must hold the same keys; an error otherwise."""
    unmatched = key_mismatches(left, right, keys).limit(5).collect()
    if unmatched:
        raise AlignmentError(f"key sets differ, for example {[tuple(r) for r in unmatched]}")
    require_unique(left, keys, "left table")
    return left.join(right, on=list(keys), how="inner")


def missing_rows(expected: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows whose key is not present."""
    return expected.join(present.select(*keys), on=list(keys), how="left_anti")


def available_rows(df: DataFrame, present: DataFrame, required: Sequence[str], key: str = KEY) -> DataFrame:
    """Rows with every required value set and whose key exists in ``present``."""
    return df.dropna(subset=list(required)).join(present.select(key), on=key, how="left_semi")


def compare_variants(
    summary: DataFrame, baseline: str, challenger: str, measure: str = "RMSE_mean", variant: str = "feature_set"
) -> DataFrame:
    """Two variants of the same model and target side by side, and whether the challenger is lower.

    Written as one conditional aggregate rather than a self-join. Pairs with only one of the variants are left out.
    """

    def of(name: str):
        return F.max(F.when(F.col(variant) == name, F.col(measure)))

    return (
        summary.where(F.col(variant).isin(baseline, challenger))
        .groupBy("model", "target")
        .agg(of(baseline).alias("baseline"), of(challenger).alias("challenger"))
        .where("baseline IS NOT NULL AND challenger IS NOT NULL")
        .withColumn("improved", F.col("challenger") < F.col("baseline"))
    )
