"""Data-quality rules. Each rule is a row ``(check, expected, actual, status)``; strict mode turns FAIL into an error."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import FOLD, KEY
from sward.functions.scalars import is_infinite, is_missing
from sward.operators.features import missing_columns

def _numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))


def missing_in(df: DataFrame, column: str) -> Column:
    return is_missing(column, numeric=_numeric(df, column))


def rule(df: DataFrame, check: str, expected: Column | int, actual: Column) -> DataFrame:
    """One rule as one aggregate row; ``actual`` (and ``expected``) are aggregate expressions."""
    expected = F.lit(expected) if isinstance(expected, int) else expected
    return graded(df.agg(F.lit(check).alias("check"), expected.cast("bigint").alias("expected"), actual.cast("bigint").alias("actual")))


def graded(rows: DataFrame) -> DataFrame:
    status = F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL")
    return rows.select("check", "expected", "actual", status.alias("status"))


def rules_in_one_pass(df: DataFrame, checks: dict[str, tuple[Column | int, Column]]) -> DataFrame:
    """Many rules about one table from a single aggregate, unpivoted to rows."""
    cells = [
        F.struct(
            F.lit(name).alias("check"),
            (F.lit(expected) if isinstance(expected, int) else expected).cast("bigint").alias("expected"),
            actual.cast("bigint").alias("actual"),
        )
        for name, (expected, actual) in checks.items()
    ]
    return graded(df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """H1: names come from the schema and emptiness from one row, so nothing is scanned.

    Every absent column also has a row of its own that names it.
    """
    absent = missing_columns(df, required)
    named: dict[str, tuple[Column | int, Column]] = {f"missing_column:{c}": (0, F.lit(1)) for c in absent}
    return rules_in_one_pass(
        df.select(F.lit(1).alias("one")).limit(1),
        {"required_columns_missing": (0, F.lit(len(absent))), **named, "non_empty": (1, F.count("one"))},
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """H2: missing values per column and in total, ``(column, n_missing)``, one pass."""
    counts = df.agg(*[F.count_if(missing_in(df, c)).alias(c) for c in columns])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return counts.withColumn("total", total).unpivot([], [*columns, "total"], "column", "n_missing")


def non_finite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """H3: NaN and infinite values per numeric column, one pass."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.isnan(c)).alias("nan_count"),
            F.count_if(is_infinite(c)).alias("inf_count"),
        )
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """H4: rows beyond the first of their key."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return rule(counted, "duplicate_keys", 0, F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def row_count(df: DataFrame, expected: int) -> DataFrame:
    """H5."""
    return rule(df, "row_count", expected, F.count(F.lit(1)))


def fold_labels(df: DataFrame, folds: int, fold: str = FOLD) -> DataFrame:
    """H6: labels are exactly 0..k-1. Counts per label first, so the set that is compared has one entry per fold."""
    labels = df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"))
    inside = F.count_if(F.col(fold).between(0, folds - 1))
    return rules_in_one_pass(
        labels,
        {
            "fold_count": (folds, F.count(fold)),
            "fold_labels_in_range": (folds, inside),
            "fold_missing": (0, F.count_if(F.col(fold).isNull())),
            "at_least_two_folds": (1, (F.count(fold) >= 2).cast("int")),
        },
    )


def same_feature_names(names: DataFrame, fold: str = FOLD, name: str = "feature") -> DataFrame:
    """H7: every fold lists the same features. A feature is wrong when it is not present in all folds."""
    folds = names.select(fold).distinct().agg(F.count(F.lit(1))).scalar()
    per_feature = names.groupBy(name, fold).agg(F.lit(1).alias("seen")).groupBy(name).agg(F.count("seen").alias("folds"))
    return rule(per_feature, "features_not_in_every_fold", 0, F.count_if(F.col("folds") != folds))


#: Combinations of listed values that are counted beside each other in one row.
MOST_SLOTS = 60


def prediction_coverage(
    rows: DataFrame, predictions: DataFrame, keys: Sequence[str], values: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """H8: every row predicted exactly once. Rows and predictions are counted together by key.

    ``values`` lists what some of the keys usually hold, such as targets and models. Combinations of these are then counted
    in one row per remaining key, so that this row, not one for each combination, is shuffled. All other values are
    counted as well, each in a row of its own.
    """
    both = rows.select(*keys, F.lit(1).alias("row"), F.lit(0).alias("prediction")).unionByName(
        predictions.select(*keys, F.lit(0).alias("row"), F.lit(1).alias("prediction"))
    )
    values = {c: list(v) for c, v in (values or {}).items()}
    slots = prod(map(len, values.values())) if values else 0
    if not 0 < slots <= MOST_SLOTS:
        counted = both.groupBy(*keys).agg(F.sum("row").alias("row"), F.sum("prediction").alias("prediction"))
        kinds = {
            "rows_without_prediction": F.count_if(F.expr("row > 0 AND prediction = 0")),
            "rows_predicted_twice": F.count_if(F.expr("row > 0 AND prediction > 1")),
            "predictions_without_row": F.count_if(F.expr("row = 0")),
        }
        return rules_in_one_pass(counted, {name: (0, actual) for name, actual in kinds.items()})

    # The combination's number; null if a value isn't listed.
    slot = F.lit(0)
    for c, listed in values.items():
        place = reduce(lambda when, i, c=c, listed=listed: when.when(F.col(c) == listed[i], i), range(1, len(listed)), F.when(F.col(c) == listed[0], 0))
        slot = slot * len(listed) + place
    own = [f"_key_{i}" for i in range(len(keys) - len(values))]
    rest = [F.col(c).alias(name) for c, name in zip((c for c in keys if c not in values), own)]
    other = F.when(F.col("_slot").isNull(), F.struct(*values))
    placed = both.withColumn("_slot", slot).select(*rest, "_slot", other.alias("_other"), "row", "prediction")

    def total(what: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0))

    counted = placed.groupBy(*own, "_other").agg(
        F.bit_or(F.expr("CASE WHEN row > 0 AND _slot IS NOT NULL THEN shiftleft(1L, _slot) ELSE 0L END")).alias("rows"),
        *[total("prediction", F.col("_slot") == i).alias(f"p_{i}") for i in range(slots)],
        total("row", F.col("_slot").isNull()).alias("other_row"),
        total("prediction", F.col("_slot").isNull()).alias("other_prediction"),
    )

    def cases(inside: Callable[[Column, Column], Column]) -> Column:
        """In how many combinations of a counted row the condition on (row wanted, predictions) holds."""
        found = [inside(F.col("rows").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.col(f"p_{i}")) for i in range(slots)]
        unlisted = F.col("_other").isNotNull() & inside(F.col("other_row") > 0, F.col("other_prediction"))
        return F.coalesce(F.sum(reduce(lambda a, b: a + b, [f.cast("bigint") for f in [*found, unlisted]])), F.lit(0))

    return rules_in_one_pass(
        counted,
        {
            "rows_without_prediction": (0, cases(lambda wanted, p: wanted & (p == 0))),
            "rows_predicted_twice": (0, cases(lambda wanted, p: wanted & (p > 1))),
            "predictions_without_row": (0, cases(lambda wanted, p: ~wanted & (p > 0))),
        },
    )


def negative_predictions(predictions: DataFrame, column: str = "pred") -> DataFrame:
    """H9."""
    return rule(predictions, "negative_predictions", 0, F.count_if(F.col(column) < 0))


def integrity_report(*parts: DataFrame) -> DataFrame:
    """H10: all rule rows together."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def overall_status(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.when(F.count_if(F.col("status") == "FAIL") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def require_pass(report: DataFrame) -> None:
    """Eager strict mode: raise with the failing checks (at most ten are shown)."""
    failed = report.where("status = 'FAIL'").limit(10).collect()
    if failed:
        raise ValueError("failed checks: " + ", ".join(f"{r['check']} ({r['actual']} != {r['expected']})" for r in failed))


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """H11: rows whose number of copies differs, with ``surplus`` > 0 where the left table has more.

    A multiset difference both ways in one combined shuffle, where ``exceptAll`` twice would take four.
    """
    right = right.select(*left.columns)
    signed = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    return signed.groupBy(*left.columns).agg(F.sum("side").alias("surplus")).where("surplus <> 0")


def round_trip(left: DataFrame, right: DataFrame) -> DataFrame:
    return rule(table_difference(left, right), "round_trip_differences", 0, F.count(F.lit(1)))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """H12: both inputs describe the same keys."""
    from sward.operators.joins import key_mismatches

    return rule(key_mismatches(left, right, list(keys)), "key_mismatches", 0, F.count(F.lit(1)))


def feature_table_checks(df: DataFrame, features: Sequence[str], key: str = KEY, expected_rows: int | None = None) -> DataFrame:
    """J17: key present and unique, no missing or infinite value, and the row count if it is known."""
    missing = reduce(lambda a, b: a + b, [F.count_if(is_missing(c)) for c in features])
    infinite = reduce(lambda a, b: a + b, [F.count_if(is_infinite(c)) for c in features])
    checks: dict[str, tuple[Column | int, Column]] = {
        "missing_keys": (0, F.count_if(F.col(key).isNull())),
        "missing_values": (0, missing),
        "infinite_values": (0, infinite),
    }
    if expected_rows is not None:
        checks["row_count"] = (expected_rows, F.count(F.lit(1)))
    return rules_in_one_pass(df, checks).unionByName(duplicate_count(df, [key]))

