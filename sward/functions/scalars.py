"""Null- and NaN-safe scalar expressions used across the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sward.constants import BLEND_STEPS, EMBEDDING_PREFIX, TARGET_LABELS, VISUAL_PREFIXES

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip_lower(value: ColumnLike, low: float = 0.0) -> Column:
    """Raise values below ``low``. NULL and NaN pass through, unlike with ``greatest``, which would hide them."""
    value = as_column(value)
    return F.when(value < F.lit(low), F.lit(low)).otherwise(value)


def clamp(value: ColumnLike, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; NULL and NaN pass through."""
    value = as_column(value)
    return (
        F.when(F.isnan(value.cast("double")), value)
        .when(value < F.lit(low), F.lit(low))
        .when(value > F.lit(high), F.lit(high))
        .otherwise(value)
    )


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Division that yields NULL for a zero denominator, also under ANSI mode."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))


def residual(actual: ColumnLike, predicted: ColumnLike) -> Column:
    return as_column(actual) - as_column(predicted)


def absolute_error(actual: ColumnLike, predicted: ColumnLike) -> Column:
    return F.abs(residual(actual, predicted))


def percentage_error(actual: ColumnLike, predicted: ColumnLike) -> Column:
    """Absolute error as a percentage of the actual value; NULL where the actual value is zero."""
    return ratio(absolute_error(actual, predicted), actual) * F.lit(100.0)


def density_kg_ha(grams: ColumnLike, area_m2: ColumnLike) -> Column:
    """Grams over a sampled area in square metres, as kilograms per hectare."""
    return ratio(grams, area_m2) * F.lit(10.0)


def is_missing(value: ColumnLike, numeric: bool = True) -> Column:
    """True for NULL, and for NaN in numeric columns."""
    value = as_column(value)
    return (value.isNull() | F.isnan(value)) if numeric else value.isNull()


def is_infinite(value: ColumnLike) -> Column:
    return F.abs(as_column(value)) == F.lit(float("inf"))


def is_finite(value: ColumnLike) -> Column:
    value = as_column(value)
    return value.isNotNull() & ~F.isnan(value) & ~is_infinite(value)


def lookup_label(value: ColumnLike, labels: Mapping[str, str] = TARGET_LABELS) -> Column:
    """Display label from a small fixed map, falling back to the value itself."""
    value = as_column(value)
    pairs = F.create_map(*[F.lit(part) for item in labels.items() for part in item])
    return F.coalesce(F.try_element_at(pairs, value), value)


def configuration_label(model: ColumnLike = "model", feature_set: ColumnLike = "feature_set") -> Column:
    return F.concat_ws(" + ", as_column(model), as_column(feature_set))


def spaced(value: ColumnLike) -> Column:
    """Underscores shown as spaces."""
    return F.translate(as_column(value), "_", " ")


def sample_title(state: ColumnLike = "State", species: ColumnLike = "Species") -> Column:
    """Human-readable sample name; empty where a part is missing."""
    return F.coalesce(F.concat(as_column(state), F.lit(" · "), spaced(species)), F.lit(""))


def under_base(base: str, path: ColumnLike) -> Column:
    """Absolute path of a relative one; absolute paths stay as they are."""
    path = as_column(path)
    prefixed = F.concat(F.lit(base.rstrip("/") + "/"), path)
    return F.when(path.startswith("/"), path).otherwise(prefixed)


def feature_family(name: ColumnLike, metadata: Sequence[str] = ()) -> Column:
    """CNN, Visual, Metadata or Other, from the feature's name.

    Metadata features have no prefix of their own: they are the listed columns and the one-hot columns named after
    them (``State_NSW``).
    """
    name = as_column(name)
    visual = F.lit(False)
    for prefix in VISUAL_PREFIXES:
        visual = visual | name.startswith(prefix)
    described = F.lit(False)
    for column in metadata:
        described = described | (name == F.lit(column)) | name.startswith(f"{column}_")
    return (
        F.when(name.startswith(EMBEDDING_PREFIX), "CNN")
        .when(visual, "Visual")
        .when(described, "Metadata")
        .otherwise("Other")
    )


def parse_timestamp(text: ColumnLike) -> Column:
    """Timestamp from ISO text; NULL where it cannot be read."""
    return F.try_to_timestamp(as_column(text))


def iso_seconds(timestamp: ColumnLike) -> Column:
    return F.date_format(as_column(timestamp), "yyyy-MM-dd'T'HH:mm:ss")


def truncated_level(value: ColumnLike, levels: int, full_scale: float = 255.0) -> Column:
    """Quantise ``0..full_scale`` to ``levels`` grey levels by truncation."""
    return F.floor(as_column(value) / F.lit(full_scale) * F.lit(levels - 1.0)).cast("int")


def even_grid(steps: int = BLEND_STEPS) -> Column:
    """The ``steps + 1`` evenly spaced values from 0 to 1 as an array."""
    return F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: i / F.lit(float(steps)))


def padded_name(prefix: str, index: int, width: int) -> str:
    return f"{prefix}{index:0{width}d}"


def sql_text(value: str) -> str:
    """A text literal for SQL expressions, whatever characters it has."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(column: str) -> str:
    """A column name for SQL expressions, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"
