"""Feature columns: groups by name, canonical order, and moves between arrays and named columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sward.constants import EMBEDDING_PREFIX, IDENTIFIERS, TARGETS, VISUAL_PREFIXES
from sward.functions.scalars import padded_name


def _require(groups: Mapping[str, list[str]]) -> None:
    empty = [name for name, columns in groups.items() if not columns]
    if empty:
        raise ValueError(f"No feature columns found for: {', '.join(empty)}.")


def baseline_groups(df: DataFrame) -> dict[str, list[str]]:
    """Feature names by origin: embeddings, metadata and both. Reads the schema only."""
    cnn = [c for c in df.columns if c.startswith(EMBEDDING_PREFIX)]
    known = {*IDENTIFIERS, *TARGETS, *cnn}
    found = {"cnn": cnn, "metadata": [c for c in df.columns if c not in known]}
    _require(found)
    return {**found, "combined": found["cnn"] + found["metadata"]}


def fused_groups(df: DataFrame) -> dict[str, list[str]]:
    """The three origins (embeddings, metadata, visual) and their four combinations. Reads the schema only."""
    cnn = [c for c in df.columns if c.startswith(EMBEDDING_PREFIX)]
    visual = [c for c in df.columns if c.startswith(VISUAL_PREFIXES)]
    known = {*IDENTIFIERS, *TARGETS, *cnn, *visual}
    metadata = [c for c in df.columns if c not in known]
    _require({"cnn": cnn, "metadata": metadata, "visual": visual})
    return {
        "cnn": cnn,
        "metadata": metadata,
        "visual": visual,
        "cnn_metadata": cnn + metadata,
        "cnn_visual": cnn + visual,
        "metadata_visual": metadata + visual,
        "all_features": cnn + metadata + visual,
    }


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def align_columns(df: DataFrame, order: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``keep`` and then ``order``; an error names the first ten that are absent."""
    absent = missing_columns(df, order)
    if absent:
        raise ValueError(f"{len(absent)} feature columns are missing, first: {absent[:10]}")
    return df.select(*keep, *order)


def spread_array(df: DataFrame, column: str, size: int, prefix: str = EMBEDDING_PREFIX, width: int = 4) -> DataFrame:
    """An array column as ``size`` named double columns (``cnn_0000``, ...), for the output boundary only.

    Rows whose array has another length raise an error rather than gaining NULLs.
    """
    checked = F.when(F.size(column) == size, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected {size} values in {column}, found "), F.size(column).cast("string")))
    )
    others = [c for c in df.columns if c != column]
    with_check = df.withColumn(column, checked)
    return with_check.select(
        *others, *[F.get(column, F.lit(i)).cast("double").alias(padded_name(prefix, i, width)) for i in range(size)]
    )


def dimensions_long(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """An array column as rows ``(keys..., position, value)``."""
    return df.select(*keys, F.posexplode(column).alias("position", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


def feature_array(columns: Sequence[str]) -> Column:
    """Named columns gathered into ``array<double>`` in the given order."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def feature_vector(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Named columns as an ML vector; NULL and NaN are errors."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(df)


def tag(df: DataFrame, **constants) -> DataFrame:
    """Put constant columns (model, feature set, fold) in front."""
    return df.select(*[F.lit(v).alias(k) for k, v in constants.items()], *[c for c in df.columns if c not in constants])


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop helper columns; names that are absent are ignored."""
    return df.drop(*columns)


def harmonise(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def training_rows(df: DataFrame, fold: int, fold_column: str = "fold") -> DataFrame:
    return df.where(F.col(fold_column) != fold)


def validation_rows(df: DataFrame, fold: int, fold_column: str = "fold") -> DataFrame:
    return df.where(F.col(fold_column) == fold)


#: The choice that leaves a column unfiltered.
NO_FILTER = {"State": "All States", "Species": "All Species"}


def filter_optional(df: DataFrame, everything: Mapping[str, str] = NO_FILTER, **wanted: str | None) -> DataFrame:
    """Equality filters; ``None`` or exactly the column's entry in ``everything`` leaves a column unfiltered."""
    for column, choice in wanted.items():
        if choice is not None and choice != everything.get(column):
            df = df.where(F.col(column) == choice)
    return df
