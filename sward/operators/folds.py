"""Which folds a table has. Folds come from the data, and no row may be outside them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from sward.constants import FOLD

#: A fold column with more labels than this is taken for a mistake, such as a key in its place.
MAX_FOLDS = 10_000


class FoldError(ValueError):
    """A row has no fold, or one that nothing was fitted for."""


def found_folds(df: DataFrame, fold: str = FOLD) -> list[int]:
    """Eager: the sorted fold labels of all rows. A NULL fold is an error, since its rows could be in no result."""
    found = [r[0] for r in df.select(fold).distinct().limit(MAX_FOLDS + 1).collect()]
    if None in found:
        raise FoldError(f"rows without {fold}")
    if len(found) > MAX_FOLDS:
        raise FoldError(f"{fold} has more than {MAX_FOLDS} labels")
    return sorted(found)


def list_folds(df: DataFrame, fold: str = FOLD) -> list[int]:
    """Eager: the fold labels, at least two, as cross-validation needs."""
    found = found_folds(df, fold)
    if len(found) < 2:
        raise FoldError(f"expected at least two folds, found {len(found)}")
    return found


def checked_folds(df: DataFrame, folds: Iterable[int] | None = None, fold: str = FOLD) -> list[int]:
    """The given folds, or those of the data. A row whose fold is not among them is an error, not a lost row."""
    found = found_folds(df, fold)
    chosen = found if folds is None else sorted(folds)
    if found and len(chosen) < 2:
        raise FoldError(f"expected at least two folds, found {len(chosen)}")
    covered_folds(found, chosen, fold)
    return chosen


def covered_folds(found: Iterable[int], known: Iterable[int], fold: str = FOLD) -> None:
    """Every fold of the rows has to be known."""
    unknown = sorted(set(found) - set(known))
    if unknown:
        raise FoldError(f"rows in {fold} {unknown[:5]}, which nothing was fitted for")
