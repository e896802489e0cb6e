"""Where regular expressions match, in code points, with DataFrame functions only.

Spark has no function for the places of all matches. They follow from the text between the matches: ``split`` gives the
pieces, ``regexp_extract_all`` the matches, and a running sum over their lengths the places.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of text kept on either side of a match.
NEAR = 48


def _pieces(text: Column, pattern: str, group: int) -> Column:
    """One entry per match, with the length of the text before it, and a last one for the tail."""
    wide = F.arrays_zip(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
    )

    def narrow(x: Column) -> Column:
        return F.struct(
            F.length(x["0"]).alias("gap"),
            F.right(x["0"], F.lit(NEAR)).alias("before"),
            F.left(x["0"], F.lit(NEAR)).alias("next"),
            x["1"].alias("found"),
            x["2"].alias("part"),
        )

    return F.when(text.rlike(pattern), F.transform(wide, narrow))


PIECE = "array<struct<gap:int,before:string,next:string,found:string,part:string>>"


def find_spans(
    rows: DataFrame,
    patterns: Mapping[str, tuple[str, int]],
    keep: tuple[str, ...],
    wanted: str | None = None,
    every_row: bool = False,
    combine: bool = False,
) -> DataFrame:
    """``(*keep, kind, start, end, found, part, before, after)``: all matches, leftmost and non-overlapping per kind.

    ``keep`` names columns that identify a row; ``text`` must not be null. ``patterns`` gives for each kind the regular
    expression and the group that ``part`` returns. Places are code points, the end is exclusive. ``wanted`` names an
    array column with the kinds to look for in a row. Rows without matches give nothing, or with ``every_row`` one row
    with a null kind. ``combine`` is for rows that may repeat with the same ``keep`` and text.

    What is shuffled is match-sized, never texts: each row's pieces meet in one task, in order, and stay partitioned by
    ``keep``.
    """

    def pieces(kind: str) -> Column:
        found = _pieces(F.col("text"), *patterns[kind])
        return found if wanted is None else F.when(F.array_contains(wanted, kind), found)

    entries = [F.struct(F.lit(kind).alias("kind"), pieces(kind).cast(PIECE).alias("pieces")) for kind in patterns]
    if every_row:
        entries.append(F.struct(F.lit(None).cast("string").alias("kind"), F.array(F.lit(None)).cast(PIECE).alias("pieces")))
    each = (
        rows.select(*keep, F.explode(F.array(*entries)).alias("_k"))
        .where(F.col("_k.pieces").isNotNull())
        .select(*keep, "_k.kind", F.posexplode("_k.pieces").alias("_at", "_p"))
        .select(*keep, "kind", "_at", "_p.*")
        .repartition(*keep)
    )
    if combine:
        each = each.dropDuplicates([*keep, "kind", "_at"])
    order = Window.partitionBy(*keep, "kind").orderBy("_at")
    upto = F.sum(F.col("gap") + F.coalesce(F.length("found"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = each.withColumn("end", upto.cast("long")).withColumn("after", F.lead("next").over(order))
    return placed.where(F.col("found").isNotNull() | F.col("kind").isNull()).select(
        *keep, "kind", (F.col("end") - F.length("found")).alias("start"), "end", "found", "part", "before", "after"
    )


def span_digest(spans: Column) -> Column:
    """``kind:start:end`` of an ordered array of structs, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
