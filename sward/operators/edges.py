"""Edge density with the usual steps: gradients, thinning across the edge, and two linked thresholds.

Gradients and thinning are array lookups in neighbouring scanlines. Only pixels that survive them, a small part of
an image, go on to the linking step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.constants import EDGE_HIGH, EDGE_LOW, KEY
from sward.operators.pixels import grey_scanlines

# Fixed value: tan(22.5 degrees), in units of 2**-15 and rounded, which splits directions into four sectors.
TAN_SECTOR = 13573
SECTOR_SHIFT = 15


def _sobel_lines(pixels: DataFrame, key: str) -> DataFrame:
    """``(image_path, y, g)``: per scanline an array of ``(gx, gy, m)`` from 3x3 Sobel filters with repeated borders."""
    window = Window.partitionBy(key).orderBy("y")
    previous = F.coalesce(F.lag("y", 1).over(window), F.lit(-1))
    gap = F.raise_error(F.concat(F.lit("missing line in "), F.col(key).cast("string"))).cast("int")
    lines = grey_scanlines(pixels, key).select(
        key,
        F.when(previous == F.col("y") - 1, F.col("y")).otherwise(gap).alias("y"),
        F.coalesce(F.lag("line", 1).over(window), "line").alias("up"),
        "line",
        F.coalesce(F.lead("line", 1).over(window), "line").alias("down"),
        (F.size("line") - 1).alias("last"),
    )
    left, right = "greatest(x - 1, 0)", "least(x + 1, last)"
    gx = " + ".join(f"{w} * (get({line}, {right}) - get({line}, {left}))" for line, w in (("up", 1), ("line", 2), ("down", 1)))
    gy = " + ".join(f"{w} * (get(down, {x}) - get(up, {x}))" for x, w in ((left, 1), ("x", 2), (right, 1)))
    cells = f"transform(sequence(0, last), x -> struct({gx} AS gx, {gy} AS gy))"
    return lines.select(key, "y", F.expr(cells).alias("g")).select(
        key, "y", "g", F.expr("transform(g, c -> abs(c.gx) + abs(c.gy))").alias("m")
    )


def gradients(pixels: DataFrame, key: str = KEY) -> DataFrame:
    """``(image_path, y, x, gx, gy, magnitude, thinned)``; magnitude is ``|gx| + |gy|``.

    ``thinned`` tells whether the magnitude is a maximum across the edge direction. Magnitudes outside the image are 0.
    Both steps look into the line above and below; the second reuses the split and order of the first.
    """
    window = Window.partitionBy(key).orderBy("y")
    near = _sobel_lines(pixels, key).select(
        key,
        "y",
        "g",
        F.lag("m", 1).over(window).alias("up"),
        "m",
        F.lead("m", 1).over(window).alias("down"),
    )
    cells = near.select(key, "y", "up", "m", "down", F.posexplode("g").alias("x", "c")).selectExpr(
        key, "y", "x", "c.gx", "c.gy", "up", "m", "down", "get(m, x) AS magnitude"
    )

    def beside(line: str, step: int) -> str:
        return f"coalesce(get({line}, x + {step}), 0)"

    def peak(before: str, after: str, ties: bool = False) -> str:
        return f"magnitude > {before} AND magnitude {'>=' if ties else '>'} {after}"

    steep, shallow = f"abs(gy) * {1 << SECTOR_SHIFT}L", f"abs(gx) * {TAN_SECTOR}L"
    thinned = f"""CASE
        WHEN {steep} < {shallow} THEN {peak(beside('m', -1), beside('m', 1), ties=True)}
        WHEN {steep} > {shallow} + abs(gx) * {1 << (SECTOR_SHIFT + 1)}L THEN {peak(beside('up', 0), beside('down', 0), ties=True)}
        WHEN (gx < 0) <> (gy < 0) THEN {peak(beside('up', 1), beside('down', -1))}
        ELSE {peak(beside('up', -1), beside('down', 1))} END"""
    return cells.selectExpr(key, "y", "x", "gx", "gy", "magnitude", f"{thinned} AS thinned")


def edge_candidates(pixels: DataFrame, key: str = KEY, low: int = EDGE_LOW, high: int = EDGE_HIGH) -> DataFrame:
    """Thinned pixels above the low threshold, with ``strong`` for those above the high one."""
    return (
        gradients(pixels, key)
        .where((F.col("magnitude") > low) & F.col("thinned"))
        .select(key, "y", "x", (F.col("magnitude") > high).alias("strong"))
    )


def _link(group: pa.Table) -> pa.Table:
    """Keep weak pixels that touch a strong one, directly or through other weak pixels (8 neighbours)."""
    ys, xs = group["y"].to_numpy().astype(np.int64), group["x"].to_numpy().astype(np.int64)
    width = int(xs.max(initial=0)) + 3
    codes = (ys + 1) * width + xs + 1
    order = np.argsort(codes)
    places, linked = codes[order], group["strong"].to_numpy(zero_copy_only=False)[order].copy()
    around = np.array([dy * width + dx for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx])
    frontier = places[linked]
    # Only pixels that the last step linked can link more, so the work is that of the edges, not of the grid.
    while len(frontier):
        near = np.unique(frontier[:, None] + around)
        at = np.minimum(np.searchsorted(places, near), len(places) - 1)
        fresh = at[(places[at] == near) & ~linked[at]]
        linked[fresh] = True
        frontier = places[fresh]
    kept = np.empty(len(linked), bool)
    kept[order] = linked
    return group.filter(pa.array(kept)).drop_columns("strong")


def edge_pixels(pixels: DataFrame, key: str = KEY, low: int = EDGE_LOW, high: int = EDGE_HIGH) -> DataFrame:
    """Edge pixels ``(image_path, y, x)``.

    Linking is reachability within one image, which no built-in operator expresses, so it runs per image on Arrow
    batches. A group is the candidate pixels of one image and so never larger than the image grid.
    """
    found = edge_candidates(pixels, key, low, high)
    schema = found.select(key, "y", "x").schema
    return found.groupBy(key).applyInArrow(_link, schema)


def edge_density(pixels: DataFrame, key: str = KEY, low: int = EDGE_LOW, high: int = EDGE_HIGH) -> DataFrame:
    """Share of an image's pixels that lie on an edge. Edges are counted where they are linked, one row per image."""
    found = edge_candidates(pixels, key, low, high)

    def count(group: pa.Table) -> pa.Table:
        return group.slice(0, 1).select([key]).append_column("edges", pa.array([_link(group).num_rows], pa.int64()))

    schema = T.StructType([found.schema[key], T.StructField("edges", T.LongType())])
    edges = found.groupBy(key).applyInArrow(count, schema)
    sizes = grey_scanlines(pixels, key).groupBy(key).agg(F.sum(F.size("line")).alias("n"))
    return sizes.join(edges, on=key, how="left").select(
        key, (F.coalesce(F.col("edges"), F.lit(0)) / F.col("n")).alias("edge_density")
    )
