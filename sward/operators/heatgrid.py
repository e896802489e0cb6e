"""Vegetation heat grid: contrast-stretched excess green, smoothed, with a summary per image."""

from __future__ import annotations

from math import exp

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sward.constants import HEAT_PERCENTILES, HEAT_SIGMA, KEY
from sward.functions.color import excess_green, vegetation_mask
from sward.functions.scalars import clamp
from sward.operators.pixels import whole_line


def stretched(pixels: DataFrame, key: str = KEY) -> DataFrame:
    """``(image_path, y, x, level)``: excess green between its 2nd and 98th percentile, as 0..255.

    A flat image is 0 everywhere. The percentiles are exact per image; an image's distinct values are bounded by the
    8-bit channels. The pixels are read and shuffled once: bounds are a window over the image.
    """
    exg = pixels.select(key, "y", "x", excess_green().alias("exg"))
    low, high = HEAT_PERCENTILES
    bounds = F.percentile("exg", F.array(F.lit(low), F.lit(high))).over(Window.partitionBy(key))
    bounded = exg.withColumn("p", bounds).withColumns({"lo": F.col("p")[0], "hi": F.col("p")[1]})
    scaled = clamp(F.try_divide(F.col("exg") - F.col("lo"), F.col("hi") - F.col("lo")), 0.0, 1.0)
    level = F.when(F.col("hi") <= F.col("lo"), 0).otherwise(F.floor(scaled * 255.0)).cast("int")
    return bounded.select(key, "y", "x", level.alias("level"))


def kernel(sigma: float = HEAT_SIGMA) -> list[float]:
    """Normalised Gaussian weights for offsets ``-radius..radius``; three sigma each side, as for 8-bit images."""
    radius = (round(sigma * 6 + 1) | 1) // 2
    weights = [exp(-(o * o) / (2.0 * sigma * sigma)) for o in range(-radius, radius + 1)]
    total = sum(weights)
    return [w / total for w in weights]


def _mixing(width: int, weights: list[float]) -> np.ndarray:
    """Matrix that smooths a line of ``width`` values, with mirrored borders (the border value is not repeated)."""
    radius = len(weights) // 2
    targets = np.repeat(np.arange(width), len(weights))
    reach = targets + np.tile(np.arange(-radius, radius + 1), width)
    period = max(2 * (width - 1), 1)
    folded = np.abs(reach) % period
    sources = np.minimum(folded, period - folded) if width > 1 else np.zeros_like(folded)
    matrix = np.zeros((width, width))
    np.add.at(matrix, (sources, targets), np.tile(weights, width))
    return matrix


def smoothed_line(line: str, sigma: float = HEAT_SIGMA) -> Column:
    """A scanline smoothed along itself.

    Arrow batches of lines meet one small matrix per line length. The built-in alternative, dozens of ``lag`` and
    ``lead`` terms or array lambdas per pixel, was many times slower.
    """
    weights = kernel(sigma)

    @F.pandas_udf("array<double>")
    def smooth(lines: pd.Series) -> pd.Series:
        lengths = lines.map(len).to_numpy()
        result = np.empty(len(lines), dtype=object)
        for width in np.unique(lengths):
            places = np.flatnonzero(lengths == width)
            mixed = np.stack(lines.iloc[places].to_list()).astype(float) @ _mixing(int(width), weights)
            for place, row in zip(places, mixed, strict=True):
                result[place] = row
        return pd.Series(result)

    return smooth(line)


def _smooth_axis(grid: DataFrame, key: str, along: str, across: str, sigma: float) -> DataFrame:
    """One axis: gather lines (as long as the image is wide or high), smooth them, and unfold them again.

    A line with a missing or repeated pixel is an error.
    """
    cells = F.array_sort(F.collect_list(F.struct(along, "value")))
    lines = grid.groupBy(key, across).agg(cells.alias("cells")).select(key, across, whole_line("cells", along, key).alias("line"))
    return lines.select(key, across, F.posexplode(smoothed_line("line", sigma)).alias(along, "value"))


def smoothed(grid: DataFrame, value: str = "level", key: str = KEY, sigma: float = HEAT_SIGMA) -> DataFrame:
    """Gaussian smoothing, one axis after the other: ``(image_path, y, x, <value>)`` as doubles.

    Two shuffles, by image and row and by image and column, so a big image is spread over many tasks.
    """
    table = grid.select(key, "y", "x", F.col(value).cast("double").alias("value"))
    rows = _smooth_axis(table, key, "x", "y", sigma)
    both = _smooth_axis(rows, key, "y", "x", sigma)
    return both.select(key, "y", "x", F.col("value").alias(value))


def heat_summary(pixels: DataFrame, key: str = KEY) -> DataFrame:
    """Vegetation coverage and excess-green range per image."""
    exg = pixels.select(key, excess_green().alias("exg"))
    return exg.groupBy(key).agg(
        F.avg(vegetation_mask().cast("double")).alias("vegetation_coverage_ratio"),
        F.min("exg").alias("exg_min"),
        F.max("exg").alias("exg_max"),
    )
