"""Per-pixel colour expressions on 8-bit channels.

HSV and grey follow the public 8-bit fixed-point conventions of common image libraries (hue in 0..179, 12-bit
reciprocals for hue and saturation, 15-bit luma weights), so the results are whole numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sward.constants import BROWN_HUE, BROWN_MIN_VALUE, BROWN_SATURATION, EXG_THRESHOLD
from sward.functions.scalars import ColumnLike, as_column

# Luma weights 0.299 / 0.587 / 0.114 in units of 2**-15.
LUMA_RED, LUMA_GREEN, LUMA_BLUE, LUMA_SHIFT = 9798, 19235, 3735, 15
# Fixed value: binary digits of the reciprocals used for hue and saturation.
HSV_SHIFT = 12


def grey8(r: ColumnLike = "r", g: ColumnLike = "g", b: ColumnLike = "b") -> Column:
    weighted = as_column(r) * LUMA_RED + as_column(g) * LUMA_GREEN + as_column(b) * LUMA_BLUE
    return F.shiftright((weighted + F.lit(1 << (LUMA_SHIFT - 1))).cast("int"), LUMA_SHIFT)


def _scaled(value: Column, numerator: float, denominator: Column) -> Column:
    """``value * numerator / denominator`` with the reciprocal rounded to HSV_SHIFT binary digits first."""
    reciprocal = F.rint(F.lit(numerator * (1 << HSV_SHIFT)) / denominator)
    return F.floor((value * reciprocal + F.lit(float(1 << (HSV_SHIFT - 1)))) / F.lit(float(1 << HSV_SHIFT)))


def hsv8(r: ColumnLike = "r", g: ColumnLike = "g", b: ColumnLike = "b") -> Column:
    """Struct ``(h, s, v)`` of whole numbers; read it once per pixel and reuse the fields."""
    r, g, b = (as_column(c).cast("double") for c in (r, g, b))
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    spread = high - low
    saturation = F.when(high == 0, F.lit(0.0)).otherwise(_scaled(spread, 255.0, F.nullif(high, F.lit(0.0))))
    sector = (
        F.when(high == r, g - b)
        .when(high == g, b - r + 2.0 * spread)
        .otherwise(r - g + 4.0 * spread)
    )
    turned = _scaled(sector, 180.0 / 6.0, F.nullif(spread, F.lit(0.0)))
    hue = F.when(spread == 0, F.lit(0.0)).when(turned < 0, turned + 180.0).otherwise(turned)
    return F.struct(
        hue.cast("int").alias("h"), saturation.cast("int").alias("s"), high.cast("int").alias("v")
    )


def excess_green(r: ColumnLike = "r", g: ColumnLike = "g", b: ColumnLike = "b") -> Column:
    """2g - r - b on channels that sum to one; 0 for a black pixel."""
    r, g, b = (as_column(c).cast("double") for c in (r, g, b))
    total = r + g + b
    safe = F.when(total == 0, F.lit(1.0)).otherwise(total)
    return F.when(total == 0, F.lit(0.0)).otherwise(2.0 * (g / safe) - (r / safe) - (b / safe))


def vegetation_mask(exg: ColumnLike = "exg", threshold: float = EXG_THRESHOLD) -> Column:
    return as_column(exg) > F.lit(threshold)


def brown_mask(h: ColumnLike = "h", s: ColumnLike = "s", v: ColumnLike = "v") -> Column:
    return (
        as_column(h).between(*BROWN_HUE)
        & as_column(s).between(*BROWN_SATURATION)
        & (as_column(v) >= F.lit(BROWN_MIN_VALUE))
    )


def with_colour_bands(pixels):
    """Add ``h, s, v, exg, vegetation, brown`` to a pixel table, each computed once."""
    return (
        pixels.withColumn("hsv", hsv8())
        .withColumn("exg", excess_green())
        .select(*pixels.columns, "hsv.h", "hsv.s", "hsv.v", "exg")
        .withColumn("vegetation", vegetation_mask())
        .withColumn("brown", brown_mask())
    )
