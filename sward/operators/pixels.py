"""Per-image features from a pixel table ``(image_path, y, x, r, g, b)`` with 8-bit channels.

Colour statistics are one mergeable aggregate per image: every task reduces its own pixels before the shuffle. Texture and
edges read neighbours: their pixels are shuffled once, by image, so that an image (whose size is bounded by the camera)
is in one task; its rows become arrays, in which neighbours are positions, and nothing is shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sward.constants import EXG_THRESHOLD, GLCM_DISTANCES, GREY_LEVELS, HIST_BINS, IMAGE_SIDE, KEY
from sward.functions.color import grey8, vegetation_mask, with_colour_bands
from sward.functions.scalars import padded_name, truncated_level

# Histogram ranges of the HSV channels.
HIST_RANGE = {"h": (0, 180), "s": (0, 256), "v": (0, 256)}
TEXTURE = ("contrast", "dissimilarity", "homogeneity", "energy", "correlation")


def resample_area(
    pixels: DataFrame,
    width: int = IMAGE_SIDE,
    height: int = IMAGE_SIDE,
    bands: Sequence[str] = ("r", "g", "b"),
    key: str = KEY,
    whole: bool = True,
    source: tuple[int, int] | None = None,
) -> DataFrame:
    """Bring every image to ``width x height``: shrunk by averaging over covered areas, enlarged by interpolation.

    Works for fractional factors: a source pixel is shared among the target cells it overlaps, weighted by the
    overlap, and the shares combine before the shuffle. Where either side grows, cells are mixed from two source
    positions along each axis instead, in proportion to the part of the cell that reaches into the second, as area
    resampling does when it enlarges. With ``source`` as the common (width, height) of all images
    nothing is joined; otherwise each image's size is found first and joined by key, where AQE splits a hot image.
    With ``whole`` the averages are rounded back to 8-bit levels.
    """
    if source:
        sized = pixels.withColumns({"w": F.lit(source[0]), "h": F.lit(source[1])})
    else:
        sized = pixels.join(pixels.groupBy(key).agg((F.max("x") + 1).alias("w"), (F.max("y") + 1).alias("h")), on=key)
    grows = f"(w < {width} OR h < {height})"

    def cells(position: str, size: str, target: int) -> Column:
        scale = f"({float(target)}D / {size})"
        first, last = f"int(floor({position} * {scale}))", f"int(least(ceil(({position} + 1) * {scale}) - 1, {target - 1}))"
        overlap = f"least(({position} + 1) * {scale}, c + 1D) - greatest({position} * {scale}, double(c))"
        # The first of a cell's two positions, and the part of the cell behind it, which the second gets (the last one has no next).
        left, part = f"((c * {size}) div {target})", f"greatest((c + 1) - ((c * {size}) div {target} + 1) * {scale}, 0D)"
        mixed = f"IF({left} = {position}, 1 - {part}, 0D) + IF(least({left} + 1, {size} - 1) = {position}, {part}, 0D)"
        near = f"int(greatest(floor(({position} - 1) * {scale}), 0)), int(least(ceil(({position} + 1) * {scale}), {target - 1}))"
        shares = f"""IF({grows}, transform(sequence({near}), c -> struct(c AS cell, double({mixed}) AS weight)),
            transform(sequence({first}, {last}), c -> struct(c AS cell, double({overlap}) AS weight)))"""
        return F.expr(f"explode(filter({shares}, s -> s.weight > 1e-9))")

    spread = (
        sized.withColumn("cx", cells("x", "w", width))
        .withColumn("cy", cells("y", "h", height))
        .withColumn("weight", F.col("cx.weight") * F.col("cy.weight"))
    )

    def mean(band: str) -> Column:
        value = F.sum(F.col(band) * F.col("weight")) / F.sum("weight")
        return (F.rint(value).cast("int") if whole else value).alias(band)

    return spread.groupBy(key, F.col("cy.cell").alias("y"), F.col("cx.cell").alias("x")).agg(*[mean(b) for b in bands])


def _moments(band: str, name: str) -> list[str]:
    # Medians buffer distinct values only: at most 256 levels per channel, whatever the number of pixels.
    return [f"avg({band}) AS {name}_mean", f"stddev_pop({band}) AS {name}_std", f"median({band}) AS {name}_median"]


def _masked_mean(mask: str, band: str, name: str) -> str:
    return f"coalesce(avg({band}) FILTER (WHERE {mask}), 0D) AS {name}"


def _histogram(band: str, bins: int) -> list[str]:
    return [f"count_if({band}_bin = {i + 1}) / count(1) AS {padded_name(f'hist_{band}_', i, 2)}" for i in range(bins)]


def colour_features(
    pixels: DataFrame, key: str = KEY, bins: int = HIST_BINS, threshold: float = EXG_THRESHOLD
) -> DataFrame:
    """RGB, HSV, excess-green, vegetation, brown and histogram features: one row per image, one aggregate.

    Columns that a caller does not select are pruned from the aggregate.
    """
    banded = with_colour_bands(pixels)
    if threshold != EXG_THRESHOLD:
        banded = banded.withColumn("vegetation", vegetation_mask("exg", threshold))
    # width_bucket numbers from 1 and puts the upper bound into an extra bucket; the last bin is closed.
    placed = [
        f"least(width_bucket({b}, {float(low)}D, {float(high)}D, {bins}), {bins}) AS {b}_bin" for b, (low, high) in HIST_RANGE.items()
    ]
    banded = banded.selectExpr(key, *"rgbhsv", "exg", "vegetation", "brown", *placed)
    columns = [c for band in "rgb" for c in _moments(band, f"rgb_{band}")]
    columns += [c for band in "hsv" for c in _moments(band, f"hsv_{band}")]
    # Excess green depends on g and r+g+b only, which bounds its distinct values per image, hence the median's buffer.
    columns += [*_moments("exg", "exg"), "min(exg) AS exg_min", "max(exg) AS exg_max"]
    columns.append("avg(double(vegetation)) AS vegetation_coverage_ratio")
    columns += [_masked_mean("vegetation", band, f"vegetation_rgb_{band}_mean") for band in "rgb"]
    columns += [_masked_mean("vegetation", band, f"vegetation_{band}_mean") for band in "hsv"]
    columns.append("avg(double(brown)) AS brown_coverage_ratio")
    columns += [_masked_mean("brown", band, f"brown_rgb_{band}_mean") for band in "rgb"]
    for band in "hsv":
        columns += _histogram(band, bins)
    return banded.groupBy(key).agg(*[F.expr(c) for c in columns])


def colour_feature_names(bins: int = HIST_BINS) -> list[str]:
    """Names in canonical order."""
    stats = ("mean", "std", "median")
    names = [f"rgb_{b}_{s}" for b in "rgb" for s in stats] + [f"hsv_{b}_{s}" for b in "hsv" for s in stats]
    names += [f"exg_{s}" for s in ("mean", "std", "median", "min", "max")]
    names += ["vegetation_coverage_ratio"]
    names += [f"vegetation_rgb_{b}_mean" for b in "rgb"] + [f"vegetation_{b}_mean" for b in "hsv"]
    names += ["brown_coverage_ratio"] + [f"brown_rgb_{b}_mean" for b in "rgb"]
    return names + [padded_name(f"hist_{b}_", i, 2) for b in "hsv" for i in range(bins)]


def visual_feature_names(bins: int = HIST_BINS) -> list[str]:
    return colour_feature_names(bins) + [f"texture_{p}" for p in TEXTURE] + ["edge_density"]


def whole_line(cells: str, along: str, key: str = KEY) -> Column:
    """The values of a sorted array of ``(along, value)``; a gap or a repeated position is an error.

    Neighbours are array positions, so a line that doesn't have every position once would give wrong pairs.
    """
    complete = F.col(f"{cells}.{along}").cast("array<int>") == F.sequence(F.lit(0), F.size(cells) - 1)
    problem = F.concat(F.lit(f"missing or repeated {along} in a line of "), F.col(key).cast("string"))
    return F.when(complete, F.col(f"{cells}.value")).otherwise(F.raise_error(problem))


def scanlines(pixels: DataFrame, value: Column, key: str = KEY, name: str = "line") -> DataFrame:
    """Rows of an image as arrays: ``(image_path, y, line)``; every line must have all its pixels, once.

    One shuffle by image, which also serves every later step that works within an image.
    """
    cells = F.array_sort(F.collect_list(F.struct("x", "value")))
    values = pixels.select(key, "y", "x", value.alias("value")).repartition(key)
    return values.groupBy(key, "y").agg(cells.alias("cells")).select(key, "y", whole_line("cells", "x", key).alias(name))


def grey_scanlines(pixels: DataFrame, key: str = KEY) -> DataFrame:
    return scanlines(pixels, grey8(), key)


def neighbour_pairs(
    lines: DataFrame, offsets: Sequence[tuple[int, int]], key: str = KEY, line: str = "line"
) -> DataFrame:
    """Pairs of values a fixed offset apart: ``(image_path, offset, a, b)``, offsets as ``(rows, columns)``.

    ``offset`` is the position in ``offsets``. Offsets within a row are array lookups. Other rows come from ``lead``
    over the scanlines of an image, which moves one array per row, not one row per pixel; a row that is absent has no
    pairs.
    """
    below = sorted({dy for dy, _ in offsets if dy})
    if any(dy < 0 for dy in below):
        raise ValueError("row offsets must not be negative; swap the pair instead")
    window = Window.partitionBy(key).orderBy("y")

    def line_below(dy: int) -> Column:
        # With rows absent, the one looked for is fewer steps ahead.
        steps = [F.when(F.lead("y", k).over(window) == F.col("y") + dy, F.lead(line, k).over(window)) for k in range(dy, 0, -1)]
        return F.coalesce(*steps).alias(f"{line}_{dy}")

    table = lines.select(key, "y", line, *[line_below(dy) for dy in below])

    def pair(index: int, dy: int, dx: int) -> Column:
        other = f"{line}_{dy}" if dy else line
        return F.struct(
            F.lit(index).alias("offset"),
            F.get(line, F.col("x")).alias("a"),
            F.when(F.col("x") + dx >= 0, F.get(other, F.col("x") + dx)).alias("b"),
        )

    pairs = F.array(*[pair(i, dy, dx) for i, (dy, dx) in enumerate(offsets)])
    return (
        table.withColumn("x", F.explode(F.sequence(F.lit(0), F.size(line) - 1)))
        .select(key, F.explode(pairs).alias("pair"))
        .select(key, "pair.offset", "pair.a", "pair.b")
        .where("b IS NOT NULL")
    )


def glcm_offsets(distances: Sequence[int], angles: Sequence[float] = (0.0,)) -> list[tuple[int, int]]:
    """(rows, columns) per distance and angle in radians; a pair that points upwards is reversed, as the matrix is symmetric."""
    from math import cos, sin

    offsets = []
    for distance in distances:
        for angle in angles:
            dy, dx = round(sin(angle) * distance), round(cos(angle) * distance)
            offsets.append((-dy, -dx) if dy < 0 else (dy, dx))
    return offsets


def texture_features(
    pixels: DataFrame,
    key: str = KEY,
    distances: Sequence[int] = GLCM_DISTANCES,
    angles: Sequence[float] = (0.0,),
    levels: int = GREY_LEVELS,
) -> DataFrame:
    """Grey-level co-occurrence texture, mean over distances and angles.

    The symmetric normalised matrix is never built: pairs are counted unordered, and every property is a sum over those
    counts (at most ``levels * (levels + 1) / 2`` per image and offset).
    """
    # Grey values become levels only here, so that edges read the very same scanlines and Spark shuffles them once.
    pairs = neighbour_pairs(grey_scanlines(pixels, key), glcm_offsets(distances, angles), key).select(
        key, "offset", truncated_level("a", levels).alias("a"), truncated_level("b", levels).alias("b")
    )
    counts = pairs.groupBy(key, "offset", F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    i, j, n = F.col("i"), F.col("j"), F.col("n")
    gap, total = (j - i).cast("double"), F.sum("n")
    # Each unordered count stands for two ordered ones off the diagonal, with half the weight each.
    energy = F.sqrt(F.sum(F.when(i == j, n * n).otherwise(n * n / 2.0))) / total
    mean = F.sum(n * (i + j) / 2.0) / total
    second = F.sum(n * (i * i + j * j) / 2.0) / total
    cross = F.sum(n * i * j) / total
    per_offset = counts.groupBy(key, "offset").agg(
        (F.sum(n * gap * gap) / total).alias("contrast"),
        (F.sum(n * gap) / total).alias("dissimilarity"),
        (F.sum(n / (1.0 + gap * gap)) / total).alias("homogeneity"),
        energy.alias("energy"),
        (second - mean * mean).alias("variance"),
        (cross - mean * mean).alias("covariance"),
    )
    # A flat image has no variance; its correlation is 1 by convention.
    flat = F.sqrt(F.greatest(F.col("variance"), F.lit(0.0))) < 1e-15
    correlation = F.when(flat, 1.0).otherwise(F.try_divide(F.col("covariance"), F.col("variance")))
    return (
        per_offset.withColumn("correlation", correlation)
        .groupBy(key)
        .agg(*[F.avg(p).alias(f"texture_{p}") for p in TEXTURE])
    )


def visual_features(pixels: DataFrame, key: str = KEY) -> DataFrame:
    """All 88 visual features per image, in canonical order; a missing or infinite value is an error.

    One aggregate over the pixels for colour; texture and edges read scanlines made from one shuffle of the grey values,
    by image. What is joined has one row per image.
    """
    from sward.operators.edges import edge_density

    images = colour_features(pixels, key)
    table = images.join(texture_features(pixels, key), on=key, how="left").join(edge_density(pixels, key), on=key, how="left")
    return table.selectExpr(
        key,
        *[
            f"""CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) AND abs({c}) <> double('infinity') THEN {c}
                ELSE double(raise_error(concat('{c} is not finite for ', string({key})))) END AS {c}"""
            for c in visual_feature_names()
        ],
    )
