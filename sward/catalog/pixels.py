"""Image features from the pixel table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sward.catalog import base, query
from sward.catalog.oracle import r, sql
from sward.constants import KEY
from sward.functions import color
from sward.operators import edges, heatgrid, pixels
from sward.sources import views

STATS = ("mean", "std", "median")


def _stats(band: str, name: str) -> list[str]:
    return [r(f"avg({band})", f"{name}_mean"), r(f"stddev_pop({band})", f"{name}_std"), r(f"median({band})", f"{name}_median")]


def _masked(mask: str, band: str, name: str) -> str:
    return r(f"coalesce(avg({band}) FILTER ({mask}), 0)", name)


def _bins(band: str, high: float) -> list[str]:
    place = f"least(CAST(floor({band} / ({high} / 16.0)) AS INTEGER), 15)"
    return [r(f"CAST(count(*) FILTER ({place} = {i}) AS DOUBLE) / count(*)", f"hist_{band}_{i:02d}") for i in range(16)]


RGB = [c for b in "rgb" for c in _stats(b, f"rgb_{b}")]
HSV = [c for b in "hsv" for c in _stats(b, f"hsv_{b}")]
EXG = [*_stats("exg", "exg"), r("min(exg)", "exg_min"), r("max(exg)", "exg_max")]
COVERAGE = [r("avg(CASE WHEN veg THEN 1.0 ELSE 0.0 END)", "vegetation_coverage_ratio")]
VEGETATION = [_masked("veg", b, f"vegetation_rgb_{b}_mean") for b in "rgb"] + [_masked("veg", b, f"vegetation_{b}_mean") for b in "hsv"]
BROWN = [r("avg(CASE WHEN brown THEN 1.0 ELSE 0.0 END)", "brown_coverage_ratio")] + [_masked("brown", b, f"brown_rgb_{b}_mean") for b in "rgb"]
HISTOGRAMS = [*_bins("h", 180.0), *_bins("s", 256.0), *_bins("v", 256.0)]
TEXTURE = [r(f"texture_{p}", f"texture_{p}") for p in pixels.TEXTURE]


def _per_image(columns: list[str]) -> str:
    return sql(f"SELECT image_path, {', '.join(columns)} FROM bands GROUP BY image_path")


def _colour(spark, folder, *names: str):
    return base.rounded(pixels.colour_features(views.pixels(spark, folder)).select(KEY, *names))


@query(
    "j1_half_size",
    sql("""SELECT image_path, CAST(y // 2 AS INTEGER) AS y, CAST(x // 2 AS INTEGER) AS x, CAST(round_even(avg(r), 0) AS INTEGER) AS r,
        CAST(round_even(avg(g), 0) AS INTEGER) AS g, CAST(round_even(avg(b), 0) AS INTEGER) AS b FROM pixels GROUP BY 1, 2, 3"""),
)
def j1_half_size(spark, folder):
    return pixels.resample_area(views.pixels(spark, folder), 4, 4, source=(8, 8)).select(KEY, F.col("y").cast("int"), F.col("x").cast("int"), "r", "g", "b")


def _covered(axis: str, cell: str, cells: int) -> str:
    scale = f"{cells} / 8.0::DOUBLE"
    return f"greatest(least(({axis} + 1) * {scale}, {cell} + 1) - greatest({axis} * {scale}, {cell}), 0)"


@query(
    "j1_resample",
    sql(f"""SELECT image_path, CAST(ty AS INTEGER) AS y, CAST(tx AS INTEGER) AS x, {r('sum(r * w) / sum(w)', 'r')}, {r('sum(g * w) / sum(w)', 'g')}, {r('sum(b * w) / sum(w)', 'b')}
        FROM (SELECT *, {_covered('y', 'ty', 3)} * {_covered('x', 'tx', 5)} AS w FROM pixels, range(3) t(ty), range(5) u(tx))
        WHERE w > 1e-9 GROUP BY image_path, ty, tx"""),
)
def j1_resample(spark, folder):
    small = pixels.resample_area(views.pixels(spark, folder), 5, 3, whole=False)
    return base.rounded(small.select(KEY, F.col("y").cast("int"), F.col("x").cast("int"), "r", "g", "b"))


def _mixed(axis: str, cell: str, cells: int, side: int = 8) -> str:
    left, part = f"({cell} * {side} // {cells})", f"greatest({cell} + 1 - ({cell} * {side} // {cells} + 1) * ({cells} / {side}.0::DOUBLE), 0)"
    return f"(CASE WHEN {axis} = {left} THEN 1 - {part} ELSE 0 END + CASE WHEN {axis} = least({left} + 1, {side - 1}) THEN {part} ELSE 0 END)"


def _enlarge_sql(width: int, height: int) -> str:
    return sql(f"""SELECT image_path, CAST(ty AS INTEGER) AS y, CAST(tx AS INTEGER) AS x, {r('sum(r * w) / sum(w)', 'r')}, {r('sum(g * w) / sum(w)', 'g')}, {r('sum(b * w) / sum(w)', 'b')}
        FROM (SELECT *, {_mixed('y', 'ty', height)} * {_mixed('x', 'tx', width)} AS w FROM pixels, range({height}) t(ty), range({width}) u(tx))
        WHERE w > 1e-9 GROUP BY image_path, ty, tx""")


@query("j1_enlarge", _enlarge_sql(20, 12))
def j1_enlarge(spark, folder):
    large = pixels.resample_area(views.pixels(spark, folder), 20, 12, whole=False)
    return base.rounded(large.select(KEY, F.col("y").cast("int"), F.col("x").cast("int"), "r", "g", "b"))


@query("j1_enlarge_one_side", _enlarge_sql(5, 11))
def j1_enlarge_one_side(spark, folder):
    """Wider than high before, higher than wide after: both axes interpolate as soon as one of them grows."""
    tall = pixels.resample_area(views.pixels(spark, folder), 5, 11, whole=False, source=(8, 8))
    return base.rounded(tall.select(KEY, F.col("y").cast("int"), F.col("x").cast("int"), "r", "g", "b"))


@query("j2_rgb", _per_image(RGB))
def j2_rgb(spark, folder):
    return _colour(spark, folder, *[f"rgb_{b}_{s}" for b in "rgb" for s in STATS])


@query("j3_hsv_pixels", sql("SELECT image_path, y, x, h, s, v FROM hsv"))
def j3_hsv_pixels(spark, folder):
    return color.with_colour_bands(views.pixels(spark, folder)).select(KEY, "y", "x", "h", "s", "v")


@query("j4_hsv", _per_image(HSV))
def j4_hsv(spark, folder):
    return _colour(spark, folder, *[f"hsv_{b}_{s}" for b in "hsv" for s in STATS])


@query("j5_exg_pixels", sql(f"SELECT image_path, y, x, {r('exg', 'exg', 9)} FROM hsv"))
def j5_exg_pixels(spark, folder):
    return base.rounded(views.pixels(spark, folder).select(KEY, "y", "x", color.excess_green().alias("exg")), 9)


@query("j6_exg", _per_image(EXG))
def j6_exg(spark, folder):
    return _colour(spark, folder, *[f"exg_{s}" for s in (*STATS, "min", "max")])


@query("j7_vegetation_mask", sql("SELECT image_path, y, x, exg > 0.05 AS vegetation FROM hsv"))
def j7_vegetation_mask(spark, folder):
    exg = views.pixels(spark, folder).select(KEY, "y", "x", color.excess_green().alias("exg"))
    return exg.select(KEY, "y", "x", color.vegetation_mask("exg", 0.05).alias("vegetation"))


@query("j8_vegetation_coverage", _per_image(COVERAGE))
def j8_vegetation_coverage(spark, folder):
    return _colour(spark, folder, "vegetation_coverage_ratio")


@query("j9_vegetation_colour", _per_image(VEGETATION))
def j9_vegetation_colour(spark, folder):
    return _colour(spark, folder, *[f"vegetation_rgb_{b}_mean" for b in "rgb"], *[f"vegetation_{b}_mean" for b in "hsv"])


@query("j10_brown_mask", sql("SELECT image_path, y, x, brown FROM bands"))
def j10_brown_mask(spark, folder):
    return color.with_colour_bands(views.pixels(spark, folder)).select(KEY, "y", "x", "brown")


@query("j11_brown", _per_image(BROWN))
def j11_brown(spark, folder):
    return _colour(spark, folder, "brown_coverage_ratio", *[f"brown_rgb_{b}_mean" for b in "rgb"])


@query("j12_histograms", _per_image(HISTOGRAMS))
def j12_histograms(spark, folder):
    return _colour(spark, folder, *[f"hist_{b}_{i:02d}" for b in "hsv" for i in range(16)])


@query("j13_glcm", sql(f"SELECT image_path, {', '.join(TEXTURE)} FROM texture"))
def j13_glcm(spark, folder):
    return base.rounded(pixels.texture_features(views.pixels(spark, folder)))


@query("j14_gradients", sql("SELECT image_path, y, x, gx, gy, m AS magnitude FROM magnitudes"))
def j14_gradients(spark, folder):
    return edges.gradients(views.pixels(spark, folder)).drop("thinned")


@query("j14_candidates", sql("SELECT image_path, y, x, strong FROM candidates"))
def j14_candidates(spark, folder):
    return edges.edge_candidates(views.pixels(spark, folder))


@query("j14_edges", sql(f"SELECT image_path, {r('edge_density', 'edge_density')} FROM edge_share"))
def j14_edges(spark, folder):
    return base.rounded(edges.edge_density(views.pixels(spark, folder)))


@query(
    "j15_visual_features",
    sql(f"""SELECT * FROM (SELECT image_path, {', '.join(RGB + HSV + EXG + COVERAGE + VEGETATION + BROWN + HISTOGRAMS)} FROM bands GROUP BY image_path)
        JOIN (SELECT image_path, {', '.join(TEXTURE)} FROM texture) USING (image_path)
        JOIN (SELECT image_path, {r('edge_density', 'edge_density')} FROM edge_share) USING (image_path)"""),
)
def j15_visual_features(spark, folder):
    return base.rounded(pixels.visual_features(views.pixels(spark, folder)))


@query(
    "j16_batch",
    sql(f"""SELECT image_path, fold, {r('avg(v)', 'hsv_v_mean')}, any_value(texture_contrast) AS texture_contrast, any_value(edge_density) AS edge_density
        FROM bands JOIN samples USING (image_path) JOIN (SELECT image_path, {TEXTURE[0]} FROM texture) USING (image_path)
        JOIN (SELECT image_path, {r('edge_density', 'edge_density')} FROM edge_share) USING (image_path) GROUP BY image_path, fold"""),
)
def j16_batch(spark, folder):
    """Features of all images next to their folds; unused features are pruned from the aggregates."""
    features = pixels.visual_features(views.pixels(spark, folder)).select(KEY, "hsv_v_mean", "texture_contrast", "edge_density")
    return base.rounded(features.join(views.samples(spark, folder).select(KEY, "fold"), on=KEY))


_STRETCH = """
    SELECT image_path, y, x, CASE WHEN hi <= lo THEN 0
        ELSE CAST(floor(least(greatest((exg - lo) / (hi - lo), 0), 1) * 255.0::DOUBLE) AS INTEGER) END AS level
    FROM hsv JOIN (SELECT image_path, quantile_cont(exg, 0.02) AS lo, quantile_cont(exg, 0.98) AS hi FROM hsv GROUP BY image_path) USING (image_path)"""


@query("j18_stretch", sql(_STRETCH))
def j18_stretch(spark, folder):
    return heatgrid.stretched(views.pixels(spark, folder))


_SIGMA = 1.5


def _smooth_sql(sigma: float) -> str:
    """Both axes at once: every pixel sums a square of neighbours, with positions mirrored at the borders."""
    radius = (round(sigma * 6 + 1) | 1) // 2
    weight = f"exp(-(o * o) / (2.0 * {sigma} * {sigma}))"

    def mirrored(p: str) -> str:
        return f"(7 - abs(((({p}) % 14) + 14) % 14 - 7))"

    body = sql(f"SELECT image_path FROM ({_STRETCH})")
    views_only = body.rsplit("\nSELECT image_path FROM", 1)[0]
    return f"""{views_only},
        stretch AS ({_STRETCH}),
        taps AS (SELECT o, {weight} / (SELECT sum({weight}) FROM range({-radius}, {radius + 1}) t(o)) AS w FROM range({-radius}, {radius + 1}) t(o)),
        rows_done AS (SELECT a.image_path, a.y, a.x, sum(w * b.level) AS level FROM stretch a, taps, stretch b
            WHERE b.image_path = a.image_path AND b.y = a.y AND b.x = {mirrored('a.x + o')} GROUP BY 1, 2, 3)
        SELECT a.image_path, a.y, a.x, {r('sum(w * b.level)', 'level')} FROM rows_done a, taps, rows_done b
        WHERE b.image_path = a.image_path AND b.x = a.x AND b.y = {mirrored('a.y + o')} GROUP BY 1, 2, 3"""


@query("j19_smooth", _smooth_sql(7.0))
def j19_smooth(spark, folder):
    return base.rounded(heatgrid.smoothed(heatgrid.stretched(views.pixels(spark, folder))))


@query("j19_smooth_narrow", _smooth_sql(_SIGMA))
def j19_smooth_narrow(spark, folder):
    return base.rounded(heatgrid.smoothed(heatgrid.stretched(views.pixels(spark, folder)), sigma=_SIGMA))


@query("j20_heat_summary", _per_image([*COVERAGE, *EXG[-2:]]))
def j20_heat_summary(spark, folder):
    return base.rounded(heatgrid.heat_summary(views.pixels(spark, folder)))
