import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sward.operators import edges, heatgrid, pixels

SCHEMA = "image_path string, y int, x int, r int, g int, b int"


def frame(spark, **images):
    data = [
        (name, y, x, *map(int, image[y, x])) for name, image in images.items() for y in range(image.shape[0]) for x in range(image.shape[1])
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(5)
    smooth = np.zeros((24, 20, 3), int)
    yy, xx = np.mgrid[0:24, 0:20]
    smooth[..., 0] = 120 + 100 * ((xx - 10) ** 2 + (yy - 12) ** 2 < 36)
    smooth[..., 1] = 90 + 6 * yy
    smooth[..., 2] = 30
    return {
        "noise": rng.integers(0, 256, (12, 10, 3)),
        "disc": smooth,
        "black": np.zeros((6, 6, 3), int),
        "flat": np.full((6, 7, 3), 77),
    }


@pytest.fixture(scope="module")
def table(spark, images):
    return frame(spark, **images).cache()


def grey(image):
    return (image @ np.array([9798, 19235, 3735]) + 16384) >> 15


def test_visual_features_of_every_kind_of_image(table, images):
    got = {r["image_path"]: r for r in rows(pixels.visual_features(table))}
    assert set(got) == set(images) and list(got["noise"])[1:] == pixels.visual_feature_names()
    assert len(pixels.visual_feature_names()) == 88
    for name, r in got.items():
        assert all(math.isfinite(v) for k, v in r.items() if k != "image_path")
        for band in "hsv":
            assert sum(r[f"hist_{band}_{i:02d}"] for i in range(16)) == pytest.approx(1.0)
        assert 0 <= r["vegetation_coverage_ratio"] <= 1 and 0 <= r["brown_coverage_ratio"] <= 1
        for i, band in enumerate("rgb"):
            channel = images[name][..., i]
            assert r[f"rgb_{band}_mean"] == pytest.approx(channel.mean())
            assert r[f"rgb_{band}_std"] == pytest.approx(channel.std())
            assert r[f"rgb_{band}_median"] == pytest.approx(np.median(channel))
    assert got["black"]["exg_mean"] == 0 and got["black"]["vegetation_rgb_g_mean"] == 0
    assert got["flat"]["texture_correlation"] == 1 and got["flat"]["texture_energy"] == 1 and got["flat"]["edge_density"] == 0


def glcm(levels, dy, dx):
    height, width = levels.shape
    matrix = np.zeros((32, 32))
    for y in range(height):
        for x in range(width):
            if 0 <= y + dy < height and 0 <= x + dx < width:
                matrix[levels[y, x], levels[y + dy, x + dx]] += 1
    matrix = matrix + matrix.T
    return matrix / matrix.sum()


@pytest.mark.parametrize("angles", [(0.0,), (0.0, math.pi / 4, math.pi / 2, 3 * math.pi / 4)])
def test_texture_equals_the_matrix_definition(table, images, angles):
    got = {r["image_path"]: r for r in rows(pixels.texture_features(table, angles=angles))}
    i, j = np.mgrid[0:32, 0:32]
    for name in ("noise", "disc"):
        levels = np.floor(grey(images[name]) / 255.0 * 31).astype(int)
        found = []
        for distance in (1, 3, 5):
            for angle in angles:
                p = glcm(levels, round(math.sin(angle) * distance), round(math.cos(angle) * distance))
                mi, mj = (p * i).sum(), (p * j).sum()
                si, sj = math.sqrt((p * (i - mi) ** 2).sum()), math.sqrt((p * (j - mj) ** 2).sum())
                found.append(
                    [(p * (i - j) ** 2).sum(), (p * abs(i - j)).sum(), (p / (1 + (i - j) ** 2)).sum(), math.sqrt((p**2).sum()), (p * (i - mi) * (j - mj)).sum() / (si * sj)]
                )
        for prop, value in zip(pixels.TEXTURE, np.mean(found, axis=0)):
            assert got[name][f"texture_{prop}"] == pytest.approx(value)


def brute_edges(image, low=50, high=150):
    g = np.pad(grey(image).astype(int), 1, mode="edge")
    h, w = image.shape[:2]
    gx, gy = np.zeros((h, w), int), np.zeros((h, w), int)
    for y in range(h):
        for x in range(w):
            n = g[y : y + 3, x : x + 3]
            gx[y, x] = (n[:, 2] - n[:, 0]) @ [1, 2, 1]
            gy[y, x] = (n[2] - n[0]) @ [1, 2, 1]
    m = np.pad(abs(gx) + abs(gy), 1)
    keep = {}
    for y in range(h):
        for x in range(w):
            c, ax, ay = m[y + 1, x + 1], abs(int(gx[y, x])), abs(int(gy[y, x])) << 15
            if c <= low:
                continue
            if ay < ax * 13573:
                ok = c > m[y + 1, x] and c >= m[y + 1, x + 2]
            elif ay > ax * 13573 + (ax << 16):
                ok = c > m[y, x + 1] and c >= m[y + 2, x + 1]
            else:
                s = -1 if (gx[y, x] < 0) != (gy[y, x] < 0) else 1
                ok = c > m[y, x + 1 - s] and c > m[y + 2, x + 1 + s]
            if ok:
                keep[y, x] = c > high
    found = [p for p, strong in keep.items() if strong]
    seen = set(found)
    while found:
        y, x = found.pop()
        for q in [(y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]:
            if q in keep and q not in seen:
                seen.add(q)
                found.append(q)
    return seen


def test_edges_equal_brute_force(table, images):
    got = rows(edges.edge_pixels(table))
    density = {r["image_path"]: r["edge_density"] for r in rows(edges.edge_density(table))}
    for name, image in images.items():
        expected = brute_edges(image)
        assert {(r["y"], r["x"]) for r in got if r["image_path"] == name} == expected
        assert density[name] == pytest.approx(len(expected) / image[..., 0].size)
    assert density["disc"] > 0


def test_weak_chain_is_linked_whole(spark):
    chain = [("i", 0, x, x == 0) for x in range(200)] + [("i", 5, x, False) for x in range(50)]
    found = spark.createDataFrame(chain, "image_path string, y int, x int, strong boolean")
    kept = found.groupBy("image_path").applyInArrow(edges._link, "image_path string, y int, x int")
    assert kept.count() == 200


def test_resampling_keeps_the_mean_and_known_sizes(spark, images):
    table = frame(spark, noise=images["noise"])
    small = pixels.resample_area(table, 5, 4, whole=False)
    got = small.agg(F.count(F.lit(1)).alias("n"), F.avg("r").alias("r")).first()
    assert got["n"] == 20 and got["r"] == pytest.approx(images["noise"][..., 0].mean())
    fixed = pixels.resample_area(table, 5, 4, whole=False, source=(10, 12))
    for a, b in zip(rows(small, "y", "x"), rows(fixed, "y", "x"), strict=True):
        assert list(a.values())[1:] == pytest.approx(list(b.values())[1:])


def test_enlarging_mixes_two_positions_along_each_axis(table, images):
    def lines(grid, cells, axis):
        """A matrix product with one row of weights per target cell."""
        size = grid.shape[axis]
        weights = np.zeros((cells, size))
        for c in range(cells):
            left = c * size // cells
            part = max(c + 1 - (left + 1) * cells / size, 0.0)
            weights[c, left] += 1 - part
            weights[c, min(left + 1, size - 1)] += part
        return np.moveaxis(np.tensordot(weights, grid, (1, axis)), 0, axis)

    height, width = images["noise"].shape[:2]
    for size in ((width * 2 + 3, height * 3), (width * 2, max(1, height - 1))):
        large = pixels.resample_area(table.where("image_path = 'noise'"), *size, bands=("r",), whole=False)
        got = {(r["y"], r["x"]): r["r"] for r in large.collect()}
        expected = lines(lines(images["noise"][..., 0].astype(float), size[1], 0), size[0], 1)
        assert len(got) == size[0] * size[1]
        assert [got[y, x] for y in range(size[1]) for x in range(size[0])] == pytest.approx(list(expected.ravel()))
    same = pixels.resample_area(table.where("image_path = 'noise'"), width, height, bands=("r",))
    assert {(r["y"], r["x"]): r["r"] for r in same.collect()} == {(y, x): int(v) for (y, x), v in np.ndenumerate(images["noise"][..., 0])}


def test_stretch_and_smoothing(table, images):
    levels = pixels_by_image(rows(heatgrid.stretched(table)), images, "level")
    assert levels["flat"].max() == 0 and levels["noise"].max() == 255 and levels["noise"].min() == 0
    smooth = pixels_by_image(rows(heatgrid.smoothed(heatgrid.stretched(table), sigma=2.0)), images, "level")
    weights = np.array(heatgrid.kernel(2.0))
    radius = len(weights) // 2
    for name, grid in levels.items():
        padded = np.pad(grid.astype(float), radius, mode="reflect")
        lines = np.apply_along_axis(lambda v: np.convolve(v, weights, "valid"), 1, padded)
        assert smooth[name] == pytest.approx(np.apply_along_axis(lambda v: np.convolve(v, weights, "valid"), 0, lines))


def test_smoothing_of_single_pixel_lines(spark):
    grid = spark.createDataFrame([("i", 0, x, float(x)) for x in range(3)], "image_path string, y int, x int, level double")
    got = [r["level"] for r in rows(heatgrid.smoothed(grid, sigma=1.0), "x")]
    assert len(got) == 3 and got[1] == pytest.approx(1.0)


def pixels_by_image(found, images, value):
    grids = {name: np.zeros(image.shape[:2]) for name, image in images.items()}
    for r in found:
        grids[r["image_path"]][r["y"], r["x"]] = r[value]
    return grids


def test_absent_and_repeated_pixels_are_refused(spark):
    whole = frame(spark, a=np.arange(48).reshape(4, 4, 3) % 256)
    hole = whole.where("NOT (y = 2 AND x = 2)")
    twice = whole.union(whole.where("y = 1 AND x = 1"))
    for broken in (hole, twice):
        for feature in (pixels.texture_features, edges.edge_density):
            with pytest.raises(Exception, match="missing or repeated x"):
                feature(broken).collect()
        with pytest.raises(Exception, match="missing or repeated"):
            heatgrid.smoothed(heatgrid.stretched(broken)).collect()


def test_absent_lines_have_no_pairs_and_no_edges(spark):
    whole = frame(spark, a=np.arange(48).reshape(4, 4, 3) % 256)
    gap = whole.where("y <> 1")
    lines = pixels.grey_scanlines(gap)
    found = pixels.neighbour_pairs(lines, [(1, 0), (2, 0)]).groupBy("offset").count().collect()
    assert {r["offset"]: r["count"] for r in found} == {0: 4, 1: 4}
    with pytest.raises(Exception, match="missing line"):
        edges.edge_density(gap).collect()


def test_linking_has_no_size_limit_and_follows_long_chains():
    import pyarrow as pa

    # A serpentine of weak pixels over a 2000 x 1000 grid, one strong pixel at its end, and an island that stays weak.
    ys, xs = [], []
    for i, y in enumerate(range(0, 1990, 10)):
        ys += [y] * 1000 + [y + k for k in range(1, 10)]
        xs += list(range(1000)) + [999 if i % 2 == 0 else 0] * 9
    strong = np.zeros(len(ys), bool)
    strong[0] = True
    table = pa.table({"image_path": ["a"] * (len(ys) + 2), "y": [*ys, 1999, 1999], "x": [*xs, 500, 501], "strong": [*strong, False, False]})
    kept = edges._link(table)
    assert kept.num_rows == len(ys)
