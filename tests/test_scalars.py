import math

from conftest import rows
from pyspark.sql import functions as F

from sward.functions import color, scalars

NAN, INF = float("nan"), float("inf")


def one(spark, **columns):
    return rows(spark.range(1).select(*[c.alias(n) for n, c in columns.items()]))[0]


def test_clips_keep_null_and_nan(spark):
    df = spark.createDataFrame([(-2.0,), (0.5,), (9.0,), (None,), (NAN,)], "v double")
    out = [(r["a"], r["b"]) for r in df.select(scalars.clip_lower("v").alias("a"), scalars.clamp("v", 0.0, 1.0).alias("b")).collect()]
    assert out[:4] == [(0.0, 0.0), (0.5, 0.5), (9.0, 1.0), (None, None)]
    assert math.isnan(out[4][0]) and math.isnan(out[4][1])


def test_zero_denominators_give_null(spark):
    got = one(spark, pct=scalars.percentage_error(F.lit(0.0), F.lit(2.0)), density=scalars.density_kg_ha(F.lit(50.0), F.lit(0.25)), none=scalars.density_kg_ha(F.lit(1.0), F.lit(0.0)))
    assert got == {"pct": None, "density": 2000.0, "none": None}


def test_missing_and_finite(spark):
    df = spark.createDataFrame([(1.0,), (None,), (NAN,), (INF,), (-INF,)], "v double")
    got = [(r[0], r[1], r[2]) for r in df.select(scalars.is_missing("v"), scalars.is_finite("v"), F.coalesce(scalars.is_infinite("v"), F.lit(False))).collect()]
    assert got == [(False, True, False), (True, False, False), (True, False, False), (False, False, True), (False, False, True)]


def test_labels_and_names(spark):
    got = one(
        spark,
        known=scalars.lookup_label(F.lit("GDM_g")),
        unknown=scalars.lookup_label(F.lit("other")),
        title=scalars.sample_title(F.lit("Tas"), F.lit("Ryegrass_Clover")),
        blank=scalars.sample_title(F.lit("Tas"), F.lit(None).cast("string")),
        relative=scalars.under_base("/data/", F.lit("train/a.jpg")),
        absolute=scalars.under_base("/data/", F.lit("/x/a.jpg")),
    )
    assert got == {
        "known": "Green Dry Matter",
        "unknown": "other",
        "title": "Tas · Ryegrass Clover",
        "blank": "",
        "relative": "/data/train/a.jpg",
        "absolute": "/x/a.jpg",
    }


def test_feature_family(spark):
    df = spark.createDataFrame([("cnn_0001",), ("hist_h_00",), ("State_NSW",), ("Height_Ave_cm",), ("what",)], "f string")
    found = [r[0] for r in df.select(scalars.feature_family("f", ["State", "Height_Ave_cm"])).collect()]
    assert found == ["CNN", "Visual", "Metadata", "Metadata", "Other"]


def test_times(spark):
    got = one(spark, good=scalars.iso_seconds(scalars.parse_timestamp(F.lit("2024-05-06T07:08:09.5"))), bad=scalars.parse_timestamp(F.lit("soon")))
    assert got == {"good": "2024-05-06T07:08:09", "bad": None}


def test_levels_and_grid(spark):
    got = one(spark, top=scalars.truncated_level(F.lit(255), 32), under=scalars.truncated_level(F.lit(254), 32), grid=scalars.even_grid(4))
    assert got == {"top": 31, "under": 30, "grid": [0.0, 0.25, 0.5, 0.75, 1.0]}


def test_hsv_of_plain_colours(spark):
    colours = [(255, 0, 0), (0, 255, 0), (0, 0, 255), (0, 0, 0), (255, 255, 255), (255, 0, 1), (128, 64, 32)]
    df = spark.createDataFrame(colours, "r int, g int, b int")
    got = [tuple(r[0]) for r in df.select(color.hsv8()).collect()]
    assert got == [(0, 255, 255), (60, 255, 255), (120, 255, 255), (0, 0, 0), (0, 0, 255), (0, 255, 255), (10, 191, 128)]


def test_excess_green_and_grey(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 255, 0), (100, 100, 100), (255, 255, 255)], "r int, g int, b int")
    got = [(r[0], r[1]) for r in df.select(color.excess_green(), color.grey8()).collect()]
    assert got == [(0.0, 0), (2.0, 150), (0.0, 100), (0.0, 255)]
