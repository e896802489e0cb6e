"""Views of the benchmark tables in the shape of the pipeline's inputs.

Images are keyed by ``image_path``. Orders stand for samples, line items for weighed components, stored embeddings for
8 x 8 images, events for the assessment log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.constants import KEY, N_FOLDS, TARGETS
from sward.operators.metrics import lengthen_targets
from sward.operators.preprocess import assign_folds
from sward.sources.tables import read_table

COMPONENTS = {"A": "Dry_Clover_g", "N": "Dry_Dead_g", "R": "Dry_Green_g"}
SIDE = 8


def path_of(number: str | Column) -> Column:
    return F.concat(F.lit("train/"), F.col(number) if isinstance(number, str) else number, F.lit(".jpg"))


def observed_components(spark: SparkSession, folder: str) -> DataFrame:
    """Raw long targets ``(image_path, target_name, target)``: only components that were weighed."""
    flags = F.create_map(*[F.lit(x) for item in COMPONENTS.items() for x in item])
    items = read_table(spark, folder, "lineitem").select(
        path_of("l_orderkey").alias(KEY), flags[F.col("l_returnflag")].alias("target_name"), "l_quantity"
    )
    return items.groupBy(KEY, "target_name").agg(F.sum("l_quantity").alias("target"))


def wide_targets(spark: SparkSession, folder: str) -> DataFrame:
    """One row per image with all five targets; components that were not weighed are 0.

    Grouped by the key itself, so that later joins on the key need no second shuffle.
    """
    items = read_table(spark, folder, "lineitem").select(path_of("l_orderkey").alias(KEY), "l_returnflag", "l_quantity")

    def of(*flags: str) -> Column:
        return F.sum(F.when(F.col("l_returnflag").isin(*flags), F.col("l_quantity")).otherwise(0.0))

    return items.groupBy(KEY).agg(
        of("A").alias("Dry_Clover_g"),
        of("N").alias("Dry_Dead_g"),
        of("R").alias("Dry_Green_g"),
        of("A", "N", "R").alias("Dry_Total_g"),
        of("A", "R").alias("GDM_g"),
    ).select(KEY, *TARGETS)


def long_targets(spark: SparkSession, folder: str) -> DataFrame:
    return lengthen_targets(wide_targets(spark, folder))


def samples(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata and folds of every image, with gaps in all four metadata columns."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )

    def known(value: str, gap: int) -> Column:
        return F.when(F.col("o_orderkey") % gap != 0, F.col(value))

    folded = assign_folds(joined, "o_custkey", N_FOLDS, hashed=False)
    return folded.select(
        path_of("o_orderkey").alias(KEY),
        F.col("o_custkey").alias("group_id"),
        "fold",
        known("c_mktsegment", 17).alias("State"),
        known("n_name", 19).alias("Species"),
        known("c_acctbal", 13).alias("Pre_GSHH_NDVI"),
        known("o_totalprice", 11).alias("Height_Ave_cm"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(path_of("vec_id").alias(KEY), "embedding", "label")


def pixels(spark: SparkSession, folder: str) -> DataFrame:
    """8-bit pixel table ``(image_path, y, x, r, g, b)`` from the 64 values of every embedding."""
    size = SIDE * SIDE

    def channel(shift: int) -> Column:
        value = (F.get("embedding", (F.col("p") + shift) % size).cast("double") + 0.5) * 255.0
        return F.floor(F.when(value < 0, 0.0).when(value > 255, 255.0).otherwise(value)).cast("int")

    cells = embeddings(spark, folder).select(KEY, "embedding", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("p"))
    return cells.select(
        KEY,
        F.floor(F.col("p") / SIDE).cast("int").alias("y"),
        (F.col("p") % SIDE).alias("x"),
        channel(0).alias("r"),
        channel(21).alias("g"),
        channel(42).alias("b"),
    )


def monitor(events: DataFrame) -> DataFrame:
    """Assessment log from an events table or stream."""
    return events.select(
        F.col("event_id").alias("token"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("State"),
        F.col("user_id").cast("string").alias("Species"),
        F.col("value").alias("Dry_Total_g"),
        (F.lit(1) + F.col("user_id") % 4).cast("double").alias("area_m2"),
    )


def monitor_table(spark: SparkSession, folder: str) -> DataFrame:
    return monitor(read_table(spark, folder, "events"))


def modelling_table(spark: SparkSession, folder: str) -> DataFrame:
    """Samples with their targets."""
    return samples(spark, folder).join(wide_targets(spark, folder), on=KEY)
