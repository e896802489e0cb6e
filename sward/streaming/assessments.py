"""The assessment log as streams. Every query has a watermark or a state bounded by its grouping keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.operators.features import filter_optional
from sward.session import work_path

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet") -> DataFrame:
    """Event files as a stream. The file pattern lets new files join later."""
    return spark.readStream.schema(T.StructType.fromDDL(EVENTS)).parquet(f"{folder}/{pattern}")


def commit_once(log: DataFrame, delay: str = "1 day", token: str = "token", ts: str = "ts") -> DataFrame:
    """Keep the first event of every token. Tokens are forgotten once the watermark passes them, which bounds the state."""
    return log.withWatermark(ts, delay).dropDuplicatesWithinWatermark([token])


def running_totals(log: DataFrame, by: tuple[str, ...] = ("State",), measure: str = "Dry_Total_g") -> DataFrame:
    """Number and mean of assessments per group; one state row per group."""
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("assessments"), F.avg(measure).alias("mean_value"))


def latest(log: DataFrame, by: tuple[str, ...] = ("State",), ts: str = "ts", token: str = "token") -> DataFrame:
    """Latest record per group, ties by token."""
    others = [c for c in log.columns if c not in by]
    order = F.struct(F.col(ts), F.col(token))
    return log.groupBy(*by).agg(F.max_by(F.struct(*others), order).alias("row")).select(*by, "row.*")


def windowed_trend(log: DataFrame, width: str = "7 days", delay: str = "1 day", ts: str = "ts") -> DataFrame:
    """Mean biomass and density per tumbling window; windows close with the watermark."""
    density = F.try_divide(F.col("Dry_Total_g"), F.col("area_m2")) * 10.0
    return (
        log.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("assessments"),
            F.avg("Dry_Total_g").alias("mean_value"),
            F.avg(density).alias("mean_kg_ha"),
        )
        .select(F.col("w.start").alias("window_start"), "assessments", "mean_value", "mean_kg_ha")
    )


def filtered(log: DataFrame, state: str | None = None, species: str | None = None) -> DataFrame:
    return filter_optional(log, State=state, Species=species)


def append_to(log: DataFrame, path: str, checkpoint: str):
    """Append a stream to a table of files; each file is committed once."""
    return (
        log.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_appends(log: DataFrame, name: str) -> DataFrame:
    """Run an append stream over everything available and return the table it wrote."""
    spark = log.sparkSession
    path = work_path(spark, name)
    append_to(log, path, f"{path}-checkpoint").awaitTermination()
    return spark.read.schema(log.schema).parquet(path)


#: Batches after which an upsert table is written anew as a whole and its older batches go.
SNAPSHOT_EVERY = 50


def upsert_to(result: DataFrame, path: str, checkpoint: str, keys: Sequence[str], snapshot_every: int = SNAPSHOT_EVERY):
    """Write the changed groups of every batch under ``batch=<n>``.

    A batch that is run again overwrites its own folder, so a restart never counts twice. Every so many batches the
    folder holds the newest version of all groups, after which the older ones are deleted; a crash in between leaves
    old versions that the snapshot supersedes. So readers never meet more than that number of folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number % snapshot_every or not number:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
            return
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [status.getPath().getName() for status in files.listStatus(root)]
        older = [n for n in names if n.startswith("batch=") and int(n[6:]) < number]
        schema = T.StructType([*batch.schema.fields, T.StructField("batch", T.IntegerType())])
        versions = batch.withColumn("batch", F.lit(number))
        if older:
            stored = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in older])
            versions = versions.unionByName(stored)
        newest_versions(versions, list(keys), batch.columns).write.mode("overwrite").parquet(f"{path}/batch={number}")
        for n in older:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}"), True)

    return (
        result.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_versions(versions: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    others = [c for c in columns if c not in keys]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col("batch")).alias("row"))
    return newest.select(*keys, "row.*")


def current_state(spark: SparkSession, path: str, keys: list[str], schema: T.StructType) -> DataFrame:
    """The newest version of every group from a table written by ``upsert_to``."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
    return newest_versions(spark.read.schema(with_batch).parquet(path), keys, schema.names)


def drain_updates(result: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Run an updating stream over everything available and return its current state."""
    spark = result.sparkSession
    path = work_path(spark, name)
    upsert_to(result, path, f"{path}-checkpoint", keys).awaitTermination()
    return current_state(spark, path, keys, result.schema)
