"""Session settings and durable intermediate storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is written for. All of them are ordinary Spark settings a cluster may override.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "sward", **extra: str) -> SparkSession:
    """A session with the recommended settings; ``master`` is only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, from ``spark.checkpoint.dir``.

    A machine-local folder is made only when the session runs in local mode and names no folder itself; on a cluster
    an unset folder is an error, because a local path would vanish with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
    folder = tempfile.mkdtemp(prefix="sward-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several later jobs read, and read it back.

    The written table survives executor loss and cuts the lineage, and the files give Catalyst real sizes to plan with.
    """
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once everything made of them is written, too."""
    for table in tables:
        delete_path(table.sparkSession, table.stored_at)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_STORED: dict[tuple[str, str], tuple[tuple, DataFrame, str]] = {}


def listing(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the files in a folder and its tables: changes when the data does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.listStatus(path) if files.exists(path) else []:
        inner = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in inner]
    return tuple(sorted(found))


def delete_path(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored_once(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table ``<folder>/<name>`` that is written when an application first asks for it and read from then on.

    As in any pipeline, feature tables are built once and every report reads them. When the files of the folder change,
    the table is built again and the outdated one deleted; ``forget_stored`` deletes all of them.
    """
    key = (spark.sparkContext.applicationId, name)
    folder, _, short = name.rpartition("/")
    state = listing(spark, folder)
    if key in _STORED and _STORED[key][0] != state:
        delete_path(spark, _STORED.pop(key)[2])
    if key not in _STORED:
        path = work_path(spark, short)
        build().write.mode("overwrite").parquet(path)
        _STORED[key] = (state, spark.read.parquet(path), path)
    return _STORED[key][1]


def is_stored(spark: SparkSession, name: str) -> bool:
    """Whether ``stored_once`` has the table, of the files that are in the folder now."""
    key = (spark.sparkContext.applicationId, name)
    return key in _STORED and _STORED[key][0] == listing(spark, name.rpartition("/")[0])


def forget_stored(spark: SparkSession) -> None:
    """Delete the stored tables of this application."""
    for key in [k for k in _STORED if k[0] == spark.sparkContext.applicationId]:
        delete_path(spark, _STORED.pop(key)[2])
