"""Small tables: fetching parameters once, and broadcasting with a proof of size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sward.session import materialise

PARAMETER_ROWS = 10_000
HELD_BYTES = 64 << 20


def held(df: DataFrame, limit: int = PARAMETER_ROWS, what: str = "parameter table") -> DataFrame:
    """Run a plan whose result is usually small (fitted parameters) and keep the result in later plans.

    Eager, as fitting a model is. At most ``limit + 1`` rows reach the driver. What comes back is a local relation of
    known size, so joins broadcast it, and plans built on it stay short. A result of more rows or bytes is written to
    the shared folder instead and read from there, so that joins choose by its size.
    """
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit or table.nbytes > HELD_BYTES:
        return materialise(df, what.replace(" ", "-"))
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))


def small_side(df: DataFrame, limit: int = PARAMETER_ROWS, what: str = "parameter table") -> DataFrame:
    """Broadcast a table that is small by contract, and fail in the plan if it is not.

    The lazy counterpart of ``held``, for use inside one plan. At most ``limit + 1`` rows reach the check. Tables that
    grow with the data must not come here: join them plainly and let file sizes and AQE choose.
    """
    counted = df.limit(limit + 1).withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    too_many = F.raise_error(F.lit(f"{what} has more than {limit} rows; it cannot be broadcast")).cast("boolean")
    return F.broadcast(counted.where(F.when(F.col("_rows") <= limit, F.lit(True)).otherwise(too_many)).drop("_rows"))
