"""Exact quantiles of very large groups, without ever holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sward.functions.scalars import is_missing
from sward.session import materialise

#: Size of a sketch; it is off by well under a thousandth of the rows.
SKETCH_SIZE = 4000
MARGIN = 0.002
GRID = 1000
#: First-level groups in which the tasks' sketches of one group merge, before these merge again.
SALTS = 1024
#: Values around a rank that one task may count.
FEW = 1_000_000
#: Bracket tables of more rows than this are joined by shuffling instead of broadcasting.
BROADCAST_ROWS = 10_000


def _written(df: DataFrame, name: str) -> DataFrame:
    """A small table, run once: one row per group and rank. It is broadcast if it really is small."""
    table = materialise(df, name)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    groups: Sequence[str],
    spread: tuple[str, Column] | None = None,
    few: int = FEW,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """Exact linear-interpolation quantiles: columns ``groups..., prob, quantile``.

    ``percentile`` keeps every distinct value of a group in one task, which does not scale, so:

    1. one count gives the size and range of every group (eager, one row per group);
    2. while more than ``few`` values surround a wanted rank, sketches of the values in its bracket narrow it. Sketches
       merge in two levels, so no task gets those of all tasks; the values below and inside the new bracket are
       counted, and a bracket that missed its rank is not taken;
    3. one count collapses everything outside the brackets to two rows per rank and keeps exact value counts inside, on
       which a short running sum finds the ranks.

    ``spread`` is a group column and an array expression over it: the rows of a group also belong to all groups of that
    array *instead* (a fold's rows to the training sets of the other folds). Where no group is large, counts of distinct
    values are spread, not rows. NULL and NaN are ignored; a group without values has no output row.
    """
    groups = list(groups)
    values = df.select(*groups, F.col(value).cast("double").alias("v")).where(~is_missing("v"))

    def spread_out(table: DataFrame) -> DataFrame:
        return table.withColumn(spread[0], F.explode(spread[1])) if spread else table

    def with_brackets(table: DataFrame, brackets: DataFrame) -> DataFrame:
        return table.join(brackets, on=groups) if groups else table.join(brackets)

    totals = values.groupBy(*groups).agg(F.count(F.lit(1)).alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    totals = spread_out(totals).groupBy(*groups).agg(F.sum("inside").alias("inside"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    state = totals.where("inside > 0").select(
        *groups, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"), "inside", "lo", "hi", F.lit(0).cast("long").alias("below")
    )
    state = state.withColumn("position", F.col("prob") * (F.col("inside") - 1))
    state = _written(state.withColumn("open", (F.col("inside") > few) & (F.col("lo") < F.col("hi"))), "quantile-brackets")
    large = state.where("open").limit(1).count() > 0
    while state.where("open").limit(1).count():
        state = _written(_narrowed(with_brackets(spread_out(values), state.where("open")), state, groups, few, size), "quantile-brackets")

    counted = values.withColumn("n", F.lit(1).cast("long")) if large else values.groupBy(*groups, "v").agg(F.count(F.lit(1)).alias("n"))
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0)
    per_rank = [*groups, "prob"]
    collapsed = (
        with_brackets(spread_out(counted), state.select(*groups, "prob", "lo", "hi", "position"))
        .groupBy(*groups, "prob", "position", side.alias("side"), F.when(side == 0, F.col("v")).alias("v"))
        .agg(F.sum("n").alias("n"))
    )
    running = Window.partitionBy(*per_rank).orderBy("side", "v")
    ranked = collapsed.select("*", F.sum("n").over(running).alias("upto"))

    def at(rank: Column) -> Column:
        holds = (rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n"))
        outside = F.raise_error(F.lit("quantile rank outside its bracket"))
        return F.max(F.when(holds, F.when(F.col("side") == 0, F.col("v")).otherwise(outside.cast("double"))))

    below, above = at(F.floor("position")), at(F.ceil("position"))
    fraction = F.max(F.col("position") - F.floor("position"))
    return ranked.groupBy(*per_rank).agg((below + (above - below) * fraction).alias("quantile"))


def _narrowed(bracketed: DataFrame, state: DataFrame, groups: list[str], few: int, size: int) -> DataFrame:
    """The brackets after one round. A round that doesn't get smaller, as with one value everywhere, closes its bracket."""
    per_rank = [*groups, "prob"]
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    inside = F.col("v").between(F.col("lo"), F.col("hi"))
    parts = bracketed.where(inside).groupBy(*per_rank, salt.alias("_salt")).agg(F.kll_sketch_agg_double("v", size).alias("sketch"))
    whole = parts.groupBy(*per_rank).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    first, last = F.floor("position") - F.col("below"), F.ceil("position") + 1 - F.col("below")
    low, high = first / F.col("inside") - MARGIN, last / F.col("inside") + MARGIN

    # The ranks that a sketch is asked for have to be constants.
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    tried = whole.join(state.drop("open"), on=per_rank).withColumn("grid", grid).select(
        *per_rank,
        F.when(low > 0, F.get("grid", F.floor(low * GRID).cast("int"))).otherwise(F.col("lo")).alias("lo_2"),
        F.when(high < 1, F.get("grid", F.ceil(high * GRID).cast("int"))).otherwise(F.col("hi")).alias("hi_2"),
    )
    tried = _written(tried, "quantile-tries")
    counts = bracketed.join(tried, on=per_rank).groupBy(*per_rank).agg(
        F.count_if(F.col("v") < F.col("lo_2")).alias("below_2"),
        F.count_if(F.col("v").between(F.col("lo_2"), F.col("hi_2"))).alias("inside_2"),
        F.first("lo_2").alias("lo_2"),
        F.first("hi_2").alias("hi_2"),
    )
    held = (F.col("below_2") <= F.floor("position")) & (F.ceil("position") < F.col("below_2") + F.col("inside_2"))
    taken = F.coalesce(F.col("open") & held, F.lit(False))
    smaller = F.col("inside_2") < 0.9 * F.col("inside")
    new = {c: F.when(taken, F.col(f"{c}_2")).otherwise(F.col(c)) for c in ("lo", "hi", "below", "inside")}
    still = F.col("open") & taken & smaller & (F.col("inside_2") > few) & (F.col("lo_2") < F.col("hi_2"))
    joined = state.join(counts, on=per_rank, how="left")
    return joined.select(*per_rank, *[new[c].alias(c) for c in ("inside", "lo", "hi", "below")], "position", F.coalesce(still, F.lit(False)).alias("open"))
