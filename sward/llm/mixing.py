"""Mixing sources to target weights by the cube method.

Every document of a source is to be taken ``target / source size`` times: its whole part for certain, its fraction by
balanced sampling. The flight phase moves the fractions of three documents at a time through the null space of the two
constraints (documents taken and words taken) until one of them is 0 or 1, so both totals stay exact. It runs in chunks
of bounded size; the two or fewer documents that each chunk leaves undecided fly again together, level by level, until
one chunk per source remains, whose last two documents land on the rounding nearest to both totals.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sward.session import materialise

#: Rows of a source that fly together in one group, whatever the source's size.
CHUNK = 4096
#: Plans of more sources than this are joined by shuffling instead of broadcasting.
BROADCAST_SOURCES = 100_000
ALMOST = 1e-9


def source_plan(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, n_docs, source_size, target)``.

    Sources in code point order, null last, weigh ``weights``, repeating. Together they get ``share`` of all sizes; a
    target stops at ``most`` times its source's size, and what is left over goes to the others by weight. In order of
    that stop per weight, the sources that reach it come first, so one running sum finds where the others begin. The
    windows hold one row per source.
    """
    totals = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("stop", F.col("source_size") * most)
    rising = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    before, onward = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= F.col("stop"))
    # The level that holds is that of the first free source; sources before it stop.
    shared = F.coalesce(F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(float("inf")))
    return leveled.select("source", "n_docs", "source_size", F.least("stop", shared * F.col("weight")).alias("target"))


def fly(p: np.ndarray, x: np.ndarray, coins: np.ndarray) -> np.ndarray:
    """Fractions after the flight phase: sums of p and of p * x as before, at most two strictly between 0 and 1.

    ``coins`` are uniform numbers that don't depend on the order of the rows; each step ends at one of its two ends so that
    expectations stay the same.
    """
    p, held, k = [float(v) for v in p], [], 0
    for i in range(len(p)):
        if ALMOST < p[i] < 1 - ALMOST:
            held.append(i)
        while len(held) == 3 or (len(held) == 2 and x[held[0]] == x[held[1]]):
            step = [1.0, -1.0]
            if len(held) == 3:
                a, b, c = (float(x[j]) for j in held)
                step = [b - c, c - a, a - b] if a != b or b != c else [1.0, -1.0, 0.0]
            moves = [(p[j], d) for j, d in zip(held, step) if d]
            up = min((1 - v) / d if d > 0 else -v / d for v, d in moves)
            down = min(v / d if d > 0 else (v - 1) / d for v, d in moves)
            by = up if coins[k % len(coins)] * (up + down) < down else -down
            k += 1
            for j, d in zip(held, step):
                v = p[j] + d * by
                p[j] = 0.0 if v < ALMOST else 1.0 if v > 1 - ALMOST else v
            held = [j for j in held if 0.0 < p[j] < 1.0]
    return np.array(p)


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The rounding of the few fractions that are left with the smallest error in words, then in documents."""
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    choices = [np.array(c, float) for c in itertools.product((0, 1), repeat=len(left))]
    best = min(choices, key=lambda c: (abs(float(((c - p[left]) * x[left]).sum())), abs(float((c - p[left]).sum())), tuple(c)))
    p = p.copy()
    p[left] = best
    return p


def _flight(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["u", "doc_id", "size"], kind="stable", na_position="last")
    p = fly(group["p"].to_numpy(float), group["size"].to_numpy(float), group["coin"].to_numpy(float))
    if group["chunks"].iloc[0] == 1:
        p = land(p, group["size"].to_numpy(float))
    return group.assign(p=p)[["doc_id", "source", "size", "whole", "p"]]


def balanced_copies(units: DataFrame, seed: int = 0) -> DataFrame:
    """``(doc_id, source, size, copies)`` from ``(doc_id, source, size, whole, p)``: fractions ``p`` become 0 or 1.

    One row per row of ``units``, so repeated rows are sampled one by one. Uniform numbers are hashes of row and level:
    reruns agree, and a lost task computes the same again.
    """
    schema = f"doc_id {units.schema['doc_id'].dataType.simpleString()}, source string, size long, whole long, p double"
    fraction = (F.col("p") > 0) & (F.col("p") < 1)
    decided, level = [], 0
    while True:
        level += 1
        counts = units.where(fraction).groupBy("source").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
        sizes = counts.agg(F.count("*").alias("n"), F.max("chunks").alias("chunks")).first()
        counts = F.broadcast(counts) if sizes["n"] <= BROADCAST_SOURCES else counts
        decided.append(units.where(~fraction | F.col("p").isNull()))
        if not sizes["n"]:
            break
        counts = counts.withColumnRenamed("source", "_s")
        u, coin = (
            (F.pmod(F.xxhash64("doc_id", "size", F.lit(seed), F.lit(level), F.lit(name)), F.lit(1 << 52)) / float(1 << 52)).alias(name)
            for name in ("u", "coin")
        )
        chunk = F.pmod(F.xxhash64(F.lit(level), "doc_id", "size"), F.col("chunks")).alias("chunk")
        flown = (
            units.where(fraction)
            .join(counts, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "source", "size", "whole", "p", "chunks", chunk, u, coin)
            .groupBy("source", "chunk")
            .applyInPandas(_flight, schema)
        )
        units = materialise(flown, f"mix-level-{level}")
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out.select("doc_id", "source", "size", (F.col("whole") + F.coalesce(F.col("p"), F.lit(0.0)).cast("long")).alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(key, source, size, source_size, target, copies, taken)`` for every row of ``docs``.

    ``size`` is the number of words (0 for null and empty texts, which are taken as often as any other text of their
    source), ``copies`` how often the mix takes the document and ``taken`` the words of all copies. A null source is a
    source of its own, the last. Sources without words have target 0 and are not taken. Repeated rows and null keys are
    rows like others; other columns are not read; no rows give no rows.

    Texts are read once, for their sizes; only keys and numbers are shuffled, and a source of any size flies in chunks.
    """
    words = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    sized = materialise(docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), words.alias("size")), "mix-sizes")
    plan = materialise(source_plan(sized, weights, share, most).withColumnRenamed("source", "_s"), "mix-plan")
    small = plan.count() <= BROADCAST_SOURCES
    plan = F.broadcast(plan) if small else plan
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = sized.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("rate", rate)
    near = F.round("rate")
    whole = F.when(F.abs(F.col("rate") - near) < ALMOST, near).otherwise(F.floor("rate")).cast("long")
    units = planned.select("doc_id", "source", "size", whole.alias("whole"), F.greatest(F.lit(0.0), F.col("rate") - whole).alias("p"))
    units = units.withColumn("p", F.when(F.col("p") < ALMOST, 0.0).otherwise(F.col("p")))
    copies = balanced_copies(units)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return copies.join(plan, F.col("source").eqNullSafe(F.col("_s"))).select(F.col("doc_id").alias(key), F.col("source").alias(source), "size", "source_size", "target", "copies", taken)
