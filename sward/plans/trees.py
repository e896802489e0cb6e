"""Tree ensembles that Spark ML lacks, grown by Spark jobs: extremely randomised trees and leaf-limited histogram boosting.

The trees of all folds (and, when boosting, of all targets) grow together: a pass over the rows brings every row to its
node in every tree, sums what the open nodes need, and adds these sums by node, first in lanes when there are many
partitions. Only a node's chosen split comes back to the driver, where the trees are, as in Spark's own ensembles;
subtrees of nodes whose rows fit a task stay in a written table, since unlimited trees have as many nodes as rows; such a
task gets a row once, however many of its trees have it, and grows them all with array operations. When boosting,
a node whose rows take less than their histograms in all tasks and at all levels is finished by the task that gets them, and
a model of so few rows is grown there with all its rounds.
Rows are read from a written table in every pass, so a lost executor costs the tasks it ran.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sward.constants import FOLD, KEY, SEED, TARGETS
from sward.operators.bounded import held
from sward.operators.folds import checked_folds
from sward.session import delete_path, materialise, work_path

#: Bytes of sums that one pass may hold in a task; more open nodes take several passes.
PASS_BYTES = 128 << 20
#: Partitions from which sums are added in lanes first.
LANES = 32
#: A node of at most so many rows is finished by the task that gets them, if they take at most ``TASK_BYTES``.
SMALL_ROWS = 200_000
#: Bytes of the rows that a task holds for all nodes that it finishes; each row is there once.
TASK_BYTES = 256 << 20
#: About so many of these nodes are dealt at most: with more rows and trees the tasks finish larger nodes.
SMALL_NODES = 50_000
#: Rows of the training sets whose subtrees meet the rows to be predicted in one task.
PART_ROWS = 500_000
#: Rows of nodes that are evaluated together; larger nodes are read in pieces of so many.
BLOCK_ROWS = 2_048
#: Bytes of a node's rows, as bins and residuals, up to which boosting finishes it in the task that gets them; a model
#: whose training rows take no more is grown there with all its rounds.
SUBTREE_BYTES = 32 << 20
#: Rows from which histograms are made feature by feature; fewer are counted in one call.
LONG_ROWS = 512
PURE = 1e-12
TIE = 1e-9


@dataclass
class Nodes:
    """Trees as growing columns. A node without split is a leaf; a split's right child follows its left one."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)

    def add(self) -> int:
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.left.append(-1)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        left, right = self.add(), self.add()
        self.feature[node], self.threshold[node], self.left[node] = feature, threshold, left
        return left, right

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature, np.int32), np.array(self.threshold), np.array(self.left, np.int32)


def descend(arrays: tuple[np.ndarray, np.ndarray, np.ndarray], root: int | np.ndarray, x: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
    """The leaf of every row: values up to the threshold go left. With ``of``, entry i is row ``of[i]`` from ``root[i]``."""
    feature, threshold, left = arrays
    at = np.full(len(x) if of is None else len(of), root, np.int64)
    rows = np.arange(len(at))
    while True:
        rows = rows[feature[at[rows]] >= 0]
        if not len(rows):
            return at
        here = at[rows]
        at[rows] = left[here] + (x[rows if of is None else of[rows], feature[here]] > threshold[here])


def matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of equally long arrays without gaps as a matrix."""
    column = batch.column(name)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if column.null_count or np.isnan(values).any() or len(values) % max(1, len(column)):
        raise ValueError(f"{name} has gaps or arrays of different lengths")
    return values.reshape(len(column), -1)


def training_table(df: DataFrame, features: str, targets: Sequence[str], fold: str, key: str) -> DataFrame:
    """``(key, fold, x, y)``, written once; ``features`` is an array column."""
    y = F.array(*[F.col(t).cast("double") for t in targets])
    rows = df.select(F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"), F.col(features).cast("array<double>").alias("x"), y.alias("y"))
    return materialise(rows, "tree-rows")


# Sums by node

Partial = Callable[[Iterator[pa.RecordBatch]], Iterable[tuple[int, bytes]]]
PARTIAL = "node long, lane int, sums binary"


def _pieces(partial: Partial):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lane = TaskContext.get().partitionId() % LANES
        for node, sums in partial(batches):
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([lane], pa.int32()), pa.array([sums], pa.binary())], names=["node", "lane", "sums"])

    return run


def _added(add: Callable, out: Callable, names: list[str], kinds: list[pa.DataType], by_lane: bool):
    """Adds the sums of each node, which arrive one after another, and gives ``out(node, sums)`` as a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, rows = None, None, []

        def pack():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for node, lane, sums in zip(*[batch.column(c) for c in ("node", "lane", "sums")]):
                group = (node.as_py(), lane.as_py() if by_lane else 0)
                if group != now:
                    if now is not None:
                        rows.append(out(now[0], state) if not by_lane else (*now, out(now[0], state)))
                    now, state = group, None
                state = add(state, np.frombuffer(sums.as_py()))
            if rows:
                yield pack()
                rows = []
        if now is not None:
            rows.append(out(now[0], state) if not by_lane else (*now, out(now[0], state)))
            yield pack()

    return run


def summed(table: DataFrame, partial: Partial, add: Callable, pack: Callable, finish: Callable, schema: str, kinds: list[pa.DataType]) -> list:
    """One pass: ``partial`` gives sums by node in every task, ``add`` joins two, ``finish`` makes a row of the total."""
    pieces = table.mapInArrow(_pieces(partial), PARTIAL)
    if table.rdd.getNumPartitions() > LANES:
        lanes = _added(add, lambda _, s: pack(s).tobytes(), ["node", "lane", "sums"], [pa.int64(), pa.int32(), pa.binary()], True)
        pieces = pieces.repartition("node", "lane").sortWithinPartitions("node", "lane").mapInArrow(lanes, PARTIAL)
    names = [c.split()[0] for c in schema.split(", ")]
    return pieces.repartition("node").sortWithinPartitions("node").mapInArrow(_added(add, finish, names, kinds, False), schema).collect()


def _plus(state, more):
    return more if state is None else state + more


def _least(state, more):
    return more if state is None else np.minimum(state, more)


# Extremely randomised trees


def draws(name: str, n: int) -> np.ndarray:
    """``n`` pairwise independent numbers in [0, 1) that depend on nothing but the name.

    With h and s the first and second 32 bits of the name's MD5, the i-th is (h + i s) mod 2^32, divided by 2^32.
    """
    text = hashlib.md5(name.encode()).hexdigest()
    return (int(text[:8], 16) + np.arange(n, dtype=np.int64) * int(text[8:16], 16)) % 2**32 / 2.0**32


def first_best(gains: np.ndarray) -> int:
    """The first of the largest gains; those that differ by rounding are equal, whatever order the sums were added in."""
    top = gains.max()
    return int(np.flatnonzero(gains >= top - TIE * max(1.0, abs(top)))[0])


def best_cut(sums: np.ndarray, n_features: int, n_targets: int, min_leaf: int) -> tuple[int, float]:
    """``(feature, gain)`` of the random cut that takes most squared error off all targets together; -1 for none.

    ``sums`` holds rows and target sums left of every feature's cut, then rows, sums and sums of squares of the node.
    """
    left = sums[: n_features * (1 + n_targets)].reshape(n_features, 1 + n_targets)
    n, total = sums[-1 - 2 * n_targets], sums[-2 * n_targets : -n_targets]
    rows, rest = left[:, 0], n - left[:, 0]
    valid = (rows >= min_leaf) & (rest >= min_leaf)
    if not valid.any():
        return -1, 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = (left[:, 1:] ** 2).sum(1) / rows + ((total - left[:, 1:]) ** 2).sum(1) / rest - (total**2).sum() / n
    gains[~valid] = -np.inf
    best = first_best(gains)
    return best, float(gains[best])


def drawn_cuts(name: str, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A threshold for every feature, below its largest value; none where all values are equal."""
    cut = low + draws(name, len(low)) * (high - low)
    return np.where(low < high, np.minimum(cut, np.nextafter(high, low)), np.nan)


def cut_sums(x: np.ndarray, y: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """What ``best_cut`` needs of some rows; sums of parts add up."""
    with_one = np.column_stack([np.ones(len(x)), y])
    return np.concatenate([((x <= cuts).astype(np.float64).T @ with_one).ravel(), with_one.sum(0), (y**2).sum(0)])


def judged(sums: np.ndarray, n_features: int, n_targets: int, min_leaf: int) -> tuple[int, list[float], int, float, int]:
    """``(rows, means, feature, gain, rows to the left)`` of a node; feature -1 makes it a leaf."""
    n, total, squares = sums[-1 - 2 * n_targets], sums[-2 * n_targets : -n_targets], sums[-n_targets:]
    feature, gain = best_cut(sums, n_features, n_targets, min_leaf)
    if float((squares - total**2 / n).sum()) <= PURE * max(1.0, float(squares.sum())):
        feature = -1
    return int(n), (total / n).tolist(), feature, gain, int(sums[feature * (1 + n_targets)]) if feature >= 0 else 0


class Subtree:
    """Nodes of a subtree as columns, for as many as ``n`` rows can have; the first is its root."""

    def __init__(self, n: int, n_targets: int):
        size = max(1, 2 * n - 1)
        self.used = 1
        self.feature, self.left = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.threshold, self.gain = np.zeros(size), np.zeros(size)
        self.n, self.means = np.zeros(size, np.int64), np.zeros((size, n_targets))

    def split(self, at: np.ndarray, feature: np.ndarray, threshold: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Splits nodes; returns the left children, which the right ones follow."""
        children = self.used + 2 * np.arange(len(at))
        self.used += 2 * len(at)
        self.feature[at], self.threshold[at], self.gain[at], self.left[at] = feature, threshold, gain, children
        return children

    def columns(self) -> list[np.ndarray]:
        return [c[: self.used] for c in (self.feature, self.threshold, self.left, self.n, self.gain)] + [self.means[: self.used].ravel()]


def drawn_for_places(name: str, places: Sequence[int], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``drawn_cuts`` for several places of a tree, a row for each."""
    digests = b"".join(hashlib.md5(f"{name}:{p}".encode()).digest()[:8] for p in places)
    start, step = np.frombuffer(digests, ">u4").astype(np.int64).reshape(-1, 2, 1).transpose(1, 0, 2)
    cut = low + ((start + np.arange(low.shape[1]) * step) % 2**32 / 2.0**32) * (high - low)
    return np.where(low < high, np.minimum(cut, np.nextafter(high, low)), np.nan)


def grown_tree(x: np.ndarray, y: np.ndarray, rows: np.ndarray, name: str, place: int, levels: int, min_leaf: int) -> Subtree:
    """The subtree of a node whose rows are all here. Large nodes are split one by one, the rest level by level."""
    tree = Subtree(len(rows), y.shape[1])
    stack = [(0, rows, place, levels)]
    while stack:
        at, rows, here, left_levels = stack.pop()
        if len(rows) <= BLOCK_ROWS:
            grown_levels(tree, at, x[rows], y[rows], name, here, left_levels, min_leaf)
            continue
        pieces = [rows[i : i + BLOCK_ROWS] for i in range(0, len(rows), BLOCK_ROWS)]
        ranges = [(x[p].min(0), x[p].max(0)) for p in pieces]
        cuts = drawn_cuts(f"{name}:{here}", np.min([r[0] for r in ranges], axis=0), np.max([r[1] for r in ranges], axis=0))
        sums = sum(cut_sums(x[p], y[p], cuts) for p in pieces)
        tree.n[at], tree.means[at], feature, gain, _ = judged(sums, x.shape[1], y.shape[1], min_leaf)
        if feature >= 0 and left_levels > 0:
            goes = x[rows, feature] <= cuts[feature]
            child = int(tree.split(np.array([at]), feature, cuts[feature], gain)[0])
            stack += [(child, rows[goes], 2 * here, left_levels - 1), (child + 1, rows[~goes], 2 * here + 1, left_levels - 1)]
    return tree


def grown_levels(tree: Subtree, at: int, x: np.ndarray, y: np.ndarray, name: str, place: int, levels: int, min_leaf: int) -> None:
    """Grows a subtree below a node of ``tree``: all nodes of a level together, those of about equal sizes in one array."""
    d, k = x.shape[1], y.shape[1]
    order, sizes, nodes, places = np.arange(len(x)), np.array([len(x)]), np.array([at]), [place]
    while len(nodes):
        starts = np.cumsum(sizes) - sizes
        tree.n[nodes], tree.means[nodes] = sizes, np.add.reduceat(y[order], starts, axis=0) / sizes[:, None]
        following: list[tuple] = []
        if levels > 0:
            able = np.flatnonzero(sizes >= 2 * min_leaf)
            # Sizes are filled up to powers of two; an array has rows enough for speed and few enough for the cache.
            power = np.ceil(np.log2(np.maximum(sizes[able], 1))).astype(np.int64)
            for p in np.unique(power):
                same, width = able[power == p], 1 << int(p)
                step = max(1, BLOCK_ROWS // width)
                for i in range(0, len(same), step):
                    following += _level_block(tree, same[i : i + step], width, order, starts, sizes, nodes, places, x, y, name, min_leaf)
        levels -= 1
        if not following:
            return
        order, sizes, nodes = (np.concatenate([f[i] for f in following]) for i in range(3))
        places = [p for f in following for p in f[3]]


def _level_block(tree, some, width, order, starts, sizes, nodes, places, x, y, name, min_leaf) -> list[tuple]:
    """Splits some nodes of at most ``width`` rows; ``(rows, sizes, nodes, places)`` of their left, then right children."""
    n = sizes[some]
    real = np.arange(width) < n[:, None]
    rows = order[starts[some, None] + np.minimum(np.arange(width), n[:, None] - 1)]
    values, own = x[rows], y[rows]
    here = [places[i] for i in some]
    cuts = drawn_for_places(name, here, values.min(1), values.max(1))
    goes = values <= cuts[:, None, :]
    # Targets less their mean in the node: what is right of a cut sums to the negative of what is left of it.
    own_squares = (own**2 * real[..., None]).sum((1, 2))
    own = (own - tree.means[nodes[some]][:, None, :]) * real[..., None]
    left = np.matmul(goes.astype(np.float64).transpose(0, 2, 1), np.concatenate([real[..., None], own], axis=2))
    count = left[:, :, 0]
    rest = n[:, None] - count
    valid = (count >= min_leaf) & (rest >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = np.where(valid, (left[:, :, 1:] ** 2).sum(2) * (1 / count + 1 / rest), -np.inf)
    top = gains.max(1)
    splits = np.isfinite(top) & ((own**2).sum((1, 2)) > PURE * np.maximum(1.0, own_squares))
    at = np.flatnonzero(splits)
    if not len(at):
        return []
    top = top[at]
    # The first of the largest, as in ``first_best``.
    feature = (gains[at] >= (top - TIE * np.maximum(1.0, np.abs(top)))[:, None]).argmax(1)
    goes = goes[at, :, feature]
    children = tree.split(nodes[some[at]], feature, cuts[at, feature], gains[at, feature])
    found = []
    for i, part in enumerate((goes & real[at], ~goes & real[at])):
        found.append((rows[at][part], part.sum(1), children + i, [2 * here[j] + i for j in at]))
    return found


#: Subtrees as columns, a row for each; their first node is ``node`` of the ensemble, at ``place`` of its tree. The means of
#: all targets follow one another by node. Subtrees of a ``part`` are met together.
GROWN = "part int, fold int, tree int, place string, node long, feature array<int>, threshold array<double>, left array<int>, n array<long>, gain array<double>, means array<double>"
SPLIT = "fold int, tree int, node string, feature int, threshold double, n long, gain double, outputs array<double>"


def unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SPLIT`` from subtrees."""
    kinds = pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.float64())
    names = [c.split()[0] for c in SPLIT.split(", ")]
    for batch in batches:
        for r in batch.to_pylist():
            found, stack, k = [], [(0, int(r["place"]))], len(r["means"]) // len(r["n"])
            while stack:
                at, place = stack.pop()
                split = r["feature"][at] >= 0
                cut = (r["feature"][at], r["threshold"][at]) if split else (None, None)
                found.append((r["fold"], r["tree"], str(place), *cut, r["n"][at], r["gain"][at] if split else None, r["means"][k * at : k * at + k]))
                if split:
                    stack += [(r["left"][at], 2 * place), (r["left"][at] + 1, 2 * place + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)


@dataclass
class TreeEnsemble:
    """Fitted trees of all folds: ``roots[fold]`` lists them, ``values`` has a row per node and a column per output.

    Nodes without values are the first ones of subtrees, which are in the written table ``grown``.
    """

    targets: Sequence[str]
    nodes: Nodes
    roots: dict[int, list[int]]
    values: list[list[float]]
    rows: list[int]
    gains: list[float]
    #: Added to the outputs' sum, which is divided by ``shrink[fold]``.
    base: dict[int, list[float]]
    shrink: dict[int, float]
    grown: DataFrame | None = None
    #: The part of ``grown`` that has a node's subtree.
    part_of: dict[int, int] = field(default_factory=dict)

    def predict(self, df: DataFrame, features: str, key: str = KEY, fold: str = FOLD, targets: bool = True) -> DataFrame:
        """``(key, fold, target, y, pred)``: each row by the trees of its own fold. A fold without trees is an error."""
        if self.grown is not None:
            return self._unfolded(self._met(df, features, key, fold, targets), key, fold)
        columns = [F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"), F.col(features).cast("array<double>").alias("x")]
        y = F.array(*[F.col(t).cast("double") if targets else F.lit(None).cast("double") for t in self.targets])
        shared = df.sparkSession.sparkContext.broadcast((self.nodes.arrays(), np.array(self.values), self.roots, self.base, self.shrink))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrays, values, roots, base, shrink = shared.value
            for batch in batches:
                x, folds = matrix(batch, "x"), batch.column("fold").to_numpy(zero_copy_only=False)
                pred = np.zeros((len(x), values.shape[1]))
                for k in np.unique(folds):
                    if int(k) not in roots:
                        raise ValueError(f"no trees for fold {k}")
                    here = np.flatnonzero(folds == k)
                    own = x[here]
                    total = sum((values[descend(arrays, root, own)] for root in roots[int(k)]), np.zeros((len(here), values.shape[1])))
                    pred[here] = np.array(base[int(k)]) + total / shrink[int(k)]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(pred.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("fold"), batch.column("y"), lists], names=["key", "fold", "y", "pred"])

        kind = df.schema[key].dataType.simpleString()
        scored = df.select(*columns, y.alias("y")).mapInArrow(score, f"key {kind}, fold int, y array<double>, pred array<double>")
        return self._unfolded(scored, key, fold)

    def _unfolded(self, scored: DataFrame, key: str, fold: str) -> DataFrame:
        cells = [F.struct(F.lit(t).alias("target"), F.get("y", F.lit(i)).alias("y"), F.get("pred", F.lit(i)).alias("pred")) for i, t in enumerate(self.targets)]
        return scored.select(F.col("key").alias(key), F.col("fold").alias(fold), F.inline(F.array(*cells)))

    def _met(self, df: DataFrame, features: str, key: str, fold: str, targets: bool) -> DataFrame:
        """``(key, fold, y, pred)`` where subtrees are in a table.

        A row descends to leaves, whose values it takes, and to subtrees, which it meets in a task by part, once for all
        subtrees of the part; what it gets there is added by row.
        """
        k = len(self.targets)
        columns = [F.monotonically_increasing_id().alias("id"), F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"), F.col(features).cast("array<double>").alias("x")]
        y = F.array(*[F.col(t).cast("double") if targets else F.lit(None).cast("double") for t in self.targets])
        values = np.array([[np.nan] * k if v is None else v for v in self.values])
        part_of = np.full(len(values), -1, np.int64)
        part_of[list(self.part_of)] = list(self.part_of.values())
        shared = df.sparkSession.sparkContext.broadcast((self.nodes.arrays(), values, self.roots, part_of))
        doubles, longs = pa.list_(pa.float64()), pa.list_(pa.int64())
        names = ["part", "id", "x", "nodes", "key", "fold", "y", "sums"]

        def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            arrays, values, roots, part_of = shared.value
            for batch in batches:
                x, folds, ids = matrix(batch, "x"), batch.column("fold").to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
                if not len(x):
                    continue
                total = np.zeros((len(x), k))
                waits: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
                for f in np.unique(folds):
                    if int(f) not in roots:
                        raise ValueError(f"no trees for fold {f}")
                    here = np.flatnonzero(folds == f)
                    own = x[here]
                    for root in roots[int(f)]:
                        at = descend(arrays, root, own)
                        parts = part_of[at]
                        off = parts < 0
                        total[here[off]] += values[at[off]]
                        for part in np.unique(parts[~off]):
                            on = parts == part
                            waits.setdefault(int(part), []).append((here[on], at[on]))
                for part, met in waits.items():
                    rows, at = (np.concatenate(c) for c in zip(*met))
                    order = np.argsort(rows, kind="stable")
                    rows, starts = np.unique(rows[order], return_index=True)
                    n = len(rows)
                    nodes = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), pa.array(at[order], pa.int64()))
                    packed = pa.array([row.tobytes() for row in x[rows]], pa.binary())
                    met = [pa.array(np.full(n, part)), pa.array(ids[rows]), packed, nodes, pa.nulls(n, batch.column("key").type), pa.nulls(n, pa.int32()), pa.nulls(n, doubles), pa.nulls(n, doubles)]
                    yield pa.RecordBatch.from_arrays(met, names=names)
                n = len(x)
                own = [pa.array(-1 - ids % 1024), pa.array(ids), pa.nulls(n, pa.binary()), pa.nulls(n, longs), *[batch.column(c) for c in ("key", "fold", "y")], pa.array(list(total), doubles)]
                yield pa.RecordBatch.from_arrays(own, names=names)

        def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, subtrees, joined = None, [], None

            def whole():
                """The part's subtrees as one set of nodes, and the place of each one's first node, by its number."""
                shift = np.cumsum([0] + [len(s[1]) for s in subtrees])
                feature, threshold, left = (np.concatenate([s[i] for s in subtrees]) for i in (1, 2, 3))
                left = left.astype(np.int64) + np.repeat(shift[:-1], np.diff(shift))
                order = np.argsort([s[0] for s in subtrees])
                return (feature, threshold, left), np.concatenate([s[4] for s in subtrees]), np.array([s[0] for s in subtrees])[order], shift[:-1][order]

            for batch in batches:
                parts = batch.column("part").to_numpy()
                own = np.flatnonzero(parts < 0)
                if len(own):
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(own)) for c in ("id", "key", "fold", "y", "sums")], names=["id", "key", "fold", "y", "sums"])
                trees_here = batch.column("feature").is_valid().to_numpy(zero_copy_only=False)
                for part in np.unique(parts[parts >= 0]):
                    if part != now:
                        now, subtrees, joined = part, [], None
                    # Subtrees come before the rows that reached them.
                    for i in np.flatnonzero((parts == part) & trees_here):
                        cells = [batch.column(c)[int(i)].values.to_numpy() for c in ("feature", "threshold", "left", "means")]
                        subtrees.append((batch.column("node")[int(i)].as_py(), *(c.copy() for c in cells[:3]), cells[3].reshape(-1, k).copy()))
                    rows = np.flatnonzero((parts == part) & ~trees_here)
                    if not len(rows):
                        continue
                    if not subtrees:
                        raise ValueError("a subtree is absent")
                    if joined is None:
                        joined, subtrees = whole(), [()]
                    arrays, means, known, first = joined
                    met = batch.column("nodes").take(pa.array(rows))
                    lengths = pa.compute.list_value_length(met).to_numpy(zero_copy_only=False)
                    nodes = met.flatten().to_numpy()
                    at = np.minimum(np.searchsorted(known, nodes), len(known) - 1)
                    if (known[at] != nodes).any():
                        raise ValueError("a subtree is absent")
                    x = np.frombuffer(b"".join(batch.column("x").take(pa.array(rows)).to_pylist())).reshape(len(rows), -1)
                    leaves = descend(arrays, first[at], x, np.repeat(np.arange(len(rows)), lengths))
                    sums = np.add.reduceat(means[leaves], np.cumsum(lengths) - lengths, axis=0)
                    n = len(rows)
                    cells = [batch.column("id").take(pa.array(rows)), pa.nulls(n, batch.column("key").type), pa.nulls(n, pa.int32()), pa.nulls(n, doubles), pa.array(list(sums), doubles)]
                    yield pa.RecordBatch.from_arrays(cells, names=["id", "key", "fold", "y", "sums"])

        kind = df.schema[key].dataType.simpleString()
        rows = df.select(*columns, y.alias("y")).mapInArrow(reached, f"part long, id long, x binary, nodes array<long>, key {kind}, fold int, y array<double>, sums array<double>")
        subtrees = self.grown.select(F.col("part").cast("long").alias("part"), "node", "feature", "threshold", "left", "means")
        both = rows.unionByName(subtrees, allowMissingColumns=True)
        parts = both.repartition("part").sortWithinPartitions("part", F.col("feature").isNull()).mapInArrow(answered, f"id long, key {kind}, fold int, y array<double>, sums array<double>")
        own = F.first(F.when(F.col("y").isNotNull(), F.struct("key", "fold", "y")), ignorenulls=True)
        sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(k)]
        base = F.create_map(*[F.lit(v) for f in self.roots for v in (f, self.shrink[f])])
        start = [F.create_map(*[F.lit(v) for f in self.roots for v in (f, float(self.base[f][i]))]) for i in range(k)]
        pred = F.array(*[start[i][F.col("own.fold")] + F.col(f"s{i}") / base[F.col("own.fold")] for i in range(k)])
        return parts.groupBy("id").agg(own.alias("own"), *sums).select("own.key", "own.fold", "own.y", pred.alias("pred"))

    def table(self, spark: SparkSession) -> DataFrame:
        """``(fold, tree, node, feature, threshold, n, gain, outputs)``: the trees as rows; children are 2 and 2 + 1 times their parent."""
        found = []
        for fold, roots in self.roots.items():
            for tree, root in enumerate(roots):
                stack = [(root, 1)]
                while stack:
                    at, name = stack.pop()
                    if self.values[at] is None:
                        continue
                    split = self.nodes.feature[at] >= 0
                    cut = (self.nodes.feature[at], self.nodes.threshold[at]) if split else (None, None)
                    found.append((fold, tree, str(name), *cut, self.rows[at], self.gains[at] if split else None, list(map(float, self.values[at]))))
                    if split:
                        stack += [(self.nodes.left[at], 2 * name), (self.nodes.left[at] + 1, 2 * name + 1)]
        top = spark.createDataFrame(found, SPLIT)
        return top if self.grown is None else top.unionByName(self.grown.mapInArrow(unfolded, SPLIT))

    def importances(self, spark: SparkSession, names: Sequence[str]) -> DataFrame:
        """``(fold, feature, importance)``: each tree's gains by feature as shares, averaged; zero ones included."""
        inner = self.table(spark).where("feature IS NOT NULL").groupBy("fold", "tree", "feature").agg(F.sum("gain").alias("own"))
        whole = inner.groupBy("fold", "tree").agg(F.sum("own").alias("whole"))
        shares = inner.join(whole.where("whole > 0"), ["fold", "tree"]).groupBy("fold", "feature").agg(F.sum(F.col("own") / F.col("whole")).alias("share"))
        every = [(f, i, n, len(roots)) for f, roots in self.roots.items() for i, n in enumerate(names)]
        every = spark.createDataFrame(every, "fold int, feature int, name string, trees int")
        share = F.coalesce(F.col("share"), F.lit(0.0)) / F.greatest("trees", F.lit(1))
        return every.join(shares, ["fold", "feature"], "left").select("fold", F.col("name").alias("feature"), share.alias("importance"))


def extra_trees(
    df: DataFrame,
    features: str,
    targets: Sequence[str] = TARGETS,
    trees: int = 100,
    depth: int = 30,
    min_leaf: int = 1,
    seed: int = SEED,
    folds: Sequence[int] | None = None,
    key: str = KEY,
    fold: str = FOLD,
) -> TreeEnsemble:
    """Joint extremely randomised trees for every fold, each grown on all rows of the other folds.

    At every node each feature gets one threshold, drawn uniformly between its smallest and largest value there; the one
    that takes most squared error off all targets together splits the node. No bootstrap, all features. Nodes of equal
    targets, of fewer than twice ``min_leaf`` rows or at ``depth`` are leaves with the mean of every target.

    Eager: two passes a level (ranges, then sums left of the drawn thresholds), more where ``PASS_BYTES`` of sums don't
    hold a level. Nodes of at most ``SMALL_ROWS``, whose rows fit ``TASK_BYTES``, are dealt to tasks in groups; a task gets
    every row of its nodes once and grows the rest by the same rules; the subtrees are written, not fetched. Where
    ``SMALL_NODES`` of them would not hold the rows of all trees, larger nodes do.
    Thresholds depend on seed, fold, tree and place in the tree alone. Gaps in ``features`` are an error;
    rows whose targets have gaps too. No training rows for a fold is an error.
    """
    folds = [int(k) for k in checked_folds(df, folds, fold)]
    table = training_table(df, features, targets, fold, key)
    spark, k = df.sparkSession, len(targets)
    d = table.select(F.size("x").alias("d")).first()
    d = 0 if d is None else d["d"]
    n_rows, most = table.count(), TASK_BYTES // (8 * (d + k + 1))
    few = max(min(SMALL_ROWS, most), n_rows * trees * len(folds) // SMALL_NODES)
    nodes = Nodes()
    roots = {f: [nodes.add() for _ in range(trees)] for f in folds}
    owner = {root: (f, t, 1) for f in folds for t, root in enumerate(roots[f])}
    values, rows, gains = {}, {}, {}
    width = d * (1 + k) + 1 + 2 * k
    per_pass = max(1, PASS_BYTES // (8 * width))

    def passes(frontier: list[int], thresholds: dict[int, np.ndarray] | None):
        """Sums of the frontier's nodes: without thresholds their ranges, as least values and least negatives."""
        arrays = nodes.arrays()
        slot_of = np.full(len(arrays[0]), -1, np.int64)
        slot_of[frontier] = np.arange(len(frontier))
        root_of = sorted({(owner[n][0], roots[owner[n][0]][owner[n][1]]) for n in frontier})
        cuts = None if thresholds is None else np.stack([thresholds[n] for n in frontier])
        shared = spark.sparkContext.broadcast((arrays, slot_of, root_of, frontier, cuts))

        def partial(batches):
            arrays, slot_of, root_of, frontier, cuts = shared.value
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                x, y, own = matrix(batch, "x"), matrix(batch, "y"), batch.column("fold").to_numpy(zero_copy_only=False)
                for f, root in root_of:
                    here = np.flatnonzero(own != f)
                    slots = slot_of[descend(arrays, root, x[here])]
                    order = np.argsort(slots, kind="stable")
                    order = order[np.searchsorted(slots[order], 0) :]
                    starts = np.flatnonzero(np.diff(slots[order], prepend=-1))
                    for a, b in zip(starts, np.append(starts[1:], len(order))):
                        slot, at = int(slots[order[a]]), here[order[a:b]]
                        if cuts is None:
                            sums = np.concatenate([x[at].min(0), -x[at].max(0)])
                            found[slot] = _least(found.get(slot), sums)
                        else:
                            found[slot] = _plus(found.get(slot), cut_sums(x[at], y[at], cuts[slot]))
            for slot, sums in found.items():
                yield frontier[slot], sums.tobytes()

        return partial

    def filled(small: dict[int, tuple[int, int]], limit: int) -> dict[int, int]:
        """A number for every node, of folds and trees in order, so that nodes with one have ``limit`` rows at most together."""
        numbers, number, held_rows = {}, 0, 0
        for n in sorted(small, key=lambda n: owner[n]):
            if held_rows and held_rows + small[n][1] > limit:
                number, held_rows = number + 1, 0
            numbers[n] = number
            held_rows += small[n][1]
        return numbers

    def finished(small: dict[int, tuple[int, int]]) -> tuple[DataFrame, dict[int, int]]:
        """Subtrees of small nodes, which have levels left and rows, grown by tasks that get the rows; and their parts."""
        total = sum(n for _, n in small.values())
        # Where all rows fit a task, nodes of many trees share them; else a group's nodes have no more than fit together.
        slot_of = filled(small, -(-total // (2 * spark.sparkContext.defaultParallelism)) if n_rows <= most else max(few, most))
        part_of = filled(small, PART_ROWS)
        groups: dict[int, dict[tuple[int, int, int], list[int]]] = {}
        for n, slot in slot_of.items():
            f, tree, _ = owner[n]
            groups.setdefault(slot, {}).setdefault((f, tree, roots[f][tree]), []).append(n)
        about = {n: (owner[n][2], levels, part_of[n]) for n, (levels, _) in small.items()}
        shared = spark.sparkContext.broadcast((nodes.arrays(), slot_of, groups, about))
        root_of = sorted({(f, root) for g in groups.values() for f, _, root in g})

        def dealt(batches):
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            arrays, slot_of, groups, _ = shared.value
            slots = np.full(len(arrays[0]), -1, np.int64)
            slots[list(slot_of)] = list(slot_of.values())
            for i, batch in enumerate(batches):
                x, y, own = matrix(batch, "x"), matrix(batch, "y"), batch.column("fold").to_numpy(zero_copy_only=False)
                wanted = np.zeros((len(groups), len(x)), bool)
                for f, root in root_of:
                    here = np.flatnonzero(own != f)
                    slot = slots[descend(arrays, root, x, here) if len(here) else here]
                    wanted[slot[slot >= 0], here[slot >= 0]] = True
                both = np.column_stack([x, y, own])
                for slot in np.flatnonzero(wanted.any(1)):
                    block = [pa.array([v], kind) for v, kind in ((slot, pa.int32()), (task, pa.int32()), (i, pa.int32()), (both[wanted[slot]].tobytes(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(block, names=["slot", "task", "block", "rows"])

        def subtrees(slot, blocks):
            arrays, _, groups, about = shared.value
            both = np.frombuffer(b"".join(blocks)).reshape(-1, d + k + 1)
            blocks.clear()
            x, y, own = both[:, :d], np.ascontiguousarray(both[:, d : d + k]), both[:, -1]
            for (f, tree, root), some in groups[slot].items():
                at = descend(arrays, root, x)
                at[own == f] = -1
                for n in some:
                    place, levels, part = about[n]
                    columns = grown_tree(x, y, np.flatnonzero(at == n), f"{seed}:{f}:{tree}", place, levels, min_leaf).columns()
                    cells = [pa.array([v], kind) for v, kind in ((part, pa.int32()), (f, pa.int32()), (tree, pa.int32()), (str(place), pa.string()), (n, pa.int64()))]
                    cells += [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c)) for c in columns]
                    yield pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in GROWN.split(", ")])

        def grown(batches):
            now, blocks = None, []
            for batch in batches:
                for slot, block in zip(batch.column("slot").to_pylist(), batch.column("rows")):
                    if slot != now and blocks:
                        yield from subtrees(now, blocks)
                    now = slot
                    blocks.append(block.as_py())
            if blocks:
                yield from subtrees(now, blocks)

        pieces = table.mapInArrow(dealt, "slot int, task int, block int, rows binary")
        # Blocks in one order, whichever came first: sums don't depend on it.
        pieces = pieces.repartitionById(len(groups), "slot").sortWithinPartitions("slot", "task", "block")
        return materialise(pieces.mapInArrow(grown, GROWN), "subtrees"), part_of

    level, frontier, small = 0, [r for f in folds for r in roots[f]], {}
    while frontier:
        following = []
        for at in range(0, len(frontier), per_pass):
            part = frontier[at : at + per_pass]
            names = {n: ":".join(map(str, (seed, *owner[n]))) for n in part}

            def drawn(node, ranges, names=names):
                return node, drawn_cuts(names[node], ranges[:d], -ranges[d:]).tolist()

            kinds = [pa.int64(), pa.list_(pa.float64())]
            found = summed(table, passes(part, None), _least, lambda s: s, drawn, "node long, cuts array<double>", kinds)
            cuts = {r["node"]: np.array(r["cuts"]) for r in found}
            if len(cuts) < len(part):
                raise ValueError("a fold has no training rows")

            def chosen(node, sums):
                return node, *judged(sums, d, k, min_leaf)

            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.float64(), pa.int64()]
            schema = "node long, n long, means array<double>, feature int, gain double, n_left long"
            for r in summed(table, passes(part, cuts), _plus, lambda s: s, chosen, schema, kinds):
                node = r["node"]
                values[node], rows[node], gains[node] = r["means"], r["n"], r["gain"]
                if r["feature"] >= 0 and level < depth:
                    f, tree, place = owner[node]
                    children = nodes.split(node, r["feature"], float(cuts[node][r["feature"]]))
                    for i, (child, n) in enumerate(zip(children, (r["n_left"], r["n"] - r["n_left"]))):
                        owner[child] = (f, tree, 2 * place + i)
                        if n <= few:
                            small[child] = (depth - level - 1, n)
                        else:
                            following.append(child)
        level, frontier = level + 1, following
    grown, part_of = finished(small) if small else (None, {})
    size = range(len(nodes.feature))
    zero = {f: [0.0] * k for f in folds}
    shrink = dict.fromkeys(folds, float(trees))
    return TreeEnsemble(targets, nodes, roots, [values.get(n) for n in size], [rows.get(n, 0) for n in size], [gains.get(n, 0.0) for n in size], zero, shrink, grown, part_of)


# Histogram boosting


def bin_edges(table: DataFrame, bins: int) -> list[np.ndarray]:
    """Upper edges of every feature's bins: midpoints of its values where they are few, else quantiles. Eager.

    Numbers of distinct values and quantiles come from mergeable sketches; only features that have few values are listed.
    """
    long = table.select(F.posexplode("x").alias("feature", "value"))
    points = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    counted = long.groupBy("feature").agg(F.approx_count_distinct("value", 0.01).alias("n"), F.percentile_approx("value", points, F.lit(100 * bins)).alias("cuts"))
    few = counted.where(F.col("n") <= 2 * bins).select("feature")
    distinct = long.join(F.broadcast(few), "feature").distinct().groupBy("feature").agg(F.array_sort(F.collect_list("value")).alias("values"))
    edges = {}
    for r in held(counted.join(distinct, "feature", "left"), what="bin edges").collect():
        values = r["values"]
        if values is not None and len(values) <= bins:
            edges[r["feature"]] = np.array([(a + b) / 2 for a, b in zip(values, values[1:])])
        else:
            edges[r["feature"]] = np.unique(np.array(r["cuts"]))
    return [edges[i] for i in sorted(edges)]


@dataclass(frozen=True)
class Boosting:
    """Published settings: 31 leaves, L2 1.0, rate 0.05, 300 rounds; at least 20 rows a leaf, 255 bins."""

    rate: float = 0.05
    rounds: int = 300
    leaves: int = 31
    l2: float = 1.0
    min_leaf: int = 20
    bins: int = 255
    #: Rounds after which predictions so far are written, so that a pass replays no more trees than these.
    store_every: int = 10


def best_bin(counts: np.ndarray, sums: np.ndarray, settings: Boosting) -> tuple[int, int, float]:
    """``(feature, bin, gain)`` of a node's histograms (feature x bin); bins up to the chosen one go left. -1 for none."""
    left_n, left_g = counts.cumsum(1), sums.cumsum(1)
    n, g = left_n[:, -1:], left_g[:, -1:]
    valid = (left_n >= settings.min_leaf) & (n - left_n >= settings.min_leaf)
    if not valid.any():
        return -1, 0, 0.0
    gains = left_g**2 / (left_n + settings.l2) + (g - left_g) ** 2 / (n - left_n + settings.l2) - g**2 / (n + settings.l2)
    gains[~valid] = -np.inf
    at = first_best(gains.ravel())
    return at // counts.shape[1], at % counts.shape[1], float(gains.ravel()[at])


class BestFirst:
    """The open leaves of one tree, which splits its best one until it has enough leaves.

    Children of all open leaves are evaluated in the same pass, before one of them is known to be the next, so that a
    tree of 31 leaves takes about as many passes as it has levels.
    """

    def __init__(self, root: int, leaves: int):
        self.left, self.open, self.found, self.children = leaves - 1, [], {}, {}
        self.internal: set[int] = set()
        self.waiting = [root]

    def advance(self, nodes: Nodes, found: dict[int, tuple]) -> list[int]:
        """Takes ``node: (feature, threshold, gain)`` of the nodes asked for; returns the nodes to evaluate next."""
        self.found.update(found)
        while all(n in self.found for n in self.waiting):
            for node in self.waiting:
                feature, threshold, gain = self.found[node]
                if feature >= 0 and gain > 0:
                    heapq.heappush(self.open, (-gain, node))
                    self.children[node] = nodes.split(node, feature, threshold)
            self.waiting = []
            if not self.open or not self.left:
                break
            _, node = heapq.heappop(self.open)
            self.internal.add(node)
            self.left -= 1
            self.waiting = list(self.children[node])
        ahead = [c for _, node in self.open for c in self.children[node]] if self.left else []
        return [n for n in self.waiting + ahead if n not in self.found]


def histograms(columns: np.ndarray, at: np.ndarray, g: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and residual sums by feature and bin, of the rows ``at``; ``columns`` has a row of bins per feature."""
    d = len(columns)
    if len(at) >= LONG_ROWS:
        counts, sums = np.empty((d, width), np.int64), np.empty((d, width))
        for i, column in enumerate(columns):
            own = column[at].astype(np.intp)
            counts[i], sums[i] = np.bincount(own, minlength=width), np.bincount(own, g, width)
        return counts, sums
    cells = (columns[:, at] + width * np.arange(d)[:, None]).ravel()
    return np.bincount(cells, minlength=d * width).reshape(d, width), np.bincount(cells, np.tile(g, d), d * width).reshape(d, width)


#: A subtree's nodes as columns, the first being ``node`` of the ensemble; children that the subtree had no use for are empty.
FINISHED = "node long, feature array<int>, bin array<int>, left array<int>, n array<long>, g array<double>, gain array<double>"


def best_first_subtree(columns: np.ndarray, g: np.ndarray, width: int, splits: int, settings: Boosting) -> tuple[list[list], dict[int, np.ndarray]]:
    """The best ``splits`` splits below a node, whose rows are all here, in the order and with the numbers of ``BestFirst``.

    Also the rows of its leaves. Of two children the smaller one's histograms are counted, the other has the rest.
    """
    found: list[list] = [[-1], [0], [-1], [0], [0.0], [0.0]]
    rows, heap, kept = {0: np.arange(len(g))}, [], {}

    def look(node: int, counted: tuple[np.ndarray, np.ndarray] | None) -> None:
        if counted is None:
            return
        feature, bin_, gain = best_bin(*counted, settings)
        if feature >= 0 and gain > 0:
            found[0][node], found[1][node], found[2][node], found[5][node] = feature, bin_, len(found[0]), gain
            for column, blank in zip(found, (-1, 0, -1, 0, 0.0, 0.0)):
                column += [blank, blank]
            kept[node] = counted
            heapq.heappush(heap, (-gain, node))

    found[3][0], found[4][0] = len(g), float(g.sum())
    if splits and len(g) >= 2 * settings.min_leaf:
        look(0, histograms(columns, rows[0], g, width))
    while heap and splits:
        _, node = heapq.heappop(heap)
        splits -= 1
        at, whole = rows.pop(node), kept.pop(node)
        goes = columns[found[0][node]][at] <= found[1][node]
        parts, children = (at[goes], at[~goes]), (found[2][node], found[2][node] + 1)
        for child, part in zip(children, parts):
            rows[child] = part
            found[3][child], found[4][child] = len(part), float(g[part].sum())
        more = [bool(splits) and len(part) >= 2 * settings.min_leaf for part in parts]
        counted: list[tuple[np.ndarray, np.ndarray] | None] = [None, None]
        if any(more):
            less = int(len(parts[1]) < len(parts[0]))
            small = histograms(columns, parts[less], g[parts[less]], width)
            counted[less] = small if more[less] else None
            counted[1 - less] = (whole[0] - small[0], whole[1] - small[1]) if more[1 - less] else None
        for child, own in zip(children, counted):
            look(child, own)
    return found, rows


#: A round's tree of a model as columns.
ROUND = "model int, round int, feature array<int>, bin array<int>, left array<int>, n array<long>, output array<double>, gain array<double>"


def all_rounds(columns: np.ndarray, y: np.ndarray, base: float, width: int, settings: Boosting) -> Iterator[list[np.ndarray]]:
    """The trees of a model, whose training rows are all here, round by round; leaves alone have no feature."""
    raw = np.full(len(y), base)
    for _ in range(settings.rounds):
        found, leaves = best_first_subtree(columns, raw - y, width, settings.leaves - 1, settings)
        feature, bin_, left, n, g, gain = map(np.array, found)
        feature[list(leaves)] = -1
        output = -settings.rate * g / (n + settings.l2)
        for leaf, at in leaves.items():
            raw[at] += output[leaf]
        # Children that the tree had no use for go.
        used = np.zeros(len(feature), bool)
        used[0] = True
        used[left[feature >= 0]] = used[left[feature >= 0] + 1] = True
        place = np.cumsum(used) - 1
        left = np.where(feature >= 0, place[left], -1)
        yield [c[used] for c in (feature, bin_, left, n, output, gain)]


def boosted_trees(
    df: DataFrame,
    features: str,
    targets: Sequence[str] = TARGETS,
    settings: Boosting = Boosting(),
    folds: Sequence[int] | None = None,
    key: str = KEY,
    fold: str = FOLD,
) -> dict[str, TreeEnsemble]:
    """Histogram boosting on squared error, an ensemble per target, for all folds and targets at once.

    A round fits one tree to the residuals of each: leaf-limited and best-first, gains and leaf values shrunken by L2, leaf
    values by the rate. Outputs start at the training mean. A fold's models use the rows of the other folds.

    Eager: where the training rows of a model take at most ``SUBTREE_BYTES``, they go to a task by model, which grows all
    rounds. Otherwise the rows of a node that do go to a task by node, once a round, which grows the rest of the tree as far
    as it may; above, a level takes a pass of histograms. Passes of all folds and targets are shared.
    Predictions so far are written every ``store_every`` rounds, and the table before is deleted. Gaps in features or
    targets are an error.
    """
    spark = df.sparkSession
    folds = [int(k) for k in checked_folds(df, folds, fold)]
    table = training_table(df, features, targets, fold, key)
    edges = bin_edges(table, settings.bins)
    d, width = len(edges), max((len(e) for e in edges), default=0) + 1
    models = [(f, t) for f in folds for t in range(len(targets))]
    moments = table.select("fold", F.posexplode("y").alias("t", "v")).groupBy("fold", "t").agg(F.count("v").alias("n"), F.sum("v").alias("s")).collect()

    def mean(f: int, t: int) -> float:
        parts = [(r["n"], r["s"]) for r in moments if r["fold"] != f and r["t"] == t]
        if not parts:
            raise ValueError(f"fold {f} has no training rows")
        return sum(s for _, s in parts) / sum(n for n, _ in parts)

    bases = [mean(f, t) for f, t in models]

    kind = np.dtype("u1" if width <= 1 << 8 else "<u2")
    few = SUBTREE_BYTES // (d * kind.itemsize + 8)
    trained = {f: sum(r["n"] for r in moments if r["fold"] != f and r["t"] == 0) for f in folds}

    def with_bins(batches):
        for batch in batches:
            x = matrix(batch, "x")
            bins = np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]).astype(kind)
            packed = pa.array([row.tobytes() for row in bins], pa.binary())
            raw = pa.array([bases] * len(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("fold", "y")], packed, raw], names=["fold", "y", "bins", "raw"])

    stored_schema = "fold int, y array<double>, bins binary, raw array<double>"

    def written(frame: DataFrame) -> tuple[DataFrame, str]:
        path = work_path(spark, "boosting-rows")
        frame.write.parquet(path)
        return spark.read.schema(stored_schema).parquet(path), path

    rows, path = written(table.mapInArrow(with_bins, stored_schema))
    # Trees are on bins while they grow: values up to an edge have bins up to its place.
    done: list[tuple[Nodes, list[int], list[float]]] = []
    recent = 0

    def binned(batch):
        return np.frombuffer(b"".join(batch.column("bins").to_pylist()), kind).reshape(len(batch), d)

    def replay(trees, bins, raw, chosen):
        """``raw`` with the outputs of the chosen models' trees since it was written."""
        for arrays, roots, values in trees:
            for m in chosen:
                raw[:, m] += values[descend(arrays, roots[m], bins)]
        return raw

    def frozen(some):
        return [(n.arrays(), r, np.array(v)) for n, r, v in some]

    def reached(batch, before, arrays, roots, per_model):
        """``(node, rows, residuals)`` of the nodes asked for that rows of the batch reach, and the bins."""
        bins, y, own = binned(batch), matrix(batch, "y"), batch.column("fold").to_numpy(zero_copy_only=False)
        raw = replay(before, bins, matrix(batch, "raw"), per_model)
        met = []
        for m, wanted in per_model.items():
            f, t = models[m]
            here = np.flatnonzero(own != f)
            leaf = descend(arrays, roots[m], bins[here])
            for node in wanted:
                at = here[leaf == node]
                if len(at):
                    met.append((node, at, raw[at, m] - y[at, t]))
        return met, bins

    sizes: list[list[int]] = []
    gained: list[list[float]] = []

    def in_tasks() -> None:
        """All rounds of all models, each grown by the task that gets its training rows."""

        def dealt(batches):
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            for i, batch in enumerate(batches):
                bins, y, own = binned(batch), matrix(batch, "y"), batch.column("fold").to_numpy(zero_copy_only=False)
                for m, (f, t) in enumerate(models):
                    at = own != f
                    if at.any():
                        block = [pa.array([v], k) for v, k in ((m, pa.int32()), (task, pa.int32()), (i, pa.int32()), (bins[at].tobytes(), pa.binary()), (y[at, t].tobytes(), pa.binary()))]
                        yield pa.RecordBatch.from_arrays(block, names=["model", "task", "block", "bins", "y"])

        def rounds(model, bins, y):
            columns = np.ascontiguousarray(np.frombuffer(b"".join(bins), kind).reshape(-1, d).T)
            bins.clear()
            kinds = pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()
            for i, tree in enumerate(all_rounds(columns, np.frombuffer(b"".join(y)), bases[model], width, settings)):
                arrays = [pa.array([model], pa.int32()), pa.array([i], pa.int32()), *[pa.array([c], pa.list_(k)) for c, k in zip(tree, kinds)]]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in ROUND.split(", ")])
            y.clear()

        def grown(batches):
            now, bins, y = None, [], []
            for batch in batches:
                for model, *block in zip(*[batch.column(c) for c in ("model", "bins", "y")]):
                    if model.as_py() != now and bins:
                        yield from rounds(now, bins, y)
                    now = model.as_py()
                    bins.append(block[0].as_py())
                    y.append(block[1].as_py())
            if bins:
                yield from rounds(now, bins, y)

        pieces = rows.mapInArrow(dealt, "model int, task int, block int, bins binary, y binary")
        # Blocks in one order, whichever came first: sums don't depend on it.
        pieces = pieces.repartitionById(len(models), "model").sortWithinPartitions("model", "task", "block")
        trees_of = {(r["round"], r["model"]): r for r in pieces.mapInArrow(grown, ROUND).collect()}
        for i in range(settings.rounds):
            nodes, roots, outputs, n, gain = Nodes(), [], [], [], []
            for m in range(len(models)):
                r, shift = trees_of[i, m], len(nodes.feature)
                roots.append(shift)
                nodes.feature += r["feature"]
                nodes.threshold += map(float, r["bin"])
                nodes.left += [c + shift for c in r["left"]]
                outputs, n, gain = outputs + r["output"], n + r["n"], gain + r["gain"]
            done.append((nodes, roots, outputs))
            sizes.append(n)
            gained.append(gain)

    whole_models = all(trained[f] <= few for f in folds)
    if whole_models:
        in_tasks()
    for round_ in range(0 if whole_models else settings.rounds):
        nodes = Nodes()
        roots = [nodes.add() for _ in models]
        growing = [BestFirst(r, settings.leaves) for r in roots]
        model_of = {r: m for m, r in enumerate(roots)}
        outputs, counts, gain_of = {}, {}, {}
        # Rows of nodes not looked at yet; and the subtree that has a node, with its place there.
        n_of = {r: trained[models[m][0]] for m, r in enumerate(roots)}
        finished: dict[int, tuple[Row, int]] = {}
        before = frozen(done[len(done) - recent :])

        def by_model(part):
            per_model: dict[int, list[int]] = {}
            for n in part:
                per_model.setdefault(model_of[n], []).append(n)
            return per_model

        def looked(node, n, g, gain):
            outputs[node] = -settings.rate * g / (n + settings.l2)
            counts[node], gain_of[node] = n, gain

        def histogram_pass(part):
            """Best splits of the nodes by their histograms, which tasks add by node."""
            shared = spark.sparkContext.broadcast((before, nodes.arrays(), roots, by_model(part)))

            def partial(batches):
                total: dict[int, np.ndarray] = {}
                for batch in batches:
                    met, bins = reached(batch, *shared.value)
                    columns = np.ascontiguousarray(bins.T)
                    for node, at, g in met:
                        both = np.concatenate([c.ravel() for c in histograms(columns, at, g, width)])
                        total[node] = _plus(total.get(node), both)
                for node, sums in total.items():
                    seen = np.flatnonzero(sums[: d * width])
                    yield node, np.concatenate([seen, sums[seen], sums[d * width + seen]]).tobytes()

            def add(state, more):
                state = np.zeros(2 * d * width) if state is None else state
                seen, n, g = more.reshape(3, -1)
                state[seen.astype(np.int64)] += n
                state[d * width + seen.astype(np.int64)] += g
                return state

            def pack(state):
                seen = np.flatnonzero(state[: d * width])
                return np.concatenate([seen, state[seen], state[d * width + seen]])

            def finish(node, state):
                n, g = state[: d * width].reshape(d, width), state[d * width :].reshape(d, width)
                feature, bin_, gain = best_bin(n, g, settings)
                return node, int(n[0].sum()), float(g[0].sum()), feature, bin_, gain, int(n[feature, : bin_ + 1].sum())

            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]
            schema = "node long, n long, g double, feature int, bin int, gain double, n_left long"
            return summed(rows, partial, add, pack, finish, schema, kinds)

        def subtree_pass(part):
            """Subtrees below the nodes: their rows, in blocks, go to a task by node, which grows what the tree may still need."""
            shared = spark.sparkContext.broadcast((before, nodes.arrays(), roots, by_model(part)))
            splits = {n: growing[model_of[n]].left for n in part}
            slots = {n: i for i, n in enumerate(part)}

            def dealt(batches):
                from pyspark import TaskContext

                task = TaskContext.get().partitionId()
                for i, batch in enumerate(batches):
                    met, bins = reached(batch, *shared.value)
                    for node, at, g in met:
                        block = [pa.array([v], k) for v, k in ((slots[node], pa.int32()), (node, pa.int64()), (task, pa.int32()), (i, pa.int32()), (bins[at].tobytes(), pa.binary()), (g.tobytes(), pa.binary()))]
                        yield pa.RecordBatch.from_arrays(block, names=["slot", "node", "task", "block", "bins", "g"])

            def grown(batches):
                now, bins, g = None, [], []

                def out():
                    columns = np.ascontiguousarray(np.frombuffer(b"".join(bins), kind).reshape(-1, d).T)
                    bins.clear()
                    subtree, _ = best_first_subtree(columns, np.frombuffer(b"".join(g)), width, splits[now], settings)
                    g.clear()
                    kinds = pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()
                    arrays = [pa.array([now], pa.int64()), *[pa.array([c], pa.list_(k)) for c, k in zip(subtree, kinds)]]
                    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in FINISHED.split(", ")])

                for batch in batches:
                    for node, *block in zip(*[batch.column(c) for c in ("node", "bins", "g")]):
                        if node.as_py() != now:
                            if now is not None:
                                yield out()
                            now = node.as_py()
                        bins.append(block[0].as_py())
                        g.append(block[1].as_py())
                if now is not None:
                    yield out()

            pieces = rows.mapInArrow(dealt, "slot int, node long, task int, block int, bins binary, g binary")
            # Blocks in one order, whichever came first: sums don't depend on it.
            pieces = pieces.repartitionById(len(part), "slot").sortWithinPartitions("node", "task", "block")
            return pieces.mapInArrow(grown, FINISHED).collect()

        def from_subtree(node):
            r, at = finished[node]
            looked(node, r["n"][at], r["g"][at], r["gain"][at])
            return r["feature"][at], float(r["bin"][at]), r["gain"][at]

        asked = list(roots)
        while asked:
            found: dict[int, tuple] = {}
            large = [n for n in asked if n_of[n] > few]
            small = [n for n in asked if n_of[n] <= few]
            per_pass = max(1, PASS_BYTES // (16 * d * width))
            for i in range(0, len(large), per_pass):
                for r in histogram_pass(large[i : i + per_pass]):
                    found[r["node"]] = (r["feature"], float(r["bin"]), r["gain"])
                    looked(r["node"], r["n"], r["g"], r["gain"])
                    n_of[r["node"]] = r["n_left"]
            for r in subtree_pass(small) if small else []:
                finished[r["node"]] = (r, 0)
                found[r["node"]] = from_subtree(r["node"])
            asked = []
            for m, tree in enumerate(growing):
                new = {n: v for n, v in found.items() if model_of[n] == m}
                while True:
                    wanted = tree.advance(nodes, new)
                    for node, children in tree.children.items():
                        if children[0] in model_of:
                            continue
                        model_of.update(dict.fromkeys(children, m))
                        if node in finished:
                            r, at = finished[node]
                            finished.update({c: (r, r["left"][at] + i) for i, c in enumerate(children)})
                        else:
                            n_of.update(zip(children, (n_of[node], counts[node] - n_of[node])))
                    new = {n: from_subtree(n) for n in wanted if n in finished}
                    if not new:
                        break
                asked += wanted
        for tree in growing:
            for node in tree.children:
                if node not in tree.internal:
                    nodes.feature[node] = -1
        size = range(len(nodes.feature))
        done.append((nodes, roots, [outputs.get(n, 0.0) for n in size]))
        sizes.append([counts.get(n, 0) for n in size])
        gained.append([gain_of.get(n, 0.0) for n in size])
        recent += 1
        if recent == settings.store_every and round_ + 1 < settings.rounds:
            trees = spark.sparkContext.broadcast(frozen(done[-recent:]))

            def updated(batches, trees=trees):
                for batch in batches:
                    raw = replay(trees.value, binned(batch), matrix(batch, "raw"), range(len(models)))
                    lists = pa.array(list(raw), pa.list_(pa.float64()))
                    yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("fold", "y", "bins")], lists], names=["fold", "y", "bins", "raw"])

            old, recent = path, 0
            rows, path = written(rows.mapInArrow(updated, stored_schema))
            delete_path(spark, old)
    delete_path(spark, path)
    result = {}
    for t, target in enumerate(targets):
        whole, values, n_rows, gains_of, starts = Nodes(), [], [], [], {f: [] for f in folds}
        for (nodes, roots, outputs), n, g in zip(done, sizes, gained):
            shift = len(whole.feature)
            whole.feature += nodes.feature
            whole.threshold += [float(edges[i][int(b)]) if i >= 0 else 0.0 for i, b in zip(nodes.feature, nodes.threshold)]
            whole.left += [i + shift for i in nodes.left]
            values += [[v] for v in outputs]
            n_rows += n
            gains_of += g
            for m, (f, own) in enumerate(models):
                if own == t:
                    starts[f].append(roots[m] + shift)
        base = {f: [bases[m]] for m, (f, own) in enumerate(models) if own == t}
        result[target] = TreeEnsemble([target], whole, starts, values, n_rows, gains_of, base, dict.fromkeys(folds, 1.0))
    return result
