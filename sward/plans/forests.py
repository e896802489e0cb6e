"""Random forests of unlimited trees, grown by Spark jobs.

Spark ML's forest sums histograms of every open node in every task and passes the rows once a level for as many nodes as
fit; unlimited trees have about as many nodes as rows. Here the binned training rows go to tasks that grow some of the trees
each, all nodes of a level together; trees are written as a table and meet the rows to be predicted by part. Bagging, bins,
impurity, tie order and limits are those of Spark ML's estimator; random numbers are not, so single trees differ from its.
Training sets that don't fit a task go to Spark ML's estimator.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.constants import FOLD, KEY, SEED
from sward.functions.scalars import clip_lower
from sward.plans.trees import PURE, TIE, bin_edges, descend, matrix
from sward.session import delete_path, free_name, materialise

#: Bytes of binned rows, with a target each, that a task holds to grow trees.
FOREST_BYTES = 64 << 20
#: Bytes of the trees of a part, 20 a training row each, which one task holds to score rows.
PART_BYTES = 64 << 20
#: Rows of the trees that are grown together.
PACK_ROWS = 16_384
#: Cells that are evaluated at once; nodes of at most so many rows are judged by pairs of rows, larger ones by histograms.
CELLS, PAIR_ROWS = 1 << 18, 16

#: Trees of a part of a forest, first nodes first, with bins in place of thresholds; importances are sums over the trees.
PACKS = "target int, part int, trees int, feature binary, bin binary, left binary, value binary, importance array<double>"


class Pack:
    """Trees that grow together. ``rows`` and ``weight`` have the rows of all open nodes, one node after another."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, numbers: range, seed: int, width: int, min_leaf: int):
        self.bins, self.y, self.width, self.min_leaf = bins, y, width, min_leaf
        drawn = [np.bincount(np.random.default_rng([seed, t]).integers(0, len(y), len(y)), minlength=len(y)) for t in numbers]
        own = [np.flatnonzero(w) for w in drawn]
        self.rows, self.weight = np.concatenate(own), np.concatenate([w[r] for w, r in zip(drawn, own)]).astype(np.float64)
        self.sizes = np.array([len(r) for r in own])
        self.nodes = self.tree = np.arange(len(own))
        self.trees = self.used = len(own)
        size = 2 * len(self.rows)
        self.feature, self.left = np.full(size, -1, np.int16), np.full(size, -1, np.int32)
        self.bin, self.value = np.zeros(size, np.uint8), np.zeros(size)
        self.importance = np.zeros((len(own), bins.shape[1]))

    def grow(self, depth: int) -> None:
        for level in range(depth + 1):
            starts = np.cumsum(self.sizes) - self.sizes
            total = np.add.reduceat(self.weight, starts)
            own = self.y[self.rows]
            self.value[self.nodes] = np.add.reduceat(self.weight * own, starts) / total
            off = own - np.repeat(self.value[self.nodes], self.sizes)
            squares = np.add.reduceat(self.weight * off**2, starts)
            able = squares > PURE * np.maximum(1.0, np.add.reduceat(self.weight * own**2, starts))
            able = np.flatnonzero(able & (total >= 2 * self.min_leaf)) if level < depth else np.array([], np.int64)
            following: list[tuple] = []
            power = np.ceil(np.log2(self.sizes[able])).astype(np.int64)
            for p in np.unique(power):
                same, width = able[power == p], 1 << int(p)
                step = max(1, CELLS // (width * self.bins.shape[1] * (width if width <= PAIR_ROWS else 1)))
                for i in range(0, len(same), step):
                    following += self._split(same[i : i + step], width, starts, total, off)
            if not following:
                return
            self.rows, self.weight, self.sizes, self.nodes, self.tree = (np.concatenate(c) for c in zip(*following))

    def _split(self, some: np.ndarray, width: int, starts: np.ndarray, total: np.ndarray, off: np.ndarray) -> list[tuple]:
        """Splits some nodes of at most ``width`` rows; what ``grow`` keeps of their left, then right children."""
        n = self.sizes[some]
        real = np.arange(width) < n[:, None]
        place = starts[some, None] + np.minimum(np.arange(width), n[:, None] - 1)
        rows, weight = self.rows[place], self.weight[place]
        # Targets less their mean in the node: what is right of a cut sums to the negative of what is left of it.
        sums = np.stack([weight * real, weight * off[place] * real], axis=1)
        judge = self._by_pairs if width <= PAIR_ROWS else self._by_histograms
        top, feature, cut = judge(rows, sums, total[some])
        at = np.flatnonzero(top > 0)
        if not len(at):
            return []
        feature, cut, some = feature[at], cut[at], some[at]
        children = self.used + 2 * np.arange(len(at))
        self.used += 2 * len(at)
        nodes, tree = self.nodes[some], self.tree[some]
        self.feature[nodes], self.bin[nodes], self.left[nodes] = feature, cut, children
        np.add.at(self.importance, (tree, feature), top[at])
        goes = self.bins[rows[at], feature[:, None]] <= cut[:, None]
        found = []
        for i, part in enumerate((goes & real[at], ~goes & real[at])):
            found.append((rows[at][part], weight[at][part], part.sum(1), children + i, tree))
        return found

    def _gains(self, count: np.ndarray, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        rest = total.reshape(-1, 1, 1) - count
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where((count >= self.min_leaf) & (rest >= self.min_leaf), left**2 * (1 / count + 1 / rest), -np.inf)

    def _by_pairs(self, rows: np.ndarray, sums: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(gain, feature, bin)`` of each node's best split, cutting at every row's bin."""
        bins = self.bins[rows]
        m, s, d = bins.shape
        goes = (bins[:, :, None, :] <= bins[:, None, :, :]).reshape(m, s, s * d)
        left = np.matmul(sums, goes.astype(np.float64)).reshape(m, 2, s, d)
        gains = self._gains(left[:, 0], left[:, 1], total)
        by_feature = gains.max(1)
        top, feature = self._first(by_feature)
        every = np.arange(m)
        near = gains[every, :, feature] >= _least_of(by_feature[every, feature])[:, None]
        return by_feature[every, feature], feature, np.where(near, bins[every, :, feature], 255).min(1)

    def _by_histograms(self, rows: np.ndarray, sums: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same by histograms of all bins; rows of large nodes are read in pieces."""
        m, s = rows.shape
        d, width = self.bins.shape[1], self.width
        base = (np.arange(m)[:, None, None] * d + np.arange(d)) * width
        counted = np.zeros((2, m * d * width))
        step = max(1, CELLS // (m * d))
        for i in range(0, s, step):
            cells = (base + self.bins[rows[:, i : i + step]]).ravel()
            for j in range(2):
                counted[j] += np.bincount(cells, np.repeat(sums[:, j, i : i + step].ravel(), d), m * d * width)
        count, left = counted.reshape(2, m, d, width).cumsum(3)
        gains = self._gains(count, left, total)
        by_feature = gains.max(2)
        top, feature = self._first(by_feature)
        every = np.arange(m)
        cut = (gains[every, feature] >= _least_of(by_feature[every, feature])[:, None]).argmax(1)
        return by_feature[every, feature], feature, cut

    def _first(self, by_feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest gains, and the first features that have them but for rounding."""
        top = by_feature.max(1)
        return top, (by_feature >= _least_of(top)[:, None]).argmax(1)

    def packed(self) -> list[bytes]:
        return [c[: self.used].tobytes() for c in (self.feature, self.bin, self.left, self.value)]

    def importances(self) -> np.ndarray:
        whole = self.importance.sum(1, keepdims=True)
        return np.divide(self.importance, whole, out=np.zeros_like(self.importance), where=whole > 0).sum(0)


def _least_of(top: np.ndarray) -> np.ndarray:
    """Gains from this on equal the largest one but for rounding."""
    return np.where(np.isfinite(top), top - TIE * np.abs(top), top)


class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "most levels of splits", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least drawn rows of a child", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most bins of a feature", TypeConverters.toInt)

    def setPredictionCol(self, value: str):
        return self._set(predictionCol=value)

    def setFeaturesCol(self, value: str):
        return self._set(featuresCol=value)


class ForestRegressor(Estimator, _ForestParams):
    """Bootstrap trees on squared error with all features at every split; see the module."""

    @keyword_only
    def __init__(self, *, numTrees: int = 300, maxDepth: int = 30, minInstancesPerNode: int = 1, maxBins: int = 32, seed: int = SEED):
        super().__init__()
        self._setDefault(numTrees=300, maxDepth=30, minInstancesPerNode=1, maxBins=32, seed=SEED)
        self._set(**self._input_kwargs)

    def setLabelCol(self, value: str):
        return self._set(labelCol=value)

    def _fit(self, dataset: DataFrame) -> Model:
        label = self.getLabelCol()
        return self.fit_targets(dataset, [label])[label]

    def fit_targets(self, df: DataFrame, targets: Sequence[str]) -> dict[str, Model]:
        """Eager: a model for every target, from one reading of the rows. Gaps in features or targets are an error."""
        if self.getOrDefault("maxBins") > 256:
            raise ValueError("more than 256 bins")
        y = F.array(*[F.col(t).cast("double") for t in targets])
        table = df.select(vector_to_array(self.getFeaturesCol()).alias("x"), y.alias("y"))
        shape = table.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
        n, d = shape["n"], shape["d"]
        if not n:
            raise ValueError("no training rows")
        if n * (d + 8) > FOREST_BYTES:
            return {t: self._distributed(t).fit(df) for t in targets}
        edges = bin_edges(table, self.getOrDefault("maxBins"))
        width = max(len(e) for e in edges) + 1
        spark, trees, chosen = df.sparkSession, self.getOrDefault("numTrees"), len(targets)
        depth, min_leaf, seed = (self.getOrDefault(c) for c in ("maxDepth", "minInstancesPerNode", "seed"))
        parts = min(trees, max(-(-2 * spark.sparkContext.defaultParallelism // chosen), -(-20 * n * trees // PART_BYTES)))
        ranges = [range(trees * p // parts, trees * (p + 1) // parts) for p in range(parts)]

        def dealt(batches):
            for batch in batches:
                if len(batch):
                    bins, own = binned(matrix(batch, "x"), edges), matrix(batch, "y")
                    for t in range(chosen):
                        block = [pa.array([v] * parts, pa.binary()) for v in (bins.tobytes(), own[:, t].tobytes())]
                        slots = pa.array(range(t * parts, (t + 1) * parts), pa.int32())
                        yield pa.RecordBatch.from_arrays([slots, *block], names=["slot", "bins", "y"])

        def grown(batches):
            now, blocks = None, []
            for batch in batches:
                for slot, *block in zip(*[batch.column(c).to_pylist() for c in ("slot", "bins", "y")]):
                    if slot != now and blocks:
                        yield from packs(now, blocks)
                        blocks = []
                    now = slot
                    blocks.append(block)
            if blocks:
                yield from packs(now, blocks)

        def packs(slot, blocks):
            bins = np.frombuffer(b"".join(b for b, _ in blocks), np.uint8).reshape(-1, d)
            own = np.frombuffer(b"".join(v for _, v in blocks))
            # Rows in one order, whatever task they came from: the draws are of places in it.
            order = np.lexsort([*bins.T[::-1], own])
            bins, own = bins[order], own[order]
            numbers, step = ranges[slot % parts], max(1, PACK_ROWS // len(own))
            for i in range(0, len(numbers), step):
                pack = Pack(bins, own, numbers[i : i + step], seed, width, min_leaf)
                pack.grow(depth)
                cells = [pa.array([v], pa.int32()) for v in (slot // parts, slot % parts, pack.trees)]
                cells += [pa.array([v], pa.binary()) for v in pack.packed()] + [pa.array([pack.importances()], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in PACKS.split(", ")])

        pieces = table.mapInArrow(dealt, "slot int, bins binary, y binary").repartitionById(parts * chosen, "slot").sortWithinPartitions("slot")
        stored = materialise(pieces.mapInArrow(grown, PACKS), "forest")
        found = {}
        for i, t in enumerate(targets):
            model = ForestModel(stored.where(F.col("target") == i), edges, trees, parts, stored.stored_at)
            found[t] = self._copyValues(model)._set(labelCol=t)
        return found

    def _distributed(self, label: str) -> RandomForestRegressor:
        names = {c: self.getOrDefault(c) for c in ("numTrees", "maxDepth", "minInstancesPerNode", "maxBins", "seed", "featuresCol", "predictionCol")}
        return RandomForestRegressor(featureSubsetStrategy="all", labelCol=label, **names)


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Values up to an edge have bins up to its place."""
    return np.column_stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]).astype(np.uint8)


class ForestModel(Model, _ForestParams):
    """Trees in a written table, ``PACKS`` of one target, dealt to ``parts``; their mean is the prediction."""

    def __init__(self, packs: DataFrame, edges: list[np.ndarray], trees: int, parts: int, stored_at: str):
        super().__init__()
        self.packs, self.edges, self.trees, self.parts, self.stored_at = packs, edges, trees, parts, stored_at

    @property
    def featureImportances(self) -> DenseVector:
        """Each tree's gains by feature as shares, averaged; they sum to 1 unless no tree has a split."""
        rows = self.packs.select(F.posexplode("importance").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        sums = {r["i"]: r["v"] for r in rows}
        shares = np.array([sums.get(i, 0.0) for i in range(len(self.edges))])
        return DenseVector(shares / (shares.sum() or 1.0))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """The rows are written first, so that their numbers stay the same."""
        number, fold = free_name(dataset, "_row"), free_name(dataset, "_fold")
        rows = materialise(dataset.withColumn(number, F.monotonically_increasing_id()), "forest-rows")
        scored = predict_folds(rows.withColumn(fold, F.lit(0)), {(0, ""): self}, [""], number, fold=fold, known=False)
        pred = scored.select(number, F.col("pred").alias(self.getPredictionCol()))
        return rows.join(pred, on=number).drop(number)


def discard(models: Iterable[Model]) -> None:
    """Delete the tables of trees, once all that is predicted with them is written; other models have none."""
    for spark, path in {(m.packs.sparkSession, m.stored_at) for m in models if isinstance(m, ForestModel)}:
        delete_path(spark, path)


def predict_folds(
    df: DataFrame, models: Mapping[tuple[int, str], ForestModel], targets: Sequence[str], key: str = KEY, clip: bool = False, fold: str = FOLD, known: bool = True
) -> DataFrame:
    """Each row scored by the models of its own fold, ``(key, fold, target, y, pred)``; all models have one features column.

    A row's bins go to every part of its fold's forests, in blocks; what it gets there is added by row. ``known``: targets
    are columns of the rows. A fold without models is an error.
    """
    spark, plan, first = df.sparkSession, [], 0
    for (f, t), model in models.items():
        plan.append((int(f), targets.index(t), first, model))
        first += model.parts
    [features] = {m.getFeaturesCol() for m in models.values()}
    folds = {f for f, *_ in plan}
    shared = spark.sparkContext.broadcast([(f, t, slot, m.edges, m.parts) for f, t, slot, m in plan])
    target_of = {slot + p: t for _, t, slot, m in plan for p in range(m.parts)}
    columns = [F.monotonically_increasing_id().alias("id"), F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"), vector_to_array(features).alias("x")]
    y = F.array(*[F.col(t).cast("double") if known else F.lit(None).cast("double") for t in targets])
    kind = df.schema[key].dataType.simpleString()

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            x, own, ids = matrix(batch, "x"), batch.column("fold").to_numpy(zero_copy_only=False), batch.column("id").to_numpy()
            if not set(own.tolist()) <= folds:
                raise ValueError("a row's fold has no models")
            for f, _, slot, edges, parts in shared.value:
                here = np.flatnonzero(own == f)
                if len(here):
                    block = [pa.array([v] * parts, pa.binary()) for v in (ids[here].tobytes(), binned(x[here], edges).tobytes())]
                    nothing = [pa.nulls(parts, t) for t in (pa.int64(), batch.column("key").type, pa.int32(), pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays([pa.array(range(slot, slot + parts), pa.int64()), *block, *nothing], names=names)
            blank = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(-1 - ids % 1024), blank, blank, *[batch.column(c) for c in ("id", "key", "fold", "y")]], names=names)

    names = ["slot", "ids", "bins", "id", "key", "fold", "y"]

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, packs = None, []
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            key_kind, rows = batch.column("key").type, np.flatnonzero(slots < 0)
            if len(rows):
                own = [batch.column(c).take(pa.array(rows)) for c in ("id", "key", "fold", "y")]
                yield pa.RecordBatch.from_arrays([*own, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.float64())], names=out)
            for i in np.flatnonzero(slots >= 0):
                if slots[i] != now:
                    now, packs = slots[i], []
                # Trees come before the rows that they score.
                if batch.column("trees")[i].as_py() is not None:
                    cells = zip(("feature", "bin", "left", "value"), (np.int16, np.uint8, np.int32, np.float64))
                    packs.append((batch.column("trees")[i].as_py(), *[np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in cells]))
                    continue
                if not packs:
                    raise ValueError("trees are absent")
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                bins = np.frombuffer(batch.column("bins")[i].as_py(), np.uint8).reshape(len(ids), -1)
                total, every = np.zeros(len(ids)), np.arange(len(ids))
                for trees, feature, cut, left, value in packs:
                    at = descend((feature, cut, left), np.repeat(np.arange(trees), len(ids)), bins, np.tile(every, trees))
                    total += value[at].reshape(trees, -1).sum(0)
                n = len(ids)
                nothing = [pa.nulls(n, t) for t in (key_kind, pa.int32(), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([pa.array(ids), *nothing, pa.array(np.full(n, target_of[now], np.int32)), pa.array(total)], names=out)

    out = ["id", "key", "fold", "y", "target", "part"]
    both = df.select(*columns, y.alias("y")).mapInArrow(reached, f"slot long, ids binary, bins binary, id long, key {kind}, fold int, y array<double>")
    for _, _, slot, model in plan:
        packs = model.packs.select((F.col("part").cast("long") + slot).alias("slot"), "trees", "feature", "bin", "left", "value")
        both = both.unionByName(packs, allowMissingColumns=True)
    both = both.repartition("slot").sortWithinPartitions("slot", F.col("trees").isNull())
    parts = both.mapInArrow(answered, f"id long, key {kind}, fold int, y array<double>, target int, part double")
    own = F.first(F.when(F.col("y").isNotNull(), F.struct("key", "fold", "y")), ignorenulls=True)
    # Sums don't depend on which task was first.
    sums = [F.aggregate(F.array_sort(F.collect_list(F.when(F.col("target") == i, F.col("part")))), F.lit(0.0), lambda a, b: a + b).alias(f"s{i}") for i in range(len(targets))]
    found = parts.groupBy("id").agg(own.alias("own"), *sums)
    trees = {t: m.trees for (_, t), m in models.items()}
    cells = []
    for i, t in enumerate(targets):
        pred = F.col(f"s{i}") / F.lit(float(trees[t]))
        cells.append(F.struct(F.lit(t).alias("target"), F.get("own.y", F.lit(i)).alias("y"), pred.alias("pred")))
    long = found.select(F.col("own.key").alias(key), F.col("own.fold").alias(fold), F.inline(F.array(*cells)))
    return long.withColumn("pred", clip_lower("pred")) if clip else long
