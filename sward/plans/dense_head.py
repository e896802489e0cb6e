"""A two-layer head on frozen embeddings, trained by synchronous mini-batches over Spark partitions.

One hidden layer and one output per target, Huber loss, Adam. A round is one pass over the rows of its mini-batch: tasks add
up the gradients of all folds' models, which are summed by fold; the driver, which holds nothing but parameters, takes the
step. After each epoch the validation loss is measured and the whole state is appended to a table, so a run that dies goes
on from its last epoch. Rules for stopping, halving the rate and the best epoch read that history.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.constants import FOLD, KEY, SEED, TARGETS
from sward.operators.folds import checked_folds
from sward.plans.trees import matrix, summed
from sward.session import materialise, work_path


@dataclass(frozen=True)
class Head:
    """Published settings: 256 hidden units, 10 epochs at 0.0001, patience 3, halved after 2, dropout 0.3; ``rounds``
    mini-batches an epoch."""

    hidden: int = 256
    epochs: int = 10
    rounds: int = 8
    rate: float = 1e-4
    patience: int = 3
    halve_after: int = 2
    least_rate: float = 1e-6
    plateau: float = 1e-4
    dropout: float = 0.3
    delta: float = 1.0
    seed: int = SEED


def sizes(d: int, hidden: int, k: int) -> list[tuple[int, ...]]:
    return [(d, hidden), (hidden,), (hidden, k), (k,)]


def unpacked(flat: np.ndarray, d: int, hidden: int, k: int) -> list[np.ndarray]:
    parts, at = [], 0
    for shape in sizes(d, hidden, k):
        n = int(np.prod(shape))
        parts.append(flat[at : at + n].reshape(shape))
        at += n
    return parts


def first_weights(d: int, hidden: int, k: int, seed: int) -> np.ndarray:
    """Uniform weights within sqrt(6 / (inputs + outputs)), zero offsets."""
    rng = np.random.default_rng(seed)
    parts = []
    for shape in sizes(d, hidden, k):
        bound = (6 / sum(shape)) ** 0.5 if len(shape) == 2 else 0.0
        parts.append(rng.uniform(-bound, bound, shape).ravel())
    return np.concatenate(parts)


def mixed(rows: np.ndarray, salt: int) -> np.ndarray:
    """Random-looking 53-bit numbers from hashes and a salt, by multiplications and shifts."""
    x = (rows ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(11)


def kept_units(rows: np.ndarray, hidden: int, settings: Head, salt: int) -> np.ndarray:
    """Dropout as factors: 0, or 1 / (1 - rate). They depend on the row's hash, the unit and the salt alone."""
    units = rows[:, None] + np.arange(1, hidden + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return (mixed(units, salt) / 2.0**53 >= settings.dropout) / (1 - settings.dropout)


def outputs(flat: np.ndarray, x: np.ndarray, hidden: int, k: int) -> np.ndarray:
    w1, b1, w2, b2 = unpacked(flat, x.shape[1], hidden, k)
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def huber(error: np.ndarray, delta: float) -> np.ndarray:
    size = np.abs(error)
    return np.where(size <= delta, 0.5 * error**2, delta * (size - 0.5 * delta))


def gradient(flat: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray, hidden: int, delta: float) -> np.ndarray:
    """Summed gradients of the mean loss over outputs, then rows and summed loss."""
    k = y.shape[1]
    w1, b1, w2, b2 = unpacked(flat, x.shape[1], hidden, k)
    before = x @ w1 + b1
    layer = np.maximum(before, 0) * keep
    error = layer @ w2 + b2 - y
    slope = np.clip(error, -delta, delta) / k
    back = (slope @ w2.T) * keep * (before > 0)
    parts = [x.T @ back, back.sum(0), layer.T @ slope, slope.sum(0)]
    return np.concatenate([*[p.ravel() for p in parts], [len(x), huber(error, delta).sum() / k]])


@dataclass
class Fold:
    """Training state of one fold's model."""

    weights: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    rate: float
    step: int = 0
    history: list[tuple[int, float, float, float]] = field(default_factory=list)
    best: np.ndarray | None = None

    def take(self, slope: np.ndarray) -> None:
        """One step of Adam."""
        self.step += 1
        self.mean = 0.9 * self.mean + 0.1 * slope
        self.square = 0.999 * self.square + 0.001 * slope**2
        at = self.mean / (1 - 0.9**self.step), self.square / (1 - 0.999**self.step)
        self.weights = self.weights - self.rate * at[0] / (np.sqrt(at[1]) + 1e-7)


def decide(history: Sequence[tuple[int, float, float, float]], settings: Head) -> tuple[float, bool, int]:
    """``(rate, stopped, best epoch)`` after a history of ``(epoch, loss, validation loss, rate)``.

    An epoch is best if its validation loss is below all before it; ``patience`` epochs without one stop. ``halve_after``
    epochs that don't improve by ``plateau`` halve the rate, and counting begins anew.
    """
    best, best_at, since, low, wait, rate = np.inf, -1, 0, np.inf, 0, settings.rate
    for epoch, _, loss, _ in history:
        if loss < best:
            best, best_at, since = loss, epoch, 0
        else:
            since += 1
        if loss < low - settings.plateau:
            low, wait = loss, 0
        else:
            wait += 1
            if wait >= settings.halve_after:
                rate, wait = max(rate / 2, settings.least_rate), 0
    return rate, since >= settings.patience, best_at


STATE = "run string, fold int, epoch int, loss double, val_loss double, rate double, next_rate double, step int, weights binary, mean binary, square binary"


@dataclass
class DenseHead:
    """Fitted heads of all folds, each at its best epoch."""

    targets: Sequence[str]
    settings: Head
    folds: dict[int, Fold]

    def history(self, spark) -> DataFrame:
        """``(fold, epoch, loss, val_loss, rate)``: one row per fold and epoch that was trained."""
        rows = [(f, *h) for f, state in self.folds.items() for h in state.history]
        return spark.createDataFrame(rows, "fold int, epoch int, loss double, val_loss double, rate double")

    def predict(self, df: DataFrame, features: str, key: str = KEY, fold: str = FOLD) -> DataFrame:
        """``(key, fold, target, y, pred)``: each row by its own fold's head. A fold without one is an error."""
        shared = df.sparkSession.sparkContext.broadcast({f: s.best for f, s in self.folds.items()})
        hidden, k = self.settings.hidden, len(self.targets)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, own = matrix(batch, "x"), batch.column("fold").to_numpy(zero_copy_only=False)
                pred = np.zeros((len(x), k))
                for f in np.unique(own):
                    if int(f) not in shared.value:
                        raise ValueError(f"no head for fold {f}")
                    pred[own == f] = outputs(shared.value[int(f)], x[own == f], hidden, k)
                columns = [batch.column(c) for c in ("key", "fold", "y")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(pred), pa.list_(pa.float64()))], names=["key", "fold", "y", "pred"])

        y = F.array(*[F.col(t).cast("double") for t in self.targets])
        rows = df.select(F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"), F.col(features).cast("array<double>").alias("x"), y.alias("y"))
        kind = df.schema[key].dataType.simpleString()
        scored = rows.mapInArrow(score, f"key {kind}, fold int, y array<double>, pred array<double>")
        cells = [F.struct(F.lit(t).alias("target"), F.get("y", F.lit(i)).alias("y"), F.get("pred", F.lit(i)).alias("pred")) for i, t in enumerate(self.targets)]
        return scored.select(F.col("key").alias(key), F.col("fold").alias(fold), F.inline(F.array(*cells)))


def fit_heads(
    df: DataFrame,
    features: str,
    targets: Sequence[str] = TARGETS,
    settings: Head = Head(),
    folds: Sequence[int] | None = None,
    key: str = KEY,
    fold: str = FOLD,
    store: str | None = None,
    data: str = "",
) -> DenseHead:
    """A joint head for every fold, trained on the other folds' rows and validated on its own.

    Eager: ``rounds`` passes an epoch and one for the validation loss, shared by all folds that still train. A row is in
    one mini-batch an epoch, drawn by hashes of its key. ``store`` is a folder for the state; a run with the same settings,
    folds, targets, columns and ``data`` (a name for the rows' version) goes on behind its last whole epoch. Gaps in
    features or targets are an error, and so is a fold without rows to train or validate on.
    """
    spark, k = df.sparkSession, len(targets)
    folds = [int(f) for f in checked_folds(df, folds, fold)]
    y = F.array(*[F.col(t).cast("double") for t in targets])
    hashed = F.xxhash64(F.col(key)).alias("row")
    rows = df.select(hashed, F.col(fold).cast("int").alias("fold"), F.col(features).cast("array<double>").alias("x"), y.alias("y"))
    table = materialise(rows, "head-rows")
    head = table.select(F.size("x").alias("d")).first()
    d = head["d"] if head else 0
    width = sum(int(np.prod(s)) for s in sizes(d, settings.hidden, k))
    # The number of epochs is no part of the run's name: a longer run goes on where a shorter one ended.
    named = (astuple(replace(settings, epochs=0)), folds, tuple(targets), features, d, data)
    run = hashlib.sha256(repr(named).encode()).hexdigest()
    store = store or work_path(spark, "head-state")
    states = {f: Fold(first_weights(d, settings.hidden, k, settings.seed + f), np.zeros(width), np.zeros(width), settings.rate) for f in folds}
    losses: dict[int, dict[int, bytes]] = {f: {} for f in folds}
    resume(spark, store, run, states, losses)

    def partial(kind: str, epoch: int, number: int, models: dict[int, np.ndarray]):
        shared = spark.sparkContext.broadcast(models)

        def run_batches(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                x, wanted, own = matrix(batch, "x"), matrix(batch, "y"), batch.column("fold").to_numpy(zero_copy_only=False)
                row = batch.column("row").to_numpy().view(np.uint64)
                for f, weights in shared.value.items():
                    if kind == "validate":
                        at = own == f
                        error = outputs(weights, x[at], settings.hidden, k) - wanted[at]
                        sums = np.array([at.sum(), huber(error, settings.delta).sum() / k])
                    else:
                        part = mixed(row, epoch) % np.uint64(settings.rounds)
                        at = (own != f) & (part == np.uint64(number))
                        keep = kept_units(row[at], settings.hidden, settings, (epoch * 1009 + f) % 2**31)
                        sums = gradient(weights, x[at], wanted[at], keep, settings.hidden, settings.delta)
                    total[f] = total[f] + sums if f in total else sums
            for f, sums in total.items():
                yield f, sums.tobytes()

        return run_batches

    def passed(kind: str, epoch: int, number: int, models: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        def add(state, more):
            return more if state is None else state + more

        def out(f, sums):
            return f, sums.tobytes()

        found = summed(table, partial(kind, epoch, number, models), add, lambda s: s, out, "node long, sums binary", [pa.int64(), pa.binary()])
        return {int(r["node"]): np.frombuffer(r["sums"]) for r in found}

    for epoch in range(settings.epochs):
        going = [f for f in folds if len(states[f].history) == epoch and not decide(states[f].history, settings)[1]]
        if not going:
            continue
        seen = {f: np.zeros(2) for f in going}
        for number in range(settings.rounds):
            for f, sums in passed("train", epoch, number, {f: states[f].weights for f in going}).items():
                seen[f] += sums[-2:]
                if sums[-2]:
                    states[f].take(sums[:-2] / sums[-2])
        for f, (n, loss) in passed("validate", epoch, 0, {f: states[f].weights for f in going}).items():
            if not n or not seen[f][0]:
                raise ValueError(f"fold {f} has no rows to train or validate on")
            state = states[f]
            state.history.append((epoch, float(seen[f][1] / seen[f][0]), float(loss / n), state.rate))
            losses[f][epoch] = state.weights.tobytes()
            state.rate = decide(state.history, settings)[0]
            best = decide(state.history, settings)[2]
            losses[f] = {e: w for e, w in losses[f].items() if e == best}
        saved = [
            (run, f, epoch, *states[f].history[-1][1:], states[f].rate, states[f].step, *[bytearray(v.tobytes()) for v in (states[f].weights, states[f].mean, states[f].square)])
            for f in going
        ]
        spark.createDataFrame(saved, STATE).coalesce(1).write.mode("append").parquet(store)
    for f, state in states.items():
        kept = losses[f].get(decide(state.history, settings)[2])
        state.best = np.frombuffer(kept) if kept else state.weights
    return DenseHead(targets, settings, states)


def resume(spark, store: str, run: str, states: dict[int, Fold], losses: dict[int, dict[int, bytes]]) -> None:
    """Brings every fold to the end of its stored history of this run; an absent table changes nothing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return
    table = spark.read.schema(STATE).parquet(store).where(F.col("run") == run).dropDuplicates(["fold", "epoch"])
    for r in table.select("fold", "epoch", "loss", "val_loss", "rate").orderBy("epoch").collect():
        states[r["fold"]].history.append((r["epoch"], r["loss"], r["val_loss"], r["rate"]))
    # Of weights, only those of the last and of the best epoch of each fold are read.
    last = {f: len(s.history) - 1 for f, s in states.items()}
    best = {f: min(s.history, key=lambda h: (h[2], h[0]))[0] for f, s in states.items() if s.history}
    wanted = [(f, e) for f in best for e in {last[f], best[f]}]
    if not wanted:
        return
    for r in table.where(" OR ".join(f"(fold = {f} AND epoch = {e})" for f, e in wanted)).collect():
        state = states[r["fold"]]
        if r["epoch"] == best[r["fold"]]:
            losses[r["fold"]][r["epoch"]] = bytes(r["weights"])
        if r["epoch"] == last[r["fold"]]:
            state.weights, state.mean, state.square = (np.frombuffer(bytes(r[c])) for c in ("weights", "mean", "square"))
            state.rate, state.step = r["next_rate"], r["step"]
