"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: every word has a sparse random index vector (two entries of +1 or -1); a word's context vector is the
sum of the index vectors of its neighbours over the whole corpus. Words are hashed into a fixed number of rows, so the
table of context vectors has the same size for any corpus. A document is the mean and the spread of its words' vectors.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.llm.textual import WordHash, utf8
from sward.session import materialise

ROWS, DIMENSIONS, REACH = 1 << 14, 64, 2
#: Labelled documents that the network is fitted on at most: those with the smallest hashes of their ids.
TRAINING_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY, SEED = 32, 60, 256, 0.01, 1e-4, 7
#: Words are runs of letters, of digits and of other characters; letters keep their case, since capitals tell.
TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\x00-\x20A-Za-z0-9\x80-\xff]+")
#: Features of a document: means and spreads of its words' vectors, and the logarithm of their number.
WIDTH = 2 * DIMENSIONS + 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the two entries of every row's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMENSIONS, (ROWS, 2)), rng.choice([-1.0, 1.0], (ROWS, 2))


def token_rows(text: str | None, hashes: WordHash) -> np.ndarray:
    return hashes.of(TOKEN.findall(utf8(text))) % ROWS


def add_contexts(sums: np.ndarray, rows: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add to every word's sum (``ROWS * DIMENSIONS``, flat) the index vectors of up to ``REACH`` neighbours a side.

    Texts are ``REACH`` places or more apart, and such places are -1, so both words of a counted pair are of one text.
    """
    for step in range(1, REACH + 1):
        inside = (rows[:-step] >= 0) & (rows[step:] >= 0)
        left, right = rows[:-step][inside], rows[step:][inside]
        for words, near in ((left, right), (right, left)):
            for entry in range(2):
                sums += np.bincount(words * DIMENSIONS + places[near, entry], weights=signs[near, entry], minlength=len(sums))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, sums, (places, signs) = WordHash(8), np.zeros(ROWS * DIMENSIONS), index_vectors()
    pad = np.full(REACH, -1, np.int64)
    waiting, size = [], 0

    def flush() -> None:
        if waiting:
            add_contexts(sums, np.concatenate(waiting), places, signs)
            waiting.clear()

    for batch in batches:
        for text in batch.column(0).to_pylist():
            waiting += [token_rows(text, hashes), pad]
            size += len(waiting[-2]) + REACH
            if size >= 1 << 20:
                flush()
                size = 0
    flush()
    table = sums.reshape(ROWS, DIMENSIONS)
    used = np.flatnonzero(table.any(axis=1))
    values = pa.FixedSizeListArray.from_arrays(pa.array(table[used].astype(np.int64).ravel()), DIMENSIONS).cast(pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(used), values], names=["row", "context"])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """``ROWS`` x ``DIMENSIONS`` unit vectors from all rows of ``docs``.

    Sums are whole numbers, so the order of tasks doesn't matter. A task sends one row per used hash row at most; the
    driver receives one row per hash row (8 MB).
    """
    summed = (
        docs.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(_contexts, "row long, context array<long>")
        .groupBy("row")
        .agg(F.array(*[F.sum(F.col("context")[d]) for d in range(DIMENSIONS)]).alias("context"))
    )
    vectors = np.zeros((ROWS, DIMENSIONS), np.float32)
    for batch in summed.toArrow().to_batches():
        sums = batch.column("context").flatten().to_numpy().reshape(-1, DIMENSIONS)
        vectors[batch.column("row").to_numpy()] = np.sign(sums) * np.log1p(np.abs(sums))
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if not len(rows):
        return np.zeros(WIDTH, np.float32)
    used, counts = np.unique(rows, return_counts=True)
    share, own = counts / len(rows), vectors[used]
    mean = share @ own
    spread = np.sqrt(np.maximum(share @ (own * own) - mean * mean, 0))
    return np.concatenate([mean, spread, [np.log1p(len(rows)) / 10]]).astype(np.float32)


def document_vectors(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, vector)`` for every row: two scans of the texts, none of which is shuffled."""
    table = docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash(8)
        for batch in batches:
            flat = np.concatenate([pooled(token_rows(t, hashes), table.value) for t in batch.column(1).to_pylist()] or [np.zeros(0, np.float32)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(flat), WIDTH).cast(pa.list_(pa.float32()))], names=["key", "vector"])

    named = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(pool, f"key {named.schema[0].dataType.simpleString()}, vector array<float>")


@dataclass
class Network:
    """``sigmoid((tanh(z @ w1 + b1) @ w2 + b2) / temperature)`` of standardised features z."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def constant(score: float) -> Network:
    """The network for labels of one class or none: the same score for every document."""
    zeros = np.zeros((WIDTH, HIDDEN))
    return Network(np.zeros(WIDTH), np.ones(WIDTH), zeros, zeros[0], np.zeros(HIDDEN), float(np.log(score / (1 - score))))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the cross-entropy."""
    rng = np.random.default_rng(SEED)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    weights = [rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            chosen = order[at : at + BATCH]
            h = np.tanh(z[chosen] @ weights[0] + weights[1])
            off = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -30, 30))) - y[chosen]) / len(chosen)
            back = np.outer(off, weights[2]) * (1 - h * h)
            t += 1
            for k, slope in enumerate((z[chosen].T @ back, back.sum(0), h.T @ off, np.array([off.sum()]))):
                slope = slope + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                weights[k] = weights[k] - RATE * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return Network(mean, scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def calibrated(network: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The temperature with the smallest cross-entropy on rows that the network was not fitted on."""
    if len(x) and 0 < y.mean() < 1:
        logits = network.logits(x)

        def loss(temperature: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / temperature, -30, 30))), 1e-9, 1 - 1e-9)
            return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

        network.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return network


def fold(key: str):
    """crc32 of the id as text, modulo 5: 0 is held out, 1 calibrates, the rest trains; null for null ids."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def train(vectors: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> Network:
    """Fit on labelled documents outside the held-out fold.

    A document labelled several times gets the majority, ties 1; null ids and labels are ignored. With one class only
    the score is its share, smoothed; without any label it is one half.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    known = known.where(fold("_k") != 0)
    # Ids alone decide which rows train; the vectors of those, a bounded number, meet them by broadcast.
    present = vectors.select("key").join(known, F.col("key") == F.col("_k")).select("_k", "y", F.xxhash64("_k").alias("h")).distinct()
    chosen = F.broadcast(present.orderBy("h", "_k").limit(TRAINING_ROWS))
    rows = (
        vectors.join(chosen, F.col("key") == F.col("_k"))
        .select("vector", "y", (fold("key") == 1).alias("calibrates"), "h", "key", F.xxhash64("vector").alias("text_hash"))
        .orderBy("h", "key", "text_hash")
        .limit(TRAINING_ROWS)
        .select("vector", "y", "calibrates")
        .toArrow()
    )
    y = rows.column("y").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return constant((y.sum() + 1) / (len(y) + 2))
    x = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, WIDTH).astype(float)
    held = rows.column("calibrates").to_numpy(zero_copy_only=False)
    if y[~held].min(initial=1) == y[~held].max(initial=0):
        held[:] = False
    return calibrated(fit(x[~held], y[~held]), x[held], y[held])


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.3) -> DataFrame:
    """``(key, held_out, score, predicted)`` for every row of ``docs``.

    Scores depend on the text alone. Null and empty texts have the zero vector and its score. Null keys are not held
    out. Repeated rows are kept; other columns are not read; no rows give no rows. The table of document vectors is
    written to the shared folder once, so that training and scoring read no text again.
    """
    vectors = materialise(document_vectors(docs, key, text), "document-vectors")
    network = docs.sparkSession.sparkContext.broadcast(train(vectors, labels, key))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy().reshape(-1, WIDTH).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(network.value.scores(x))], names=["key", "score"])

    scored = vectors.mapInArrow(score, f"key {vectors.schema[0].dataType.simpleString()}, score double")
    return scored.select(
        F.col("key").alias(key), F.coalesce(fold("key") == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted")
    )
