"""Quality rules: base rules on words and lines, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed uni- and bigrams are counted over the whole corpus: one of all texts, one of the trusted
ones. A document's score is the mean log ratio of the two over its n-grams; it is kept from a fixed score on. Rare
n-grams say little: a prior of the shape of the raw counts pulls their ratios to 0, so that words of a few clean texts
are not taken for junk in a small corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.llm.textual import SPACES, WordHash, sliced, utf8

#: Hash buckets of the multinomials: a driver and worker array of 512 KB whatever the corpus.
BUCKETS = 1 << 16
#: Raw n-grams that a bucket needs to count for half of what it says; until then its ratio stays near 0.
PRIOR = 4.0
#: Kept from this mean log ratio (nats per n-gram) on.
LEAST_SCORE = -0.15
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50
#: A text is trusted when it has at most these percentages of symbols and capitals among word characters, of repeated
#: words among words, and no repeated line, whatever its length.
TRUSTED_SYMBOLS, TRUSTED_CAPITALS, TRUSTED_REPEATED = 1, 15, 20
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    n = len(hashes)
    if n < 4:
        return 0
    values, ids = np.unique(hashes, return_inverse=True)
    ids = ids.astype(np.int64)
    pairs = np.unique(ids[:-1] * len(values) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, window, count = np.unique(pairs[:-1] * len(values) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


def measure(text: str | None, hashes: WordHash) -> tuple[tuple[int, ...], bool, np.ndarray]:
    """The base features, whether the text is trusted, and the buckets of its n-grams."""
    text = text or ""
    words = hashes.of(utf8(text).split())
    lines = Counter(line for line in text.split("\n") if line.strip(SPACES))
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    features = (len(words), chars, symbols, lines.total() - len(lines), repeated_words(words))
    trusted = (
        100 * symbols <= TRUSTED_SYMBOLS * chars
        and 100 * features[4] <= TRUSTED_REPEATED * features[0]
        and features[3] == 0
        and 100 * sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) <= TRUSTED_CAPITALS * chars
    )
    grams = np.concatenate([words, words[:-1] * 31 + words[1:]]) % BUCKETS
    return features, trusted, grams


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, raw, target = WordHash(8), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in sliced(batches):
        for text in batch.column(0).to_pylist():
            _, trusted, grams = measure(text, hashes)
            counts = np.bincount(grams, minlength=BUCKETS) if len(grams) > BUCKETS // 8 else None
            for table in (raw, target) if trusted else (raw,):
                if counts is None:
                    np.add.at(table, grams, 1)
                else:
                    table += counts
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, raw[used], target[used])], names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log ratio of every bucket, from exact counts over all rows.

    Each task sends at most one row per bucket; the sums, one row per bucket, are the only thing the driver receives.
    An empty corpus, or one without trusted texts, gives zeros, so that every score is 0 and every text kept.
    """
    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_count, "bucket long, raw long, target long")
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.any():
        return np.zeros(BUCKETS)
    trusted = target.sum() / raw.sum()
    return np.log((target + PRIOR * trusted) / ((raw + PRIOR) * trusted))


def judge(text: str | None, hashes: WordHash, ratios: np.ndarray) -> tuple[tuple[int, ...], float, bool, bool]:
    """``(features, score, base_failed, kept)`` of one text."""
    features, _, grams = measure(text, hashes)
    score = float(ratios[grams].mean()) if len(grams) else 0.0
    failed = base_failed(features[0], features[4])
    return features, score, failed, not failed and score >= LEAST_SCORE


def rate_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score, base_failed, kept)`` for every row.

    Null and empty texts have no words, so they fail the base rules; repeated rows and null keys are kept as rows;
    other columns are not read; no rows give no rows. Two scans of the texts, no shuffle of them.
    """
    model = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, text))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash(8)
        for batch in sliced(batches):
            rated = [judge(t, hashes, model.value) for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[0][k] for r in rated], pa.int64()) for k in range(len(FEATURES))]
            columns += [pa.array([r[1] for r in rated], pa.float64())] + [pa.array([r[k] for r in rated], pa.bool_()) for k in (2, 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", *FEATURES, "score", "base_failed", "kept"])

    named = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {named.schema[0].dataType.simpleString()}, {', '.join(f'{f} long' for f in FEATURES)}, score double, base_failed boolean, kept boolean"
    return named.mapInArrow(rate, schema).withColumnRenamed("key", key)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns as they are.

    Rows with null or empty texts fail the base rules and go; repeated rows stay or go together; no rows give no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, text))
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash(8)
        for batch in sliced(batches):
            yield batch.filter(pa.array([judge(t, hashes, model.value)[3] for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
