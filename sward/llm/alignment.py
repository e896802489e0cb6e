"""Alignment of two tokenizers by bytes, and how often the corpus links each pair of their ids.

Every document's links leave its task as sorted runs of (pair, document) records, one run per radix partition of the
second tokenizer's ids, packed with zstd. Runs are merged by a heap, which counts each pair over the corpus; since pairs
are sorted by the second side first, all counts of an id pass together and give its highest. Then every run meets the
counts of its partition and streams back what each document's links are worth.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sward.session import materialise

@dataclass(frozen=True)
class Sizes:
    """``radix`` partitions of the second tokenizer's ids, so that one has at most 1/radix of all pairs of ids. A chunk of
    documents ends at ``chunk_docs`` (records name a document by its place in the chunk) or ``chunk_links``. Merged counts
    come in blocks of ``block_pairs``, from ``fan_in`` runs at a time. ``sharing`` chunks use one copy of a partition's
    counts when their records are valued.
    """

    radix: int = 64
    chunk_docs: int = 4096
    chunk_links: int = 1_500_000
    block_pairs: int = 1 << 16
    fan_in: int = 64
    sharing: int = 1024


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, others follow 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Side:
    """One tokenizer: its encoder and each id's bytes."""

    encode: object
    pieces: list[bytes]
    sizes: np.ndarray


#: Longest text in characters that the quick encoder gets; its pattern matcher has a stack of fixed size.
QUICK = 100_000


@functools.lru_cache(maxsize=2)
def byte_side(path: str, pattern: str | None = None) -> Side:
    """The byte-level tokenizer at ``path``. Strings of special tokens inside texts are ordinary text.

    With ``pattern``, by which the vocabulary was split into words, texts are encoded by ranks, several times as fast, if the
    file's ids are its merges in order and nothing normalises the text; long texts always go through the file's own rules.
    """
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    letters = byte_letters()
    ids = {**rules["model"]["vocab"], **{t["content"]: t["id"] for t in rules.get("added_tokens", [])}}
    pieces = [b""] * (1 + max(ids.values()))
    for name, i in ids.items():
        pieces[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
    quick = _by_ranks(rules, pieces, pattern) if pattern else None

    def encode(text: str) -> list[int]:
        if quick and len(text) <= QUICK:
            return quick(text)
        return _tokenizer(path).encode(text, add_special_tokens=False).ids

    return Side(encode, pieces, np.array([len(p) for p in pieces], np.int64))


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The library's tokenizer, loaded when a text first needs it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _by_ranks(rules: dict, pieces: list[bytes], pattern: str):
    """An encoder that takes ids for ranks, or None where that would not give the file's ids."""
    model, split = rules["model"], rules.get("pre_tokenizer") or {}
    vocabulary, merges = model.get("vocab", {}), [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    in_order = len(vocabulary) >= 256 + len(merges) and all(vocabulary.get("".join(m)) == 256 + i for i, m in enumerate(merges))
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    if not (in_order and plain and model.get("type") == "BPE" and not rules.get("normalizer") and not model.get("dropout")):
        return None
    import tiktoken

    ranks = {pieces[i]: i for i in range(256 + len(merges))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@functools.lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """The sentencepiece model at ``path``; byte pieces are their byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    return Side(lambda text: model.encode(text, num_threads=1), pieces, np.array([len(p) for p in pieces], np.int64))


@dataclass
class Aligned:
    """Ids of one text and, for every link, its two tokens."""

    first: np.ndarray
    second: np.ndarray
    linked: np.ndarray
    linked_to: np.ndarray
    closes: np.ndarray
    closes_to: np.ndarray


def align(first: np.ndarray, second: np.ndarray, first_sizes: np.ndarray, second_sizes: np.ndarray) -> Aligned:
    """Links of two token lists over the same bytes. Between two neighbouring ends, of either side, lies just one link."""
    ends, ends_to = np.cumsum(first_sizes[first]), np.cumsum(second_sizes[second])
    before, before_to = np.searchsorted(ends_to, ends), np.searchsorted(ends, ends_to)
    closes, closes_to = ends == ends_to[before], ends_to == ends[before_to]
    # An end's place among all ends: those of its own side and of the other one before it, shared ones once.
    own, other = np.arange(len(first)), np.arange(len(second))
    place = own + before - (np.cumsum(closes) - closes)
    place_to = other + before_to - (np.cumsum(closes_to) - closes_to)
    size = len(first) + len(second) - int(closes.sum())
    linked, linked_to = np.empty(size, np.int64), np.empty(size, np.int64)
    linked[place_to], linked_to[place_to] = before_to, other
    linked[place], linked_to[place] = own, before
    return Aligned(first, second, linked, linked_to, closes, closes_to)


def group_pieces(n_first: int, n_second: int) -> list[bytes]:
    """Decimal ids with what may follow them: ids of the first side inside and at the end of a group, then the second's."""
    return [b"%d%c" % (i, c) for size, marks in ((n_first, b",|"), (n_second, b",;")) for i in range(size) for c in marks]


def group_text(found: Aligned, pieces: list[bytes], n_first: int) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids in order."""
    end, end_to = np.flatnonzero(found.closes) + 1, np.flatnonzero(found.closes_to) + 1
    group = np.cumsum(found.closes) - found.closes
    group_to = np.cumsum(found.closes_to) - found.closes_to
    where = np.empty(len(found.first) + len(found.second), np.int64)
    where[np.arange(len(found.first)) + np.concatenate([[0], end_to])[group]] = 2 * found.first + found.closes
    where[np.arange(len(found.second)) + end[group_to]] = 2 * (n_first + found.second) + found.closes_to
    return b"".join(map(pieces.__getitem__, where.tolist()))[:-1]


# Runs


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in as few bytes each as the largest needs, then zstd."""
    top = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(values.astype(f"<u{width}").tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data[1:])
    return np.frombuffer(raw, f"<u{data[0]}").astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


RUN = "radix int, low long, pairs binary, counts binary, repeats binary, docs binary, times binary"
FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ENCODED = "key {key}, chunk long, place int, " + FIGURES + ", " + RUN


def spill(records: np.ndarray, n_first: int, n_second: int, sizes: Sizes) -> Iterator[dict]:
    """The sorted runs of a chunk's records, one per radix partition that has any.

    A record is (radix, second id, first id, document) in one number; equal ones are counted as one.
    """
    records = np.sort(records)
    starts = np.flatnonzero(np.diff(records, prepend=-1))
    times = np.diff(np.append(starts, len(records)))
    whole, docs = np.divmod(records[starts], sizes.chunk_docs)
    radix, pairs = np.divmod(whole, n_first * n_second)
    bounds = np.searchsorted(radix, np.arange(sizes.radix + 1))
    for r in np.flatnonzero(np.diff(bounds)):
        here = slice(bounds[r], bounds[r + 1])
        first_of = np.flatnonzero(np.diff(pairs[here], prepend=-1))
        yield {
            "radix": int(r),
            "low": int(pairs[bounds[r]]),
            "pairs": pack_sorted(pairs[here][first_of]),
            "counts": pack(np.add.reduceat(times[here], first_of)),
            "repeats": pack(np.diff(np.append(first_of, bounds[r + 1] - bounds[r]))),
            "docs": pack(docs[here]),
            "times": pack(times[here]),
        }


def _encoder(first_path: str, second_path: str, pattern: str | None, key_type: str, sizes: Sizes):
    columns = [c.split()[0] for c in ENCODED.format(key=key_type).split(", ")]
    kinds = {"chunk": pa.int64(), "low": pa.int64(), "place": pa.int32(), "radix": pa.int32(), "groups_sha256": pa.string()}
    kinds |= dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), pa.int64())
    kinds |= dict.fromkeys(("pairs", "counts", "repeats", "docs", "times"), pa.binary())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, second = byte_side(first_path, pattern), piece_side(second_path)
        n_first, n_second = len(first.pieces), len(second.pieces)
        pieces = group_pieces(n_first, n_second)
        chunk, place, waiting, links, kind = TaskContext.get().partitionId() << 32, 0, [], 0, None

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kinds.get(c, kind)) for c in columns], names=columns)

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting:
                for run in spill(np.concatenate(waiting), n_first, n_second, sizes):
                    yield batch_of([{"chunk": chunk, **run}])

        for batch in batches:
            kind = batch.schema.field("key").type
            rows = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                row = {"key": key, "chunk": chunk, "place": place, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
                text = text.as_py()
                if text:
                    spaced = " " + text
                    a, b, target = first.encode(spaced), second.encode(text), spaced.encode()
                    if b"".join(map(first.pieces.__getitem__, a)) == target == b"".join(map(second.pieces.__getitem__, b)):
                        found = align(np.array(a, np.int64), np.array(b, np.int64), first.sizes, second.sizes)
                        ids, ids_to = found.first[found.linked], found.second[found.linked_to]
                        waiting.append((((ids_to % sizes.radix) * n_second + ids_to) * n_first + ids) * sizes.chunk_docs + place)
                        links += len(ids)
                        row |= {"n_a": len(a), "n_b": len(b), "n_groups": int(found.closes.sum()), "n_links": len(ids)}
                        row["groups_sha256"] = hashlib.sha256(group_text(found, pieces, n_first)).hexdigest()
                rows.append(row)
                place += 1
                if place == sizes.chunk_docs or links >= sizes.chunk_links:
                    yield from flush()
                    chunk, place, waiting, links = chunk + 1, 0, [], 0
            if rows:
                yield batch_of(rows)
        yield from flush()

    return encode


# Merging

COUNTS = "radix int, run long, low long, pairs binary, counts binary, best binary"


class Merge:
    """Counts of one radix partition from blocks that come in the order of their first pairs.

    What lies below a new block's first pair is complete: the heap gives the waiting blocks that reach below it. Blocks go
    out whole in ids of the second side, with the pairs that have its highest count marked.
    """

    def __init__(self, n_first: int, block_pairs: int):
        self.n_first, self.block_pairs, self.heap, self.done, self.seen = n_first, block_pairs, [], [], 0

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.seen += 1
        heapq.heappush(self.heap, (int(pairs[0]), self.seen, pairs, counts))

    def drain(self, below: int | None) -> None:
        parts = []
        while self.heap and (below is None or self.heap[0][0] < below):
            _, order, pairs, counts = heapq.heappop(self.heap)
            cut = len(pairs) if below is None else int(np.searchsorted(pairs, below))
            parts.append((pairs[:cut], counts[:cut]))
            if cut < len(pairs):
                heapq.heappush(self.heap, (int(pairs[cut]), order, pairs[cut:], counts[cut:]))
        if parts:
            pairs, counts = (np.concatenate(p) for p in zip(*parts))
            order = np.argsort(pairs, kind="stable")
            starts = np.flatnonzero(np.diff(pairs[order], prepend=-1))
            self.done.append((pairs[order][starts], np.add.reduceat(counts[order], starts)))

    def blocks(self, last: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if not self.done or (not last and sum(len(p) for p, _ in self.done) < self.block_pairs):
            return
        pairs, counts = (np.concatenate(p) for p in zip(*self.done))
        side = pairs // self.n_first
        # The last id may get further pairs, so it waits; a block holds at most the pairs of one id more than its size.
        cut = len(pairs) if last else int(np.searchsorted(side, side[-1]))
        self.done = [(pairs[cut:], counts[cut:])] if cut < len(pairs) else []
        if cut:
            starts = np.flatnonzero(np.diff(side[:cut], prepend=-1))
            highest = np.maximum.reduceat(counts[:cut], starts)
            sizes = np.diff(np.append(starts, cut))
            yield pairs[:cut], counts[:cut], (counts[:cut] == np.repeat(highest, sizes)).astype(np.int64)


def _merger(n_first: int, block_pairs: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        names = [c.split()[0] for c in COUNTS.split(", ")]

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            for pairs, counts, best in state.blocks(last):
                values = [now[0]], [now[1]], [int(pairs[0])], [pack_sorted(pairs)], [pack(counts)], [pack(best)]
                kinds = pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            for radix, group, pairs, counts in zip(*[batch.column(c).to_pylist() for c in ("radix", "group", "pairs", "counts")]):
                if now != (radix, group):
                    if state is not None:
                        state.drain(None)
                        yield from out(True)
                    now, state = (radix, group), Merge(n_first, block_pairs)
                pairs = unpack_sorted(pairs)
                state.drain(int(pairs[0]))
                yield from out(False)
                state.add(pairs, unpack(counts))
        if state is not None:
            state.drain(None)
            yield from out(True)

    return merge


def merged_counts(runs: DataFrame, n_runs: int, n_first: int, sizes: Sizes) -> DataFrame:
    """``(radix, run, low, pairs, counts, best)``: corpus counts in blocks. Rounds of merges, ``fan_in`` runs at a time."""
    while True:
        groups = math.ceil(n_runs / sizes.fan_in)
        rows = runs.select("radix", F.pmod(F.xxhash64("run"), F.lit(groups)).alias("group"), "low", "pairs", "counts")
        dealt = rows.repartition("radix", "group").sortWithinPartitions("radix", "group", "low")
        runs = materialise(dealt.mapInArrow(_merger(n_first, sizes.block_pairs), COUNTS), "pair-counts")
        if groups == 1:
            return runs
        n_runs = groups


VALUES = "chunk long, best binary, sums binary"


def _value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's counts come first, then its runs; each run gives its documents' sums, by place."""
    now, parts, table = None, [], None
    for batch in batches:
        out = []
        wanted = ("radix", "group", "chunk", "pairs", "counts", "best", "repeats", "docs", "times")
        for radix, group, chunk, pairs, counts, best, repeats, docs, times in zip(*[batch.column(c) for c in wanted]):
            if now != (radix.as_py(), group.as_py()):
                now, parts, table = (radix.as_py(), group.as_py()), [], None
            if not chunk.is_valid:
                parts.append((unpack_sorted(pairs.as_py()), unpack(counts.as_py()), unpack(best.as_py())))
                continue
            if table is None:
                table, parts = [np.concatenate(p) for p in zip(*parts)], []
            at = np.repeat(np.searchsorted(table[0], unpack_sorted(pairs.as_py())), unpack(repeats.as_py()))
            places, n = unpack(docs.as_py()), unpack(times.as_py())
            best_of, sum_of = np.zeros(places.max() + 1, np.int64), np.zeros(places.max() + 1, np.int64)
            np.add.at(best_of, places, n * table[2][at])
            np.add.at(sum_of, places, n * table[1][at])
            out.append((chunk.as_py(), pack(best_of), pack(sum_of)))
        if out:
            kinds = pa.int64(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["chunk", "best", "sums"])


RESULT = "key {key}, " + FIGURES + ", n_best long, count_sum long"


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's sums come first, then its documents. Documents without links stand behind those with sums, if at all."""
    now, totals = None, None
    figures = [c.split()[0] for c in FIGURES.split(", ")]
    for batch in batches:
        keep, extra = [], []
        for i, (chunk, place, best, sums) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("chunk", "place", "best", "sums")])):
            if chunk != now:
                now, totals = chunk, np.zeros((2, 1), np.int64)
            if place is None:
                values = np.stack([unpack(best), unpack(sums)])
                if values.shape[1] > totals.shape[1]:
                    values, totals = totals, values
                totals[:, : values.shape[1]] += values
            else:
                keep.append(i)
                extra.append(totals[:, place].tolist() if place < totals.shape[1] else [0, 0])
        if keep:
            rows = batch.take(pa.array(keep, pa.int32()))
            both = [pa.array(c, pa.int64()) for c in zip(*extra)]
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in ("key", *figures)] + both, names=["key", *figures, "n_best", "count_sum"])


def align_tokenizers(
    docs: DataFrame,
    first_path: str,
    second_path: str,
    pattern: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row.

    Side a is a byte-level tokenizer, which gets a space and the text; side b a sentencepiece model, which adds that space.
    Tokens are linked where their bytes overlap, and grouped between the ends they share. A pair's count is its number of
    links in all rows; ``n_best`` counts a row's links whose count is the highest of their b id, ``count_sum`` sums counts.
    Null and empty texts, and texts that either side does not give back byte by byte, have zeros and an empty digest.
    Repeated rows and null keys are kept and counted each; other columns are not read; no rows give no rows.

    Records of a chunk are packed where they arise and lie in the shared folder; counts, not records, are merged, so a
    pair that every document has is a number per chunk. Valuing needs one partition's counts, at most 1/``radix`` of
    the pairs of the vocabularies, and one run at a time; each chunk has one run a partition, so common ids spread by chunk.
    """
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    n_first = len(byte_side(first_path).pieces)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    encoded = materialise(rows.mapInArrow(_encoder(first_path, second_path, pattern, key_type, sizes), ENCODED.format(key=key_type)), "aligned-runs")
    figures = [c.split()[0] for c in FIGURES.split(", ")]
    runs = encoded.where(F.col("radix").isNotNull()).select("chunk", *[c.split()[0] for c in RUN.split(", ")])
    chunks = max(1, runs.select("chunk").distinct().count())
    ordered = runs.select("radix", F.col("chunk").alias("run"), "low", "pairs", "counts")
    counts = merged_counts(ordered, chunks, n_first, sizes)
    groups = math.ceil(chunks / sizes.sharing)
    copies = counts.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), "low", "pairs", "counts", "best")
    dealt = runs.withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(groups))).drop("counts").unionByName(copies, allowMissingColumns=True)
    in_turn = dealt.repartition("radix", "group").sortWithinPartitions("radix", "group", F.col("chunk").asc_nulls_first(), "low")
    values = in_turn.mapInArrow(_value, VALUES)
    results = encoded.where(F.col("radix").isNull()).select("key", "chunk", "place", *figures).unionByName(values, allowMissingColumns=True)
    gathered = results.repartition("chunk").sortWithinPartitions("chunk", F.col("place").asc_nulls_first())
    result = gathered.mapInArrow(_gather, RESULT.format(key=key_type))
    return result.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
