"""Benchmark decontamination with a generalised suffix automaton over the words of all test items.

Training words stream through the automaton, which always knows the longest run of words, ending here, that occurs in
some item. A run of ``window`` words is a leak; an item of fewer words leaks where it occurs as a whole.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sward.llm.textual import ALNUM_LOWER, sliced, utf8
from sward.session import discard, free_name, materialise

WINDOW = 10
#: Words of items that one automaton holds at most, give or take what a hash deals unevenly (one item may exceed it);
#: more items go to further automata, one pass over the texts each, so that no process holds the whole benchmark.
AUTOMATON_WORDS = 500_000
#: Bytes of an automaton in one stored row.
PIECE = 1 << 22


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case; runs of ASCII letters and digits and of all other non-ASCII characters."""
    return utf8(text).translate(ALNUM_LOWER).split()


class Automaton:
    """Suffix automaton of many word sequences, with the items in which each window occurs.

    ``following[s]`` maps words to states, ``link[s]`` is the suffix link and ``length[s]`` the longest run of state s.
    Items are positions in ``ids``; a window's are kept once, at the state whose shortest runs are no shorter than it.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window, self.ids = window, []
        self.following: list[dict[bytes, int]] = [{}]
        self.link, self.length, added = [-1], [0], []
        for name, words in items:
            if words:
                self._add(words)
                added.append(words)
                self.ids.append(name)
        self._place(added)

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.following.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.following[q]))
        self.link[q] = copy
        while p >= 0 and self.following[p].get(word) == q:
            self.following[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        q = self.following[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        now, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.following[p]:
            self.following[p][word] = now
            p = self.link[p]
        if p >= 0:
            q = self.following[p][word]
            self.link[now] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return now

    def _add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _place(self, items: list[list[bytes]]) -> None:
        """The state of every state's last window, the items of these, and where short items end."""
        n = len(self.link)
        self.whole: dict[int, list[tuple[int, int]]] = {}
        self.leaks: dict[int, list[int]] = {}
        self.own, self.near = [0] * n, [0] * n
        ends = []
        for item, words in enumerate(items):
            state = 0
            for word in words:
                state = self.following[state][word]
            if len(words) < self.window:
                self.whole.setdefault(state, []).append((len(words), item))
            ends.append(state)
        for s in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= self.window:
                self.own[s] = self.own[up] or s
            self.near[s] = up if up in self.whole else self.near[up] if up > 0 else 0
        # Walking an item from the start passes all its windows.
        for item, words in enumerate(items):
            state = 0
            for at, word in enumerate(words):
                state = self.following[state][word]
                if at + 1 >= self.window:
                    found = self.leaks.setdefault(self.own[state], [])
                    if not found or found[-1] != item:
                        found.append(item)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans ``[start, end)`` in words, merged and in order, and the names of items that occur."""
        following, link, length, window = self.following, self.link, self.length, self.window
        own, near, whole = self.own, self.near, self.whole
        spans: list[tuple[int, int]] = []
        windows, items = set(), set()
        state = run = 0
        for at, word in enumerate(words):
            after = following[state].get(word)
            while after is None and state:
                state = link[state]
                run = length[state]
                after = following[state].get(word)
            if after is None:
                run = 0
                continue
            state, run = after, run + 1
            hit = 0
            if run >= window:
                hit = window
                windows.add(own[state])
            end = state if state in whole else near[state]
            while end:
                for size, item in whole[end]:
                    if run >= size:
                        hit = max(hit, size)
                        items.add(item)
                end = near[end]
            if hit:
                start = at + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at + 1))
        for s in windows:
            items.update(self.leaks[s])
        return spans, {self.ids[i] for i in items}


def store_automata(items: DataFrame, window: int, key: str = "item_id", text: str = "text") -> tuple[DataFrame, list[int]]:
    """A written table ``(block, part, data)`` of pickled automata, and its blocks.

    Items are dealt to blocks by a hash, as many as keep each below ``AUTOMATON_WORDS`` (a word has two bytes at least,
    with the space behind it). A task builds one block at a time; repeated rows go before. Null texts are no items.
    """
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.where("text IS NOT NULL").distinct()
    most = rows.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(most / AUTOMATON_WORDS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        named = sorted(zip(group["key"], group["text"]))
        data = pickle.dumps(Automaton(((k, words_of(t)) for k, t in named), window), pickle.HIGHEST_PROTOCOL)
        pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
        return pd.DataFrame({"block": int(group["block"].iloc[0]), "part": range(len(pieces)), "data": pieces})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))
    stored = materialise(dealt.groupBy("block").applyInPandas(build, "block long, part long, data binary"), "automata")
    return stored, sorted(r["block"] for r in stored.select("block").distinct().collect())


#: The automaton that a worker used last, by the name of its pass.
_LOADED: dict[str, Automaton] = {}


def loaded(name: str, data: bytes) -> Automaton:
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = pickle.loads(data)
    return _LOADED[name]


Finish = Callable[[pa.RecordBatch, list[tuple[int, list[tuple[int, int]], list[str]]]], pa.RecordBatch]


def met_items(docs: DataFrame, items: DataFrame, window: int, text: str, finish: Finish, schema: T.StructType | str) -> DataFrame:
    """Scan every text with the automata of all blocks; ``finish`` makes the rows of ``schema`` from a batch of ``docs`` and

    ``(number of words, hit spans in words, sorted item ids)`` of each row. One pass for each block: the driver and every
    worker hold one automaton at a time. Passes before the last write the documents with what they have met.
    """
    spark, at = docs.sparkSession, docs.columns.index(text)
    stored, blocks = store_automata(items, window)
    spans_name, items_name = free_name(docs, "_spans"), free_name(docs, "_items")
    now = docs.select("*", F.lit(None).cast("array<long>").alias(spans_name), F.lit(None).cast("array<string>").alias(items_name))

    def meeting(name: str, data: Broadcast, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = loaded(name, data.value)
            for batch in sliced(batches):
                own, (before, names) = batch.columns[:-2], [c.to_pylist() for c in batch.columns[-2:]]
                found = []
                for t, ends, met in zip(own[at].to_pylist(), before, names):
                    words = words_of(t)
                    spans, more = automaton.scan(words)
                    if ends:
                        spans = merged([*zip(ends[::2], ends[1::2]), *spans])
                    found.append((len(words), spans, sorted(more.union(met or ()))))
                if last:
                    yield finish(pa.RecordBatch.from_arrays(own, schema=pa.schema([batch.schema.field(i) for i in range(len(own))])), found)
                else:
                    flat = [[e for span in f[1] for e in span] for f in found]
                    columns = [pa.array(c, batch.schema.field(len(own) + i).type) for i, c in enumerate((flat, [f[2] for f in found]))]
                    yield pa.RecordBatch.from_arrays([*own, *columns], schema=batch.schema)

        return scan

    def automaton_of(block: int) -> bytes:
        return b"".join(bytes(r["data"]) for r in stored.where(F.col("block") == block).orderBy("part").toLocalIterator())

    for block in blocks[:-1]:
        data = spark.sparkContext.broadcast(automaton_of(block))
        found = materialise(now.mapInArrow(meeting(uuid.uuid4().hex, data, False), now.schema), "met-items")
        data.destroy()
        if block != blocks[0]:
            discard(now)
        now = found
    data = spark.sparkContext.broadcast(automaton_of(blocks[-1]) if blocks else pickle.dumps(Automaton([], window)))
    discard(stored)
    return now.mapInArrow(meeting(uuid.uuid4().hex, data, True), schema)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_hit, items)`` for every row; ``items`` are the distinct ids, as sorted strings.

    Null texts, of documents or items, have no words; items without words never occur; items of fewer than ``window``
    words occur as a whole. A null item id counts as an empty string. Repeated rows and null keys are kept; other
    columns are not read; no rows give no rows, no items no hits. Texts are not shuffled, and scanned once for every
    ``AUTOMATON_WORDS`` words of items.
    """

    def finish(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        hits = pa.array([sum(e - s for s, e in f[1]) for f in found], pa.int64())
        columns = [batch.column(0), pa.array([f[0] for f in found], pa.int64()), hits, pa.array([f[2] for f in found], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_hit", "items"])

    named = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {named.schema[0].dataType.simpleString()}, n_words long, n_hit long, items array<string>"
    return met_items(named, items, window, "text", finish, schema).withColumnRenamed("key", key)


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters from the first to the last word of every span."""
    places = word_places(text)
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


#: Words in the original text: as in ``words_of``, with capitals still in place.
PLACES = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def word_places(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PLACES.finditer(text)]


def remove_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_share: float = 0.01, text: str = "text") -> DataFrame:
    """``docs`` without leaks: hit spans are cut out, and rows with more than ``most_share`` of hit words go.

    All columns stay as they are except ``text``; rows without hits, null texts included, are unchanged. Repeated rows are
    kept or cut alike; no rows give no rows, no items change nothing; columns may have any names.
    """
    at = docs.columns.index(text)

    def finish(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
        texts, keep = batch.column(at).to_pylist(), []
        for k, (n, spans, _) in enumerate(found):
            keep.append(sum(e - s for s, e in spans) <= most_share * n)
            if spans and keep[-1]:
                texts[k] = without_spans(texts[k], spans)
        columns = [pa.array(texts, batch.schema.field(at).type) if k == at else c for k, c in enumerate(batch.columns)]
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep, pa.bool_()))

    return met_items(docs, items, window, text, finish, docs.schema)
