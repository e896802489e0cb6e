"""N-gram Jaccard join: a size-aware heavy-light join on word shingles, and the classes its links make.

Exact copies (equal shingle sets) are one class from the start. Sets are ordered by a global order of shingles, frequent
ones last. Two sets with similarity t share at least two shingles of their first n - ceil(t n) + 2, and one of their
first n - ceil(t n) + 1. Small sets therefore enumerate all two-element subsets of the longer prefix, large sets are
found by scanning the inverted lists of the shorter one; the boundary is the size at which the two cost least. Small
sets close enough to the boundary to be similar to a large one are in the lists, too.

Only classes matter, so pairs that are connected already are never formed: links to leaders of shared minimum hashes are
verified first, and lists whose sets all belong to one class produce nothing. Every remaining candidate pair of
different classes is verified against whole sets.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sward.llm.components import components
from sward.llm.textual import ASCII_LOWER, sliced, utf8
from sward.session import discard, free_name, materialise

SIZE, PERCENT = 5, 75
#: Shingles whose frequency the global order knows, the most frequent ones: 6 MB in the driver and in every worker. The
#: order decides how long lists get, never which pairs are found.
KNOWN = 1 << 18
#: Bits of the filter of list keys per key, and the logarithm of its most 64-bit words (8 MB). With more keys than that
#: holds it lets more entries through to the exact join.
KEY_BITS, MOST_WORDS = 16, 20
#: Leaders that a set of another class is compared with in a round over the lists, and rounds at most; a round that
#: finds no link is the last. What rounds leave is enumerated in full.
LEADERS, ROUNDS = 3, 2
#: A leader is compared with sets that meet it in one list for so many shingles of the smaller set, or more.
AGREEING = 100
#: Percentage of a set's size by which prefixes are longer than they need be, so that pairs have to share as many shingles more.
MARGIN = 3
#: Shingles of a task that are counted together.
COUNTED = 1 << 20
#: Joins of texts with at most so many ids broadcast them; with more, both sides are shuffled.
BROADCAST_IDS = 1_000_000
#: Cost of an entry in an inverted list, in enumerated subsets: lists of one shingle meet more often than pairs of two.
LIST_COST = 3
#: Largest boundary that is considered; subsets grow with the square of the size.
LARGEST_LIGHT = 64
#: Pairs of one first document that are verified together; more are spread over tasks.
GROUP = 256
#: Odd multipliers modulo 2**64: of a word's bytes and of a shingle's words.
BYTE_FACTOR, WORD_FACTOR = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)
#: A random number for every byte, and whether it separates words.
BYTE_VALUES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SEPARATES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes that are hashed together; longer texts are cut between words.
BLOCK = 1 << 18


@functools.lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the byte multiplier and of its inverse modulo 2**64."""
    both = []
    for factor in (BYTE_FACTOR, pow(BYTE_FACTOR, -1, 1 << 64)):
        column = np.full(BLOCK + 1, factor, np.uint64)
        column[0] = 1
        both.append(np.multiply.accumulate(column))
    return both[0], both[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of at most ``BLOCK`` bytes, from running sums over the bytes instead of word by word."""
    up, down = powers()
    codes = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~SEPARATES[codes], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    upto = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[codes] * up[: len(codes)], out=upto[1:])
    return mixed((upto[ends] - upto[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    if len(data) <= BLOCK:
        return block_hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            cut = max(data.rfind(bytes([c]), at, end) for c in (9, 10, 11, 12, 13, 32))
            if cut < 0:
                # One word longer than a block: it is hashed as its halves' names.
                stop = min((i for c in (9, 10, 11, 12, 13, 32) if (i := data.find(bytes([c]), end)) >= 0), default=len(data))
                parts.append(np.array([int.from_bytes(hashlib.blake2b(data[at:stop].lstrip(), digest_size=8).digest(), "little")], np.uint64))
                at = stop
                continue
            end = cut
        if end > at:
            parts.append(block_hashes(data[at:end]))
        at = max(end, at + 1)
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text of fewer words is one shingle, of none no shingle."""
    h = word_hashes(utf8(text).translate(ASCII_LOWER))
    if not len(h):
        return h
    size = min(SIZE, len(h))
    last = len(h) - size + 1
    total = h[:last].copy()
    for k in range(1, size):
        total *= WORD_FACTOR
        total += h[k : k + last]
    if size < SIZE:
        total += np.uint64(size)
    total = np.sort(mixed(total))
    first = np.empty(last, bool)
    first[0] = True
    np.not_equal(total[1:], total[:-1], out=first[1:])
    return total[first]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection >= 75 * union, for two sorted sets."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def prefix_lengths(n: int) -> tuple[int, int]:
    """How many first shingles share one, and how many share two, with those of every similar set."""
    need = -(-PERCENT * n // 100)
    return n - need + 1, min(n, n - need + 2)


SUMMARY = "key long, n long, print binary, least array<long>, known array<long>, times array<long>"


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, and rows without key that hold how often the task's more frequent shingles occur."""
    seen, waiting, size = set(), [], 0
    names, types = zip(*[(f.name, f.type) for f in SUMMARY_ARROW])

    def counted() -> list:
        values, times = np.unique(np.concatenate(waiting), return_counts=True)
        often = times > 1
        return [None, None, None, None, values[often].view(np.int64), times[often]]

    for batch in sliced(batches):
        rows = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            found = shingles(text)
            if not len(found):
                rows.append([key, 0, None, None, None, None])
                continue
            print_ = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
            starts = np.searchsorted(found, np.arange(8, dtype=np.uint64) << np.uint64(61))
            ends = np.append(starts[1:], len(found))
            rows.append([key, len(found), print_, found[starts[starts < ends]].view(np.int64), None, None])
            if print_ not in seen and len(seen) < 100_000:
                seen.add(print_)
                waiting.append(found)
                size += len(found)
        if size >= COUNTED:
            rows.append(counted())
            waiting, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types], names=list(names))
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(counted(), types)], names=list(names))


SUMMARY_ARROW = pa.schema(
    [("key", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("least", pa.list_(pa.int64())), ("known", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]
)


def _of_ids(texts: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Join texts with rows per ``key``: a written table whose size is known decides how."""
    return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "key", how)


def verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(a, b)``: the pairs whose whole sets are similar. ``pairs`` is a written table of distinct pairs.

    Sets are made from the texts of the documents concerned. A pair's second set goes to its first, whose own set goes
    to as many tasks as its pairs need; each task then streams sets behind the one they are compared with. An id with
    several texts has several sets; a link to any of them counts, and a task holds all those of the first id.
    """
    ids = materialise(pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct(), "pair-ids")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sets = [shingles(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary())], names=["key", "set"])

    sets = _of_ids(texts, ids, "left_semi").select("key", "text").mapInArrow(make, "key long, set binary")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    members = pairs.join(parts, "a").select(F.col("a").alias("group"), F.pmod(F.xxhash64("b"), "parts").alias("part"), F.col("b").alias("key"), F.lit(1).alias("role"))
    leaders = members.select("group", "part", F.col("group").alias("key"), F.lit(0).alias("role")).distinct()
    dealing = materialise(members.union(leaders), "pair-dealing")
    dealt = _of_ids(sets, dealing, "inner").select("group", "part", "role", "key", "set")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = None, {}
        for batch in sliced(batches):
            links = []
            for group, role, key, data in zip(*[batch.column(c).to_pylist() for c in ("group", "role", "key", "set")]):
                found = np.frombuffer(data, np.uint64)
                if role == 0:
                    if group != now:
                        now, own = group, {}
                    own[data] = found
                elif group == now and any(similar(x, found) for x in own.values()):
                    links.append((group, key))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    in_turn = dealt.repartition("group", "part").sortWithinPartitions("group", "part", "role", "key")
    links = materialise(in_turn.mapInArrow(compare, "a long, b long").distinct(), "links")
    discard(ids, dealing)
    return links


def boundary(sizes: dict[int, int], larger: int) -> int:
    """The size up to which sets enumerate subsets, from the number of sets of each small size and the entries of larger ones."""

    def cost(s: int) -> float:
        subsets = sum(c * math.comb(prefix_lengths(n)[1], 2) for n, c in sizes.items() if n <= s)
        entries = sum(c * prefix_lengths(n)[0] for n, c in sizes.items() if 100 * n >= PERCENT * (s + 1))
        return subsets + LIST_COST * (entries + larger)

    return min(range(1, LARGEST_LIGHT + 1), key=cost)


class Order:
    """The global order: shingles by known frequency, unknown ones (0) first, then by hash."""

    BITS = 22

    def __init__(self, known: np.ndarray, times: np.ndarray):
        by_hash = np.argsort(known)
        self.known, self.times = known[by_hash], times[by_hash]
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[self.known >> np.uint64(64 - self.BITS)] = True

    def first(self, found: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` first of a sorted set, in order."""
        times = np.zeros(len(found), np.int64)
        asked = np.flatnonzero(self.maybe[found >> np.uint64(64 - self.BITS)])
        if len(asked):
            at = np.minimum(np.searchsorted(self.known, found[asked]), len(self.known) - 1)
            times[asked] = np.where(self.known[at] == found[asked], self.times[at], 0)
        plain = found[times == 0]
        if len(plain) >= n:
            return plain[:n]
        often = np.flatnonzero(times)
        return np.concatenate([plain, found[often[np.lexsort((found[often], times[often]))]][: n - len(plain)]])


def in_lists(n: int, light: int) -> bool:
    """Whether a set of this size can be similar to one above the boundary, or is one."""
    return 100 * n >= PERCENT * (light + 1)


def join_keys(found: np.ndarray, order: Order, light: int) -> np.ndarray:
    """The keys under which a set meets similar ones: shingles of the short prefix, or pairs of the long one.

    The lowest bit tells the two kinds apart.
    """
    n = len(found)
    one, two = prefix_lengths(n)
    first = order.first(found, two)
    keys = []
    if in_lists(n, light):
        keys.append(first[:one] | np.uint64(1))
    if 2 <= n <= light:
        first = np.sort(first)
        a, b = np.triu_indices(two, 1)
        keys.append(mixed(first[a] * WORD_FACTOR + first[b]) & ~np.uint64(1))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def key_filter(shared: DataFrame, n: int) -> np.ndarray:
    """A blocked Bloom filter of list keys: 64-bit words with two bits a key. Made by the cluster, a bounded number of words."""
    bits = min(MOST_WORDS, max(6, math.ceil(math.log2(max(1, n) * KEY_BITS / 64))))
    bit = "shiftleft(1L, cast(shiftright(join_key, {}) & 63 as int))"
    word = F.expr(f"shiftrightunsigned(join_key, {64 - bits})").alias("word")
    found = shared.groupBy(word).agg(F.bit_or(F.expr(f"{bit.format(2)} | {bit.format(8)}")).alias("bits")).toArrow()
    words = np.zeros(1 << bits, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return words


def passing(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether keys may be in the filter; those that are always pass."""
    place = keys >> np.uint64(65 - len(words).bit_length())
    mask = (np.uint64(1) << ((keys >> np.uint64(2)) & np.uint64(63))) | (np.uint64(1) << ((keys >> np.uint64(8)) & np.uint64(63)))
    return words[place] & mask == mask


def _entries(texts: DataFrame, classes: DataFrame, order: Order, light: int, words: np.ndarray | None = None) -> DataFrame:
    """``(join_key, cls, key, n, at)``: the keys of the first document of every distinct set, with its class so far.

    ``at`` is the place of a shingle in the global order of its set, and 0 for pairs of shingles. With a filter, only
    keys that pass it.
    """
    shared_order = texts.sparkSession.sparkContext.broadcast((order, words))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, words = shared_order.value
        for batch in sliced(batches):
            all_keys, places, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                keys = join_keys(found, order, light) if len(found) else found
                at = np.arange(len(keys)) * (keys & np.uint64(1)).astype(np.int64)
                if words is not None:
                    pass_ = passing(keys, words)
                    keys, at = keys[pass_], at[pass_]
                all_keys.append(keys)
                places.append(at)
                sizes.append(len(found))
            lengths = np.array([len(k) for k in all_keys[1:]], np.int64)
            rows = np.repeat(np.arange(len(lengths)), lengths)
            columns = [batch.column("cls").take(pa.array(rows)), batch.column("key").take(pa.array(rows)), pa.array(np.array(sizes, np.int64)[rows]), pa.array(np.concatenate(places))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(all_keys).view(np.int64)), *columns], names=["join_key", "cls", "key", "n", "at"])

    classed = _of_ids(texts, classes, "left").where(F.coalesce("stays", F.lit(True)))
    return classed.select("key", F.coalesce("cls", "key").alias("cls"), "text").mapInArrow(emit, "join_key long, cls long, key long, n long, at long")


def overlap(both: Column) -> Column:
    """Shingles that two similar sets of ``both`` shingles together have in common, at least."""
    return F.ceil(F.lit(PERCENT) * both / (100 + PERCENT))


def meets_larger(counted: bool = False) -> Column:
    """Whether an entry is early enough to meet sets that are not smaller; pairs of shingles always are.

    With ``counted``, whether it may count for a pair whose larger set is at most 100 / ``PERCENT`` times the smaller one.
    """
    more = F.floor(F.col("n") * MARGIN / PERCENT) if counted else F.lit(0)
    return (F.col("join_key").bitwiseAND(1) == 0) | (F.col("at") <= F.col("n") - overlap(2 * F.col("n")) + more)


def several_classes(entries: DataFrame) -> DataFrame:
    """``(join_key, least_n)``: lists of more than one class where a set of ``least_n`` shingles or more may meet another.

    Of two similar sets the one that is not larger has all shingles that count early enough; lists without such an entry,
    and entries of sets that are smaller than all of these, can be left out. Combined in the map tasks.
    """
    least = F.min(F.when(meets_larger(counted=True), F.col("n"))).alias("least_n")
    lists = entries.groupBy("join_key").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), least)
    return lists.where("low <> high AND least_n IS NOT NULL").select("join_key", "least_n")


def in_lists_of(entries: DataFrame, lists: DataFrame) -> DataFrame:
    """The entries that may meet another one in the given lists."""
    return entries.join(lists, "join_key").where("n >= least_n").drop("least_n")


def list_leaders(met: DataFrame, number: int) -> DataFrame:
    """``(a, b)``: each set outside the largest class of its lists with the leaders it meets in most of them.

    A list's leader is one set of the class that has most entries there, drawn anew for every eighth of the lists and
    every round. Linking to leaders merges a large group of near copies with few pairs, before pairs are enumerated.
    Leaders met in few lists, for the size of the smaller set, are left to that enumeration: similar sets of n shingles
    share about a fifth of n list keys, an eighth of which is one draw's.
    """
    draw = F.xxhash64("key", F.pmod(F.xxhash64("join_key"), F.lit(8)), F.lit(number))
    sizes = met.groupBy("join_key", "cls").agg(F.count("*").alias("c"), F.min(F.struct(draw, "key", "n")).alias("leader"))
    best = sizes.groupBy("join_key").agg(F.max_by(F.struct("cls", "leader"), F.struct("c", "cls")).alias("best"))
    led = best.select("join_key", F.col("best.cls").alias("led"), F.col("best.leader.key").alias("a"), F.col("best.leader.n").alias("m"))
    meets = met.join(led, "join_key").where((F.col("cls") != F.col("led")) & (100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")))
    counted = meets.groupBy("key", "a").agg(F.count("*").alias("agree"), F.least(F.first("n"), F.first("m")).alias("least_n"))
    counted = counted.where(F.col("agree") * AGREEING >= F.col("least_n"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("agree"), "a"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= LEADERS).select("a", F.col("key").alias("b"))


def reclassed(met: DataFrame, links: DataFrame) -> DataFrame:
    """Entries with the classes that links make, of lists that still have several."""
    classes = components(links).select(F.col("node").alias("_k"), "component")
    named = met.join(classes, F.col("key") == F.col("_k"), "left").withColumn("cls", F.coalesce("component", "cls")).drop("_k", "component")
    return in_lists_of(named, several_classes(named))


def candidate_pairs(met: DataFrame) -> DataFrame:
    """``(a, b)``: pairs of sets of different classes that could be similar, from entries of lists with several classes.

    Two sets of sizes n and m that overlap in c = t / (1 + t) (n + m) shingles share one of their first n - c + 1 and
    m - c + 1. That is shorter than the prefix which a set needs for partners of any size, so only matches inside it count.
    The smaller set of a pair has the shorter one: it meets larger sets with no more than its first entries, so a frequent
    shingle, which is late in the order of most sets that have it, brings few of them together.

    Before whole sets are compared, pairs have to share l of their first n - c + l and m - c + l, too, with l as large as
    ``MARGIN`` and the listed prefixes allow; a document's listed keys are counted against another's.
    """
    other = met.select("join_key", *[F.col(c).alias(f"{c}_2") for c in ("cls", "key", "n", "at")])
    of_list = F.col("join_key").bitwiseAND(1) == 1
    common = overlap(F.col("n") + F.col("n_2"))
    inside = (F.col("at") <= F.col("n") - common) & (F.col("at_2") <= F.col("n_2") - common)
    in_turn = (F.col("n") < F.col("n_2")) | ((F.col("n") == F.col("n_2")) & (F.col("key") < F.col("key_2")))
    fits = in_turn & (F.col("cls") != F.col("cls_2")) & (100 * F.col("n") >= PERCENT * F.col("n_2")) & (~of_list | inside)
    meeting = met.where(meets_larger()).join(other, "join_key").where(fits)
    pairs = materialise(meeting.groupBy("key", "key_2", "n", "n_2").agg(F.max(~of_list).alias("sure")), "meeting-pairs")

    listed = met.where(of_list).groupBy("key").agg(F.collect_list(F.struct("at", "join_key")).alias("listed"))
    listed = materialise(listed, "listed-keys")
    first, second = (listed.select(F.col("key").alias(k), F.col("listed").alias(f"{k}_listed")) for k in ("key", "key_2"))
    share = F.least(1 + F.floor(F.col("n_2") * MARGIN / 100), common - F.ceil(F.col("n_2") * PERCENT / 100) + 1)

    def leading(column: str, n: str) -> Column:
        return F.transform(F.filter(column, lambda x: x["at"] < F.col(n) - common + share), lambda x: x["join_key"])

    agree = F.size(F.array_intersect(leading("key_listed", "n"), leading("key_2_listed", "n_2")))
    both = pairs.join(first, "key", "left").join(second, "key_2", "left")
    kept = both.where(F.col("sure") | (agree >= share)).select(F.col("key").alias("a"), F.col("key_2").alias("b"))
    found = materialise(kept, "candidate-pairs")
    discard(pairs, listed)
    return found


def leader_pairs(sets: DataFrame) -> DataFrame:
    """``(a, b)``: for each set the leader it shares most of its minimum hashes with; at most one pair per set.

    A leader is the smallest id under a minimum hash. Only pairs that share three of them, or all, are worth verifying.
    """
    hashes = materialise(sets.select("key", "n", F.size("least").alias("hashes"), F.explode("least").alias("h")), "min-hashes")
    leaders = hashes.groupBy("h").agg(F.min(F.struct("key", "n")).alias("leader"), F.count("*").alias("c")).where("c > 1").select("h", "leader.*")
    leaders = materialise(leaders.withColumnsRenamed({"key": "a", "n": "m"}), "leaders")
    met = hashes.join(leaders, "h").where((F.col("key") != F.col("a")) & (100 * F.least("n", "m") >= PERCENT * F.greatest("n", "m")))
    agreed = met.groupBy("key", "a").agg(F.count("*").alias("agree"), F.first("hashes").alias("hashes")).where((F.col("agree") >= 3) | (F.col("agree") == F.col("hashes")))
    best = agreed.groupBy("key").agg(F.min(F.struct((-F.col("agree")).alias("o"), "a")).alias("best"))
    pairs = materialise(best.select("best.a", F.col("key").alias("b")), "leader-pairs")
    discard(hashes, leaders)
    return pairs


def join_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id that links lead to, the row's own included. Texts without words, null ones too,
    have no shingles and are linked with nothing. Rows with equal sets are linked; rows that share an id count as one
    document. A null id is no name: each such row is a document of its own that links like any other; a class without any
    id is null. Ids must be whole numbers; other columns are not read; no rows give no rows.

    Four scans of the texts make shingles; what is shuffled are summaries of documents, list keys (combined in the map
    tasks), and the sets of documents in candidate pairs.
    """
    texts, last_id = _numbered(docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")))
    summary = materialise(texts.mapInArrow(_summarise, SUMMARY), "shingle-summaries")
    rows = summary.where("n IS NOT NULL").select("key", "n", "print", "least")
    firsts = rows.where("n > 0 AND key IS NOT NULL").groupBy("print").agg(F.min(F.struct("key", "n", "least")).alias("s"))
    firsts = materialise(firsts.select("print", "s.*"), "distinct-sets")

    pairs = leader_pairs(firsts)
    links = verified(texts, pairs)
    discard(pairs)
    # Documents whose class is not simply themselves, and copies, which stay out of the join.
    copies = rows.where("n > 0 AND key IS NOT NULL").join(firsts.select(F.col("print").alias("_p"), F.col("key").alias("first")), F.col("print") == F.col("_p")).where("key <> first")
    classes = components(links).select(F.col("node").alias("key"), F.col("component").alias("cls"), F.lit(True).alias("stays"))
    unnamed = copies.select("key", F.col("first").alias("cls"), F.lit(False).alias("stays")).dropDuplicates(["key"]).join(firsts.select("key"), "key", "left_anti")
    classes = materialise(classes.union(unnamed), "first-classes")

    often = summary.where("known IS NOT NULL").select(F.explode(F.arrays_zip("known", "times")).alias("k")).groupBy("k.known").agg(F.sum("k.times").alias("times"))
    top = often.orderBy(F.desc("times"), "known").limit(KNOWN).toArrow()
    order = Order(top.column("known").to_numpy().view(np.uint64), top.column("times").to_numpy())
    small = firsts.where(F.col("n") <= 2 * LARGEST_LIGHT).groupBy("n").count().collect()
    larger = firsts.where(F.col("n") > 2 * LARGEST_LIGHT).agg(F.sum(F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)).first()[0] or 0
    light = boundary({r["n"]: r["count"] for r in small}, larger)

    named = texts.where("key IS NOT NULL")
    shared = materialise(several_classes(_entries(named, classes, order, light)), "shared-keys")
    words = key_filter(shared, shared.count())
    met = materialise(in_lists_of(_entries(named, classes, order, light, words), shared), "list-entries")
    discard(shared)
    for number in range(ROUNDS):
        leaders = materialise(list_leaders(met, number), "list-leaders")
        found = verified(texts, leaders)
        discard(leaders)
        if not found.limit(1).count():
            break
        both, old = materialise(links.union(found), "links"), (met, links, found)
        links, met = both, materialise(reclassed(met, both), "list-entries")
        discard(*old)
    candidates = candidate_pairs(met)
    discard(met)
    more = verified(texts, candidates)
    discard(candidates)

    # An id with several sets is one document: it unites their classes.
    several = rows.where("n > 0 AND key IS NOT NULL").groupBy("key").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low <> high")
    shared_ids = copies.join(several.select("key"), "key", "left_semi").select(F.col("first").alias("a"), F.col("key").alias("b"))
    linked = components(links.union(more).union(shared_ids)).withColumnRenamed("node", "key")
    named = materialise(firsts.join(linked, "key", "left").select("print", F.coalesce("component", "key").alias("component")), "set-classes")
    joined = rows.select("key", "n", "print").join(named.withColumnRenamed("print", "_p"), F.col("print") == F.col("_p"), "left")
    named = [F.when(c <= last_id, c) for c in (F.col("key"), F.coalesce("component", "key"))]
    return joined.select(named[0].alias(key), F.col("n").alias("n_shingles"), named[1].alias("component_id"))


def _numbered(texts: DataFrame) -> tuple[DataFrame, int]:
    """Texts whose null ids are numbers above all ids, and the largest id. Rows without id are written to keep theirs."""
    top, nulls = texts.agg(F.coalesce(F.max("key"), F.lit(0)), F.count_if(F.col("key").isNull())).first()
    if not nulls:
        return texts, top
    numbers = (F.lit(top + 1) + F.monotonically_increasing_id()).alias("key")
    unnamed = materialise(texts.where("key IS NULL").select(numbers, "text"), "unnamed-texts")
    return texts.where("key IS NOT NULL").union(unnamed), top


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their class, all columns as they are.

    Rows without shingles and rows with a null id stay. Where rows of one id have different texts, each text is classed
    by itself, so that no text goes for another one's copy; rows of a class that share its smallest id all stay.
    """
    mark = F.xxhash64(F.col(text).cast("string"))
    k, m, number, going_name = (free_name(docs, c) for c in ("_k", "_m", "_number", "_going"))
    named = docs.where(F.col(key).isNotNull()).select(F.col(key).alias(k), mark.alias(m))
    several = named.groupBy(k).agg(F.min(m).alias("low"), F.max(m).alias("high")).where("low <> high")
    if not several.limit(1).count():
        classes = join_classes(docs, key, text)
        going = materialise(classes.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(k)).distinct(), "copies")
        return _without(docs, going, k, key)
    # Numbers in the order of the ids, one for each text of an id; written, so that they stay what they are.
    numbers = materialise(named.distinct().orderBy(k, m).withColumn(number, F.monotonically_increasing_id()), "text-numbers")
    numbered = docs.join(numbers, (F.col(key) == F.col(k)) & mark.eqNullSafe(F.col(m)), "left").drop(k, m)
    numbered = materialise(numbered, "numbered-documents")
    classes = join_classes(numbered, number, text).select(F.col(number).alias("number"), "component_id").where("number <> component_id").distinct()
    ids = numbers.select(F.col(number).alias("number"), F.col(k).alias("id"))
    kept_ids = ids.select(F.col("number").alias("component_id"), F.col("id").alias("kept"))
    going = classes.join(ids, "number").join(kept_ids, "component_id").where("id <> kept")
    going = materialise(going.select(F.col("number").alias(going_name)), "copies")
    return _without(numbered, going, going_name, number).select(*[F.col(f"`{c}`") for c in docs.columns])


def _without(docs: DataFrame, going: DataFrame, name: str, key: str) -> DataFrame:
    going = F.broadcast(going) if going.count() <= BROADCAST_IDS else going
    return docs.join(going, F.col(key) == F.col(name), "left_anti")
