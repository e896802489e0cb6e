"""Conversation structure repair: the cheapest edits that make roles alternate, found by an auction on node prices.

A node is (rows passed, state of ``(s?(ua)+)?``); edits are arcs with integer costs. A path grows along the arc that its
last node bids for, or shrinks by raising that node's price. Where all prices have converged, the arcs of every cheapest
repair and no others are tight, so walking tight arcs by their smallest initial gives the first of all cheapest audits.

Long conversations are cut into segments. A segment's auctions say what each way through it, from state to state, costs
and does; only these sums meet per conversation, so no task holds a conversation.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sward.session import materialise

#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role's initial leads from each state.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LETTERS = "sua"
ROLES = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Faults in a row's code: none, to be deleted, cut short.
SOUND, DOOMED, SHORT = range(3)
#: What ends a conversation in each state: inserted turns and their cost.
CLOSE = ("", "II", "I", "")
CLOSING = tuple(INSERT * len(c) for c in CLOSE)
#: Rows of a segment, and rows whose prices one auction settles.
SEGMENT = 4096
BLOCK = 4
FAR = 1 << 60


def _arcs(code: int) -> list[list[tuple[str, int, int]]]:
    """``(initial, cost, step)`` of each state's arcs at a row, by initial; a step counts nodes, four to a row."""
    letter, fault = (LETTERS + "?")[code // 3], code % 3
    late = TRUNCATED if fault == SHORT else 0
    found = []
    for state in range(4):
        arcs = [("D", DELETE, 4)]
        for role, to in (("u", USER), ("a", ASSISTANT)):
            if AFTER[role].get(state) == to:
                arcs.append(("I", INSERT, to - state))
                if fault != DOOMED:
                    arcs.append(("R", REROLE + late, 4 + to - state))
        to = AFTER.get(letter, {}).get(state)
        if fault != DOOMED and to is not None:
            arcs.append(("K", KEEP + late, 4 + to - state))
        found.append(sorted(arcs))
    return found


ARCS = [_arcs(code) for code in range(12)]


def _settle(prices: list[int], codes: bytes, low: int, high: int) -> None:
    """Exact prices for the four nodes before row ``low``, given those before row ``high``; lower bounds in between.

    Every node starts at the least exact price, which no arc undercuts as costs aren't negative. Nodes with no way out
    stay at ``FAR`` and take no part. Prices are integers that only rise, so the auction ends.
    """
    ends = [n for n in range(4 * high, 4 * high + 4) if prices[n] < FAR]
    floor = min(prices[n] for n in ends)
    for row in range(high - 1, low - 1, -1):
        for state in (USER, ASSISTANT, USER, START, SYSTEM):
            node = 4 * row + state
            if any(prices[node + step] < FAR for _, _, step in ARCS[codes[row]][state]):
                prices[node] = floor
    exact = set(ends)
    for origin in range(4 * low, 4 * low + 4):
        if prices[origin] == FAR:
            continue
        path = [origin]
        while path[-1] not in exact:
            node = path[-1]
            bid, to = min([(cost + prices[node + step], node + step) for _, cost, step in ARCS[codes[node >> 2]][node & 3]])
            if prices[node] < bid:
                prices[node] = bid
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        exact.update(path)


def auction(codes: bytes, exits: tuple[int, ...]) -> list[int]:
    """Node prices of a segment whose four last nodes cost ``exits``: exact before its first row, else never too high."""
    prices = [FAR] * (4 * len(codes)) + list(exits)
    for high in range(len(codes), 0, -BLOCK):
        _settle(prices, codes, max(0, high - BLOCK), high)
    return prices


def trace(codes: bytes, prices: list[int], entries: tuple[int, ...]) -> dict[int, tuple[str, int]]:
    """``entry: (initials, exit)``: the tight way with the smallest initials from each entry that has one."""
    end = 4 * len(codes)
    open_nodes = bytearray(end) + bytearray(p < FAR for p in prices[end:])

    def tight(node: int):
        price = prices[node]
        return [a for a in ARCS[codes[node >> 2]][node & 3] if open_nodes[node + a[2]] and price < FAR and price == a[1] + prices[node + a[2]]]

    for row in range(len(codes) - 1, -1, -1):
        for state in (USER, ASSISTANT, USER, START, SYSTEM):
            node = 4 * row + state
            if tight(node):
                open_nodes[node] = 1
    ways = {}
    for entry in entries:
        if open_nodes[entry]:
            node, initials = entry, []
            while node < end:
                initial, _, step = tight(node)[0]
                initials.append(initial)
                node += step
            ways[entry] = "".join(initials), node & 3
    return ways


@functools.lru_cache(maxsize=1 << 14)
def segment_ways(codes: bytes, first: bool, last: bool) -> tuple[tuple[str, int, int, int], ...]:
    """``(initials, entry, exit, cost)`` of the best way between every two states, by initials.

    A conversation begins in one state, and its last segment's ways include the closing cost.
    """
    entries = (START,) if first else (START, SYSTEM, USER, ASSISTANT)
    targets = [CLOSING] if last else [tuple(0 if q == to else FAR for q in range(4)) for to in range(4)]
    ways = []
    for exits in targets:
        prices = auction(codes, exits)
        ways += [(initials, entry, to, prices[entry]) for entry, (initials, to) in trace(codes, prices, entries).items()]
    return tuple(sorted(ways))


WAYS = "conv_id {id}, segment long, last boolean, ways array<struct<initials string, entry int, exit int, cost long>>"


def _find_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("initials", pa.string()), ("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64())]))
    for batch in batches:
        found = []
        for codes, segment, last in zip(*[batch.column(c).to_pylist() for c in ("codes", "segment", "last")]):
            ways = segment_ways(bytes(codes), segment == 0, last)
            found.append([{"initials": i, "entry": e, "exit": x, "cost": c} for i, e, x, c in ways])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("segment"), batch.column("last"), pa.array(found, kind)], names=["conv_id", "segment", "last", "ways"]
        )


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which way each segment takes: prices pass back over the segments, then the first tight way forward is taken."""
    for batch in batches:
        chosen = []
        for segments in batch.column("segments").to_pylist():
            prices = [(0, 0, 0, 0)]
            for one in reversed(segments):
                prices.append(tuple(min([w["cost"] + prices[-1][w["exit"]] for w in one["ways"] if w["entry"] == q], default=FAR) for q in range(4)))
            state, at = START, []
            for k, one in enumerate(segments):
                here, then = prices[len(segments) - k], prices[len(segments) - k - 1]
                i, way = next((i, w) for i, w in enumerate(one["ways"]) if w["entry"] == state and w["cost"] + then[w["exit"]] == here[state])
                at.append({"segment": one["segment"], "at": i})
                state = way["exit"]
            chosen.append(at)
        kind = pa.list_(pa.struct([("segment", pa.int64()), ("at", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(chosen, kind)], names=["conv_id", "chosen"])


def in_order(conversations: DataFrame) -> DataFrame:
    """``(conv_id, segment, position, last, turn, role, text, fault, code)``: rows in order with their first fault.

    Sorting and numbering run over one conversation at a time and spill; nothing but the rows' own columns is carried.
    """
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    by_turn = F.col("turn").asc_nulls_first()
    same = Window.partitionBy("conv_id", "role", "text").orderBy(by_turn)
    order = Window.partitionBy("conv_id").orderBy(by_turn, "role", "text", "_copy")
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    short = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, "blank").when(F.col("_copy") > 1, "duplicate").when(short, "truncated")
    letter = F.lit(len(LETTERS))
    for i, c in enumerate(LETTERS):
        letter = F.when(F.col("role").startswith(c), i).otherwise(letter)
    number = F.when(F.col("fault") == "truncated", SHORT).when(F.col("fault").isNotNull(), DOOMED).otherwise(SOUND)
    return (
        rows.repartition("conv_id")
        .withColumn("_copy", F.row_number().over(same))
        .withColumn("fault", fault)
        .withColumn("position", F.row_number().over(order).cast("long"))
        .withColumn("last", F.lead(F.lit(True)).over(order).isNull())
        .withColumn("segment", F.floor((F.col("position") - 1) / SEGMENT))
        .select("conv_id", "segment", "position", "last", "turn", "role", "text", "fault", (3 * letter + number).cast("int").alias("code"))
    )


def cheapest_ways(rows: DataFrame) -> DataFrame:
    """``(conv_id, segment, entry, initials)``: what the cheapest repair does in each segment of ``in_order``'s rows."""
    id_type = rows.schema["conv_id"].dataType.simpleString()
    codes = F.transform(F.sort_array(F.collect_list(F.struct("position", "code"))), lambda x: x["code"])
    groups = rows.groupBy("conv_id", "segment").agg(codes.alias("codes"), F.max("last").alias("last"))
    ways = materialise(groups.mapInArrow(_find_ways, WAYS.format(id=id_type)), "segment-ways")
    costs = F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"), w["cost"].alias("cost")))
    summed = ways.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", costs.alias("ways")))).alias("segments"))
    chosen = summed.mapInArrow(_choose, f"conv_id {id_type}, chosen array<struct<segment long, at int>>")
    picks = chosen.select(F.col("conv_id").alias("_conv"), F.inline("chosen").alias("_segment", "_at"))
    way = F.get("ways", F.col("_at"))
    close = F.when(F.col("last"), F.get(F.array(*map(F.lit, CLOSE)), way["exit"])).otherwise("")
    return ways.join(picks, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment"))).select(
        "conv_id", "segment", way["entry"].alias("entry"), F.concat(way["initials"], close).alias("initials")
    )


STEPS = "conv_id {id}, segment long, step int, edit string, turn long, role string, text string, was string, fault string"


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's head row brings its initials; every later row of it takes the next ones."""
    initials, state, step = "", START, 0
    names = [c.split()[0] for c in STEPS.format(id="x").split(", ")]
    for batch in batches:
        out: list[list] = [[] for _ in names]

        def emit(conv, segment, edit, turn, role, text, was, fault):
            for column, value in zip(out, (conv, segment, step, edit, turn, role, text, was, fault)):
                column.append(value)

        def insert(conv, segment):
            nonlocal state, step
            while step < len(initials) and initials[step] == "I":
                state = ASSISTANT if state == USER else USER
                emit(conv, segment, "I", None, ROLES[state], "", None, None)
                step += 1

        wanted = ("conv_id", "segment", "position", "last", "turn", "role", "text", "fault", "entry", "initials")
        for conv, segment, position, last, turn, role, text, fault, entry, head in zip(*[batch.column(c).to_pylist() for c in wanted]):
            if position is None:
                initials, state, step = head, entry, 0
                continue
            insert(conv, segment)
            edit, was = initials[step], role
            if edit == "R":
                state = ASSISTANT if state == USER else USER
                role = ROLES[state]
            elif edit == "K":
                state = AFTER[role[0]][state]
            emit(conv, segment, edit, turn, role, text, was, fault)
            step += 1
            if last:
                insert(conv, segment)
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.int32(), pa.string(), pa.int64(), *[pa.string()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def _repaired(conversations: DataFrame, by: list[str]) -> DataFrame:
    rows = materialise(in_order(conversations), "ordered-turns")
    id_type = rows.schema["conv_id"].dataType.simpleString()
    heads = cheapest_ways(rows)
    both = rows.drop("code").unionByName(heads, allowMissingColumns=True)
    sorted_rows = both.repartition(*by).sortWithinPartitions("conv_id", "segment", F.col("position").asc_nulls_first())
    return sorted_rows.mapInArrow(_edit, STEPS.format(id=id_type))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """``(conv_id, segment, step, edit, turn, role, text, was, fault)``: every row and every inserted turn with its edit.

    The edits are the cheapest that leave role initials ``(s?(ua)+)?``, of equal ones those whose initials come first in
    ASCII: K keeps a row, R gives it the role user or assistant (``was`` is its own), D deletes it, I inserts an empty
    turn. ``segment`` and ``step`` order them; without the D rows they are the repaired conversation. ``fault`` is blank
    (no character but ASCII white space), duplicate (role and text of an earlier row) or truncated (the last character
    is none of ``.!?``), whichever comes first; blank rows and duplicates must go.

    Rows are ordered by ``turn`` (nulls first), then role and text. A null role or text is one space, so such a row is
    blank or takes another role. Rows with a null ``conv_id`` are a conversation of their own. Repeated rows are
    duplicates. Other columns are not read; no rows give no rows.

    Auctions and edits run by segment, however long a conversation is; only the sort that numbers its rows is one task's.
    """
    return _repaired(conversations, ["conv_id", "segment"])


AUDIT = (
    "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
LEGAL = ("su", "ua", "au")


class _Audit:
    """Running figures of one conversation."""

    def __init__(self, conv):
        self.conv, self.low, self.high, self.turns = conv, None, None, 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = 0
        self.initials: list[str] = []
        self.before: str | None = None
        self.digest, self.any = hashlib.sha256(), False

    def add(self, edit, turn, role, text, was, fault) -> None:
        self.initials.append(edit)
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            if self.before is not None and self.before + was[:1] not in LEGAL:
                self.illegal += 1
            self.before = was[:1]
            if turn is not None and turn != self.high:
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            if fault is not None:
                self.faults[fault] += 1
            if fault == "truncated" and edit != "D":
                self.cost += TRUNCATED
        if edit != "D":
            self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def row(self) -> list:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.initials), self.digest.hexdigest()]


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in AUDIT.format(id="x").split(", ")]
    one, kind = None, None

    def pack(done):
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    for batch in batches:
        done, kind = [], batch.schema.field("conv_id").type
        for conv, *row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "edit", "turn", "role", "text", "was", "fault")]):
            if one is None or conv != one.conv:
                if one is not None:
                    done.append(one.row())
                one = _Audit(conv)
            one.add(*row)
        if done:
            yield pack(done)
    if one is not None:
        yield pack([one.row()])


def audit_conversations(conversations: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` for every conversation.

    ``originals`` names the conversations to report; those without rows have zeros, an empty audit and the digest of
    nothing. Rows are read as ``repair_conversations`` says. A running digest needs a conversation's rows in one task,
    through which they pass as a sorted stream that may spill; its audit holds one character per row.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    audits = _repaired(conversations, ["conv_id"]).mapInArrow(_audits, AUDIT.format(id=kind))
    if originals is None:
        return audits
    wanted = originals.select(F.col("conv_id").alias("_conv")).distinct()
    filled: list[Column] = [F.col("_conv").alias("conv_id")]
    filled += [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    filled += [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return wanted.join(audits, F.col("_conv").eqNullSafe(F.col("conv_id")), "left").select(*filled)


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with planted faults by the CRC of ``conv_id:turn``, one row in four.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 removes its stops, 3 repeats it, 4 makes it a user's.
    Nulls in names, roles and texts are one space.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    drawn = rows.withColumn("_d", F.crc32(name.cast("binary")) % 20).where("_d <> 0")
    return drawn.select(
        "conv_id",
        "turn",
        F.when(F.col("_d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_d") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")
