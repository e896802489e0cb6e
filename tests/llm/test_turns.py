"""Conversation repair against a search over all edits, on random codes and on small tables with every odd case."""

import hashlib
import heapq
import random
import re

from pyspark.sql import functions as F

from sward.llm import turns

NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """``(cost, audit, repaired)`` of ``(role, text, fault)`` rows: the first complete repair of a search by (cost, audit)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, at, state, done = heapq.heappop(heap)
        if at == len(rows) and state in (0, 3):
            return cost, audit, "\n".join(done)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        for c, name in NAMES.items():
            if state in NEXT[c]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, NEXT[c][state], (*done, f"{name}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, done))
            if fault not in ("blank", "duplicate"):
                late = 5 if fault == "truncated" else 0
                for c, name in NAMES.items():
                    if state in NEXT[c]:
                        heapq.heappush(heap, (cost + 1 + late, audit + "R", at + 1, NEXT[c][state], (*done, f"{name}:{text}")))
                if state in NEXT.get(role[:1], {}):
                    heapq.heappush(heap, (cost + late, audit + "K", at + 1, NEXT[role[0]][state], (*done, f"{role}:{text}")))


def plain_audit(rows):
    """What the query says of one conversation's ``(turn, role, text)`` rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    seen, marked = set(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None
        seen.add((role, text))
        marked.append((role, text, fault))
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, repaired = cheapest(marked)
    faults = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
    return gaps, *faults, illegal, cost, audit, hashlib.sha256(repaired.encode()).hexdigest()


def conversation(rng, size):
    roles = ["user", "assistant", "system", "tool", "", None, "u", "assistant"]
    texts = ["One.", "Two!", "Three?", "cut", "cut, é", "", " \t\n", None, "Four. ", "x" * 3000 + "."]
    return [(rng.choice([None, *range(size + 2)]), rng.choice(roles), rng.choice(texts)) for _ in range(size)]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], "conv_id long, turn long, role string, text string, code int, fault string")


def test_auction_finds_the_first_of_the_cheapest_audits():
    rng = random.Random(3)
    for round_ in range(400):
        codes = bytes(rng.choice([0, 3, 6, 9, 5, 8] if round_ % 2 else range(12)) for _ in range(rng.randrange(1, 25)))
        rows = [(("system", "user", "assistant", "tool")[c // 3], "", (None, "blank", "truncated")[c % 3]) for c in codes]
        cost, audit, _ = cheapest(rows)
        [(initials, _, end, found)] = turns.segment_ways(codes, True, True)
        assert (initials + turns.CLOSE[end], found) == (audit, cost)


def test_converged_prices_never_undercut_an_arc():
    rng = random.Random(4)
    codes = bytes(rng.choice(range(12)) for _ in range(200))
    prices = turns.auction(codes, turns.CLOSING)
    for node in range(4 * len(codes)):
        if prices[node] < turns.FAR:
            assert prices[node] <= min(cost + prices[node + step] for _, cost, step in turns.ARCS[codes[node // 4]][node % 4])


def test_audits_equal_plain_python(spark):
    rng = random.Random(5)
    rows = [(conv, *r) for conv in [None, *range(60)] for r in conversation(rng, rng.randrange(1, 12))]
    rows += rows[:20]
    got = {r["conv_id"]: tuple(r)[1:] for r in turns.audit_conversations(table(spark, rows).repartition(7)).collect()}
    for conv in [None, *range(60)]:
        assert got[conv] == plain_audit([r[1:] for r in rows if r[0] == conv]), conv
    assert len(got) == 61


def test_long_conversations_are_repaired_in_segments(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{i}!", f"{i}"])) for i in range(700)]
    want = plain_audit([r[1:] for r in rows])
    monkeypatch.setattr(turns, "SEGMENT", 64)
    assert tuple(turns.audit_conversations(table(spark, rows)).first())[1:] == want
    steps = turns.repair_conversations(table(spark, rows))
    in_order = [r for r in steps.orderBy("segment", "step").collect()]
    assert "".join(r["edit"] for r in in_order) == want[-2]
    kept = "\n".join(f"{r['role']}:{r['text']}" for r in in_order if r["edit"] != "D")
    assert hashlib.sha256(kept.encode()).hexdigest() == want[-1]
    assert in_order[-1]["segment"] == 10


def test_conversations_that_lose_all_rows_are_reported(spark):
    lost = next(c for c in range(1000) if spark.range(1).select(F.crc32(F.lit(f"{c}:0").cast("binary")) % 20).first()[0] == 0)
    rows = [(lost, 0, "user", "x")]
    damaged = turns.damage(table(spark, rows))
    assert damaged.count() == 0
    [row] = turns.audit_conversations(damaged, table(spark, rows)).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    none = table(spark, rows).limit(0)
    assert turns.audit_conversations(turns.damage(none), none).count() == 0
    assert turns.repair_conversations(none).count() == 0


def test_damage_follows_the_remainder(spark):
    rows = [(c, t, r, x) for c in [None, *range(40)] for t, r, x in ((0, "system", "A. b! c?"), (None, None, None), (2, "assistant", "z."))]
    got = sorted(map(str, turns.damage(table(spark, rows)).collect()))
    want = []
    import zlib

    for conv, turn, role, text in rows:
        role, text = role or " ", " " if text is None else text
        drawn = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if drawn == 1:
            text = ""
        if drawn == 2:
            text = re.sub("[.!?]", "", text)
        if drawn == 4:
            role = "user"
        want += [{"conv_id": conv, "turn": turn, "role": role, "text": text}] * {0: 0, 3: 2}.get(drawn, 1)
    assert got == sorted(f"Row(conv_id={w['conv_id']}, turn={w['turn']}, role={w['role']!r}, text={w['text']!r})" for w in want)
