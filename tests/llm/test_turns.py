"""Operator 11 against an exhaustive search, and its block path against its plain path."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fieldwise.llm import turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(roles, faults):
    """(cost, edits) of the least of all edit strings, by cost, then as text: all of them, cheapest first."""
    n, heap, best = len(roles), [(0, "", 0, "")], None
    while heap and (best is None or heap[0][0] <= best[0]):
        cost, edits, i, initials = heapq.heappop(heap)
        if i == n and re.fullmatch(r"(s?(ua)+)?", initials):
            best = min(best or (cost, edits), (cost, edits))
        if not any(re.fullmatch(p, initials) for p in (r"s?(ua)*u?", "")) or len(edits) > 2 * n + 4:
            continue  # no continuation is sound
        if i < n:
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, initials))
            if faults[i] not in ("blank", "duplicate"):
                more = cost + (faults[i] == "truncated")
                heapq.heappush(heap, (more, edits + "K", i + 1, initials + roles[i][:1]))
                for to in "ua":
                    heapq.heappush(heap, (more + 2, edits + "R", i + 1, initials + to))
        for to in "ua":
            heapq.heappush(heap, (cost + 2, edits + "I", i, initials + to))
    return best


def plain(rows, damage):
    """The contract, row by row, for (conv_id, turn, role, text)."""
    after = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        held = after.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, held in after.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in held:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [t for t, _, _ in held if t is not None]
        cost, audit = brute([r for _, r, _ in held], faults)
        fixed, last, i = [], "", 0
        for e in audit:
            due = "assistant" if last == "u" else "user"
            if e in "IR":
                fixed.append((due, "" if e == "I" else held[i][2]))
            elif e == "K":
                fixed.append(held[i][1:])
            i += e != "I"
            last = next((r[:1] for r, _ in reversed(fixed) if r), "")
        whole = "\n".join(f"{r}:{t}" for r, t in fixed)
        initials = [r[:1] for _, r, _ in held]
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256(whole.encode()).hexdigest(),
        )
    return out


def made(seed, n):
    r = random.Random(seed)
    words = ["Yes.", "No", "", " \t", "Why?", "Go on!", "a\nb. ", None]
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, 6)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, None]), role, r.choice(words) if r.random() < 0.4 else f"text {turn % 3}."))
    return rows + rows[:3] + [(None, None, "user", "Hi."), (None, 3, "assistant", "Ho.")]


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("damage", [True, False])
def test_reports_are_those_of_an_exhaustive_search(spark, damage):
    rows = made(5, 120)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(turns.report(turns.damaged(df) if damage else df)) == plain(rows, damage)


@pytest.mark.parametrize("long_rows, block_rows", [(1, 1), (2, 2), (3, 4)])
def test_blocks_give_what_whole_conversations_give(spark, long_rows, block_rows):
    rows = turns.damaged(spark.createDataFrame(made(6, 100), SCHEMA))
    assert got(turns.report(rows, long_rows, block_rows)) == got(turns.report(rows))
    order = ("conv_id", "step")
    assert turns.edits(rows, long_rows, block_rows).orderBy(*order).collect() == turns.edits(rows).orderBy(*order).collect()


def test_a_long_conversation_and_equal_rows(spark):
    r = random.Random(3)
    rows = [(1, i, "user" if i % 2 == 0 or r.random() < 0.1 else "assistant", f"t {i % 900}" + r.choice(["", ".", "."])) for i in range(5_000)]
    rows += [(1, 7_000, "user", "again and again.")] * 600
    df = spark.createDataFrame(rows, SCHEMA)
    whole = got(turns.report(df, 1_000_000))
    assert got(turns.report(df)) == whole and whole[1][0] == 2_000 and whole[1][2] >= 599


def test_edits_spell_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "system", "x."), (2, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("step", F.lit(1)).withColumn("edit", F.lit("x")).withColumn("_long", F.lit(0))
    fixed = [tuple(r) for r in turns.edits(df).orderBy("conv_id", "step").collect()]
    assert fixed == [
        (1, 0, "K", 0, "user", "Hi."), (1, 1, "I", None, "assistant", ""), (1, 2, "K", 1, "user", "There."), (1, 3, "R", 2, "assistant", "x."),
        (2, 0, "D", None, None, None),
    ]


def test_nothing_and_dropped_conversations(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi.", True)], SCHEMA + ", dropped boolean")
    assert got(turns.report(df)) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert turns.edits(df).count() == 0 and turns.report(df.limit(0)).count() == 0
