"""Operator 11: conversation structure repair by iterative-deepening A*.

A conversation is sound if the initials of its roles, in order, spell
``(s?(ua)+)?``. The cheapest edits that make it so are searched for: keep a row
(K, 0), delete it (D, 3; the only edit of a blank or repeated row), give it the
role that is due (R, 2), insert an empty row of the role that is due (I, 2); a
truncated row that is not deleted adds 1. Which role is due follows from what
stands before, so a string of edits determines the repaired conversation.

The search goes depth first, edits in ASCII order, and gives up a branch whose
cost and least remaining cost exceed a bound; the bound grows by one until a
branch accepts. The first that does is cheapest, and ASCII-least among the
cheapest. (Row, last role) with a budget that failed is kept in a table; what
failed with it fails with less, under any bound.

The least remaining cost counts what each remaining row costs whatever happens,
and one for each neighbouring pair that is not sound: an edit costs two or more
and mends two pairs at most.

A conversation's rows meet in one task, sorted by turn. Conversations of more
than ``LONG_ROWS`` rows are cut into blocks of ``BLOCK_ROWS``: each block is
searched for every role it may begin after and end in, and the blocks' cheapest
edits are chained (see ``_chained``). No two edit strings of a block that begin
and end alike are a prefix of each other, so least parts make the least whole.

Defined results: null roles and texts count as one space. Rows are taken by turn
(null first), then role, then text; equal rows stay neighbours. An empty role has
no initial: it is illegal beside any other, and kept it spells nothing. A conversation without
rows, or whose rows are all marked ``dropped``, has zeros and an empty audit. Null
ids are one conversation. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, S, U, A, OTHER, NONE = range(6)
CODES = {"s": S, "u": U, "a": A}
#: The role that an inserted or re-roled row takes after each last role.
DUE = (U, U, A, U)
NAMES = {U: "user", A: "assistant"}
#: (last role, next role) that are sound neighbours within a conversation.
SOUND = frozenset({(START, S), (START, U), (S, U), (U, A), (A, U)})
#: Last roles that a sound conversation may end in.
ENDS = (START, A)
BLANKS = " \t\n\x0b\x0c\r"
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with the contract's damage, by crc32(``conv_id:turn``) % 20: 0 marks the row as
    dropped, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it the user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(fate == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text")).alias("text"),
        (fate == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def code_of(role: str) -> int:
    return CODES.get(role[:1], OTHER) if role else NONE


def fault_of(text: str) -> int:
    """Blank, truncated or none; repeats are known by what was seen earlier."""
    bare = text.rstrip(BLANKS)
    return BLANK if not bare else NO_FAULT if bare[-1] in ".!?" else TRUNCATED


def cheapest_edits(codes: Sequence[int], faults: Sequence[int], start: int = START, ends: Sequence[int] = ENDS, trailing: bool = True) -> tuple[int, str]:
    """(cost, edits) of the ASCII-least of the cheapest edit strings that lead from the last role
    ``start`` over all rows to one of ``ends``; one must exist. Without ``trailing`` nothing is
    inserted behind the last row."""
    n = len(codes)
    must = [f in (BLANK, DUPLICATE) for f in faults]
    extra = [int(f == TRUNCATED) for f in faults]
    # least[i][last]: what the rows from i on cost at least after that last role
    least: list[tuple[int, ...]] = [()] * (n + 1)
    least[n] = tuple(int(last not in ends) for last in range(4))
    following, base = None, 0
    for i in range(n - 1, -1, -1):
        if must[i]:
            base += 3
        else:
            base += extra[i]
            if codes[i] != NONE:
                base += (codes[i], following) not in SOUND if following is not None else codes[i] not in ends
                following = codes[i]
        least[i] = tuple(base + (((last, following) not in SOUND) if following is not None else last not in ends) for last in range(4))
    failed: dict[int, int] = {}
    bound = least[0][start]
    while True:
        # one frame a step: row, last role, budget left, next edit to try
        frames, edits = [[0, start, bound, 0]], []
        while frames:
            frame = frames[-1]
            i, last, left, turn = frame
            if turn == 0 and i == n and last in ends:
                return bound - left, "".join(edits)
            step = None
            while step is None and turn < 4:
                if turn == 0:  # D
                    if i < n:
                        step = (i + 1, last, 3, "D")
                elif turn == 1:  # I
                    if i < n or trailing:
                        step = (i, DUE[last], 2, "I")
                elif i < n and not must[i]:
                    if turn == 2:  # K
                        if codes[i] == NONE:
                            step = (i + 1, last, extra[i], "K")
                        elif (last, codes[i]) in SOUND:
                            step = (i + 1, codes[i], extra[i], "K")
                    else:  # R
                        step = (i + 1, DUE[last], 2 + extra[i], "R")
                turn += 1
                if step is not None:
                    budget = left - step[2]
                    if budget < least[step[0]][step[1]] or failed.get(step[0] * 4 + step[1], -1) >= budget:
                        step = None
            frame[3] = turn
            if step is None:
                key = i * 4 + last
                failed[key] = max(failed.get(key, -1), left)
                frames.pop()
                if edits:
                    edits.pop()
            else:
                frames.append([step[0], step[1], left - step[2], 0])
                edits.append(step[3])
        bound += 1


def repaired(roles: Sequence[str], texts: Sequence[str], edits: str, last: int = START) -> Iterator[tuple[str, int | None, str | None, str | None]]:
    """(edit, row, role, text) of each edit; deleted rows have neither role nor text, inserted ones no row."""
    i = 0
    for e in edits:
        if e == "I":
            last = DUE[last]
            yield e, None, NAMES[last], ""
            continue
        if e == "D":
            yield e, i, None, None
        elif e == "R":
            last = DUE[last]
            yield e, i, NAMES[last], texts[i]
        else:
            last = code_of(roles[i]) if roles[i] else last
            yield e, i, roles[i], texts[i]
        i += 1


def judged(turns: Sequence[int | None], roles: Sequence[str], texts: Sequence[str]) -> tuple[dict[str, int], list[int], list[int]]:
    """A conversation's counts, and the role code and first fault of each of its rows."""
    seen: set[tuple[str, str]] = set()
    codes, faults = [], []
    for role, text in zip(roles, texts, strict=True):
        fault = fault_of(text)
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        codes.append(code_of(role))
        faults.append(fault)
    known = [t for t in turns if t is not None]
    counts = {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum((a, b) not in SOUND for a, b in zip(codes, codes[1:], strict=False)),
    }
    return counts, codes, faults


#: Conversations of more rows than this are searched in blocks, in several tasks.
LONG_ROWS = 2048
BLOCK_ROWS = 256


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key values, rows as tuples) of rows that arrive grouped by their first ``keys`` columns."""
    at: tuple | None = None
    rows: list[tuple] = []
    for b in batches:
        for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)], strict=True):
            if row[:keys] != at:
                if at is not None:
                    yield at, rows
                at, rows = row[:keys], []
            rows.append(row[keys:])
    if at is not None:
        yield at, rows


def _mapped(df: DataFrame, fn, schema: T.StructType, size: int = 2_000) -> DataFrame:
    """``mapInArrow`` of ``fn(batches)``, which yields tuples of the schema's columns."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in fn(batches):
            held.append(row)
            if len(held) == size:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def _bare(rows: DataFrame) -> DataFrame:
    """Id and row columns alone, nulls of role and text as one space, ids in the form they came."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    gone = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text("role"), text("text"), gone.alias("dropped"))


def _order(*more: str) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), *[F.col(c) for c in ("role", "text", *more)]]


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, counts, edits, repaired rows) of each conversation."""
    for (conv,), all_rows in _grouped(batches, 1):
        rows = [r for r in all_rows if not r[3]]
        turns, roles, texts = ([r[k] for r in rows] for k in range(3))
        counts, codes, faults = judged(turns, roles, texts)
        cost, edits = cheapest_edits(codes, faults)
        fixed = [(e, None if i is None else turns[i], role, text) for e, i, role, text in repaired(roles, texts, edits)]
        yield conv, [*counts.values(), cost], edits, fixed


def lines(fixed: Iterator[tuple]) -> str:
    """The repaired conversation, one ``role:text`` a line."""
    return "\n".join(f"{role}:{text}" for _, _, role, text in fixed if role is not None)


def report(rows: DataFrame, long_rows: int = LONG_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every id."""
    schema = _report_schema(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, counts, edits, fixed in _solved(batches):
            yield conv, *counts, edits, hashlib.sha256(lines(fixed).encode()).hexdigest()

    short, long = _by_length(_bare(rows), long_rows)
    out = _mapped(_arranged(short), run, schema)
    return out if long is None else out.unionByName(_long_report(Blocks(long, block_rows), schema))


def edits(rows: DataFrame, long_rows: int = LONG_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The repaired conversations: (conv_id, step, edit, turn, role, text), a row an edit, steps from 0;
    deleted rows have neither role nor text, inserted rows no turn."""
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL("step bigint, edit string, turn bigint, role string, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, _, _, fixed in _solved(batches):
            yield from ((conv, i, *step) for i, step in enumerate(fixed))

    short, long = _by_length(_bare(rows), long_rows)
    out = _mapped(_arranged(short), run, schema)
    return out if long is None else out.unionByName(_long_edits(Blocks(long, block_rows), schema))


def _report_schema(rows: DataFrame) -> T.StructType:
    counts = [T.StructField(c, T.LongType()) for c in REPORT]
    return T.StructType([rows.schema["conv_id"], *counts, *[T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")]])


def _arranged(rows: DataFrame) -> DataFrame:
    """Each conversation's rows in one task, in order."""
    return rows.repartition("conv_id").sortWithinPartitions(*_order())


def _by_length(rows: DataFrame, long_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations up to ``long_rows`` rows, and those of longer ones (None, if there are none)."""
    long = written(rows.filter(~F.col("dropped")).groupBy("conv_id").count().filter(F.col("count") > long_rows).select(F.col("conv_id").alias("_long")), "long")
    if long.isEmpty():
        return rows, None
    is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
    return rows.join(long, is_long, "left_anti"), rows.filter(~F.col("dropped")).drop("dropped").join(long, is_long, "left_semi")


class Blocks:
    """Long conversations: their rows by (conv_id, block), and each block's cheapest edits."""

    def __init__(self, rows: DataFrame, block_rows: int) -> None:
        conv = rows.schema["conv_id"]
        # equal rows may be very many: the partition they came from spreads them
        ordered = rows.withColumn("_from", F.spark_partition_id()).repartitionByRange(*_order("_from")).sortWithinPartitions(*_order("_from")).drop("_from")
        numbered = written(_mapped(ordered, _numbered, T.StructType([conv, *T.StructType.fromDDL("turn bigint, role string, text string, part int, nth bigint, code int, fault int, same binary").fields])), "turns")
        held = numbered.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        parts = held.select(F.col("conv_id").alias("_c"), F.col("part").alias("_p"), before.alias("_before"))
        placed = numbered.join(parts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))).withColumn("pos", F.col("_before") + F.col("nth")).drop("_c", "_p", "_before", "part", "nth")
        first = placed.groupBy(F.col("conv_id").alias("_c"), F.col("same").alias("_same")).agg(F.min("pos").alias("_first"))
        again = (F.col("fault") != BLANK) & (F.col("pos") > F.col("_first"))
        placed = placed.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("same") == F.col("_same")))
        self.rows = written(
            placed.select("conv_id", F.expr(f"pos div {block_rows}").alias("block"), "pos", "turn", "role", "text", "code", F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault")),
            "turns",
        )
        part = T.StructType([conv, *T.StructType.fromDDL("block bigint, costs array<bigint>, audits array<string>, counts array<bigint>, turns array<bigint>, codes array<int>").fields])
        bare = self.rows.select("conv_id", "block", "pos", "turn", "code", "fault")
        tables = _mapped(bare.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos"), _block_tables, part, 64)
        chain = T.StructType([conv, *T.StructType.fromDDL("block bigint, start int, edits string, step bigint, counts array<bigint>").fields])
        self.chained = written(_mapped(tables.repartition("conv_id").sortWithinPartitions("conv_id", "block"), _chained, chain, 64), "chained")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows with their place among those of their conversation in this partition."""
    part, at, nth, first = TaskContext.get().partitionId(), None, 0, True
    for b in batches:
        for conv, turn, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if first or conv != at:
                at, nth, first = conv, 0, False
            same = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            yield conv, turn, role, text, part, nth, code_of(role), fault_of(text), same
            nth += 1


def _block_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of each block, by (role before it, its last role): the cost and edits of its cheapest repair."""
    for (conv, block), rows in _grouped(batches, 2):
        codes, faults = [r[2] for r in rows], [r[3] for r in rows]
        found = [through(codes, faults, start, end) for start in range(4) for end in range(4)]
        known = [r[1] for r in rows if r[1] is not None]
        counts = [faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), sum((a, b) not in SOUND for a, b in zip(codes, codes[1:], strict=False))]
        spans = [known[0], known[-1], len(set(known))] if known else []
        yield conv, block, [c for c, _ in found], [e for _, e in found], counts, spans, [codes[0], codes[-1]]


def through(codes: Sequence[int], faults: Sequence[int], start: int, end: int) -> tuple[int | None, str | None]:
    """The cheapest edits of a block that lead from one last role to another without an insertion behind
    its last row (that belongs to the next block); (None, None) if none do."""
    n = len(codes)
    if end in (U, A):
        return cheapest_edits(codes, faults, start, (end,), trailing=False)
    # whatever is kept or inserted is a user's or assistant's, and no way leads back: all rows go,
    # but for those whose role spells nothing and, from the start to S, one system row
    extra = [int(f == TRUNCATED) for f in faults]
    stays = [f in (NO_FAULT, TRUNCATED) for f in faults]
    cost = [extra[i] if codes[i] == NONE and stays[i] else 3 for i in range(n)]
    edits = ["K" if codes[i] == NONE and stays[i] else "D" for i in range(n)]
    if (start, end) == (START, S):
        # of the cheapest system rows the last, as D comes before K
        kept = [(extra[i], -i) for i in range(n) if codes[i] == S and stays[i]]
        if not kept:
            return None, None
        i = -min(kept)[1]
        cost[i], edits[i] = extra[i], "K"
    elif start != end:
        return None, None
    return sum(cost), "".join(edits)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each block's part of the conversation's cheapest edits, then a row of the conversation's counts.

    For each role that the blocks so far may end in, the cheapest edits are kept as a chain of parts.
    Equal costs are told apart by their place among the kept ones, which is that of the whole strings.
    """
    for (conv,), rows in _streamed(batches):
        # last role -> (cost, place, (chain before, block, start, edits))
        alive: dict[int, tuple[int, int, tuple | None]] = {START: (0, 0, None)}
        sums, low, high, distinct, last_code, seen_turn = [0] * 4, None, None, 0, None, None
        for block, costs, audits, counts, turns, codes in rows:
            nxt: dict[int, tuple[int, int, str, tuple]] = {}
            for start, (cost, place, chain) in alive.items():
                for end in range(4):
                    c, part = costs[4 * start + end], audits[4 * start + end]
                    if c is not None and (end not in nxt or (cost + c, place) < nxt[end][:2]):
                        nxt[end] = (cost + c, place, part, (chain, block, start, part))
            by_string = sorted(nxt, key=lambda e: (nxt[e][1], nxt[e][2]))
            alive = {e: (nxt[e][0], by_string.index(e), nxt[e][3]) for e in nxt}
            sums = [a + b for a, b in zip(sums, counts, strict=True)]
            sums[3] += last_code is not None and (last_code, codes[0]) not in SOUND
            last_code = codes[1]
            if turns:
                low = turns[0] if low is None else low
                high = turns[1]
                distinct += turns[2] - (seen_turn == turns[0])
                seen_turn = turns[1]
        # behind the last row the due roles may be inserted
        tail = {START: "", S: "II", U: "I", A: ""}
        ends = [(cost + 2 * len(tail[e]), place, e) for e, (cost, place, _) in alive.items()]
        cost = min(ends)[0]
        # as strings: a place decides, as no chain is another's prefix
        _, _, end = min((place, cost, e) for c, place, e in ends if c == cost)
        chain, parts = alive[end][2], []
        while chain is not None:
            parts.append(chain[1:])
            chain = chain[0]
        step = 0
        for k, (block, start, part) in enumerate(reversed(parts)):
            part += tail[end] if k == len(parts) - 1 else ""
            yield conv, block, start, part, step, None
            step += len(part)
        yield conv, None, None, "".join(p for *_, p in reversed(parts)) + tail[end], None, [0 if low is None else high - low + 1 - distinct, *sums, cost]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Like ``_grouped`` by the first column, but a group's rows come one by one."""
    rows = (row for b in batches for row in zip(*[b.column(i).to_pylist() for i in range(b.num_columns)], strict=True))
    for conv, group in itertools.groupby(rows, key=lambda r: r[:1]):
        yield conv, (r[1:] for r in group)


def _long_steps(blocks: Blocks) -> DataFrame:
    """The rows of long conversations, each with its block's edits."""
    parts = blocks.chained.filter("block is not null").select(F.col("conv_id").alias("_c"), F.col("block").alias("_b"), "start", "edits", "step")
    rows = blocks.rows.join(parts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b")))
    rows = rows.select("conv_id", "block", "pos", "turn", "role", "text", "start", "edits", "step")
    return rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")


def _mended(rows: list[tuple]) -> Iterator[tuple]:
    """(edit, turn, role, text) of a block's rows (pos, turn, role, text, start, edits, step)."""
    found = repaired([r[2] for r in rows], [r[3] for r in rows], rows[0][5], rows[0][4])
    return ((e, None if i is None else rows[i][1], role, text) for e, i, role, text in found)


def _long_edits(blocks: Blocks, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv, _), rows in _grouped(batches, 2):
            yield from ((conv, rows[0][6] + i, *step) for i, step in enumerate(_mended(rows)))

    return _mapped(_long_steps(blocks), run, schema)


def _long_report(blocks: Blocks, schema: T.StructType) -> DataFrame:
    """A hash takes its text in order, so one task streams a conversation's blocks through it."""
    conv = schema["conv_id"]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv_id, block), rows in _grouped(batches, 2):
            yield conv_id, block, lines(_mended(rows))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv_id,), rows in _streamed(batches):
            whole, some = hashlib.sha256(), False
            for _, text in rows:
                if text:
                    whole.update((("\n" if some else "") + text).encode())
                    some = True
            yield conv_id, whole.hexdigest()

    parts = _mapped(_long_steps(blocks), texts, T.StructType([conv, *T.StructType.fromDDL("block bigint, lines string").fields]), 16)
    hashed = _mapped(parts.repartition("conv_id").sortWithinPartitions("conv_id", "block"), hashes, T.StructType([conv, T.StructField("repaired_sha256", T.StringType())]))
    totals = blocks.chained.filter("block is null").select(F.col("conv_id").alias("_c"), "edits", "counts")
    rows = hashed.join(totals, F.col("conv_id").eqNullSafe(F.col("_c")))
    return rows.select("conv_id", *[F.col("counts")[i].alias(c) for i, c in enumerate(REPORT)], F.col("edits").alias("audit"), "repaired_sha256")
