"""Conversations put back into the order ``(system? (user assistant)+)?`` by the cheapest edits, found by halving.

A turn is kept (cost 0), given the other role (1) or deleted (2); empty turns are inserted (5 each). Blank turns and
repeats are always deleted, and a turn without an end costs 5 unless it is deleted. Of the cheapest edits those whose
letters (K, R, D, I) come first as text are taken.

Four states say what stands before a turn: nothing, the system's turn, a user's, or an assistant's. What a stretch of
turns does is a 4 by 4 table: the least cost from state to state, and how the edits to the states that can be reached
compare as text. (Both sides hold one letter other than I for every turn and end with one, so neither begins with the
other, and the order of two beginnings settles the order of the wholes.) Tables of neighbouring stretches combine. The
edits are found as Hirschberg does: costs forward to the middle and backward from the end meet there, the cheapest
crossing is taken, the first in order among equal ones, and both halves are solved by themselves, in linear space.

At scale, turns are range-partitioned by conversation and turn, so that a conversation of any length spreads over tasks.
A conversation that lies within one partition, and in one block of ``block_turns``, is solved there. Of the others each
block gives its table; the tables of a conversation (one row a block) give the states in which blocks meet, and blocks
are then solved by themselves. Only the final digest of a conversation is taken block after block, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from itertools import count, groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.cluster import written
from statledger.llm.textarrays import slices

BLOCK_TURNS, BLOCK_BYTES = 8192, 4 << 20
WHITE = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINE, CUT_OFF, DELETED = range(3)
FAR = 1 << 50

#: The state after an inserted turn or one with its role changed.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What is inserted at the end, by state.
CLOSING = ("", "II", "I", "")


@cache
def _edits(code: int) -> tuple[tuple[tuple[int, str], ...], ...]:
    """(cost, letters) of the best edits of one turn from state to state: insertions before it, and its own letter."""
    initial, fault = "sua?"[code // 3], code % 3
    best = [[(FAR, "")] * 4 for _ in range(4)]
    for before in range(4):
        state, inserted = before, 0
        while inserted < 3:
            ways = [(2, "D", state)]
            if fault != DELETED:
                if initial in {NOTHING: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}[state]:
                    ways.append((5 * fault, "K", "?sua".index(initial)))
                ways.append((1 + 5 * fault, "R", FOLLOWING[state]))
            for cost, letter, after in ways:
                best[before][after] = min(best[before][after], (cost + 5 * inserted, "I" * inserted + letter))
            state, inserted = FOLLOWING[state], inserted + 1
    return tuple(map(tuple, best))


Table = tuple[tuple[tuple[int, int], ...], ...]


@cache
def _table(code: int) -> Table:
    """(cost, rank) from state to state: ranks order the letters of one row."""
    out = []
    for row in _edits(code):
        order = sorted(range(4), key=lambda t: row[t][1])
        out.append(tuple((row[t][0], order.index(t)) for t in range(4)))
    return tuple(out)


def _forward(vector: Sequence[tuple[int, int]], table: Table) -> list[tuple[int, int]]:
    """(cost, rank) per state after a stretch, from those before it."""
    via = [min((vector[p][0] + table[p][t][0], vector[p][1], table[p][t][1]) for p in range(4)) for t in range(4)]
    order = sorted(range(4), key=lambda t: via[t][1:])
    return [(min(via[t][0], FAR), order.index(t)) for t in range(4)]


def _backward(table: Table, costs: Sequence[int]) -> list[int]:
    return [min(table[p][t][0] + costs[t] for t in range(4)) for p in range(4)]


def _from(state: int) -> list[tuple[int, int]]:
    return [(0 if s == state else FAR, s) for s in range(4)]


def crossings(tables: Sequence[Table], start: int, end: int) -> list[int]:
    """The state before each stretch, and after the last, on the cheapest way from ``start`` to ``end``."""
    if len(tables) == 1:
        return [start, end]
    middle = len(tables) // 2
    forward = _from(start)
    for table in tables[:middle]:
        forward = _forward(forward, table)
    backward = [FAR if s != end else 0 for s in range(4)]
    for table in reversed(tables[middle:]):
        backward = _backward(table, backward)
    crossing = min(range(4), key=lambda s: (forward[s][0] + backward[s], forward[s][1]))
    return crossings(tables[:middle], start, crossing) + crossings(tables[middle:], crossing, end)[1:]


def last_state(tables: Sequence[Table]) -> int:
    """The state after the last turn on the cheapest way to a whole conversation."""
    vector = _from(NOTHING)
    for table in tables:
        vector = _forward(vector, table)
    return min(range(4), key=lambda s: (vector[s][0] + 5 * len(CLOSING[s]), vector[s][1]))


def letters(codes: bytes, start: int, end: int) -> str:
    """Edits of a stretch of turns, from state to state."""
    if not codes:
        return ""
    states = crossings([_table(c) for c in codes], start, end)
    return "".join(_edits(c)[p][t][1] for c, p, t in zip(codes, states, states[1:]))


def edits(codes: bytes) -> str:
    """Edits of a whole conversation."""
    end = last_state([_table(c) for c in codes])
    return letters(codes, NOTHING, end) + CLOSING[end]


@lru_cache(1 << 16)
def _short_edits(codes: bytes) -> str:
    return edits(codes)


def cost_of(audit: str, codes: bytes) -> int:
    own = [x for x in audit if x != "I"]
    return 5 * (len(audit) - len(own)) + sum({"K": 0, "R": 1, "D": 2}[x] + (5 if x != "D" and c % 3 == CUT_OFF else 0) for x, c in zip(own, codes, strict=True))


def repaired(audit: str, rows: Sequence[tuple[str, str]], codes: bytes, start: int = NOTHING) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that stay; ``rows`` are those that need not be deleted."""
    state, own, k = start, iter(rows), 0
    for letter in audit:
        if letter == "I":
            state = FOLLOWING[state]
            yield letter, ROLES[state], ""
            continue
        row = next(own) if codes[k] % 3 != DELETED else None
        if letter == "K":
            state = "?sua".index("sua"[codes[k] // 3])
            yield letter, row[0], row[1]
        elif letter == "R":
            state = FOLLOWING[state]
            yield letter, ROLES[state], row[1]
        k += 1


def faults(turns: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text and ``copies`` (0: only there for its conversation), with what is wrong.

    Equal rows become one with the sum of their copies. blank; again: role and text occur at an earlier turn;
    truncated. Null roles and texts are one space.
    """
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    there = F.col("copies") > 0
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *[v.alias(c) for c, v in spaced.items()], "copies")
    rows = rows.withColumns({c: F.when(there, F.col(c)).otherwise("") for c in spaced})
    folded = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.md5("text"))
    key = ["role", "digest"]
    repeats = (
        folded.filter(there)
        .groupBy(F.col("conv_id").alias("__conv_id"), *[F.col(c).alias(f"__{c}") for c in key])
        .agg(F.min("turn").alias("__first"), F.max(F.col("turn").isNull()).alias("__open"), F.count("*").alias("__n"))
        .filter(F.col("__n") > 1)
    )
    same = F.col("conv_id").eqNullSafe(F.col("__conv_id")) & (F.col("role") == F.col("__role")) & (F.col("digest") == F.col("__digest"))
    later = F.when(F.col("__open"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("__first"))
    ended = F.rtrim("text", F.lit(WHITE))
    return folded.join(repeats, same, "left").select(
        "conv_id", "turn", "role", "digest", "text", "copies",
        (ended == "").alias("blank"),
        F.coalesce(later, F.lit(False)).alias("again"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


class _Block:
    """Consecutive turns of a conversation."""

    def __init__(self) -> None:
        self.codes, self.rows, self.bytes = bytearray(), [], 0
        self.counts = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.initials: list[str] = []
        self.turns: list[int | None] = [None, None, 0]  # first, last, distinct

    def add(self, turn: int | None, role: str, text: str, copies: int, blank: bool, again: bool, truncated: bool) -> None:
        initial = role[:1] or " "
        if not self.initials:
            self.initials = [initial, initial]
        elif self.initials[1] + initial not in ("su", "ua", "au"):
            self.counts[3] += 1
        self.counts[3] += copies - 1
        self.initials[1] = initial
        gone = blank or again
        self.counts[0] += copies * blank
        self.counts[1] += (copies - (not again)) * (not blank)
        self.counts[2] += truncated and not gone
        kind = 3 * ("sua".find(initial) % 4)
        self.codes.append(kind + (DELETED if gone else CUT_OFF if truncated else FINE))
        self.codes.extend(bytes([kind + DELETED]) * (copies - 1))
        if not gone:
            self.rows.append((role, text))
            self.bytes += len(text)
        if turn is not None:
            self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + (turn != self.turns[1])]


_TURN = T.StructType([T.StructField(n, T.StringType()) for n in ("edit", "role", "text")])
_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("role", "text")])


def _fields(key: T.DataType) -> list[T.StructField]:
    numbers = ["blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns", "cost"]
    return [
        T.StructField("conv_id", key),
        T.StructField("part", T.LongType()),
        T.StructField("block", T.LongType()),
        *[T.StructField(n, T.LongType()) for n in numbers],
        T.StructField("initials", T.StringType()),
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
        T.StructField("repaired", T.ArrayType(_TURN)),
    ]


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of tuples as Arrow batches; the last value of a row is how much it holds, and no column."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    held: list[tuple] = []
    total = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), arrow)], schema=arrow)

    for row in rows:
        held.append(row)
        total += row[-1]
        if len(held) >= size or total >= max_bytes:
            yield batch()
            held, total = [], 0
    if held:
        yield batch()


def _solved(block: _Block, audit: str, start: int, texts: bool, digest: bool) -> tuple:
    """(cost, initials, audit, digest, turns) of a block whose edits are known."""
    turns = list(repaired(audit, block.rows, bytes(block.codes), start))
    sha = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in turns).encode()).hexdigest() if digest else None
    return cost_of(audit, bytes(block.codes)), "".join(block.initials), audit, sha, [dict(zip(_TURN.names, t)) for t in turns] if texts else None


def _pieces(faulty: DataFrame, block_turns: int, texts: bool) -> DataFrame:
    """Blocks of conversations in order. A conversation that is one block away from a partition's ends is solved
    (``codes`` null); others have their codes, rows and table."""
    by = ["conv_id", "turn", "role", "digest"]
    ordered = faulty.repartitionByRange(*by).sortWithinPartitions(*by).drop("digest")
    extra = [
        T.StructField("codes", T.BinaryType()),
        T.StructField("rows", T.ArrayType(_ROW)),
        T.StructField("table", T.ArrayType(T.LongType())),
    ]
    schema = T.StructType([*_fields(faulty.schema["conv_id"].dataType), *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def turns() -> Iterator[tuple]:
            for batch in slices(batches):
                yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "blank", "again", "truncated")])

        def blocks(own: Iterator[tuple]) -> Iterator[_Block]:
            block = _Block()
            for _, turn, role, text, copies, blank, again, truncated in own:
                while copies:
                    if len(block.codes) >= block_turns or block.bytes >= BLOCK_BYTES:
                        yield block
                        block = _Block()
                    now = min(copies, max(block_turns - len(block.codes), 1))
                    block.add(turn, role, text, now, blank, again, truncated)
                    copies, again = copies - now, True
            yield block

        serial = count()

        def piece(conv, number: int, block: _Block, whole: bool) -> tuple:
            codes = bytes(block.codes)
            begin = (conv, part, next(serial), *block.counts, *block.turns)
            if whole:
                audit = _short_edits(codes) if len(codes) <= 64 else edits(codes)
                out = _solved(block, audit, NOTHING, texts, True)
                return (*begin, *out, None, None, None, len(audit) + (block.bytes if texts else 0))
            table = [_from(s) for s in range(4)]
            for code in codes:
                table = [_forward(vector, _table(code)) for vector in table]
            flat = [x for row in table for pair in row for x in pair]
            rows = [dict(zip(_ROW.names, r)) for r in block.rows]
            return (*begin, None, "".join(block.initials), None, None, None, codes, rows, flat, block.bytes + len(codes))

        def out() -> Iterator[tuple]:
            waiting, first = None, True  # the last conversation of a partition is known when it has ended
            for conv, own in groupby(turns(), key=lambda r: r[0]):
                if waiting:
                    yield piece(*waiting, whole=not first and not waiting[1])
                    first = False
                for number, block in enumerate(blocks(own)):
                    if number:
                        yield piece(*waiting, whole=False)
                    waiting = (conv, number, block)
            if waiting:
                yield piece(*waiting, whole=False)

        yield from _batches(out(), schema, 4096, 1 << 23)

    return ordered.mapInArrow(run, schema)


def _met(parts: DataFrame) -> DataFrame:
    """(part, block, start, end, closing): the states in which the blocks of every conversation meet. One small row a
    block; a conversation's rows meet in one task."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("part", "block", "start", "end")] + [T.StructField("closing", T.StringType())])
    ordered = parts.select("conv_id", "part", "block", "table").repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns])

        def out() -> Iterator[tuple]:
            for _, own in groupby(rows(), key=lambda r: r[0]):
                own = list(own)
                tables = [tuple(tuple(zip(flat[p * 8 : p * 8 + 8 : 2], flat[p * 8 + 1 : p * 8 + 8 : 2])) for p in range(4)) for *_, flat in own]
                end = last_state(tables)
                states = crossings(tables, NOTHING, end)
                for k, (_, part, block, _) in enumerate(own):
                    yield part, block, states[k], states[k + 1], CLOSING[end] if k + 1 == len(own) else "", 8

        yield from _batches(out(), schema, 4096, 1 << 20)

    return ordered.mapInArrow(run, schema)


def repair_blocks(turns: DataFrame, block_turns: int = BLOCK_TURNS, texts: bool = True) -> DataFrame:
    """One row per block of a conversation, in the order of (part, block): counts of faults, cost, audit, and the
    repaired turns (edit, role, text) of the block. See :func:`repair` for ``turns``; ``texts=False`` leaves the turns
    of conversations of one block out. Their digest is there; other blocks have none."""
    pieces = written(_pieces(faults(turns), block_turns, texts), "conversation-blocks")
    fields = _fields(pieces.schema["conv_id"].dataType)
    names = [f.name for f in fields]
    whole = pieces.filter(F.col("codes").isNull()).select(names)
    parts = pieces.filter(F.col("codes").isNotNull())
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            for batch in batches:
                for row in range(batch.num_rows):
                    r = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                    block = _Block()
                    block.codes, block.rows, block.initials = bytearray(r["codes"]), [tuple(x.values()) for x in r["rows"]], list(r["initials"])
                    audit = letters(r["codes"], r["start"], r["end"]) + r["closing"]
                    cost, _, audit, sha, kept = _solved(block, audit, r["start"], True, False)
                    r |= {"cost": cost, "audit": audit, "repaired_sha256": sha, "repaired": kept}
                    yield *[r[n] for n in names], len(r["codes"]) + sum(len(x["text"]) for x in r["rows"])

        yield from _batches(out(), schema, 512, 1 << 23)

    solved = parts.join(_met(parts), ["part", "block"]).select(*names, "codes", "rows", "start", "end", "closing").mapInArrow(run, schema)
    return whole.unionByName(solved)


def repair(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per conversation: conv_id, gaps (missing turn numbers), blank, duplicate, truncated, illegal (pairs of
    roles that may not follow each other), cost, audit (letters of the edits) and repaired_sha256 (of ``role:text`` of
    the repaired turns, one a line).

    ``turns``: conv_id, turn, role, text and copies (how often the row stands there; a row of 0 only says that its
    conversation exists). Turns are taken in order of turn, nulls first, rows of one turn by role and the MD5 of their
    text; equal rows are a turn and its repeats. Null roles and texts are one space; a null conv_id is one
    conversation. A conversation without turns has zeros, an empty audit and the digest of an empty text. An empty
    table gives an empty table. Other columns are ignored. Texts of any length are turns like others.
    """
    solved = repair_blocks(turns, block_turns, texts=False)
    key = solved.schema["conv_id"].dataType
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps")
    one = solved.filter(F.col("repaired_sha256").isNotNull()).select("conv_id", gaps, *counts, "audit", "repaired_sha256")
    schema = T.StructType(
        [
            T.StructField("conv_id", key),
            *[T.StructField(n, T.LongType()) for n in ("gaps", *counts)],
            *[T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")],
        ]
    )
    several = solved.filter(F.col("repaired_sha256").isNull()).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for row in range(batch.num_rows):
                    yield {c: batch.column(c)[row].as_py() for c in batch.schema.names}

        def out() -> Iterator[tuple]:
            for conv, own in groupby(rows(), key=lambda r: r["conv_id"]):
                total, audit, sha, begun = dict.fromkeys(counts, 0), [], hashlib.sha256(), False
                first, last, distinct, initial = None, None, 0, None
                for r in own:
                    for c in counts:
                        total[c] += r[c]
                    if r["initials"]:
                        total["illegal"] += initial is not None and initial + r["initials"][:1] not in ("su", "ua", "au")
                        initial = r["initials"][-1:]
                    if r["first_turn"] is not None:
                        first = r["first_turn"] if first is None else first
                        distinct += r["turns"] - (r["first_turn"] == last)
                        last = r["last_turn"]
                    audit.append(r["audit"])
                    for turn in r["repaired"]:
                        sha.update((("\n" if begun else "") + f"{turn['role']}:{turn['text']}").encode())
                        begun = True
                gap = last - first + 1 - distinct if first is not None else 0
                yield conv, gap, *total.values(), "".join(audit), sha.hexdigest(), sum(map(len, audit))

        yield from _batches(out(), schema, 4096, 1 << 23)

    return one.unionByName(several.mapInArrow(run, schema))
