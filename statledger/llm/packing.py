"""Hierarchical multi-length packing of token ids.

Documents are cut at the longest window; what is left of each is routed to the tier of the smallest window that holds
it. Tiers are packed from the longest window down: a piece opens a window, the gap is filled with the longest pieces
of shorter tiers that fit, and the last gap with the beginning of a piece that is cut. So every window is full. What is
left over of one batch joins the next, and at the end of a partition becomes sequences of powers of two. Sequences are
then dealt to step groups of about equal work.

A partition of the input is packed by itself: no rows move, and a task holds the token ids of one batch of texts, which
are tokenised and given out in smaller slices.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.textarrays import slices
from statledger.llm.vocabularies import Vocabulary, vocabulary

TIERS = (4096, 2048, 1024, 512)
STEP_TOKENS = 16 * 4096
BATCH_BYTES = 16 << 20
#: Text tokenised at once, and ids given out at once. They bound a task's memory and do not change what is packed.
SLICE_BYTES = 1 << 20

# (length, document number, start in the document); lengths come first, so that a sorted list is sorted by length.
Piece = tuple[int, int, int]


class Packer:
    """Packs pieces into full windows of the tiers' lengths; powers of two, longest first."""

    def __init__(self, tiers: Sequence[int] = TIERS):
        self.tiers = sorted(tiers, reverse=True)
        self.waiting: dict[int, list[Piece]] = {t: [] for t in self.tiers}
        self.full: list[list[Piece]] = []

    def tier_of(self, length: int) -> int:
        return min(t for t in self.tiers if t >= length)

    def add(self, document: int, start: int, length: int) -> None:
        """Whole longest windows at once; the rest waits in its tier."""
        longest = self.tiers[0]
        for at in range(start, start + length - longest + 1, longest):
            self.full.append([(longest, document, at)])
        if rest := length % longest:
            insort(self.waiting[self.tier_of(rest)], (rest, document, start + length - rest))

    def _longest_within(self, gap: int) -> Piece | None:
        for tier in self.tiers:
            pieces = self.waiting[tier]
            if pieces and (i := bisect_right(pieces, (gap + 1,))):
                return pieces.pop(i - 1)
        return None

    def _begin_of_a_piece(self, gap: int) -> Piece | None:
        """The first ``gap`` tokens of a piece of the shortest tier that has one; its rest waits again."""
        for tier in reversed(self.tiers):
            if self.waiting[tier]:
                length, document, start = self.waiting[tier].pop()
                rest = length - gap
                insort(self.waiting[self.tier_of(rest)], (rest, document, start + gap))
                return gap, document, start
        return None

    def pack(self) -> list[Piece]:
        """Fill windows from the longest tier down; returns the pieces of the last window, which nothing could fill."""
        for tier in self.tiers:
            while self.waiting[tier]:
                window = [self.waiting[tier].pop()]
                gap = tier - window[0][0]
                while gap:
                    piece = self._longest_within(gap) or self._begin_of_a_piece(gap)
                    if piece is None:
                        return window
                    window.append(piece)
                    gap -= piece[0]
                self.full.append(window)
        return []

    def finish(self, pieces: list[Piece]) -> None:
        """Cut a last window into sequences of powers of two."""
        left = sum(p[0] for p in pieces)
        pieces = pieces[::-1]
        while left:
            gap = 1 << (left.bit_length() - 1)
            left -= gap
            window = []
            while gap:
                length, document, start = pieces.pop()
                took = min(gap, length)
                window.append((took, document, start))
                if took < length:
                    pieces.append((length - took, document, start + took))
                gap -= took
            self.full.append(window)


def step_groups(lengths: Sequence[int], step_tokens: int) -> list[int]:
    """Deal sequences to groups: each goes to the group with the least work so far (its tokens), longest first."""
    groups = max(1, -(-sum(lengths) // step_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        work, group = heapq.heappop(heap)
        out[i] = group
        heapq.heappush(heap, (work + lengths[i], group))
    return out


def _encoded(encoder: Vocabulary, texts: pa.RecordBatch, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each with its end id, and the offset at which each text's begin (and the last's end)."""
    parts, begins = [], [np.zeros(1, np.int64)]
    for part in slices([texts], max_bytes=SLICE_BYTES):
        ids, offsets = encoder.encode(part.column("text"))
        count = part.num_rows
        ended = np.full(len(ids) + count, end_id, dtype=np.uint32)
        ended[np.arange(len(ids)) + np.repeat(np.arange(count), np.diff(offsets))] = ids
        parts.append(ended)
        begins.append(begins[-1][-1] + offsets[1:] + np.arange(1, count + 1))
    return np.concatenate(parts), np.concatenate(begins)


def _packed(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, tiers: Sequence[int], step_tokens: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    encoder = vocabulary(path)
    first_id = TaskContext.get().partitionId() << 32
    sequences = steps = 0
    carried: list[tuple[Piece, object, int, np.ndarray]] = []  # piece, document id, its tokens, ids from start

    def emit(full, names, totals, ids_of):
        nonlocal sequences, steps
        lengths = [sum(p[0] for p in window) for window in full]
        groups = step_groups(lengths, step_tokens)
        rows, held = [], 0

        def given() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for n, window in enumerate(full):
            offset = 0
            for length, document, start in window:
                rows.append(
                    (names[document], start, length, ids_of(document, start, length), totals[document])
                    + (first_id + sequences + n, offset, lengths[n], first_id + steps + groups[n])
                )
                offset += length
            held += 4 * offset
            if held >= SLICE_BYTES:
                yield given()
                rows, held = [], 0
        yield given()
        sequences += len(full)
        steps += max(groups, default=-1) + 1

    for batch in slices(batches, max_bytes=BATCH_BYTES):
        count = batch.num_rows
        ended, begins = _encoded(encoder, batch, end_id)
        names = batch.column("doc_id").to_pylist() + [c[1] for c in carried]
        totals = np.diff(begins).tolist() + [c[2] for c in carried]
        begin = begins.tolist()
        packer = Packer(tiers)
        held = {}
        for n, (piece, _, _, own) in enumerate(carried, start=count):
            held[n] = (piece[2], own)
            packer.add(n, piece[2], piece[0])
        for n in range(count):
            packer.add(n, 0, totals[n])

        def ids_of(document, start, length):
            if document in held:
                base, own = held[document]
                return own[start - base : start - base + length].tobytes()
            return ended[begin[document] + start : begin[document] + start + length].tobytes()

        left = packer.pack()
        carried = [
            (piece, names[piece[1]], totals[piece[1]], np.frombuffer(ids_of(piece[1], piece[2], piece[0]), np.uint32))
            for piece in left
        ]
        yield from emit(packer.full, names, totals, ids_of)
    packer = Packer(tiers)
    packer.finish([(c[0][0], n, c[0][2]) for n, c in enumerate(carried)])
    yield from emit(
        packer.full,
        [c[1] for c in carried],
        [c[2] for c in carried],
        lambda n, start, length: carried[n][3][start - carried[n][0][2] :][:length].tobytes(),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    tiers: Sequence[int] = TIERS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``max(tiers)`` tokens, each of a power of two in length.

    ``docs`` has doc_id and text; other columns are ignored. Returns per piece: doc_id, start and length in the
    document's tokens, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset in the sequence,
    sequence_tokens, step_group. Null and empty texts are documents of the end id alone; rows that repeat are packed
    as often as they occur; rows of an id that differ are documents of their own; a null doc_id stays null. An empty
    table gives no rows. A document may be of any length; it must fit the memory of a task.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    source = docs.select("doc_id", "text")
    long = T.LongType()
    fields = [("start", long), ("length", long), ("ids", T.BinaryType()), ("doc_tokens", long), ("sequence_id", long)]
    fields += [("offset", long), ("sequence_tokens", long), ("step_group", long)]
    schema = T.StructType([source.schema["doc_id"]] + [T.StructField(n, t) for n, t in fields])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        return _packed(batches, tokenizer_path, end_id, tiers, step_tokens, to_arrow_schema(schema))

    return source.mapInArrow(run, schema)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The packed pieces with the checksum of their ids in place of the ids."""
    names = ["doc_id", "start", "length"]
    rest = ["doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group"]
    return pieces.select(*names, F.crc32("ids").alias("ids_crc32"), *rest)
