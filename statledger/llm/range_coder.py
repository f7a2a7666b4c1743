"""Adaptive context-mixing range coder for token ids, over many blocks at a time.

A frame is up to ``FRAME_BLOCKS`` blocks of equal length. Each block has its own coder and its own checksum; predictions
and counts are the frame's, so that a frame is read as a whole. All blocks of a frame advance one id at a time together, so
that numpy works on one id of each: what a frame costs depends on the ids of a block as much as on those of all blocks.

Prediction. Order 2 (the last two ids) and order 1 (the last id) each predict the id that followed that context before,
with a confidence of 0 to 3. Order 0 keeps frequent ids in slots with counts. What is coded first is how the id is found:
as the order-2 prediction, the order-1 prediction, an id in a slot, or by its number of bits. The chances mix three
adaptive counts: one by the order-2 confidence, one by the order-1 confidence, one without context. Then follows the slot,
by its count, or the id's lower bits.

Counts take in what was coded at steps that depend on the number of ids alone. Between two such steps chances are shares
of a power of two, which are looked up: no block sums or divides counts of its own.

Coding. A carry-less range coder with a 64-bit low end, which puts out 32 bits at a time. An id takes at most 28 bits
between two looks at what may be put out, 31 if it is longer than 16 bits.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 512
FRAME_BLOCKS = 8192
MAGIC = b"CMR2"
# Magic, bits of the longest id, blocks, ids. Then, of each block, the crc32 of its ids (little-endian unsigned 32-bit)
# and the bytes that follow for it. Then the crc32 of all these.
HEADER = struct.Struct("<4sBII")
CHECKSUM = struct.Struct("<I")

_CONTEXTS = 1 << 17
_LEVELS = 4  # of confidence
_WAYS = 64  # room for three predictions and the numbers of bits from 0 to 32
_WAY_BITS = 12
_SLOT_BITS = 16
_STEP = 8
_MOST = 1 << 20
_INTERVAL = 1 << 17  # ids between two updates of counts, at most
_U = np.uint64
_ROOM = _U(1 << 32)
_LOW = _U((1 << 32) - 1)
_32 = _U(32)
_PAIRS = np.arange(_LEVELS * _LEVELS)


class CorruptBlock(ValueError):
    """A block whose header, length or checksum is wrong."""


class _Counts:
    """Counts of a frame, and the shares they give: ``way_*`` by both confidences and way, ``slot_*`` by slot."""

    def __init__(self, bits: int):
        self.ways = 3 + bits + 1  # three predictions, or a number of bits from 0
        self.by = [np.ones((n, self.ways), np.int64) for n in (_LEVELS, _LEVELS, 1)]
        self.plain = bits <= _SLOT_BITS
        self.slots = 1 << min(bits, _SLOT_BITS)
        self.slot_id = np.arange(self.slots, dtype=np.uint32)
        self.slot_count = np.zeros(self.slots, np.int64)
        self.slot_begin, self.slot_part = np.zeros(self.slots, _U), np.zeros(self.slots, _U)
        self.way_begin, self.way_part = (np.zeros((len(_PAIRS), _WAYS), _U) for _ in range(2))
        self._share_ways()

    def slot_of(self, ids: np.ndarray) -> np.ndarray:
        return ids if self.plain else (ids ^ (ids >> 16) * np.uint32(40503)) & np.uint32(self.slots - 1)

    def _share_ways(self) -> None:
        chances = self.by[0][_PAIRS // _LEVELS] + self.by[1][_PAIRS % _LEVELS] + self.by[2]
        upto = np.cumsum(chances, axis=1)
        # At least 1 each, so that all are possible.
        ends = upto * ((1 << _WAY_BITS) - self.ways) // upto[:, -1:] + np.arange(1, self.ways + 1)
        parts = np.diff(ends, axis=1, prepend=0)
        self.way_begin[:, : self.ways], self.way_part[:, : self.ways] = ends - parts, parts

    def update(self, cells: np.ndarray, ids: np.ndarray) -> None:
        """Count what was coded: places in ``way_begin`` and ids."""
        seen = np.bincount(cells.ravel(), minlength=len(_PAIRS) * _WAYS).reshape(_LEVELS, _LEVELS, _WAYS)[:, :, : self.ways]
        for counts, more in zip(self.by, (seen.sum(axis=1), seen.sum(axis=0), seen.sum(axis=(0, 1))[None]), strict=True):
            counts += more * _STEP
            full = counts.sum(axis=1) > _MOST
            counts[full] = (counts[full] >> 1) | 1
        self._share_ways()
        ids = ids.ravel()
        slot = self.slot_of(ids)
        if not self.plain:
            free = self.slot_count[slot] == 0
            self.slot_id[slot[free]] = ids[free]
            slot = slot[self.slot_id[slot] == ids]
        self.slot_count += np.bincount(slot, minlength=self.slots)
        upto = np.cumsum(self.slot_count)
        if upto[-1] > _MOST:
            self.slot_count >>= 1
            upto = np.cumsum(self.slot_count)
        ends = (upto << _SLOT_BITS) // max(int(upto[-1]), 1)
        self.slot_part[:] = np.diff(ends, prepend=0)
        self.slot_begin[:] = ends
        self.slot_begin -= self.slot_part

    def lookups(self) -> tuple[np.ndarray, np.ndarray]:
        """The way of each share by both confidences, and the slot of each share."""
        parts = self.way_part.astype(np.int64).ravel()
        ways = np.repeat(np.arange(len(parts), dtype=np.uint16), parts)
        used = np.flatnonzero(self.slot_part)
        slots = np.repeat(used.astype(np.uint16), self.slot_part[used].astype(np.int64))
        return ways, slots if len(slots) else np.zeros(1, np.uint16)


def _intervals(lanes: int, steps: int):
    """First and last step of each stretch between two updates."""
    begin = 0
    while begin < steps:
        end = min(steps, begin + max(1, min(begin // 4, _INTERVAL // lanes)))
        yield begin, end
        begin = end


class _Predictions:
    """What followed each context in a frame: an id, times 4, plus the confidence."""

    def __init__(self, lanes: int, bits: int):
        self.dtype = np.uint32 if bits <= 30 else np.uint64
        self.table = np.zeros(2 * _CONTEXTS, self.dtype)
        self.at = np.empty((2, lanes), np.int64)
        self.before, self.last = np.full(lanes, 7), np.zeros(lanes, np.int64)

    def look(self) -> np.ndarray:
        """Of each lane, the index of both confidences; ``found`` has both ids."""
        last, at = self.last, self.at
        np.multiply(last, 2654435761, out=at[0])
        at[0] += self.before
        at[0] >>= 12
        at[0] &= _CONTEXTS - 1
        np.bitwise_and(last, _CONTEXTS - 1, out=at[1])
        at[1] += _CONTEXTS
        self.entry = self.table.take(at)
        self.level = self.entry & self.dtype(3)
        self.found = self.entry >> self.dtype(2)
        return (self.level[0] << self.dtype(2) | self.level[1]).astype(np.int64)

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """Of lanes that share a context, the last one counts."""
        entry, one = self.entry, self.dtype(1)
        fresh = ids.astype(self.dtype, copy=False) << self.dtype(2)
        fresh |= one
        new = np.where(self.level > one, entry - one, fresh)
        np.copyto(new, np.minimum(entry + one, entry | self.dtype(3)), where=hit)
        self.table[self.at] = new
        self.before = self.last * 40503
        self.last = ids.astype(np.int64)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit length of each id."""
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


_BITS = _bits(np.arange(1 << 16))


class _Coder:
    """Low ends and widths of ``lanes`` intervals."""

    def __init__(self, lanes: int):
        self.low, self.width = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)

    def settle(self) -> None:
        """Put out, or take in, the highest 32 bits of lanes of less than that width; once is always enough."""
        if (lanes := (self.width < _ROOM).nonzero()[0]).size:
            low, width = self.low.take(lanes), self.width.take(lanes)
            # Where an interval holds a multiple of 2^32, it ends there.
            width = np.minimum(width - _U(1), ~low & _LOW)
            width += _U(1)
            self._moved(lanes, low)
            self.low[lanes], self.width[lanes] = low << _32, width << _32


class _Encoder(_Coder):
    """``lanes`` and ``words``: what was put out, in order."""

    def __init__(self, lanes: int):
        super().__init__(lanes)
        self.lanes, self.words = [], []

    def put(self, begin, part, bits) -> None:
        """Code the share ``begin`` to ``begin + part`` of 2 to the power of ``bits`` in all lanes."""
        self.width >>= bits
        self.low += begin * self.width
        self.width *= part

    def put_bits(self, lanes, value, bits) -> None:
        width = self.width.take(lanes) >> bits
        self.low[lanes] += value * width
        self.width[lanes] = width

    def _moved(self, lanes, low) -> None:
        self.lanes.append(lanes.astype(np.int32))
        self.words.append((low >> _32).astype("<u4"))

    def finish(self) -> list[bytes]:
        # Intervals are as wide as 2^32 or wider, so that one word, followed by zeros, lies in them.
        self._moved(np.arange(len(self.low)), self.low + _LOW)
        lanes = np.concatenate(self.lanes)
        words = np.concatenate(self.words)[np.argsort(lanes, kind="stable")]
        ends = np.cumsum(np.bincount(lanes))
        return [words[b:e].tobytes() for b, e in zip([0, *ends[:-1]], ends, strict=True)]


class _Decoder(_Coder):
    """``ahead``: how far the code is above the low end."""

    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads))
        # Whole words, and the zeros that follow the last one.
        padded = [p + b"\0" * (8 + -len(p) % 4) for p in payloads]
        self.data = np.frombuffer(b"".join(padded), dtype="<u4").astype(np.uint32, copy=False)
        sizes = np.array([len(p) // 4 for p in padded])
        self.at = np.cumsum(sizes) - sizes
        self.ahead = np.zeros(len(payloads), _U)
        for _ in range(2):
            self.ahead = (self.ahead << _32) | self.data[self.at]
            self.at += 1

    def share(self, bits) -> np.ndarray:
        """Where in 2 to the power of ``bits`` the next value of each lane lies; a damaged block's may be too high."""
        self.width >>= bits
        return (self.ahead // self.width).astype(np.int64)

    def take(self, begin, part) -> None:
        begin *= self.width
        self.low += begin
        self.ahead -= begin
        self.width *= part

    def slots(self, lanes, counts: _Counts, lookup: np.ndarray) -> np.ndarray:
        width = self.width.take(lanes)
        width >>= _U(_SLOT_BITS)
        ahead = self.ahead.take(lanes)
        slot = lookup.take((ahead // width).astype(np.int64), mode="clip").astype(np.int64)
        begin = counts.slot_begin.take(slot)
        begin *= width
        self.low[lanes] += begin
        ahead -= begin
        self.ahead[lanes] = ahead
        width *= counts.slot_part.take(slot)
        self.width[lanes] = width
        return slot

    def take_bits(self, lanes, bits) -> np.ndarray:
        width, ahead = self.width.take(lanes) >> bits, self.ahead.take(lanes)
        value = np.minimum(ahead // width, (_U(1) << bits) - _U(1))
        begin = value * width
        self.low[lanes] += begin
        self.ahead[lanes] = ahead - begin
        self.width[lanes] = width
        return value

    def _moved(self, lanes, low) -> None:
        at = self.at.take(lanes)
        self.ahead[lanes] = (self.ahead.take(lanes) << _32) | self.data.take(at, mode="clip")
        self.at[lanes] = at + 1


def encode(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """``ids`` (unsigned 32-bit) as frames one after another; no ids give no bytes."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    size = block_ids * FRAME_BLOCKS
    return b"".join(_encoded(ids[i : i + size], block_ids) for i in range(0, len(ids), size))


def _encoded(ids: np.ndarray, block_ids: int) -> bytes:
    lanes = -(-len(ids) // block_ids)
    steps = -(-len(ids) // lanes)
    square = np.zeros(lanes * steps, np.uint32)
    square[: len(ids)] = ids
    columns = np.ascontiguousarray(square.reshape(lanes, steps).T)
    most = int(ids.max()).bit_length()
    counts, past, coder = _Counts(most), _Predictions(lanes, most), _Encoder(lanes)
    one = _U(1)
    for first, last in _intervals(lanes, steps):
        some = columns[first:last]
        slot = counts.slot_of(some)
        parts = counts.slot_part.take(slot)
        begins = counts.slot_begin.take(slot)
        length = _BITS.take(some) if counts.plain else _bits(some)
        known = parts > 0
        if not counts.plain:
            known &= counts.slot_id[slot] == some
        otherwise = np.where(known, np.uint8(2), length + np.uint8(3))
        cells = np.empty(some.shape, np.int64)
        way_begin, way_part = counts.way_begin.ravel(), counts.way_part.ravel()
        for t in range(last - first):
            now, way = some[t], otherwise[t]
            cell = past.look()
            cell *= _WAYS
            hit = past.found == now
            right = hit & (past.level > 0)
            np.putmask(way, right[1], 1)
            np.putmask(way, right[0], 0)
            cell += way
            coder.put(way_begin.take(cell), way_part.take(cell), _U(_WAY_BITS))
            in_slot = way == 2
            coder.put(
                begins[t] * in_slot, np.where(in_slot, parts[t], one), in_slot.astype(_U) << _U(4)
            )
            if (rare := (way > 4).nonzero()[0]).size:  # an id of no or one bit is known by its length
                bits = way[rare].astype(_U) - _U(4)
                if not counts.plain:
                    coder.settle()
                coder.put_bits(rare, now[rare].astype(_U) - (one << bits), bits)
            coder.settle()
            past.learn(now, hit)
            cells[t] = cell
        counts.update(cells, some)
    payloads = coder.finish()
    head = np.empty((lanes, 2), "<u4")
    for i, payload in enumerate(payloads):
        head[i] = zlib.crc32(ids[i * steps : (i + 1) * steps].tobytes()), len(payload)
    head = HEADER.pack(MAGIC, most, lanes, len(ids)) + head.tobytes()
    return b"".join([head, CHECKSUM.pack(zlib.crc32(head)), *payloads])


def decode(data: bytes) -> np.ndarray:
    """The ids of frames written by :func:`encode`; raises CorruptBlock where one isn't as it was written."""
    out, at = [np.zeros(0, np.uint32)], 0
    while at < len(data):
        if at + HEADER.size > len(data):
            raise CorruptBlock("a header is cut off")
        magic, bits, lanes, size = HEADER.unpack_from(data, at)
        follows = at + HEADER.size + 8 * lanes
        if magic != MAGIC or follows + CHECKSUM.size > len(data):
            raise CorruptBlock(f"no frame begins at byte {at}")
        if CHECKSUM.unpack_from(data, follows)[0] != zlib.crc32(data[at:follows]):
            raise CorruptBlock(f"the header at byte {at} has another checksum")
        head = np.frombuffer(data[at + HEADER.size : follows], "<u4").reshape(lanes, 2)
        ends = follows + CHECKSUM.size + np.cumsum(head[:, 1].astype(np.int64))
        if ends[-1] > len(data):
            raise CorruptBlock(f"no frame ends at byte {ends[-1]}")
        begins = ends - head[:, 1]
        ids = _decoded([data[b:e] for b, e in zip(begins, ends, strict=True)], bits, size)
        steps = -(-size // lanes)
        for i in range(lanes):
            if zlib.crc32(ids[i * steps : (i + 1) * steps].tobytes()) != head[i, 0]:
                raise CorruptBlock(f"block {i} of the frame that ends at byte {ends[-1]} has another checksum")
        out.append(ids)
        at = int(ends[-1])
    return np.concatenate(out)


def _decoded(payloads: list[bytes], most: int, size: int) -> np.ndarray:
    """The ``size`` ids of a frame whose longest ids have ``most`` bits."""
    lanes = len(payloads)
    steps = -(-size // lanes)
    counts, past, coder = _Counts(most), _Predictions(lanes, most), _Decoder(payloads)
    columns = np.zeros((steps, lanes), np.uint32)
    for first, last in _intervals(lanes, steps):
        ways, slots = counts.lookups()
        cells = np.empty((last - first, lanes), np.int64)
        way_begin, way_part = counts.way_begin.ravel(), counts.way_part.ravel()
        for t in range(last - first):
            share = past.look()
            share <<= _WAY_BITS
            share += np.minimum(coder.share(_U(_WAY_BITS)), (1 << _WAY_BITS) - 1)
            cells[t] = ways.take(share)
            cell = cells[t]
            coder.take(way_begin.take(cell), way_part.take(cell))
            way = cell & (_WAYS - 1)
            now = columns[first + t]
            now[:] = past.found[1]
            np.copyto(now, past.found[0], where=way == 0, casting="unsafe")
            if (some := (way == 2).nonzero()[0]).size:
                now[some] = counts.slot_id.take(coder.slots(some, counts, slots))
            if (rare := (way > 2).nonzero()[0]).size:
                bits = way[rare] - 3
                now[rare] = bits
                long = bits > 1
                rare, bits = rare[long], bits[long].astype(_U) - _U(1)
                if rare.size and not counts.plain:
                    coder.settle()
                now[rare] = coder.take_bits(rare, bits) + (_U(1) << bits)
            coder.settle()
            past.learn(now, past.found == now)
        counts.update(cells, columns[first:last])
    return np.ascontiguousarray(columns.T).reshape(-1)[:size].astype("<u4", copy=False)
