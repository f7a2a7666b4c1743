"""Periodic runs: stretches of words that repeat with a period at least four times over, found by multi-scale minimizers.

A run is a stretch with a smallest period q that no neighbouring word extends. Periods up to ``SHORT`` are found by
comparing the words with themselves q words on. Longer ones are sought in scales: the scale of P covers periods from
P + 1 to 2P. It hashes every stretch of 2P words and takes the least hash of every window of P stretches. In a run, two
stretches less than a period apart differ, and windows a period apart hold the same stretches; so the next equal
minimum lies exactly one period on. Such pairs seed the run, which is then extended word by word. A run of four periods
always holds two such windows, so none is missed; pairs that are not runs are turned down when they are extended.

No row leaves its task, and there is no shuffle. A batch of texts is worked on together, at most 4 MB (or one text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from statledger.llm.textarrays import BASE, NOT_WHITE, Words, mix, slices, words

#: Periods up to this one are found by direct comparison. A power of two.
SHORT = 8
LEAST_LENGTH, LEAST_REPEATS = 6, 4

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``size`` neighbours; ``size`` is a power of two."""
    step = 1
    while step < size:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of equal neighbouring minimizers whose distance is a period of this scale."""
    least = _sliding(grams, scale, np.minimum)
    edge = np.zeros(scale - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), scale, np.maximum) == grams)
    values = grams[chosen]
    order = np.argsort(values, kind="stable")
    at, values = chosen[order], values[order]
    apart = np.diff(at)
    found = (values[1:] == values[:-1]) & (apart > scale) & (apart <= 2 * scale)
    return at[:-1][found], apart[found]


def _agreeing(ids: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal those a period later."""
    count, size = 0, 64
    while True:
        if step > 0:
            begin = at + count
            end = min(begin + size, len(ids) - period)
            same = ids[begin:end] == ids[begin + period : end + period]
        else:
            end = at - count + 1
            begin = max(end - size, 0)
            same = (ids[begin:end] == ids[begin + period : end + period])[::-1]
        if begin >= end:
            return count
        differs = int(np.argmin(same))
        if not same[differs]:
            return count + differs
        count += end - begin
        size *= 2


def _extended(ids: np.ndarray, at: np.ndarray, apart: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the stretch around every seed, once for all seeds of a stretch."""
    order = np.lexsort((at, apart))
    at, apart = at[order], apart[order]
    periods, begins = np.unique(apart, return_index=True)
    for period, begin, end in zip(periods.tolist(), begins, np.append(begins, len(at))[1:]):
        own, k = at[begin:end], 0
        while k < len(own):
            seed = int(own[k])
            after = seed + _agreeing(ids, seed, period, 1)
            start = seed + 1 - _agreeing(ids, seed, period, -1)
            if after > seed:
                yield start, after - start + period, period
            k = int(np.searchsorted(own, max(after, seed + 1)))


def find_runs(
    hashes: np.ndarray, first: np.ndarray, least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts, whose words are ``hashes[first[d] : first[d + 1]]``: the number of each run's text, and rows of
    (start, length, period), by text, start and period. A run is ``least_length`` words and ``least_repeats`` periods."""
    if least_repeats < 4:
        raise ValueError("stretches of fewer than four periods may hold no pair of equal minimizers")
    counts = np.diff(first)
    n, texts = len(hashes), len(counts)
    # A word of its own after every text: no stretch that goes beyond a text equals another.
    text = np.repeat(np.arange(texts), counts)
    ids = np.empty(n + texts, np.uint64)
    ids[np.arange(n) + text] = hashes
    begins = first[:-1] + np.arange(texts)
    ids[begins + counts] = mix(np.arange(texts, dtype=np.uint64) + np.uint64(BASE))
    found: list[np.ndarray] = []
    for period in range(1, SHORT + 1):
        same = np.zeros(max(len(ids) - period, 0) + 2, np.int8)
        same[1:-1] = ids[:-period] == ids[period:]
        edges = np.diff(same)
        start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        length = end - start + period
        keep = length >= max(least_length, least_repeats * period)
        found.append(np.stack([start, length, np.full(len(start), period)], 1)[keep])
    scale, size, grams, at = SHORT, 1, ids, np.arange(len(ids))
    long = np.ones(texts, bool)
    while True:
        enough = counts >= least_repeats * (scale + 1)
        if not enough.any():
            break
        keep = np.repeat(enough[long], counts[long] + 1)[: len(grams)]
        grams, at, long = grams[keep], at[keep], enough
        while size < 2 * scale:
            grams = mix(grams[:-size] * np.uint64(BASE) + grams[size:])
            at = at[: len(grams)]
            size *= 2
        seeds, apart = _seeds(grams, scale)
        stretches = np.array(list(_extended(ids, at[seeds], apart)), np.int64).reshape(-1, 3)
        found.append(stretches[stretches[:, 1] >= np.maximum(least_length, least_repeats * stretches[:, 2])])
        scale *= 2
    runs = np.concatenate(found)
    # The same stretch under a multiple of its period, and a stretch found at two scales, count once.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(begins, runs[:, 0], "right") - 1
    runs[:, 0] -= begins[owner]
    return owner, runs


def _collapsed(parts: Words, owner: np.ndarray, runs: np.ndarray) -> pa.Array:
    """Texts of the words that no run holds beyond its first period, joined by a space."""
    n = len(parts.start)
    depth = np.zeros(n + 1, np.int64)
    begin = parts.first[owner] + runs[:, 0]
    np.add.at(depth, begin + runs[:, 2], 1)
    np.add.at(depth, begin + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth)[:n] == 0)
    start, size, text = parts.start[kept], parts.end[kept] - parts.start[kept], parts.text[kept]
    last = np.ones(len(kept), bool)
    last[:-1] = text[1:] != text[:-1]
    wide = size + ~last
    ends = np.cumsum(wide)
    total = int(ends[-1]) if len(ends) else 0
    out = np.full(total, 0x20, np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(ends - wide, size) + inside] = parts.data[np.repeat(start, size) + inside]
    of_text = np.zeros(len(parts.first) - 1, np.int64)
    np.add.at(of_text, text, wide)
    offsets = np.concatenate([[0], np.cumsum(of_text)])
    return pa.LargeStringArray.from_buffers(len(of_text), pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def periodic_runs(
    docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, least_repeats: int = LEAST_REPEATS
) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period in words, by start and period) and collapsed (the
    text with every run cut to its first period, words joined by one space).

    Null and empty texts, and texts without words, have no runs and an empty collapsed text. Repeated rows are judged
    each by itself; an empty table gives an empty one. Columns of ``docs`` with the names of the new ones are replaced.
    A text is one unit of work: a task holds about a hundred times its bytes in arrays while it does.
    """
    new = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    taken = {f.name for f in new}
    kept = [c for c in docs.columns if c not in taken]
    schema = T.StructType([*[docs.schema[c] for c in kept], *new])
    source = docs if text not in taken else docs.withColumnRenamed(text, f"__{text}")
    column = text if text not in taken else f"__{text}"
    source = source.select(*kept, *([column] if column not in kept else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]
        for batch in slices(batches, column):
            parts = words(batch.column(column), NOT_WHITE, lower=False)
            owner, runs = find_runs(parts.hashes, parts.first, least_length, least_repeats)
            offsets = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, k])) for k in range(3)], fields=fields)
            lists = pa.ListArray.from_arrays(pa.array(offsets), structs)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts.counts, pa.int64()), lists, _collapsed(parts, owner, runs)], schema.names)

    return source.mapInArrow(run, schema)
