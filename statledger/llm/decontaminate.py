"""Benchmark decontamination with suffix arrays of the training text.

Each batch of documents is a shard. Its suffix array holds the word positions at which a benchmark passage could begin,
sorted by the words that follow; positions followed by a word that no benchmark item has cannot match, and are left
out. Every suffix of every item is searched in it by bisection, which gives all places where the suffix's first window
occurs. Places that continue each other on one diagonal (same distance between document and item) make the longest
verbatim matches.

Documents are read once per block of benchmark items, and no document moves. A block is broadcast, and is bounded by
``BLOCK_BYTES`` of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.textarrays import LETTER_OR_DIGIT, Words, slices, words

WINDOW = 10
#: Benchmark text per broadcast block.
BLOCK_BYTES = 16 << 20
#: Document text searched at once.
SLICE_BYTES = 1 << 20


@dataclass
class Suffixes:
    """The suffixes of one block of items that are long enough to begin a window, by their first window."""

    known: np.ndarray  # hashes of all words, sorted
    width: dict[int, int]  # window sizes: of items with fewer words than the window, their own
    keys: dict[int, np.ndarray]  # by size: distinct first windows, sorted
    first: dict[int, np.ndarray]  # by size: where each key's suffixes begin in the next two
    item: dict[int, np.ndarray]
    at: dict[int, np.ndarray]  # position of the suffix in the block's words
    begins: dict[int, np.ndarray]  # hashes of the words that begin a window


def word_keys(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``size`` word numbers from each position as one sortable byte string; numbers begin at 1, so none is cut off."""
    rows = ids[at[:, None] + np.arange(size)].astype(">u4")
    return np.ascontiguousarray(rows).view(f"S{4 * size}").ravel() if len(at) else np.zeros(0, f"S{4 * size}")


def _numbers(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Number of each word among the known ones, from 1; 0 for others."""
    if not len(known):
        return np.zeros(len(hashes), np.uint32)
    maybe = np.zeros(1 << 20, dtype=bool)
    maybe[known >> np.uint64(44)] = True
    near = np.flatnonzero(maybe[hashes >> np.uint64(44)])
    place = np.minimum(np.searchsorted(known, hashes[near]), len(known) - 1)
    out = np.zeros(len(hashes), np.uint32)
    out[near] = np.where(known[place] == hashes[near], place + 1, 0)
    return out


def _sizes(own: Words, window: int) -> np.ndarray:
    return np.minimum(own.counts, window)


def test_suffixes(texts: list[str | None], window: int = WINDOW) -> Suffixes:
    """All suffixes of the items ``texts``."""
    own = words(pa.array(texts, pa.string()), LETTER_OR_DIGIT)
    known = np.unique(own.hashes)
    ids = _numbers(known, own.hashes)
    sizes = _sizes(own, window)
    out = Suffixes(known, {}, {}, {}, {}, {}, {})
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(own.text[: max(0, len(ids) - size + 1)] == own.text[size - 1 :])
        at = at[sizes[own.text[at]] == size]
        keys = word_keys(ids, at, size)
        order = np.argsort(keys, kind="stable")
        distinct, first = np.unique(keys[order], return_index=True)
        out.width[size] = size
        out.keys[size], out.first[size] = distinct, np.append(first, len(at))
        out.item[size], out.at[size] = own.text[at][order], at[order]
        out.begins[size] = np.unique(own.hashes[at])
    return out


def search(column: pa.Array, tests: Suffixes) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Word counts of the texts, and all longest verbatim matches: text, word position, words, item."""
    own = words(column, LETTER_OR_DIGIT)
    found: dict[str, list[np.ndarray]] = {"text": [], "at": [], "words": [], "item": []}
    n = len(own.start)
    ids = _numbers(tests.known, own.hashes) if n else np.zeros(0, np.uint32)
    outside = np.append(np.flatnonzero(ids == 0), n)
    left = np.minimum(outside[np.searchsorted(outside, np.arange(n))], own.first[1:][own.text]) - np.arange(n) if n else ids
    for size, keys in tests.keys.items():
        # The shard's suffix array, down to the first window.
        at = np.flatnonzero(left >= size)
        if size < max(tests.keys):
            at = at[np.isin(own.hashes[at], tests.begins[size])]
        suffixes = word_keys(ids, at, size)
        order = np.argsort(suffixes, kind="stable")
        suffixes, at = suffixes[order], at[order]
        low, high = np.searchsorted(suffixes, keys, "left"), np.searchsorted(suffixes, keys, "right")
        hit = np.flatnonzero(high > low)
        places = high[hit] - low[hit]
        pairs = places * np.diff(tests.first[size])[hit]
        # Every place of every suffix that begins with the window.
        key = np.repeat(np.arange(len(hit)), pairs)
        inner = np.arange(len(key)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        place = at[low[hit][key] + inner % places[key]]
        suffix = tests.first[size][hit][key] + inner // places[key]
        item, there = tests.item[size][suffix], tests.at[size][suffix]
        # Runs on one diagonal are one match.
        order = np.lexsort((place, there - place))
        place, item, line = place[order], item[order], (there - place)[order]
        text = own.text[place]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (place[1:] != place[:-1] + 1) | (item[1:] != item[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        run = np.diff(np.append(begin, len(place)))
        for name, values in (("text", text[begin]), ("at", place[begin]), ("words", run + size - 1), ("item", item[begin])):
            found[name].append(values)
    out = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in found.items()}
    out["at"] = out["at"] - own.first[out["text"]]
    return own.counts, out


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All longest verbatim matches, per document and block of items.

    Returns per row of ``docs`` and block: doc_id, n_words, matches (array of at, words, item_id; word positions from
    0). An item with fewer words than the window matches as a whole. Texts that are null or have no words have no
    matches, as have such items; an item without an id matches, with a null item_id. Other columns are ignored. An
    empty benchmark is one block without matches.
    """
    source = docs.select("doc_id", "text")
    kind = benchmark.schema["item_id"].dataType
    match = T.StructType([T.StructField("at", T.LongType()), T.StructField("words", T.LongType()), T.StructField("item_id", kind)])
    schema = T.StructType([source.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("matches", T.ArrayType(match))])

    def over(names, tests):
        shared = docs.sparkSession.sparkContext.broadcast((names, tests))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            names, tests = shared.value
            items = pa.array(names, arrow.field("matches").type.value_type.field("item_id").type)
            for batch in slices(batches, max_bytes=SLICE_BYTES):
                counts, found = search(batch.column("text"), tests)
                order = np.lexsort((found["at"], found["text"]))
                found = {k: v[order] for k, v in found.items()}
                offsets = np.searchsorted(found["text"], np.arange(batch.num_rows + 1))
                values = pa.StructArray.from_arrays(
                    [pa.array(found["at"], pa.int64()), pa.array(found["words"], pa.int64()), items.take(pa.array(found["item"], pa.int64()))],
                    fields=list(arrow.field("matches").type.value_type),
                )
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, type=arrow.field("matches").type)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), lists], schema=arrow)

        return source.mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, [over(names, test_suffixes(texts, window)) for names, texts in blocks(benchmark, block_bytes)])


def blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items, in blocks of bounded size; one empty block if there are none."""
    names, texts, size, some = [], [], 0, False
    for row in benchmark.select("item_id", "text").dropDuplicates().toLocalIterator():
        names.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "")
        if size >= block_bytes:
            yield names, texts
            names, texts, size, some = [], [], 0, True
    if names or not some:
        yield names, texts


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a match), item_ids (sorted, distinct), longest_match.

    Rows that share a doc_id give one row: they should be copies of one document. Null ids are one id.
    """
    found = matches(docs, benchmark, window, block_bytes)
    ends = F.array_sort(F.flatten(F.collect_list("matches")))
    covered = F.aggregate(
        "all",
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("end")),
        lambda a, m: F.struct(
            (a.hit + F.greatest(F.lit(0).cast("long"), m["at"] + m["words"] - F.greatest(a.end, m["at"]))).alias("hit"),
            F.greatest(a.end, m["at"] + m["words"]).alias("end"),
        ),
    )["hit"]
    names = F.array_sort(F.array_distinct(F.filter(F.transform("all", lambda m: m["item_id"]), lambda x: x.isNotNull())))
    longest = F.coalesce(F.array_max(F.transform("all", lambda m: m["words"])), F.lit(0).cast("long"))
    return (
        found.groupBy("doc_id")
        .agg(F.max("n_words").alias("n_words"), ends.alias("all"))
        .select("doc_id", "n_words", covered.alias("n_hit"), names.alias("item_ids"), longest.alias("longest_match"))
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit word, with all their columns."""
    hit = contamination(docs, benchmark, window).filter("n_hit > 0").select(F.col("doc_id").alias("__hit"))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["__hit"]), "left_anti")
