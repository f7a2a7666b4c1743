"""Language-model scoring with a Katz backoff model of word pairs.

The chance of a word after another is its Good-Turing discounted share of what followed that context in training; what
the discounts leave over goes to the words that never followed it, in proportion to their chances by the lower order,
by a weight that makes all chances of a context sum to exactly one. The lower order is discounted the same way, and
leaves its rest to one unknown word. Counts above ``LARGEST`` keep the last count's absolute discount, so that every
context leaves something over.

How it runs. Documents are taken in blocks of at most ``BLOCK_ROWS`` rows and about ``BLOCK_BYTES`` bytes, so that a word pair is one entry per block and not one
per occurrence:

1. Every block sends its distinct words and pairs, with their training counts, to buckets by hash; a bucket adds them up,
   keeps the sums as its partition of the model's table of counts, and answers each block with the sums of its entries
   (one answer per pair also says "yours", so that each pair is told of by one block only).
2. Blocks meet their answers, score what needs no backoff weight, and send each context's part of the two sums of its
   backoff weight, and each document's contexts that need one.
3. Weights are made of the sums per context, joined to the documents that need them, and added to their scores.

Words and pairs travel as 64-bit hashes; two different ones share one with a chance of about 2^-64. Hot words and pairs
are one entry per block, and buckets are by hash of the entry, so no context has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.cluster import written
from statledger.llm.textarrays import BASE, NOT_WHITE, mix, slices, words

#: Largest count with a Good-Turing discount.
LARGEST = 5
BLOCK_ROWS = 8192
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 4 << 20
_END, _BEGIN = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_ANSWERS = "kind int, order int, bucket long, block long, keys binary, counts binary, first long, second long"


def numbered(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, text, held_out and row of every row. Row numbers are Spark's, which leave 31 bits to the partition."""
    return docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.monotonically_increasing_id().alias("row"))


def dealt(batches: Iterator[pa.RecordBatch], block_rows: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition with their block: the row number that it begins with.

    Blocks are runs of at most ``block_rows`` rows; one ends with the row that takes its texts to ``block_bytes``.
    """
    block, rows, held = -1, 0, 0
    for batch in slices(batches, max_bytes=SLICE_BYTES):
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        blocks = np.empty(batch.num_rows, np.int64)
        for i, (row, size) in enumerate(zip(batch.column("row").to_pylist(), sizes, strict=True)):
            if block < 0 or rows >= block_rows or held >= block_bytes:
                block, rows, held = row, 0, 0
            blocks[i] = block
            rows += 1
            held += size
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks)], [*batch.schema.names, "block"])


def with_blocks(rows: DataFrame, block_rows: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    schema = T.StructType([*rows.schema, T.StructField("block", T.LongType())])
    return rows.mapInArrow(lambda batches: dealt(batches, block_rows, block_bytes), schema)


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data) or b"", np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


@dataclass
class Block:
    """Distinct words and pairs of some documents, in order of their hashes."""

    first: np.ndarray  # first token of each document
    word: np.ndarray
    word_of: np.ndarray  # of each token
    pair: np.ndarray
    pair_at: np.ndarray  # a token that ends each pair
    pair_of: np.ndarray
    context: np.ndarray  # word number of what precedes each token; -1 at the beginning of a document

    @property
    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end; and the number of tokens of each text."""
    own = words(column, NOT_WHITE)
    count = len(column)
    out = np.full(len(own.start) + count, _END)
    out[np.arange(len(own.start)) + own.text] = own.hashes
    return out, own.counts + 1


def block_of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Block:
    token = np.concatenate([p[0] for p in parts])
    first = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first[:-1]] = _BEGIN
    word, word_of = np.unique(token, return_inverse=True)
    pair, pair_at, pair_of = np.unique(mix(mix(before) * np.uint64(BASE) + token), return_index=True, return_inverse=True)
    context = np.empty(len(token), np.int64)
    context[1:] = word_of[:-1]
    context[first[:-1]] = -1
    return Block(first, word, word_of, pair, pair_at, pair_of, context)


def entries(rows: DataFrame, buckets: int, block_rows: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every block's distinct words (order 1) and pairs (order 2) with their training counts, by bucket."""
    bits = int(buckets).bit_length() - 1

    def sent(number: int, parts: list, held: list) -> pa.RecordBatch:
        own = block_of(parts)
        training = np.repeat(~np.concatenate(held), np.diff(own.first))
        rows = []
        for order, keys, places in ((1, own.word, own.word_of), (2, own.pair, own.pair_of)):
            counts = np.bincount(places, training, minlength=len(keys)).astype(np.uint32)
            bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.unique(bucket).tolist():
                some = slice(edges[b], edges[b + 1])
                rows.append((order, b, number, pack_sorted(keys[some]), pack(counts[some])))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["order", "bucket", "block", "keys", "counts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = None, [], []
        # Blocks are dealt in the same Python worker, which a second one in a row would add to.
        for batch in dealt(batches, block_rows, block_bytes):
            blocks = batch.column("block").to_numpy()
            for begin in np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])).tolist():
                end = int(np.searchsorted(blocks, blocks[begin], "right"))
                some = batch.slice(begin, end - begin)
                if number is not None and number != blocks[begin]:
                    yield sent(number, parts, held)
                    parts, held = [], []
                number = int(blocks[begin])
                parts.append(tokens(some.column("text")))
                held.append(some.column("held_out").to_numpy(zero_copy_only=False))
        if parts:
            yield sent(number, parts, held)

    # All columns are read, as they are later: a plan that reads fewer might deal rows to partitions in another way.
    return rows.mapInArrow(run, "order int, bucket long, block long, keys binary, counts binary")


def _add_up(group: pa.Table) -> pa.Table:
    """Sums of one bucket: a row of the model (kind 0), its counts of counts (1), and an answer to each block (2)."""
    order, bucket = group.column("order")[0].as_py(), group.column("bucket")[0].as_py()
    keys = [unpack_sorted(x.as_py()) for x in group.column("keys")]
    counts = np.concatenate([unpack(x.as_py(), np.uint32) for x in group.column("counts")]).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, counts, minlength=len(distinct)).astype(np.int64)
    told = np.flatnonzero(counts)
    teller = np.full(len(distinct), -1)
    teller[place[told][::-1]] = told[::-1]
    answer = total[place] << 1
    answer[teller[teller >= 0]] |= 1
    seen = total > 0
    rows = [(0, order, bucket, None, pack_sorted(distinct[seen]), pack(total[seen]), int(total.sum()), int(seen.sum()))]
    often = np.bincount(total[seen & (total <= LARGEST + 1)], minlength=LARGEST + 2)
    rows += [(1, order, bucket, None, None, None, r, int(often[r])) for r in range(1, LARGEST + 2)]
    for block, some in zip(group.column("block").to_pylist(), np.split(answer, ends[:-1]), strict=True):
        rows.append((2, order, bucket, block, None, pack(some.astype(np.uint64)), None, None))
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = ["kind", "order", "bucket", "block", "keys", "counts", "first", "second"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


@dataclass
class Discounts:
    """Share of a count that is kept: ``kept[r]`` for r up to ``LARGEST``, and ``r - rest`` of any larger r."""

    kept: np.ndarray
    rest: float

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        small = self.kept[np.minimum(counts, LARGEST)] * counts
        return np.where(counts <= LARGEST, small, counts - self.rest)


def good_turing(often: dict[int, int]) -> Discounts:
    """Katz's discounts from the numbers of entries seen once, twice, ... ``LARGEST + 1`` times.

    Where these numbers give no share between 0 and 1, as in small or odd corpora, all counts lose the same amount.
    """
    n = np.array([0] + [often.get(r, 0) for r in range(1, LARGEST + 2)], dtype=float)
    kept = np.ones(LARGEST + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        tail = (LARGEST + 1) * n[LARGEST + 1] / n[1]
        for r in range(1, LARGEST + 1):
            kept[r] = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
    if not (np.isfinite(kept).all() and (kept[1:] > 0).all() and (kept[1:] < 1).all()):
        lost = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        lost = min(max(lost, 0.1), 0.9)
        kept = np.array([1.0] + [(r - lost) / r for r in range(1, LARGEST + 1)])
    return Discounts(kept, LARGEST * (1 - kept[LARGEST]))


@dataclass
class Model:
    """What does not grow with the vocabulary: totals and discounts."""

    tokens: int
    distinct: int
    documents: int
    words: Discounts
    pairs: Discounts
    unknown: float  # chance of the unknown word

    def chances(self, counts: np.ndarray) -> np.ndarray:
        """Of words by their counts; those never seen share the unknown word's."""
        return np.where(counts > 0, self.words(counts) / max(1, self.tokens), self.unknown)


def fit(answers: DataFrame, documents: int) -> Model:
    """Totals and discounts from the buckets' rows."""
    rows = answers.filter("kind = 1").groupBy("order", "first").agg(F.sum("second").alias("entries")).collect()
    often = {o: {r["first"]: r["entries"] for r in rows if r["order"] == o} for o in (1, 2)}
    total = answers.filter("kind = 0 and order = 1").agg(F.sum("first").alias("n"), F.sum("second").alias("v")).first()
    n, v = total.n or 0, total.v or 0
    kept = good_turing(often[1])
    # What words keep: their counts less what each discount takes.
    lost = sum(often[1].get(r, 0) * r * (1 - kept.kept[r]) for r in range(1, LARGEST + 1))
    larger = v - sum(often[1].get(r, 0) for r in range(1, LARGEST + 1))
    unknown = (lost + larger * kept.rest) / n if n else 1.0
    return Model(n, v, documents, kept, good_turing(often[2]), unknown)


def _answered(table: pa.Table, order: int) -> np.ndarray:
    rows = table.filter(pa.compute.equal(table.column("order"), order)).sort_by("bucket")
    parts = [unpack(x.as_py(), np.uint64) for x in rows.column("counts")]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _scored(model: Model):
    """Function of a block's documents and answers: documents' rows, and rows of contexts (see the module)."""
    names = ["kind", "doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "context", "mass", "lower", "times"]

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        import pyarrow.compute  # noqa: F401

        key_type = docs.schema.field("doc_id").type
        kinds = [pa.int32(), key_type, pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2, pa.int64(), *[pa.float64()] * 2, pa.int64()]
        empty = pa.table([pa.array([], k) for k in kinds], names)
        if not docs.num_rows:
            return empty
        own = block_of([tokens(b.column("text")) for b in slices(docs.to_batches(), max_bytes=SLICE_BYTES)])
        answer = _answered(answers, 1), _answered(answers, 2)
        if (len(own.word), len(own.pair)) != tuple(map(len, answer)):
            raise RuntimeError("the documents changed between two readings; write them as a table first")
        count, pairs, mine = answer[0] >> 1, answer[1] >> 1, (answer[1] & 1).astype(bool)
        chance = model.chances(count)
        # Of each distinct pair: its context's count, its word, and what it keeps.
        context, word = own.context[own.pair_at], own.word_of[own.pair_at]
        often = np.where(context >= 0, count[context], model.documents)
        with np.errstate(divide="ignore"):
            seen = np.log10(model.pairs(pairs) / np.maximum(1, often))
            pair_score = np.where(pairs > 0, seen, np.log10(chance[word]))
        first, size = own.first[:-1], np.diff(own.first)
        score = np.add.reduceat(pair_score[own.pair_of], first)
        known = np.add.reduceat((count > 0)[own.word_of].astype(np.int64), first)
        base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))
        base = np.add.reduceat(base[own.word_of], first)
        number = docs.column("row").to_numpy()

        def rows(kind, length, **columns):
            arrays = [columns.get(n, pa.nulls(length, k)) for n, k in zip(names, kinds, strict=True)]
            arrays[0] = np.full(length, kind)
            return pa.table([a if isinstance(a, pa.ChunkedArray) else pa.array(a, k) if isinstance(a, np.ndarray) else a for a, k in zip(arrays, kinds, strict=True)], names)

        documents = rows(
            0, docs.num_rows, doc_id=docs.column("doc_id"), held_out=docs.column("held_out"), row=number,
            n_tokens=size, n_known=known, base_score=base, score=score,
        )
        told = np.flatnonzero(mine)
        key, back = np.unique(context[told], return_inverse=True)
        names_of = np.append(own.word, _BEGIN).view(np.int64)  # -1 is the beginning
        contexts = rows(
            1, len(key), context=names_of[key],
            mass=np.bincount(back, model.pairs(pairs[told]) / np.maximum(1, often[told]), minlength=len(key)),
            lower=np.bincount(back, chance[word[told]], minlength=len(key)),
        )
        # A context that training never had gives the word its lower chance as it is.
        open_ = np.flatnonzero(((pairs == 0) & (often > 0))[own.pair_of])
        wanted, times = np.unique((own.document[open_] << 33) + own.context[open_] + 1, return_counts=True)
        needs = rows(2, len(wanted), row=number[wanted >> 33], context=names_of[(wanted & ((1 << 33) - 1)) - 1], times=times)
        return pa.concat_tables([documents, contexts, needs])

    return run


def score(docs: DataFrame, held_out: Column, block_rows: int = BLOCK_ROWS, buckets: int | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows for which ``held_out`` is not true teach the model; all are scored, score being the log10 probability of the
    text under it and base_score that of a smoothed model of single words. A null text is empty, and has one token, its
    end; a held_out that is null counts as false. Rows are scored one by one: repeated rows count and score as often as
    they occur. With nothing to learn from, every word is the unknown one. An empty table gives no rows. ``docs`` is
    read three times and must be the same each time, as a table of files is.
    """
    spark = docs.sparkSession
    rows = numbered(docs, held_out)
    parts = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 1 << max(0, parts - 1).bit_length()
    answers = written(entries(rows, parts, block_rows).groupBy("order", "bucket").applyInArrow(_add_up, _ANSWERS), "katz-counts")
    model = fit(answers, rows.filter("not held_out").count())
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"kind int, doc_id {key}, held_out boolean, row long, n_tokens long, n_known long, base_score double, score double, "
        "context long, mass double, lower double, times long"
    )
    scored = (
        with_blocks(rows, block_rows).groupBy("block")
        .cogroup(answers.filter("kind = 2").select("block", "order", "bucket", "counts").groupBy("block"))
        .applyInArrow(_scored(model), schema)
    )
    found = written(scored, "katz-scores")
    sums = found.filter("kind = 1").groupBy("context").agg(F.sum("mass").alias("mass"), F.sum("lower").alias("lower"))
    weights = sums.select("context", F.log10((1 - F.col("mass")) / (1 - F.col("lower"))).alias("weight"))
    backed = (
        found.filter("kind = 2").select("row", "context", "times").join(weights, "context")
        .groupBy("row").agg(F.sum(F.col("times") * F.col("weight")).alias("backoff"))
    )
    documents = found.filter("kind = 0").join(backed, "row", "left")
    return documents.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("score") + F.coalesce("backoff", F.lit(0.0))).alias("score"),
    )
