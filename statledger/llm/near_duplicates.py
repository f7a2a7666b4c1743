"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Equal sets are one class, so copies cost nothing further. In each of
``TREES`` independent trees, every class chooses a minwise token; a node holds the classes that chose the same one. Two
classes of similarity s meet in a tree with chance s, so in one of ten trees with at least 1 - 0.2^10 at a similarity of
0.8, however large the nodes are: every unconnected pair of every node is compared.

Classes that are already connected need no comparison, so a node whose classes are all connected is done. A node with at
most ``exhaustive`` unconnected pairs per class is compared pair by pair. In another, all classes are first compared with
a few of them, the pivots, which connects dense groups; what is left unconnected is compared in full, in pairs of blocks
of bounded size: first all by their sketches, then by their full sets those that have another like them in the node. A pair of blocks is one task's work and gives only the links that connect something in it, so pairs
are never rows there. Its work still grows with the square of the unconnected classes of a node, in numpy.

Pairs first pass exact bounds on sizes and an estimate from sketches, then are confirmed on full sets of 64-bit shingle
hashes, which are made once and only for classes that met others: a bitmap of their ids, of bounded size, keeps the other texts
out of the shuffle. Pairs are never expanded among copies. Connected
components are found by passing on the smallest id and jumping along pointers, over confirmed links only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.cluster import written
from statledger.llm.textarrays import NOT_WHITE, Words, mix, slices, sums_by_text, words

SLICE_BYTES = 1 << 20
#: Blocks of full sets in a block of sketches.
SKETCH_BLOCKS = 4
#: Bits that tell before a shuffle which rows may be wanted (4 MB at most, whatever the input), and those of one bitmap.
FILTER_BITS = 1 << 25
BITMAP_BITS = 1 << 15


@dataclass(frozen=True)
class Join:
    """Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``shingle`` words."""

    shingle: int = 5
    percent: int = 80
    trees: int = 10
    #: A node with at most so many pairs of unconnected classes per class is compared exhaustively.
    exhaustive: int = 8
    pivots: int = 2
    #: Minwise tokens per document; trees take them in turn.
    tokens: int = 64
    #: Rounds of pivots. After them, what is left of the large nodes is compared exhaustively.
    depth: int = 1
    #: Classes, and shingles of them, in a block of a large node; rows of one task are two blocks.
    block: int = 1024
    block_shingles: int = 1 << 20
    #: Pairs go on if so many standard deviations below the wanted similarity still agree with their sketches.
    deviations: float = 4.5

    @property
    def agreeing(self) -> int:
        s = self.percent / 100
        return max(1, int(self.tokens * s - self.deviations * (self.tokens * s * (1 - s)) ** 0.5))


def shingle_sets(own: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle, by text; a text of fewer words is one shingle of all of them."""
    at, value = own.windows(size)
    texts, values = [own.text[at]], [value]
    for n in range(1, size):
        short = np.flatnonzero(own.counts == n)
        if len(short):
            total = np.zeros(len(short), np.uint64)
            for k in range(n):
                total = mix(total + own.hashes[own.first[short] + k])
            texts.append(short)
            values.append(mix(total + np.uint64(n)))
    text, value = np.concatenate(texts), np.concatenate(values)
    _, first = np.unique(value ^ mix(text + 1), return_index=True)
    first = first[np.argsort(text[first], kind="stable")]
    return text[first], value[first]


def signatures(docs: DataFrame, rule: Join) -> DataFrame:
    """doc_id, n, key1 and key2 (of the set), tokens (minwise values) and sketch (8 bits of each) of every row."""
    source = docs.select("doc_id", "text")
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("n", T.LongType()),
            T.StructField("key1", T.LongType()),
            T.StructField("key2", T.LongType()),
            T.StructField("tokens", T.ArrayType(T.IntegerType())),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    random = np.random.default_rng(20)
    factors = random.integers(0, 2**63, rule.tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = random.integers(0, 2**63, rule.tokens, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in slices(batches, max_bytes=SLICE_BYTES):
            count = batch.num_rows
            text, value = shingle_sets(words(batch.column("text"), NOT_WHITE), rule.shingle)
            first = np.searchsorted(text, np.arange(count + 1))
            sizes = np.diff(first)
            filled = np.flatnonzero(sizes)
            least = np.zeros((count, rule.tokens), np.uint32)
            for k in range(rule.tokens if len(filled) else 0):
                scattered = (((value ^ masks[k]) * factors[k]) >> np.uint64(32)).astype(np.uint32)
                least[filled, k] = np.minimum.reduceat(scattered, first[:-1][filled])
            keys = [sums_by_text(first, mix(value ^ np.uint64(c))).view(np.int64) for c in (0x51, 0xA7)]
            # Bits of a token that its use as a branch does not favour.
            sketch = (mix(least.ravel()) & np.uint64(255)).astype(np.uint8)
            arrays = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                *[pa.array(k) for k in keys],
                pa.ListArray.from_arrays(np.arange(count + 1, dtype=np.int32) * rule.tokens, pa.array(least.ravel().view(np.int32))),
                pa.FixedSizeBinaryArray.from_buffers(pa.binary(rule.tokens), count, [None, pa.py_buffer(sketch)]).cast(pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def full_sets(docs: DataFrame, rule: Join) -> DataFrame:
    """doc_id and shingles (sorted 64-bit hashes as bytes) of every row."""
    source = docs.select("doc_id", "text")
    schema = T.StructType([source.schema["doc_id"], T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, max_bytes=SLICE_BYTES):
            text, value = shingle_sets(words(batch.column("text"), NOT_WHITE), rule.shingle)
            value = value[np.lexsort((value, text))]
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int64) * 8
            sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(value.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets.cast(pa.binary())], schema.names)

    return source.mapInArrow(run, schema)


def _may_be_in(rows: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """The rows whose ``name`` is in ``wanted``, and a few others: those whose hash shares a bit with a wanted one's.

    Nothing is shuffled but the bits. More wanted values than bits let more rows pass, and lose none.
    """
    place = F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))
    bitmap, bit = F.floor(place / BITMAP_BITS).cast("int"), (place % BITMAP_BITS)
    bits = wanted.select(bitmap.alias("__bitmap"), bit.alias("bit")).groupBy("__bitmap").agg(F.bitmap_construct_agg("bit").alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    near = rows.join(F.broadcast(bits), bitmap == F.col("__bitmap"))
    return near.filter(F.getbit(byte, (bit % 8).cast("int")) == 1).select(rows.columns)


def _like(pairs: DataFrame, classes: DataFrame, rule: Join) -> DataFrame:
    """Pairs whose sketches agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                    for c in ("sketch_a", "sketch_b")
                )
                agree = (one == two).sum(axis=1) >= rule.agreeing
                yield batch.select(["a", "b"]).filter(pa.array(agree))

    joined = _beside(pairs, classes.select("rep", "sketch"), "sketch")
    return joined.mapInArrow(run, pairs.schema)


def _beside(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) with both classes' ``name``."""
    for side in "ab":
        pairs = pairs.join(values.select(F.col("rep").alias(side), F.col(name).alias(f"{name}_{side}")), side)
    return pairs.select("a", "b", f"{name}_a", f"{name}_b")


def _confirmed(pairs: DataFrame, sets: DataFrame, rule: Join) -> DataFrame:
    """Pairs that are linked, by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(batch.column("shingles_a"), batch.column("shingles_b"), strict=True):
                one, two = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(two.as_buffer(), np.uint64)
                both = np.concatenate([one, two])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= rule.percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return _beside(pairs, sets, "shingles").mapInArrow(run, pairs.schema)


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Columns node and least: the smallest id that each end of the links (a, b) is connected with.

    Every round, a node takes the least label of its neighbours, and then its label's label. Labels are written each
    round; a round only moves the links and one row per node. With ``rounds``, it stops there: nodes of one label are
    connected, but not all that are connected have one label yet.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("least")), "labels")
    while rounds != 0:
        rounds = None if rounds is None else rounds - 1
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("least").alias("near"))
        )
        passed = labels.join(near, "node").select("node", F.least("least", "near").alias("next"), F.col("least").alias("old"))
        jump = labels.select(F.col("node").alias("next"), F.col("least").alias("further"))
        new = written(passed.join(jump, "next").select("node", F.least("next", "further").alias("least"), "old"), "labels")
        changed = rounds is not None or new.filter("least <> old").limit(1).count()
        labels = new.select("node", "least")
        if not changed:
            break
    return labels


def near_duplicates(docs: DataFrame, rule: Join | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text; others are ignored).

    component_id is the smallest doc_id that can be reached over links, and kept says that it is the row's own. Texts
    that are null or have no words are linked with nothing. Rows that repeat an id and text share its answer. A row
    without an id can be linked, but names no component; alone, it is kept. An empty table gives no rows.
    """
    rule = rule or Join()
    signed = written(signatures(docs, rule), "signatures")
    classes = written(
        signed.filter("n > 0 and doc_id is not null")
        .groupBy("key1", "key2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")),
        "classes",
    )
    labels = written(_connected(docs, classes, rule), "components")
    named = classes.select("key1", "key2", "n", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("key1", "key2", "n", F.coalesce("least", "rep").alias("component"))
    out = signed.select("doc_id", "n", "key1", "key2").join(named, ["key1", "key2", "n"], "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def _connected(docs: DataFrame, classes: DataFrame, rule: Join) -> DataFrame:
    """Columns node and least of all classes that are linked with others."""
    spark = docs.sparkSession
    roots = F.transform(
        F.sequence(F.lit(0), F.lit(rule.trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.xxhash64(t, F.col("tokens")[t]).alias("path")),
    )
    nodes = classes.select("rep", "n", F.explode(roots).alias("at")).select("rep", "n", "at.tree", "at.path")
    kind = classes.schema["rep"].dataType
    none = spark.createDataFrame([], T.StructType([T.StructField("node", kind), T.StructField("least", kind)]))
    labels, sets, found = none, None, []

    def made(met: DataFrame) -> DataFrame:
        met = written(met.distinct(), "met")
        texts = _may_be_in(docs.select("doc_id", "text"), met.select(F.col("__met").alias("doc_id")), "doc_id")
        # One row of each id, while the texts lie by id: the sets are not moved for it.
        texts = texts.join(met, F.col("doc_id") == F.col("__met"), "left_semi").dropDuplicates(["doc_id"])
        return written(full_sets(texts, rule).withColumnRenamed("doc_id", "rep"), "sets")

    for number in range(rule.depth + 1):
        rows = nodes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        rows = rows.withColumn("component", F.coalesce("least", "rep")).drop("least")
        chosen = [
            F.min(F.struct(F.xxhash64("rep", F.lit(number), F.lit(i)).alias("order"), "rep", "n", "component")).alias(f"pivot{i}")
            for i in range(rule.pivots)
        ]
        pivots = [f"pivot{i}" for i in range(rule.pivots)]
        sizes = (
            rows.groupBy("path", "component")
            .agg(F.count("*").alias("size"), F.sum("n").alias("shingles"), *chosen)
            .groupBy("path")
            .agg(
                F.count("*").alias("components"),
                F.sum("size").alias("size"),
                F.sum("shingles").alias("shingles"),
                ((F.sum("size") * F.sum("size") - F.sum(F.col("size") * F.col("size"))) / 2).alias("unconnected"),
                *[F.min(c).alias(c) for c in pivots],
            )
            .filter("components > 1")
            .select(
                "path",
                (F.col("unconnected") > rule.exhaustive * F.col("size")).alias("large"),
                F.greatest(F.ceil(F.col("size") / rule.block), F.ceil(F.col("shingles") / rule.block_shingles)).cast("int").alias("blocks"),
                F.array_distinct(F.array(*pivots)).alias("pivots"),
            )
        )
        active = written(rows.join(sizes, "path"), "nodes")
        if number == rule.depth:
            found.append(written(_compared(active, classes, sets if sets is not None else made(active.select(F.col("rep").alias("__met"))), rule), "confirmed"))
            break
        large = F.col("large")
        pairs = written(_pairs(active, large, rule), "pairs")
        like = written(_like(pairs, classes, rule), "pairs")
        nodes = active.filter(large).select("rep", "n", "tree", "path")
        if sets is None:
            # Only classes like another of their node can need their sets, in this round or later.
            alike = written(_alike(active.filter(large), classes, rule), "alike")
            met = like.select(F.col("a").alias("__met")).unionAll(like.select("b"))
            sets = made(met.unionAll(alike.select("rep")))
        found.append(written(_confirmed(like, sets, rule), "confirmed"))
        nodes = nodes.join(alike, ["path", "rep"], "left_semi")
        if not nodes.limit(1).count():
            break
        # What is known to be connected so far saves comparisons later; it need not be all that is.
        known = labels.filter("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
        labels = components(known.unionAll(found[-1]), rounds=2)
    return components(reduce(DataFrame.unionAll, found))


def _possible(rule: Join, label: np.ndarray, n: np.ndarray, tokens: np.ndarray, sketch: np.ndarray, u: int, some: np.ndarray) -> np.ndarray:
    """Those of ``some`` that may be linked with u, are not connected with it, and meet it in no earlier tree."""
    some = some[label[some] != label[u]]
    some = some[100 * np.minimum(n[some], n[u]) >= rule.percent * np.maximum(n[some], n[u])]
    # A pair is compared in the first tree in which it meets.
    some = some[~(tokens[some] == tokens[u]).any(axis=1)]
    return some[(sketch[some] == sketch[u]).sum(axis=1) >= rule.agreeing]


def _in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """Rows with block, and one and two of each pair of blocks of their node that theirs is in."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep", F.lit("block")), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("other", "blocks")


def _alike(active: DataFrame, classes: DataFrame, rule: Join) -> DataFrame:
    """path and rep of the classes that have another in their node with which a link is possible, by sizes and sketches.

    The others have no links there. Blocks are larger than those of full sets, whose rows have many times the bytes.
    """
    rows = active.select("rep", "n", "tree", "path", "component", F.ceil(F.col("blocks") / SKETCH_BLOCKS).cast("int").alias("blocks"))
    rows = rows.join(classes.select("rep", F.slice("tokens", 1, rule.trees).alias("tokens"), "sketch"), "rep")
    out = T.StructType([active.schema["path"], active.schema["rep"]])

    def run(group: pa.Table) -> pa.Table:
        one, two, tree = (group.column(c)[0].as_py() for c in ("one", "two", "tree"))
        count = group.num_rows
        block, n = group.column("block").to_numpy(), group.column("n").to_numpy()
        label = rep_codes(group.column("component"))
        tokens = group.column("tokens").combine_chunks().flatten().to_numpy().reshape(count, -1)[:, :tree]
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(count, -1)
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        found = np.zeros(count, dtype=bool)
        for number, u in enumerate(left.tolist()):
            some = _possible(rule, label, n, tokens, sketch, u, left[number + 1 :] if one == two else right)
            found[some] = True
            found[u] |= len(some) > 0
        return group.select(["path", "rep"]).filter(pa.array(found))

    return _in_blocks(rows, F.col("blocks")).groupBy("path", "one", "two").applyInArrow(run, out).distinct()


def _compared(active: DataFrame, classes: DataFrame, sets: DataFrame, rule: Join) -> DataFrame:
    """Links (a, b) that connect all linked classes of every node: each pair of blocks of a node gives a forest of its own."""
    rows = active.select("rep", "n", "tree", "path", "component", "blocks")
    rows = rows.join(classes.select("rep", F.slice("tokens", 1, rule.trees).alias("tokens"), "sketch"), "rep").join(sets, "rep")
    rows = _in_blocks(rows, F.col("blocks"))
    kind = classes.schema["rep"].dataType
    links = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def run(group: pa.Table) -> pa.Table:
        one, two, tree = (group.column(c)[0].as_py() for c in ("one", "two", "tree"))
        count, rep = group.num_rows, group.column("rep")
        block, n = group.column("block").to_numpy(), group.column("n").to_numpy()
        label = rep_codes(group.column("component"))
        tokens = group.column("tokens").combine_chunks().flatten().to_numpy().reshape(count, -1)[:, :tree]
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(count, -1)
        parts = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        # Shingles of one class only can be in no intersection.
        distinct, value, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = times[value] > 1
        owner = np.repeat(np.arange(count), [len(x) for x in parts])[shared]
        value = value[shared]
        first = np.searchsorted(owner, np.arange(count + 1))
        mark = np.zeros(len(distinct), dtype=bool)
        left = np.flatnonzero(block == one)
        right = np.flatnonzero(block == two)
        found: list[tuple[int, int]] = []
        for number, u in enumerate(left.tolist()):
            some = _possible(rule, label, n, tokens, sketch, u, left[number + 1 :] if one == two else right)
            if not len(some):
                continue
            mark[value[first[u] : first[u + 1]]] = True
            sizes = first[some + 1] - first[some]
            begins = np.cumsum(sizes) - sizes
            places = np.repeat(first[some] - begins, sizes) + np.arange(sizes.sum())
            running = np.concatenate([[0], np.cumsum(mark[value[places]])])
            common = running[begins + sizes] - running[begins]
            mark[value[first[u] : first[u + 1]]] = False
            linked = some[100 * common >= rule.percent * (n[some] + n[u] - common)]
            merged, at = np.unique(label[linked], return_index=True)
            found += [(u, int(v)) for v in linked[at]]
            label[np.isin(label, merged)] = label[u]
        a, b = (pa.array([x[k] for x in found], pa.int64()) for k in (0, 1))
        return pa.table({"a": rep.take(a), "b": rep.take(b)})

    return rows.groupBy("path", "one", "two").applyInArrow(run, links)


def rep_codes(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each distinct value."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)


def _pairs(active: DataFrame, large, rule: Join) -> DataFrame:
    """Distinct pairs a < b of unconnected classes whose sizes allow a link: all of small nodes, those with pivots of large."""
    side = ["rep", "n", "component"]
    small = active.filter(~large).select("path", *side)
    two = small.select("path", *[F.col(c).alias(f"{c}2") for c in side])
    within = small.join(two, "path").filter("rep < rep2")
    star = active.filter(large).select(*side, F.explode("pivots").alias("pivot"))
    star = star.select(*side, *[F.col(f"pivot.{c}").alias(f"{c}2") for c in side]).filter("rep <> rep2")
    both = within.select(*star.columns).unionAll(star).filter("component <> component2")
    possible = both.filter(100 * F.least("n", "n2") >= rule.percent * F.greatest("n", "n2"))
    return possible.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def keep_one(docs: DataFrame, rule: Join | None = None) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group, with all columns; rows that repeat in full stay once."""
    kept = near_duplicates(docs, rule).filter("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi").dropDuplicates()
