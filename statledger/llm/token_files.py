"""Token-id files: every document's ids in ascending order of doc_id, written by a context-mixing range coder.

Format. A Parquet table whose rows are segments: part and segment (their order is the order of documents), doc_ids and
n_tokens of whole documents, and ids, the frames of :mod:`range_coder`. A segment can be read by itself.

Texts are range-partitioned by doc_id and sorted within partitions, the one shuffle. Each task tokenises and codes its
range a segment at a time; a segment ends with the document that reaches ``SEGMENT_IDS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm import range_coder
from statledger.llm.textarrays import slices
from statledger.llm.vocabularies import vocabulary

SEGMENT_IDS = 4_000_000
BATCH_BYTES = 8 << 20


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, segment_ids: int = SEGMENT_IDS
) -> None:
    """Write doc_id and text of ``docs`` to ``path``.

    Null and empty texts are the end id alone. A null doc_id comes first. Rows of one doc_id are written one after
    another. Other columns are ignored. An empty table gives an empty table of segments. A corrupt file is told by the
    checksum of its block when it is read.
    """
    source = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("segment", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
            T.StructField("n_tokens", T.ArrayType(T.LongType())),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        encoder = vocabulary(tokenizer_path)
        part, segment = TaskContext.get().partitionId(), 0
        names, sizes, held, total = [], [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            held.clear()
            coded = range_coder.encode(ids)
            columns = [[part], [segment], [pa.concat_arrays(names).to_pylist()], [np.concatenate(sizes)], [coded]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in slices(batches, max_bytes=BATCH_BYTES):
            ids, offsets = encoder.encode(batch.column("text"))
            count = batch.num_rows
            ended = np.full(len(ids) + count, end_id, dtype=np.uint32)
            ended[np.arange(len(ids)) + np.repeat(np.arange(count), np.diff(offsets))] = ids
            begins = offsets + np.arange(count + 1)
            first = 0
            while first < count:
                # The first document that reaches the segment's size, or the batch's last.
                last = min(int(np.searchsorted(begins[1:], begins[first] + segment_ids - total, "left")), count - 1) + 1
                names.append(batch.column("doc_id").slice(first, last - first))
                sizes.append(np.diff(begins[first : last + 1]))
                held.append(ended[begins[first] : begins[last]])
                total += len(held[-1])
                first = last
                if total >= segment_ids:
                    yield closed()
                    segment += 1
                    names, sizes, held, total = [], [], [], 0
        if total:
            yield closed()

    source.mapInArrow(run, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit)."""
    files = spark.read.parquet(path)
    sizes = files.select("part", "segment", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("size"))
    # One row per part meets in one task, then one per segment of a part.
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.withColumn("in_part", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(parts, "part")
        .select("part", "segment", (F.col("before") + F.col("in_part")).alias("first"))
    )
    key = files.schema["doc_ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("segment", T.LongType()),
            T.StructField("doc_id", key),
            T.StructField("at", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, segment = batch.column("part")[row].as_py(), batch.column("segment")[row].as_py()
                names = batch.column("doc_ids")[row].values
                sizes = batch.column("n_tokens")[row].values.to_numpy()
                ids = range_coder.decode(batch.column("ids")[row].as_py())
                ends = np.concatenate([[0], np.cumsum(sizes)])
                if ends[-1] != len(ids):
                    raise range_coder.CorruptBlock(f"segment {segment} of part {part} has {len(ids)} ids, not {ends[-1]}")
                texts = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(names), [None, pa.py_buffer(ends.astype(np.int64) * 4), pa.py_buffer(ids.tobytes())]
                )
                same = [pa.array(np.full(len(names), x), pa.int64()) for x in (part, segment)]
                arrays = [*same, names, pa.array(ends[:-1], pa.int64()), pa.array(sizes, pa.int64()), texts.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    rows = files.select("part", "segment", "doc_ids", "n_tokens", "ids").mapInArrow(run, schema)
    # Three numbers for each segment go to the executors; the ids stay where they are read.
    return rows.join(F.broadcast(starts), ["part", "segment"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")
