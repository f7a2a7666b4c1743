"""File streams into ingest, sidecar and event tables.

Each run takes what is new (``availableNow``) and ends, which is the daily schedule; left running with a
processing-time trigger the same queries are the continuous pipes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statledger.operators.telemetry import type_events
from statledger.schemas import EVENT_LINE_SCHEMA, SIDECAR_DOCUMENT_SCHEMA
from statledger.sources.files import (
    CORRUPT,
    FILE_PATH,
    load_metadata_columns,
    scan_csv_strings,
    sidecar_table,
)
from statledger.sources.versions import Store


def stream_files(spark: SparkSession, root: str, pattern: str = "*.csv", max_files: int = 10_000) -> DataFrame:
    """Paths of files as they land below ``root``, at most ``max_files`` a batch; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(root)
        .select("path")
    )


def run_available(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query to finish what is there."""
    query.awaitTermination()


def start_batches(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], once: bool = True) -> StreamingQuery:
    """Start a micro-batch query that hands every batch to ``write``."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stream_ingest_csv(
    spark: SparkSession,
    root: str,
    columns: Sequence[str],
    sidecar: Callable[[], DataFrame],
    out: str,
    checkpoint: str,
    multi_line: bool = False,
    once: bool = True,
) -> StreamingQuery:
    """Pick up landed files and append their rows, with metadata, to the ingest table at ``out``.

    The reader is that of the batch: columns are mapped by each file's own header, ``columns`` come first and others
    follow, so that the table's schema evolves. A batch overwrites its own folder, so a batch repeated after a failure
    does not load twice. Rejected records go to ``<out>_rejected``. ``sidecar`` is called per batch: metadata lands
    together with the files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]  # at most maxFilesPerTrigger
        if not paths:
            return
        rows = scan_csv_strings(spark, paths, columns, multi_line=multi_line, positions=True, corrupt=True)
        # Rejected records keep their place in the row numbering, as they do in the file.
        loaded = load_metadata_columns(rows, sidecar(), root)
        loaded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        rejected = rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(FILE_PATH).alias("file_path"), F.col(CORRUPT).alias("record"))
        rejected.write.mode("overwrite").parquet(f"{out}_rejected/batch={batch_id}")

    return start_batches(stream_files(spark, root), checkpoint, write, once)


def stream_ingest_table(
    spark: SparkSession, root: str, columns: Sequence[str], sidecar: Callable[[], DataFrame], store: Store, table: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """The same into a table of ``store``: a batch's rows, and those it rejects (``<table>_REJECTED``), become visible
    together, and the table's columns are kept in its document, so that reading it merges no footers. A batch that was
    committed before a failure is told by its checkpoint and number and not loaded twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [row.path for row in batch.collect()]  # at most maxFilesPerTrigger
        change = store.change()
        done = change.tables.get(table, {}).get("batches", {})
        if not paths or done.get(checkpoint, -1) >= batch_id:
            return
        rows = scan_csv_strings(spark, paths, columns, positions=True, corrupt=True)
        loaded = load_metadata_columns(rows, sidecar(), root)
        change.append(table, loaded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))
        change.append(f"{table}_REJECTED", rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(FILE_PATH).alias("file_path"), F.col(CORRUPT).alias("record")))
        change.tables[table]["batches"] = done | {checkpoint: batch_id}
        change.commit(batch=str(batch_id))

    return start_batches(stream_files(spark, root), checkpoint, write, once)


def read_ingest(spark: SparkSession, out: str) -> DataFrame:
    """The ingest table a stream has written so far, with every column any of its files had."""
    return spark.read.option("mergeSchema", True).parquet(out).drop("batch")


def _append_parquet(stream: DataFrame, out: str, checkpoint: str, once: bool) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stream_ingest_sidecar(
    spark: SparkSession, root: str, out: str, checkpoint: str, once: bool = True, document_per_file: bool = False
) -> StreamingQuery:
    """Metadata documents to the sidecar table; the file sink's log makes it exactly once."""
    documents = (
        spark.readStream.schema(SIDECAR_DOCUMENT_SCHEMA)
        .option("multiLine", document_per_file)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .json(root)
    )
    return _append_parquet(sidecar_table(documents), out, checkpoint, once)


def stream_ingest_telemetry(spark: SparkSession, root: str, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Event lines to the event table."""
    lines = spark.readStream.schema(EVENT_LINE_SCHEMA).option("recursiveFileLookup", True).json(root)
    return _append_parquet(type_events(lines), out, checkpoint, once)


def stream_first_seen(stream: DataFrame, keys: Sequence[str] = ("_FILE_CONTENT_KEY", "_FILE_ROW_NUMBER")) -> DataFrame:
    """Keyed streaming deduplication. It keeps the FIRST load of a row, unlike the RAW view, which keeps the latest;
    its state grows with the keys, so the view over the appended table is the default."""
    return stream.dropDuplicates(list(keys))
