"""Scheduled runs into a store: what is new lands with its metadata and events, all of it or nothing.

Also the RAW table kept up to date: only the latest load of every file row, merged batch by batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.functions.paths import load_id
from statledger.operators import revisions
from statledger.operators.changes import anti_unchanged_headers, latest_sidecar_record
from statledger.operators.telemetry import type_events
from statledger.schemas import EVENT_SCHEMA, SIDECAR_SCHEMA
from statledger.session import scratch_path
from statledger.sources.files import sidecar_table
from statledger.sources.sinks import sidecar_records
from statledger.sources.versions import COMPRESSION, Change, Store

LANDING, SIDECAR, EVENTS, RAW = "LANDING", "INGEST_METADATA", "EVENTS", "RAW"
FILE = ["source_url", "file_name"]
#: Rows of one file that lie in one bucket of the RAW table; the next ones lie in the next.
ROWS_PER_BUCKET = 1_000_000


def _table(store: Store, name: str, schema) -> DataFrame:
    held = store.contents().get(name)
    return store.read(name) if held else store.spark.createDataFrame([], schema)


def packed_hash(text: Column) -> Column:
    """A hash in half the bytes, for shuffles; text that is no lower-case hex is kept as it is."""
    raw = F.unhex(text)
    same = F.lower(F.hex(raw)).eqNullSafe(text)
    return F.struct(F.when(same, raw).alias("raw"), F.when(~same, text).alias("text"))


def unpacked_hash(packed: Column) -> Column:
    return F.coalesce(F.lower(F.hex(packed["raw"])), packed["text"])


def decide(discovered: DataFrame, sidecar: DataFrame) -> DataFrame:
    """``discovered`` with skip_reason: source_unchanged (its headers are those of the source's last record),
    content_unchanged (its hash is that of the file's last record), or NULL for what is to land.

    Files are judged by their names, headers and hashes alone. The verdicts on files with new headers are written to the
    shared folder, so that whole rows are shuffled once to take them up, and not at all where they are few.
    A row whose file is NULL is source_unchanged; rows that share a file are joined with each other's verdicts.
    """
    content = discovered.select(*FILE, "etag", "last_modified", packed_hash(F.col("content_hash")).alias("__hash"))
    fetched = anti_unchanged_headers(content, sidecar).select(*FILE, "__hash")
    held = latest_sidecar_record(sidecar, by_file_name=True).select(
        F.col("_SOURCE_FILE_PATH").alias("source_url"), F.col("_SOURCE_FILE_NAME").alias("file_name"), packed_hash(F.col("_FILE_CONTENT_KEY")).alias("__held")
    )
    same = [F.col(f"__hash.{f}") == F.col(f"__held.{f}") for f in ("raw", "text")]
    new = ~F.coalesce(*same, F.lit(False))
    verdicts = fetched.join(held, FILE, "left").groupBy(*FILE).agg(F.count("*").alias("__fetched"), F.count_if(new).alias("__new"))
    path = scratch_path(discovered.sparkSession, "verdicts")
    verdicts.write.option("compression", COMPRESSION).parquet(path)
    verdicts = discovered.sparkSession.read.schema(verdicts.schema).parquet(path)
    rows = discovered.withColumn("content_hash", packed_hash(F.col("content_hash"))).join(verdicts, FILE, "left")
    rows = rows.withColumn("content_hash", unpacked_hash(F.col("content_hash"))).select(*discovered.columns, "__fetched", "__new")
    reason = F.when(F.col("__fetched").isNull(), "source_unchanged").when(F.col("__new") == 0, "content_unchanged")
    times = F.coalesce(F.col("__fetched") * F.greatest("__new", F.lit(1)), F.lit(1)).cast("int")
    return rows.withColumn("skip_reason", reason).withColumn("__time", F.explode(F.sequence(F.lit(1), times))).drop("__fetched", "__new", "__time")


def scheduled_run(store: Store, discovered: DataFrame, rows: DataFrame, run_id: str, at: str, minimum_publication: str | None = None) -> int | None:
    """Land what is new of ``discovered``; returns the version that shows it, or None if this run was committed before.

    ``discovered``: one row per (source_url, file_name) with the columns of :func:`sidecar_records` but ingested_at,
    which is ``at``. ``rows``: the payload of the files, with source_url and file_name; only that of files that land is
    kept. Rows, metadata records and one event per file (with the rows counted as they were written) become visible
    together. A run that ends on the way leaves nothing visible, and is run again under the same ``run_id``.
    """
    spark = store.spark
    if not _table(store, EVENTS, EVENT_SCHEMA).filter(F.col("RUN_ID") == run_id).isEmpty():
        return None
    change = store.change()
    # One row per file, needed several times below.
    path = scratch_path(spark, "decided")
    decide(discovered, _table(store, SIDECAR, SIDECAR_SCHEMA)).write.option("compression", COMPRESSION).parquet(path)
    decided = spark.read.parquet(path)
    own = F.col("skip_reason").isNull()
    new = decided.filter(own).withColumn("ingested_at", F.lit(at))
    key = F.col("content_hash")
    files = new.select(*FILE, F.col("target_path").alias("_SOURCE_FILE_PATH"), packed_hash(key).alias("_FILE_CONTENT_KEY"))
    if new.isEmpty():
        # Nothing lands: the payload need not be moved.
        files = files.limit(0)
    payload = rows.join(files, FILE).withColumn("_FILE_CONTENT_KEY", unpacked_hash(F.col("_FILE_CONTENT_KEY")))
    landed = change.append(LANDING, payload.withColumns({"_LOAD_ID": load_id(F.col("_FILE_CONTENT_KEY")), "_INGESTED_AT": F.lit(at)}))
    records = sidecar_records(new, **({"minimum_publication": minimum_publication} if minimum_publication else {}))
    change.append(SIDECAR, sidecar_table(records))
    counted = landed.groupBy(*FILE).agg(F.count("*").alias("n"))
    told = decided.select(*FILE, "series_id", "sub_dataset_id", "content_hash", "target_path", "skip_reason")
    # Only files that land have rows to be counted.
    counts = told.filter(own).withColumn("content_hash", packed_hash(key)).join(counted, FILE, "left")
    counts = counts.withColumn("content_hash", unpacked_hash(key))
    told = counts.unionByName(told.filter(~own).withColumn("n", F.lit(None).cast("long")))
    change.append(EVENTS, type_events(told.select(
        F.lit(at).alias("event_timestamp_utc"),
        F.lit(run_id).alias("run_id"),
        F.when(F.col("skip_reason") == "source_unchanged", "DOWNLOAD").otherwise("UPLOAD").alias("stage"),
        F.when(own, "SUCCEEDED").otherwise("SKIPPED").alias("status"),
        F.lit("1").alias("attempt_number"),
        "series_id",
        "sub_dataset_id",
        *FILE,
        F.col("content_hash").alias("source_content_hash"),
        F.when(own, load_id(key)).alias("load_id"),
        F.when(own, F.coalesce("n", F.lit(0))).alias("normalized_row_count"),
        F.when(own, F.col("target_path")).alias("uploaded_path"),
        "skip_reason",
    )))
    return change.commit(run_id=run_id)


def merge_loads(change: Change, loaded: DataFrame, table: str = RAW, buckets: int = 64) -> list[int]:
    """Merge loaded rows into the RAW table, of which only the latest load of a file row stays; returns the buckets that
    were read and written. Repeated and late loads may come in any order.

    A file's rows begin in the bucket of its content key and go on to the next every ``ROWS_PER_BUCKET``, so a batch of
    a few files touches few buckets, and a file of any size none above its share.
    """
    step = F.floor(F.coalesce(F.col("_FILE_ROW_NUMBER"), F.lit(0)) / ROWS_PER_BUCKET)
    by = F.pmod(F.xxhash64("_FILE_CONTENT_KEY"), F.lit(1 << 40)) + step
    return change.merge_latest(table, loaded, revisions.ROW_KEYS, revisions.latest_load_order(), by, buckets)


def current_raw(store: Store, sidecar: DataFrame, table: str = RAW, view_name: str | None = None) -> DataFrame:
    """The RAW view over the maintained table: nothing is deduplicated when it is read."""
    return revisions.described_view(store.read(table), sidecar, view_name)
