"""Writers: landing partitions, metadata documents, run events, ingest tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statledger.functions.dates import MIN_PLAUSIBLE_PUBLICATION, plausible_publication, publication_source_flag
from statledger.functions.paths import load_id, partition_values, stage_relative_path
from statledger.operators.telemetry import type_events
from statledger.schemas import SIDECAR_COLUMNS

#: Lines of one file of a metadata dataset.
RECORDS_PER_FILE = 250_000


def sink_landing_partitions(df: DataFrame, path: str, downloaded_at: str = "downloaded_at", format: str = "csv") -> None:
    """Write below ``download_year=/download_month=/downloaded_at=``; rows of one partition are brought together by key
    and spread over as many tasks as adaptive execution finds useful, so a large partition is several files."""
    year, month, safe = partition_values(F.col(downloaded_at))
    parts = {"download_year": year, "download_month": month, "downloaded_at": safe}
    writer = df.withColumns(parts).hint("rebalance", *parts).write.mode("append").partitionBy(*parts)
    (writer.option("header", True).option("escape", '"') if format == "csv" else writer).format(format).save(path)


def _size(df: DataFrame) -> Column:
    """Bytes of a row as delimited text: its fields, a separator or line end behind each."""
    fields = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    return reduce(lambda a, b: a + b, fields) + len(fields)


def write_counted(raw: DataFrame, normalize: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write ``normalize(raw)`` and count rows and bytes on both sides while that is done: no second pass.

    The counts are those of Spark's observations of the one job that ``write`` runs, complete when it has ended.
    """
    before, after = Observation(), Observation()
    rows = F.count(F.lit(1))
    source = raw.observe(before, rows.alias("raw_row_count"), F.coalesce(F.sum(_size(raw)), F.lit(0)).alias("source_bytes"))
    tidy = normalize(source)
    write(tidy.observe(after, rows.alias("normalized_row_count"), F.coalesce(F.sum(_size(tidy)), F.lit(0)).alias("normalized_bytes")))
    return {**before.get, **after.get}


def upload_event(spark: SparkSession, counts: Mapping[str, int], at: str, **values: str) -> DataFrame:
    """One successful upload as a row of the event table: what :func:`write_counted` counted, and other columns by name."""
    told = {"event_timestamp_utc": at, "stage": "UPLOAD", "status": "SUCCEEDED", "attempt_number": "1", **values, **{k: str(v) for k, v in counts.items()}}
    return type_events(spark.createDataFrame([tuple(told.values())], ", ".join(f"{k} string" for k in told)))


def join_array_text(values: Column) -> Column:
    """``a,b,c`` of an array."""
    return F.concat_ws(",", values)


def sidecar_records(
    files: DataFrame, contract_version: str = "1.0", minimum_publication: str = MIN_PLAUSIBLE_PUBLICATION
) -> DataFrame:
    """Metadata documents of files about to land.

    ``files``: source_url, target_path, path_prefix, content_hash, publication_date, downloaded_at, ingested_at,
    series_id, sub_dataset_id, acquisition_method, fallback_reason, the six coverage columns, duration_type,
    duration_value, duration_unit, fiscal_year_start_month, breakdown_granularity (array), etag, last_modified.
    """
    publication = plausible_publication(F.col("publication_date"), minimum_publication)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    scope = F.struct(
        F.col("duration_type"),
        F.col("duration_value").cast("long").alias("duration_value"),
        F.col("duration_unit"),
        F.col("fiscal_year_start_month").cast("long").alias("fiscal_year_start_month"),
    )
    values = {
        "_CONTRACT_VERSION": F.lit(contract_version),
        "_DOWNLOADED_AT": F.col("downloaded_at"),
        "_INGESTED_AT": F.col("ingested_at"),
        "_SOURCE_FILE_PATH": F.col("source_url"),
        "_SOURCE_FILE_NAME": F.element_at(F.split("target_path", "/"), -1),
        "_FILE_CONTENT_KEY": F.col("content_hash"),
        "_FILE_SCOPE_DURATION_TYPE": F.col("duration_type"),
        "_FILE_SCOPE_DURATION_VALUE": text("duration_value"),
        "_FILE_SCOPE_DURATION_UNIT": text("duration_unit"),
        "_FILE_SCOPE_FISCAL_YEAR_START_MONTH": text("fiscal_year_start_month"),
        "_BREAKDOWN_GRANULARITY": join_array_text(F.col("breakdown_granularity")),
        "_PUBLICATION_DATE": publication,
        "_PUBLICATION_DATE_SOURCE": publication_source_flag(publication),
        "_ACQUISITION_METHOD": F.col("acquisition_method"),
        "_FALLBACK_REASON": F.col("fallback_reason"),
        "_LOAD_ID": load_id(F.col("content_hash")),
        "_SERIES_ID": F.col("series_id"),
        "_SUB_DATASET_ID": F.col("sub_dataset_id"),
        "_TARGET_PATH": F.col("target_path"),
        "_PAYLOAD_STAGE_PATH": stage_relative_path(F.col("target_path"), F.col("path_prefix")),
        "_SOURCE_ETAG": F.nullif(F.col("etag"), F.lit("")),
        "_SOURCE_LAST_MODIFIED": F.nullif(F.col("last_modified"), F.lit("")),
    }
    coverage = F.struct(scope.alias("file_scope"), F.col("breakdown_granularity")).alias("period_coverage")
    return files.select(*[values.get(c, F.col(c)).alias(c) for c in SIDECAR_COLUMNS], coverage)


def sink_sidecar(records: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON line per landed file in a metadata dataset (whose name must not start with ``_``).

    The lines repeat their keys and most of their text, so they are gzipped; a gzipped file is read by one task, so none
    has more than ``RECORDS_PER_FILE`` lines.
    """
    records.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).json(path)


def sink_telemetry(events: DataFrame, path: str) -> None:
    """Event lines below ``event_date=YYYYMMDD/run_id=…``; keys are lower case, absent values are not written."""
    lower = events.select(*[F.col(c).alias(c.lower()) for c in events.columns])
    dated = lower.withColumn("event_date", F.date_format("event_timestamp_utc", "yyyyMMdd")).withColumn("run", F.col("run_id"))
    # The run id is both a key of the line and a folder.
    line = F.to_json(F.struct(*[F.col(c) for c in lower.columns])).alias("value")
    dated.select(line, "event_date", F.col("run").alias("run_id")).write.mode("append").partitionBy("event_date", "run_id").text(path)


def sink_ingest_append(df: DataFrame, path: str) -> None:
    """Append to an ingest table; the first append creates it."""
    df.write.mode("append").parquet(path)


def sink_metadata_reload(df: DataFrame, path: str) -> None:
    """Replace a metadata table as a whole."""
    df.write.mode("overwrite").parquet(path)
