"""Fixed table and document layouts, as data."""

from __future__ import annotations

from pyspark.sql import types as T

CONTRACT_VERSION_COLUMN = "_CONTRACT_VERSION"


def _fields(names: list[str], types: dict[str, T.DataType] | None = None) -> list[T.StructField]:
    types = types or {}
    return [T.StructField(name, types.get(name, T.StringType())) for name in names]


# Metadata columns in front of every ingest table, in table order.
INGEST_COLUMNS = [
    "_INGESTED_AT",
    "_SOURCE_FILE_PATH",
    "_SOURCE_FILE_NAME",
    "_FILE_ROW_NUMBER",
    "_FILE_CONTENT_KEY",
    "_ACQUISITION_METHOD",
    "_FALLBACK_REASON",
    "_LOAD_ID",
]

# Columns of the per-file metadata table, in table order.
SIDECAR_COLUMNS = [
    "_CONTRACT_VERSION",
    "_DOWNLOADED_AT",
    "_INGESTED_AT",
    "_SOURCE_FILE_PATH",
    "_SOURCE_FILE_NAME",
    "_FILE_CONTENT_KEY",
    "_SUBJECT_PERIOD_FROM",
    "_SUBJECT_PERIOD_TO",
    "_SUBJECT_PERIOD_COVERAGE_TYPE",
    "_SUBJECT_PERIOD_INFERENCE_METHOD",
    "_SUBJECT_PERIOD_INFERENCE_SOURCE",
    "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE",
    "_FILE_SCOPE_DURATION_TYPE",
    "_FILE_SCOPE_DURATION_VALUE",
    "_FILE_SCOPE_DURATION_UNIT",
    "_FILE_SCOPE_FISCAL_YEAR_START_MONTH",
    "_BREAKDOWN_GRANULARITY",
    "_PUBLICATION_DATE",
    "_PUBLICATION_DATE_SOURCE",
    "_ACQUISITION_METHOD",
    "_FALLBACK_REASON",
    "_LOAD_ID",
    "_SERIES_ID",
    "_SUB_DATASET_ID",
    "_TARGET_PATH",
    "_PAYLOAD_STAGE_PATH",
    "_SOURCE_ETAG",
    "_SOURCE_LAST_MODIFIED",
]
SIDECAR_LONG_COLUMNS = ["_FILE_SCOPE_DURATION_VALUE", "_FILE_SCOPE_FISCAL_YEAR_START_MONTH"]

# Sidecar columns carried into the deduplicated view and what replaces NULL (None: keep NULL).
SIDECAR_VIEW_DEFAULTS: dict[str, str | None] = {
    "_DOWNLOADED_AT": "",
    "_SUBJECT_PERIOD_FROM": "",
    "_SUBJECT_PERIOD_TO": "",
    "_SUBJECT_PERIOD_COVERAGE_TYPE": "unknown",
    "_SUBJECT_PERIOD_INFERENCE_METHOD": "not_inferred",
    "_SUBJECT_PERIOD_INFERENCE_SOURCE": "none",
    "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE": "low",
    "_FILE_SCOPE_DURATION_TYPE": "unknown",
    "_FILE_SCOPE_DURATION_VALUE": None,
    "_FILE_SCOPE_DURATION_UNIT": "",
    "_FILE_SCOPE_FISCAL_YEAR_START_MONTH": None,
    "_BREAKDOWN_GRANULARITY": "",
    "_PUBLICATION_DATE": "",
    "_PUBLICATION_DATE_SOURCE": "unknown",
}

# Metadata names that presentation aliasing and column profiles leave alone: the ingest columns, the sidecar
# columns of the deduplicated view and the contract version.
METADATA_COLUMNS = frozenset(INGEST_COLUMNS) | frozenset(SIDECAR_VIEW_DEFAULTS) | {CONTRACT_VERSION_COLUMN}

# Columns of the run-event table, in table order.
EVENT_COLUMNS = [
    "EVENT_TIMESTAMP_UTC",
    "RUN_ID",
    "CONTRACT_VERSION",
    "STAGE",
    "STATUS",
    "ATTEMPT_NUMBER",
    "SERIES_ID",
    "SUB_DATASET_ID",
    "SOURCE_URL",
    "FILE_NAME",
    "SOURCE_CONTENT_HASH",
    "LOAD_ID",
    "SOURCE_BYTES",
    "RAW_ROW_COUNT",
    "NORMALIZED_ROW_COUNT",
    "NORMALIZED_BYTES",
    "UPLOADED_PATH",
    "SKIP_REASON",
    "ACQUISITION_METHOD",
    "DURATION_MS",
    "ERROR_TYPE",
    "ERROR_MESSAGE",
    "DISCOVERED_FILE_COUNT",
]
EVENT_LONG_COLUMNS = [
    "ATTEMPT_NUMBER",
    "SOURCE_BYTES",
    "RAW_ROW_COUNT",
    "NORMALIZED_ROW_COUNT",
    "NORMALIZED_BYTES",
    "DURATION_MS",
    "DISCOVERED_FILE_COUNT",
]
EVENT_NOT_NULL_COLUMNS = ["RUN_ID", "STAGE", "STATUS", "ATTEMPT_NUMBER"]

INGEST_SCHEMA = T.StructType(
    _fields(INGEST_COLUMNS, {"_INGESTED_AT": T.TimestampType(), "_FILE_ROW_NUMBER": T.LongType()})
)
SIDECAR_SCHEMA = T.StructType(_fields(SIDECAR_COLUMNS, {c: T.LongType() for c in SIDECAR_LONG_COLUMNS}))

_FILE_SCOPE_SCHEMA = T.StructType(
    [
        T.StructField("duration_type", T.StringType()),
        T.StructField("duration_value", T.LongType()),
        T.StructField("duration_unit", T.StringType()),
        T.StructField("fiscal_year_start_month", T.LongType()),
    ]
)
# The document keeps every flat value as text and adds the nested coverage block.
SIDECAR_DOCUMENT_SCHEMA = T.StructType(
    _fields(SIDECAR_COLUMNS)
    + [
        T.StructField(
            "period_coverage",
            T.StructType(
                [
                    T.StructField("file_scope", _FILE_SCOPE_SCHEMA),
                    T.StructField("breakdown_granularity", T.ArrayType(T.StringType())),
                ]
            ),
        )
    ]
)
# Event lines carry lower-case keys; values are read as text and cast with ``try_cast``.
EVENT_LINE_SCHEMA = T.StructType(_fields([name.lower() for name in EVENT_COLUMNS]))
EVENT_SCHEMA = T.StructType(
    _fields(
        EVENT_COLUMNS,
        {"EVENT_TIMESTAMP_UTC": T.TimestampType(), **{c: T.LongType() for c in EVENT_LONG_COLUMNS}},
    )
)
