"""Run events as a typed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.schemas import EVENT_COLUMNS, EVENT_LONG_COLUMNS


def safe_cast(column: Column, type_name: str) -> Column:
    """The value as ``type_name``; NULL where it is not one."""
    return column.try_cast(type_name)


def blank_to_null_long(column: Column) -> Column:
    """Blank text to NULL, then a 64-bit integer."""
    return F.nullif(column.cast("string"), F.lit("")).try_cast("long")


def type_events(lines: DataFrame) -> DataFrame:
    """Lower-case text columns of event lines to the typed upper-case event table; missing keys read NULL."""
    present = {c.lower(): c for c in lines.columns}

    def typed(name: str) -> Column:
        source = F.col(present[name.lower()]) if name.lower() in present else F.lit(None).cast("string")
        if name == "EVENT_TIMESTAMP_UTC":
            return source.try_cast("timestamp").alias(name)
        return (source.try_cast("long") if name in EVENT_LONG_COLUMNS else source).alias(name)

    return lines.select(*[typed(name) for name in EVENT_COLUMNS])


def telemetry_staging(events: DataFrame) -> DataFrame:
    """The event table's columns in order."""
    return events.select(*EVENT_COLUMNS)


def json_get_path(document: Column, path: str, type_name: str = "string") -> Column:
    """``$.path`` of a JSON text as a type; NULL where missing or not castable."""
    return F.get_json_object(document, path).try_cast(type_name)
