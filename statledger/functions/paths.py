"""File identity: landing paths, content hashes, load ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOAD_ID_LENGTH = 16


def partition_values(downloaded_at: Column) -> tuple[Column, Column, Column]:
    """(year, month, safe timestamp) of the landing path; too short a timestamp gives ``unknown``."""
    safe = F.translate(F.trim(downloaded_at), " /:", "--")
    year = F.when(F.length(safe) >= 4, F.substring(safe, 1, 4)).otherwise("unknown")
    month = F.when(F.length(safe) >= 6, F.substring(safe, 5, 2)).otherwise("unknown")
    return year, month, safe


def landing_path(prefix: Column, downloaded_at: Column, file_name: Column) -> Column:
    """``<prefix>/download_year=…/download_month=…/downloaded_at=…/<file>``."""
    year, month, safe = partition_values(downloaded_at)
    return F.concat(
        prefix, F.lit("/download_year="), year, F.lit("/download_month="), month,
        F.lit("/downloaded_at="), safe, F.lit("/"), file_name,
    )


def stage_relative_path(target_path: Column, prefix: Column) -> Column:
    """Target path without the first occurrence of ``prefix/``."""
    needle = F.concat(prefix, F.lit("/"))
    at = F.position(needle, target_path)
    before = F.substr(target_path, F.lit(1), at - 1)
    after = F.substr(target_path, at + F.length(needle))
    return F.when(at > 0, F.concat(before, after)).otherwise(target_path)


def content_hash(content: Column) -> Column:
    """SHA-256 hex of the bytes."""
    return F.sha2(content, 256)


def load_id(content_key: Column) -> Column:
    """First 16 characters of the content hash."""
    return F.substring(content_key, 1, LOAD_ID_LENGTH)


def series_parts(relative_path: Column) -> tuple[Column, Column]:
    """(series, sub-dataset) = first two directories of a path below the landing root."""
    parts = F.split(F.trim(relative_path, F.lit("/")), "/")
    known = F.size(parts) >= 2
    return (
        F.when(known, F.get(parts, F.lit(0))).otherwise("unknown"),
        F.when(known, F.get(parts, F.lit(1))).otherwise("unknown"),
    )
