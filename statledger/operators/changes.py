"""What is new: comparisons with the metadata of earlier loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.operators.ordering import first_per_key


def latest_sidecar_record(
    sidecar: DataFrame, by_file_name: bool = False, tiebreak: Sequence[str] = ("_FILE_CONTENT_KEY",)
) -> DataFrame:
    """The record loaded last per source (and file name)."""
    keys = ["_SOURCE_FILE_PATH"] + (["_SOURCE_FILE_NAME"] if by_file_name else [])
    return first_per_key(sidecar, keys, [F.coalesce(F.col("_INGESTED_AT"), F.lit("")).desc(), *[F.col(c).desc() for c in tiebreak]])


def anti_unchanged_headers(
    discovered: DataFrame, sidecar: DataFrame, url: str = "source_url", etag: str = "etag",
    last_modified: str = "last_modified", tiebreak: Sequence[str] = ("_FILE_CONTENT_KEY",),
) -> DataFrame:
    """Files to fetch: not those whose latest record has the same ETag, or the same Last-Modified."""
    latest = latest_sidecar_record(sidecar, tiebreak=tiebreak).select(
        F.col("_SOURCE_FILE_PATH").alias("__url"), F.col("_SOURCE_ETAG").alias("__etag"),
        F.col("_SOURCE_LAST_MODIFIED").alias("__modified"),
    )

    def same(now: str, before: str):
        return F.coalesce((F.col(now) != "") & (F.col(now) == F.col(before)), F.lit(False))

    return (
        discovered.join(latest, F.col(url) == F.col("__url"), "left")
        .filter(~(same(etag, "__etag") | same(last_modified, "__modified")))
        .drop("__url", "__etag", "__modified")
    )


def anti_unchanged_content(
    files: DataFrame, sidecar: DataFrame, url: str = "source_url", file_name: str = "file_name",
    content_hash: str = "content_hash", by_file_name: bool = True,
) -> DataFrame:
    """Files to land: not those whose latest record (of source and name, or of the source) has the same hash."""
    latest = latest_sidecar_record(sidecar, by_file_name).select(
        F.col("_SOURCE_FILE_PATH").alias("__url"), F.col("_SOURCE_FILE_NAME").alias("__name"),
        F.col("_FILE_CONTENT_KEY").alias("__hash"),
    )
    same = (F.col(url) == F.col("__url")) & (F.col(content_hash) == F.col("__hash"))
    if by_file_name:
        same = same & (F.col(file_name) == F.col("__name"))
    return files.join(latest, same, "left_anti")


def anti_missing_targets(targets: DataFrame, discovered: DataFrame, key: str = "sub_dataset_id") -> DataFrame:
    """Targets without any discovered file, the ones manual files stand in for."""
    return targets.join(discovered.select(key), key, "left_anti")


def sidecar_index_join(files: DataFrame, sidecar: DataFrame, path: str = "file_path", later: str = "_INGESTED_AT") -> DataFrame:
    """Attach to each file the last sidecar document whose target path is the file's path, slashes trimmed."""
    slash = F.lit("/")
    index = sidecar.withColumn("__target", F.trim(F.col("_TARGET_PATH"), slash)).filter(F.col("__target") != "")
    index = first_per_key(index, ["__target"], [F.col(later).desc_nulls_last(), F.col("_FILE_CONTENT_KEY").desc()])
    return files.join(index, F.trim(F.col(path), slash) == F.col("__target"), "left").drop("__target")


def files_without_sidecar(files: DataFrame, sidecar: DataFrame, path: str = "file_path") -> DataFrame:
    """(path, problem) of files without metadata and of metadata without a file."""
    slash = F.lit("/")
    landed = files.select(F.trim(F.col(path), slash).alias("path")).distinct()
    described = sidecar.select(F.trim(F.col("_TARGET_PATH"), slash).alias("path")).filter(F.col("path") != "").distinct()
    return (
        landed.withColumn("__file", F.lit(True))
        .join(described.withColumn("__sidecar", F.lit(True)), "path", "full")
        .filter(F.col("__file").isNull() | F.col("__sidecar").isNull())
        .select("path", F.when(F.col("__sidecar").isNull(), "file_without_sidecar").otherwise("sidecar_without_file").alias("problem"))
    )
