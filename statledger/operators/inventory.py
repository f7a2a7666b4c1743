"""Inventory rows (one per known file) to targets and sample files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.functions.text import clean_none_like, is_none_like, object_suffix, slugify
from statledger.functions.urls import url_extension


def _prepared(rows: DataFrame) -> DataFrame:
    trimmed = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in ("dataset_name", "parent_link", "sub_link", "sub_collection", "target_file", "note")}
    named = rows.withColumns(trimmed).filter(F.col("dataset_name") != "")
    return named.withColumn("sub_dataset_id", clean_none_like(F.col("sub_collection")))


def inventory_samples(rows: DataFrame) -> DataFrame:
    """Distinct example files per (dataset, sub-dataset): file_url, first position ``seq``, note of that row.

    Flat on purpose: a target with very many files is many rows, not one array.
    """
    listed = _prepared(rows).filter(~is_none_like(F.col("target_file")))
    return listed.groupBy("dataset_name", "sub_dataset_id", F.col("target_file").alias("file_url")).agg(
        F.min("seq").alias("seq"), F.min_by("note", "seq").alias("notes")
    )


def agg_inventory_rollup(rows: DataFrame) -> DataFrame:
    """One row per target: ids, entry and sub-page URLs (first stated), number of example files, their extensions.

    Datasets without an entry URL and targets without an example file are left out.
    """
    prepared = _prepared(rows)

    def first_stated(column: str):
        return F.min_by(F.col(column), F.when(~is_none_like(F.col(column)), F.col("seq")))

    keys = ["dataset_name", "sub_dataset_id"]
    entry = prepared.filter(~is_none_like(F.col("parent_link"))).groupBy("dataset_name").agg(first_stated("parent_link").alias("entry_url"))
    subpages = prepared.filter(~is_none_like(F.col("sub_link"))).groupBy(*keys).agg(first_stated("sub_link").alias("sample_subpage_url"))
    samples = inventory_samples(rows).withColumn("extension", url_extension(F.col("file_url")))
    # Counted per extension first: the set collected per target holds extensions, not files.
    extensions = samples.groupBy(*keys, "extension").agg(F.count("*").alias("files"))
    targets = extensions.groupBy(*keys).agg(
        F.sum("files").alias("sample_count"),
        F.sort_array(F.collect_set(F.nullif(F.col("extension"), F.lit("")))).alias("include_extensions"),
    )
    slug = slugify(F.col("dataset_name"))
    return (
        targets.join(entry, "dataset_name")
        .join(subpages, keys, "left")
        .select(
            slug.alias("dataset_id"),
            "dataset_name",
            "entry_url",
            "sub_dataset_id",
            object_suffix(slug, F.col("sub_dataset_id")).alias("object_name_suffix"),
            F.concat(slug, F.lit("/"), F.col("sub_dataset_id")).alias("path_prefix"),
            F.coalesce("sample_subpage_url", F.lit("")).alias("sample_subpage_url"),
            "sample_count",
            "include_extensions",
        )
    )
