"""Counts, profiles, parity and drift checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.functions.paths import series_parts
from statledger.operators.shape import union_all_tables
from statledger.schemas import EVENT_NOT_NULL_COLUMNS, METADATA_COLUMNS

# Fixed value: the one RAW table that holds run events instead of published rows.
EVENTS_TABLE = "RAW_FUNCTION_APP_EVENTS"
DRIFT_THRESHOLD = 0.20
#: Parts that a table's headers are dealt over to be compared.
DRIFT_SLICES = 64

LOADED_COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("raw_table_name", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("loaded_row_count", T.LongType()),
    ]
)


def agg_loaded_row_counts(tables: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """Rows per load id in every RAW table (the events table excepted)."""
    counts = {
        name: df.filter(F.col("_LOAD_ID").isNotNull())
        .groupBy(F.col("_LOAD_ID").alias("load_id"))
        .agg(F.count("*").alias("loaded_row_count"))
        .select(F.lit(name).alias("raw_table_name"), "load_id", "loaded_row_count")
        for name, df in sorted(tables.items())
        if name.startswith("RAW_") and name != EVENTS_TABLE
    }
    return union_all_tables(counts, LOADED_COUNTS_SCHEMA, spark)


def agg_tagged_row_counts(rows: DataFrame, table_name: Column) -> DataFrame:
    """The same for rows of many tables in one frame, told apart by ``table_name``: one pass, however many tables."""
    return (
        rows.filter(F.col("_LOAD_ID").isNotNull())
        .groupBy(table_name.alias("raw_table_name"), F.col("_LOAD_ID").alias("load_id"))
        .agg(F.count("*").alias("loaded_row_count"))
    )


def agg_loaded_by_load_id(counts: DataFrame) -> DataFrame:
    return counts.groupBy("load_id").agg(F.sum("loaded_row_count").alias("loaded_row_count"))


def agg_normalize_events(events: DataFrame) -> DataFrame:
    """Row count and time of successful uploads per load and file."""
    keys = ["LOAD_ID", "SERIES_ID", "SUB_DATASET_ID", "SOURCE_URL", "FILE_NAME"]
    uploaded = (F.col("STAGE") == "UPLOAD") & (F.col("STATUS") == "SUCCEEDED") & F.col("LOAD_ID").isNotNull()
    return (
        events.filter(uploaded)
        .groupBy(*[F.col(k).alias(k.lower()) for k in keys])
        .agg(F.max("NORMALIZED_ROW_COUNT").alias("normalized_row_count"), F.max("EVENT_TIMESTAMP_UTC").alias("normalized_at"))
    )


def join_row_parity(normalized: DataFrame, loaded: DataFrame) -> DataFrame:
    """Uploads with the rows loaded under the same load id."""
    return normalized.join(loaded, "load_id", "left")


def row_parity(events: DataFrame, counts: DataFrame) -> DataFrame:
    """Did every uploaded row arrive? NULL where either count is unknown."""
    joined = join_row_parity(agg_normalize_events(events), agg_loaded_by_load_id(counts))
    return joined.select(
        "load_id", "series_id", "sub_dataset_id", "source_url", "file_name", "normalized_row_count", "loaded_row_count",
        (F.col("normalized_row_count") == F.col("loaded_row_count")).alias("row_parity_pass"), "normalized_at",
    )


def check_row_parity_failures(parity: DataFrame) -> DataFrame:
    return parity.filter(~F.col("row_parity_pass"))


def column_profile(df: DataFrame, table_name: str, approximate: bool = False, metadata_columns: Sequence[str] = tuple(METADATA_COLUMNS)) -> DataFrame:
    """Row count, null count, null share and distinct values of every payload column, from one scan.

    Rows become (column, value) pairs that are counted twice: per value, where map tasks already fold repeats of a
    frequent value, and then per column. Wide tables need neither one scan nor one expanded row set per column. With
    ``approximate`` the distinct count is a sketch and there is no shuffle of values at all.
    """
    skipped = {c.upper() for c in metadata_columns}
    columns = [c for c in df.columns if c.upper() not in skipped]
    known = df.sparkSession.createDataFrame(list(enumerate(columns)), "place int, column_name string")
    # Long texts are told apart by their hash, so that they are not shuffled.
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    values = F.array(*[F.when(F.length(t) > 64, F.sha2(t, 256)).otherwise(t) for t in texts])
    pairs = df.select(F.posexplode(values).alias("place", "value"))
    if approximate:
        counted = pairs.groupBy("place").agg(
            F.count("*").alias("row_count"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            F.approx_count_distinct("value").alias("distinct_value_count"),
        )
    else:
        per_value = pairs.groupBy("place", "value").agg(F.count("*").alias("n"))
        counted = per_value.groupBy("place").agg(
            F.sum("n").alias("row_count"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
            F.count("value").alias("distinct_value_count"),
        )
    zero = F.lit(0).cast("long")
    row_count, null_count = F.coalesce("row_count", zero), F.coalesce("null_count", zero)
    return known.join(counted, "place", "left").select(
        F.lit(table_name).alias("raw_table_name"),
        "column_name",
        row_count.alias("row_count"),
        null_count.alias("null_count"),
        F.when(row_count > 0, null_count.cast("double") / row_count).alias("null_pct"),
        F.coalesce("distinct_value_count", zero).alias("distinct_value_count"),
    )


def profile_sketches(rows: DataFrame, by: str = "_LOAD_ID", metadata_columns: Sequence[str] = tuple(METADATA_COLUMNS), lg_size: int = 14) -> DataFrame:
    """(load, column_name, row_count, null_count, sketch): the profile of every load's payload columns, to be stored.

    One pass and one row per load and column; no value is shuffled, only sketches of its distinct values (2^``lg_size``
    registers, a standard error of 0.8 % at 14). Sketches of loads add up, see :func:`profile_of_sketches`.
    """
    skipped = {c.upper() for c in metadata_columns} | {by.upper()}
    columns = [c for c in rows.columns if c.upper() not in skipped]
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.col(f"`{c}`")).alias("known"),
            F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), lg_size).alias("sketch"),
        )
        for c in columns
    ]
    counted = rows.groupBy(F.col(f"`{by}`").alias("load")).agg(F.count("*").alias("row_count"), F.array(*per_column).alias("columns"))
    return counted.select("load", "row_count", F.explode("columns").alias("c")).select(
        "load", "c.column_name", "row_count", (F.col("row_count") - F.col("c.known")).alias("null_count"), "c.sketch"
    )


def profile_of_sketches(sketches: DataFrame, table_name: str) -> DataFrame:
    """The profile of a table as the union of its loads' sketches; columns as in :func:`column_profile`.

    A load that is stored twice counts its rows twice, and its distinct values once.
    """
    whole = sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.hll_union_agg("sketch").alias("sketch")
    )
    return whole.select(
        F.lit(table_name).alias("raw_table_name"),
        "column_name",
        "row_count",
        "null_count",
        F.when(F.col("row_count") > 0, F.col("null_count").cast("double") / F.col("row_count")).alias("null_pct"),
        F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("long")).alias("distinct_value_count"),
    )


def check_profile_bounds(profile: DataFrame) -> DataFrame:
    """Profile rows that cannot be: null share outside [0, 1] or more distinct values than rows."""
    return profile.filter(
        ~F.col("null_pct").between(0, 1) | (F.col("distinct_value_count") > F.col("row_count"))
    )


def check_not_null(df: DataFrame, columns: Sequence[str] = tuple(EVENT_NOT_NULL_COLUMNS)) -> DataFrame:
    """(column_name, failing_rows) of all columns from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failing_rows")


def drift_ratio(known: Column, actual: Column) -> Column:
    """Jaccard distance of two name arrays; 0 if both are empty. Names compare in exact case."""
    either = F.size(F.array_union(known, actual))
    return F.when(either == 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.size(F.array_intersect(known, actual)) / either)


def set_jaccard_drift(headers: DataFrame, known: DataFrame, on: str = "table_name") -> DataFrame:
    """Add known_columns and drift_ratio to headers (table, actual_columns); tables without a known list drop out.

    A table's headers are dealt over ``DRIFT_SLICES`` parts by their contents, and its known list goes to each, so that
    no task reads all headers of a table.
    """
    # Rows are dealt by values that can be hashed, so that a repeated task deals them alike.
    hashed = [F.col(f"`{f.name}`") for f in headers.schema if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]
    dealt = headers.withColumn("__slice", F.pmod(F.xxhash64(*hashed), F.lit(DRIFT_SLICES)))
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DRIFT_SLICES - 1).cast("long")))
    return dealt.join(known.withColumn("__slice", slices), [on, "__slice"], "inner").drop("__slice").withColumn(
        "drift_ratio", drift_ratio(F.col("known_columns"), F.col("actual_columns"))
    )


def drift_warnings(headers: DataFrame, known: DataFrame, threshold: float = DRIFT_THRESHOLD, on: str = "table_name") -> DataFrame:
    """Files whose columns moved more than ``threshold`` from the known list."""
    return set_jaccard_drift(headers, known, on).filter(F.col("drift_ratio") > threshold)


def agg_file_counts(files: DataFrame, path: str = "relative_path") -> DataFrame:
    """CSV files per series and sub-dataset."""
    series, sub_dataset = series_parts(F.col(path))
    return (
        files.filter(F.col(path).endswith(".csv"))
        .groupBy(series.alias("series_id"), sub_dataset.alias("sub_dataset_id"))
        .agg(F.count("*").alias("csv_file_count"))
    )


def agg_distinct_sources(sidecar: DataFrame) -> DataFrame:
    return sidecar.agg(F.count_distinct(F.nullif(F.col("_SOURCE_FILE_PATH"), F.lit(""))).alias("sidecar_source_url_count"))


def agg_status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.filter(F.col(status) != "").groupBy(status).agg(F.count("*").alias("rows"))


def agg_csv_row_count(rows: DataFrame, files: DataFrame, file: str = "file_path") -> DataFrame:
    """Data rows per listed file; a file without rows counts 0."""
    counted = rows.groupBy(file).agg(F.count("*").alias("__rows"))
    return files.select(file).distinct().join(counted, file, "left").select(
        file, F.coalesce("__rows", F.lit(0).cast("long")).alias("row_count")
    )


def agg_stage_metrics(events: DataFrame) -> DataFrame:
    """Events, total and longest duration per run, stage and status."""
    return events.groupBy("RUN_ID", "STAGE", "STATUS").agg(
        F.count("*").alias("event_count"),
        F.sum("DURATION_MS").alias("total_duration_ms"),
        F.max("DURATION_MS").alias("max_duration_ms"),
        F.sum("DISCOVERED_FILE_COUNT").alias("discovered_file_count"),
    )


def agg_load_failures(failures: DataFrame) -> DataFrame:
    """How many files failed, in how many tables."""
    return failures.agg(F.count("*").alias("failure_count"), F.count_distinct("table_name").alias("failed_table_count"))


def verification_report(
    files: DataFrame,
    sidecar: DataFrame,
    warnings: DataFrame,
    tables: Mapping[str, DataFrame],
    path: str = "relative_path",
    path_sample: int = 0,
) -> DataFrame:
    """One (metric, subject, value) table: file and sidecar counts, groups, drift, and rows and columns per table.

    With ``path_sample``, also the number of distinct CSV paths and that many of them in order, each with how often it is
    listed. Null paths are none.
    """

    columns = ["metric", "subject", "value"]
    csv = files.filter(F.col(path).endswith(".csv"))
    no_source = F.lit(None).cast("string").alias("source")
    tagged = (
        csv.select(F.lit("csv").alias("kind"), no_source)
        .unionByName(sidecar.select(F.lit("sidecar").alias("kind"), F.col("_SOURCE_FILE_PATH").alias("source")))
        .unionByName(warnings.select(F.lit("drift").alias("kind"), no_source))
    )
    totals = tagged.agg(
        F.count_if(F.col("kind") == "csv").alias("csv_file_count"),
        F.count_if(F.col("kind") == "sidecar").alias("sidecar_file_count"),
        F.count_distinct(F.nullif(F.col("source"), F.lit(""))).alias("sidecar_source_url_count"),
        F.count_if(F.col("kind") == "drift").alias("schema_drift_warning_count"),
    ).withColumns(
        {
            "csv_without_sidecar_possible": (F.col("csv_file_count") > F.col("sidecar_file_count")).cast("long"),
            "sidecar_without_csv_possible": (F.col("sidecar_file_count") > F.col("csv_file_count")).cast("long"),
        }
    )
    group = F.concat_ws("/", "series_id", "sub_dataset_id").alias("subject")
    parts = [
        totals.unpivot([], totals.columns, "metric", "value").withColumn("subject", F.lit("")),
        agg_file_counts(files, path).select(F.lit("csv_files").alias("metric"), group, F.col("csv_file_count").alias("value")),
    ]
    if path_sample:
        listed = csv.groupBy(F.col(path).alias("subject")).agg(F.count("*").alias("value"))
        parts.append(listed.orderBy("subject").limit(path_sample).withColumn("metric", F.lit("csv_path_sample")))
        parts.append(listed.agg(F.count("*").alias("value")).select(F.lit("csv_file_path_count").alias("metric"), F.lit("").alias("subject"), "value"))
    for name, df in sorted(tables.items()):
        size = df.agg(F.count("*").alias("table_rows")).withColumn("table_columns", F.lit(len(df.columns)).cast("long"))
        parts.append(size.unpivot([], size.columns, "metric", "value").withColumn("subject", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), [p.select(columns) for p in parts])
