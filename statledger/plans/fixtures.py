"""Published-statistics shaped inputs derived from the test tables, in Spark and as DuckDB CTEs.

Files are (month, block of 100 customers, revision) slices of ``orders``, so their number grows with the table. The
row number in a file is the order key: no window is needed to number rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statledger.functions.text import MONTHS

PAYLOAD = ["Period", "OrderKey", "Org Code", "priorityClass", "c-d"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def orders_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "yyyymm", F.year("o_orderdate") * 100 + F.month("o_orderdate")
    )


def _loads(df: DataFrame) -> DataFrame:
    """Add ``rev`` and ``copy``: every fourth month has a second revision, every third month's files were loaded twice."""
    one_or_two, one = F.array(F.lit(1), F.lit(2)), F.array(F.lit(1))
    return df.withColumn("rev", F.explode(F.when(F.col("yyyymm") % 4 == 0, one_or_two).otherwise(one))).withColumn(
        "copy", F.explode(F.when(F.col("yyyymm") % 3 == 0, one_or_two).otherwise(one))
    )


def _shard() -> Column:
    return F.floor(F.col("o_custkey") / 100)


def _file_columns() -> dict[str, Column]:
    """Ingest metadata of a load, from yyyymm, shard, rev and copy."""
    key = F.concat(F.lit("k-"), F.col("yyyymm"), F.lit("-"), F.col("shard"), F.lit("-"), F.col("rev"))
    first = F.col("rev") == 1
    path = F.concat(F.lit("p="), F.col("yyyymm"), F.lit("/s="), F.col("shard"), F.lit("/rev="), F.col("rev"), F.lit(".csv"))
    return {
        "_INGESTED_AT": F.when(first & (F.col("copy") == 1), _ntz("2024-01-01 00:00:00"))
        .when(first, _ntz("2024-01-01 06:00:00"))
        .when(F.col("copy") == 1, _ntz("2024-02-01 00:00:00"))
        .otherwise(_ntz("2024-02-01 06:00:00")),
        "_SOURCE_FILE_PATH": path,
        "_SOURCE_FILE_NAME": F.concat(F.lit("s"), F.col("shard"), F.lit("-rev"), F.col("rev"), F.lit(".csv")),
        "_FILE_CONTENT_KEY": key,
        "_ACQUISITION_METHOD": F.when(first, "automated").otherwise("manual"),
        "_FALLBACK_REASON": F.when(first, "").otherwise("auto_discovery_empty"),
        "_LOAD_ID": F.substring(key, 1, 16),
        "Period": F.col("yyyymm").cast("string"),
    }


def f_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only loads of all files, repeated ones included."""
    columns = {name: column.alias(name) for name, column in _file_columns().items()}
    period = columns.pop("Period")
    metadata = list(columns.values())
    return _loads(orders_months(spark, sf_dir).withColumn("shard", _shard())).select(
        *metadata[:3],
        F.col("o_orderkey").alias("_FILE_ROW_NUMBER"),
        *metadata[3:],
        period,
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_custkey").alias("Org Code"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("priorityClass"),
        (F.col("o_totalprice") + F.col("rev") - 1).alias("c-d"),
    )


def _file_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per load of a file with its number of rows ``n``; files are counted before their names are made."""
    files = orders_months(spark, sf_dir).groupBy("yyyymm", _shard().alias("shard")).agg(F.count("*").alias("n"))
    return _loads(files).select("n", "copy", *[column.alias(name) for name, column in _file_columns().items()])


def f_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata per file; every fifth month's is missing, some have no publication date."""
    files = _file_loads(spark, sf_dir).filter((F.col("copy") == 1) & (F.col("Period").cast("int") % 5 != 0))
    month = F.col("Period").cast("int")
    published = F.when(month % 8 != 1, F.concat("Period", F.when(F.col("_ACQUISITION_METHOD") == "automated", "15T090000").otherwise("20T090000")))
    return files.select(
        F.col("_SOURCE_FILE_PATH").alias("_PAYLOAD_STAGE_PATH"),
        F.concat(F.lit("https://example.test/"), F.col("_SOURCE_FILE_PATH")).alias("_SOURCE_FILE_PATH"),
        "_SOURCE_FILE_NAME",
        "_FILE_CONTENT_KEY",
        "_LOAD_ID",
        F.concat("Period", F.lit("01T000000")).alias("_SUBJECT_PERIOD_FROM"),
        F.concat("Period", F.lit("28T235959")).alias("_SUBJECT_PERIOD_TO"),
        F.when(month % 2 == 0, "single_month").alias("_SUBJECT_PERIOD_COVERAGE_TYPE"),
        F.when(month % 7 == 0, F.lit(12)).cast("long").alias("_FILE_SCOPE_DURATION_VALUE"),
        published.alias("_PUBLICATION_DATE"),
        F.concat("Period", F.when(F.col("_ACQUISITION_METHOD") == "automated", "16T070000").otherwise("21T070000")).alias("_DOWNLOADED_AT"),
        F.when(F.col("_ACQUISITION_METHOD") == "automated", "2024-01-01T00:00:00Z").otherwise("2024-02-01T00:00:00Z").alias("_INGESTED_AT"),
        F.concat(F.lit("landing/"), F.col("_SOURCE_FILE_PATH")).alias("_TARGET_PATH"),
        F.when(month % 3 != 0, F.concat(F.lit("e"), F.col("Period"))).alias("_SOURCE_ETAG"),
        F.when(month % 4 != 0, F.concat(F.lit("m"), F.col("Period"))).alias("_SOURCE_LAST_MODIFIED"),
        "_ACQUISITION_METHOD",
    )


def f_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upload event per file load."""
    month = F.col("Period").cast("int")
    return (
        _file_loads(spark, sf_dir)
        .select(
            F.col("_INGESTED_AT").alias("EVENT_TIMESTAMP_UTC"),
            F.concat(F.lit("run-"), "Period").alias("RUN_ID"),
            F.lit("UPLOAD").alias("STAGE"),
            F.when(month % 9 == 0, "FAILED").otherwise("SUCCEEDED").alias("STATUS"),
            F.lit(1).cast("long").alias("ATTEMPT_NUMBER"),
            F.lit("orders").alias("SERIES_ID"),
            F.col("_ACQUISITION_METHOD").alias("SUB_DATASET_ID"),
            F.col("_SOURCE_FILE_PATH").alias("SOURCE_URL"),
            F.col("_SOURCE_FILE_NAME").alias("FILE_NAME"),
            F.col("_LOAD_ID").alias("LOAD_ID"),
            F.when(month % 6 == 0, F.lit(None)).when(month % 7 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("NORMALIZED_ROW_COUNT"),
        )
    )


def f_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, one column per year."""
    year = F.year("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("org_code"))
        .agg(*[F.sum(F.when(year == y, F.round(F.col("o_totalprice") * 100).cast("long"))).alias(f"y{y}") for y in (1996, 1997, 1998)])
    )


def f_discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    suffix = F.when(F.col("o_orderkey") % 2 == 0, ".csv/").otherwise(F.when(F.col("o_orderkey") % 3 == 0, ".ZIP").otherwise(".csv"))
    return orders.select(
        F.col("o_orderstatus").alias("dataset_id"),
        F.ascii("o_orderstatus").alias("dataset_order"),
        F.col("o_orderpriority").alias("sub_dataset_id"),
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("https://example.test/"), "o_orderstatus", F.lit("/"), "o_custkey", suffix).alias("source_url"),
        F.when(F.col("o_orderkey") % 7 != 0, F.concat(month.cast("string"), F.lit("01T000000"))).alias("publication_date"),
        F.concat(F.lit("e"), F.col("o_custkey") % 40).alias("etag"),
        F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("m"), F.col("o_custkey") % 30)).alias("last_modified"),
        F.concat(F.lit("h"), F.col("o_custkey") % 20).alias("content_hash"),
    )


def f_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in ten ways; ``shape`` says which."""
    d = F.col("o_orderdate")
    shape = F.col("o_orderkey") % 11
    year, month = F.year(d), F.month(d)
    start_year = F.when(month <= 3, year - 1).otherwise(year)
    fiscal = F.concat(start_year.cast("string"), F.lit("-"), F.lpad(((start_year + 1) % 100).cast("string"), 2, "0"), F.lit("_"), F.lower(F.date_format(d, "MMMM")))
    day = F.dayofmonth(d)
    ordinal = F.concat(day.cast("string"), F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th"))
    text = (
        F.when(shape == 0, F.date_format(d, "d MMMM yyyy"))
        .when(shape == 1, F.date_format(d, "yyyy-MM-dd"))
        .when(shape == 2, F.date_format(d, "yyyyMMdd"))
        .when(shape == 3, F.date_format(d, "MMMM yyyy"))
        .when(shape == 4, F.date_format(d, "MMMyyyy"))
        .when(shape == 5, F.concat(F.lit("n/a "), year.cast("string")))
        .when(shape == 6, fiscal)
        .when(shape == 7, F.concat(ordinal, F.date_format(d, " MMM, yyyy")))
        .when(shape == 8, F.date_format(d, "yyyy-MM-dd'T'10:30"))
        .when(shape == 9, F.date_format(d, "dd-MMM-yyyy 23:59:07"))
        .otherwise(F.date_format(d, "yyyy-MM-'31'"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", year.alias("y"), month.alias("m"), day.alias("d"), shape.alias("shape"), text.alias("text_value")
    )


def f_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook cells: one book per eight orders, sheets and rows by order and line, four columns."""
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_partkey").cast("string").alias("A"),
        F.min("l_returnflag").alias("B"),
        F.min("l_quantity").cast("long").cast("string").alias("C"),
        F.min("l_linestatus").alias("D"),
    )
    place = F.col("l_orderkey") % 8
    cell = F.array(*[F.struct(F.lit(i + 1).alias("col"), F.col(c).alias("value")) for i, c in enumerate("ABCD")])
    return (
        rows.select(
            F.concat(F.lit("book"), F.floor(F.col("l_orderkey") / 8)).alias("file"),
            place.cast("int").alias("sheet_index"),
            F.concat(F.when(place % 2 == 0, "Raw data ").otherwise("Cover "), place.cast("string")).alias("sheet"),
            F.col("l_linenumber").alias("row"),
            F.explode(cell).alias("cell"),
        )
        .select("file", "sheet_index", "sheet", "row", "cell.col", "cell.value")
    )


def f_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory rows from parts: dataset = brand, sub-collection = type."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("seq"),
        F.concat(F.lit(" "), "p_brand").alias("dataset_name"),
        F.when(key % 3 == 0, F.lit("n/a")).otherwise(F.concat(F.lit("https://example.test/"), key % 50)).alias("parent_link"),
        F.when(key % 4 == 0, F.concat(F.lit("https://example.test/sub/"), key)).otherwise(F.lit("None")).alias("sub_link"),
        F.when(key % 9 == 0, F.lit("N/A")).otherwise(F.col("p_type")).alias("sub_collection"),
        F.when(key % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("https://example.test/f/"), F.col("p_size"), F.when(F.col("p_size") % 2 == 0, ".CSV").when(F.col("p_size") % 3 == 0, ".zip?x=1").otherwise(""))
        ).alias("target_file"),
        F.col("p_name").alias("note"),
    )


# The same inputs for DuckDB, in dependency order.
CTES = {
    "f_ingest": """
SELECT CASE WHEN rev = 1 AND copy = 1 THEN TIMESTAMP '2024-01-01 00:00:00' WHEN rev = 1 THEN TIMESTAMP '2024-01-01 06:00:00'
            WHEN copy = 1 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-02-01 06:00:00' END AS "_INGESTED_AT",
       concat('p=', yyyymm, '/s=', shard, '/rev=', rev, '.csv') AS "_SOURCE_FILE_PATH",
       concat('s', shard, '-rev', rev, '.csv') AS "_SOURCE_FILE_NAME",
       o_orderkey AS "_FILE_ROW_NUMBER",
       concat('k-', yyyymm, '-', shard, '-', rev) AS "_FILE_CONTENT_KEY",
       CASE WHEN rev = 1 THEN 'automated' ELSE 'manual' END AS "_ACQUISITION_METHOD",
       CASE WHEN rev = 1 THEN '' ELSE 'auto_discovery_empty' END AS "_FALLBACK_REASON",
       substring(concat('k-', yyyymm, '-', shard, '-', rev), 1, 16) AS "_LOAD_ID",
       CAST(yyyymm AS VARCHAR) AS "Period", o_orderkey AS "OrderKey", o_custkey AS "Org Code",
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS "priorityClass",
       o_totalprice + rev - 1 AS "c-d"
FROM (SELECT *, unnest(CASE WHEN yyyymm % 3 = 0 THEN [1, 2] ELSE [1] END) AS copy
      FROM (SELECT *, unnest(CASE WHEN yyyymm % 4 = 0 THEN [1, 2] ELSE [1] END) AS rev
            FROM (SELECT *, year(o_orderdate) * 100 + month(o_orderdate) AS yyyymm, o_custkey // 100 AS shard FROM orders)))""",
    "f_sidecar": """
SELECT "_SOURCE_FILE_PATH" AS "_PAYLOAD_STAGE_PATH", concat('https://example.test/', "_SOURCE_FILE_PATH") AS "_SOURCE_FILE_PATH",
       "_SOURCE_FILE_NAME", "_FILE_CONTENT_KEY", "_LOAD_ID",
       concat("Period", '01T000000') AS "_SUBJECT_PERIOD_FROM", concat("Period", '28T235959') AS "_SUBJECT_PERIOD_TO",
       CASE WHEN mm % 2 = 0 THEN 'single_month' END AS "_SUBJECT_PERIOD_COVERAGE_TYPE",
       CAST(CASE WHEN mm % 7 = 0 THEN 12 END AS BIGINT) AS "_FILE_SCOPE_DURATION_VALUE",
       CASE WHEN mm % 8 <> 1 THEN concat("Period", CASE WHEN "_ACQUISITION_METHOD" = 'automated' THEN '15T090000' ELSE '20T090000' END) END AS "_PUBLICATION_DATE",
       concat("Period", CASE WHEN "_ACQUISITION_METHOD" = 'automated' THEN '16T070000' ELSE '21T070000' END) AS "_DOWNLOADED_AT",
       CASE WHEN "_ACQUISITION_METHOD" = 'automated' THEN '2024-01-01T00:00:00Z' ELSE '2024-02-01T00:00:00Z' END AS "_INGESTED_AT",
       concat('landing/', "_SOURCE_FILE_PATH") AS "_TARGET_PATH",
       CASE WHEN mm % 3 <> 0 THEN concat('e', "Period") END AS "_SOURCE_ETAG",
       CASE WHEN mm % 4 <> 0 THEN concat('m', "Period") END AS "_SOURCE_LAST_MODIFIED",
       "_ACQUISITION_METHOD"
FROM (SELECT DISTINCT "_SOURCE_FILE_PATH", "_SOURCE_FILE_NAME", "_FILE_CONTENT_KEY", "_LOAD_ID", "Period", "_ACQUISITION_METHOD",
             CAST("Period" AS INTEGER) AS mm FROM f_ingest)
WHERE mm % 5 <> 0""",
    "f_telemetry": """
SELECT "_INGESTED_AT" AS "EVENT_TIMESTAMP_UTC", concat('run-', "Period") AS "RUN_ID", 'UPLOAD' AS "STAGE",
       CASE WHEN CAST("Period" AS INTEGER) % 9 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS "STATUS",
       CAST(1 AS BIGINT) AS "ATTEMPT_NUMBER", 'orders' AS "SERIES_ID", "_ACQUISITION_METHOD" AS "SUB_DATASET_ID",
       "_SOURCE_FILE_PATH" AS "SOURCE_URL", "_SOURCE_FILE_NAME" AS "FILE_NAME", "_LOAD_ID" AS "LOAD_ID",
       CASE WHEN CAST("Period" AS INTEGER) % 6 = 0 THEN NULL WHEN CAST("Period" AS INTEGER) % 7 = 0 THEN count(*) + 1 ELSE count(*) END AS "NORMALIZED_ROW_COUNT"
FROM f_ingest GROUP BY "Period", "_LOAD_ID", "_ACQUISITION_METHOD", "_SOURCE_FILE_PATH", "_SOURCE_FILE_NAME", "_INGESTED_AT\"""",
    "dedup": """
SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY "_FILE_CONTENT_KEY", "_FILE_ROW_NUMBER"
    ORDER BY "_INGESTED_AT" DESC, "_SOURCE_FILE_PATH" DESC, "_SOURCE_FILE_NAME" DESC) AS rk FROM f_ingest) WHERE rk = 1""",
    "joined": """
SELECT p.*, m."_DOWNLOADED_AT", m."_SUBJECT_PERIOD_FROM", m."_SUBJECT_PERIOD_TO", m."_SUBJECT_PERIOD_COVERAGE_TYPE",
       CAST(NULL AS VARCHAR) AS "_SUBJECT_PERIOD_INFERENCE_METHOD", CAST(NULL AS VARCHAR) AS "_SUBJECT_PERIOD_INFERENCE_SOURCE",
       CAST(NULL AS VARCHAR) AS "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE", CAST(NULL AS VARCHAR) AS "_FILE_SCOPE_DURATION_TYPE",
       m."_FILE_SCOPE_DURATION_VALUE", CAST(NULL AS VARCHAR) AS "_FILE_SCOPE_DURATION_UNIT",
       CAST(NULL AS VARCHAR) AS "_FILE_SCOPE_FISCAL_YEAR_START_MONTH", CAST(NULL AS VARCHAR) AS "_BREAKDOWN_GRANULARITY",
       m."_PUBLICATION_DATE", CAST(NULL AS VARCHAR) AS "_PUBLICATION_DATE_SOURCE"
FROM dedup p LEFT JOIN f_sidecar m ON p."_SOURCE_FILE_PATH" = m."_PAYLOAD_STAGE_PATH\"""",
    "raw": """
SELECT * REPLACE (coalesce("_DOWNLOADED_AT", '') AS "_DOWNLOADED_AT", coalesce("_SUBJECT_PERIOD_FROM", '') AS "_SUBJECT_PERIOD_FROM",
       coalesce("_SUBJECT_PERIOD_TO", '') AS "_SUBJECT_PERIOD_TO", coalesce("_SUBJECT_PERIOD_COVERAGE_TYPE", 'unknown') AS "_SUBJECT_PERIOD_COVERAGE_TYPE",
       'not_inferred' AS "_SUBJECT_PERIOD_INFERENCE_METHOD", 'none' AS "_SUBJECT_PERIOD_INFERENCE_SOURCE",
       'low' AS "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE", 'unknown' AS "_FILE_SCOPE_DURATION_TYPE", '' AS "_FILE_SCOPE_DURATION_UNIT",
       '' AS "_BREAKDOWN_GRANULARITY", coalesce("_PUBLICATION_DATE", '') AS "_PUBLICATION_DATE", 'unknown' AS "_PUBLICATION_DATE_SOURCE")
FROM joined""",
    "presentation": """
SELECT * EXCLUDE ("Period", "OrderKey", "Org Code", "priorityClass", "c-d"), "Period" AS "PERIOD", "OrderKey" AS "ORDER_KEY",
       "Org Code" AS "ORG_CODE", "priorityClass" AS "PRIORITY_CLASS", "c-d" AS "C_D"
FROM raw WHERE "_SUBJECT_PERIOD_FROM" IS NOT NULL AND "_SUBJECT_PERIOD_TO" IS NOT NULL""",
    "ranks": """
SELECT *, CAST(row_number() OVER (PARTITION BY "PERIOD" ORDER BY "_PUBLICATION_DATE" DESC NULLS LAST, "_INGESTED_AT" DESC,
       "_SOURCE_FILE_PATH" DESC, "_SOURCE_FILE_NAME" DESC) AS BIGINT) AS "_PUBLICATION_RANK"
FROM (SELECT DISTINCT "_SOURCE_FILE_NAME", "_SOURCE_FILE_PATH", "_INGESTED_AT", "PERIOD", "_PUBLICATION_DATE" FROM presentation)""",
    "f_wide": """
SELECT o_custkey AS org_code, CAST(sum(CASE WHEN year(o_orderdate) = 1996 THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS y1996,
       CAST(sum(CASE WHEN year(o_orderdate) = 1997 THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS y1997,
       CAST(sum(CASE WHEN year(o_orderdate) = 1998 THEN CAST(round(o_totalprice * 100) AS BIGINT) END) AS BIGINT) AS y1998
FROM orders GROUP BY o_custkey""",
    "f_discovered": """
SELECT o_orderstatus AS dataset_id, ascii(o_orderstatus) AS dataset_order, o_orderpriority AS sub_dataset_id, o_orderkey AS seq,
       concat('https://example.test/', o_orderstatus, '/', o_custkey,
              CASE WHEN o_orderkey % 2 = 0 THEN '.csv/' WHEN o_orderkey % 3 = 0 THEN '.ZIP' ELSE '.csv' END) AS source_url,
       CASE WHEN o_orderkey % 7 <> 0 THEN concat(year(o_orderdate) * 100 + month(o_orderdate), '01T000000') END AS publication_date,
       concat('e', o_custkey % 40) AS etag, CASE WHEN o_orderkey % 5 <> 0 THEN concat('m', o_custkey % 30) END AS last_modified,
       concat('h', o_custkey % 20) AS content_hash
FROM orders""",
    "f_dates": """
SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 11 AS shape FROM orders""",
    "f_cells": """
SELECT file, sheet_index, sheet, "row", c.col AS col, c.value AS value FROM (
SELECT concat('book', l_orderkey // 8) AS file, CAST(l_orderkey % 8 AS INTEGER) AS sheet_index,
       concat(CASE WHEN l_orderkey % 2 = 0 THEN 'Raw data ' ELSE 'Cover ' END, l_orderkey % 8) AS sheet, l_linenumber AS "row",
       unnest([{'col': 1, 'value': CAST(min(l_partkey) AS VARCHAR)}, {'col': 2, 'value': min(l_returnflag)},
               {'col': 3, 'value': CAST(CAST(min(l_quantity) AS BIGINT) AS VARCHAR)}, {'col': 4, 'value': min(l_linestatus)}]) AS c
FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "f_inventory": """
SELECT p_partkey AS seq, p_brand AS dataset_name, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('https://example.test/', p_partkey % 50) END AS parent_link,
       CASE WHEN p_partkey % 4 = 0 THEN concat('https://example.test/sub/', p_partkey) END AS sub_link,
       CASE WHEN p_partkey % 9 = 0 THEN 'default' ELSE lower(p_type) END AS sub_dataset_id,
       CASE WHEN p_partkey % 5 <> 0 THEN concat('https://example.test/f/', p_size, CASE WHEN p_size % 2 = 0 THEN '.CSV' WHEN p_size % 3 = 0 THEN '.zip?x=1' ELSE '' END) END AS target_file,
       CASE WHEN p_size % 2 = 0 THEN 'csv' WHEN p_size % 3 = 0 THEN 'zip' ELSE '' END AS extension, p_name AS note
FROM part""",
    "visible": r"""
SELECT page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', ' ', 'g') AS html FROM pages""",
    "anchors": r"""
SELECT url AS page_url, generate_subscripts(a, 1) - 1 AS position, unnest(a) AS anchor
FROM (SELECT url, regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a\s*>') AS a FROM visible)""",
    "links": r"""
SELECT page_url, CAST(position AS INTEGER) AS position, href,
       trim(regexp_replace(regexp_replace(regexp_replace(anchor, '<[^>]*>', ' ', 'g'), '&amp;', '&', 'g'), '\s+', ' ', 'g')) AS link_text,
       CASE WHEN href LIKE '/%' THEN concat(regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1), href) ELSE href END AS link_url
FROM (SELECT *, regexp_extract(anchor, 'href="([^"]*)"', 1) AS href FROM anchors)""",
}
REQUIRES = {
    "f_sidecar": ["f_ingest"], "f_telemetry": ["f_ingest"], "dedup": ["f_ingest"], "joined": ["dedup", "f_sidecar"],
    "raw": ["joined"], "presentation": ["raw"], "ranks": ["presentation"], "anchors": ["visible"], "links": ["anchors"],
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause defining the named inputs and what they need."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        wanted.add(name)
        for other in REQUIRES.get(name, []):
            need(other)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in CTES.items() if n in wanted) + "\n"


def f_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that link on: each names the next page (the last has none), a data file and its publication date."""
    pages = table(spark, sf_dir, "pages")
    following = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    month = F.element_at(F.array(*[F.lit(m) for m in SITE_MONTHS]), (F.col("page_id") % 12 + 1).cast("int"))
    year = (F.col("page_id") % 20 + 2001).cast("string")
    addition = F.concat(
        F.lit('<p>Published: '), (F.col("page_id") % 28 + 1), F.lit(" "), month, F.lit(" "), year,
        F.lit("</p>"), F.coalesce(F.concat(F.lit('<a href="'), "next_url", F.lit('">Release '), year, F.lit("</a>")), F.lit("")),
        F.lit('<a href="/files/'), F.lower(month), year,
        F.lit("-"), "page_id", F.when(F.col("page_id") % 3 == 0, ".zip").otherwise(".csv"), F.lit('">Data '), month, F.lit(" "), year, F.lit("</a>"),
    )
    return pages.join(following, "page_id", "left").select("page_id", "url", F.concat("html", addition).alias("html"))


SITE_MONTHS = [m.capitalize() for m in MONTHS]

_MONTH_LIST = "['" + "', '".join(SITE_MONTHS) + "']"
CTES["site"] = f"""
SELECT p.page_id, p.url, n.url AS next_url, {_MONTH_LIST}[p.page_id % 12 + 1] AS mname, p.page_id % 12 + 1 AS m, p.page_id % 20 + 2001 AS y, p.page_id % 28 + 1 AS d,
       concat('/files/', lower({_MONTH_LIST}[p.page_id % 12 + 1]), p.page_id % 20 + 2001, '-', p.page_id, CASE WHEN p.page_id % 3 = 0 THEN '.zip' ELSE '.csv' END) AS file_href,
       regexp_extract(p.url, '^([a-z]+://[^/?#]*)', 1) AS origin, p.html
FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1"""
