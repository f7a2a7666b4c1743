"""File sources, sinks and streams, over files Spark writes from the tables into the shared folder."""

from __future__ import annotations

import contextlib
import io
import zipfile
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from statledger.functions.paths import content_hash, landing_path
from statledger.operators import quality, revisions
from statledger.operators.quality import agg_csv_row_count
from statledger.plans.fixtures import CTES, PAYLOAD, REQUIRES, f_discovered, f_ingest, f_sidecar, f_telemetry, table, with_ctes
from statledger.plans.registry import query
from statledger.schemas import SIDECAR_COLUMNS, SIDECAR_SCHEMA
from statledger.session import scratch_path, ship_by_value
from statledger.sources import files, sinks
from statledger.sources.versions import Store
from statledger.streaming import ingest as streams
from statledger.streaming import scheduled

ship_by_value(__name__)


def _payload(spark, sf_dir):
    return f_ingest(spark, sf_dir).select(*[f"`{c}`" for c in PAYLOAD])


def _as_values(df):
    """Typed back from text, so that number formats do not matter."""
    return df.select(
        "Period", F.col("OrderKey").cast("long").alias("OrderKey"), F.col("Org Code").cast("long").alias("Org Code"), "priorityClass", F.col("c-d").cast("double").alias("c-d")
    )


_PAYLOAD_SQL = with_ctes("f_ingest") + """SELECT "Period", "OrderKey", "Org Code", "priorityClass", "c-d" FROM f_ingest"""


@query("scan_csv_strings", """SELECT doc_id, text, lang FROM documents""")
def scan_csv_strings(spark, sf_dir):
    """Whole document texts, with their quotes, separators and line breaks, through CSV files."""
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "documents").select("doc_id", "text", "lang").write.option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path, header=True)
    rows = files.scan_csv_strings(spark, [path], ["doc_id", "text", "lang"], multi_line=True)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


@query("scan_csv_delimiter_encoding", """SELECT c_custkey, c_name, c_mktsegment FROM customer""")
def scan_csv_delimiter_encoding(spark, sf_dir):
    path = scratch_path(spark, "csv")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    customers.write.option("sep", ";").option("encoding", "UTF-16LE").csv(path, header=True)
    rows = files.scan_csv_strings(spark, [path], customers.columns, sep=";", encoding="UTF-16LE", multi_line=True)
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query("scan_csv_ragged_headers", with_ctes("f_ingest") + """SELECT "Period", "OrderKey", CASE WHEN "_ACQUISITION_METHOD" = 'manual' THEN "priorityClass" END AS "priorityClass", "c-d" FROM f_ingest""")
def scan_csv_ragged_headers(spark, sf_dir):
    """Two generations of files with different columns in different order, below one folder."""
    path = scratch_path(spark, "csv")
    ingest = f_ingest(spark, sf_dir)
    old = ingest.filter(F.col("_ACQUISITION_METHOD") == "automated").select("Period", "OrderKey", "c-d")
    new = ingest.filter(F.col("_ACQUISITION_METHOD") == "manual").select("c-d", "priorityClass", "Period", "OrderKey")
    old.write.csv(f"{path}/old", header=True)
    new.write.csv(f"{path}/new", header=True)
    rows = files.scan_csv_strings(spark, [path])
    return rows.select("Period", F.col("OrderKey").cast("long").alias("OrderKey"), "priorityClass", F.col("c-d").cast("double").alias("c-d"))


@query("scan_csv_trim_blank_null", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders""")
def scan_csv_trim_blank_null(spark, sf_dir):
    path = scratch_path(spark, "csv")
    padded = F.when(F.col("o_orderkey") % 8 == 0, "").when(F.col("o_orderkey") % 4 == 0, "   ").otherwise(F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")))
    written = table(spark, sf_dir, "orders").select("o_orderkey", padded.alias("priority")).write
    written.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path, header=True)
    rows = files.scan_csv_strings(spark, [path], ["o_orderkey", "priority"], trim=True)
    return rows.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query("detect_encoding", r"""SELECT lang, CASE WHEN max(CASE WHEN regexp_matches(text, '[\x{80}-\x{FF}]') THEN 1 ELSE 0 END) = 1 THEN 'cp1252' ELSE 'utf-8' END AS encoding FROM documents WHERE doc_id % 2 = 0 GROUP BY 1
UNION ALL SELECT concat(lang, '-utf8'), 'utf-8' FROM documents WHERE doc_id % 2 = 1 GROUP BY 1""")
def detect_encoding(spark, sf_dir):
    """Texts by language, every other one landed in ISO-8859-1, the rest in UTF-8."""
    path = scratch_path(spark, "encodings")
    docs = table(spark, sf_dir, "documents").select("text", F.col("lang").alias("part"), "doc_id")
    docs.filter(F.col("doc_id") % 2 == 0).drop("doc_id").write.partitionBy("part").option("encoding", "ISO-8859-1").csv(f"{path}/latin")
    docs.filter(F.col("doc_id") % 2 == 1).drop("doc_id").withColumn("part", F.concat("part", F.lit("-utf8"))).write.partitionBy("part").csv(f"{path}/utf8")
    found = files.detect_encoding(spark, [path])
    part = F.regexp_extract("file_path", "part=([^/]*)/", 1)
    return found.groupBy(part.alias("lang")).agg(F.min("encoding").alias("encoding"))


# Charsets that Spark writes, and what must be told of the files. Its UTF-32 has no mark.
_WRITTEN = {
    "ISO-8859-1": "cp1252", "UTF-8": "utf-8", "US-ASCII": "ascii", "UTF-16": "utf-16", "UTF-16LE": "utf-16le", "UTF-16BE": "utf-16be", "UTF-32": "utf-32be",
}
_FORGED = {"C1": "latin-1", "marked": "utf-32", "turned": "utf-32le", "turned-marked": "utf-32"}


@query("detect_encoding_all", "SELECT DISTINCT concat(lang, '-', e.a) AS part, e.b AS encoding FROM documents, (VALUES "
       + ", ".join(f"('{a}', '{b}')" for a, b in (_WRITTEN | _FORGED).items()) + ") e(a, b)")
def detect_encoding_all(spark, sf_dir):
    """Texts by language, landed in every encoding: as Spark writes them, with a character that windows-1252 has not,
    with a mark in front, and with the bytes of each unit turned round.

    Eleven copies of the texts, half of them in two or four bytes a character, are landed gzipped, in files that are
    small enough for one task each, side by side: a table that is read in few parts is landed by few tasks at a time.
    Higher levels of gzip compress in up to five times the time, to a seventh less."""
    packed = {"compression": "gzip", "zlib.compress.level": "TWO", "maxRecordsPerFile": 10_000}
    path = scratch_path(spark, "encodings")
    # A session in which UTF-32LE can be named, the units of UTF-32 turned round, and in which a task keeps a file open for
    # each of up to 16 parts: its texts need not be sorted by part.
    landing = spark.newSession()
    landing.conf.set("spark.sql.legacy.javaCharsets", "true")
    landing.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")
    docs = table(landing, sf_dir, "documents").select("text", "lang")

    def land(charset, text, kind):
        rows = docs.select(text.alias("text"), F.concat_ws("-", "lang", F.lit(kind)).alias("part"))
        rows.write.partitionBy("part").options(**packed).option("encoding", charset).csv(f"{path}/{kind}")

    def forge(kind, mark, charset, end):
        units = F.encode(F.concat(F.lit(mark), "text"), charset).cast("string")
        rows = docs.select(units.alias("value"), F.concat_ws("-", "lang", F.lit(kind)).alias("part"))
        rows.write.partitionBy("part").options(**packed).option("lineSep", end).text(f"{path}/{kind}")

    landings = [
        (land, charset, F.regexp_replace("text", "[^\\x00-\\x7F]", "?") if charset == "US-ASCII" else F.concat("text", F.lit(" \u00e9")), charset)
        for charset in _WRITTEN
    ]
    landings.append((land, "ISO-8859-1", F.concat("text", F.lit("\u0081")), "C1"))
    for kind, mark, charset, end in (("marked", "\ufeff", "UTF-32", "\0\0\0\n"), ("turned", "", "UTF-32LE", "\n\0\0\0"), ("turned-marked", "\ufeff", "UTF-32LE", "\n\0\0\0")):
        landings.append((forge, kind, mark, charset, end))
    # Where threads are not pinned to ones of the JVM, there is nothing to hand on, and the session is given back.
    own = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(landings)) as pool:
        for landed in [pool.submit(write if own is spark else own(write), *values) for write, *values in landings]:
            landed.result()
    found = files.detect_encoding(spark, [path], ("ascii", *[e for e in files.ENCODINGS if e != "ascii"]))
    part = F.regexp_extract("file_path", "part=([^/]*)/", 1)
    return found.groupBy(part.alias("part")).agg(F.concat_ws("|", F.array_sort(F.collect_set("encoding"))).alias("encoding"))


def _zip_parts(batches):
    for batch in batches:
        rows = []
        for key, name, brand, kind in zip(batch["p_partkey"], batch["p_name"], batch["p_brand"], batch["p_type"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w") as archive:
                archive.writestr("data/", "")
                archive.writestr("readme.txt", name)
                if kind != "SMALL":
                    archive.writestr(f"data/{key}.csv", f'key,name\n{key},"{name}, {brand}"\n')
                    archive.writestr(f"other/{key}.CSV", f"brand\n{brand}\n\n")
                    archive.writestr("book.xlsx", brand)
            rows.append((f"part-{key}.zip", buffer.getvalue()))
        yield pd.DataFrame(rows, columns=["path", "content"])


def _archives(spark, sf_dir):
    """One archive per part, built inside the tasks; those of small parts hold nothing usable."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return parts.mapInPandas(_zip_parts, "path string, content binary")


@query("scan_zip_members", """SELECT path, concat(d, k, e) AS member, concat(k, e) AS file_name, t AS file_type, CAST(n AS INTEGER) AS bytes FROM (
SELECT concat('part-', p_partkey, '.zip') AS path, 'data/' AS d, CAST(p_partkey AS VARCHAR) AS k, '.csv' AS e, 'csv' AS t, strlen(concat('key,name#', p_partkey, ',"', p_name, ', ', p_brand, '"#')) AS n FROM part WHERE p_type <> 'SMALL'
UNION ALL SELECT concat('part-', p_partkey, '.zip'), 'other/', CAST(p_partkey AS VARCHAR), '.CSV', 'csv', strlen(concat('brand#', p_brand, '##')) FROM part WHERE p_type <> 'SMALL'
UNION ALL SELECT concat('part-', p_partkey, '.zip'), '', 'book', '.xlsx', 'xlsx', strlen(p_brand) FROM part WHERE p_type <> 'SMALL')""")
def scan_zip_members(spark, sf_dir):
    members = files.scan_zip_members(_archives(spark, sf_dir))
    return members.select("path", "member", "file_name", "file_type", F.length("content").alias("bytes"))


@query("scan_zip_member_rows", """SELECT concat('part-', p_partkey, '.zip') AS path, concat('data/', p_partkey, '.csv') AS member, CAST(1 AS BIGINT) AS row_number, concat(p_partkey, '|', p_name, ', ', p_brand) AS fields FROM part WHERE p_type <> 'SMALL'
UNION ALL SELECT concat('part-', p_partkey, '.zip'), concat('other/', p_partkey, '.CSV'), 1, p_brand FROM part WHERE p_type <> 'SMALL'""")
def scan_zip_member_rows(spark, sf_dir):
    rows = files.member_rows(files.scan_zip_members(_archives(spark, sf_dir)))
    data = rows.filter((F.col("row_number") > 0) & (F.size("fields") > 0))
    return data.withColumn("fields", F.concat_ws("|", "fields"))


@query("archives_without_members", "SELECT concat('part-', p_partkey, '.zip') AS path FROM part WHERE p_type = 'SMALL'")
def archives_without_members(spark, sf_dir):
    archives = _archives(spark, sf_dir)
    return files.archives_without_members(archives)


def _landing_files(spark, sf_dir):
    """Files about to land: one per discovered row, with their coverage and scope hints."""
    seq = F.col("seq")
    month = F.substring("publication_date", 1, 6)
    found = f_discovered(spark, sf_dir)
    return found.select(
        "source_url",
        landing_path(F.concat(F.lit("area/"), "dataset_id"), F.coalesce("publication_date", F.lit("x")), F.concat(F.lit("f"), seq, F.lit(".csv"))).alias("target_path"),
        F.concat(F.lit("area/"), "dataset_id").alias("path_prefix"),
        F.sha2("source_url", 256).alias("content_hash"),
        "publication_date",
        F.coalesce("publication_date", F.lit("x")).alias("downloaded_at"),
        F.lit("2024-01-01T00:00:00Z").alias("ingested_at"),
        F.col("dataset_id").alias("series_id"),
        "sub_dataset_id",
        F.lit("automated").alias("acquisition_method"),
        F.lit("").alias("fallback_reason"),
        F.concat(month, F.lit("01T000000")).alias("_SUBJECT_PERIOD_FROM"),
        F.concat(month, F.lit("28T235959")).alias("_SUBJECT_PERIOD_TO"),
        F.lit("single_month").alias("_SUBJECT_PERIOD_COVERAGE_TYPE"),
        F.lit("m").alias("_SUBJECT_PERIOD_INFERENCE_METHOD"),
        F.lit("s").alias("_SUBJECT_PERIOD_INFERENCE_SOURCE"),
        F.lit("high").alias("_SUBJECT_PERIOD_INFERENCE_CONFIDENCE"),
        F.lit("rolling").alias("duration_type"),
        F.when(seq % 3 != 0, 12).alias("duration_value"),
        F.when(seq % 3 != 0, "month").alias("duration_unit"),
        F.when(seq % 4 == 0, 4).alias("fiscal_year_start_month"),
        F.when(seq % 2 == 0, F.array(F.lit("month"), F.lit("region"))).otherwise(F.array().cast("array<string>")).alias("breakdown_granularity"),
        "etag",
        "last_modified",
    )


CTES["landed"] = """SELECT *, concat('download_year=', CASE WHEN publication_date IS NULL THEN 'unknown' ELSE substring(publication_date, 1, 4) END, '/download_month=', CASE WHEN publication_date IS NULL THEN 'unknown' ELSE substring(publication_date, 5, 2) END,
 '/downloaded_at=', coalesce(publication_date, 'x'), '/f', seq, '.csv') AS stage FROM f_discovered"""
REQUIRES["landed"] = ["f_discovered"]
_SIDECAR_SQL = with_ctes("landed") + """SELECT '1.0' AS "_CONTRACT_VERSION", coalesce(publication_date, 'x') AS "_DOWNLOADED_AT", '2024-01-01T00:00:00Z' AS "_INGESTED_AT", source_url AS "_SOURCE_FILE_PATH",
 concat('f', seq, '.csv') AS "_SOURCE_FILE_NAME", sha256(source_url) AS "_FILE_CONTENT_KEY", substring(publication_date, 1, 6) || '01T000000' AS "_SUBJECT_PERIOD_FROM", substring(publication_date, 1, 6) || '28T235959' AS "_SUBJECT_PERIOD_TO",
 'single_month' AS "_SUBJECT_PERIOD_COVERAGE_TYPE", 'm' AS "_SUBJECT_PERIOD_INFERENCE_METHOD", 's' AS "_SUBJECT_PERIOD_INFERENCE_SOURCE", 'high' AS "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE", 'rolling' AS "_FILE_SCOPE_DURATION_TYPE",
 CAST(CASE WHEN seq % 3 <> 0 THEN 12 END AS BIGINT) AS "_FILE_SCOPE_DURATION_VALUE", CASE WHEN seq % 3 <> 0 THEN 'month' ELSE '' END AS "_FILE_SCOPE_DURATION_UNIT", CAST(CASE WHEN seq % 4 = 0 THEN 4 END AS BIGINT) AS "_FILE_SCOPE_FISCAL_YEAR_START_MONTH",
 CASE WHEN seq % 2 = 0 THEN 'month,region' ELSE '' END AS "_BREAKDOWN_GRANULARITY", coalesce(publication_date, '') AS "_PUBLICATION_DATE", CASE WHEN publication_date IS NULL THEN 'none' ELSE 'scraped' END AS "_PUBLICATION_DATE_SOURCE",
 'automated' AS "_ACQUISITION_METHOD", '' AS "_FALLBACK_REASON", substring(sha256(source_url), 1, 16) AS "_LOAD_ID", dataset_id AS "_SERIES_ID", sub_dataset_id AS "_SUB_DATASET_ID", concat('area/', dataset_id, '/', stage) AS "_TARGET_PATH",
 stage AS "_PAYLOAD_STAGE_PATH", etag AS "_SOURCE_ETAG", last_modified AS "_SOURCE_LAST_MODIFIED" FROM landed"""


def _records(spark, sf_dir):
    # The test months lie before the default plausibility limit.
    return sinks.sidecar_records(_landing_files(spark, sf_dir), minimum_publication="19000101T000000")


@query("sink_sidecar", _SIDECAR_SQL)
def sink_sidecar(spark, sf_dir):
    path = scratch_path(spark, "sidecar")
    sinks.sink_sidecar(_records(spark, sf_dir), path)
    return files.scan_sidecar_json(spark, path)


@query("scan_sidecar_json", _SIDECAR_SQL)
def scan_sidecar_json(spark, sf_dir):
    """The documents again, with as many unreadable lines in between."""
    path = scratch_path(spark, "sidecar")
    sinks.sink_sidecar(_records(spark, sf_dir), path)
    table(spark, sf_dir, "orders").select(F.concat(F.lit('{"_CONTRACT_VERSION": '), "o_orderkey", F.lit(' "broken"')).alias("value")).write.mode("append").text(path)
    return files.scan_sidecar_json(spark, path)


@query("scan_sidecar_paths", _SIDECAR_SQL)
def scan_sidecar_paths(spark, sf_dir):
    records = _records(spark, sf_dir)
    return files.scan_sidecar_paths(records.select(F.to_json(F.struct(*records.columns)).alias("value"))).select(*SIDECAR_COLUMNS)


_EVENT_SQL = with_ctes("f_telemetry") + """SELECT "EVENT_TIMESTAMP_UTC", "RUN_ID", "STAGE", "STATUS", "ATTEMPT_NUMBER", "SERIES_ID", "SUB_DATASET_ID", "SOURCE_URL", "FILE_NAME", "LOAD_ID", "NORMALIZED_ROW_COUNT" FROM f_telemetry"""
_EVENT_NAMES = ["RUN_ID", "STAGE", "STATUS", "ATTEMPT_NUMBER", "SERIES_ID", "SUB_DATASET_ID", "SOURCE_URL", "FILE_NAME", "LOAD_ID", "NORMALIZED_ROW_COUNT"]


def _event_view(events):
    return events.select(F.col("EVENT_TIMESTAMP_UTC").cast("timestamp_ntz").alias("EVENT_TIMESTAMP_UTC"), *_EVENT_NAMES)


@query("scan_telemetry_jsonl", _EVENT_SQL)
def scan_telemetry_jsonl(spark, sf_dir):
    path = scratch_path(spark, "events")
    sinks.sink_telemetry(f_telemetry(spark, sf_dir), path)
    return _event_view(files.scan_telemetry_jsonl(spark, path))


@query("sink_telemetry", with_ctes("f_telemetry") + """SELECT concat('event_date=', strftime("EVENT_TIMESTAMP_UTC", '%Y%m%d'), '/run_id=', "RUN_ID") AS folder, count(*) AS events FROM f_telemetry GROUP BY 1""")
def sink_telemetry(spark, sf_dir):
    path = scratch_path(spark, "events")
    sinks.sink_telemetry(f_telemetry(spark, sf_dir), path)
    lines = spark.read.text(path)
    return lines.groupBy(F.concat(F.lit("event_date="), F.col("event_date").cast("string"), F.lit("/run_id="), "run_id").alias("folder")).agg(F.count("*").alias("events"))


@query("scan_manual_drop", """SELECT concat('manual/orders/', o_orderstatus, '/', strftime(o_orderdate, '%b%Y'), '-', o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '.csv' WHEN 1 THEN '.ZIP' WHEN 2 THEN '.ods' ELSE '.xlsx' END) AS source_url,
 strftime(o_orderdate, '%Y%m01T000000') AS publication_date, strftime(o_orderdate, '%Y%m') AS subject_period_hint, 'orders' AS series_id, 'all' AS sub_dataset_id FROM orders WHERE o_orderkey % 5 < 4""")
def scan_manual_drop(spark, sf_dir):
    key = F.col("o_orderkey") % 5
    suffix = F.when(key == 0, ".csv").when(key == 1, ".ZIP").when(key == 2, ".ods").when(key == 3, ".xlsx").otherwise(".pdf")
    name = F.concat(F.date_format("o_orderdate", "MMMyyyy"), F.lit("-"), "o_orderkey", suffix)
    listed = table(spark, sf_dir, "orders").select(F.concat(F.lit("manual/orders/"), "o_orderstatus", F.lit("/"), name).alias("source_url"))
    rules = [("link_text", r"([a-z]+\d{4})"), ("url_segment", r"/([a-z]{3}\d{4})-")]
    return files.manual_candidates(listed, "orders", "all", r"^([a-z]{3})(\d{4})", rules).drop("link_text")


@query("manual_drop_folder", """SELECT DISTINCT strftime(o_orderdate, '%b%Y') AS folder, strftime(o_orderdate, '%Y%m') AS subject_period_hint, 'orders' AS series_id, 'all' AS sub_dataset_id
FROM orders WHERE o_orderstatus <> 'P'""")
def manual_drop_folder(spark, sf_dir):
    """Files dropped by hand into one folder a month, listed from there; notes and other targets are not candidates."""
    path = scratch_path(spark, "manual")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("line"), "o_orderstatus", F.date_format("o_orderdate", "MMMyyyy").alias("drop")
    )
    noted = F.col("o_orderstatus") == "P"
    for folder, dropped, form in [
        ("orders/all", orders.filter(~noted), "csv"),
        ("orders/all/notes", orders.filter(noted), "text"),
        ("orders/other", orders.filter(noted), "csv"),
    ]:
        dropped.select("line", "drop").repartition("drop").write.partitionBy("drop").format(form).save(f"{path}/{folder}")
    listed = files.scan_manual_drop(spark, path, "orders", "all")
    found = files.manual_candidates(listed, "orders", "all", r"^([a-z]{3})(\d{4})", [("url_segment", r"/drop=([a-z]{3}\d{4})/")])
    folder = F.regexp_extract("source_url", "/drop=([^/]*)/", 1).alias("folder")
    return found.select(folder, "subject_period_hint", "series_id", "sub_dataset_id").distinct()


def _land(spark, sf_dir, path):
    """Land the ingest payload by month of the order."""
    stamped = _payload(spark, sf_dir).withColumn("downloaded_at", F.concat("Period", F.lit("01T000000")))
    sinks.sink_landing_partitions(stamped, path)


@query("sink_landing_partitions", with_ctes("f_ingest") + """SELECT substring("Period", 1, 4) AS download_year, substring("Period", 5, 2) AS download_month, "Period" || '01T000000' AS downloaded_at, count(*) AS rows, CAST(sum("OrderKey") AS BIGINT) AS keys FROM f_ingest GROUP BY 1, 2, 3""")
def sink_landing_partitions(spark, sf_dir):
    path = scratch_path(spark, "landing")
    _land(spark, sf_dir, path)
    schema = "Period string, OrderKey long, `Org Code` long, priorityClass string, `c-d` double, download_year string, download_month string, downloaded_at string"
    rows = spark.read.schema(schema).option("header", True).csv(path)
    return rows.groupBy("download_year", "download_month", "downloaded_at").agg(F.count("*").alias("rows"), F.sum("OrderKey").alias("keys"))


@query("scan_landed_files", with_ctes("f_ingest") + """SELECT DISTINCT concat('download_year=', substring("Period", 1, 4), '/download_month=', substring("Period", 5, 2), '/downloaded_at=', "Period", '01T000000') AS folder FROM f_ingest""")
def scan_landed_files(spark, sf_dir):
    path = scratch_path(spark, "landing")
    _land(spark, sf_dir, path)
    return files.scan_landed_files(spark, path).select(F.regexp_replace("relative_path", "/[^/]*$", "").alias("folder")).distinct()


def _listed_sidecar(spark, path):
    """Metadata for whatever files landed below ``path``."""
    landed = files.scan_landed_files(spark, path)
    stamp = F.regexp_extract("relative_path", "downloaded_at=([^/]*)", 1)
    return landed.select(
        F.concat(F.lit("/"), "relative_path").alias("_TARGET_PATH"),
        F.col("relative_path").alias("_PAYLOAD_STAGE_PATH"),
        F.when(F.substring(stamp, 6, 1).cast("int") % 2 == 0, "2024-01-01T00:00:00").alias("_INGESTED_AT"),
        F.lit("2024-03-01 06:00:00").alias("_DOWNLOADED_AT"),
        F.lit(None).cast("string").alias("_SOURCE_FILE_NAME"),
        content_hash(F.col("relative_path")).alias("_FILE_CONTENT_KEY"),
        F.lit("").alias("_ACQUISITION_METHOD"),
        F.lit(None).cast("string").alias("_FALLBACK_REASON"),
        F.lit("").alias("_LOAD_ID"),
    )


@query("load_metadata_columns", with_ctes("f_ingest") + """SELECT "Period", CASE WHEN CAST(substring("Period", 6, 1) AS INTEGER) % 2 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-03-01 06:00:00' END AS ingested_at, 'automated' AS method, '' AS reason,
 count(*) AS rows, CAST(sum("OrderKey") AS BIGINT) AS keys, true AS numbered, true AS identified FROM f_ingest GROUP BY 1, 2""")
def load_metadata_columns(spark, sf_dir):
    path = scratch_path(spark, "landing")
    _land(spark, sf_dir, path)
    rows = files.scan_csv_strings(spark, [path], PAYLOAD, positions=True)
    loaded = files.load_metadata_columns(rows, _listed_sidecar(spark, path), path)
    number = F.col("_FILE_ROW_NUMBER")
    per_file = loaded.groupBy(
        "Period", F.col("_INGESTED_AT").cast("timestamp_ntz").alias("ingested_at"), F.col("_ACQUISITION_METHOD").alias("method"), F.col("_FALLBACK_REASON").alias("reason"), "_SOURCE_FILE_PATH"
    ).agg(
        F.count("*").alias("n"), F.sum(F.col("OrderKey").cast("long")).alias("k"),
        ((F.min(number) == 1) & (F.max(number) == F.count("*")) & (F.count_distinct(number) == F.count("*"))).alias("numbered"),
        F.bool_and((F.col("_LOAD_ID") == F.substring("_FILE_CONTENT_KEY", 1, 16)) & F.col("_SOURCE_FILE_NAME").endswith(".csv")).alias("identified"),
    )
    return per_file.groupBy("Period", "ingested_at", "method", "reason").agg(
        F.sum("n").alias("rows"), F.sum("k").alias("keys"), F.bool_and("numbered").alias("numbered"), F.bool_and("identified").alias("identified")
    )


@query("ingest_default_columns", with_ctes("f_discovered") + """SELECT seq, CASE WHEN seq % 3 = 0 THEN TIMESTAMP '2024-03-01 06:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS "_INGESTED_AT", CASE WHEN seq % 2 = 0 THEN 'manual' ELSE 'automated' END AS "_ACQUISITION_METHOD",
 '' AS "_FALLBACK_REASON", CASE WHEN seq % 5 = 0 THEN 'given' ELSE substring(sha256(source_url), 1, 16) END AS "_LOAD_ID", concat('f', seq, '.csv') AS "_SOURCE_FILE_NAME" FROM f_discovered""")
def ingest_default_columns(spark, sf_dir):
    seq = F.col("seq")
    none = F.lit(None).cast("string")
    df = f_discovered(spark, sf_dir).select(
        "seq", F.when(seq % 3 != 0, "2024-01-01T00:00:00").alias("_INGESTED_AT"), F.lit("2024-03-01 06:00:00").alias("_DOWNLOADED_AT"), none.alias("_PAYLOAD_STAGE_PATH"), none.alias("_SOURCE_FILE_NAME"),
        F.sha2("source_url", 256).alias("_FILE_CONTENT_KEY"), F.when(seq % 2 == 0, "manual").otherwise("").alias("_ACQUISITION_METHOD"), none.alias("_FALLBACK_REASON"),
        F.when(seq % 5 == 0, "given").otherwise("").alias("_LOAD_ID"), F.concat(F.lit("f"), seq, F.lit(".csv")).alias(files.FILE_NAME),
    )
    out = files.ingest_default_columns(df).withColumn("_INGESTED_AT", F.col("_INGESTED_AT").cast("timestamp_ntz"))
    return out.select("seq", "_INGESTED_AT", "_ACQUISITION_METHOD", "_FALLBACK_REASON", "_LOAD_ID", "_SOURCE_FILE_NAME")


@query("file_row_number", "SELECT o_orderstatus, count(*) AS rows, true AS numbered FROM orders GROUP BY 1")
def file_row_number(spark, sf_dir):
    """Rows landed sorted by key: their number in the file must follow the key."""
    path = scratch_path(spark, "rows")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    orders.repartition("o_orderstatus").sortWithinPartitions("o_orderkey").write.csv(path, header=True)
    rows = files.scan_csv_strings(spark, [path], orders.columns, positions=True)
    numbered = files.file_row_number(rows)
    ends = numbered.groupBy(files.FILE_PATH).agg(
        F.min("_FILE_ROW_NUMBER").alias("low"), F.max("_FILE_ROW_NUMBER").alias("high"), F.count_distinct("_FILE_ROW_NUMBER").alias("n"),
        F.min(F.col("o_orderkey").cast("long")).alias("first_key"), F.min_by(F.col("o_orderkey").cast("long"), "_FILE_ROW_NUMBER").alias("at_first"),
        F.max(F.col("o_orderkey").cast("long")).alias("last_key"), F.max_by(F.col("o_orderkey").cast("long"), "_FILE_ROW_NUMBER").alias("at_last"),
    )
    good = (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("first_key") == F.col("at_first")) & (F.col("last_key") == F.col("at_last"))
    joined = numbered.join(ends.select(files.FILE_PATH, good.alias("good")), files.FILE_PATH)
    return joined.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.bool_and("good").alias("numbered"))


@query("file_row_number_parquet", "SELECT o_orderkey, row_number() OVER () AS \"_FILE_ROW_NUMBER\" FROM (SELECT o_orderkey FROM orders)")
def file_row_number_parquet(spark, sf_dir):
    return files.parquet_row_number(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "_FILE_ROW_NUMBER")


@query("skip_bad_files", """SELECT 'good' AS kind, o_orderkey, o_custkey FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT 'rejected', o_orderkey, NULL FROM orders WHERE o_orderkey % 10 = 0""")
def skip_bad_files(spark, sf_dir):
    path = scratch_path(spark, "bad")
    extra = F.when(F.col("o_orderkey") % 10 == 0, ",x,y").otherwise("")
    table(spark, sf_dir, "orders").select(F.concat("o_orderkey", F.lit(","), "o_custkey", extra).alias("value")).write.text(path)
    good, rejected = files.skip_bad_files(spark, [path], ["o_orderkey", "o_custkey"], header=False, glob="*.txt")
    kept = good.select(F.lit("good").alias("kind"), F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"))
    key = F.regexp_extract("record", r"^(\d+),", 1).cast("long").alias("o_orderkey")
    return kept.unionByName(rejected.select(F.lit("rejected").alias("kind"), key, F.lit(None).cast("long").alias("o_custkey")))


def _write_lines(lines, path, encoding="utf-8"):
    """(file, n, line) rows as one CSV file per ``file``, line by line as they are."""
    ordered = lines.repartition("file").sortWithinPartitions("file", "n").select("file", "line").write.partitionBy("file")
    raw = {"sep": "\u0001", "quote": "\u0000", "escape": "\u0000", "emptyValue": "", "encoding": encoding, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    ordered.options(**raw).csv(path)


# What is wrong with the files of each kind, and how many files there are of each.
_FILES_PER_KIND = 4
_KINDS = {
    "good": 'o_orderkey,o_custkey,note', "reordered": 'note,o_orderkey,o_custkey', "repeated": 'o_orderkey,o_custkey,note,Note,o_orderkey',
    "cut": 'o_orderkey,o_custkey,note', "latin": 'o_orderkey,o_custkey,note', "wide": 'o_orderkey,o_custkey,note', "short": 'o_orderkey,o_custkey,note', "blank": '',
}


def _land_files_with_faults(spark, sf_dir, path):
    """Orders in files of eight kinds: five of them have one faulty record, the last in the file, or no header."""
    n = len(_KINDS)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("p"))
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("o_orderkey") % n + 1).cast("int"))
    file = F.concat_ws("-", kind, (F.floor(F.col("o_orderkey") / n) % _FILES_PER_KIND).cast("string"))
    note = F.concat(F.lit('"'), F.col("p"), F.lit(', ""so""  "'))
    plain = F.concat_ws(",", "o_orderkey", "o_custkey", note)
    line = (
        F.when(kind == "reordered", F.concat_ws(",", note, "o_orderkey", "o_custkey"))
        .when(kind == "repeated", F.concat_ws(",", "o_orderkey", "o_custkey", note, F.lit("again"), F.col("o_orderkey") * 2))
        .when(kind == "blank", F.lit(""))
        .otherwise(plain)
    )
    rows = orders.select(file.alias("file"), kind.alias("kind"), F.lit(1).alias("part"), F.col("o_orderkey").alias("n"), line.alias("line"))
    each = rows.select("file", "kind").distinct()
    header = F.element_at(F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair]), F.col("kind"))
    fault = {"cut": '1,2,"no end', "latin": "1,2,\u00e9t\u00e9", "wide": "1,2,x,y", "short": "1,2"}
    faults = F.element_at(F.create_map(*[F.lit(x) for pair in fault.items() for x in pair]), F.col("kind"))
    heads = each.select("file", "kind", F.lit(0).alias("part"), F.lit(0).cast("long").alias("n"), header.alias("line"))
    tails = each.select("file", "kind", F.lit(2).alias("part"), F.lit(0).cast("long").alias("n"), faults.alias("line")).filter("line IS NOT NULL")
    lines = heads.unionByName(rows).unionByName(tails).select("file", "kind", F.struct("part", "n").alias("n"), "line")
    latin = F.col("kind") == "latin"
    _write_lines(lines.filter(~latin), f"{path}/utf8")
    _write_lines(lines.filter(latin), f"{path}/latin", "ISO-8859-1")


_FAULTS_SQL = """WITH k AS (SELECT o_orderkey, o_custkey, concat(o_orderpriority, ', "so"  ') AS note,
 ['good', 'reordered', 'repeated', 'cut', 'latin', 'wide', 'short', 'blank'][o_orderkey % 8 + 1] AS kind, (o_orderkey // 8) % 4 AS part FROM orders),
f AS (SELECT concat(kind, '-', part) AS file, kind, count(*) AS n FROM k GROUP BY 1, 2)
"""


@query("load_ledger", _FAULTS_SQL + """SELECT file, CASE WHEN kind IN ('good', 'reordered', 'repeated') THEN 'loaded' ELSE 'failed' END AS outcome, CASE WHEN kind IN ('good', 'reordered', 'repeated') THEN n ELSE 0 END AS row_count,
 CASE kind WHEN 'cut' THEN '1 lines with an unclosed quote' WHEN 'latin' THEN '1 lines are not utf-8' WHEN 'wide' THEN '1 records do not fit the header, first: 1,2,x,y' WHEN 'short' THEN '1 records do not fit the header, first: 1,2' WHEN 'blank' THEN 'no header' END AS error FROM f""")
def load_ledger(spark, sf_dir):
    """One outcome and one error per file; the files are of eight kinds."""
    path = scratch_path(spark, "faults")
    _land_files_with_faults(spark, sf_dir, path)
    _, ledger = files.load_isolated(spark, [path])
    return ledger.select(F.regexp_extract("file_path", "file=([^/]*)/", 1).alias("file"), "outcome", "row_count", "error")


@query("load_isolated", _FAULTS_SQL + """SELECT o_orderkey, o_custkey, note, CASE WHEN kind = 'repeated' THEN 'again' END AS "Note_1", CASE WHEN kind = 'repeated' THEN o_orderkey * 2 END AS "o_orderkey_1" FROM k WHERE kind IN ('good', 'reordered', 'repeated')
UNION ALL SELECT NULL, n, error, file, NULL FROM (SELECT file, 0 AS n, 'no header' AS error FROM f WHERE kind = 'blank')""")
def load_isolated(spark, sf_dir):
    """Rows of the files that load, by name, and the files without a header among those that fail."""
    path = scratch_path(spark, "faults")
    _land_files_with_faults(spark, sf_dir, path)
    rows, ledger = files.load_isolated(spark, [path])
    number = lambda c: F.col(c).cast("long").alias(c)
    loaded = rows.select(number("o_orderkey"), number("o_custkey"), "note", "Note_1", number("o_orderkey_1"))
    none = F.lit(None).cast("long")
    file = F.regexp_extract("file_path", "file=([^/]*)/", 1)
    failed = ledger.filter("error = 'no header'").select(none.alias("o_orderkey"), F.col("row_count").alias("o_custkey"), F.col("error").alias("note"), file.alias("Note_1"), none.alias("o_orderkey_1"))
    return loaded.unionByName(failed)


_BY_NAME = """SELECT o_orderkey AS a, o_custkey AS b, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS extra, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS c FROM orders"""


def _land_three_headers(spark, sf_dir, path):
    """The same rows in files whose columns are in another order, lack one, or have one more."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"), F.col("o_orderstatus").alias("c"), F.col("o_orderpriority").alias("extra")
    )
    for kind, header in enumerate((["b", "c", "a"], ["a", "b"], ["extra", "a", "c", "b"])):
        orders.filter(F.col("a") % 3 == kind).select(*header).write.csv(f"{path}/downloaded_at=2024010{kind + 1}/kind{kind}", header=True)


def _three_headers(rows):
    return rows.select(F.col("a").cast("long"), F.col("b").cast("long"), "extra", "c")


@query("scan_csv_by_name", _BY_NAME)
def scan_csv_by_name(spark, sf_dir):
    path = scratch_path(spark, "by-name")
    _land_three_headers(spark, sf_dir, path)
    return _three_headers(files.scan_csv_strings(spark, [path], ["a", "b", "c"]))


@query("stream_csv_by_name", _BY_NAME)
def stream_csv_by_name(spark, sf_dir):
    """The same files by the stream, with row numbers that must be whole in each file."""
    path, out, checkpoint = (scratch_path(spark, n) for n in ("by-name", "ingest", "checkpoint"))
    _land_three_headers(spark, sf_dir, path)
    nothing = lambda: spark.createDataFrame([], SIDECAR_SCHEMA)
    streams.run_available(streams.stream_ingest_csv(spark, path, ["a", "b", "c"], nothing, out, checkpoint))
    loaded = streams.read_ingest(spark, out)
    number = F.col("_FILE_ROW_NUMBER")
    whole = loaded.groupBy("_SOURCE_FILE_NAME").agg(
        ((F.min(number) == 1) & (F.max(number) == F.count("*")) & (F.count_distinct(number) == F.count("*"))).alias("whole")
    )
    return _three_headers(loaded.join(whole.filter("whole"), "_SOURCE_FILE_NAME"))


@query("archive_errors", "SELECT concat('part-', p_partkey, '.zip') AS path FROM part WHERE p_partkey % 7 = 0")
def archive_errors(spark, sf_dir):
    """Some archives have lost their end: each is a row, and the rest load."""
    broken = F.when(F.regexp_extract("path", r"(\d+)", 1).cast("long") % 7 == 0, F.expr("substr(content, 1, 20)")).otherwise(F.col("content"))
    return files.archive_errors(_archives(spark, sf_dir).withColumn("content", broken)).select("path")


@query("csv_row_count_files", with_ctes("f_ingest") + """SELECT "Period" AS period, count(*) AS row_count FROM f_ingest GROUP BY 1""")
def csv_row_count_files(spark, sf_dir):
    path = scratch_path(spark, "landing")
    _land(spark, sf_dir, path)
    listed = files.scan_landed_files(spark, path)
    rows = files.scan_csv_strings(spark, [path], PAYLOAD, positions=True).withColumnRenamed(files.FILE_PATH, "file_path")
    rows = rows.withColumn("file_path", files.relative_path(files.plain_path(F.col("file_path")), path))
    counts = agg_csv_row_count(rows, listed.select(F.col("relative_path").alias("file_path")))
    return counts.groupBy(F.regexp_extract("file_path", r"downloaded_at=(\d{6})", 1).alias("period")).agg(F.sum("row_count").alias("row_count"))


@query("sink_ingest_append", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'")
def sink_ingest_append(spark, sf_dir):
    path = scratch_path(spark, "ingest")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    sinks.sink_ingest_append(orders, path)
    sinks.sink_ingest_append(orders.filter(F.col("o_orderstatus") == "O"), path)
    return spark.read.parquet(path)


@query("sink_metadata_reload", with_ctes("f_sidecar") + """SELECT * FROM f_sidecar WHERE "_ACQUISITION_METHOD" = 'manual'""")
def sink_metadata_reload(spark, sf_dir):
    path = scratch_path(spark, "metadata")
    sidecar = f_sidecar(spark, sf_dir)
    sinks.sink_metadata_reload(sidecar, path)
    sinks.sink_metadata_reload(sidecar.filter(F.col("_ACQUISITION_METHOD") == "manual"), path)
    return spark.read.parquet(path)


def _stream_twice(spark, sf_dir):
    """Land one half, run, land the other half, run, run again with nothing new; returns the ingest table's path."""
    landing, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "ingest", "checkpoint"))
    stamped = _payload(spark, sf_dir).withColumn("downloaded_at", F.concat("Period", F.lit("01T000000")))
    early = F.col("Period").cast("int") % 2 == 0
    for part in (stamped.filter(early), stamped.filter(~early), None):
        if part is not None:
            sinks.sink_landing_partitions(part, landing)
        query_ = streams.stream_ingest_csv(spark, landing, PAYLOAD, lambda: _listed_sidecar(spark, landing), out, checkpoint)
        streams.run_available(query_)
    return out


@query("stream_ingest_csv", _PAYLOAD_SQL)
def stream_ingest_csv(spark, sf_dir):
    return _as_values(streams.read_ingest(spark, _stream_twice(spark, sf_dir)))


@query("stream_raw_dedup", with_ctes("f_ingest") + """SELECT "Period", count(*) AS rows FROM f_ingest GROUP BY 1""")
def stream_raw_dedup(spark, sf_dir):
    """The RAW view over what the stream appended, and appended once more as a repeated load."""
    path = _stream_twice(spark, sf_dir)
    loaded = streams.read_ingest(spark, path)
    again = loaded.withColumn("_INGESTED_AT", F.col("_INGESTED_AT") + F.expr("INTERVAL 1 DAY"))
    raw = revisions.raw_view(loaded.unionByName(again), f_sidecar(spark, sf_dir))
    return raw.groupBy("Period").agg(F.count("*").alias("rows"))


@query("stream_first_seen", "SELECT o_custkey FROM orders GROUP BY 1")
def stream_first_seen(spark, sf_dir):
    out, checkpoint = scratch_path(spark, "first"), scratch_path(spark, "checkpoint")
    orders = spark.readStream.schema(table(spark, sf_dir, "orders").schema).option("pathGlobFilter", "orders.parquet").parquet(sf_dir)
    first = streams.stream_first_seen(orders.select("o_custkey"), ["o_custkey"])
    writer = first.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    streams.run_available(writer.trigger(availableNow=True).start())
    return spark.read.parquet(out)


@query("stream_ingest_sidecar", _SIDECAR_SQL)
def stream_ingest_sidecar(spark, sf_dir):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("sidecar", "table", "checkpoint"))
    sinks.sink_sidecar(_records(spark, sf_dir), source)
    for _ in range(2):
        streams.run_available(streams.stream_ingest_sidecar(spark, source, out, checkpoint))
    return spark.read.parquet(out)


@query("stream_ingest_telemetry", _EVENT_SQL)
def stream_ingest_telemetry(spark, sf_dir):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("events", "table", "checkpoint"))
    sinks.sink_telemetry(f_telemetry(spark, sf_dir), source)
    streams.run_available(streams.stream_ingest_telemetry(spark, source, out, checkpoint))
    return _event_view(spark.read.parquet(out))


@query("stream_scheduled_run", "SELECT 1 AS run, count(*) AS rows FROM events WHERE event_type <> 'view' UNION ALL SELECT 2, 0 UNION ALL SELECT 3, count(*) FROM events WHERE event_type = 'view'")
def stream_scheduled_run(spark, sf_dir):
    """Three scheduled runs over a folder: everything so far, nothing new, what arrived since."""
    source, out, checkpoint = (scratch_path(spark, n) for n in ("drop", "table", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    runs = []
    for run, drop in enumerate([events.filter("event_type <> 'view'"), None, events.filter("event_type = 'view'")], start=1):
        if drop is not None:
            drop.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        # One checkpoint for all runs: what a run has read, a later one does not read again.
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, batch_id, run=run: batch.write.mode("overwrite").parquet(f"{out}/run={run}/batch={batch_id}")
        )
        streams.run_available(writer.trigger(availableNow=True).start())
        runs.append(run)
    counts = spark.read.schema("event_id long, run int, batch int").parquet(out).groupBy("run").agg(F.count("*").alias("n"))
    return spark.createDataFrame([(r,) for r in runs], "run int").join(counts, "run", "left").select("run", F.coalesce("n", F.lit(0).cast("long")).alias("rows"))


@query("drift_from_headers", _FAULTS_SQL + """SELECT file, CAST(0.25 AS DOUBLE) AS drift_ratio FROM f WHERE kind = 'repeated'""")
def drift_from_headers(spark, sf_dir):
    """Drift of landed files from the headers they have; names repeated in a header count once."""
    path = scratch_path(spark, "faults")
    _land_files_with_faults(spark, sf_dir, path)
    headers = files.scan_headers(spark, [path])
    actual = headers.select(F.regexp_extract("file_path", "file=([^/]*)/", 1).alias("file"), F.lit("ORDERS").alias("table_name"), F.col("columns").alias("actual_columns"))
    known = spark.createDataFrame([("ORDERS", ["o_orderkey", "o_custkey", "note"])], "table_name string, known_columns array<string>")
    return quality.drift_warnings(actual, known).select("file", F.round("drift_ratio", 9).alias("drift_ratio"))


@query("ingest_evolving", """SELECT o_orderkey AS id, o_orderstatus AS "Status", CASE WHEN o_orderkey % 4 = 1 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 4 IN (2, 3) THEN o_custkey END AS customer, CASE WHEN o_orderkey % 4 = 3 THEN year(o_orderdate) END AS year FROM orders""")
def ingest_evolving(spark, sf_dir):
    """Four generations of one table, each with other columns; the table's document has them all in order."""
    store = Store(spark, scratch_path(spark, "store"))
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    generations = [
        [key.alias("id"), status.alias("Status")],
        [F.col("o_orderpriority").alias("priority"), status.alias("STATUS"), key.alias("ID")],
        [key.alias("Id"), status.alias("status"), F.col("o_custkey").alias("customer")],
        [F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("CUSTOMER"), key.alias("id"), status.alias("Status")],
    ]
    for n, columns in enumerate(generations):
        change = store.change()
        change.append("INGEST", orders.filter(key % 4 == n).select(*columns))
        change.commit()
    return store.read("INGEST")


@query("refresh_atomic", with_ctes("f_sidecar") + """SELECT * FROM f_sidecar WHERE "_ACQUISITION_METHOD" = 'manual'""")
def refresh_atomic(spark, sf_dir):
    """A full refresh, another, and a third that fails half-way: the second stays, whole."""
    store = Store(spark, scratch_path(spark, "store"))
    sidecar = f_sidecar(spark, sf_dir)
    manual = sidecar.filter(F.col("_ACQUISITION_METHOD") == "manual")
    broken = sidecar.withColumn("_LOAD_ID", F.when(F.col("_LOAD_ID") > "8", F.raise_error(F.lit("lost"))).otherwise(F.col("_LOAD_ID")))
    for rows in (sidecar, manual, broken):
        change = store.change()
        try:
            change.replace("METADATA", rows)
        except PySparkException:
            continue
        change.commit()
    return store.read("METADATA")


@query("raw_maintained", with_ctes("raw") + "SELECT * FROM raw")
def raw_maintained(spark, sf_dir):
    """The RAW view over a table that takes loads in batches, late ones and one of them twice among them."""
    store = Store(spark, scratch_path(spark, "store"))
    ingest = f_ingest(spark, sf_dir)
    batch = F.pmod(F.xxhash64("_INGESTED_AT", "_FILE_CONTENT_KEY"), F.lit(3))
    for n in (2, 0, 1, 0):
        change = store.change()
        scheduled.merge_loads(change, ingest.filter(batch == n), buckets=16)
        change.commit()
    return scheduled.current_raw(store, f_sidecar(spark, sf_dir))


def _runs(spark, sf_dir):
    """A store after four scheduled runs over the orders' files: a third of them; all, of which some have new headers
    and some of those new contents, once ended on the way; and all again."""
    store = Store(spark, scratch_path(spark, "store"))
    customer = F.regexp_extract("source_url", r"/(\d+)\.", 1).cast("long")
    found = _landing_files(spark, sf_dir).withColumns(
        {"file_name": F.element_at(F.split("target_path", "/"), -1), "c": customer, "seq": F.regexp_extract("target_path", r"f(\d+)\.csv$", 1).cast("long")}
    )
    found = found.withColumn("content_hash", F.sha2(F.concat("source_url", "file_name"), 256)).drop("ingested_at")
    headers = {"etag": F.when(F.col("c") % 4 == 0, F.concat("etag", F.lit("x"))).otherwise(F.col("etag"))}
    headers |= {"last_modified": F.when(F.col("c") % 4 != 0, F.col("last_modified"))}
    headers |= {"content_hash": F.when(F.col("c") % 8 == 0, F.sha2("content_hash", 256)).otherwise(F.col("content_hash"))}
    later = found.withColumns(headers)
    rows = found.select("source_url", "file_name", F.explode(F.sequence(F.lit(1), (F.col("c") % 3 + 1).cast("int"))).alias("line"))

    def run(name, files_, at, into=store):
        return scheduled.scheduled_run(into, files_.drop("c", "seq"), rows, name, at, minimum_publication="19000101T000000")

    run("run-1", found.filter(F.col("seq") % 3 == 0), "2024-01-01T00:00:00Z")
    with contextlib.suppress(_Killed):
        run("run-3", later, "2024-01-03T00:00:00Z", _Fragile(spark, store.path))
    run("run-3", later, "2024-01-03T00:00:00Z")
    run("run-4", later, "2024-01-04T00:00:00Z")
    if run("run-3", later, "2024-01-05T00:00:00Z") is not None:
        raise AssertionError("a run that was committed ran again")
    return store


class _Killed(Exception):
    pass


class _Fragile(Store):
    """A store whose changes end between their second and third write."""

    def change(self):
        change, writes = super().change(), []
        append = change.append

        def dying(name, df):
            if len(writes) == 2:
                raise _Killed
            writes.append(name)
            return append(name, df)

        change.append = dying
        return change


CTES["runs"] = """SELECT *, CAST(regexp_extract(source_url, '/([0-9]+)[.]', 1) AS BIGINT) AS c, concat('f', seq, '.csv') AS file_name FROM f_discovered"""
REQUIRES["runs"] = ["f_discovered"]
CTES["decided"] = """SELECT *, seq % 3 = 0 AS before, c % 3 + 1 AS n,
 CASE WHEN source_url IN (SELECT source_url FROM runs WHERE seq % 3 = 0) AND c % 4 <> 0 THEN 'source_unchanged' WHEN seq % 3 = 0 AND c % 8 <> 0 THEN 'content_unchanged' ELSE 'landed' END AS again FROM runs"""
REQUIRES["decided"] = ["runs"]


@query("scheduled_run", with_ctes("decided") + """SELECT 'run-1' AS run, 'landed' AS outcome, count(*) AS files, CAST(sum(n) AS BIGINT) AS rows FROM decided WHERE before
UNION ALL SELECT 'run-3', again, count(*), CAST(sum(CASE WHEN again = 'landed' THEN n END) AS BIGINT) FROM decided GROUP BY again
UNION ALL SELECT 'run-4', 'skipped', count(*), NULL FROM decided
UNION ALL SELECT 'all', 'landing rows', NULL, CAST(sum(CASE WHEN before THEN n ELSE 0 END + CASE WHEN again = 'landed' THEN n ELSE 0 END) AS BIGINT) FROM decided
UNION ALL SELECT 'all', 'metadata records', CAST(sum(CAST(before AS INTEGER) + CAST(again = 'landed' AS INTEGER)) AS BIGINT), NULL FROM decided""")
def scheduled_run(spark, sf_dir):
    """What each run did by its events, and what is visible after all."""
    store = _runs(spark, sf_dir)
    outcome = F.when(F.col("SKIP_REASON").isNull(), "landed").when(F.col("RUN_ID") == "run-4", "skipped").otherwise(F.col("SKIP_REASON"))
    done = store.read(scheduled.EVENTS).groupBy(F.col("RUN_ID").alias("run"), outcome.alias("outcome")).agg(F.count("*").alias("files"), F.sum("NORMALIZED_ROW_COUNT").alias("rows"))
    none, every = F.lit(None).cast("long"), F.lit("all").alias("run")
    landed = store.read(scheduled.LANDING).agg(F.count("*").alias("rows")).select(every, F.lit("landing rows").alias("outcome"), none.alias("files"), "rows")
    records = store.read(scheduled.SIDECAR).agg(F.count("*").alias("files")).select(every, F.lit("metadata records").alias("outcome"), "files", none.alias("rows"))
    return done.unionByName(landed).unionByName(records)


@query("scheduled_run_parity", with_ctes("decided") + """, l AS (SELECT sha256(concat(source_url, file_name)) AS k, n FROM decided WHERE before UNION ALL SELECT CASE WHEN c % 8 = 0 THEN sha256(sha256(concat(source_url, file_name))) ELSE sha256(concat(source_url, file_name)) END, n FROM decided WHERE again = 'landed')
SELECT substring(k, 1, 16) AS load_id, n AS normalized_row_count, n AS loaded_row_count, true AS row_parity_pass FROM l""")
def scheduled_run_parity(spark, sf_dir):
    """Rows counted by the events of the runs against rows that are visible."""
    store = _runs(spark, sf_dir)
    counts = quality.agg_tagged_row_counts(store.read(scheduled.LANDING), F.lit("RAW_LANDING"))
    return quality.row_parity(store.read(scheduled.EVENTS), counts).select("load_id", "normalized_row_count", "loaded_row_count", "row_parity_pass")


@query("observed_upload_parity", """SELECT o_orderstatus AS sub_dataset_id, count(*) AS raw_row_count, CAST(sum(strlen(concat(o_orderkey, ',', o_orderpriority)) + 1) AS BIGINT) AS source_bytes,
 count(*) FILTER (o_orderkey % 10 <> 0) AS normalized_row_count, CAST(sum(strlen(concat(o_orderkey, ',', upper(o_orderpriority))) + 1) FILTER (o_orderkey % 10 <> 0) AS BIGINT) AS normalized_bytes,
 count(*) FILTER (o_orderkey % 10 <> 0) AS loaded_row_count, true AS row_parity_pass FROM orders GROUP BY 1""")
def observed_upload_parity(spark, sf_dir):
    """Upload events from what was counted while files were normalised and written, against what is loaded of them."""
    path = scratch_path(spark, "landing")
    orders = table(spark, sf_dir, "orders")
    events = []
    for status in "FOP":
        raw = orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderpriority")
        tidy = lambda df: df.filter(F.col("o_orderkey") % 10 != 0).withColumn("o_orderpriority", F.upper("o_orderpriority"))
        counts = sinks.write_counted(raw, tidy, lambda df, s=status: df.write.option("header", True).csv(f"{path}/{s}"))
        events.append(sinks.upload_event(spark, counts, run_id="run", load_id=f"load-{status}", series_id="orders", sub_dataset_id=status, at="2024-01-01T00:00:00Z"))
    staged = reduce(lambda a, b: a.unionByName(b), events)
    rows = files.scan_csv_strings(spark, [path], positions=True)
    counted = quality.agg_tagged_row_counts(rows.withColumn("_LOAD_ID", F.concat(F.lit("load-"), F.regexp_extract(files.FILE_PATH, "/([FOP])/[^/]*$", 1))), F.lit("RAW_ORDERS"))
    parity = quality.row_parity(staged, counted).select("sub_dataset_id", "normalized_row_count", "loaded_row_count", "row_parity_pass")
    told = staged.select(F.col("SUB_DATASET_ID").alias("sub_dataset_id"), F.col("RAW_ROW_COUNT").alias("raw_row_count"), F.col("SOURCE_BYTES").alias("source_bytes"), F.col("NORMALIZED_BYTES").alias("normalized_bytes"))
    return told.join(parity, "sub_dataset_id")


@query("stream_ingest_table", _PAYLOAD_SQL)
def stream_ingest_table(spark, sf_dir):
    """The stream of landed files into a table of a store, in three runs of which the last finds nothing."""
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    store = Store(spark, scratch_path(spark, "store"))
    stamped = _payload(spark, sf_dir).withColumn("downloaded_at", F.concat("Period", F.lit("01T000000")))
    early = F.col("Period").cast("int") % 2 == 0
    for part in (stamped.filter(early), stamped.filter(~early), None):
        if part is not None:
            sinks.sink_landing_partitions(part, landing)
        streams.run_available(streams.stream_ingest_table(spark, landing, PAYLOAD, lambda: _listed_sidecar(spark, landing), store, "INGEST", checkpoint))
    return _as_values(store.read("INGEST"))
