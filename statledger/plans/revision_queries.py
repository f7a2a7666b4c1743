"""Windows, joins and compositions from loads to current revisions, and the change comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from statledger.operators import changes, discovery, ordering, revisions, shape
from statledger.plans.fixtures import f_cells, f_discovered, f_ingest, f_sidecar, f_wide, table, with_ctes
from statledger.plans.registry import query

VOLATILE = "_LOADED_AT"


@query("dedup_latest_ingest", with_ctes("dedup") + "SELECT * FROM dedup")
def dedup_latest_ingest(spark, sf_dir):
    return revisions.dedup_latest_ingest(f_ingest(spark, sf_dir))


@query("join_sidecar_left", with_ctes("joined") + "SELECT * FROM joined")
def join_sidecar_left(spark, sf_dir):
    return revisions.join_sidecar_left(revisions.dedup_latest_ingest(f_ingest(spark, sf_dir)), f_sidecar(spark, sf_dir))


@query("coalesce_sidecar_defaults", with_ctes("raw") + """SELECT "_FILE_CONTENT_KEY", "_FILE_ROW_NUMBER", "_SUBJECT_PERIOD_FROM", "_SUBJECT_PERIOD_COVERAGE_TYPE",
  "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE", "_FILE_SCOPE_DURATION_VALUE", "_PUBLICATION_DATE", "_PUBLICATION_DATE_SOURCE" FROM raw""")
def coalesce_sidecar_defaults(spark, sf_dir):
    joined = join_sidecar_left(spark, sf_dir)
    return revisions.coalesce_sidecar_defaults(joined).select(
        "_FILE_CONTENT_KEY", "_FILE_ROW_NUMBER", "_SUBJECT_PERIOD_FROM", "_SUBJECT_PERIOD_COVERAGE_TYPE",
        "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE", "_FILE_SCOPE_DURATION_VALUE", "_PUBLICATION_DATE", "_PUBLICATION_DATE_SOURCE",
    )


@query("raw_view", with_ctes("raw") + "SELECT * FROM raw")
def raw_view(spark, sf_dir):
    revisions.raw_view(f_ingest(spark, sf_dir), f_sidecar(spark, sf_dir), "RAW_ORDERS")
    return spark.table("RAW_ORDERS")


@query("project_exclude", with_ctes("f_ingest") + """SELECT * EXCLUDE ("c-d", "priorityClass") FROM f_ingest""")
def project_exclude(spark, sf_dir):
    return shape.project_exclude(f_ingest(spark, sf_dir), "c-d", "priorityClass")


@query("presentation_select", with_ctes("presentation") + "SELECT * FROM presentation")
def presentation_select(spark, sf_dir):
    return revisions.presentation_select(raw_view(spark, sf_dir)).drop(VOLATILE)


@query("presentation_select_strict", with_ctes("presentation") + """SELECT * FROM presentation WHERE "_SUBJECT_PERIOD_FROM" <> '' AND "_SUBJECT_PERIOD_TO" <> ''""")
def presentation_select_strict(spark, sf_dir):
    return revisions.presentation_select(raw_view(spark, sf_dir), strict=True).drop(VOLATILE)


@query("distinct_file_periods", with_ctes("presentation") + """SELECT DISTINCT "_SOURCE_FILE_NAME", "_SOURCE_FILE_PATH", "_INGESTED_AT", "PERIOD", "_PUBLICATION_DATE" FROM presentation""")
def distinct_file_periods(spark, sf_dir):
    return revisions.distinct_file_periods(presentation_select(spark, sf_dir), ["PERIOD"])


@query("publication_rank", with_ctes("ranks") + "SELECT * FROM ranks")
def publication_rank(spark, sf_dir):
    return revisions.publication_rank(presentation_select(spark, sf_dir), ["PERIOD"])


@query("publication_rank_subject_period", with_ctes("presentation") + """
SELECT *, CAST(row_number() OVER (PARTITION BY "_SUBJECT_PERIOD_FROM", "_SUBJECT_PERIOD_TO" ORDER BY "_PUBLICATION_DATE" DESC NULLS LAST, "_INGESTED_AT" DESC,
  "_SOURCE_FILE_PATH" DESC, "_SOURCE_FILE_NAME" DESC) AS BIGINT) AS "_PUBLICATION_RANK"
FROM (SELECT DISTINCT "_SOURCE_FILE_NAME", "_SOURCE_FILE_PATH", "_INGESTED_AT", "_SUBJECT_PERIOD_FROM", "_SUBJECT_PERIOD_TO", "_PUBLICATION_DATE" FROM presentation)""")
def publication_rank_subject_period(spark, sf_dir):
    return revisions.publication_rank(presentation_select(spark, sf_dir))


@query("join_current_revision", with_ctes("ranks") + """SELECT p.* FROM presentation p JOIN ranks r ON p."_SOURCE_FILE_NAME" = r."_SOURCE_FILE_NAME"
  AND p."_SOURCE_FILE_PATH" = r."_SOURCE_FILE_PATH" AND p."_INGESTED_AT" = r."_INGESTED_AT" AND p."PERIOD" = r."PERIOD" WHERE r."_PUBLICATION_RANK" = 1""")
def join_current_revision(spark, sf_dir):
    presentation = presentation_select(spark, sf_dir)
    return revisions.join_current_revision(presentation, revisions.publication_rank(presentation, ["PERIOD"]), ["PERIOD"])


@query("current_revision", with_ctes("ranks") + """SELECT p.* FROM presentation p JOIN ranks r ON p."_SOURCE_FILE_NAME" = r."_SOURCE_FILE_NAME"
  AND p."_SOURCE_FILE_PATH" = r."_SOURCE_FILE_PATH" AND p."_INGESTED_AT" = r."_INGESTED_AT" AND p."PERIOD" = r."PERIOD" WHERE r."_PUBLICATION_RANK" = 1""")
def current_revision(spark, sf_dir):
    """Flagship: the rows of the current publication of every reporting period."""
    return revisions.current_revision(raw_view(spark, sf_dir), ["PERIOD"]).drop(VOLATILE)


@query("revision_rank_full", with_ctes("raw") + """
SELECT *, CAST(row_number() OVER (PARTITION BY "Period" ORDER BY CASE WHEN "_PUBLICATION_DATE" <> '' THEN 1 ELSE 0 END DESC, "_PUBLICATION_DATE" DESC,
  CASE WHEN "_SUBJECT_PERIOD_TO" <> '' THEN 1 ELSE 0 END DESC, "_SUBJECT_PERIOD_TO" DESC, "_DOWNLOADED_AT" DESC, "_INGESTED_AT" DESC, "_SOURCE_FILE_PATH" DESC) AS BIGINT) AS "_REVISION_RANK"
FROM (SELECT DISTINCT "Period", "_PUBLICATION_DATE", "_SUBJECT_PERIOD_TO", "_DOWNLOADED_AT", "_INGESTED_AT", "_SOURCE_FILE_PATH" FROM raw)""")
def revision_rank_full(spark, sf_dir):
    files = raw_view(spark, sf_dir).select(
        "Period", "_PUBLICATION_DATE", "_SUBJECT_PERIOD_TO", "_DOWNLOADED_AT", "_INGESTED_AT", "_SOURCE_FILE_PATH"
    )
    return revisions.revision_rank_full(files.distinct(), ["Period"])


@query("join_max_publication_simple", with_ctes("presentation") + """
SELECT p.* FROM presentation p JOIN (SELECT "PERIOD", max("_PUBLICATION_DATE") AS mp FROM presentation GROUP BY "PERIOD") m
ON p."PERIOD" = m."PERIOD" AND p."_PUBLICATION_DATE" = m.mp""")
def join_max_publication_simple(spark, sf_dir):
    return revisions.join_max_publication_simple(presentation_select(spark, sf_dir), ["PERIOD"])


_SIDE = """, side AS (SELECT source_url AS "_SOURCE_FILE_PATH", concat('f', seq % 3, '.csv') AS "_SOURCE_FILE_NAME", content_hash AS "_FILE_CONTENT_KEY",
  publication_date AS "_INGESTED_AT", concat('e', seq % 40) AS "_SOURCE_ETAG", concat('m', seq % 30) AS "_SOURCE_LAST_MODIFIED" FROM f_discovered WHERE dataset_id <> 'P')"""


def _side(spark, sf_dir):
    """Earlier loads: metadata records of the discovered files of two datasets, several per URL."""
    return f_discovered(spark, sf_dir).filter(F.col("dataset_id") != "P").select(
        F.col("source_url").alias("_SOURCE_FILE_PATH"),
        F.concat(F.lit("f"), F.col("seq") % 3, F.lit(".csv")).alias("_SOURCE_FILE_NAME"),
        F.col("content_hash").alias("_FILE_CONTENT_KEY"),
        F.col("publication_date").alias("_INGESTED_AT"),
        F.concat(F.lit("e"), F.col("seq") % 40).alias("_SOURCE_ETAG"),
        F.concat(F.lit("m"), F.col("seq") % 30).alias("_SOURCE_LAST_MODIFIED"),
        F.col("seq"),
    )


@query("latest_sidecar_record", with_ctes("f_sidecar") + """SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY "_SOURCE_FILE_PATH", "_SOURCE_FILE_NAME"
  ORDER BY coalesce("_INGESTED_AT", '') DESC, "_FILE_CONTENT_KEY" DESC) AS rk FROM f_sidecar) WHERE rk = 1""")
def latest_sidecar_record(spark, sf_dir):
    return changes.latest_sidecar_record(f_sidecar(spark, sf_dir), by_file_name=True)


@query("anti_unchanged_headers", with_ctes("f_discovered") + _SIDE + """, latest AS (SELECT "_SOURCE_FILE_PATH", max("_SOURCE_ETAG") AS e, max("_SOURCE_LAST_MODIFIED") AS lm FROM (
  SELECT *, row_number() OVER (PARTITION BY "_SOURCE_FILE_PATH" ORDER BY coalesce("_INGESTED_AT", '') DESC, "_FILE_CONTENT_KEY" DESC, "_SOURCE_ETAG" DESC, "_SOURCE_LAST_MODIFIED" DESC) AS rk FROM side) WHERE rk = 1 GROUP BY 1)
SELECT d.* FROM f_discovered d LEFT JOIN latest l ON d.source_url = l."_SOURCE_FILE_PATH"
WHERE NOT (coalesce(d.etag <> '' AND d.etag = l.e, false) OR coalesce(d.last_modified <> '' AND d.last_modified = l.lm, false))""")
def anti_unchanged_headers(spark, sf_dir):
    return changes.anti_unchanged_headers(
        f_discovered(spark, sf_dir), _side(spark, sf_dir), tiebreak=["_FILE_CONTENT_KEY", "_SOURCE_ETAG", "_SOURCE_LAST_MODIFIED"]
    )


@query("anti_unchanged_content", with_ctes("f_discovered") + _SIDE + """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "_SOURCE_FILE_PATH", "_SOURCE_FILE_NAME"
  ORDER BY coalesce("_INGESTED_AT", '') DESC, "_FILE_CONTENT_KEY" DESC) AS rk FROM side) WHERE rk = 1)
SELECT d.source_url, d.seq, d.content_hash FROM f_discovered d WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l."_SOURCE_FILE_PATH" = d.source_url
  AND l."_SOURCE_FILE_NAME" = concat('f', d.seq % 3, '.csv') AND l."_FILE_CONTENT_KEY" = d.content_hash)""")
def anti_unchanged_content(spark, sf_dir):
    files = f_discovered(spark, sf_dir).withColumn("file_name", F.concat(F.lit("f"), F.col("seq") % 3, F.lit(".csv")))
    return changes.anti_unchanged_content(files, _side(spark, sf_dir)).select("source_url", "seq", "content_hash")


@query("anti_unchanged_content_manual", with_ctes("f_discovered") + _SIDE + """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "_SOURCE_FILE_PATH"
  ORDER BY coalesce("_INGESTED_AT", '') DESC, "_FILE_CONTENT_KEY" DESC) AS rk FROM side) WHERE rk = 1)
SELECT d.source_url, d.seq, d.content_hash FROM f_discovered d WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l."_SOURCE_FILE_PATH" = d.source_url AND l."_FILE_CONTENT_KEY" = d.content_hash)""")
def anti_unchanged_content_manual(spark, sf_dir):
    found = changes.anti_unchanged_content(f_discovered(spark, sf_dir), _side(spark, sf_dir), by_file_name=False)
    return found.select("source_url", "seq", "content_hash")


@query("anti_missing_targets", """SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)""")
def anti_missing_targets(spark, sf_dir):
    targets = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey").distinct()
    found = table(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 8000).select(F.col("s_nationkey").alias("c_nationkey"))
    return changes.anti_missing_targets(targets, found, "c_nationkey")


@query("sidecar_index_join", with_ctes("f_sidecar") + """SELECT f.file_path, s."_FILE_CONTENT_KEY", s."_LOAD_ID", s."_PUBLICATION_DATE"
FROM (SELECT DISTINCT concat('/landing/', "_SOURCE_FILE_PATH", '/') AS file_path FROM f_ingest) f LEFT JOIN f_sidecar s ON trim(f.file_path, '/') = trim(s."_TARGET_PATH", '/')""")
def sidecar_index_join(spark, sf_dir):
    files = f_ingest(spark, sf_dir).select(F.concat(F.lit("/landing/"), "_SOURCE_FILE_PATH", F.lit("/")).alias("file_path")).distinct()
    joined = changes.sidecar_index_join(files, f_sidecar(spark, sf_dir))
    return joined.select("file_path", "_FILE_CONTENT_KEY", "_LOAD_ID", "_PUBLICATION_DATE")


@query("files_without_sidecar", with_ctes("f_sidecar") + """, f AS (SELECT DISTINCT concat('landing/', "_SOURCE_FILE_PATH", CASE WHEN "Period" = '199606' THEN '.moved' ELSE '' END) AS path FROM f_ingest),
s AS (SELECT DISTINCT "_TARGET_PATH" AS path FROM f_sidecar)
SELECT path, 'file_without_sidecar' AS problem FROM f WHERE path NOT IN (SELECT path FROM s)
UNION ALL SELECT path, 'sidecar_without_file' FROM s WHERE path NOT IN (SELECT path FROM f)""")
def files_without_sidecar(spark, sf_dir):
    moved = F.when(F.col("Period") == "199606", ".moved").otherwise("")
    files = f_ingest(spark, sf_dir).select(F.concat(F.lit("landing/"), "_SOURCE_FILE_PATH", moved).alias("file_path"))
    return changes.files_without_sidecar(files, f_sidecar(spark, sf_dir))


@query("dedup_discovered", with_ctes("f_discovered") + r"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY sub_dataset_id, regexp_replace(trim(source_url), '/+$', '') ORDER BY seq) AS rk FROM f_discovered) WHERE rk = 1""")
def dedup_discovered(spark, sf_dir):
    return discovery.dedup_discovered(f_discovered(spark, sf_dir))


_CAPPED = """, t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, sub_dataset_id ORDER BY coalesce(publication_date, '') DESC, source_url DESC, seq) AS tr FROM f_discovered) WHERE tr <= 7),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY coalesce(publication_date, '') DESC, source_url DESC, seq) AS dr FROM t) WHERE dr <= 20)"""


@query("topk_per_group_then_global", with_ctes("f_discovered") + _CAPPED + """, b AS (SELECT dataset_id, dataset_order, count(*) AS n FROM g GROUP BY 1, 2),
k AS (SELECT dataset_id, least(n, greatest(0, 45 - coalesce(sum(n) OVER (ORDER BY dataset_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS kept FROM b)
SELECT g.* EXCLUDE (tr, dr) FROM g JOIN k USING (dataset_id) WHERE g.dr <= k.kept""")
def topk_per_group_then_global(spark, sf_dir):
    return discovery.cap_discovered(f_discovered(spark, sf_dir), target_limit=7, dataset_limit=20, total_limit=45)


@query("running_total_budget", with_ctes("f_discovered") + """, b AS (SELECT sub_dataset_id, min(seq) AS dataset_order, count(*) AS eligible FROM f_discovered GROUP BY 1)
SELECT sub_dataset_id, dataset_order, eligible, CAST(least(eligible, greatest(0, (SELECT count(*) // 2 FROM f_discovered) - coalesce(sum(eligible) OVER (ORDER BY dataset_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS kept FROM b""")
def running_total_budget(spark, sf_dir):
    found = f_discovered(spark, sf_dir)
    eligible = found.groupBy("sub_dataset_id").agg(F.min("seq").alias("dataset_order"), F.count("*").alias("eligible"))
    half = found.agg(F.floor(F.count("*") / 2).alias("half"))
    # One row beside all: the budget as a column.
    return discovery.budget_by_dataset(eligible.join(F.broadcast(half)), F.col("half")).drop("half")


@query("sort_newest_first", with_ctes("f_discovered") + "SELECT seq, publication_date, source_url FROM f_discovered ORDER BY coalesce(publication_date, '') DESC, source_url DESC")
def sort_newest_first(spark, sf_dir):
    return ordering.sort_newest_first(f_discovered(spark, sf_dir).select("seq", "publication_date", "source_url"))


@query("limit_sample", with_ctes("f_discovered") + "SELECT source_url FROM f_discovered ORDER BY source_url LIMIT 25")
def limit_sample(spark, sf_dir):
    return ordering.limit_sample(f_discovered(spark, sf_dir), "source_url")


@query("filter_include_exclude", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def filter_include_exclude(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").withColumn("o_custkey", F.col("c_custkey"))
    return discovery.filter_include_exclude(
        orders, "o_custkey", customers.filter(F.col("c_acctbal") > 0), customers.filter(F.col("c_mktsegment") == "BUILDING")
    )


_NAMED = """SELECT d.file, d.sheet, CAST(d."row" - 2 AS INTEGER) AS "row", CAST(d.col AS INTEGER) AS col, h.value AS column_name, d.value
FROM f_cells d LEFT JOIN (SELECT file, sheet, col, value FROM f_cells WHERE "row" = 2) h ON d.file = h.file AND d.sheet = h.sheet AND d.col = h.col
WHERE d.col >= 2 AND d."row" > 2"""


@query("sheet_start_cell", with_ctes("f_cells") + _NAMED)
def sheet_start_cell(spark, sf_dir):
    return shape.sheet_start_cell(f_cells(spark, sf_dir), "B2")


@query("sheet_cells_to_table", with_ctes("f_cells") + """SELECT file, sheet, "row", max(CASE WHEN column_name = 'N' THEN value END) AS "N", max(CASE WHEN column_name = 'O' THEN value END) AS "O" FROM (SELECT * FROM (
WITH h AS (SELECT file, sheet, col, value AS column_name FROM f_cells WHERE "row" = 1)
SELECT d.file, d.sheet, CAST(d."row" - 1 AS INTEGER) AS "row", h.column_name, d.value FROM f_cells d LEFT JOIN h USING (file, sheet, col) WHERE d."row" > 1)) GROUP BY 1, 2, 3""")
def sheet_cells_to_table(spark, sf_dir):
    return shape.cells_to_table(shape.sheet_start_cell(f_cells(spark, sf_dir), None), ["N", "O"])


@query("sheet_select_named", with_ctes("f_cells") + """SELECT f_cells.* FROM f_cells JOIN (SELECT file, min(sheet_index) AS sheet_index FROM f_cells GROUP BY file) USING (file, sheet_index)""")
def sheet_select_named(spark, sf_dir):
    return shape.sheet_select_named(f_cells(spark, sf_dir))


@query("unpivot_wide", with_ctes("f_wide") + """SELECT org_code, k AS reporting_period, v AS value FROM (SELECT org_code, CAST(y1996 AS VARCHAR) AS y1996, CAST(y1997 AS VARCHAR) AS y1997, CAST(y1998 AS VARCHAR) AS y1998 FROM f_wide)
UNPIVOT INCLUDE NULLS (v FOR k IN (y1996, y1997, y1998))""")
def unpivot_wide(spark, sf_dir):
    return shape.unpivot_wide(f_wide(spark, sf_dir), ["org_code"], "reporting_period")
