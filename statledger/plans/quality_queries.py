"""Discovery over pages, counts, parity, profiles, drift and inventories."""

from __future__ import annotations

from pyspark.sql import functions as F

from statledger.functions import html
from statledger.operators import discovery, inventory, quality, revisions, routing, shape, telemetry
from statledger.plans.fixtures import (
    CTES, REQUIRES, f_cells, f_ingest, f_inventory, f_sidecar, f_site, f_telemetry, table, with_ctes,
)
from statledger.plans.registry import query
from statledger.plans.revision_queries import raw_view
from statledger.schemas import EVENT_COLUMNS
from statledger.session import scratch_path
from statledger.sources.versions import Store

# Links the site input adds to every page, in page order, and the older ones before them.
CTES["site_links"] = """
SELECT page_url, position, href, link_text, CASE WHEN href LIKE '/%' THEN concat(regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1), href) ELSE href END AS link_url FROM (
SELECT l.page_url, l.position, l.href, l.link_text FROM links l JOIN site s ON s.url = l.page_url
UNION ALL SELECT s.url, CAST(coalesce(n.k, 0) AS INTEGER), s.next_url, concat('Release ', s.y) FROM site s LEFT JOIN (SELECT page_url, count(*) AS k FROM anchors GROUP BY 1) n ON n.page_url = s.url WHERE s.next_url IS NOT NULL
UNION ALL SELECT s.url, CAST(coalesce(n.k, 0) + CASE WHEN s.next_url IS NULL THEN 0 ELSE 1 END AS INTEGER), s.file_href, concat('Data ', s.mname, ' ', s.y) FROM site s LEFT JOIN (SELECT page_url, count(*) AS k FROM anchors GROUP BY 1) n ON n.page_url = s.url)"""
REQUIRES["site_links"] = ["links", "site"]

_RELEASE_STEP = discovery.LinkStep(text_filter=r"release \d{4}")
_FILE_STEP = discovery.LinkStep("a[href*='/files/']", r"data", ("csv",))


def _seeds(spark, sf_dir, name):
    return f_site(spark, sf_dir).select(F.col("url").alias(name))


_HOPS = """, hop1 AS (SELECT l.link_url AS page_url FROM site_links l JOIN site s ON s.url = l.page_url WHERE regexp_matches(l.link_text, '(?i)release [0-9]{4}')),
hop2 AS (SELECT l.* FROM site_links l JOIN hop1 USING (page_url) WHERE l.href LIKE '%/files/%' AND regexp_matches(l.link_text, '(?i)data') AND regexp_matches(lower(l.link_url), '[.]csv$'))"""


@query("link_hop_chain", with_ctes("site_links") + _HOPS + " SELECT page_url, position, href, link_text, link_url FROM hop2")
def link_hop_chain(spark, sf_dir):
    links = html.html_links(f_site(spark, sf_dir))
    return discovery.link_hop_chain(links, _seeds(spark, sf_dir, "page_url"), [_RELEASE_STEP, _FILE_STEP])


@query("discover_files", with_ctes("site_links") + _HOPS + """
SELECT h.page_url, h.link_url AS source_url, h.link_text, CASE WHEN s.m = 2 AND s.d > 28 THEN concat(s.y, '0201T000000') ELSE concat(s.y, lpad(CAST(s.m AS VARCHAR), 2, '0'), lpad(CAST(s.d AS VARCHAR), 2, '0'), 'T000000') END AS publication_date,
  concat(s.y, lpad(CAST(s.m AS VARCHAR), 2, '0')) AS subject_period_hint FROM hop2 h JOIN site s ON s.url = h.page_url""")
def discover_files(spark, sf_dir):
    found = discovery.discover_files(
        f_site(spark, sf_dir), _seeds(spark, sf_dir, "page_url"), [_RELEASE_STEP, _FILE_STEP],
        ("link_text", r"([a-z]+ \d{4})"), [("file_name", r"^([a-z]{3})[a-z]*(\d{4})-"), ("link_text", r"([a-z]+ \d{4})")],
    )
    return found.select("page_url", "source_url", "link_text", "publication_date", "subject_period_hint")


_ZIP_STEP = discovery.LinkStep("a[href*='/files/']", None, ("zip",))
_TARGET_RULES = {
    "releases": discovery.PageRule([_RELEASE_STEP, _FILE_STEP], ("link_text", r"([a-z]+ \d{4})"), [("file_name", r"^([a-z]{3})[a-z]*(\d{4})-")]),
    "archives": discovery.PageRule([_ZIP_STEP], ("link_text", r"([a-z]+ \d{4})"), [("link_text", r"([a-z]+ \d{4})")]),
    "siblings": discovery.PageRule([_FILE_STEP], ("link_text", r"([a-z]+ \d{4})"), siblings=True, sibling_text="^release", max_pages=2),
}
_TARGET_SEEDS = """t AS (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN 'releases' WHEN 1 THEN 'archives' ELSE 'siblings' END AS rule, concat('t', page_id % 7) AS sub_dataset_id FROM site)"""


@query("discover_targets", with_ctes("site_links") + ", " + _TARGET_SEEDS + """,
r AS (SELECT *, regexp_matches(link_text, '(?i)release [0-9]{4}') AS release, href LIKE '%/files/%' AND regexp_matches(link_text, '(?i)data') AND regexp_matches(lower(link_url), '[.]csv$') AS file, href LIKE '%/files/%' AND regexp_matches(lower(link_url), '[.]zip$') AS zip,
  regexp_replace(trim(link_url), '/+$', '') AS target FROM site_links),
b AS (SELECT t.page_id, t.sub_dataset_id, t.url AS seed, r.target, min(r.position) AS position FROM t JOIN r ON r.page_url = t.url
  WHERE t.rule = 'siblings' AND regexp_matches(r.link_text, '(?i)^release') AND r.target <> regexp_replace(t.url, '/+$', '') AND NOT regexp_matches(lower(r.target), '[.](csv|xlsx?|zip|xlsm|txt|json|xml|pdf|docx?|pptx?)($|[?])') GROUP BY 1, 2, 3, 4),
f AS (
  SELECT t.sub_dataset_id, t.rule, y.page_url, y.link_url, y.link_text FROM t JOIN r x ON x.page_url = t.url AND x.release JOIN r y ON y.page_url = x.link_url AND y.file WHERE t.rule = 'releases'
  UNION ALL SELECT t.sub_dataset_id, t.rule, y.page_url, y.link_url, y.link_text FROM t JOIN r y ON y.page_url = t.url AND y.zip WHERE t.rule = 'archives'
  UNION ALL SELECT t.sub_dataset_id, t.rule, y.page_url, y.link_url, y.link_text FROM t JOIN r y ON y.page_url = t.url AND y.file WHERE t.rule = 'siblings'
  UNION ALL SELECT b.sub_dataset_id, 'siblings', y.page_url, y.link_url, y.link_text FROM (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY sub_dataset_id, seed ORDER BY position, target) = 1) b JOIN r y ON y.page_url = b.target AND y.file)
SELECT sub_dataset_id, h.page_url, link_url AS source_url, link_text, concat(s.y, lpad(CAST(s.m AS VARCHAR), 2, '0'), lpad(CAST(s.d AS VARCHAR), 2, '0'), 'T000000') AS publication_date,
  max(CASE WHEN rule <> 'siblings' THEN concat(s.y, lpad(CAST(s.m AS VARCHAR), 2, '0')) END) AS subject_period_hint FROM f h JOIN site s ON s.url = h.page_url GROUP BY ALL""")
def discover_targets(spark, sf_dir):
    """Every page is a source page of one of seven targets, under one of three rules."""
    pages = f_site(spark, sf_dir)
    n = F.col("page_id") % 3
    rule = F.when(n == 0, "releases").when(n == 1, "archives").otherwise("siblings")
    # Rules that give a period come first, so that it does not depend on the order of pages.
    order = F.when(n == 2, 1).otherwise(0)
    seeds = pages.select(F.concat(F.lit("t"), F.col("page_id") % 7).alias("sub_dataset_id"), order.alias("source_order"), F.col("url").alias("page_url"), rule.alias("rule"))
    return discovery.discover_targets(pages, seeds, _TARGET_RULES).drop("source_order")


@query("sibling_pages", with_ctes("site_links") + r""", seeds AS (SELECT DISTINCT url AS seed_url FROM site),
c AS (SELECT s.seed_url, regexp_replace(trim(l.link_url), '/+$', '') AS page_url, l.position, l.link_text FROM site_links l JOIN seeds s ON s.seed_url = l.page_url),
k AS (SELECT seed_url, page_url, min(position) AS position FROM c WHERE NOT regexp_matches(lower(page_url), '\.(csv|xlsx?|zip|xlsm|txt|json|xml|pdf|docx?|pptx?)($|\?)')
  AND regexp_matches(page_url, '(?i)e') AND regexp_matches(link_text, '(?i)^[a-r]') AND page_url <> regexp_replace(seed_url, '/+$', '') GROUP BY 1, 2)
SELECT seed_url, seed_url AS page_url, 0 AS page_order FROM seeds
UNION ALL SELECT * FROM (SELECT seed_url, page_url, CAST(row_number() OVER (PARTITION BY seed_url ORDER BY position) AS INTEGER) AS page_order FROM k) WHERE page_order <= 3""")
def sibling_pages(spark, sf_dir):
    links = html.html_links(f_site(spark, sf_dir))
    return discovery.sibling_pages(links, _seeds(spark, sf_dir, "seed_url"), url_pattern="E", text_pattern="^[a-r]", max_pages=4)


@query("sibling_pages_by_period", with_ctes("site_links") + r""", seeds AS (SELECT DISTINCT url AS seed_url FROM site),
k AS (SELECT s.seed_url, regexp_replace(trim(l.link_url), '/+$', '') AS page_url, min(l.position) AS position FROM site_links l JOIN seeds s ON s.seed_url = l.page_url
  WHERE regexp_matches(l.link_text, '^Release 20') AND NOT regexp_matches(lower(l.link_url), '[.](csv|zip)$') GROUP BY 1, 2)
SELECT seed_url, seed_url AS page_url, 0 AS page_order FROM seeds UNION ALL SELECT seed_url, page_url, CAST(row_number() OVER (PARTITION BY seed_url ORDER BY position) AS INTEGER) FROM k""")
def sibling_pages_by_period(spark, sf_dir):
    return discovery.sibling_pages(html.html_links(f_site(spark, sf_dir)), _seeds(spark, sf_dir, "seed_url"))


@query("link_text_match", with_ctes("site_links") + r""", ex AS (SELECT page_url, link_url AS example_url, lower(regexp_extract(link_url, '([^/]*)$', 1)) AS tail FROM site_links WHERE href LIKE '/%'),
m AS (SELECT ex.page_url, ex.example_url, l.link_text, row_number() OVER (PARTITION BY ex.page_url, ex.example_url ORDER BY CASE WHEN lower(l.href) LIKE concat('%', ex.tail) AND l.link_text <> '' THEN 0 ELSE 1 END, l.position) AS rk
  FROM (SELECT DISTINCT * FROM ex) ex JOIN site_links l ON l.page_url = ex.page_url AND (suffix(lower(l.href), ex.tail) OR contains(lower(l.href), ex.tail)))
SELECT page_url, example_url, link_text FROM m WHERE rk = 1""")
def link_text_match(spark, sf_dir):
    links = html.html_links(f_site(spark, sf_dir))
    examples = links.filter(F.col("href").startswith("/")).select("page_url", F.col("link_url").alias("example_url")).distinct()
    return discovery.best_link_for_example(examples, links)


_SHEET_RULES = [routing.RouteRule("RAW", "area/raw", ["data [0-4]$"]), routing.RouteRule("OTHER", "area/other", ["^RAW", "cover 7"])]


@query("route_sheet_rules", with_ctes("f_cells") + """SELECT DISTINCT file, sheet, CASE WHEN regexp_matches(sheet, '(?i)data [0-4]$') THEN 'RAW' ELSE 'OTHER' END AS object_suffix,
  CASE WHEN regexp_matches(sheet, '(?i)data [0-4]$') THEN 'area/raw' ELSE 'area/other' END AS path_prefix FROM f_cells WHERE regexp_matches(sheet, '(?i)^raw|cover 7')""")
def route_sheet_rules(spark, sf_dir):
    sheets = f_cells(spark, sf_dir).select("file", "sheet").distinct()
    return routing.route_sheet_rules(sheets, _SHEET_RULES)


@query("unrouted_workbooks", with_ctes("f_cells") + """SELECT file FROM f_cells GROUP BY file HAVING count(CASE WHEN regexp_matches(sheet, 'data 2|data 4') THEN 1 END) = 0""")
def unrouted_workbooks(spark, sf_dir):
    sheets = f_cells(spark, sf_dir).select("file", "sheet").distinct()
    return routing.unrouted_workbooks(sheets, [routing.RouteRule("X", "x", ["data 2", "DATA 4"])])


CTES["counts"] = """SELECT concat('RAW_', upper("_ACQUISITION_METHOD")) AS raw_table_name, "_LOAD_ID" AS load_id, count(*) AS loaded_row_count FROM dedup WHERE "_LOAD_ID" IS NOT NULL GROUP BY 1, 2"""
CTES["normalized"] = """SELECT "LOAD_ID" AS load_id, "SERIES_ID" AS series_id, "SUB_DATASET_ID" AS sub_dataset_id, "SOURCE_URL" AS source_url, "FILE_NAME" AS file_name, max("NORMALIZED_ROW_COUNT") AS normalized_row_count, max("EVENT_TIMESTAMP_UTC") AS normalized_at
FROM f_telemetry WHERE "STAGE" = 'UPLOAD' AND "STATUS" = 'SUCCEEDED' AND "LOAD_ID" IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""
CTES["parity"] = """SELECT n.*, l.loaded_row_count, n.normalized_row_count = l.loaded_row_count AS row_parity_pass FROM normalized n LEFT JOIN (SELECT load_id, CAST(sum(loaded_row_count) AS BIGINT) AS loaded_row_count FROM counts GROUP BY 1) l USING (load_id)"""
REQUIRES.update({"counts": ["dedup"], "normalized": ["f_telemetry"], "parity": ["normalized", "counts"]})


@query("agg_loaded_row_counts", with_ctes("counts") + "SELECT * FROM counts")
def agg_loaded_row_counts(spark, sf_dir):
    """Loads are deduplicated once, and counted before any metadata is joined."""
    rows = revisions.dedup_latest_ingest(f_ingest(spark, sf_dir))
    return quality.agg_tagged_row_counts(rows, F.concat(F.lit("RAW_"), F.upper("_ACQUISITION_METHOD")))


@query("agg_loaded_by_load_id", with_ctes("counts") + "SELECT load_id, CAST(sum(loaded_row_count) AS BIGINT) AS loaded_row_count FROM counts GROUP BY 1")
def agg_loaded_by_load_id(spark, sf_dir):
    return quality.agg_loaded_by_load_id(agg_loaded_row_counts(spark, sf_dir))


@query("agg_normalize_events", with_ctes("normalized") + "SELECT * FROM normalized")
def agg_normalize_events(spark, sf_dir):
    return quality.agg_normalize_events(f_telemetry(spark, sf_dir))


@query("join_row_parity", with_ctes("parity") + "SELECT * EXCLUDE (row_parity_pass) FROM parity")
def join_row_parity(spark, sf_dir):
    return quality.join_row_parity(agg_normalize_events(spark, sf_dir), agg_loaded_by_load_id(spark, sf_dir))


@query("row_parity", with_ctes("parity") + "SELECT * FROM parity")
def row_parity(spark, sf_dir):
    return quality.row_parity(f_telemetry(spark, sf_dir), agg_loaded_row_counts(spark, sf_dir))


@query("check_row_parity_failures", with_ctes("parity") + "SELECT * FROM parity WHERE row_parity_pass = false")
def check_row_parity_failures(spark, sf_dir):
    return quality.check_row_parity_failures(row_parity(spark, sf_dir))


def _profile_sql(source: str, columns: list[str], name: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS raw_table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count("{c}") AS null_count,
        CASE WHEN count(*) > 0 THEN (count(*) - count("{c}")) / CAST(count(*) AS DOUBLE) END AS null_pct, count(DISTINCT "{c}") AS distinct_value_count FROM {source}"""
        for c in columns
    )


_LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query("column_profile", with_ctes("dedup") + _profile_sql("dedup", ["Period", "OrderKey", "Org Code", "priorityClass", "c-d"], "RAW_ORDERS"))
def column_profile(spark, sf_dir):
    return quality.column_profile(raw_view(spark, sf_dir), "RAW_ORDERS")


@query("column_profile_wide", _profile_sql("lineitem", _LINE_COLUMNS, "LINEITEM"))
def column_profile_wide(spark, sf_dir):
    return quality.column_profile(table(spark, sf_dir, "lineitem"), "LINEITEM")


def _within(profile, rows, error):
    """A profile with ``within`` in place of its distinct counts: whether they are that near those of the rows."""
    exact = quality.column_profile(rows, "LINEITEM").select("column_name", F.col("distinct_value_count").alias("exact"))
    near = F.abs(F.col("distinct_value_count") - F.col("exact")) <= error * F.col("exact")
    return profile.join(exact, "column_name").withColumn("within", near).drop("exact", "distinct_value_count")


@query("column_profile_approximate", "SELECT raw_table_name, column_name, row_count, null_count, null_pct, true AS within FROM (" + _profile_sql("lineitem", _LINE_COLUMNS, "LINEITEM") + ")")
def column_profile_approximate(spark, sf_dir):
    """All columns; the sketch is within a fifth of the exact count (its standard error is a twentieth)."""
    return _within(quality.column_profile(table(spark, sf_dir, "lineitem"), "LINEITEM", approximate=True), table(spark, sf_dir, "lineitem"), 0.2)


@query("column_profile_sketches", "SELECT raw_table_name, column_name, row_count, null_count, null_pct, true AS within FROM (" + _profile_sql("lineitem", _LINE_COLUMNS, "LINEITEM") + ")")
def column_profile_sketches(spark, sf_dir):
    """The profile of a table from the sketches stored with its loads, which come in two versions of the store."""
    store = Store(spark, scratch_path(spark, "store"))
    lines = table(spark, sf_dir, "lineitem").withColumn("_LOAD_ID", F.concat("l_returnflag", "l_linestatus"))
    for part in (F.col("l_linestatus") == "F", F.col("l_linestatus") != "F"):
        change = store.change()
        change.append("PROFILES", quality.profile_sketches(lines.filter(part)))
        change.commit()
    return _within(quality.profile_of_sketches(store.read("PROFILES"), "LINEITEM"), table(spark, sf_dir, "lineitem"), 0.05)


@query("check_profile_bounds", with_ctes("dedup") + "SELECT * FROM (" + _profile_sql("dedup", ["Period", "OrderKey", "Org Code", "priorityClass", "c-d"], "RAW_ORDERS") + ") WHERE null_pct > 0")
def check_profile_bounds(spark, sf_dir):
    """A profile whose null share was shifted out of bounds where there were NULLs."""
    profile = quality.column_profile(raw_view(spark, sf_dir), "RAW_ORDERS")
    shifted = profile.withColumn("null_pct", F.when(F.col("null_pct") > 0, F.col("null_pct") + 2).otherwise(F.col("null_pct")))
    return quality.check_profile_bounds(shifted).withColumn("null_pct", F.col("null_count") / F.col("row_count"))


@query("check_not_null", "SELECT 'event_type' AS column_name, count(*) - count(event_type) AS failing_rows FROM events UNION ALL SELECT 'k', count(CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 = 0 THEN 1 END) FROM events")
def check_not_null(spark, sf_dir):
    k = telemetry.json_get_path(F.col("props"), "$.k", "bigint")
    events = table(spark, sf_dir, "events").select("event_type", F.when(k % 5 != 0, k).alias("k"))
    return quality.check_not_null(events, ["event_type", "k"])


def _events(spark, sf_dir):
    """User events as run events of an event table: run = user, stage = type, status by key."""
    k = telemetry.json_get_path(F.col("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("event_timestamp_utc"), F.concat(F.lit("run-"), "user_id").alias("run_id"), F.upper("event_type").alias("stage"),
        F.when(k % 4 == 0, "FAILED").otherwise("SUCCEEDED").alias("status"), F.lit("1").alias("attempt_number"),
        F.when(k % 7 != 0, k.cast("string")).otherwise("x").alias("duration_ms"), F.lit("dropped").alias("execution_mode"),
    )


CTES["run_events"] = """SELECT ts AS "EVENT_TIMESTAMP_UTC", concat('run-', user_id) AS "RUN_ID", upper(event_type) AS "STAGE", CASE WHEN k % 4 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS "STATUS",
CAST(1 AS BIGINT) AS "ATTEMPT_NUMBER", CASE WHEN k % 7 <> 0 THEN k END AS "DURATION_MS" FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""


@query("telemetry_staging", with_ctes("run_events") + 'SELECT "EVENT_TIMESTAMP_UTC", "RUN_ID", "STAGE", "STATUS", "ATTEMPT_NUMBER", "DURATION_MS", ' + ", ".join(f'CAST(NULL AS {"BIGINT" if c in ("SOURCE_BYTES", "RAW_ROW_COUNT", "NORMALIZED_ROW_COUNT", "NORMALIZED_BYTES", "DISCOVERED_FILE_COUNT") else "VARCHAR"}) AS "{c}"' for c in EVENT_COLUMNS if c not in ("EVENT_TIMESTAMP_UTC", "RUN_ID", "STAGE", "STATUS", "ATTEMPT_NUMBER", "DURATION_MS")) + " FROM run_events")
def telemetry_staging(spark, sf_dir):
    staged = telemetry.telemetry_staging(telemetry.type_events(_events(spark, sf_dir)))
    return staged.withColumn("EVENT_TIMESTAMP_UTC", F.col("EVENT_TIMESTAMP_UTC").cast("timestamp_ntz"))


@query("agg_stage_metrics", with_ctes("run_events") + """SELECT "RUN_ID", "STAGE", "STATUS", count(*) AS event_count, CAST(sum("DURATION_MS") AS BIGINT) AS total_duration_ms, max("DURATION_MS") AS max_duration_ms, CAST(NULL AS BIGINT) AS discovered_file_count FROM run_events GROUP BY 1, 2, 3""")
def agg_stage_metrics(spark, sf_dir):
    return quality.agg_stage_metrics(telemetry.type_events(_events(spark, sf_dir)))


@query("agg_file_counts", with_ctes("f_ingest") + """SELECT series_id, sub_dataset_id, count(*) AS csv_file_count FROM (SELECT DISTINCT "_SOURCE_FILE_PATH", split_part("_SOURCE_FILE_PATH", '/', 1) AS series_id, split_part("_SOURCE_FILE_PATH", '/', 2) AS sub_dataset_id FROM f_ingest) GROUP BY 1, 2""")
def agg_file_counts(spark, sf_dir):
    files = f_ingest(spark, sf_dir).select(F.col("_SOURCE_FILE_PATH").alias("relative_path")).distinct()
    return quality.agg_file_counts(files)


@query("agg_distinct_sources", with_ctes("f_sidecar") + """SELECT count(DISTINCT nullif("_SOURCE_FILE_PATH", '')) AS sidecar_source_url_count FROM f_sidecar""")
def agg_distinct_sources(spark, sf_dir):
    return quality.agg_distinct_sources(f_sidecar(spark, sf_dir))


@query("agg_status_counts", """SELECT o_orderstatus AS status, count(*) AS rows FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def agg_status_counts(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    return quality.agg_status_counts(table(spark, sf_dir, "orders").select(status.alias("status")))


@query("agg_csv_row_count", """SELECT c_custkey AS customer, count(o_orderkey) AS row_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def agg_csv_row_count(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"))
    return quality.agg_csv_row_count(rows, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer")), "customer")


@query("agg_load_failures", with_ctes("f_telemetry") + """SELECT count(*) AS failure_count, count(DISTINCT "SUB_DATASET_ID") AS failed_table_count FROM f_telemetry WHERE "STATUS" = 'FAILED'""")
def agg_load_failures(spark, sf_dir):
    failed = f_telemetry(spark, sf_dir).filter(F.col("STATUS") == "FAILED").withColumn("table_name", F.col("SUB_DATASET_ID"))
    return quality.agg_load_failures(failed)


@query("agg_inventory_rollup", with_ctes("f_inventory") + r""", s AS (SELECT DISTINCT dataset_name, sub_dataset_id, target_file, extension FROM f_inventory WHERE target_file IS NOT NULL),
e AS (SELECT dataset_name, arg_min(parent_link, seq) AS entry_url FROM f_inventory WHERE parent_link IS NOT NULL GROUP BY 1),
u AS (SELECT dataset_name, sub_dataset_id, arg_min(sub_link, seq) AS sub_url FROM f_inventory WHERE sub_link IS NOT NULL GROUP BY 1, 2)
SELECT trim(regexp_replace(lower(s.dataset_name), '[^a-z0-9]+', '-', 'g'), '-') AS dataset_id, s.dataset_name, e.entry_url, s.sub_dataset_id,
  concat(upper(trim(regexp_replace(s.dataset_name, '[^A-Za-z0-9]+', '_', 'g'), '_')), '_', upper(regexp_replace(s.sub_dataset_id, '[^A-Za-z0-9]+', '_', 'g'))) AS object_name_suffix,
  concat(trim(regexp_replace(lower(s.dataset_name), '[^a-z0-9]+', '-', 'g'), '-'), '/', s.sub_dataset_id) AS path_prefix, coalesce(u.sub_url, '') AS sample_subpage_url, count(*) AS sample_count,
  coalesce(string_agg(DISTINCT nullif(s.extension, ''), ',' ORDER BY nullif(s.extension, '')), '') AS include_extensions
FROM s JOIN e USING (dataset_name) LEFT JOIN u USING (dataset_name, sub_dataset_id) GROUP BY ALL""")
def agg_inventory_rollup(spark, sf_dir):
    rollup = inventory.agg_inventory_rollup(f_inventory(spark, sf_dir))
    return rollup.withColumn("include_extensions", F.concat_ws(",", "include_extensions"))


@query("inventory_samples", with_ctes("f_inventory") + """SELECT dataset_name, sub_dataset_id, target_file AS file_url, min(seq) AS seq, arg_min(note, seq) AS notes FROM f_inventory WHERE target_file IS NOT NULL GROUP BY 1, 2, 3""")
def inventory_samples(spark, sf_dir):
    return inventory.inventory_samples(f_inventory(spark, sf_dir))


_KNOWN = ["ColA", "ColB", "ColC"]


@query("drift_warnings", """WITH h AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN ['ColA', 'ColB', 'ColC'] WHEN 1 THEN ['ColA', 'ColX'] WHEN 2 THEN ['cola', 'ColB', 'ColC', p_brand] ELSE ['ColA', 'ColB', 'ColC', 'ColD'] END AS a FROM part WHERE p_type <> 'SMALL')
SELECT p_partkey, round(1.0 - len(list_intersect(a, ['ColA', 'ColB', 'ColC'])) / len(list_distinct(list_concat(a, ['ColA', 'ColB', 'ColC']))), 9) AS drift_ratio FROM h WHERE p_partkey % 4 <> 0""")
def drift_warnings(spark, sf_dir):
    key = F.col("p_partkey") % 4
    names = lambda *n: F.array(*[F.lit(x) for x in n])
    actual = (
        F.when(key == 0, names(*_KNOWN))
        .when(key == 1, names("ColA", "ColX"))
        .when(key == 2, F.array(F.lit("cola"), F.lit("ColB"), F.lit("ColC"), F.col("p_brand")))
        .otherwise(names(*_KNOWN, "ColD"))
    )
    parts = table(spark, sf_dir, "part")
    headers = parts.select("p_partkey", F.col("p_type").alias("table_name"), actual.alias("actual_columns"))
    known = parts.filter(F.col("p_type") != "SMALL").select(F.col("p_type").alias("table_name")).distinct().withColumn("known_columns", names(*_KNOWN))
    return quality.drift_warnings(headers, known).select("p_partkey", F.round("drift_ratio", 9).alias("drift_ratio"))


@query("verification_report", with_ctes("raw") + """, f AS (SELECT DISTINCT "_SOURCE_FILE_PATH" AS p FROM f_ingest), c AS (SELECT (SELECT count(*) FROM f) AS files, (SELECT count(*) FROM f_sidecar) AS sides)
SELECT 'csv_file_count' AS metric, '' AS subject, files AS value FROM c UNION ALL SELECT 'sidecar_file_count', '', sides FROM c
UNION ALL SELECT 'sidecar_source_url_count', '', count(DISTINCT "_SOURCE_FILE_PATH") FROM f_sidecar
UNION ALL SELECT 'schema_drift_warning_count', '', count(*) FROM part WHERE p_partkey % 4 <> 0 AND p_type <> 'SMALL'
UNION ALL SELECT 'csv_without_sidecar_possible', '', CAST(files > sides AS BIGINT) FROM c UNION ALL SELECT 'sidecar_without_csv_possible', '', CAST(sides > files AS BIGINT) FROM c
UNION ALL SELECT 'csv_files', concat(split_part(p, '/', 1), '/', split_part(p, '/', 2)), count(*) FROM f GROUP BY 2
UNION ALL SELECT 'table_rows', 'RAW_ORDERS', count(*) FROM raw UNION ALL SELECT 'table_columns', 'RAW_ORDERS', 27
UNION ALL SELECT 'table_rows', 'INGEST_ORDERS', count(*) FROM f_ingest UNION ALL SELECT 'table_columns', 'INGEST_ORDERS', 13""")
def verification_report(spark, sf_dir):
    ingest = f_ingest(spark, sf_dir)
    files = ingest.select(F.col("_SOURCE_FILE_PATH").alias("relative_path")).distinct()
    tables = {"RAW_ORDERS": raw_view(spark, sf_dir), "INGEST_ORDERS": ingest}
    return quality.verification_report(files, f_sidecar(spark, sf_dir), drift_warnings(spark, sf_dir), tables)


@query("verification_report_paths", with_ctes("f_ingest", "f_sidecar") + """, p AS (SELECT "_SOURCE_FILE_PATH" AS path, count(*) AS n FROM f_ingest GROUP BY 1)
SELECT 'csv_file_count' AS metric, '' AS subject, CAST(sum(n) AS BIGINT) AS value FROM p UNION ALL SELECT 'csv_file_path_count', '', count(*) FROM p
UNION ALL SELECT * FROM (SELECT 'csv_path_sample', path, n FROM p ORDER BY path LIMIT 25)""")
def verification_report_paths(spark, sf_dir):
    """The report's counts of CSV paths, listed once per loaded row, and its first 25."""
    listed = f_ingest(spark, sf_dir).select(F.col("_SOURCE_FILE_PATH").alias("relative_path"))
    none = listed.limit(0)
    report = quality.verification_report(listed, f_sidecar(spark, sf_dir), none, {}, path_sample=25)
    return report.filter(F.col("metric").isin("csv_file_count", "csv_file_path_count", "csv_path_sample"))


@query("schema_evolve_union", """SELECT o_orderkey AS id, o_orderstatus AS "Status", CAST(NULL AS VARCHAR) AS priority FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 <> 0""")
def schema_evolve_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    older = orders.filter(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("Status"))
    newer = orders.filter(F.col("o_orderkey") % 2 != 0).select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("STATUS"), F.col("o_orderkey").alias("id")
    )
    return shape.schema_evolve_union([older, newer])


@query("match_columns_by_name", 'SELECT o_orderkey AS "OrderKey", o_orderstatus AS "STATUS", CAST(NULL AS VARCHAR) AS "Missing", o_custkey AS extra FROM orders')
def match_columns_by_name(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("extra"), F.col("o_orderstatus").alias("Status"), F.col("o_orderkey").alias("ORDERKEY")
    )
    return shape.match_columns_by_name(df, ["OrderKey", "STATUS", "Missing"])


@query("union_all_tables", "SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT c_name, 'customer' FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier")
def union_all_tables(spark, sf_dir):
    frames = {
        t: table(spark, sf_dir, t).select(F.col(c).alias("name"), F.lit(t).alias("kind"))
        for t, c in {"nation": "n_name", "customer": "c_name", "supplier": "s_name"}.items()
    }
    return shape.union_all_tables(frames, next(iter(frames.values())).schema, spark)


