"""Scalar functions over dates, text, URLs and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from statledger.functions import dates, html, paths, periods, text, urls
from statledger.functions.text import MONTHS
from statledger.operators import discovery, quality, routing, shape, telemetry
from statledger.plans.fixtures import CTES, f_date_text, f_discovered, f_ingest, f_inventory, f_site, table, with_ctes
from statledger.plans.registry import query
from statledger.sources import sinks

_MONTHS = str([m.capitalize() for m in MONTHS])
# Compact ISO value each text shape of the date input must give.
CTES["dates"] = """
SELECT *, CASE WHEN shape IN (0, 1, 2, 7) THEN concat(y, lpad(CAST(m AS VARCHAR), 2, '0'), lpad(CAST(d AS VARCHAR), 2, '0'), 'T000000')
  WHEN shape IN (3, 4, 6) THEN concat(y, lpad(CAST(m AS VARCHAR), 2, '0'), '01T000000') WHEN shape = 5 THEN NULL
  WHEN shape = 8 THEN concat(y, lpad(CAST(m AS VARCHAR), 2, '0'), lpad(CAST(d AS VARCHAR), 2, '0'), 'T103000')
  WHEN shape = 9 THEN concat(y, lpad(CAST(m AS VARCHAR), 2, '0'), lpad(CAST(d AS VARCHAR), 2, '0'), 'T235907')
  WHEN m IN (1, 3, 5, 7, 8, 10, 12) THEN concat(y, lpad(CAST(m AS VARCHAR), 2, '0'), '31T000000') END AS iso
FROM (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d, o_orderkey % 11 AS shape FROM orders)"""


@query("normalize_datetime", with_ctes("dates") + "SELECT o_orderkey, iso FROM dates")
def normalize_datetime(spark, sf_dir):
    return f_date_text(spark, sf_dir).select("o_orderkey", dates.normalize_datetime(F.col("text_value")).alias("iso"))


@query("normalize_datetime_spaces", with_ctes("dates") + "SELECT o_orderkey, iso FROM dates")
def normalize_datetime_spaces(spark, sf_dir):
    """The same texts with no-break, thin and ideographic spaces."""
    spaces = F.element_at(F.array(*[F.lit(c) for c in "\u00a0\u2009\u3000"]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    spaced = F.concat(spaces, F.replace(F.col("text_value"), F.lit(" "), spaces), spaces)
    return f_date_text(spark, sf_dir).select("o_orderkey", dates.normalize_datetime(spaced).alias("iso"))


@query("subject_period_yyyymm", with_ctes("dates") + "SELECT o_orderkey, substring(iso, 1, 6) AS period FROM dates")
def subject_period_yyyymm(spark, sf_dir):
    return f_date_text(spark, sf_dir).select("o_orderkey", dates.subject_period_yyyymm(F.col("text_value")).alias("period"))


@query("fiscal_month_date", with_ctes("dates") + "SELECT o_orderkey, CASE WHEN shape = 6 THEN iso END AS iso FROM dates")
def fiscal_month_date(spark, sf_dir):
    return f_date_text(spark, sf_dir).select("o_orderkey", dates.fiscal_month_date(F.col("text_value")).alias("iso"))


@query("compact_month_date", with_ctes("dates") + "SELECT o_orderkey, CASE WHEN shape = 4 OR (shape = 3 AND m = 5) THEN iso END AS iso FROM dates")
def compact_month_date(spark, sf_dir):
    return f_date_text(spark, sf_dir).select("o_orderkey", dates.compact_month_date(F.col("text_value")).alias("iso"))


@query("strip_ordinals", f"""SELECT o_orderkey, concat(day(o_orderdate), ' ', {_MONTHS}[month(o_orderdate)]) AS plain FROM orders""")
def strip_ordinals(spark, sf_dir):
    day = F.dayofmonth("o_orderdate")
    suffix = F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "RD").otherwise("th")
    written = F.concat(day, suffix, F.date_format("o_orderdate", " MMMM"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.strip_ordinals(written).alias("plain"))


@query("collapse_whitespace", r"""SELECT doc_id, trim(regexp_replace(text, '[ \t\n\v\f\r]+', ' ', 'g')) AS text FROM documents""")
def collapse_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.collapse_whitespace(F.col("text")).alias("text"))


@query("extract_by_pattern", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y%m%dT000000') END AS iso FROM orders""")
def extract_by_pattern(spark, sf_dir):
    part = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("latest")
    url = F.concat(F.lit("https://example.test/"), part, F.lit("/file.csv"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.extract_by_pattern(url, r"/(\d{4}-\d{2}-\d{2})/").alias("iso"))


@query("extract_by_selectors", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y%m%dT000000') ELSE strftime(o_orderdate, '%Y%m01T000000') END AS iso FROM orders""")
def extract_by_selectors(spark, sf_dir):
    page = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "'Updated on 'yyyy-MM-dd")).otherwise(
        F.date_format("o_orderdate", "'figures for 'MMMM yyyy' and more'")
    )
    selectors = [r"updated on (\d{4}-\d{2}-\d{2})", r"figures for ([a-z]+ \d{4})"]
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.extract_by_selectors(page, selectors).alias("iso"))


@query("extract_page_publication", with_ctes("site") + """SELECT page_id, concat(y, lpad(CAST(m AS VARCHAR), 2, '0'), lpad(CAST(d AS VARCHAR), 2, '0'), 'T000000') AS published
FROM site WHERE NOT (m = 2 AND d > 28)""")
def extract_page_publication(spark, sf_dir):
    pages = f_site(spark, sf_dir)
    return pages.select("page_id", dates.extract_page_publication(html.html_page_text(F.col("html"))).alias("published"))


@query("publication_date_choice", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '20240515T000000' ELSE strftime(o_orderdate, '%Y%m01T000000') END AS publication FROM orders""")
def publication_date_choice(spark, sf_dir):
    page = F.when(F.col("o_orderkey") % 3 == 0, "20240515T000000")
    link = F.date_format("o_orderdate", "'Data for 'MMMM yyyy")
    chosen = dates.publication_date_choice(page, link, F.lit("https://example.test/x.csv"), "link_text", r"([a-z]+ \d{4})")
    return table(spark, sf_dir, "orders").select("o_orderkey", chosen.alias("publication"))


@query("subject_period_rules", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y%m') ELSE NULL END AS period FROM orders""")
def subject_period_rules(spark, sf_dir):
    third = F.col("o_orderkey") % 3
    name = F.when(third == 0, F.lower(F.date_format("o_orderdate", "'x_'MMMyyyy'.csv'"))).otherwise("x.csv")
    link = F.when(third == 1, F.date_format("o_orderdate", "MMMM yyyy")).otherwise("no period")
    rules = [("file_name", r"_([a-z]{3}\d{4})\."), ("link_text", r"([a-z]+ \d{4})")]
    url = F.concat(F.lit("https://example.test/"), name)
    found = dates.subject_period_rules(rules, link, url, F.lit(""), urls.url_filename(url))
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("period"))


@query("filter_plausible_publication", with_ctes("f_discovered") + """SELECT seq, CASE WHEN publication_date >= '19980601T000000' THEN publication_date ELSE '' END AS publication FROM f_discovered""")
def filter_plausible_publication(spark, sf_dir):
    return f_discovered(spark, sf_dir).select("seq", dates.plausible_publication(F.col("publication_date"), "19980601T000000").alias("publication"))


@query("publication_source_flag", with_ctes("f_discovered") + """SELECT seq, CASE WHEN publication_date <> '' THEN 'scraped' ELSE 'none' END AS flag FROM f_discovered""")
def publication_source_flag(spark, sf_dir):
    return f_discovered(spark, sf_dir).select("seq", dates.publication_source_flag(F.col("publication_date")).alias("flag"))


_TWO = "strftime(o_orderdate, '%Y%m') AS a, strftime(o_orderdate + INTERVAL 65 DAY, '%Y%m') AS b"


@query("month_tokens", f"""SELECT o_orderkey, concat(a, ',', b) AS months FROM (SELECT o_orderkey, {_TWO} FROM orders)""")
def month_tokens(spark, sf_dir):
    later = F.expr("o_orderdate + INTERVAL 65 DAYS")
    written = F.concat(F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" to "), F.lower(F.date_format(later, "MMM")), F.lit("-"), F.date_format(later, "yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(",", periods.month_tokens(written).cast("array<string>")).alias("months"))


@query("month_bounds", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m01T000000') AS month_from, strftime(last_day(o_orderdate), '%Y%m%dT235959') AS month_to FROM orders""")
def month_bounds(spark, sf_dir):
    month = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", periods.month_start(month).alias("month_from"), periods.month_end(month).alias("month_to"))


_COVERAGE = ["period_from", "period_to", "coverage_type", "method", "source", "confidence"]


def _coverage(df, column):
    return df.select("o_orderkey", *[F.col(column)[c].alias(a) for c, a in zip(periods.COVERAGE_COLUMNS, _COVERAGE)])


@query("coverage_single_or_range", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m01T000000') AS period_from,
  strftime(last_day(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 65 DAY ELSE o_orderdate END), '%Y%m%dT235959') AS period_to,
  CASE WHEN o_orderkey % 2 = 0 THEN 'month_range' ELSE 'single_month' END AS coverage_type, CASE WHEN o_orderkey % 2 = 0 THEN 'range_from_link_text' ELSE 'single_month_from_link_text' END AS method,
  'link_text' AS source, CASE WHEN o_orderkey % 2 = 0 THEN 'medium' ELSE 'high' END AS confidence FROM orders""")
def coverage_single_or_range(spark, sf_dir):
    later = F.when(F.col("o_orderkey") % 2 == 0, F.expr("o_orderdate + INTERVAL 65 DAYS")).otherwise(F.col("o_orderdate"))
    short = F.when(F.year("o_orderdate") >= 2000, F.date_format("o_orderdate", "MMMyy")).otherwise(F.date_format("o_orderdate", "MMMyyyy"))
    written = F.concat(F.date_format(later, "MMMM yyyy"), F.lit(" from "), short)
    tokens = periods.month_tokens(written)
    return _coverage(table(spark, sf_dir, "orders").withColumn("t", tokens).withColumn("c", periods.coverage_single_or_range(F.col("t"), F.lit("link_text"))), "c")


@query("coverage_yyyymm_hint", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y%m01T000000') END AS period_from,
  CASE WHEN o_orderkey % 4 <> 0 THEN strftime(last_day(o_orderdate), '%Y%m%dT235959') END AS period_to, CASE WHEN o_orderkey % 4 <> 0 THEN 'single_month' END AS coverage_type,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'subject_period_rule_yyyymm' END AS method, CASE WHEN o_orderkey % 4 <> 0 THEN 'subject_period_hint' END AS source,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'high' END AS confidence FROM orders""")
def coverage_yyyymm_hint(spark, sf_dir):
    hint = F.when(F.col("o_orderkey") % 4 == 0, "202613").otherwise(F.date_format("o_orderdate", "yyyyMM"))
    return _coverage(table(spark, sf_dir, "orders").withColumn("c", periods.coverage_yyyymm_hint(hint)), "c")


@query("coverage_ytd", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN concat(CASE WHEN month(o_orderdate) >= 4 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END, '0401T000000') ELSE concat(year(o_orderdate), '0101T000000') END AS period_from,
  strftime(last_day(o_orderdate), '%Y%m%dT235959') AS period_to, CASE WHEN o_orderkey % 2 = 0 THEN 'fiscal_ytd' ELSE 'calendar_ytd' END AS coverage_type,
  CASE WHEN o_orderkey % 2 = 0 THEN 'fiscal_ytd_from_link_text' ELSE 'calendar_ytd_from_link_text' END AS method, 'link_text' AS source, 'medium' AS confidence FROM orders""")
def coverage_ytd(spark, sf_dir):
    written = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "Fiscal YTD ").otherwise("Year to date "), F.date_format("o_orderdate", "MMMM yyyy"))
    df = table(spark, sf_dir, "orders").withColumn("w", written).withColumn("t", periods.month_tokens(F.col("w")))
    return _coverage(df.withColumn("c", periods.coverage_ytd(F.col("w"), F.col("t"), F.lit("link_text"), F.lit(4))), "c")


@query("coverage_rolling_12", """SELECT o_orderkey, strftime(o_orderdate - INTERVAL 11 MONTH, '%Y%m01T000000') AS period_from, strftime(last_day(o_orderdate), '%Y%m%dT235959') AS period_to,
  'rolling_12_month' AS coverage_type, 'rolling_12_from_link_text' AS method, 'link_text' AS source, 'medium' AS confidence FROM orders""")
def coverage_rolling_12(spark, sf_dir):
    written = F.date_format("o_orderdate", "'Rolling 12 months to 'MMMM yyyy")
    df = table(spark, sf_dir, "orders").withColumn("w", written).withColumn("t", periods.month_tokens(F.col("w")))
    return _coverage(df.withColumn("c", periods.coverage_rolling_12(F.col("w"), F.col("t"), F.lit("link_text"))), "c")


@query("coverage_daily", with_ctes("dates") + """SELECT o_orderkey, concat(substring(iso, 1, 8), 'T000000') AS period_from, concat(substring(iso, 1, 8), 'T235959') AS period_to, 'daily' AS coverage_type,
  'daily_from_link_text' AS method, 'link_text' AS source, 'low' AS confidence FROM dates WHERE iso IS NOT NULL""")
def coverage_daily(spark, sf_dir):
    df = f_date_text(spark, sf_dir).withColumn("c", periods.coverage_daily(F.col("text_value"), F.lit("link_text")))
    return _coverage(df.filter(F.col("c").isNotNull()), "c")


_MB = "strftime(o_orderdate, '%Y%m01T000000')"
_ME = "strftime(last_day(o_orderdate), '%Y%m%dT235959')"


@query("infer_period_coverage", f"""SELECT o_orderkey, CASE k WHEN 5 THEN '' WHEN 4 THEN strftime(o_orderdate, '%Y%m%dT000000') WHEN 3 THEN concat(year(o_orderdate), '0101T000000') WHEN 2 THEN strftime(o_orderdate - INTERVAL 11 MONTH, '%Y%m01T000000') ELSE {_MB} END AS "_SUBJECT_PERIOD_FROM",
  CASE k WHEN 5 THEN '' WHEN 4 THEN strftime(o_orderdate, '%Y%m%dT235959') ELSE {_ME} END AS "_SUBJECT_PERIOD_TO",
  ['single_month', 'single_month', 'rolling_12_month', 'calendar_ytd', 'daily', 'unknown'][k + 1] AS "_SUBJECT_PERIOD_COVERAGE_TYPE",
  ['subject_period_rule_yyyymm', 'single_month_from_file_name', 'rolling_12_from_link_text', 'calendar_ytd_from_page_text', 'daily_from_link_text', 'not_inferred'][k + 1] AS "_SUBJECT_PERIOD_INFERENCE_METHOD",
  ['subject_period_hint', 'file_name', 'link_text', 'page_text', 'link_text', 'none'][k + 1] AS "_SUBJECT_PERIOD_INFERENCE_SOURCE",
  ['high', 'high', 'medium', 'medium', 'low', 'low'][k + 1] AS "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE" FROM (SELECT *, o_orderkey % 6 AS k FROM orders)""")
def infer_period_coverage(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    month = F.date_format("o_orderdate", "MMMM yyyy")
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(k == 0, F.date_format("o_orderdate", "yyyyMM")).alias("hint"),
        F.when(k == 2, F.concat(F.lit("Rolling 12 months to "), month)).when(k == 4, F.date_format("o_orderdate", "d MMM yyyy 10:30")).otherwise("Data").alias("link"),
        F.when(k == 1, F.concat(F.lit("https://example.test/"), F.date_format("o_orderdate", "MMM-yyyy"), F.lit(".csv"))).otherwise("https://example.test/data.csv").alias("url"),
        F.when(k == 3, F.concat(F.lit("Figures YTD "), month)).otherwise("Page").alias("page"),
    )
    # A dated link text carries a month as well: written with an underscore it is a day, not a month mention.
    link = F.when(F.col("link").rlike(r"10:30$"), F.translate("link", " ", "_")).otherwise(F.col("link"))
    df = df.withColumn("link", F.regexp_replace(link, "_10:30", ""))
    out = periods.infer_period_coverage(df, F.col("hint"), F.col("link"), F.col("url"), F.col("page"))
    return out.select("o_orderkey", *periods.COVERAGE_COLUMNS)


@query("link_subject_period", f"""SELECT o_orderkey, {_MB} AS period_from, CASE WHEN o_orderkey % 2 = 0 THEN {_ME} ELSE strftime(last_day(o_orderdate + INTERVAL 65 DAY), '%Y%m%dT235959') END AS period_to,
  CASE WHEN o_orderkey % 2 = 0 THEN 'single_month_from_url' ELSE 'range_from_link_text' END AS method FROM orders""")
def link_subject_period(spark, sf_dir):
    later = F.expr("o_orderdate + INTERVAL 65 DAYS")
    even = F.col("o_orderkey") % 2 == 0
    link = F.when(even, "Data").otherwise(F.concat(F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" to "), F.date_format(later, "MMMM yyyy")))
    url = F.when(even, F.date_format("o_orderdate", "'https://example.test/'MMMyyyy'.csv'")).otherwise("https://example.test/x")
    df = table(spark, sf_dir, "orders").select("o_orderkey", periods.link_subject_period(link, url).alias("p"))
    return df.select("o_orderkey", "p.*")


@query("url_filename", "SELECT page_id, regexp_extract(url, '([^/]*)/*$', 1) AS name FROM pages")
def url_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.url_filename(F.col("url")).alias("name"))


@query("url_extension", r"""SELECT page_id, lower(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '\.([^.]*)$', 1)) AS extension FROM pages""")
def url_extension(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.url_extension(F.col("url")).alias("extension"))


@query("url_canonical", "SELECT page_id, regexp_replace(trim(url), '/+$', '') AS canonical FROM pages")
def url_canonical(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", urls.url_canonical(F.col("url")).alias("canonical"))


@query("url_resolve", r"""SELECT page_id, concat(origin, '/a/', page_id) AS rooted, concat(origin, dir, 'x.csv') AS relative, concat(origin, regexp_replace(dir, '[^/]*/$', ''), 'up.csv') AS parent,
  'https://other.test/f' AS absolute FROM (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '^(.*/)', 1) AS dir FROM pages)""")
def url_resolve(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.url_resolve(u, F.concat(F.lit("/a/"), F.col("page_id").cast("string"))).alias("rooted"),
        urls.url_resolve(u, F.lit("x.csv")).alias("relative"),
        urls.url_resolve(u, F.lit("../up.csv")).alias("parent"),
        urls.url_resolve(u, F.lit("https://other.test/f")).alias("absolute"),
    )


@query("partition_path_values", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y') END AS download_year, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%m') END AS download_month,
  CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE strftime(o_orderdate, '%Y%m%dT000000') END AS downloaded_at FROM orders""")
def partition_path_values(spark, sf_dir):
    stamp = F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss"))
    year, month, safe = paths.partition_values(stamp)
    return table(spark, sf_dir, "orders").select("o_orderkey", year.alias("download_year"), month.alias("download_month"), safe.alias("downloaded_at"))


@query("stage_relative_path", with_ctes("f_discovered") + """SELECT seq, concat(substring(source_url, 1, 21), regexp_replace(source_url, '^https://example.test/[A-Z]/', '')) AS stage_path FROM f_discovered""")
def stage_relative_path(spark, sf_dir):
    return f_discovered(spark, sf_dir).select("seq", paths.stage_relative_path(F.col("source_url"), F.col("dataset_id")).alias("stage_path"))


@query("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", paths.content_hash(F.col("text")).alias("content_hash"))


@query("load_id", "SELECT doc_id, substring(sha256(text), 1, 16) AS load_id FROM documents")
def load_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", paths.load_id(paths.content_hash(F.col("text"))).alias("load_id"))


@query("output_hash_rule", """SELECT doc_id, source, CASE WHEN n > 1 OR doc_id % 10 = 0 THEN sha256(text) ELSE sha256(source) END AS content_hash
FROM (SELECT doc_id, text, concat(source, '/', doc_id // 2) AS source FROM documents) JOIN (SELECT concat(source, '/', doc_id // 2) AS source, count(*) AS n FROM documents GROUP BY 1) USING (source)""")
def output_hash_rule(spark, sf_dir):
    source = F.concat("source", F.lit("/"), F.floor(F.col("doc_id") / 2).cast("string"))
    outputs = table(spark, sf_dir, "documents").select(
        "doc_id", source.alias("source"), (F.col("doc_id") % 10 == 0).alias("is_archive"), F.sha2(source, 256).alias("source_hash"), F.col("text").alias("content")
    )
    return routing.output_hash_rule(outputs).select("doc_id", "source", "content_hash")


@query("join_array_text", "SELECT o_orderkey, concat(o_orderstatus, ',', o_orderpriority) AS joined FROM orders")
def join_array_text(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", sinks.join_array_text(F.array("o_orderstatus", "o_orderpriority")).alias("joined"))


@query("json_get_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.K') AS upper_k FROM events")
def json_get_path(spark, sf_dir):
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id", telemetry.json_get_path(props, "$.k", "bigint").alias("k"), telemetry.json_get_path(props, "$.K").alias("upper_k")
    )


@query("blank_to_null_long", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN CAST(p_size AS BIGINT) ELSE 0 END AS v FROM part")
def blank_to_null_long(spark, sf_dir):
    size = F.col("p_size")
    written = F.when(size % 3 == 0, "").when(size % 3 == 1, size.cast("string")).otherwise("0")
    return table(spark, sf_dir, "part").select("p_partkey", telemetry.blank_to_null_long(written).alias("v"))


@query("safe_cast", "SELECT p_partkey, TRY_CAST(p_name AS BIGINT) AS not_a_number, TRY_CAST(CAST(p_size AS VARCHAR) AS BIGINT) AS size, TRY_CAST(concat('2024-01-', p_size) AS DATE) AS day FROM part")
def safe_cast(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        telemetry.safe_cast(F.col("p_name"), "bigint").alias("not_a_number"),
        telemetry.safe_cast(F.col("p_size").cast("string"), "bigint").alias("size"),
        telemetry.safe_cast(F.concat(F.lit("2024-01-"), F.col("p_size").cast("string")), "date").alias("day"),
    )


_SNAKE = r"upper(trim(regexp_replace(regexp_replace(regexp_replace({c}, '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g'), '[^A-Za-z0-9]+', '_', 'g'), '_'))"


@query("alias_screaming_snake", f"SELECT doc_id, {_SNAKE.format(c='text')} AS name FROM documents")
def alias_screaming_snake(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.screaming_snake(F.col("text")).alias("name"))


@query("normalize_identifier", "SELECT doc_id, upper(translate(source || '-x y/z', '- /', '___')) AS name FROM documents")
def normalize_identifier(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_identifier(F.concat("source", F.lit("-x y/z"))).alias("name"))


_TOKEN = "CASE WHEN {t} = '' THEN 'DEFAULT' ELSE {t} END"
_TOK_BRAND = _TOKEN.format(t="upper(trim(regexp_replace(p_brand, '[^A-Za-z0-9]+', '_', 'g'), '_'))")
_TOK_NAME = _TOKEN.format(t="upper(trim(regexp_replace(CASE WHEN p_partkey % 7 = 0 THEN '--' ELSE p_name END, '[^A-Za-z0-9]+', '_', 'g'), '_'))")


@query("infer_object_suffix", f"SELECT p_partkey, concat({_TOK_BRAND}, '_', {_TOK_NAME}) AS suffix FROM part")
def infer_object_suffix(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 7 == 0, "--").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.object_suffix(F.col("p_brand"), name).alias("suffix"))


@query("slugify_id", """SELECT p_partkey, CASE WHEN s = '' THEN 'unknown-dataset' ELSE s END AS slug FROM (SELECT p_partkey, trim(regexp_replace(lower(CASE WHEN p_partkey % 7 = 0 THEN '##' ELSE p_brand || ' ' || p_name END), '[^a-z0-9]+', '-', 'g'), '-') AS s FROM part)""")
def slugify_id(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 7 == 0, "##").otherwise(F.concat("p_brand", F.lit(" "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.slugify(name).alias("slug"))


@query("slugify_sheet", """SELECT p_partkey, CASE WHEN s = '' THEN 'sheet' ELSE s END AS slug FROM (SELECT p_partkey, trim(regexp_replace(CASE WHEN p_partkey % 7 = 0 THEN '##' ELSE p_brand || ' ' || p_name END, '[^A-Za-z0-9]+', '_', 'g'), '_') AS s FROM part)""")
def slugify_sheet(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 7 == 0, "##").otherwise(F.concat("p_brand", F.lit(" "), "p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", text.slugify_sheet(name).alias("slug"))


@query("clean_none_like", with_ctes("f_inventory") + "SELECT seq, sub_dataset_id FROM f_inventory")
def clean_none_like(spark, sf_dir):
    return f_inventory(spark, sf_dir).select("seq", text.clean_none_like(F.col("sub_collection")).alias("sub_dataset_id"))


@query("link_text_generalize", """SELECT o_orderkey, concat('Waits ', o_orderpriority, ' national') AS text FROM orders""")
def link_text_generalize(spark, sf_dir):
    written = F.concat(F.lit("Waits (CSV, 2MB) "), "o_orderpriority", F.date_format("o_orderdate", "' 'MMMM yyyy"), F.lit(" national "), F.year("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.generalize_link_text(written).alias("text"))


@query("contains_date_text", with_ctes("dates") + "SELECT o_orderkey, shape IN (0, 1, 3, 5, 10) AS dated FROM dates")
def contains_date_text(spark, sf_dir):
    df = f_date_text(spark, sf_dir)
    written = F.when(F.col("shape") == 5, F.concat(F.lit("may "), F.col("y"))).otherwise(F.col("text_value"))
    return df.select("o_orderkey", text.contains_date_text(written).alias("dated"))


@query("period_pattern_type", with_ctes("dates") + """SELECT o_orderkey, CASE WHEN shape = 6 THEN 'fiscal_year_and_month' WHEN shape = 4 THEN 'compact_month_year' ELSE 'month_year' END AS kind FROM dates""")
def period_pattern_type(spark, sf_dir):
    return f_date_text(spark, sf_dir).select("o_orderkey", text.period_pattern_type(F.col("text_value")).alias("kind"))


@query("html_page_text", with_ctes("visible") + r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM visible""")
def html_page_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.html_page_text(F.col("html")).alias("text"))


@query("html_links", with_ctes("links") + "SELECT * FROM links")
def html_links(spark, sf_dir):
    return html.html_links(table(spark, sf_dir, "pages"))


@query("html_links_loose", with_ctes("links") + """SELECT page_url, link_url, link_text FROM links
UNION ALL SELECT url, concat('https://loose.test/u', page_id, '.csv'), 'U and more' FROM pages UNION ALL SELECT url, 'https://loose.test/v.csv', 'V' FROM pages
UNION ALL SELECT url, 'https://loose.test/w.csv', 'W' FROM pages""")
def html_links_loose(spark, sf_dir):
    """Pages that end in named, unclosed and adjacent anchors, a ">" in an attribute, no-break spaces and an open comment."""
    loose = F.concat(
        F.lit('<a name="top"><a href="https://loose.test/u'), "page_id", F.lit(".csv\">U\u00a0and&nbsp; more <a href=https://loose.test/v.csv>V<a title='a>b' "),
        F.lit('href="\u00a0https://loose.test/w.csv ">W</a><!-- <a href="https://loose.test/x.csv">X</a>'),
    )
    pages = table(spark, sf_dir, "pages").withColumn("html", F.concat("html", loose))
    return html.html_links(pages).select("page_url", "link_url", "link_text")


@query("filter_extension", with_ctes("f_discovered") + r"SELECT seq, source_url FROM f_discovered WHERE regexp_matches(lower(source_url), '\.(csv|zip)$')")
def filter_extension(spark, sf_dir):
    found = f_discovered(spark, sf_dir)
    return found.filter(discovery.extension_predicate(F.col("source_url"), ["csv", "Zip"])).select("seq", "source_url")


@query("filter_text_regex", with_ctes("links") + "SELECT page_url, position, link_text FROM links WHERE regexp_matches(link_text, '(?i)the|en$')")
def filter_text_regex(spark, sf_dir):
    links = html_links(spark, sf_dir)
    return links.filter(discovery.text_predicate(F.col("link_text"), "THE|en$")).select("page_url", "position", "link_text")


@query("filter_link_selector", with_ctes("f_discovered") + """SELECT seq, source_url FROM f_discovered WHERE (source_url LIKE '%.csv' AND source_url NOT LIKE '%/O/%') OR lower(source_url) LIKE '%.zip' OR source_url LIKE 'https://example.test/F/1%'""")
def filter_link_selector(spark, sf_dir):
    selector = "a[href$='.csv']:not([href*='/O/']), a[href$='.zip' i], a[href^=\"https://example.test/F/1\"]"
    found = f_discovered(spark, sf_dir)
    return found.filter(discovery.link_selector_predicate(selector, F.col("source_url"))).select("seq", "source_url")


@query("filter_page_not_file", with_ctes("f_discovered") + r"SELECT seq, source_url FROM f_discovered WHERE NOT regexp_matches(lower(source_url), '\.(csv|zip)($|\?)')")
def filter_page_not_file(spark, sf_dir):
    found = f_discovered(spark, sf_dir)
    return found.filter(~discovery.is_file_link(F.col("source_url"))).select("seq", "source_url")


@query("filter_period_like_ref", with_ctes("dates") + "SELECT o_orderkey FROM dates WHERE shape NOT IN (2, 4)")
def filter_period_like_ref(spark, sf_dir):
    df = f_date_text(spark, sf_dir)
    written = F.when(F.col("shape") == 6, F.concat(F.lit("FY-"), F.substring("text_value", 1, 7))).otherwise(F.col("text_value"))
    return df.filter(discovery.looks_like_period_reference(written)).select("o_orderkey")


@query("route_filename_rules", with_ctes("f_discovered") + r"""SELECT seq, CASE WHEN regexp_matches(source_url, '(?i)/F/[12]') OR regexp_matches(source_url, '(?i)\.zip$') THEN 'area/first' WHEN regexp_matches(source_url, '(?i)/f/|/o/9') THEN 'area/second' ELSE 'area' END AS path_prefix FROM f_discovered""")
def route_filename_rules(spark, sf_dir):
    rules = [routing.RouteRule("FIRST", "area/first", ["/F/[12]", r"\.zip$"]), routing.RouteRule("SECOND", "area/second", ["/f/|/o/9"])]
    return routing.route_filename_rules(f_discovered(spark, sf_dir), rules, "area", "source_url").select("seq", "path_prefix")


@query("set_jaccard_drift", """WITH w AS (SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS ws, lang FROM documents), k AS (SELECT lang, list_distinct(string_split(lower(arg_min(text, doc_id)), ' ')) AS ks FROM documents GROUP BY lang)
SELECT doc_id, round(1.0 - len(list_intersect(ws, ks)) / len(list_distinct(list_concat(ws, ks))), 9) AS drift_ratio FROM w JOIN k USING (lang)""")
def set_jaccard_drift(spark, sf_dir):
    """Word sets stand in for column lists: every document against its language's first one."""
    docs = table(spark, sf_dir, "documents")
    words = lambda c: F.array_distinct(F.split(F.lower(c), " "))
    known = docs.groupBy("lang").agg(F.min_by("text", "doc_id").alias("first")).select("lang", words(F.col("first")).alias("known_columns"))
    headers = docs.select("doc_id", "lang", words(F.col("text")).alias("actual_columns"))
    return quality.set_jaccard_drift(headers, known, "lang").select("doc_id", F.round("drift_ratio", 9).alias("drift_ratio"))


@query("alias_keep_metadata", with_ctes("f_ingest") + 'SELECT "_INGESTED_AT", "_LOAD_ID", "Period" AS "PERIOD", "priorityClass" AS "PRIORITY_CLASS" FROM f_ingest')
def alias_keep_metadata(spark, sf_dir):
    return shape.alias_columns(f_ingest(spark, sf_dir).select("_INGESTED_AT", "_LOAD_ID", "Period", "priorityClass"))


@query("alias_collision_suffix", with_ctes("f_ingest") + 'SELECT "Org Code" AS "ORG_CODE", "Period" AS "ORG_CODE_2", "_LOAD_ID", "c-d" AS "ORG_CODE_4" FROM f_ingest')
def alias_collision_suffix(spark, sf_dir):
    df = f_ingest(spark, sf_dir).select("Org Code", F.col("Period").alias("orgCode"), "_LOAD_ID", F.col("c-d").alias("org-code"))
    return shape.alias_columns(df)
