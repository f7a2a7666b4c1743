from __future__ import annotations

import random

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from statledger.operators import changes, discovery, inventory, ordering, quality, revisions, routing, shape, telemetry
from statledger.schemas import METADATA_COLUMNS, SIDECAR_SCHEMA


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def _revisions(rng, count):
    """Files of a few periods; publication, period end and load times collide often, and some are unknown."""
    for i in range(count):
        yield (
            f"P{rng.randint(1, 4)}", i, rng.choice(["", "20210105T090000", "20210105T100000", "20220701T000000"]),
            rng.choice(["", "20201231T235959", "20210131T235959"]), f"2023010{rng.randint(1, 3)}T000000", f"2024-01-0{rng.randint(1, 3)}", f"f{i:03}",
        )


REVISION_SCHEMA = (
    "REPORTING_PERIOD string, VALUE int, _PUBLICATION_DATE string, _SUBJECT_PERIOD_TO string, _DOWNLOADED_AT string, "
    "_INGESTED_AT string, _SOURCE_FILE_PATH string"
)


def test_revision_rank_against_brute_force(spark):
    items = list(_revisions(random.Random(2), 300))
    df = spark.createDataFrame(items, REVISION_SCHEMA)
    want = {}
    for period in {i[0] for i in items}:
        mine = sorted((i for i in items if i[0] == period), key=lambda i: (i[2] != "", i[2], i[3] != "", *i[3:]), reverse=True)
        want |= {i[1]: place for place, i in enumerate(mine, start=1)}
    ranked = revisions.revision_rank_full(df, ["REPORTING_PERIOD"]).collect()
    assert {r.VALUE: r._REVISION_RANK for r in ranked} == want
    best = revisions.best_revision_full(df, ["REPORTING_PERIOD"]).collect()
    assert sorted(r.VALUE for r in best) == sorted(v for v, place in want.items() if place == 1)


def test_dedup_against_brute_force(spark):
    rng = random.Random(4)
    loads = [(f"2020-01-01 0{rng.randint(0, 4)}:00", f"p{rng.randint(0, 2)}", f"n{i}", f"key{rng.randint(0, 3)}", rng.randint(1, 5), i) for i in range(250)]
    df = spark.createDataFrame(
        loads, "at string, _SOURCE_FILE_PATH string, _SOURCE_FILE_NAME string, _FILE_CONTENT_KEY string, _FILE_ROW_NUMBER long, VALUE int"
    ).withColumn("_INGESTED_AT", F.col("at").cast("timestamp"))
    latest = {}
    for load in sorted(loads, key=lambda x: x[:3]):
        latest[load[3:5]] = load[5]
    got = rows(revisions.dedup_latest_ingest(df), "_FILE_CONTENT_KEY", "_FILE_ROW_NUMBER", "VALUE")
    assert got == sorted((*key, value) for key, value in latest.items())


def test_dedup_trims_copies_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.timestamp_seconds("id").alias("_INGESTED_AT"), F.concat(F.lit("p"), "id").alias("_SOURCE_FILE_PATH"), F.hex("id").alias("_SOURCE_FILE_NAME"),
        F.concat(F.lit("k"), F.col("id") % 2).alias("_FILE_CONTENT_KEY"), (F.col("id") % 3).alias("_FILE_ROW_NUMBER"),
    )
    plan = revisions.dedup_latest_ingest(df)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


INGEST_SCHEMA = (
    "at string, _SOURCE_FILE_PATH string, _SOURCE_FILE_NAME string, _FILE_ROW_NUMBER long, _FILE_CONTENT_KEY string, "
    "_ACQUISITION_METHOD string, _FALLBACK_REASON string, _LOAD_ID string, Period string, `wardBeds` string"
)


def _ingest(spark, files):
    """One row per (file, period, value)."""
    loads = [(f"2020-0{i + 1}-01", f, f, 1, f"key-{f}", "automated", "", f"key-{f}", period, value) for i, (f, period, value) in enumerate(files)]
    return spark.createDataFrame(loads, INGEST_SCHEMA).select(F.col("at").cast("timestamp").alias("_INGESTED_AT"), "*").drop("at")


def _sidecar(spark, described):
    """Metadata of some files: file and publication."""
    named = spark.createDataFrame(described, "_PAYLOAD_STAGE_PATH string, _PUBLICATION_DATE string")
    return spark.createDataFrame([], SIDECAR_SCHEMA).unionByName(named, allowMissingColumns=True)


def test_raw_view_fills_what_no_metadata_says(spark):
    raw = revisions.raw_view(_ingest(spark, [("x", "p1", "1"), ("y", "p1", "2"), ("z", None, "3")]), _sidecar(spark, [("x", "20210101T000000")]))
    assert rows(raw, "_SOURCE_FILE_PATH", "_PUBLICATION_DATE", "_PUBLICATION_DATE_SOURCE", "_FILE_SCOPE_DURATION_TYPE") == [
        ("x", "20210101T000000", "unknown", "unknown"), ("y", "", "unknown", "unknown"), ("z", "", "unknown", "unknown")
    ]
    assert raw.filter("_FILE_SCOPE_DURATION_VALUE is null").count() == 3
    current = revisions.current_revision(raw, ["PERIOD"])
    # A published file comes before one that is not; a row without a period matches nothing.
    assert rows(current, "PERIOD", "WARD_BEDS") == [("p1", "1")]
    assert "_LOADED_AT" in current.columns
    assert rows(revisions.presentation_select(raw, strict=True), "WARD_BEDS") == []


@pytest.mark.parametrize("duration", ["rolling", "calendar_ytd", "fiscal_ytd"])
def test_overlapping_files_need_reporting_columns(spark, duration):
    raw = revisions.raw_view(_ingest(spark, [("x", "p1", "1")]), _sidecar(spark, []))
    assert revisions.current_revision(raw, [], duration) is None
    assert revisions.current_revision(raw, ["PERIOD"], duration) is not None


def test_raw_view_is_live(spark, workdir):
    """Metadata that lands after the view was made is seen through it, and nothing runs while it is made."""
    path = f"{workdir}/sidecar"
    _sidecar(spark, [("x", "20210101T000000")]).write.parquet(path)
    ingest = _ingest(spark, [("x", "p1", "1"), ("y", "p1", "2")])
    sidecar = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("view", "making the view")
    raw = revisions.raw_view(ingest, sidecar, view_name="RAW_LIVE")
    revisions.current_revision(raw, ["PERIOD"])
    revisions.publication_rank(revisions.presentation_select(raw), ["PERIOD"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("view") == []
    spark.sparkContext._jsc.clearJobGroup()
    assert rows(spark.table("RAW_LIVE").filter("_PUBLICATION_DATE <> ''"), "_SOURCE_FILE_PATH") == [("x",)]
    _sidecar(spark, [("y", "20220101T000000")]).write.mode("append").parquet(path)
    spark.catalog.refreshTable("RAW_LIVE")  # as for any table of files: list them anew
    assert rows(spark.table("RAW_LIVE").filter("_PUBLICATION_DATE <> ''"), "_SOURCE_FILE_PATH") == [("x",), ("y",)]


def test_aliases():
    assert shape.aliases(["wardBeds", "ICUBeds", "beds (all)"]) == ["WARD_BEDS", "ICU_BEDS", "BEDS_ALL"]
    assert shape.aliases(["bed rate", "_PUBLICATION_DATE"]) == ["BED_RATE", "_PUBLICATION_DATE"]
    for count in range(1, 6):
        same = ["bed rate", "BED-RATE", "bedRate", "Bed.Rate", "bed_rate"][:count]
        assert shape.aliases([*same, "y"]) == ["BED_RATE", *[f"BED_RATE_{n}" for n in range(2, count + 1)], "Y"]
    assert len(METADATA_COLUMNS) == 23


def test_unpivot(spark):
    df = spark.createDataFrame([("A1", 10, "11"), ("B1", 20, None)], "`Org Code` string, `Apr 2025` int, `May 2025` string")
    got = shape.unpivot_wide(df, ["Org Code"], "reporting_period").collect()
    assert sorted(map(tuple, got), key=str) == [("A1", "Apr 2025", "10"), ("A1", "May 2025", "11"), ("B1", "Apr 2025", "20"), ("B1", "May 2025", None)]
    with pytest.raises(ValueError):
        shape.unpivot_wide(df, ["Missing"], "p")


def test_start_cell(spark):
    assert [shape.parse_start_cell(c) for c in ("B5", "AA10", None)] == [(5, 2), (10, 27), (1, 1)]
    cells = spark.createDataFrame(
        [("f", 0, "s", 1, 1, "title"), ("f", 0, "s", 3, 1, "x"), ("f", 0, "s", 3, 2, "a"), ("f", 0, "s", 3, 3, "b"), ("f", 0, "s", 4, 2, "1"), ("f", 0, "s", 4, 3, "2"), ("f", 1, "t", 1, 1, "z")],
        "file string, sheet_index int, sheet string, row int, col int, value string",
    )
    named = shape.sheet_start_cell(shape.sheet_select_named(cells), "B3")
    assert rows(named, "row", "column_name", "value") == [(1, "a", "1"), (1, "b", "2")]
    assert rows(shape.cells_to_table(named, ["a", "b"]), "a", "b") == [("1", "2")]
    assert rows(shape.sheet_select_named(cells, "t"), "value") == [("z",)]


def test_evolve_and_match(spark):
    old = spark.createDataFrame([("1", "2")], "A string, B string")
    new = spark.createDataFrame([("3", "4")], "c string, a string")
    assert shape.schema_evolve_union([old, new]).collect()[1].asDict() == {"A": "4", "B": None, "c": "3"}
    assert shape.match_columns_by_name(new, ["A", "B"]).columns == ["A", "B", "c"]


def test_headers_of_one_table_are_compared_by_many_tasks(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        headers = spark.range(200).select(F.lit("t").alias("table_name"), F.array(F.lit("a"), F.col("id").cast("string")).alias("actual_columns"))
        known = spark.createDataFrame([("t", ["a"]), ("other", ["b"])], "table_name string, known_columns array<string>")
        got = quality.set_jaccard_drift(headers, known).select("drift_ratio", F.spark_partition_id().alias("task")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r.drift_ratio for r in got] == [0.5] * 200
    assert len({r.task for r in got}) > 1


def test_drift_is_jaccard_distance(spark):
    rng = random.Random(6)
    letters = "abcdefgh"
    known = {t: rng.sample(letters, rng.randint(1, 6)) for t in ("r", "s", "t")}
    actual = [(rng.choice(["r", "s", "t", "other"]), rng.sample(letters, rng.randint(1, 6))) for _ in range(40)]
    actual = list({(t, tuple(c)): (t, c) for t, c in actual}.values())
    headers = spark.createDataFrame(actual, "table_name string, actual_columns array<string>")
    lists = spark.createDataFrame(list(known.items()), "table_name string, known_columns array<string>")
    ratio = {(t, tuple(c)): 1 - len({*c} & {*known[t]}) / len({*c} | {*known[t]}) for t, c in actual if t in known}
    for threshold in (0.2, 0.5, 0.75):
        got = quality.drift_warnings(headers, lists, threshold=threshold).collect()
        want = {k: v for k, v in ratio.items() if v > threshold}
        assert {(r.table_name, tuple(r.actual_columns)): round(r.drift_ratio, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


def _brute_cap(items, target_limit, dataset_limit, total):
    """One pass over the newest-first list per dataset, counting what was taken."""
    taken, left = [], total
    for dataset in sorted({i[0] for i in items}):
        mine = sorted((i for i in items if i[0] == dataset), key=lambda i: i[4])
        mine.sort(key=lambda i: (i[3] or "", i[2]), reverse=True)
        kept, per_target = [], {}
        for item in mine:
            if len(kept) >= dataset_limit or len(kept) >= left:
                break
            if per_target.get(item[1], 0) < target_limit:
                per_target[item[1]] = per_target.get(item[1], 0) + 1
                kept.append(item)
        left -= len(kept)
        taken += kept
    return sorted(i[4] for i in taken)


def test_caps_against_brute_force(spark):
    rng = random.Random(5)
    items = [(rng.randint(0, 3), f"t{rng.randint(0, 2)}", f"/u{rng.randint(0, 9)}", rng.choice([None, "2024", "2025", "2026"]), seq) for seq in range(200)]
    df = spark.createDataFrame(items, "dataset_id int, sub_dataset_id string, source_url string, publication_date string, seq int").withColumn("dataset_order", F.col("dataset_id"))
    for limits in [(2, 5, 9), (50, 7, 1000), (3, 100, 20)]:
        got = sorted(r.seq for r in discovery.cap_discovered(df, *limits).collect())
        assert got == _brute_cap(items, *limits)


def test_include_exclude(spark):
    ids = spark.createDataFrame([(c,) for c in "abcd"], "id string")
    include, exclude = (spark.createDataFrame([(c,) for c in text], "id string") for text in ("abc", "b"))
    assert rows(discovery.filter_include_exclude(ids, "id", include, exclude)) == [("a",), ("c",)]
    assert rows(discovery.filter_include_exclude(ids, "id", None, exclude)) == [("a",), ("c",), ("d",)]


@pytest.mark.parametrize("width", [1, 3, 9])
def test_rank_is_the_same_whatever_the_slices(spark, width):
    """One key holds most rows; NULL is a key as well, and a value."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), F.col("id") * 7919 % 2003)).alias("v"),
        "id",
    )
    slices = [(F.substring("v", 1, width), Column.desc_nulls_last)]
    got = ordering.rank_within(df, ["k"], [F.col("v").desc_nulls_last(), F.col("id").asc()], "r", slices).collect()
    want, groups = {}, {}
    for row in df.collect():
        groups.setdefault(row.k, []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: r.id)
        group.sort(key=lambda r: (r.v is not None, r.v or ""), reverse=True)
        want.update({row.id: place for place, row in enumerate(group, start=1)})
    assert {row.id: row.r for row in got} == want and len(got) == 2000


@pytest.mark.parametrize("size", [7, 1000])
def test_running_sum_over_everything(spark, size):
    df = spark.range(1, 501).withColumn("n", F.col("id") % 5)
    slices = [(F.floor(F.col("id") / size), Column.asc)]
    got = ordering.running_sum(df, [], [F.col("id").asc()], F.col("n"), "s", slices).collect()
    assert {r.id: r.s for r in got} == {i: sum(j % 5 for j in range(1, i + 1)) for i in range(1, 501)}


def test_top_per_key_beyond_the_group_limit(spark):
    df = spark.range(3000).withColumn("k", F.col("id") % 2)
    got = ordering.top_per_key(df, ["k"], [F.col("id").desc()], 1200, "r")
    assert got.groupBy("k").agg(F.count("*"), F.min("id"), F.max("r")).orderBy("k").collect() == [(0, 1200, 600, 1200), (1, 1200, 601, 1200)]


def test_unchanged_files_are_skipped_on_the_second_run(spark):
    found = spark.createDataFrame([("u1", "f", "etag-1", None, "h1"), ("u2", "f", "", "Mon", "h2"), ("u3", "f", "e", None, "h3")], "source_url string, file_name string, etag string, last_modified string, content_hash string")
    nothing = spark.createDataFrame([], SIDECAR_SCHEMA)
    assert changes.anti_unchanged_headers(found, nothing).count() == 3
    assert changes.anti_unchanged_content(found, nothing).count() == 3
    loaded = found.select(
        F.col("source_url").alias("_SOURCE_FILE_PATH"), F.col("file_name").alias("_SOURCE_FILE_NAME"), F.lit("2026-01-01").alias("_INGESTED_AT"),
        F.col("content_hash").alias("_FILE_CONTENT_KEY"), F.col("etag").alias("_SOURCE_ETAG"), F.col("last_modified").alias("_SOURCE_LAST_MODIFIED"),
    )
    assert changes.anti_unchanged_headers(found, loaded).count() == 0
    assert changes.anti_unchanged_content(found, loaded).count() == 0
    changed = found.withColumn("etag", F.lit("new")).withColumn("last_modified", F.lit("new")).withColumn("content_hash", F.lit("new"))
    assert changes.anti_unchanged_headers(changed, loaded).count() == 3
    assert changes.anti_unchanged_content(changed, loaded, by_file_name=False).count() == 3


def test_routing_takes_the_first_rule_that_fits(spark):
    """Sheets without a rule are left out, and so are workbooks without a routed sheet."""
    names = ["beds north", "Beds south", "rates", "RATES north", "cover"]
    books = [("b1", names), ("b2", names[2:]), ("b3", ["cover", "index"])]
    sheets = spark.createDataFrame([(b, s) for b, ss in books for s in ss], "file string, sheet string")
    rules = [routing.RouteRule("N", "p/n", ["north$"]), routing.RouteRule("B", "p/b", ["^beds", "^ward"]), routing.RouteRule("R", "p/r", ["RATE"])]
    suffix = lambda sheet: next((k for k, test in (("N", sheet.endswith("north")), ("B", sheet.lower().startswith("beds")), ("R", "rate" in sheet.lower())) if test), None)
    want = sorted((b, s, suffix(s)) for b, ss in books for s in ss if suffix(s))
    assert rows(routing.route_sheet_rules(sheets, rules), "file", "sheet", "object_suffix") == want
    assert rows(routing.unrouted_workbooks(sheets, rules)) == [("b3",)]
    files = spark.createDataFrame([("beds_1.csv", None), ("other.csv", None), ("else.csv", "p/sheet"), ("BEDS.csv", "p/sheet")], "file_name string, sheet_prefix string")
    routed = routing.route_filename_rules(files, [routing.RouteRule("B", "p/beds", ["^beds"])], "p", sheet_prefix="sheet_prefix")
    assert rows(routed, "file_name", "path_prefix") == [("BEDS.csv", "p/sheet"), ("beds_1.csv", "p/beds"), ("else.csv", "p/sheet"), ("other.csv", "p")]


def test_selectors_against_brute_force(spark):
    hrefs = [f"/{kind}/{name}{end}" for kind in ("raw", "Old") for name in ("beds", "BEDS-v2") for end in (".csv", ".CSV", ".xlsx", "")]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string")
    tests = {
        "a[href]": lambda h: True,
        "a[href$='.csv']": lambda h: h.endswith(".csv"),
        "a[href$='.csv' i]": lambda h: h.lower().endswith(".csv"),
        "a[href^='/Old']:not([href*='v2'])": lambda h: h.startswith("/Old") and "v2" not in h,
        "a[href*=beds][href$='.xlsx'], a[href=\"/raw/beds\"]": lambda h: "beds" in h and h.endswith(".xlsx") or h == "/raw/beds",
        "a[href*='']": lambda h: False,
    }
    for selector, test in tests.items():
        got = [r.h for r in df.filter(discovery.link_selector_predicate(selector, F.col("h"))).collect()]
        assert sorted(got) == sorted(h for h in hrefs if test(h))
    with pytest.raises(ValueError):
        discovery.link_selector_predicate("p > a", F.col("h"))


def test_sibling_pages(spark):
    links = spark.createDataFrame(
        [("s", i, h, t, h) for i, (h, t) in enumerate([("https://e.test/2024/", "2024"), ("https://e.test/2024", "again"), ("https://e.test/2025.csv", "2025"), ("https://e.test/about", "About"), ("https://e.test/x", "March"), ("https://e.test/2026", "y"), ("s", "2024")])],
        "page_url string, position int, href string, link_text string, link_url string",
    )
    seeds = spark.createDataFrame([("s",)], "seed_url string")
    got = discovery.sibling_pages(links, seeds, max_pages=3).orderBy("page_order").collect()
    assert [r.page_url for r in got] == ["s", "https://e.test/2024", "https://e.test/x"]
    assert discovery.sibling_pages(links, seeds, max_pages=0).count() == 1


def _brute_hint(example, links):
    tail = example.rsplit("/", 1)[-1].lower()
    exact = [t for h, t in links if h.lower().endswith(tail) and t]
    loose = [t for h, t in links if tail in h.lower()]
    return (exact or loose or [None])[0]


def test_best_link_against_brute_force(spark):
    names = ["data.csv", "a.csv", "monthly-data-extract-march-2026.csv", "x", "monthly-data-extract-march", "old-data.csv"]
    pages = {
        "p1": [("/f/data.csv?x=1", "query"), ("/f/old-data.csv", ""), ("/f/OLD-data.csv", "old"), ("/y/a.csv", "a")],
        "p2": [("/m/monthly-data-extract-m", "head"), ("/m/monthly-data-extract-march-2026.csv.zip", "inner"), ("/q/xx", "x")],
    }
    links = spark.createDataFrame([(p, i, h, t) for p, ls in pages.items() for i, (h, t) in enumerate(ls)], "page_url string, position int, href string, link_text string")
    examples = [(p, f"https://e.test/z/{n}") for p in pages for n in names]
    got = {(r.page_url, r.example_url): r.link_text for r in discovery.best_link_for_example(spark.createDataFrame(examples, "page_url string, example_url string"), links).collect()}
    want = {(p, e): _brute_hint(e, pages[p]) for p, e in examples}
    assert got == {k: v for k, v in want.items() if v is not None}


def test_profile_parity_and_checks(spark):
    df = spark.createDataFrame([("1", None), ("1", "x"), ("2", None)], "a string, b string")
    got = rows(quality.column_profile(df, "RAW_T"))
    assert got == [("RAW_T", "a", 3, 0, 0.0, 2), ("RAW_T", "b", 3, 2, 2 / 3, 1)]
    assert rows(quality.column_profile(df.limit(0), "RAW_T")) == [("RAW_T", "a", 0, 0, None, 0), ("RAW_T", "b", 0, 0, None, 0)]
    assert quality.check_profile_bounds(quality.column_profile(df, "RAW_T")).count() == 0
    assert rows(quality.check_not_null(df, ["a", "b"])) == [("a", 0), ("b", 2)]
    assert quality.agg_loaded_row_counts({}, spark).columns == ["raw_table_name", "load_id", "loaded_row_count"]


def test_typed_events(spark):
    lines = spark.createDataFrame([("2026-01-01T00:00:00.123Z", "r", "12", "x", "m")], "event_timestamp_utc string, run_id string, duration_ms string, source_bytes string, execution_mode string")
    row = telemetry.type_events(lines).first()
    assert (row.RUN_ID, row.DURATION_MS, row.SOURCE_BYTES, row.EVENT_TIMESTAMP_UTC.microsecond) == ("r", 12, None, 123000)
    assert len(row) == 23 and "EXECUTION_MODE" not in row.asDict()


def test_file_counts_and_report(spark):
    files = spark.createDataFrame([("series-a/sub-a/downloaded_at=20260101T000000/sample.csv",), ("series-a/sub-a/_INGEST_METADATA.json",)], "relative_path string")
    assert rows(quality.agg_file_counts(files)) == [("series-a", "sub-a", 1)]
    sidecar = spark.createDataFrame([("u",), ("",)], "_SOURCE_FILE_PATH string")
    report = quality.verification_report(files, sidecar, files.limit(0), {"T": files})
    values = {(r.metric, r.subject): r.value for r in report.collect()}
    assert values[("csv_file_count", "")] == 1 and values[("sidecar_source_url_count", "")] == 1
    assert values[("sidecar_without_csv_possible", "")] == 1 and values[("table_rows", "T")] == 2 and values[("table_columns", "T")] == 1
    assert not any(metric.startswith("csv_path") for metric, _ in values)


def test_report_lists_paths(spark):
    files = spark.createDataFrame([("s/a/c.csv",), ("s/a/b.csv",), ("s/a/b.csv",), ("s/a/d.csv",), ("s/a/d.txt",), (None,)], "relative_path string")
    sidecar = spark.createDataFrame([], "_SOURCE_FILE_PATH string")
    report = quality.verification_report(files, sidecar, files.limit(0), {}, path_sample=2)
    paths = {(r.metric, r.subject): r.value for r in report.collect() if "path" in r.metric}
    assert paths == {("csv_file_path_count", ""): 3, ("csv_path_sample", "s/a/b.csv"): 2, ("csv_path_sample", "s/a/c.csv"): 1}
    empty = quality.verification_report(files.limit(0), sidecar, files.limit(0), {}, path_sample=2)
    assert [(r.metric, r.value) for r in empty.collect() if "path" in r.metric] == [("csv_file_path_count", 0)]


def test_inventory(spark):
    inv = spark.createDataFrame(
        [
            (0, "My Set", "none", "", "", "https://e.test/a.CSV", "first"),
            (1, "My Set", "https://e.test/p", "https://e.test/s", "N/A", "https://e.test/a.CSV", "again"),
            (2, "My Set", "https://e.test/q", "", "Sub 1", "https://e.test/b.zip", ""),
            (3, "Other", "", "", "x", "https://e.test/c", ""),
        ],
        "seq int, dataset_name string, parent_link string, sub_link string, sub_collection string, target_file string, note string",
    )
    got = {r.sub_dataset_id: r for r in inventory.agg_inventory_rollup(inv).collect()}
    assert set(got) == {"default", "sub 1"}
    assert got["default"].entry_url == "https://e.test/p" and got["default"].sample_subpage_url == "https://e.test/s"
    assert got["default"].include_extensions == ["csv"] and got["default"].object_name_suffix == "MY_SET_DEFAULT"
    assert rows(inventory.inventory_samples(inv).filter("sub_dataset_id = 'default'"), "file_url", "seq", "notes") == [("https://e.test/a.CSV", 0, "first")]
