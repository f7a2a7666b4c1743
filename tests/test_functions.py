from __future__ import annotations

import calendar
import random
from datetime import datetime
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from statledger.functions import dates, html, paths, periods, text, urls

NAMES = list(calendar.month_name)[1:]
SPACES = [" ", "\t", "\n ", "\u00a0", "\u2009\u2009", "\u3000"]


def _ordinal(day):
    return f"{day}{'th' if 10 < day < 14 else {1: 'st', 2: 'nd', 3: 'rd'}.get(day % 10, 'th')}"


def _written_dates():
    """Every shape a date is written in, over months, days and years; what is written decides what is expected."""
    rng = random.Random(3)
    for number, name in enumerate(NAMES, start=1):
        for year in (1999, 2024, 2025):
            day = rng.randint(1, calendar.monthrange(year, number)[1])
            hour, minute, second = rng.randrange(24), rng.randrange(60), rng.randrange(60)
            short, space = name[:3], rng.choice(SPACES)
            month_only, date = f"{year}{number:02}01T000000", f"{year}{number:02}{day:02}T"
            midnight, timed = date + "000000", f"{date}{hour:02}{minute:02}{second:02}"
            for word in (name, short, name.upper(), short.lower()):
                yield f"{word}{space}{year}", month_only
                yield f"{day}{space}{word}{space}{year}", midnight
                yield f"{_ordinal(day)} {word},{space}{year}", midnight
                yield f"{day}-{word}_{year}", midnight
            yield f"{day} {name} {year}{space}{hour}:{minute:02}:{second:02}", timed
            yield f"{day} {short} {year} {hour:02}:{minute:02}", timed[:-2] + "00"
            yield f"{year}{number:02}{day:02}", midnight
            yield timed, timed
            yield f"{year}-{number:02}-{day:02}", midnight
            yield f"{year}-{number:02}-{day:02}T{hour:02}:{minute:02}:{second:02}", timed
            yield f"{short}{year}", month_only
            yield f"{short}{year % 100:02}", f"20{year % 100:02}{number:02}01T000000"
            fiscal = year + (number <= 3)
            yield f"{year}_{(year + 1) % 100:02}_{name.lower()}", f"{fiscal}{number:02}01T000000"
            yield f"{year}-{(year + 1) % 100:02}-{short}", f"{fiscal}{number:02}01T000000"
            # One day too many, a time beyond the day, and a month without its year.
            yield f"{calendar.monthrange(year, number)[1] + 1} {name} {year}", None
            yield f"{year}-{number:02}-{calendar.monthrange(year, number)[1] + 1}", None
            yield f"{day} {name} {year} {24 + hour}:00", None
            yield name, None
    yield from ((text, None) for text in ("", "   ", "seven", "number 7", "12 Nonember 2024", "20241301", "2024-00-10", None))


DATE_CASES = list(_written_dates())


def test_normalize_datetime(evaluate):
    got = evaluate(lambda c: dates.normalize_datetime(F.col(c)), [c for c, _ in DATE_CASES])
    assert [(c, g) for (c, e), g in zip(DATE_CASES, got) if g != e] == []


def test_subject_period(evaluate):
    got = evaluate(lambda c: dates.subject_period_yyyymm(F.col(c)), [c for c, _ in DATE_CASES])
    assert got == [e[:6] if e else None for _, e in DATE_CASES]


def test_strip_ordinals_and_whitespace(evaluate):
    assert evaluate(lambda c: text.strip_ordinals(F.col(c)), ["2nd April 2025", "March 2026"]) == ["2 April 2025", "March 2026"]
    assert evaluate(lambda c: text.collapse_whitespace(F.col(c)), ["  a \n\t b  "]) == ["a b"]


@pytest.mark.parametrize("number", range(1, 13))
def test_extract_by_pattern(evaluate, number):
    """The groups of the first match make the date; without groups it is the whole match."""
    name = NAMES[number - 1]
    month = f"2031{number:02}01T000000"
    rows = [
        (rf"as of ({name} \d+)", f"Figures as of\u00a0{name} 2031.", month),
        (rf"as of ({name} \d+)", f"Figures by {name} 2031.", None),
        (r"on (\d+) (\w+) (\d{4})", f"on 4 {name} 2031, on 5 {name} 2031", f"2031{number:02}04T000000"),
        (rf"{name[:3]}\d\d", f"x/{name[:3].upper()}31_y", month),
    ]
    for pattern, value, expected in rows:
        assert evaluate(lambda c, pattern=pattern: dates.extract_by_pattern(F.col(c), pattern), [value]) == [expected]


def test_page_publication(evaluate):
    """A date counts after the words that announce it, in whichever of the announced forms."""
    cases = []
    for number, name in enumerate(NAMES, start=1):
        for word in ("Published", "published:", "LAST UPDATED", "Last\u00a0 updated :"):
            cases += [
                (f"Series 12, {word} {number} {name} 2019 by the office", f"2019{number:02}{number:02}T000000"),
                (f"1 May 2001 {word}\u00a0{name} 2019", f"2019{number:02}01T000000"),
                (f"{word} 2019-{number:02}-28", f"2019{number:02}28T000000"),
                (f"{word} {number} {name} 2019 {number}:3{number % 10}", f"2019{number:02}{number:02}T{number:02}3{number % 10}00"),
            ]
        cases.append((f"Read on {number} {name} 2019", None))
    got = evaluate(lambda c: dates.extract_page_publication(F.col(c)), [c for c, _ in cases])
    assert [(c, g) for (c, e), g in zip(cases, got) if g != e] == []


def test_selectors_fall_through(evaluate):
    """The first selector that finds a date is taken, not the first that matches."""
    selectors = [r"edition (\w+)", r"edition of (\d{4}-\d\d-\d\d)", r"(\d+ [a-z]+ \d{4})"]
    values = ["edition of 2012-03-04, 5 June 2013", "5 june 2013, edition seven", "edition seven"]
    got = evaluate(lambda c: dates.extract_by_selectors(F.col(c), selectors), values)
    assert got == ["20120304T000000", "20130605T000000", None]


def test_publication_choice_and_plausibility(evaluate):
    def choose(page, link, url):
        return dates.publication_date_choice(F.col(page), F.col(link), F.col(url), "link_text", r"([A-Za-z]+ \d{4})")

    got = evaluate(choose, [("20250101T000000", "May 2024", "u"), (None, "May 2024", "u"), (None, "x", "May 2023")])
    assert got == ["20250101T000000", "20240501T000000", None]
    values = [None, "20091231T235959", "20100101T000000", "20260101T000000"]
    assert evaluate(lambda c: dates.plausible_publication(F.col(c)), values) == ["", "", values[2], values[3]]
    assert evaluate(lambda c: dates.publication_source_flag(F.col(c)), ["", "2020", None]) == ["none", "scraped", "none"]


def test_subject_period_rules(evaluate):
    """Rules are tried in order, each on the text that its source names."""

    def run(rules):
        return lambda link, url, page: dates.subject_period_rules(
            rules, F.col(link), F.col(url), F.col(page), urls.url_filename(F.col(url))
        )

    row = ("Issue of May 2011", "https://e.test/jun-2012/jul2013.csv", "for August 2014")
    word = r"([a-z]+[ -]?\d{4})"
    wanted = {"link_text": "201105", "url_segment": "201206", "file_name": "201307", "page_text": "201408", "page_elements": "201408"}
    for source, period in wanted.items():
        pattern = r"(jun-\d{4})" if source == "url_segment" else r"(may \d{4})" if source == "link_text" else r"(august \d{4})" if "page" in source else word
        assert evaluate(run([(source, pattern)]), [row]) == [period]
        assert evaluate(run([(source, r"(no)(thing)"), ("file_name", word)]), [row, ("", "https://e.test/", "")]) == ["201307", None]


def test_month_tokens(evaluate):
    got = evaluate(
        lambda c: periods.month_tokens(F.col(c)),
        ["Apr 2025 to\u00a0Jun\u00a02025", "Mar26 data", "data_mar_2026", "May 15 and sept/2024", "March 20261", "sepember 2024"],
    )
    assert got == [[202504, 202506], [202603], [], [201505, 202409], [], []]


COVERAGE_CASES = [
    # hint, link text, url, page text, duration type, expected (from, to, type, method, source, confidence)
    ("202605", "x", "y", "", "unknown", ("20260501T000000", "20260531T235959", "single_month", "subject_period_rule_yyyymm", "subject_period_hint", "high")),
    ("202613", "Summary data extract", "", "", "unknown", ("", "", "unknown", "not_inferred", "none", "low")),
    (None, "Rolling 12 months up to May 2026", "https://e.test/f.csv", "", "unknown", ("20250601T000000", "20260531T235959", "rolling_12_month", "rolling_12_from_link_text", "link_text", "medium")),
    (None, "Rolling 12 months to December 2025", "", "", "unknown", ("20250101T000000", "20251231T235959", "rolling_12_month", "rolling_12_from_link_text", "link_text", "medium")),
    (None, "April 2025 to June 2025", "https://e.test/f.csv", "", "unknown", ("20250401T000000", "20250630T235959", "month_range", "range_from_link_text", "link_text", "medium")),
    (None, "May 2026", "https://e.test/april2026.csv", "", "unknown", ("20260401T000000", "20260430T235959", "single_month", "single_month_from_file_name", "file_name", "high")),
    (None, "fiscal ytd February 2026", "https://e.test/f.csv", "", "unknown", ("20250401T000000", "20260228T235959", "fiscal_ytd", "fiscal_ytd_from_link_text", "link_text", "medium")),
    (None, "YTD February 2026", "https://e.test/f.csv", "", "unknown", ("20260101T000000", "20260228T235959", "calendar_ytd", "calendar_ytd_from_link_text", "link_text", "medium")),
    (None, "YTD February 2026", "https://e.test/f.csv", "fiscal May 2025", "fiscal_ytd", ("20250401T000000", "20250531T235959", "fiscal_ytd", "fiscal_ytd_from_page_text", "page_text", "medium")),
    (None, "15 March", "https://e.test/2026-03-15", "", "unknown", ("20260315T000000", "20260315T235959", "daily", "daily_from_file_name", "file_name", "low")),
    (None, "Summary data extract", "", "", "unknown", ("", "", "unknown", "not_inferred", "none", "low")),
]


def test_infer_period_coverage(spark):
    rows = [(i, *case[:5]) for i, case in enumerate(COVERAGE_CASES)]
    df = spark.createDataFrame(rows, "n int, hint string, link string, url string, page string, dtype string")
    out = periods.infer_period_coverage(
        df, F.col("hint"), F.col("link"), F.col("url"), F.col("page"), duration_type=F.col("dtype")
    ).orderBy("n")
    got = [tuple(r) for r in out.select(*periods.COVERAGE_COLUMNS).collect()]
    assert got == [case[5] for case in COVERAGE_CASES]


def test_declared_rolling_wins_over_earlier_source(spark):
    df = spark.createDataFrame([("Rolling 12 months to May 2026", "https://e.test/april2026.csv")], "link string, url string")
    none = F.lit(None).cast("string")
    out = periods.infer_period_coverage(
        df, none, F.col("link"), F.col("url"), none, F.lit("rolling"), F.lit(12), F.lit("month")
    ).first()
    assert out["_SUBJECT_PERIOD_INFERENCE_METHOD"] == "rolling_12_from_link_text"


def test_link_subject_period(evaluate):
    got = evaluate(
        lambda link, url: periods.link_subject_period(F.col(link), F.col(url)),
        [("Apr 2025 to Jun 2025", "x"), ("x", "data/may2025.csv"), ("x", "y")],
    )
    assert [tuple(v) for v in got] == [
        ("20250401T000000", "20250630T235959", "range_from_link_text"),
        ("20250501T000000", "20250531T235959", "single_month_from_url"),
        ("", "", "not_inferred"),
    ]


def test_names(evaluate):
    """Words are joined the ways names are written; the parts are known, so the result is."""
    rng = random.Random(9)
    parts = ["Ward", "Beds", "Rate", "Total", "Value2", "X"]
    names, expected = [], []
    for _ in range(60):
        chosen = [rng.choice(parts) for _ in range(rng.randint(1, 4))]
        join = rng.choice(["", " ", "-", "__", " (", ". "])
        if join == "":
            chosen = [c for c in chosen if c != "X"] or ["Ward"]
        names.append(join.join(chosen))
        expected.append("_".join(chosen).upper())
    # An acronym ends where the next word begins; signs at the ends are dropped.
    names += ["PDFFile", "theURL", "__Beds!", "4Wards", "Q&A (part b)"]
    expected += ["PDF_FILE", "THE_URL", "BEDS", "4_WARDS", "Q_A_PART_B"]
    assert [text.screaming_snake_name(n) for n in names] == expected
    assert evaluate(lambda c: text.screaming_snake(F.col(c)), names) == expected
    assert evaluate(lambda c: text.normalize_identifier(F.col(c)), ["a-b c/d"]) == ["A_B_C_D"]
    assert evaluate(lambda a, b: text.object_suffix(F.col(a), F.col(b)), [("my data-set", "default"), ("--", "x")]) == ["MY_DATA_SET_DEFAULT", "DEFAULT_X"]
    assert evaluate(lambda c: text.slugify(F.col(c)), ["A & E waits!", "--"]) == ["a-e-waits", "unknown-dataset"]
    assert evaluate(lambda c: text.slugify_sheet(F.col(c)), ["Raw data (1)", "!!"]) == ["Raw_data_1", "sheet"]
    assert evaluate(lambda c: text.clean_none_like(F.col(c)), [" N/A ", "None", "", " Sub A", None]) == ["default", "default", "default", "sub a", "default"]


def test_link_text_helpers(evaluate):
    assert evaluate(lambda c: text.generalize_link_text(F.col(c)), ["Waits (CSV, 2MB) March 2026 national 2025"]) == ["Waits national"]
    assert evaluate(lambda c: text.contains_date_text(F.col(c)), ["on 1 May 2024", "May 2024", "2024-05-01", "2024"]) == [True, True, True, False]
    got = evaluate(lambda c: text.period_pattern_type(F.col(c)), ["x/2025-26/march", "x/mar26.csv", "x/march 2026"])
    assert got == ["fiscal_year_and_month", "compact_month_year", "month_year"]


def test_unescape(evaluate):
    cases = [("a &amp; b &lt;c&gt;", "a & b <c>"), ("&#8217;&#x2019;", "’’"), ("R&D &bogus; &copy;", "R&D &bogus; ©"), ("plain", "plain")]
    assert evaluate(lambda c: text.unescape_entities(F.col(c)), [c for c, _ in cases]) == [e for _, e in cases]


RESOLVE = [
    ("https://e.test/stats/page.html?x=1#f", h)
    for h in ["a.csv", "/root/a.csv", "//other.test/a", "https://o.test/b?x=1", "../up.csv", "./here.csv", "a/../../b.csv", "?q=2", "#top", "sub/", "../../../x", "mailto:a@b.c", ".."]
] + [("https://e.test", "a.csv"), ("https://e.test/dir/", "a.csv")]


def test_url_resolve(evaluate):
    got = evaluate(lambda p, h: urls.url_resolve(F.col(p), F.col(h)), RESOLVE)
    assert got == [urljoin(p, h) for p, h in RESOLVE]


def test_url_parts(evaluate):
    assert evaluate(lambda c: urls.url_filename(F.col(c)), ["https://e.test/a/b.csv", "https://e.test/a/", "", None]) == ["b.csv", "a", "", ""]
    assert evaluate(lambda c: urls.url_extension(F.col(c)), ["https://e.test/a.b/c.CSV?x=1.zip", "https://e.test/a"]) == ["csv", ""]
    assert evaluate(lambda c: urls.url_canonical(F.col(c)), [" https://e.test/a// "]) == ["https://e.test/a"]


def test_paths(evaluate):
    got = evaluate(
        lambda p, t, f: paths.landing_path(F.col(p), F.col(t), F.col(f)),
        [("s/sub", "20260115T103000", "f.csv"), ("s/sub", "202", "f.csv"), ("s/sub", "2026-01-15 10:30", "f.csv")],
    )
    assert got == [
        "s/sub/download_year=2026/download_month=01/downloaded_at=20260115T103000/f.csv",
        "s/sub/download_year=unknown/download_month=unknown/downloaded_at=202/f.csv",
        "s/sub/download_year=2026/download_month=-0/downloaded_at=2026-01-15-1030/f.csv",
    ]
    got = evaluate(lambda t, p: paths.stage_relative_path(F.col(t), F.col(p)), [("s.b/x/s.b/f", "s.b"), ("a/b", "zz")])
    assert got == ["x/s.b/f", "a/b"]
    assert evaluate(lambda c: paths.load_id(paths.content_hash(F.col(c))), ["abc"]) == ["ba7816bf8f01cfea"]


def test_html(spark):
    """Links in page order, however the anchors are written; hidden parts have none."""
    page = (
        '<html><head><title>T &amp; U</title><script>var a="<a href=no>no</a>";</script></head><!-- <a href="/no">no</a> -->'
        '<body><a href="/a.csv">One <b>two</b>\n three</a><a>no href</a><A HREF=\'b.csv\' class="x">B</A>'
        '<article data-href="no">text</article><a class=q href=c.csv?x=1&amp;y=2>C</a>'
        '<a name="top"><a href="d.csv">D<a href=e.csv>E</a> <a title="x > y" href="f.csv">F</body><script><a href="g.csv">G</a>'
    )
    df = spark.createDataFrame([("https://e.test/s/", page)], "url string, html string")
    got = [tuple(r)[2:] for r in html.html_links(df).orderBy("position").collect()]
    assert got == [
        ("/a.csv", "One two three", "https://e.test/a.csv"),
        ("b.csv", "B", "https://e.test/s/b.csv"),
        ("c.csv?x=1&y=2", "C", "https://e.test/s/c.csv?x=1&y=2"),
        ("d.csv", "D", "https://e.test/s/d.csv"),
        ("e.csv", "E", "https://e.test/s/e.csv"),
        ("f.csv", "F", "https://e.test/s/f.csv"),
    ]
    assert df.select(html.html_page_text(F.col("html"))).first()[0] == "T & U One two three no href B text C D E F"


def test_month_bounds(evaluate):
    got = evaluate(lambda c: F.struct(periods.month_start(F.col(c).cast("int")), periods.month_end(F.col(c).cast("int"))), ["202402", "190002", "202512"])
    assert [tuple(v) for v in got] == [
        ("20240201T000000", "20240229T235959"),
        ("19000201T000000", "19000228T235959"),
        ("20251201T000000", "20251231T235959"),
    ]
    assert datetime(2024, 2, 29)
