"""Which period a file covers, worked out from its name, link text, URL and page text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.functions.dates import days_in_month, month_number, normalize_datetime
from statledger.functions.text import MONTH_WORD, let, plain_spaces, strip
from statledger.functions.urls import url_filename

# Order in which the evidence is tried.
EVIDENCE_SOURCES = ["file_name", "link_text", "source_url", "page_text"]

COVERAGE_COLUMNS = [
    "_SUBJECT_PERIOD_FROM",
    "_SUBJECT_PERIOD_TO",
    "_SUBJECT_PERIOD_COVERAGE_TYPE",
    "_SUBJECT_PERIOD_INFERENCE_METHOD",
    "_SUBJECT_PERIOD_INFERENCE_SOURCE",
    "_SUBJECT_PERIOD_INFERENCE_CONFIDENCE",
]

_MONTH_YEAR = rf"(?i)\b{MONTH_WORD}[\s_\-/]*\d{{2,4}}\b"


def month_tokens(text: Column) -> Column:
    """Every month-year mention as an int ``year * 100 + month``, in text order; two-digit years are 20yy."""

    def token(mention: Column) -> Column:
        year = F.regexp_extract(mention, r"(\d+)$", 1).cast("int")
        return F.when(year < 100, year + 2000).otherwise(year) * 100 + month_number(mention)

    return F.transform(F.regexp_extract_all(plain_spaces(text), F.lit(_MONTH_YEAR), F.lit(0)), token)


def month_start(yyyymm: Column) -> Column:
    """``YYYYMM01T000000`` of an int month."""
    return F.concat(F.lpad(yyyymm.cast("string"), 6, "0"), F.lit("01T000000"))


def month_end(yyyymm: Column) -> Column:
    """``YYYYMMddT235959`` with the last day of an int month."""

    def ended(month: Column) -> Column:
        last_day = days_in_month(F.floor(month / 100).cast("int"), (month % 100).cast("int"))
        return F.concat(F.lpad(month.cast("string"), 6, "0"), last_day.cast("string"), F.lit("T235959"))

    return let(yyyymm, ended)


def coverage(start: Column, end: Column, kind: Column | str, method: Column, source: Column, confidence: Column | str) -> Column:
    """Coverage struct; every branch of the inference has this type."""
    columns = [v if isinstance(v, Column) else F.lit(v) for v in (start, end, kind, method, source, confidence)]
    return F.struct(*[c.alias(name) for c, name in zip(columns, COVERAGE_COLUMNS)])


def _method(kind: str, source: Column) -> Column:
    return F.concat(F.lit(f"{kind}_from_"), source)


def unknown_coverage() -> Column:
    return coverage(F.lit(""), F.lit(""), "unknown", F.lit("not_inferred"), F.lit("none"), "low")


def coverage_yyyymm_hint(hint: Column) -> Column:
    """A six-digit hint with a real month number is trusted most."""

    def hinted(text: Column) -> Column:
        month = text.try_cast("int")
        real = text.rlike(r"^\d{6}$") & (month % 100).between(1, 12)
        method, source = F.lit("subject_period_rule_yyyymm"), F.lit("subject_period_hint")
        return F.when(real, coverage(month_start(month), month_end(month), "single_month", method, source, "high"))

    return let(strip(hint), hinted)


def coverage_single_or_range(tokens: Column, source: Column) -> Column:
    """First to last month mentioned; NULL without a mention."""
    first, last = F.array_min(tokens), F.array_max(tokens)
    single = first == last
    return F.when(
        F.size(tokens) > 0,
        coverage(
            month_start(first),
            month_end(last),
            F.when(single, "single_month").otherwise("month_range"),
            F.when(single, _method("single_month", source)).otherwise(_method("range", source)),
            source,
            F.when(single, "high").otherwise("medium"),
        ),
    )


def coverage_ytd(text: Column, tokens: Column, source: Column, fiscal_start: Column) -> Column:
    """Year to date: from the fiscal or calendar year start to the last month mentioned."""

    def up_to(last: Column) -> Column:
        year, month = F.floor(last / 100).cast("int"), last % 100
        fiscal_year = F.when(month >= fiscal_start, year).otherwise(year - 1)
        fiscal = F.when(text.rlike("(?i)fiscal|fytd"), F.lit("fiscal_ytd"))
        kind = F.coalesce(fiscal, F.when(text.rlike("(?i)year to date|ytd"), F.lit("calendar_ytd")))
        start = F.when(kind == "fiscal_ytd", fiscal_year * 100 + fiscal_start).otherwise(year * 100 + 1)
        method = F.concat(kind, F.lit("_from_"), source)
        return F.when(
            last.isNotNull() & kind.isNotNull(), coverage(month_start(start), month_end(last), kind, method, source, "medium")
        )

    return let(F.array_max(tokens), up_to)


def coverage_rolling_12(text: Column, tokens: Column, source: Column) -> Column:
    """Twelve months up to the last month mentioned."""
    last = F.array_max(tokens)
    # Eleven months earlier: the next month of the year before, or January of the same year for December.
    start = F.when(last % 100 == 12, last - 11).otherwise(last - 99)
    return F.when(
        last.isNotNull() & text.rlike("(?i)rolling 12|12 month rolling"),
        coverage(month_start(start), month_end(last), "rolling_12_month", _method("rolling_12", source), source, "medium"),
    )


def coverage_daily(text: Column, source: Column) -> Column:
    """The whole text is one date."""

    def dated(day: Column) -> Column:
        start, end = F.concat(day, F.lit("T000000")), F.concat(day, F.lit("T235959"))
        return F.when(day.isNotNull(), coverage(start, end, "daily", _method("daily", source), source, "low"))

    return let(F.substring(normalize_datetime(text), 1, 8), dated)


def link_subject_period(link_text: Column, url: Column) -> Column:
    """(from, to, method) from the months in the link text, else in the URL."""

    def by(text: Column, source: str) -> Column:
        def found(tokens: Column) -> Column:
            method = F.when(F.size(tokens) > 1, f"range_from_{source}").otherwise(f"single_month_from_{source}")
            return F.when(
                F.size(tokens) > 0,
                F.struct(
                    month_start(F.array_min(tokens)).alias("period_from"),
                    month_end(F.array_max(tokens)).alias("period_to"),
                    method.alias("method"),
                ),
            )

        return let(month_tokens(text), found)

    nothing = F.struct(F.lit("").alias("period_from"), F.lit("").alias("period_to"), F.lit("not_inferred").alias("method"))
    return F.coalesce(by(link_text, "link_text"), by(url, "url"), nothing)


def infer_period_coverage(
    df: DataFrame,
    hint: Column,
    link_text: Column,
    source_url: Column,
    page_text: Column,
    duration_type: Column | None = None,
    duration_value: Column | None = None,
    duration_unit: Column | None = None,
    fiscal_start_month: Column | None = None,
) -> DataFrame:
    """Add the six coverage columns.

    Order: month hint; then, where the target declares a rolling or year-to-date file, that reading of every
    source; then per source rolling, year to date, months, single day; else unknown. The four sources are an array
    in that order, read by one expression; the first reading that is not NULL counts.
    """
    duration_type = duration_type if duration_type is not None else F.lit("unknown")
    duration_value = duration_value if duration_value is not None else F.lit(None).cast("int")
    duration_unit = duration_unit if duration_unit is not None else F.lit(None).cast("string")
    fiscal = F.coalesce(F.nullif(fiscal_start_month, F.lit(0)), F.lit(4)) if fiscal_start_month is not None else F.lit(4)

    evidence = [url_filename(source_url), link_text, source_url, page_text]
    sources = F.array(
        *[
            F.struct(F.lit(name).alias("source"), F.coalesce(text, F.lit("")).alias("text"))
            for name, text in zip(EVIDENCE_SOURCES, evidence)
        ]
    )

    nothing_yet = F.lit(None).cast("struct<" + ",".join(f"{c}:string" for c in COVERAGE_COLUMNS) + ">")

    def first_reading(read: Callable[[Column, Column], Column]) -> Column:
        """The first source ``read`` makes something of; the sources after it are not looked at."""
        return F.aggregate(
            sources,
            nothing_yet,
            lambda found, e: F.coalesce(found, let(month_tokens(e.text), lambda months: read(e, months))),
        )

    def rolling(e: Column, months: Column) -> Column:
        return coverage_rolling_12(e.text, months, e.source)

    def ytd(e: Column, months: Column) -> Column:
        return coverage_ytd(e.text, months, e.source, fiscal)

    def accepted_ytd(e: Column, months: Column) -> Column:
        # A declared fiscal file does not accept a calendar reading.
        fits = lambda c: (duration_type != "fiscal_ytd") | (c["_SUBJECT_PERIOD_COVERAGE_TYPE"] == "fiscal_ytd")
        return let(ytd(e, months), lambda c: F.when(fits(c), c))

    def any_kind(e: Column, months: Column) -> Column:
        day = F.when(F.size(months) == 0, coverage_daily(e.text, e.source))
        return F.coalesce(rolling(e, months), ytd(e, months), coverage_single_or_range(months, e.source), day)

    rolling_declared = (duration_type == "rolling") & (duration_value == 12) & (duration_unit == "month")
    ytd_declared = duration_type.isin("calendar_ytd", "fiscal_ytd")
    chosen = F.coalesce(
        coverage_yyyymm_hint(hint),
        F.when(rolling_declared, first_reading(rolling)),
        F.when(ytd_declared, first_reading(accepted_ytd)),
        first_reading(any_kind),
        unknown_coverage(),
    )
    return (
        df.withColumn("__coverage", chosen)
        .withColumns({name: F.col(f"__coverage.{name}") for name in COVERAGE_COLUMNS})
        .drop("__coverage")
    )
