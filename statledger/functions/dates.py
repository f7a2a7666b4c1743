"""Free text to compact ISO date strings, as JVM-side column expressions.

Values are ``YYYYMMDDTHHMMSS`` strings, so they compare as text. Nothing here goes through a timestamp type:
the result does not depend on the session time zone, and an impossible date gives NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from statledger.functions.text import MONTH_NAMES, MONTHS, collapse_whitespace, first_regex_value, let, strip_ordinals

# Fixed value: publication strings below this are not believed.
MIN_PLAUSIBLE_PUBLICATION = "20100101T000000"

# Where a page states its date, in order of preference.
PAGE_DATE_PATTERNS = [
    r"(?:published|last\s*updated)\s*:?\s*(\d{1,2}\s+[A-Za-z]{3,9}\s+\d{4}(?:\s+\d{1,2}:\d{2}(?::\d{2})?)?)",
    r"(?:published|last\s*updated)\s*:?\s*([A-Za-z]{3,9}\s+\d{4})",
    r"(?:published|last\s*updated)\s*:?\s*(\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}(?::\d{2})?)?)",
]

_FULL_OR_SHORT_MONTH = f"(?:{MONTH_NAMES})"
_SHORT_MONTH = "(?:" + "|".join(m[:3] for m in MONTHS) + ")"


def month_number(name: Column) -> Column:
    """1-12 from the first three letters of a month name, any case; the caller has checked that it is one."""
    short = F.lower(F.substring(name, 1, 3))
    return ((F.instr(F.lit("".join(m[:3] for m in MONTHS)), short) + 2) / 3).cast("int")


def days_in_month(year: Column, month: Column) -> Column:
    """Days of a month 1-12; NULL for another month number."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    common = F.get(F.expr("array(31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)"), month - 1)
    return F.when((month == 2) & leap, F.lit(29)).otherwise(common)


def _int(text: Column) -> Column:
    # An absent part is '' or NULL: it is kept away from the cast, whose failure path is slow.
    return F.nullif(text, F.lit("")).try_cast("int")


def _parts(year: Column, month: Column, *rest: Column) -> Column:
    """[year, month, day, hour, minute, second] as ints; what is not given is the first day or zero."""
    defaults = [F.lit(1), F.lit(0), F.lit(0), F.lit(0)]
    return F.array(year, month, *rest, *defaults[len(rest) :])


def compact_datetime(parts: Column) -> Column:
    """``YYYYMMDDTHHMMSS`` of six int parts; NULL for an impossible date or time."""

    def written(p: Column) -> Column:
        year, month, day, hour, minute, second = (p[i] for i in range(6))
        hour, minute, second = (F.coalesce(c, F.lit(0)) for c in (hour, minute, second))
        possible = (
            year.between(1, 9999)
            & day.between(1, days_in_month(year, month))
            & hour.between(0, 23)
            & minute.between(0, 59)
            & second.between(0, 59)
        )
        date, time = year * 10000 + month * 100 + day, hour * 10000 + minute * 100 + second
        return F.when(
            possible,
            F.concat(F.lpad(date.cast("string"), 8, "0"), F.lit("T"), F.lpad(time.cast("string"), 6, "0")),
        )

    return let(parts, written)


def _numeric_parts(text: Column) -> Column:
    """``yyyyMMdd``, ISO date, ISO datetime with or without seconds."""
    shape = r"^(?:\d{8}|\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}(?::\d{2})?)?)$"

    def of_digits(digits: Column) -> Column:
        spans = [(1, 4), (5, 2), (7, 2), (9, 2), (11, 2), (13, 2)]
        return F.array(*[_int(F.substring(digits, at, width)) for at, width in spans])

    return F.when(text.rlike(shape), let(F.translate(text, "-:T", ""), of_digits))


def _fiscal_parts(text: Column) -> Column:
    pattern = rf"(?i)^(\d{{4}})\s+\d{{2}}\s+({_SHORT_MONTH})"

    def of_spaced(spaced: Column) -> Column:
        month = month_number(F.regexp_extract(spaced, pattern, 2))
        second_year = F.when(month <= 3, F.lit(1)).otherwise(F.lit(0))
        year = _int(F.regexp_extract(spaced, pattern, 1)) + second_year
        return F.when(spaced.rlike(pattern), _parts(year, month))

    return let(F.translate(text, "_-", "  "), of_spaced)


def _written_parts(text: Column) -> Column:
    """``[d] Month yyyy`` with an optional time; ``_`` and ``-`` read as spaces."""
    with_day = rf"(?i)^\d{{1,2}}\s+{_FULL_OR_SHORT_MONTH}\s+\d{{4}}(?:\s+\d{{1,2}}:\d{{1,2}}(?::\d{{1,2}})?)?$"
    without_day = rf"(?i)^{_FULL_OR_SHORT_MONTH}\s+\d{{4}}$"

    def of_words(words: Column) -> Column:
        at = [F.get(words, F.lit(i)) for i in range(6)]
        return _parts(_int(at[2]), month_number(at[1]), _int(at[0]), _int(at[3]), _int(at[4]), _int(at[5]))

    def of_spaced(spaced: Column) -> Column:
        dated = F.when(spaced.rlike(with_day), spaced).when(spaced.rlike(without_day), F.concat(F.lit("1 "), spaced))
        return let(F.split(dated, r"[\s:]+"), lambda words: F.when(words.isNotNull(), of_words(words)))

    return let(F.trim(F.translate(text, "_-", "  ")), of_spaced)


def _compact_month_parts(text: Column) -> Column:
    pattern = rf"(?i)^({_SHORT_MONTH}|sept)(\d{{2}}|\d{{4}})$"

    def of_packed(packed: Column) -> Column:
        year = _int(F.regexp_extract(packed, pattern, 2))
        full_year = F.when(packed.rlike(r"\D\d\d$"), year + 2000).otherwise(year)
        return F.when(packed.rlike(pattern), _parts(full_year, month_number(packed)))

    return let(F.translate(text, " _-", ""), of_packed)


def fiscal_month_date(text: Column) -> Column:
    """``2025-26_march``: January to March fall into the second calendar year of the fiscal year."""
    return compact_datetime(_fiscal_parts(text))


def compact_month_date(text: Column) -> Column:
    """``Mar26``, ``Sept2026``: first day of the month; a two-digit year is 20yy."""
    return compact_datetime(_compact_month_parts(text))


def normalize_datetime(value: Column) -> Column:
    """Free text to ``YYYYMMDDTHHMMSS``; NULL when no known shape fits."""
    cleaned = strip_ordinals(collapse_whitespace(F.translate(value, ",", " ")))

    def of_cleaned(text: Column) -> Column:
        shapes = [_numeric_parts(text), _fiscal_parts(text), _written_parts(text), _compact_month_parts(text)]
        already = F.when(text.rlike(r"^\d{8}T\d{6}$"), text)
        return F.coalesce(already, compact_datetime(F.coalesce(*shapes)))

    # Every shape has a digit; most texts that are not dates have none.
    return F.when(value.rlike(r"\d"), let(cleaned, of_cleaned))


def subject_period_yyyymm(value: Column) -> Column:
    """``YYYYMM`` of a free-text date."""
    return F.substring(normalize_datetime(value), 1, 6)


def extract_by_pattern(text: Column, pattern: str) -> Column:
    """Date in the first match of a regular expression."""
    return normalize_datetime(first_regex_value(text, pattern))


def extract_by_selectors(text: Column, patterns: Sequence[str]) -> Column:
    """Date of the first pattern that gives one."""
    return F.coalesce(*[extract_by_pattern(text, p) for p in patterns]) if patterns else F.lit(None).cast("string")


def extract_page_publication(page_text: Column) -> Column:
    """Date a page states after "published" or "last updated"."""
    return extract_by_selectors(page_text, PAGE_DATE_PATTERNS)


def _rule_text(source: str, link_text: Column, url: Column) -> Column:
    """Text a publication rule reads: the link text, else the URL, unless the rule names the one it wants."""
    if source == "url_segment":
        return url
    if source == "link_text":
        return link_text
    return F.coalesce(F.nullif(link_text, F.lit("")), url)


def publication_date_choice(page_date: Column, link_text: Column, url: Column, source: str, pattern: str) -> Column:
    """The page's own date, else the publication rule applied to link text or URL."""
    return F.coalesce(page_date, extract_by_pattern(_rule_text(source, link_text, url), pattern))


def subject_period_rules(
    rules: Sequence[tuple[str, str]], link_text: Column, url: Column, page_text: Column, file_name: Column
) -> Column:
    """``YYYYMM`` of the first (source, pattern) rule that gives a period."""
    sources = {
        "file_name": file_name,
        "filename": file_name,
        "url_segment": url,
        "page_text": page_text,
        "page_elements": page_text,
        "link_text": link_text,
    }
    fallback = F.coalesce(F.nullif(link_text, F.lit("")), url)
    periods = [F.substring(extract_by_pattern(sources.get(s, fallback), p), 1, 6) for s, p in rules]
    return F.coalesce(*periods) if periods else F.lit(None).cast("string")


def plausible_publication(value: Column, minimum: str = MIN_PLAUSIBLE_PUBLICATION) -> Column:
    """The publication string if it is at least ``minimum`` as text, else ``''``."""
    return F.when(value >= minimum, value).otherwise(F.lit(""))


def publication_source_flag(publication_date: Column) -> Column:
    """``scraped`` for a non-empty publication date, else ``none``."""
    return F.when(publication_date != "", F.lit("scraped")).otherwise(F.lit("none"))
