"""Text, naming and identifier expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "nothing here" in inventories.
NONE_LIKE = ["", "none", "n/a", "na"]

MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
# Alternations of month names: full and three-letter ones, and as they appear in running text.
MONTH_NAMES = "|".join(MONTHS + [m[:3] for m in MONTHS])
MONTH_WORD = f"(?:{'|'.join([*MONTHS, 'sept', *[m[:3] for m in MONTHS]])})"

# White space beyond ASCII (no-break spaces among it). The engine's ``\\s`` and ``trim`` know ASCII only, so these are
# turned into plain spaces before a text is matched.
WIDE_SPACES = "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
ALL_SPACES = " \t\n\x0b\f\r" + WIDE_SPACES

# Assertions about what surrounds a match: with one, groups must be read from the whole text.
_LOOKS_AROUND = re.compile(r"\(\?[=!<]|\\[bBAZzG]|[$^]")

# Where a name splits into words: acronym|Word, lower-or-digit|Upper, and any run of other characters.
_WORD_BREAK = "(?<=[A-Z])(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])|[^A-Za-z0-9]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` mentions it.

    Keeps nested expressions small: without it every mention repeats the whole input expression in the plan.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def plain_spaces(text: Column) -> Column:
    """White space beyond ASCII as plain spaces, one for one."""
    return F.translate(text, WIDE_SPACES, " " * len(WIDE_SPACES))


def strip(text: Column) -> Column:
    """Without any white space at the ends."""
    return F.trim(text, F.lit(ALL_SPACES))


def collapse_whitespace(text: Column) -> Column:
    """Runs of whitespace become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(plain_spaces(text), r"\s+", " "))


def strip_ordinals(text: Column) -> Column:
    """``1st``/``22nd`` -> ``1``/``22``."""
    return F.regexp_replace(text, r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b", "$1")


def screaming_snake_name(name: str) -> str:
    """SCREAMING_SNAKE form of one column name (driver side, over ``df.columns``)."""
    return "_".join(filter(None, re.split(_WORD_BREAK, name))).upper()


def screaming_snake(text: Column) -> Column:
    """The same naming rule as a column expression."""
    return F.upper(F.trim(F.regexp_replace(text, _WORD_BREAK, "_"), F.lit("_")))


def normalize_identifier(text: Column) -> Column:
    """``-``, space and ``/`` become ``_``; upper case."""
    return F.upper(F.translate(text, "- /", "___"))


def _squeeze(text: Column, keep: str, filler: str) -> Column:
    return F.trim(F.regexp_replace(text, f"[^{keep}]+", filler), F.lit(filler))


def _or_default(text: Column, default: str) -> Column:
    return F.when(text == "", F.lit(default)).otherwise(text)


def name_token(text: Column) -> Column:
    """Upper-case token of letters and digits joined by ``_``; empty text gives ``DEFAULT``."""
    return _or_default(F.upper(_squeeze(text, "A-Za-z0-9", "_")), "DEFAULT")


def object_suffix(dataset_id: Column, sub_dataset_id: Column) -> Column:
    """Table-name suffix of a (dataset, sub-dataset) pair."""
    return F.concat_ws("_", name_token(dataset_id), name_token(sub_dataset_id))


def slugify(text: Column) -> Column:
    """Lower-case dash-joined id; empty text gives ``unknown-dataset``."""
    return _or_default(_squeeze(F.lower(text), "a-z0-9", "-"), "unknown-dataset")


def slugify_sheet(text: Column) -> Column:
    """Sheet name safe for a file name; empty text gives ``sheet``."""
    return _or_default(_squeeze(text, "A-Za-z0-9", "_"), "sheet")


def is_none_like(text: Column) -> Column:
    return F.lower(strip(F.coalesce(text, F.lit("")))).isin(NONE_LIKE)


def clean_none_like(text: Column) -> Column:
    """Trimmed lower-case id; a none-like text gives ``default``."""
    return F.when(is_none_like(text), F.lit("default")).otherwise(F.lower(strip(text)))


# The patterns of the next three are fixed values: what they drop or tell apart is part of the result.


def generalize_link_text(text: Column) -> Column:
    """Drop bracketed parts, month-year mentions and bare years, so the text fits every release."""
    text = F.regexp_replace(plain_spaces(text), r"\([^)]*\)", " ")
    text = F.regexp_replace(text, rf"(?i)\b(?:{MONTH_NAMES}|sept)\b\s*[-/]?\s*\d{{2,4}}\b", " ")
    return collapse_whitespace(F.regexp_replace(text, r"\b\d{4}\b", " "))


def contains_date_text(text: Column) -> Column:
    """True where the text shows ``15 Mar 2026``, ``Mar 2026`` or ``2026-03-15``."""
    return plain_spaces(text).rlike(r"\b[A-Za-z]{3,9}\s+\d{4}\b|\b\d{4}-\d{2}-\d{2}\b")


def period_pattern_type(text: Column) -> Column:
    """How periods are written in ``text``: fiscal year and month, compact month-year, or month and year."""
    return (
        F.when(text.rlike(rf"(?i)\d{{4}}[-/]\d{{2}}[-\s_/](?:{MONTH_NAMES})"), F.lit("fiscal_year_and_month"))
        .when(text.rlike(rf"(?i)(?:{MONTH_NAMES})\d{{2,4}}"), F.lit("compact_month_year"))
        .otherwise(F.lit("month_year"))
    )


def first_regex_value(text: Column, pattern: str) -> Column:
    """Non-empty groups of the first case-insensitive match joined by ``_``; the whole match if there are none.

    NULL without a match. The number of groups is known from the pattern, so this stays one column expression.
    """
    insensitive = f"(?i){pattern}"
    groups = re.compile(pattern).groups
    text = plain_spaces(text)

    def joined(text: Column) -> Column:
        parts = [F.nullif(F.regexp_extract(text, insensitive, i), F.lit("")) for i in range(1, groups + 1)]
        return F.coalesce(F.nullif(F.concat_ws("_", *parts), F.lit("")), F.regexp_extract(text, insensitive, 0))

    if _LOOKS_AROUND.search(pattern):
        return F.when(text.rlike(insensitive), let(text, joined))
    # The text is searched once; the groups are read from what matched.
    return let(F.regexp_extract(text, insensitive, 0), lambda match: F.when(match != "", joined(match)))


def unescape_entities(text: Column) -> Column:
    """Decode named and numeric character references; unknown ones stay as written."""
    names = F.create_map(
        *[F.lit(part) for name, code in name2codepoint.items() for part in (name, chr(code))],
        F.lit("apos"),
        F.lit("'"),
    )
    body = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);"

    def decode(piece: Column) -> Column:
        reference = F.regexp_extract(piece, body, 1)
        rest = F.substr(piece, F.length(reference) + 2)
        digits = F.when(
            reference.rlike("^#[xX]"), F.regexp_replace(reference, "^#[xX]", "")
        ).otherwise(F.conv(F.regexp_replace(reference, "^#", ""), 10, 16))
        is_code = reference.startswith("#") & (F.length(digits) <= 6)
        char = F.when(is_code, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")).otherwise(
            F.try_element_at(names, reference)
        )
        return F.when((reference != "") & char.isNotNull(), F.concat(char, rest)).otherwise(
            F.concat(F.lit("&"), piece)
        )

    def decode_all(pieces: Column) -> Column:
        references = F.transform(F.slice(pieces, 2, F.size(pieces)), decode)
        return F.concat(F.element_at(pieces, 1), F.array_join(references, ""))

    return let(text, lambda t: F.when(t.contains("&"), let(F.split(t, "&"), decode_all)).otherwise(t))
