"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statledger.functions.text import let, strip

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def url_path(url: Column) -> Column:
    """Path part of a URL, without host, query and fragment."""
    return F.regexp_extract(url, _PATH, 1)


def url_filename(url: Column) -> Column:
    """Last segment of the URL as written, trailing slashes ignored."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"([^/]*)/*$", 1)


def url_extension(url: Column) -> Column:
    """Lower-case text after the last dot of the URL path; empty without a dot."""
    return F.lower(F.regexp_extract(url_path(url), r"\.([^.]*)$", 1))


def url_canonical(url: Column) -> Column:
    """Trimmed URL without trailing slashes."""
    return F.regexp_replace(strip(url), "/+$", "")


def _remove_dot_segments(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path, any depth, in one fold."""
    segments = F.split(path, "/")
    folded = F.aggregate(
        F.slice(segments, 2, F.size(segments)),
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
        .when(part == ".", kept)
        .otherwise(F.concat(kept, F.array(part))),
    )
    directory = path.rlike(r"/\.{1,2}$")
    return F.concat(F.lit("/"), F.array_join(folded, "/"), F.when(directory & (F.size(folded) > 0), "/").otherwise(""))


def url_resolve(page_url: Column, href: Column) -> Column:
    """Absolute URL of ``href`` found on ``page_url``."""
    origin = F.regexp_extract(page_url, _ORIGIN, 1)
    base_path = url_path(page_url)
    base_no_query = F.regexp_extract(page_url, r"^([^?#]*)", 1)
    base_no_fragment = F.regexp_extract(page_url, r"^([^#]*)", 1)
    href_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    href_tail = F.substr(href, F.length(href_path) + 1)
    directory = F.coalesce(F.nullif(F.regexp_extract(base_path, r"^(.*/)", 1), F.lit("")), F.lit("/"))
    joined = F.when(href.startswith("/"), href_path).otherwise(F.concat(directory, href_path))
    resolved = let(joined, lambda path: F.when(path.rlike(r"/\.{1,2}(?:/|$)"), _remove_dot_segments(path)).otherwise(path))
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href == "", page_url)
        .when(href.startswith("//"), F.concat(F.regexp_extract(page_url, _SCHEME, 0), href))
        .when(href.startswith("#"), F.concat(base_no_fragment, href))
        .when(href.startswith("?"), F.concat(base_no_query, href))
        .otherwise(F.concat(origin, resolved, href_tail))
    )
