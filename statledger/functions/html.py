"""Page text and links as regular-expression column work; pages stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.functions.text import collapse_whitespace, let, strip, unescape_entities
from statledger.functions.urls import url_resolve

# One leading "<" for all alternatives: other characters are passed over without trying any of them.
# A comment, script or style that is not closed goes on to the end of the page.
_HIDDEN = r"!--.*?(?:-->|\z)|script\b[^>]*>.*?(?:</script\s*>|\z)|style\b[^>]*>.*?(?:</style\s*>|\z)"
# The rest of a tag: a ">" in a quoted attribute does not end it.
_REST = r"""[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*"""
_MARKUP = rf"(?is)<(?:{_HIDDEN}|/?[a-z]{_REST}>|[^>]*>)"
# An anchor's text ends at its closing tag, or where the next anchor, a script or a style begins.
_HIDDEN_OR_ANCHOR = rf"(?is)<(?:{_HIDDEN}|a\s{_REST}>.*?(?=</?a[\s>]|<script\b|<style\b|\z))"
_ATTRIBUTES = rf"(?is)^<a(\s{_REST})>"
_HREF = r"""(?is)\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def html_page_text(html: Column) -> Column:
    """Visible text: comments, scripts, styles and tags removed, references decoded, whitespace collapsed."""
    return collapse_whitespace(unescape_entities(F.regexp_replace(html, _MARKUP, " ")))


def html_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per link of every page: page_url, position (0-based page order), href, link_text, link_url.

    The page body is dropped as soon as its links are exploded, so later shuffles carry links only.
    """
    # Hidden sections are matched as well, so that anchors inside them are not: one pass over the page.
    found = F.regexp_extract_all(F.col(html), F.lit(_HIDDEN_OR_ANCHOR), F.lit(0))
    anchors = F.filter(found, lambda piece: F.lower(F.substring(piece, 1, 2)) == "<a")

    def parsed(anchor: Column) -> Column:
        def href_in(attributes: Column) -> Column:
            values = [F.nullif(F.regexp_extract(attributes, _HREF, i), F.lit("")) for i in (1, 2, 3)]
            return strip(unescape_entities(F.coalesce(*values)))

        def link(href: Column) -> Column:
            return F.struct(
                href.alias("href"),
                html_page_text(anchor).alias("link_text"),
                url_resolve(F.col(url), href).alias("link_url"),
            )

        return let(let(F.regexp_extract(anchor, _ATTRIBUTES, 1), href_in), link)

    # Everything about a link is worked out before the explode: filters on links then stay above it instead of being
    # pushed into, and repeating, these expressions. The outer form keeps the page from being matched a second time
    # only to test for links.
    return (
        pages.select(F.col(url).alias("page_url"), F.posexplode_outer(F.transform(anchors, parsed)).alias("position", "link"))
        .select("page_url", "position", "link.*")
        .filter(F.col("href") != "")
    )
