"""Which table a file or sheet goes to: ordered pattern rules as one conditional expression."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.functions.paths import content_hash


@dataclass(frozen=True)
class RouteRule:
    """Names matching any pattern go to ``prefix`` (and the table ``suffix``)."""

    suffix: str
    prefix: str
    patterns: Sequence[str]


def _any_pattern(patterns: Sequence[str]) -> str:
    for pattern in patterns:
        re.compile(pattern)
    return "(?i)" + "|".join(f"(?:{p})" for p in patterns)


def first_rule(name: Column, rules: Sequence[RouteRule], field: str) -> Column:
    """``field`` of the first rule that matches ``name``; NULL if none does.

    Rules are configuration on the driver, so they become one CASE: no join, no shuffle, first match wins.
    """
    usable = [r for r in rules if r.patterns]
    branches = [F.when(name.rlike(_any_pattern(r.patterns)), F.lit(getattr(r, field))) for r in usable]
    return F.coalesce(*branches) if branches else F.lit(None).cast("string")


def route_filename_rules(
    files: DataFrame, rules: Sequence[RouteRule], parent_prefix: str, file_name: str = "file_name", sheet_prefix: str | None = None
) -> DataFrame:
    """Add ``path_prefix``: the one a sheet rule gave, else the first matching file-name rule, else the parent's."""
    decided = [F.col(sheet_prefix)] if sheet_prefix else []
    return files.withColumn(
        "path_prefix", F.coalesce(*decided, first_rule(F.col(file_name), rules, "prefix"), F.lit(parent_prefix))
    )


def route_sheet_rules(sheets: DataFrame, rules: Sequence[RouteRule], sheet: str = "sheet") -> DataFrame:
    """Sheets claimed by their first matching rule (adds object_suffix and path_prefix); unmatched sheets are dropped."""
    return sheets.withColumns(
        {
            "object_suffix": first_rule(F.col(sheet), rules, "suffix"),
            "path_prefix": first_rule(F.col(sheet), rules, "prefix"),
        }
    ).filter(F.col("path_prefix").isNotNull())


def unrouted_workbooks(sheets: DataFrame, rules: Sequence[RouteRule], file: str = "file", sheet: str = "sheet") -> DataFrame:
    """Workbooks none of whose sheets a rule matches: a load error of each."""
    matched = first_rule(F.col(sheet), rules, "prefix").isNotNull()
    return sheets.groupBy(file).agg(F.max(matched).alias("matched")).filter(~F.col("matched")).select(file)


def output_hash_rule(outputs: DataFrame) -> DataFrame:
    """Add ``content_hash`` to outputs (source, is_archive, source_hash, content).

    The only output of a workbook keeps the hash of its source; several outputs and archive members are hashed each.
    Outputs are counted on (source) alone and joined back, so contents are not gathered per source.
    """
    counts = outputs.groupBy("source").agg(F.count("*").alias("__outputs"))
    # Hashed before the join: where the content itself is not asked for, only its hash is shuffled.
    hashed = outputs.withColumn("__own_hash", content_hash(F.col("content")))
    own = F.col("is_archive") | (F.col("__outputs") > 1)
    chosen = F.when(own, F.col("__own_hash")).otherwise(F.col("source_hash"))
    return hashed.join(counts, "source").withColumn("content_hash", chosen).drop("__outputs", "__own_hash")
