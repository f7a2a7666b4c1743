"""Columns in and out: evolving unions, naming, wide to long, cropped sheets."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.functions.text import screaming_snake_name
from statledger.schemas import METADATA_COLUMNS


def project_exclude(df: DataFrame, *columns: str) -> DataFrame:
    """All columns but these."""
    return df.drop(*columns)


def unique_names(names: Iterable[str]) -> list[str]:
    """Column names of a header, told apart in any case: a repeated one gets ``_1``, ``_2``, an empty one its place."""
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    result = []
    for place, given in enumerate(names):
        base = name = given or f"column{place}"
        while name.lower() in taken:
            repeats[base.lower()] = repeats.get(base.lower(), 0) + 1
            name = f"{base}_{repeats[base.lower()]}"
        taken.add(name.lower())
        result.append(name)
    return result


def schema_evolve_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames with different columns by name (any case); what a frame lacks reads NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def match_columns_by_name(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Arrange ``df`` as ``target_columns`` by case-insensitive name; absent columns read NULL, extra ones follow."""
    present = {name.lower(): name for name in df.columns}
    targets = [
        F.col(f"`{present[t.lower()]}`").alias(t) if t.lower() in present else F.lit(None).cast("string").alias(t)
        for t in target_columns
    ]
    wanted = {t.lower() for t in target_columns}
    return df.select(*targets, *[F.col(f"`{name}`") for name in df.columns if name.lower() not in wanted])


def union_all_tables(frames: Mapping[str, DataFrame], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """``union all`` of same-shaped frames; an empty typed frame if there are none."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), frames.values())


def aliases(columns: Iterable[str], keep: Iterable[str] = METADATA_COLUMNS) -> list[str]:
    """Presentation names: metadata names unchanged, others SCREAMING_SNAKE, a repeated name gets its 1-based place."""
    kept, taken, result = set(keep), set(), []
    for place, column in enumerate(columns, start=1):
        name = column if column in kept else screaming_snake_name(column)
        name = f"{name}_{place}" if name in taken else name
        taken.add(name)
        result.append(name)
    return result


def alias_columns(df: DataFrame, keep: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """Rename every column to its presentation name."""
    return df.toDF(*aliases(df.columns, keep))


def unpivot_wide(
    df: DataFrame, id_columns: Sequence[str], variable_column: str, value_column: str = "value"
) -> DataFrame:
    """Every column that is not an id becomes a (variable, value) row; values as text, NULL cells kept."""
    missing = [c for c in id_columns if c not in df.columns]
    if missing:
        raise ValueError(f"id columns not in the table: {missing}")
    melted = [c for c in df.columns if c not in id_columns]
    text = df.select(*[F.col(f"`{c}`") for c in id_columns], *[F.col(f"`{c}`").cast("string").alias(c) for c in melted])
    return text.unpivot([F.col(f"`{c}`") for c in id_columns], [F.col(f"`{c}`") for c in melted], variable_column, value_column)


def parse_start_cell(cell: str | None) -> tuple[int, int]:
    """1-based (row, column) of a reference such as ``B5``; nothing given is the top left."""
    if not cell:
        return 1, 1
    match = re.fullmatch(r"([A-Za-z]+)([0-9]+)", cell)
    if not match:
        raise ValueError(f"not a cell reference: {cell}")
    column = reduce(lambda total, letter: total * 26 + ord(letter) - ord("A") + 1, match[1].upper(), 0)
    return int(match[2]), column


def sheet_select_named(cells: DataFrame, sheet: str | None = None) -> DataFrame:
    """Cells of the named sheet, or of each workbook's first sheet (columns file, sheet_index, sheet, row, col, value)."""
    if sheet:
        return cells.filter(F.col("sheet") == sheet)
    first = cells.groupBy("file").agg(F.min("sheet_index").alias("sheet_index"))
    return cells.join(first, ["file", "sheet_index"], "left_semi")


def sheet_start_cell(cells: DataFrame, start_cell: str | None) -> DataFrame:
    """Crop sheets at ``start_cell`` and name every data cell by its column's header cell.

    Output is long: file, sheet, row (1-based, below the header), col, column_name, value. Nothing is gathered per
    sheet; the header row is joined back on (file, sheet, col).
    """
    header_row, first_col = parse_start_cell(start_cell)
    cropped = cells.filter((F.col("row") >= header_row) & (F.col("col") >= first_col))
    header = cropped.filter(F.col("row") == header_row).select("file", "sheet", "col", F.col("value").alias("column_name"))
    data = cropped.filter(F.col("row") > header_row).withColumn("row", F.col("row") - header_row)
    return data.join(header, ["file", "sheet", "col"], "left").select("file", "sheet", "row", "col", "column_name", "value")


def cells_to_table(named_cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Named cells back to one row per (file, sheet, row) with the given columns."""
    values = [F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns]
    return named_cells.groupBy("file", "sheet", "row").agg(*values)
