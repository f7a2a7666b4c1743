"""First row, top rows, ranks and running sums per key that hold up when one key owns a large share of the rows.

Everything here only describes a plan: nothing runs, is counted or is written while it is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A slice of an order: an expression, and how it is sorted. Rows sorted by the whole order must be sorted by it, too.
Slice = tuple[Column, Callable[[Column], Column]]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in ``order``.

    ``row_number() = 1`` plans a partial group limit: every map task sends at most one row per key, so copies of a
    hot key never meet in one task.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int, rank_name: str | None = None
) -> DataFrame:
    """The first ``limit`` rows of every key, with their rank if ``rank_name`` is given.

    Spark trims each map task's rows to the limit before the shuffle, up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``.
    """
    name = rank_name or "__rank"
    kept = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= limit)
    return kept if rank_name else kept.drop(name)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, slices: Sequence[Slice]) -> DataFrame:
    """Row number of every row within its key; ``order`` must be total. See :func:`running_sum` for ``slices``."""
    return running_sum(df, keys, order, F.lit(1).cast("long"), name, slices)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, name: str, slices: Sequence[Slice]
) -> DataFrame:
    """Running sum of ``value`` within each key, the row itself included; ``order`` must be total.

    A key is cut into slices by value (a day of a date, say), so that a hot key is spread over tasks: each row adds what
    its slice has before it and what the key's earlier slices have in all. The latter takes one row per key and slice.
    Slices are a function of the row, so the result does not depend on how often or where rows are read.
    """
    places = [f"__slice{i}" for i in range(len(slices))]
    sliced = df.withColumns({"__value": value} | {p: expression for p, (expression, _) in zip(places, slices, strict=True)})
    sort = [direction(F.col(p)) for p, (_, direction) in zip(places, slices, strict=True)]
    group = [*keys, *places]
    earlier = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        sliced.groupBy(*group)
        .agg(F.sum("__value").alias("__sum"))
        .withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
        .select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(group)], "__before")
    )
    within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(group)]
    return (
        sliced.withColumn("__local", F.sum("__value").over(within))
        .join(before, reduce(lambda a, b: a & b, same), "inner")
        .withColumn(name, F.col("__local") + F.col("__before"))
        .select(*df.columns, name)
    )


def sort_newest_first(df: DataFrame, publication: str = "publication_date", url: str = "source_url") -> DataFrame:
    """Newest publication first, a blank one last, then URL descending."""
    return df.orderBy(F.coalesce(F.col(publication), F.lit("")).desc(), F.col(url).desc())


def limit_sample(df: DataFrame, column: str, rows: int = 25) -> DataFrame:
    """The first ``rows`` values of a column in sorted order (planned as one distributed top-k)."""
    return df.select(column).orderBy(column).limit(rows)
