"""From append-only loads to the current revision of every reporting period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statledger.operators.ordering import Slice, first_per_key, rank_within
from statledger.operators.shape import alias_columns
from statledger.schemas import SIDECAR_VIEW_DEFAULTS

ROW_KEYS = ["_FILE_CONTENT_KEY", "_FILE_ROW_NUMBER"]
FILE_KEYS = ["_SOURCE_FILE_NAME", "_SOURCE_FILE_PATH", "_INGESTED_AT"]
SUBJECT_PERIOD = ["_SUBJECT_PERIOD_FROM", "_SUBJECT_PERIOD_TO"]
# Files covering these spans overlap, so one without reporting columns has no single current revision.
OVERLAPPING_DURATIONS = ("rolling", "calendar_ytd", "fiscal_ytd")


def latest_load_order() -> list[Column]:
    return [F.col("_INGESTED_AT").desc(), F.col("_SOURCE_FILE_PATH").desc(), F.col("_SOURCE_FILE_NAME").desc()]


def dedup_latest_ingest(ingest: DataFrame) -> DataFrame:
    """Of repeated loads of one file row keep the latest; equal times are decided by path and name."""
    return first_per_key(ingest, ROW_KEYS, latest_load_order())


def join_sidecar_left(rows: DataFrame, sidecar: DataFrame) -> DataFrame:
    """Add the sidecar columns of the view to rows of the file they describe.

    A plain join: Spark broadcasts the sidecar if its measured bytes allow, and otherwise shuffles, where adaptive
    execution splits a file that holds an outsized share of the rows. The sidecar is read when the result is.
    """
    names = {c.lower() for c in sidecar.columns}
    columns = [
        F.col(f"m.{c}") if c.lower() in names else F.lit(None).cast("string").alias(c) for c in SIDECAR_VIEW_DEFAULTS
    ]
    needed = ["_PAYLOAD_STAGE_PATH", *[c for c in SIDECAR_VIEW_DEFAULTS if c.lower() in names]]
    described = sidecar.select(*needed)
    joined = rows.alias("p").join(
        described.alias("m"), F.col("p._SOURCE_FILE_PATH") == F.col("m._PAYLOAD_STAGE_PATH"), "left"
    )
    return joined.select("p.*", *columns)


def coalesce_sidecar_defaults(df: DataFrame) -> DataFrame:
    """Replace NULL sidecar values by their defaults; the two numeric ones stay NULL."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(d)) for c, d in SIDECAR_VIEW_DEFAULTS.items() if d is not None and c in df.columns}
    )


def raw_view(ingest: DataFrame, sidecar: DataFrame, view_name: str | None = None) -> DataFrame:
    """Deduplicated rows with sidecar metadata; published as a replaceable view if named."""
    return described_view(dedup_latest_ingest(ingest), sidecar, view_name)


def described_view(latest: DataFrame, sidecar: DataFrame, view_name: str | None = None) -> DataFrame:
    """The same of rows of which only the latest loads are left."""
    raw = latest.transform(join_sidecar_left, sidecar).transform(coalesce_sidecar_defaults)
    if view_name:
        raw.createOrReplaceTempView(view_name)
    return raw


def presentation_select(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Presentation names plus ``_LOADED_AT``, rows with both period columns; ``strict`` also drops empty ones."""
    kept = raw
    for column in SUBJECT_PERIOD:
        value = F.nullif(F.col(column), F.lit("")) if strict else F.col(column)
        kept = kept.filter(value.isNotNull())
    return alias_columns(kept).withColumn("_LOADED_AT", F.current_timestamp())


def distinct_file_periods(presentation: DataFrame, period_columns: Sequence[str] = ()) -> DataFrame:
    """Which file covers which period, published when."""
    return presentation.select(*FILE_KEYS, *(period_columns or SUBJECT_PERIOD), "_PUBLICATION_DATE").distinct()


def _publication_order() -> list[Column]:
    return [
        F.col("_PUBLICATION_DATE").desc_nulls_last(),
        F.col("_INGESTED_AT").desc(),
        F.col("_SOURCE_FILE_PATH").desc(),
        F.col("_SOURCE_FILE_NAME").desc(),
    ]


def publication_rank(presentation: DataFrame, period_columns: Sequence[str] = ()) -> DataFrame:
    """Every file of a period ranked, latest publication first; a period is cut into its days of publication."""
    periods = list(period_columns or SUBJECT_PERIOD)
    files = distinct_file_periods(presentation, periods)
    return rank_within(files, periods, _publication_order(), "_PUBLICATION_RANK", [_day_of_publication(Column.desc_nulls_last)])


def _day_of_publication(direction) -> Slice:
    return F.substring("_PUBLICATION_DATE", 1, 8), direction


def join_current_revision(presentation: DataFrame, ranks: DataFrame, period_columns: Sequence[str] = ()) -> DataFrame:
    """Rows of the files ranked 1; a NULL period matches nothing.

    The winners are one narrow row per file and period; Spark broadcasts them where their measured bytes allow.
    """
    keys = [*FILE_KEYS, *(period_columns or SUBJECT_PERIOD)]
    winners = ranks.filter(F.col("_PUBLICATION_RANK") == 1).select(*keys)
    return presentation.join(winners, keys, "inner").select(*[F.col(f"`{c}`") for c in presentation.columns])


def current_revision(
    raw: DataFrame, period_columns: Sequence[str] = (), duration_type: str = "unknown", strict: bool = False
) -> DataFrame | None:
    """Presentation rows of the current revision of every period.

    None when files overlap by design and no reporting columns tell their rows apart. Only the best file per period is
    wanted, so the ranking is a group limit and never gathers a period's files.
    """
    if not period_columns and duration_type in OVERLAPPING_DURATIONS:
        return None
    presentation = presentation_select(raw, strict)
    periods = list(period_columns or SUBJECT_PERIOD)
    best = first_per_key(distinct_file_periods(presentation, periods), periods, _publication_order())
    return join_current_revision(presentation, best.withColumn("_PUBLICATION_RANK", F.lit(1)), periods)


def _revision_order() -> list[Column]:
    """Seven keys: stated publication, publication, stated period end, period end, download, load, path."""
    return [
        F.when(F.coalesce(F.col("_PUBLICATION_DATE"), F.lit("")) != "", F.lit(1)).otherwise(F.lit(0)).desc(),
        F.col("_PUBLICATION_DATE").desc(),
        F.when(F.coalesce(F.col("_SUBJECT_PERIOD_TO"), F.lit("")) != "", F.lit(1)).otherwise(F.lit(0)).desc(),
        F.col("_SUBJECT_PERIOD_TO").desc(),
        F.col("_DOWNLOADED_AT").desc(),
        F.col("_INGESTED_AT").desc(),
        F.col("_SOURCE_FILE_PATH").desc(),
    ]


def revision_rank_full(df: DataFrame, period_columns: Sequence[str]) -> DataFrame:
    """Rank by the seven-key order within each period, cut into its days of publication."""
    stated = F.when(F.coalesce(F.col("_PUBLICATION_DATE"), F.lit("")) != "", F.lit(1)).otherwise(F.lit(0))
    slices = [(stated, Column.desc), _day_of_publication(Column.desc)]
    return rank_within(df, list(period_columns), _revision_order(), "_REVISION_RANK", slices)


def best_revision_full(df: DataFrame, period_columns: Sequence[str]) -> DataFrame:
    """The row ranked 1 by the seven-key order in each period."""
    return first_per_key(df, list(period_columns), _revision_order())


def join_max_publication_simple(df: DataFrame, period_columns: Sequence[str], publication: str = "_PUBLICATION_DATE") -> DataFrame:
    """Rows published at their period's latest publication; ties all stay."""
    latest = df.groupBy(*period_columns).agg(F.max(publication).alias(publication))
    return df.join(latest, [*period_columns, publication], "inner").select(*[F.col(f"`{c}`") for c in df.columns])
