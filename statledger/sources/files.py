"""Readers of landed CSV files, metadata documents, run events, archives and manual drops."""

from __future__ import annotations

import codecs
import csv
import gzip
import io
import zipfile
import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.functions.dates import extract_by_pattern, subject_period_rules
from statledger.functions.paths import load_id
from statledger.operators.ordering import first_per_key
from statledger.operators.shape import match_columns_by_name, unique_names
from statledger.operators.telemetry import blank_to_null_long, type_events
from statledger.schemas import (
    EVENT_LINE_SCHEMA,
    INGEST_COLUMNS,
    SIDECAR_COLUMNS,
    SIDECAR_DOCUMENT_SCHEMA,
    SIDECAR_LONG_COLUMNS,
)
from statledger.session import scratch_path, ship_by_value

ship_by_value(__name__)

FILE_PATH, FILE_NAME, BLOCK_START, READ_ORDER = "__file_path", "__file_name", "__block_start", "__read_order"
CORRUPT = "_corrupt_record"

# Byte values windows-1252 leaves undefined, and its characters for 0x80-0x9F.
CP1252_UNDEFINED = ["81", "8D", "8F", "90", "9D"]
_C1 = bytes(b for b in range(0x80, 0xA0) if f"{b:02X}" not in CP1252_UNDEFINED)

CP1252_NAMES = ("cp1252", "windows-1252")
# What the reader makes of those bytes as ISO-8859-1, and what they mean.
_CP1252_PAIR = (_C1.decode("latin-1"), _C1.decode("cp1252"))

LANDED_SUFFIXES = [".csv", ".zip", ".xlsx", ".xls", ".ods"]


def _csv_reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool, header: bool = True, **options):
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
    )
    return reader.options(**options)


def plain_path(encoded: Column) -> Column:
    """A path from the ``_metadata`` column, which is %-encoded, as it is written."""
    return F.coalesce(F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B"))), encoded)


def position_columns() -> list[Column]:
    """Where a row was read from: file path and start of the block, as the reader names them (see ``plain_path``)."""
    return [F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_block_start").alias(BLOCK_START)]


def _pin_splits(spark: SparkSession) -> None:
    """Fix how files are cut into blocks for this session.

    By default the cut depends on the number of cores, which changes when executors come and go; row positions are
    read more than once and must come out the same.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


def _with_position(df: DataFrame) -> DataFrame:
    """Payload columns plus where, and in which order, each row was read."""
    return df.select("*", *position_columns(), F.monotonically_increasing_id().alias(READ_ORDER))


def _decoded(line: Column, encoding: str) -> Column:
    """The text of a line that was read as bytes."""
    if encoding.lower() in CP1252_NAMES:
        return F.translate(F.decode(line.cast("binary"), "ISO-8859-1"), *_CP1252_PAIR)
    return line if encoding.lower() == "utf-8" else F.decode(line.cast("binary"), encoding)


def _fields(line: Column, sep: str) -> Column:
    """Values of one record of unknown width: quoted ones may hold the separator."""
    field = f'("(?:[^"]|"")*"|[^{sep}"]*)(?:{sep}|$)'
    raw = F.regexp_extract_all(line, F.lit(field), F.lit(1))
    ended = F.when(line.rlike(f"{sep}$"), raw).otherwise(F.slice(raw, 1, F.greatest(F.size(raw) - 1, F.lit(1))))
    return F.transform(ended, lambda f: F.regexp_replace(F.regexp_replace(f, '^"|"$', ""), '""', '"'))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Unparsed lines of every CSV below ``paths``, with where they were read."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .text(list(paths))
        .select(
            "value",
            plain_path(F.col("_metadata.file_path")).alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("read_order"),
        )
    )


def scan_headers(spark: SparkSession, paths: Sequence[str], sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """(file_path, columns) of every CSV below ``paths``, as written: names may repeat.

    Lines are read unparsed; per file only the first line of its first block leaves the map tasks. A file without a
    line that holds anything has no row.
    """
    lines = _lines(spark, paths).filter((F.col("block") == 0) & (F.trim("value") != ""))
    first = lines.groupBy("file_path").agg(F.min_by("value", "read_order").alias("line"))
    text = F.regexp_replace(_decoded(F.col("line"), encoding), "^\\ufeff|\\r$", "")
    return first.select("file_path", _fields(text, sep).alias("columns"))


def scan_csv_strings(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = False,
    trim: bool = False,
    positions: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """Headered CSV files, every column text, files with different headers stacked by name.

    Every file is read by its own header: files of one header are one read, because a read maps columns by position.
    Names that a header repeats, in any case, are told apart (see :func:`~statledger.operators.shape.unique_names`).
    ``columns`` are the target's: they come first and are NULL where a file lacks them; other columns of the files
    follow. ``multi_line`` is for fields with line breaks inside; it makes a file unsplittable. Empty fields read NULL;
    ``trim`` also trims every field first. ``corrupt`` adds ``_corrupt_record`` with the text of rows that do not fit
    their header.
    """
    dialect = {"nullValue": "", "emptyValue": "", "ignoreLeadingWhiteSpace": trim, "ignoreTrailingWhiteSpace": trim}
    if corrupt:
        dialect |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def read(group: Sequence[str], names: Sequence[str]) -> DataFrame:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([CORRUPT] if corrupt else [])]])
        if encoding.lower() in CP1252_NAMES:
            df = decode_cp1252(_csv_reader(spark, sep, "ISO-8859-1", multi_line, **dialect).schema(schema).csv(list(group)))
        else:
            df = _csv_reader(spark, sep, encoding, multi_line, **dialect).schema(schema).csv(list(group))
        return _judged_whole(df, names) if corrupt else df

    # One row per distinct header; the paths are those that the driver lists to read the files anyway.
    grouped = scan_headers(spark, paths, sep, encoding).groupBy("columns").agg(F.collect_list("file_path").alias("files"))
    groups = [(row.files, unique_names(row["columns"])) for row in sorted(grouped.collect(), key=lambda r: min(r.files))]
    if len(groups) == 1:
        groups = [(list(paths), groups[0][1])]
    frames = [read(files, names) for files, names in groups]
    if positions:
        _pin_splits(spark)
        frames = [_with_position(f) for f in frames]
    if not frames:
        raise FileNotFoundError(f"no CSV files below {list(paths)}")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return match_columns_by_name(rows, columns) if columns is not None else rows


def _judged_whole(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same rows; a condition that always holds names every column, so that a record is judged whole whatever
    columns the caller goes on to use."""
    return rows.filter(F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0)


def decode_cp1252(df: DataFrame) -> DataFrame:
    """Text read as ISO-8859-1 to windows-1252: they differ in 27 characters only, so this is one translate per column."""
    latin, windows = _CP1252_PAIR
    return df.select(
        *[
            F.translate(F.col(f"`{f.name}`"), latin, windows).alias(f.name.translate(str.maketrans(latin, windows)))
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def repair_cp1252(text_as_latin1: Column) -> Column:
    """windows-1252 with undefined bytes replaced by U+FFFD."""
    undefined = bytes(int(h, 16) for h in CP1252_UNDEFINED).decode("latin-1")
    latin, windows = _CP1252_PAIR
    return F.translate(text_as_latin1, latin + undefined, windows + "\ufffd" * len(undefined))


NARROW = ("utf-8", "utf-8-sig", "cp1252", "latin-1", "ascii")
# Names of candidates of two and four bytes a unit, and Python's for them.
WIDE = {"utf-16": "utf-16", "utf-16le": "utf-16-le", "utf-16be": "utf-16-be", "utf-32": "utf-32", "utf-32le": "utf-32-le", "utf-32be": "utf-32-be"}
#: All encodings that can be told, in the order in which they are tried.
ENCODINGS = ("utf-8", "cp1252", "latin-1", "ascii", *WIDE)

# Names of files that the readers decompress; their size is not that of their text.
COMPRESSED = "\\.(gz|bz2|deflate|zst|lz4|snappy)$"

#: Bytes up to which a gzipped file is one value of a task, which inflates it in pieces; larger ones are read by lines.
GZIP_VALUE = 64 << 20
_PIECE = 1 << 20


class _NarrowText:
    """Which encodings of one byte a unit the bytes of one file are valid in, as they come, and whether they may be of a
    wide one."""

    def __init__(self) -> None:
        self.size, self.wide, self.ascii, self.undefined = 0, False, True, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")()

    def feed(self, data: bytes) -> None:
        self.wide = self.wide or b"\0" in data or (not self.size and data.startswith((codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)))
        self.size += len(data)
        if self.ascii and data.isascii():
            return
        self.ascii = False
        self.undefined = self.undefined or any(int(h, 16) in data for h in CP1252_UNDEFINED)
        self._keep(data)

    def _keep(self, data: bytes, final: bool = False) -> None:
        try:
            if self.utf8:
                self.utf8.decode(data, final)
        except UnicodeError:
            self.utf8 = None

    def valid(self) -> set[str]:
        self._keep(b"", True)
        told = {"utf-8": self.utf8, "utf-8-sig": self.utf8, "cp1252": not self.undefined, "latin-1": True, "ascii": self.ascii}
        return {name for name, holds in told.items() if holds}


class _WideText:
    """Which wide encodings the bytes of one file are valid in, as they come.

    A reader of lines does not say whether the last line is ended. The file's ``size`` does; it is None for compressed
    files, of which a last line end counts if it fills a unit.
    """

    def __init__(self, size: int | None) -> None:
        self.size, self.at, self.zeros, self.start, self.held = size, 0, [0, 0], b"", b""
        self.decoders = {name: codecs.getincrementaldecoder(codec)() for name, codec in WIDE.items()}

    def _keep(self, name: str, data: bytes, final: bool = False) -> None:
        try:
            # A text has no U+0000; four bytes a unit read as two would be full of it.
            if "\0" in self.decoders[name].decode(data, final):
                del self.decoders[name]
        except UnicodeError:
            del self.decoders[name]

    def feed(self, data: bytes) -> None:
        """The next bytes; a line end behind the last line is among them."""
        if self.size is None:
            data, self.held = self.held + data.removesuffix(b"\n"), data[-1:] if data.endswith(b"\n") else b""
        else:
            data = data[: self.size - self.at]
        for start in range(0, len(data), _PIECE):
            self._take(data[start : start + _PIECE])

    def _take(self, data: bytes) -> None:
        if self.at < 4:
            self.start = (self.start + data)[:4]
        for name in list(self.decoders):
            self._keep(name, data)
        if "utf-16le" in self.decoders or "utf-16be" in self.decoders:
            zero, even = np.frombuffer(data, np.uint8) == 0, self.at % 2
            self.zeros[0] += np.count_nonzero(zero[even::2])
            self.zeros[1] += np.count_nonzero(zero[1 - even :: 2])
        self.at += len(data)

    def valid(self) -> set[str]:
        if self.size is None and self.at % 2:
            self._take(b"\n")
        for name in list(self.decoders):
            self._keep(name, b"", True)
        marked = {
            "utf-16": self.start[:2] in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE),
            "utf-32": self.start in (codecs.BOM_UTF32_LE, codecs.BOM_UTF32_BE),
            # Without a mark, the zero bytes of Latin letters, spaces and separators tell the order.
            "utf-16le": self.zeros[1] >= self.zeros[0],
            "utf-16be": self.zeros[0] >= self.zeros[1],
        }
        return {name for name in self.decoders if marked.get(name, True)}


def _detect_wide(spark: SparkSession, paths: Sequence[str], candidates: Sequence[str]) -> DataFrame:
    """(file_path, wide): the first wide candidate that all bytes of a file are valid in, or NULL.

    Code units lie across line ends and must be counted from the first byte, so each file is one task here, which
    decodes it piece by piece. A session of its own has the settings that keep files whole.
    """
    whole = spark.newSession()
    whole.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    cut = F.raise_error(F.lit("a file in UTF-16 or UTF-32 was read in parts")).cast("long")
    lines = (
        whole.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.when(F.col("_metadata.file_block_start") > 0, cut)
            .when(~F.lower("_metadata.file_name").rlike(COMPRESSED), F.col("_metadata.file_size"))
            .alias("size"),
            F.col("value").cast("binary").alias("line"),
        )
    )
    wanted = [c for c in candidates if c in WIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, text, done = None, None, []

        def close() -> None:
            if text:
                valid = text.valid()
                done.append((name, next((c for c in wanted if c in valid), None)))

        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("file_path", "size", "line")])
            for (path, size), group in groupby(rows, itemgetter(0, 1)):
                if path != name:
                    close()
                    name, text = path, _WideText(size)
                text.feed(b"".join(line + b"\n" for _, _, line in group))
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], ["file_path", "wide"])

    out = scratch_path(spark, "encodings")
    found = lines.mapInArrow(run, "file_path string, wide string")
    found.select(plain_path(F.col("file_path")).alias("file_path"), "wide").write.parquet(out)
    return spark.read.schema("file_path string, wide string").parquet(out)


def _inflated(content: bytes) -> Iterator[bytes]:
    """A gzipped file's bytes, without the mark of UTF-8 that readers of lines take off."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) as file:
        yield file.read(_PIECE).removeprefix(codecs.BOM_UTF8)
        while piece := file.read(_PIECE):
            yield piece


def _detect_gzipped(files: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """(file_path, narrow, wide): the first candidate of each kind that all bytes of a gzipped file are valid in, or NULL.
    Wide ones are tried where there are zero bytes or a mark. As with lines, an empty file gives no row.

    ``files``: file_path, content. A file is inflated once, or, if its first zero byte comes late, twice.
    """
    kinds = [[c for c in candidates if c in kind] for kind in (NARROW, WIDE)]

    def told(content: bytes) -> list[str | None] | None:
        narrow, wide = _NarrowText(), None
        for piece in _inflated(content):
            first = not narrow.size
            narrow.feed(piece)
            if first and narrow.wide:
                wide = _WideText(None)
            if wide:
                wide.feed(piece)
        if not narrow.size:
            return None
        if narrow.wide and not wide:
            wide = _WideText(None)
            for piece in _inflated(content):
                wide.feed(piece)
        valid = narrow.valid(), wide.valid() if wide else ()
        return [next((c for c in kind if c in held), None) for kind, held in zip(kinds, valid)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(path.as_py(), *found) for path, content in zip(batch.column("file_path"), batch.column("content")) if (found := told(content.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in range(3)], ["file_path", "narrow", "wide"])

    return files.mapInArrow(run, "file_path string, narrow string, wide string")


def detect_encoding(spark: SparkSession, paths: Sequence[str], candidates: Sequence[str] = ("utf-8", "cp1252", "latin-1")) -> DataFrame:
    """(file_path, encoding): the first candidate that the whole file is valid in; ``ENCODINGS`` are known.

    Encodings of one byte a unit are checked line by line, so a file of any size is split over tasks. latin-1 takes any
    bytes; but a file with zero bytes, or a mark of UTF-16 or UTF-32, is tried first in the candidates of that kind, if
    there are any: ``utf-16`` and ``utf-32`` with their mark, the others without one. Of UTF-16 without a mark the order
    of bytes is that in which more zeros are high ones. Compressed files (by their suffix) are told by what they hold,
    each in one task; where wide encodings are candidates, gzipped ones of up to ``GZIP_VALUE`` bytes are read once for all.
    """
    unknown = [c for c in candidates if c not in NARROW and c not in WIDE]
    if unknown:
        raise ValueError(f"encodings that cannot be told: {unknown}; known are {[*NARROW, *WIDE]}")
    narrow = [c for c in candidates if c in NARROW]
    only_narrow = len(narrow) == len(candidates)
    path = F.col("_metadata.file_path").alias("file_path")
    # Spark applies these conditions to its list of files, before it reads any.
    as_values = F.col("_metadata.file_name").endswith(".gz") & (F.col("_metadata.file_size") <= GZIP_VALUE)
    lines = spark.read.option("recursiveFileLookup", True).text(list(paths))
    lines = (lines if only_narrow else lines.filter(~as_values)).select(path, F.col("value"), F.monotonically_increasing_id().alias("n"))
    data = F.col("value").cast("binary")
    # As ISO-8859-1 each byte is a character, and those beyond ASCII take two bytes of UTF-8.
    latin = F.decode(data, "ISO-8859-1")
    beyond = F.octet_length(latin) != F.octet_length("value")
    undefined = reduce(lambda a, b: a | b, [latin.contains(chr(int(h, 16))) for h in CP1252_UNDEFINED])
    tests = {
        "utf-8": ~F.is_valid_utf8("value"),
        "utf-8-sig": ~F.is_valid_utf8("value"),
        "cp1252": F.when(beyond, undefined).otherwise(False),
        "latin-1": F.lit(False),
        "ascii": beyond,
    }
    # Not as text, for which Spark would sort all lines by file.
    marked = F.substring(data, 1, 2).isin(F.lit(codecs.BOM_UTF16_LE), F.lit(codecs.BOM_UTF16_BE))
    wide = (F.max(F.col("value").contains("\0")) | F.min_by(marked, F.col("n"))).alias("__wide")
    failed = lines.groupBy("file_path").agg(*[F.max(tests[c]).alias(c) for c in narrow], wide).withColumn("file_path", plain_path(F.col("file_path")))
    chosen = F.coalesce(*[F.when(~F.col(f"`{c}`"), F.lit(c)) for c in narrow]) if narrow else F.lit(None).cast("string")
    if only_narrow:
        return failed.select("file_path", chosen.alias("encoding"))
    out = scratch_path(spark, "encodings")
    values = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(list(paths)).filter(as_values).select(path, "content")
    gzipped = _detect_gzipped(values, candidates).select(
        plain_path(F.col("file_path")).alias("file_path"), F.lit(False).alias("__wide"), F.coalesce("wide", "narrow").alias("narrow")
    )
    failed.select("file_path", "__wide", chosen.alias("narrow")).union(gzipped).write.parquet(out)
    told = spark.read.schema("file_path string, __wide boolean, narrow string").parquet(out)
    suspects = [row.file_path for row in told.filter("__wide").select("file_path").collect()]
    if not suspects:
        return told.select("file_path", F.col("narrow").alias("encoding"))
    found = _detect_wide(spark, suspects, candidates)
    return told.join(found, "file_path", "left").select("file_path", F.coalesce("wide", "narrow").alias("encoding"))


def _block_offsets(df: DataFrame) -> DataFrame:
    """Per block of every file: the read order of its first row and the rows of the file's earlier blocks."""
    blocks = df.groupBy(FILE_PATH, BLOCK_START).agg(F.min(READ_ORDER).alias("__first"), F.count("*").alias("__rows"))
    earlier = Window.partitionBy(FILE_PATH).orderBy(BLOCK_START).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        FILE_PATH, BLOCK_START, "__first", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__earlier")
    )


def _number(offsets: DataFrame, df: DataFrame, name: str) -> DataFrame:
    """Rows with their number; a row whose block was cut differently at the other reading is an error, never dropped."""
    joined = df.join(offsets, [FILE_PATH, BLOCK_START], "left")
    number = F.col(READ_ORDER) - F.col("__first") + F.col("__earlier") + 1
    lost = F.raise_error(F.lit("a file was cut into other blocks than before; set spark.sql.files.minPartitionNum")).cast("long")
    return joined.withColumn(name, F.coalesce(number, lost)).drop("__first", "__earlier")


def file_row_number(df: DataFrame, name: str = "_FILE_ROW_NUMBER") -> DataFrame:
    """1-based row number per file for rows read with ``positions``; rows are neither sorted nor shuffled.

    A row's number is its place in its block plus the rows of the file's earlier blocks. Read order is consecutive
    within a block, so only one row per block is aggregated and joined back.
    """
    return _number(_block_offsets(df), df, name)


def parquet_row_number(spark: SparkSession, path: str, name: str = "_FILE_ROW_NUMBER") -> DataFrame:
    """Parquet rows with their 1-based number in the file, from the reader itself."""
    return spark.read.parquet(path).select("*", (F.col("_metadata.row_index") + 1).alias(name))


def ingest_default_columns(df: DataFrame, prefix: str = "") -> DataFrame:
    """The eight ingest columns from sidecar columns (named ``prefix`` + column), with their defaults."""

    def value(column: str, default: Column) -> Column:
        return F.coalesce(F.nullif(F.col(f"{prefix}{column}"), F.lit("")), default)

    key = value("_FILE_CONTENT_KEY", F.lit(""))
    return df.withColumns(
        {
            "_INGESTED_AT": F.coalesce(
                F.nullif(F.col(f"{prefix}_INGESTED_AT"), F.lit("")), F.nullif(F.col(f"{prefix}_DOWNLOADED_AT"), F.lit(""))
            ).try_cast("timestamp"),
            "_SOURCE_FILE_PATH": value("_PAYLOAD_STAGE_PATH", F.lit("")),
            "_SOURCE_FILE_NAME": value("_SOURCE_FILE_NAME", F.col(FILE_NAME)),
            "_FILE_CONTENT_KEY": key,
            "_ACQUISITION_METHOD": value("_ACQUISITION_METHOD", F.lit("automated")),
            "_FALLBACK_REASON": value("_FALLBACK_REASON", F.lit("")),
            "_LOAD_ID": value("_LOAD_ID", load_id(key)),
        }
    )


def load_metadata_columns(rows: DataFrame, sidecar: DataFrame, root: str) -> DataFrame:
    """Landed rows (read with ``positions``) as ingest rows: row number and the metadata of their file."""
    slash = F.lit("/")
    meta = [
        "_INGESTED_AT", "_DOWNLOADED_AT", "_PAYLOAD_STAGE_PATH", "_SOURCE_FILE_NAME", "_FILE_CONTENT_KEY",
        "_ACQUISITION_METHOD", "_FALLBACK_REASON", "_LOAD_ID",
    ]
    index = first_per_key(
        sidecar.withColumn("__target", F.trim(F.col("_TARGET_PATH"), slash)).filter(F.col("__target") != ""),
        ["__target"],
        [F.col("_INGESTED_AT").desc_nulls_last(), F.col("_FILE_CONTENT_KEY").desc()],
    ).select("__target", *[F.col(c).alias(f"__m{c}") for c in meta])
    payload = [c for c in rows.columns if c not in (FILE_PATH, BLOCK_START, READ_ORDER)]
    # Metadata and its defaults are settled per block, of which there are few; the rows take them and their number
    # from one join.
    path = plain_path(F.col(FILE_PATH))
    offsets = _block_offsets(rows).withColumns(
        {"__relative": relative_path(path, root), FILE_NAME: F.element_at(F.split(path, "/"), -1)}
    )
    described = ingest_default_columns(offsets.join(index, F.col("__relative") == F.col("__target"), "left"), "__m")
    per_file = [c for c in INGEST_COLUMNS if c != "_FILE_ROW_NUMBER"]
    blocks = described.select(FILE_PATH, BLOCK_START, "__first", "__earlier", *per_file)
    return _number(blocks, rows, "_FILE_ROW_NUMBER").select(*INGEST_COLUMNS, *[F.col(f"`{c}`") for c in payload])


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, whatever the URI scheme in front and without outer slashes."""
    bare = root.split("://", 1)[-1] if "://" in root else root
    return F.trim(F.substring_index(path, bare.rstrip("/") + "/", -1), F.lit("/"))


def scan_landed_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """(file_path, relative_path, file_size) of landed files below ``downloaded_at=…`` folders; contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))
    )
    return listed.filter(F.col("file_path").contains("downloaded_at=")).withColumn("relative_path", relative_path(F.col("file_path"), root))


def scan_manual_drop(spark: SparkSession, root: str, series_id: str, sub_dataset_id: str) -> DataFrame:
    """(source_url) of everything dropped by hand for one target; contents are not read."""
    folder = f"{root.rstrip('/')}/{series_id}/{sub_dataset_id}"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return listed.select(F.col("path").alias("source_url"))


def manual_candidates(
    listed: DataFrame, series_id: str, sub_dataset_id: str, publication_pattern: str,
    period_rules: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Loadable files of a manual drop, with date and period read from their names."""
    name = F.element_at(F.split("source_url", "/"), -1)
    wanted = F.lower(F.col("source_url")).rlike(r"\.(?:" + "|".join(s[1:] for s in LANDED_SUFFIXES) + ")$")
    usable = [rule for rule in period_rules if rule[0] in ("file_name", "filename", "url_segment")]
    none = F.lit(None).cast("string")
    return (
        listed.filter(wanted)
        .select("source_url", name.alias("link_text"))
        .select(
            F.lit(series_id).alias("series_id"),
            F.lit(sub_dataset_id).alias("sub_dataset_id"),
            "source_url",
            "link_text",
            extract_by_pattern(F.col("link_text"), publication_pattern).alias("publication_date"),
            subject_period_rules(usable, none, F.col("source_url"), none, F.col("link_text")).alias("subject_period_hint"),
        )
    )


ZIP_SCHEMA = "path string, member string, file_name string, file_type string, content binary, error string"


# A batch for the JVM is full at this many rows or bytes.
BATCH_ROWS, BATCH_BYTES = 2_000, 8_000_000


def _in_batches(rows: Iterator[tuple], columns: list[str], size_of: Callable[[tuple], int]) -> Iterator[pd.DataFrame]:
    batch: list[tuple] = []
    size = 0
    for row in rows:
        batch.append(row)
        size += size_of(row)
        if len(batch) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield pd.DataFrame(batch, columns=columns)
            batch, size = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=columns)


def _usable(names: Sequence[str]) -> list[str]:
    return [n for n in names if not n.endswith("/") and "." + n.rsplit(".", 1)[-1].lower() in (".csv", ".xlsx", ".xls", ".ods")]


def _zip_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def members() -> Iterator[tuple]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for member in _usable(archive.namelist()):
                            kind = member.rsplit(".", 1)[-1].lower()
                            yield path, member, member.rsplit("/", 1)[-1], kind, archive.read(member), None
                except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError) as error:
                    # An archive that is broken, encrypted or packed in an unknown way: its failure is a row.
                    yield path, None, None, None, None, str(error)

    return _in_batches(members(), ["path", "member", "file_name", "file_type", "content", "error"], lambda row: len(row[4] or b""))


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per usable member, and one with ``error`` per archive that cannot be read. Input: (path, content) rows.

    Members leave in batches of bounded size; what was read of an archive before it failed stays.
    """
    return archives.select("path", "content").mapInPandas(_zip_members, ZIP_SCHEMA)


def scan_zip_members(archives: DataFrame) -> DataFrame:
    """One row per usable archive member; archives that cannot be read have none (see :func:`read_archives`)."""
    return read_archives(archives).filter(F.col("error").isNull()).drop("error")


def archive_errors(archives: DataFrame) -> DataFrame:
    """(path, error) of archives that cannot be read."""
    return read_archives(archives).filter(F.col("error").isNotNull()).select("path", "error")


def _archive_sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = []
        for content in batch["content"]:
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    counts.append(len(_usable(archive.namelist())))
            except zipfile.BadZipFile:
                counts.append(-1)
        yield pd.DataFrame({"path": batch["path"], "members": counts})


def archives_without_members(archives: DataFrame) -> DataFrame:
    """Archives that hold nothing usable: a load error of each. Only their lists of names are read."""
    listed = archives.select("path", "content").mapInPandas(_archive_sizes, "path string, members long")
    return listed.filter(F.col("members") == 0).select("path")


MEMBER_ROW_SCHEMA = "path string, member string, row_number long, fields array<string>"


def _member_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for path, member, content in zip(batch["path"], batch["member"], batch["content"]):
                encoding = "utf-8-sig" if _is_utf8(content) else "latin-1"
                text = io.TextIOWrapper(io.BytesIO(content), encoding=encoding, newline="")
                for number, fields in enumerate(csv.reader(text)):
                    yield path, member, number, fields

    return _in_batches(rows(), ["path", "member", "row_number", "fields"], lambda row: sum(map(len, row[3])))


def _is_utf8(content: bytes) -> bool:
    try:
        content.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def member_rows(members: DataFrame) -> DataFrame:
    """CSV members as rows (row 0 is the header), streamed in chunks."""
    return members.filter(F.col("file_type") == "csv").select("path", "member", "content").mapInPandas(_member_rows, MEMBER_ROW_SCHEMA)


def skip_bad_files(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], multi_line: bool = False, header: bool = True, glob: str = "*.csv"
) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows): rows that do not fit their file's header are set aside with their text, the rest loads.

    Without ``header``, ``columns`` are the files' columns in order.
    """
    if header:
        rows = scan_csv_strings(spark, paths, columns, multi_line=multi_line, positions=True, corrupt=True)
        rows = rows.withColumn("file_path", plain_path(F.col(FILE_PATH))).drop(FILE_PATH, BLOCK_START, READ_ORDER)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
        rows = (
            _csv_reader(
                spark, ",", "utf-8", multi_line, header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, pathGlobFilter=glob
            )
            .schema(schema)
            .csv(list(paths))
            .select("*", plain_path(F.col("_metadata.file_path")).alias("file_path"))
        )
        rows = _judged_whole(rows, columns)
    good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, rows.filter(F.col(CORRUPT).isNotNull()).select("file_path", F.col(CORRUPT).alias("record"))


def list_files(spark: SparkSession, paths: Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """(file_path, bytes) of every file below ``paths``; contents are not read.

    Spark's own listing, which the driver makes for any read of these paths, is taken for the names: files without a
    byte are in it, and in no scan.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(list(paths))
    sizes = found.select(plain_path(F.col("path")).alias("file_path"), F.col("length").alias("__bytes"))
    names = spark.createDataFrame([(name,) for name in found.inputFiles()], "name string")
    bare = F.regexp_replace(plain_path(F.col("name")), "^([A-Za-z0-9+.-]+):///", "$1:/").alias("file_path")
    return names.select(bare).join(sizes, "file_path", "left").select("file_path", F.coalesce("__bytes", F.lit(0)).cast("long").alias("bytes"))


def _line_faults(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str) -> DataFrame:
    """(file_path, undecodable, open_quote): how many lines have a fault that a lenient parser would read over."""
    lines = _lines(spark, paths).filter(F.trim("value") != "")
    if encoding.lower() == "utf-8":
        undecodable = ~F.is_valid_utf8("value")
    elif encoding.lower() in CP1252_NAMES:
        undecodable = F.hex(F.col("value").cast("binary")).rlike("^(?:..)*?(?:" + "|".join(CP1252_UNDEFINED) + ")")
    else:
        undecodable = F.lit(False)
    # What is left of a line without its well-formed quoted fields has no field that begins with a quote.
    quoted = f'(^|{sep})[ \\t]*"(?:[^"]++|"")*+"[ \\t]*(?={sep}|\\r?$)'
    text = F.regexp_replace(_decoded(F.col("value"), encoding), "^\\ufeff", "")
    open_quote = F.regexp_replace(text, quoted, "$1").rlike(f'(^|{sep})[ \\t]*"')
    return lines.groupBy("file_path").agg(F.count_if(undecodable).alias("undecodable"), F.count_if(open_quote).alias("open_quote"))


def load_isolated(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None, sep: str = ",", encoding: str = "utf-8", trim: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, ledger): every file loads as a whole or not at all, and the ledger says which.

    Ledger: file_path, bytes, outcome (``loaded`` or ``failed``), row_count (0 where failed) and error, one row per file
    listed below ``paths``, whether or not anything could be read of it. A file fails for want of a header, for bytes
    that are not of its encoding, for a quoted field that is not closed (as where a file was cut off), and for a record
    with more or fewer fields than its header. Such files cost only themselves; a header that repeats a name loads.
    ``rows`` are those of :func:`scan_csv_strings` with positions. The ledger is written once to the shared folder, one
    row a file, and rows of failed files are left out by a join with its failures.
    """
    listed = list_files(spark, paths)
    rows = scan_csv_strings(spark, paths, columns, sep, encoding, trim=trim, positions=True, corrupt=True)
    own = plain_path(F.col(FILE_PATH))
    bad = F.col(CORRUPT).isNotNull()
    parsed = rows.groupBy(own.alias("file_path")).agg(
        F.count("*").alias("n"), F.count_if(bad).alias("misfits"), F.min_by(F.when(bad, F.col(CORRUPT)), F.when(bad, F.col(READ_ORDER))).alias("misfit")
    )
    headers = scan_headers(spark, paths, sep, encoding).select("file_path", F.lit(True).alias("headed"))
    joined = (
        listed.join(headers, "file_path", "left").join(_line_faults(spark, paths, sep, encoding), "file_path", "left").join(parsed, "file_path", "left")
    )
    error = (
        F.when(F.col("headed").isNull(), F.lit("no header"))
        .when(F.col("undecodable") > 0, F.concat(F.col("undecodable").cast("string"), F.lit(f" lines are not {encoding}")))
        .when(F.col("open_quote") > 0, F.concat(F.col("open_quote").cast("string"), F.lit(" lines with an unclosed quote")))
        .when(F.col("misfits") > 0, F.concat(F.col("misfits").cast("string"), F.lit(" records do not fit the header, first: "), F.left("misfit", F.lit(200))))
    )
    count = F.when(error.isNull(), F.coalesce("n", F.lit(0))).otherwise(0).cast("long")
    outcome = F.when(error.isNull(), "loaded").otherwise("failed")
    path = scratch_path(spark, "load-ledger")
    joined.select("file_path", "bytes", outcome.alias("outcome"), count.alias("row_count"), error.alias("error")).write.parquet(path)
    ledger = spark.read.schema("file_path string, bytes long, outcome string, row_count long, error string").parquet(path)
    failed = ledger.filter(F.col("outcome") == "failed").select(F.col("file_path").alias("__failed"))
    return rows.join(failed, own == F.col("__failed"), "left_anti").drop(CORRUPT), ledger


def load_tables(spark: SparkSession, tables: Mapping[str, Sequence[str]], **options) -> tuple[dict[str, DataFrame], DataFrame]:
    """Read every table's files; a table that cannot be read becomes a failure row instead of stopping the rest."""
    loaded, failures = {}, []
    for name, paths in tables.items():
        try:
            loaded[name] = scan_csv_strings(spark, paths, **options)
        except Exception as error:
            failures.append((name, ",".join(paths), str(error)))
    return loaded, spark.createDataFrame(failures, "table_name string, paths string, error string")


def load_tables_isolated(spark: SparkSession, tables: Mapping[str, Sequence[str]], **options) -> tuple[dict[str, DataFrame], DataFrame]:
    """Load every table's files by :func:`load_isolated`: the rows of each, and all ledgers with their table_name. Folders
    without any header, or that are not there, are one failed row of their paths."""
    loaded, ledgers, absent = {}, [], []
    for name, paths in tables.items():
        try:
            loaded[name], ledger = load_isolated(spark, paths, **options)
            ledgers.append(ledger.select(F.lit(name).alias("table_name"), "*"))
        except (FileNotFoundError, AnalysisException) as error:
            absent.append((name, ",".join(paths), 0, "failed", 0, str(error)))
    schema = "table_name string, file_path string, bytes long, outcome string, row_count long, error string"
    return loaded, reduce(lambda a, b: a.unionByName(b), ledgers, spark.createDataFrame(absent, schema))


def scan_sidecar_json(spark: SparkSession, path: str, document_per_file: bool = False) -> DataFrame:
    """Metadata documents as the typed sidecar table; documents that do not parse are left out.

    The metadata dataset has one document per line; ``document_per_file`` reads indented documents, one per file.
    """
    documents = (
        spark.read.schema(SIDECAR_DOCUMENT_SCHEMA)
        .option("multiLine", document_per_file)
        .option("mode", "DROPMALFORMED")
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return sidecar_table(documents)


def sidecar_table(documents: DataFrame) -> DataFrame:
    """Documents to the 28 typed columns."""
    return documents.select(
        *[(blank_to_null_long(F.col(c)) if c in SIDECAR_LONG_COLUMNS else F.col(c)).alias(c) for c in SIDECAR_COLUMNS]
    )


def scan_sidecar_paths(documents: DataFrame, column: str = "value") -> DataFrame:
    """The 28 sidecar columns by JSON path from document text; keys are upper case."""
    parsed = documents.select(F.from_json(F.col(column), SIDECAR_DOCUMENT_SCHEMA).alias("d")).select("d.*")
    return sidecar_table(parsed)


def scan_telemetry_jsonl(spark: SparkSession, root: str) -> DataFrame:
    """Event lines below ``root`` as the typed event table. ``root`` is the event folder itself."""
    lines = spark.read.schema(EVENT_LINE_SCHEMA).option("recursiveFileLookup", True).json(root)
    return type_events(lines)
