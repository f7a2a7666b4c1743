"""WARC archives as a table of chunks: no payload is held whole once it is written, nor when it is read.

Writing. A payload longer than ``chunk_bytes`` becomes rows (record, chunk number, bytes), each of which is a WARC record:
the first has the record's own type and WARC-Segment-Number 1, the others are ``continuation`` records with the first's
id as WARC-Segment-Origin-ID, and the last tells the total length, as the format has it for segmented records. Spark's
text writer puts them into gzipped files, one per task, with its commit protocol, on any file system.

Reading. A gzipped archive is read line by line by one task. The parser keeps the header it is in and a running SHA-1,
and gives a row for each piece of payload as it passes: (record, chunk number, offset, digest of the payload so far). A
record's last row so has its length and digest, whether the payload is segmented or not.

Equal payloads are stored once: the others are ``revisit`` records that name the response they repeat.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.llm.cluster import written
from statledger.llm.textarrays import slices

CHUNK_BYTES = 1 << 15
MIN_REVISIT_BYTES = 0

# The format's version line, end of record, and profile of revisits by payload digest.
VERSION, END = "WARC/1.1", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Digits of conv() at base 32, and those of RFC 4648.
_CONV32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class BadArchive(ValueError):
    """An archive that is cut off, or whose headers or segments do not fit."""


def base32(digits: Column) -> Column:
    """Base32 of a SHA-1 in hex: five hex digits are four base32 digits."""
    fours = [F.lpad(F.conv(F.substring(digits, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*fours), _CONV32, _BASE32)


def _digested(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    page = pages.select("page_id", "url", payload.alias("payload"))
    return page.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})


def record_id(page_id: Column, digest: Column) -> Column:
    """What names a record: its page and payload."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(">"))


def records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, bytes, digest, type, refers_to) of every page.

    Of equal payloads of at least ``min_revisit_bytes``, the page with the smallest id is the response. Only payloads
    that occur more than once are joined back, by digest and length.
    """
    rows = _digested(pages)
    same = ["digest", "bytes"]
    repeated = (
        rows.filter(F.col("bytes") >= min_revisit_bytes)
        .groupBy(*same)
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
    )
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.join(repeated.drop("n"), same, "left").select(
        "page_id", "url", "payload", "bytes", base32(F.col("digest")).alias("digest"),
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _text(column: Column) -> Column:
    """A header value: breaks in it would end its line."""
    return F.regexp_replace(column, "[\\r\\n]", " ")


def _segments(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row (record, chunk number, bytes) per ``chunk_bytes`` of payload; a revisit's payload is left out.

    A chunk ends between characters: it begins at the first byte from its place on that does not continue one.
    """
    size = F.when(F.col("type") == "revisit", 0).otherwise(F.col("bytes"))
    last = F.greatest(F.ceil(size / chunk_bytes) - 1, F.lit(0)).cast("int")

    def cut(k: Column) -> Column:
        # At most three bytes of a UTF-8 character follow its first.
        at = k * chunk_bytes
        near = F.hex(F.substring(F.col("payload"), at + 1, 4))
        return at + F.floor(F.length(F.regexp_extract(near, "^((?:[89AB][0-9A-F])*)", 1)) / 2)

    chunk = rows.select("*", size.alias("stored"), F.explode(F.sequence(F.lit(0), last)).alias("chunk"), last.alias("last"))
    begin = cut(F.col("chunk"))
    end = F.when(F.col("chunk") == F.col("last"), F.col("stored")).otherwise(cut(F.col("chunk") + 1))
    begin_end = chunk.withColumns({"begin": begin, "end": end})
    data = F.substring("payload", F.col("begin").cast("int") + 1, (F.col("end") - F.col("begin")).cast("int"))
    return begin_end.withColumn("data", data).drop("payload").withColumn("block", F.sha1("data"))


def write_archives(
    pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, min_revisit_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write page_id, url and html of ``pages`` as WARC records below ``path``.

    A null html is an empty payload, a null url an empty URI, a null page_id an empty part of the record's name. Among
    equal payloads all rows with the smallest id are responses; null ids revisit it if there is another and are
    responses if not. Repeated rows are written as often as they occur. Other columns are ignored; an empty table
    gives an archive without records.
    """
    if chunk_bytes < 4:
        raise ValueError("a chunk must hold any one character: at least 4 bytes")
    part = _segments(records(pages, min_revisit_bytes), chunk_bytes)
    name = record_id(F.col("page_id"), F.col("digest"))
    segmented, first = F.col("last") > 0, F.col("chunk") == 0
    own = F.concat(F.substring("block", 1, 16), F.lit("-"), F.col("chunk").cast("string"))

    def line(field: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"\r\n{field}: "), value)
        return text if when is None else F.when(when, text).otherwise("")

    head = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(first, F.col("type")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, name).otherwise(F.concat(F.rtrim(name, F.lit(">")), F.lit(":"), own, F.lit(">")))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _text(F.coalesce("url", F.lit(""))), first),
        line("WARC-Page-ID", F.col("page_id").cast("string"), first & F.col("page_id").isNotNull()),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32(F.col("block")))),
        line("WARC-Profile", F.lit(REVISIT_PROFILE), F.col("type") == "revisit"),
        line("WARC-Refers-To", record_id(F.col("refers_to"), F.col("digest")), F.col("type") == "revisit"),
        line("WARC-Segment-Number", (F.col("chunk") + 1).cast("string"), segmented),
        line("WARC-Segment-Origin-ID", name, ~first),
        line("WARC-Segment-Total-Length", F.col("stored").cast("string"), segmented & (F.col("chunk") == F.col("last"))),
        line("Content-Type", F.lit("text/html"), F.col("type") == "response"),
        line("Content-Length", F.octet_length("data").cast("string")),
    )
    record = F.concat(head, F.lit(END), F.decode("data", "UTF-8"))
    # No limit of rows a file: it would part the segments of a record.
    part.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", 0).text(path)


class _Parser:
    """Rows of the records in bytes that come piece by piece; nothing longer than a header or a piece is kept."""

    def __init__(self) -> None:
        self.head, self.fields, self.left, self.gap = bytearray(), None, 0, 0
        self.record, self.chunk, self.at, self.sha = None, 0, 0, None

    def feed(self, data: bytes) -> Iterator[tuple]:
        view, begin = memoryview(data), 0
        while begin < len(view):
            if self.gap:
                size = min(self.gap, len(view) - begin)
                if bytes(view[begin : begin + size]) != END.encode()[4 - self.gap : 4 - self.gap + size]:
                    raise BadArchive("a record does not end where its Content-Length says")
                self.gap -= size
                begin += size
            elif self.fields is None:
                known = len(self.head)
                self.head += view[begin : begin + 1024]
                stop = self.head.find(END.encode(), max(known - 3, 0))
                if stop < 0:
                    begin += len(self.head) - known
                    continue
                begin += stop + 4 - known
                self._open(bytes(self.head[:stop]))
                if not self.left:
                    yield from self._piece(view[begin:begin])
            else:
                size = min(self.left, len(view) - begin)
                yield from self._piece(view[begin : begin + size])
                begin += size

    def _open(self, head: bytes) -> None:
        version, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise BadArchive(f"not the head of a WARC record: {version[:40]!r}")
        pairs = (x.split(":", 1) for x in lines if ":" in x)
        fields = {k.strip().lower(): v.strip() for k, v in pairs}
        try:
            self.left = int(fields["content-length"])
        except (KeyError, ValueError):
            raise BadArchive(f"a record without a Content-Length: {fields.get('warc-record-id')}") from None
        number = int(fields.get("warc-segment-number", "1"))
        origin = fields.get("warc-segment-origin-id")
        if fields.get("warc-type") == "continuation":
            if self.record is None or origin != self.record["warc-record-id"] or number != self.number + 1:
                raise BadArchive(f"segment {number} of {origin} does not follow the one before it")
        else:
            self.record, self.chunk, self.at, self.sha = fields, 0, 0, hashlib.sha1()
        self.number, self.head, self.fields = number, bytearray(), fields

    def _piece(self, data: memoryview) -> Iterator[tuple]:
        self.left -= len(data)
        self.sha.update(data)
        done = not self.left and ("warc-segment-number" not in self.fields or "warc-segment-total-length" in self.fields)
        own = self.record
        yield (
            own.get("warc-record-id"), own.get("warc-type"), own.get("warc-page-id"), own.get("warc-target-uri"), own.get("warc-refers-to"),
            own.get("warc-payload-digest", "").removeprefix("sha1:") or None, self.chunk, self.at, len(data),
            base64.b32encode(self.sha.digest()).decode(), done, bytes(data),
        )
        self.chunk += 1
        self.at += len(data)
        if not self.left:
            self.fields, self.gap = None, 4

    def close(self) -> None:
        if self.head or self.fields is not None or self.gap:
            raise BadArchive("an archive ends within a record")


CHUNKS = T.StructType(
    [
        *[T.StructField(n, T.StringType()) for n in ("record_id", "type", "page_id", "url", "refers_to", "declared_digest")],
        *[T.StructField(n, T.LongType()) for n in ("chunk", "offset", "bytes")],
        T.StructField("digest_so_far", T.StringType()),
        T.StructField("last", T.BooleanType()),
        T.StructField("data", T.BinaryType()),
    ]
)


def read_chunks(spark: SparkSession, path: str, data: bool = True, only_last: bool = False) -> DataFrame:
    """The chunk table of the gzipped archives below ``path``: rows of (record_id, chunk) in the order of the payload.

    ``data=False`` leaves the bytes out, ``only_last`` gives each record's last row alone. An archive that is cut off or
    malformed raises an error; an empty folder gives no rows. An archive that is not compressed raises an error where
    Spark would read it from its middle.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    split = F.when(F.col("_metadata.file_block_start") > 0, F.raise_error(F.lit("an archive must be compressed, or smaller than a split")).cast("long"))
    source = lines.select(F.coalesce(split, F.xxhash64("_metadata.file_path")).alias("file"), F.col("value").cast("binary").alias("line"))
    schema = T.StructType([f for f in CHUNKS if data or f.name != "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        file, parser = None, _Parser()
        rows: list[tuple] = []
        held = 0

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * len(CHUNKS)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for batch in slices(batches, "line"):
            files = batch.column("file").to_numpy()
            starts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist()]
            for begin, end in zip(starts, [*starts[1:], len(files)]):
                if files[begin] != file:
                    parser.close()
                    file, parser = files[begin], _Parser()
                piece = b"\n".join(batch.column("line").slice(begin, end - begin).to_pylist()) + b"\n"
                for row in parser.feed(piece):
                    if row[10] or not only_last:
                        rows.append(row)
                        held += row[8] * data
                    if len(rows) >= 4096 or held >= 1 << 23:
                        yield batch_of()
                        rows, held = [], 0
        parser.close()
        if rows:
            yield batch_of()

    return source.mapInArrow(run, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record of the archives.

    Length and digest are those of the payload as read; a revisit has them from the response that it names. A digest
    that is not the declared one, or a response that is not there, raises an error.
    """
    # One narrow row a record, written so that the archives are read once.
    read = written(read_chunks(spark, path, data=False, only_last=True), "warc-records")
    total = (F.col("offset") + F.col("bytes")).alias("payload_bytes")
    wrong = F.raise_error(F.concat(F.lit("payload and digest differ: "), F.col("record_id"))).cast("string")
    digest = F.when(F.col("digest_so_far") == F.coalesce("declared_digest", "digest_so_far"), F.col("digest_so_far")).otherwise(wrong)
    own = ["record_id", "page_id", "url"]
    responses = read.filter(F.col("type") != "revisit").select(*own, total, digest.alias("payload_digest"), F.col("type").alias("record_type"))
    named = responses.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.min("payload_bytes").alias("payload_bytes"), F.min("payload_digest").alias("payload_digest"), F.min("page_id").alias("of_page"), F.lit(True).alias("there")
    )
    absent = F.raise_error(F.concat(F.lit("no response for: "), F.col("record_id"))).cast("string")
    revisits = read.filter(F.col("type") == "revisit").join(named, "refers_to", "left").select(
        "record_id", F.col("page_id"), "url", "payload_bytes", "payload_digest",
        F.when(F.col("there"), F.col("type")).otherwise(absent).alias("record_type"), F.col("of_page").alias("refers_to"),
    )
    none = F.lit(None).cast("string").alias("refers_to")
    return responses.select(*own, "payload_bytes", "payload_digest", "record_type", none).unionByName(revisits).drop("record_id")
