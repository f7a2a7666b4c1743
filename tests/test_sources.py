from __future__ import annotations

import codecs
import gzip
import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from statledger.operators.quality import agg_csv_row_count
from statledger.session import scratch_path, shared_dir
from statledger.sources import files, sinks
from statledger.streaming import ingest as streams


def put(root, path, content):
    full = os.path.join(root, path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as out:
        out.write(content if isinstance(content, bytes) else content.encode("utf-8"))
    return full


def test_quotes_line_breaks_and_byte_order_mark(spark, workdir):
    put(workdir, "a/one.csv", '﻿id,"na,me",note\n1,"say ""hi""","two\nlines"\n2,,"x,y"\n')
    df = files.scan_csv_strings(spark, [workdir], multi_line=True)
    assert df.columns == ["id", "na,me", "note"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", 'say "hi"', "two\nlines"), ("2", None, "x,y")]


def test_ragged_headers_load_by_name(spark, workdir):
    put(workdir, "downloaded_at=1/a.csv", "A,B\n1,2\n")
    put(workdir, "downloaded_at=2/b.csv", "B,C,a\n3,4,5\n")
    put(workdir, "downloaded_at=3/c.csv", "A,B\n6,\n")
    got = sorted(((r.A, r.B, r.C) for r in files.scan_csv_strings(spark, [workdir]).collect()), key=str)
    assert got == [("1", "2", None), ("5", "3", "4"), ("6", None, None)]


def test_encodings(spark, workdir):
    put(workdir, "utf8.csv", "n\ncafé\n")
    put(workdir, "win.csv", "n\ncafé ’x’\n".encode("cp1252"))
    put(workdir, "latin.csv", b"n\n\x81\xe9\n")
    found = {os.path.basename(r.file_path): r.encoding for r in files.detect_encoding(spark, [workdir]).collect()}
    assert found == {"utf8.csv": "utf-8", "win.csv": "cp1252", "latin.csv": "latin-1"}
    got = files.scan_csv_strings(spark, [f"{workdir}/win.csv"], encoding="cp1252").collect()
    assert [r.n for r in got] == ["café ’x’"]
    repaired = spark.createDataFrame([("\x81\x93",)], "t string").select(files.repair_cp1252(F.col("t"))).first()[0]
    assert repaired == "�“"


def test_row_counts_and_numbers(spark, workdir):
    put(workdir, "rows.csv", "a,b\n" + "".join(f"{i},x\n" for i in range(5)))
    put(workdir, "header.csv", "a,b\n")
    put(workdir, "quoted.csv", 'a,b\n1,"x\ny"\n2,z\n')
    rows = files.scan_csv_strings(spark, [workdir], ["a", "b"], multi_line=True, positions=True)
    listed = spark.read.format("binaryFile").load(workdir).select(F.col("path").alias("file_path"))
    counted = agg_csv_row_count(rows.withColumn("file_path", F.col(files.FILE_PATH)), listed)
    assert {os.path.basename(r.file_path): r.row_count for r in counted.collect()} == {"rows.csv": 5, "header.csv": 0, "quoted.csv": 2}
    numbered = files.file_row_number(rows)
    got = [(r.a, r["_FILE_ROW_NUMBER"]) for r in numbered.filter(F.col(files.FILE_PATH).endswith("/rows.csv")).orderBy("a").collect()]
    assert got == [(str(i), i + 1) for i in range(5)]
    assert {r.a: r["_FILE_ROW_NUMBER"] for r in numbered.filter(F.col(files.FILE_PATH).endswith("/quoted.csv")).collect()} == {"1": 1, "2": 2}


def test_row_numbers_of_a_file_read_in_many_blocks(spark, workdir):
    put(workdir, "big.csv", "a,b\n" + "".join(f"{i},{'y' * (i % 50)}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = files.scan_csv_strings(spark, [workdir], ["a", "b"], positions=True)
        assert rows.select(files.BLOCK_START).distinct().count() > 4
        wrong = files.file_row_number(rows).filter(F.col("a").cast("long") + 1 != F.col("_FILE_ROW_NUMBER"))
        assert wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bad_records_and_bad_tables(spark, workdir):
    put(workdir, "x.csv", "a,b\n1,2\n1,2,3,4\n5,6\n")
    good, rejected = files.skip_bad_files(spark, [workdir], ["a", "b"])
    assert (good.count(), rejected.count()) == (2, 1)
    loaded, failures = files.load_tables(spark, {"T": [workdir], "U": [f"{workdir}/missing"]})
    assert list(loaded) == ["T"] and [r.table_name for r in failures.collect()] == ["U"]


def test_zip_members(spark, workdir):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        archive.writestr("d/", "")
        archive.writestr("d/same.csv", "a,b\n1,\"x,y\"\n")
        archive.writestr("e/same.csv", "a\né\n".encode("latin-1"))
        archive.writestr("e/book.ODS", b"\x00")
        archive.writestr("readme.txt", "no")
    put(workdir, "in/a.zip", buffer.getvalue())
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as archive:
        archive.writestr("readme.txt", "no")
    put(workdir, "in/b.zip", empty.getvalue())
    archives = spark.read.format("binaryFile").load(f"{workdir}/in").select("path", "content")
    members = files.scan_zip_members(archives)
    assert sorted((r.member, r.file_name, r.file_type) for r in members.collect()) == [("d/same.csv", "same.csv", "csv"), ("e/book.ODS", "book.ODS", "ods"), ("e/same.csv", "same.csv", "csv")]
    rows = sorted((r.member, r.row_number, list(r.fields)) for r in files.member_rows(members).collect())
    assert rows == [("d/same.csv", 0, ["a", "b"]), ("d/same.csv", 1, ["1", "x,y"]), ("e/same.csv", 0, ["a"]), ("e/same.csv", 1, ["é"])]
    assert [os.path.basename(r.path) for r in files.archives_without_members(archives).collect()] == ["b.zip"]


def test_manual_drop(spark, workdir):
    for name in ("series/sub/March-2026-data.csv", "series/sub/2026-02-01.XLSX", "series/sub/notes.txt", "series/other/x.csv"):
        put(workdir, name, "x")
    listed = files.scan_manual_drop(spark, workdir, "series", "sub")
    rules = [("link_text", "(x)"), ("file_name", r"^([a-z]+-\d{4})")]
    got = {r.link_text: (r.publication_date, r.subject_period_hint) for r in files.manual_candidates(listed, "series", "sub", r"(\d{4}-\d{2}-\d{2})|^([a-z]+-\d{4})", rules).collect()}
    assert got == {"March-2026-data.csv": ("20260301T000000", "202603"), "2026-02-01.XLSX": ("20260201T000000", None)}


def test_metadata_datasets_are_small(spark, workdir):
    rows = spark.range(2000).select(F.lit("1.0").alias("_CONTRACT_VERSION"), F.sha2(F.col("id").cast("string"), 256).alias("_FILE_CONTENT_KEY"))
    sinks.sink_sidecar(rows.coalesce(1), f"{workdir}/sidecar")
    written = sum(os.path.getsize(os.path.join(workdir, "sidecar", n)) for n in os.listdir(f"{workdir}/sidecar") if n.startswith("part-"))
    assert written < 2000 * 64
    got = files.scan_sidecar_json(spark, f"{workdir}/sidecar")
    assert sorted(r[0] for r in got.select("_FILE_CONTENT_KEY").collect()) == sorted(r[1] for r in rows.collect())


def test_encodings_of_compressed_files(spark, workdir):
    texts = {
        "le": ("ab\ncd\n".encode("utf-16-le"), "utf-16le"), "be": ("ab\ncd\n".encode("utf-16-be"), "utf-16be"),
        "open": ("ab\ncd".encode("utf-16-le"), "utf-16le"), "le32": ("ab\ncd\n".encode("utf-32-le"), "utf-32le"),
        "be32": ("ab\ncd\n".encode("utf-32-be"), "utf-32be"), "marked": ("ab\n".encode("utf-16"), "utf-16"), "utf8": ("é\n".encode(), "utf-8"),
    }
    for name, (content, _) in texts.items():
        put(workdir, f"{name}.csv.gz", gzip.compress(content))
        put(workdir, f"{name}.csv", content)
    found = {os.path.basename(r.file_path): r.encoding for r in files.detect_encoding(spark, [workdir], files.ENCODINGS).collect()}
    assert found == {name + end: told for name, (_, told) in texts.items() for end in (".csv", ".csv.gz")}


def test_gzipped_files_are_told_in_one_reading(spark, workdir, monkeypatch):
    late = b"x" * (3 << 20)
    texts = {
        "plain": (b"ab\n", "ascii"), "c1": (b"ab\x81\n", "latin-1"), "high": (b"ab\x93\n", "cp1252"), "utf8": ("\u00e9\n".encode() * 400_000, "utf-8"),
        "bom": (codecs.BOM_UTF8 + b"ab\n", "ascii"), "bom only": (codecs.BOM_UTF8, None), "empty": (b"", None), "line end": (b"\n", "ascii"),
        "cut": (late + b"\xc3", "cp1252"), "late": (late + b"\0\0", "ascii"), "late high": (late + b"\x81a\0\0", "latin-1"),
        "late wide": (late.decode().replace("x", "\u4e2d").encode("utf-16-le") + b"a\0", "utf-16le"), "odd": ("ab\n".encode("utf-16-le") + b"a", "utf-16le"),
        "marked": (codecs.BOM_UTF16_BE + "\u4e00\n".encode("utf-16-be"), "utf-16"), "lone": (codecs.BOM_UTF16_LE + b"\x34\xd8a\0", "cp1252"),
        "le32": (("ab\n\U0001d4d0" * 200_000).encode("utf-32-le"), "utf-32le"), "be32": (codecs.BOM_UTF32_BE + "ab\n\u010a".encode("utf-32-be"), "utf-32"),
    }
    for name, (content, _) in texts.items():
        half = len(content) // 2
        put(workdir, f"p/{name}.csv.gz", gzip.compress(content[:half]) + gzip.compress(content[half:]))

    def told():
        found = files.detect_encoding(spark, [workdir], ("ascii", *[e for e in files.ENCODINGS if e != "ascii"]))
        return {os.path.basename(r.file_path)[:-7]: r.encoding for r in found.collect()}

    wanted = {name: encoding for name, (_, encoding) in texts.items() if encoding}
    with monkeypatch.context() as without:
        without.setattr(files, "_detect_wide", None)
        assert told() == wanted
    monkeypatch.setattr(files, "GZIP_VALUE", 0)  # the same by lines
    assert told() == wanted


def test_wide_text_in_pieces():
    for content in ("ab\n\u010a\n".encode("utf-16-le"), "ab\u4e00\n".encode("utf-16-be"), "ab\n".encode("utf-16"), "ab\n".encode("utf-32-be"), b"ab\n", b"a\0b", b"a\n\n"):
        for size in (None, len(content)):
            whole, pieces = files._WideText(size), files._WideText(size)
            whole.feed(content)
            for at in range(0, len(content), 3):
                pieces.feed(content[at : at + 3])
            assert whole.valid() == pieces.valid() and whole.zeros == pieces.zeros


def test_sidecar_documents(spark, workdir):
    put(workdir, "a.json", json.dumps({"_CONTRACT_VERSION": "1", "_FILE_SCOPE_DURATION_VALUE": "12", "_FILE_SCOPE_FISCAL_YEAR_START_MONTH": "", "period_coverage": {"breakdown_granularity": ["m"]}}, indent=2))
    put(workdir, "b.json", "{ not json")
    got = files.scan_sidecar_json(spark, workdir, document_per_file=True).collect()
    assert len(got) == 1 and len(got[0]) == 28
    assert (got[0]["_FILE_SCOPE_DURATION_VALUE"], got[0]["_FILE_SCOPE_FISCAL_YEAR_START_MONTH"]) == (12, None)


def test_landed_rows_take_the_defaults_of_their_sidecar(spark, workdir):
    put(workdir, "s/sub/downloaded_at=1/a.csv", "x\n1\n2\n")
    put(workdir, "s/sub/downloaded_at=2/b b.csv", "x\n3\n")
    put(workdir, "s/sub/other/c.csv", "x\n4\n")
    landed = files.scan_landed_files(spark, workdir)
    assert sorted(r.relative_path for r in landed.collect()) == ["s/sub/downloaded_at=1/a.csv", "s/sub/downloaded_at=2/b b.csv"]
    names = ["_TARGET_PATH", "_INGESTED_AT", "_DOWNLOADED_AT", "_PAYLOAD_STAGE_PATH", "_SOURCE_FILE_NAME", "_FILE_CONTENT_KEY", "_ACQUISITION_METHOD", "_FALLBACK_REASON", "_LOAD_ID"]
    old = ("/s/sub/downloaded_at=1/a.csv", "2025-01-01T00:00:00Z", None, "old", None, "old", None, None, None)
    new = ("s/sub/downloaded_at=1/a.csv/", "2026-01-01T00:00:00Z", None, "stage/a.csv", None, "0123456789abcdefXYZ", None, None, "")
    sidecar = spark.createDataFrame([old, new], ", ".join(f"{n} string" for n in names))
    rows = files.scan_csv_strings(spark, [workdir], ["x"], positions=True)
    got = {r.x: r for r in files.load_metadata_columns(rows, sidecar, workdir).collect()}
    assert (got["2"]["_FILE_ROW_NUMBER"], got["2"]["_LOAD_ID"], got["2"]["_ACQUISITION_METHOD"]) == (2, "0123456789abcdef", "automated")
    assert (got["1"]["_SOURCE_FILE_PATH"], got["1"]["_SOURCE_FILE_NAME"], got["1"]["_INGESTED_AT"].year) == ("stage/a.csv", "a.csv", 2026)
    assert (got["3"]["_INGESTED_AT"], got["3"]["_SOURCE_FILE_NAME"], got["3"]["_LOAD_ID"]) == (None, "b b.csv", "")


def test_landing_layout(spark, workdir):
    df = spark.createDataFrame([("20260115T103000", "a"), ("20260216T000000", "b")], "downloaded_at string, v string")
    sinks.sink_landing_partitions(df, f"{workdir}/out")
    assert os.path.isdir(f"{workdir}/out/download_year=2026/download_month=01/downloaded_at=20260115T103000")


def test_stream_runs_twice_without_loading_twice(spark, workdir):
    put(workdir, "in/s/downloaded_at=1/a.csv", "x,y\n1,p\n2,q\nbad,row,here\n3,r\n")
    nothing = spark.createDataFrame([], "_TARGET_PATH string, _INGESTED_AT string, _DOWNLOADED_AT string, _PAYLOAD_STAGE_PATH string, _SOURCE_FILE_NAME string, _FILE_CONTENT_KEY string, _ACQUISITION_METHOD string, _FALLBACK_REASON string, _LOAD_ID string")

    def run():
        streams.run_available(streams.stream_ingest_csv(spark, f"{workdir}/in", ["x", "y"], lambda: nothing, f"{workdir}/out", f"{workdir}/cp"))
        return sorted((r.x, r["_FILE_ROW_NUMBER"], r["_SOURCE_FILE_NAME"]) for r in streams.read_ingest(spark, f"{workdir}/out").collect())

    first = [("1", 1, "a.csv"), ("2", 2, "a.csv"), ("3", 4, "a.csv")]
    assert run() == first
    assert run() == first
    assert spark.read.parquet(f"{workdir}/out_rejected").count() == 1
    put(workdir, "in/s/downloaded_at=2/b.csv", "x,y\n9,z\n")
    assert run() == [*first, ("9", 1, "b.csv")]


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
