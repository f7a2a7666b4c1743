"""Per-file isolation, tables in whole versions, the maintained RAW table, and scheduled runs that end on the way."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from statledger.operators import revisions
from statledger.operators.shape import unique_names
from statledger.schemas import SIDECAR_SCHEMA
from statledger.sources import files
from statledger.sources.versions import Conflict, Store
from statledger.streaming import ingest, scheduled


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(text.encode() if isinstance(text, str) else text)
    return path


def test_repeated_names_are_told_apart():
    assert unique_names(["a", "b", "a", "A", "a_1", "B"]) == ["a", "b", "a_1", "A_2", "a_1_1", "B_1"]
    assert unique_names(["x", "", "x", ""]) == ["x", "column1", "x_1", "column3"]
    assert unique_names(["column1", ""]) == ["column1", "column1_1"] and unique_names([]) == []


def test_files_with_repeated_names_load_beside_others(spark, workdir):
    put(workdir, "a.csv", "a,b,a\n1,2,3\n")
    put(workdir, "b.csv", "a,A,\n4,5,6\n")
    put(workdir, "c.csv", "B,a\n7,8\n")
    rows = files.scan_csv_strings(spark, [workdir])
    got = {r.a: (r.b, r.a_1, r.column2) for r in rows.select("a", "b", "a_1", "column2").collect()}
    assert got == {"1": ("2", "3", None), "4": (None, "5", "6"), "8": ("7", None, None)}


def test_every_listed_file_has_one_outcome(spark, workdir):
    put(workdir, "good.csv", 'a,b\n1,"x, ""y"""\n\n2,5" pipe\n')
    put(workdir, "d e/header only.csv", "a,b\n")
    put(workdir, "empty.csv", "")
    put(workdir, "blank.csv", "\n \n")
    put(workdir, "cut.csv", 'a,b\n1,2\n3,"no e')
    put(workdir, "wide.csv", "a,b\n1,2\n1,2,3\n4,5,6\n")
    put(workdir, "bytes.csv", b"a,b\n1,\xe9\n")
    put(workdir, "other.txt", "a\n1\n")
    rows, ledger = files.load_isolated(spark, [workdir])
    got = {os.path.basename(r.file_path): (r.outcome, r.row_count, r.error, r.bytes) for r in ledger.collect()}
    size = {name: os.path.getsize(f"{workdir}/{name}") for name in os.listdir(workdir) if name.endswith(".csv")}
    assert got == {
        "good.csv": ("loaded", 2, None, size["good.csv"]),
        "header only.csv": ("loaded", 0, None, 4),
        "empty.csv": ("failed", 0, "no header", 0),
        "blank.csv": ("failed", 0, "no header", size["blank.csv"]),
        "cut.csv": ("failed", 0, "1 lines with an unclosed quote", size["cut.csv"]),
        "wide.csv": ("failed", 0, "2 records do not fit the header, first: 1,2,3", size["wide.csv"]),
        "bytes.csv": ("failed", 0, "1 lines are not utf-8", size["bytes.csv"]),
    }
    assert sorted((r.a, r.b) for r in rows.collect()) == [("1", 'x, "y"'), ("2", '5" pipe')]
    # Those bytes are text in another encoding, and numbering and metadata go on from the rows that are left.
    rows, ledger = files.load_isolated(spark, [f"{workdir}"], encoding="cp1252")
    assert "bytes.csv" in {os.path.basename(r.file_path) for r in ledger.filter("outcome = 'loaded'").collect()}
    nothing = spark.createDataFrame([], SIDECAR_SCHEMA)
    loaded = files.load_metadata_columns(rows, nothing, workdir)
    assert sorted((r["_SOURCE_FILE_NAME"], r["_FILE_ROW_NUMBER"], r.b) for r in loaded.collect()) == [("bytes.csv", 1, "é"), ("good.csv", 1, 'x, "y"'), ("good.csv", 2, '5" pipe')]


def test_targets_fail_by_file_or_by_folder(spark, workdir):
    put(workdir, "t/x.csv", "a,b\n1,2\n")
    put(workdir, "t/y.csv", "a,b\n1,2,3\n")
    loaded, ledger = files.load_tables_isolated(spark, {"T": [f"{workdir}/t"], "U": [f"{workdir}/missing"]})
    assert list(loaded) == ["T"] and loaded["T"].count() == 1
    assert {(r.table_name, os.path.basename(r.file_path), r.outcome) for r in ledger.collect()} == {("T", "x.csv", "loaded"), ("T", "y.csv", "failed"), ("U", "missing", "failed")}


def test_ten_encodings_are_told(spark, workdir):
    import codecs

    text = "id,name\n" + "".join(f"{i},Zürich „Ă{chr(0x10A)}\U0001d4d0“ {i}\n" for i in range(300))
    latin = "id,name\n1,été\x81\n"
    wanted = {
        "utf-8": text.encode(), "cp1252": "a\n“é”\n".encode("cp1252"), "latin-1": latin.encode("latin-1"), "ascii": b"a,b\n1,2\n",
        "utf-16": text.encode("utf-16"), "utf-16le": text.encode("utf-16-le"), "utf-16be": text.encode("utf-16-be"),
        "utf-32": codecs.BOM_UTF32_BE + text.encode("utf-32-be"), "utf-32le": text.encode("utf-32-le"), "utf-32be": text.encode("utf-32-be"),
    }
    for name, data in wanted.items():
        put(workdir, f"all/{name}.csv", data)
    put(workdir, "all/utf-16 cut.csv", text.encode("utf-16-le")[:-1])  # half a unit: no encoding of two bytes
    put(workdir, "all/utf-16be marked.csv", codecs.BOM_UTF16_BE + "é".encode("utf-16-be") + "\ud834\udd1e".encode("utf-16-be", "surrogatepass"))
    put(workdir, "all/utf-16 lone.csv", codecs.BOM_UTF16_LE + "a\n\ud834b".encode("utf-16-le", "surrogatepass"))
    found = files.detect_encoding(spark, [f"{workdir}/all"], ("ascii", *[e for e in files.ENCODINGS if e != "ascii"]))
    got = {os.path.basename(r.file_path)[:-4]: r.encoding for r in found.collect()}
    assert got == {name: name for name in wanted} | {"utf-16 cut": "cp1252", "utf-16be marked": "utf-16", "utf-16 lone": "cp1252"}
    assert {r.encoding for r in files.detect_encoding(spark, [f"{workdir}/all/ascii.csv"], files.ENCODINGS).collect()} == {"utf-8"}
    assert [r.encoding for r in files.detect_encoding(spark, [f"{workdir}/all/utf-8.csv"], ("utf-16", "ascii")).collect()] == [None]
    with pytest.raises(ValueError, match="ebcdic"):
        files.detect_encoding(spark, [workdir], ("utf-8", "ebcdic"))


@pytest.fixture
def store(spark, workdir):
    return Store(spark, f"{workdir}/store")


def committed(store, act):
    change = store.change()
    out = act(change)
    change.commit()
    return out


def test_columns_of_a_table_over_generations(spark, store):
    for columns in ("1 AS id, 'a' AS Name", "'b' AS NAME, 2 AS ID, 2.5D AS extra", "3 AS Id", "array('x') AS tags, null AS late, 4 AS id"):
        committed(store, lambda c, q=columns: c.append("T", spark.sql(f"SELECT {q}")))
    read = store.read("T")
    assert read.columns == ["id", "Name", "extra", "tags", "late"] and dict(read.dtypes)["late"] == "string"
    assert [tuple(r) for r in read.orderBy("id").collect()] == [(1, "a", None, None, None), (2, "b", 2.5, None, None), (3, None, None, None, None), (4, None, None, ["x"], None)]
    assert [c["since"] for c in store.contents()["T"]["columns"]] == [1, 1, 2, 4, 4]
    assert store.read("T", 1).columns == ["id", "Name"] and store.read("T", 2).count() == 2
    for wrong in ("'x' AS ID", "1 AS id, 2 AS ID"):
        with pytest.raises(ValueError):
            store.change().append("T", spark.sql(f"SELECT 1 AS z, {wrong}") if "," not in wrong else spark.range(1).select(F.lit(1).alias("id"), F.lit(2).alias("ID")))
    with pytest.raises(KeyError):
        store.read("U")


def test_a_version_is_whole_or_not_there(spark, store):
    one, two = spark.range(5), spark.range(7)
    committed(store, lambda c: (c.append("A", one), c.append("B", one)))
    broken = two.withColumn("id", F.when(F.col("id") > 3, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    change = store.change()
    change.replace("A", two)
    with pytest.raises(Exception, match="lost"):
        change.replace("B", broken)
    assert (store.version(), store.read("A").count(), store.read("B").count()) == (1, 5, 5)
    first, second = store.change(), store.change()
    first.replace("A", two)
    second.append("A", two)
    assert first.commit() == 2
    with pytest.raises(Conflict):
        second.commit()
    assert (store.version(), store.read("A").count(), store.read("A", 1).count()) == (2, 7, 5)
    store.expire(keep=1)
    assert (store.read("A").count(), store.read("B").count(), len(os.listdir(f"{store.path}/data"))) == (7, 5, 2)


def test_merging_reads_and_writes_touched_buckets_only(spark, store, monkeypatch):
    rows = spark.range(2000).selectExpr("cast(id % 40 as string) AS _FILE_CONTENT_KEY", "id AS _FILE_ROW_NUMBER", "1 AS v", "timestamp'2024-01-01' AS _INGESTED_AT", "'p' AS _SOURCE_FILE_PATH", "'n' AS _SOURCE_FILE_NAME")
    every = committed(store, lambda c: scheduled.merge_loads(c, rows, buckets=16))
    assert len(every) > 8
    before = store.contents()["RAW"]["folders"]
    read = []
    monkeypatch.setattr(Store, "of", lambda self, held, folders, of=Store.of: read.append(list(folders)) or of(self, held, folders))
    later = rows.filter("_FILE_CONTENT_KEY IN ('3', '7')").selectExpr("*").withColumns({"v": F.lit(2), "_INGESTED_AT": F.expr("timestamp'2024-01-02'")})
    touched = committed(store, lambda c: scheduled.merge_loads(c, later, buckets=16))
    assert 1 <= len(touched) <= 2 and read == [[f for b in touched for f in before[str(b)]]]
    after = store.contents()["RAW"]["folders"]
    assert {b for b in after if after[b] != before.get(b)} == {str(b) for b in touched}
    late = rows.filter("_FILE_CONTENT_KEY = '3'").withColumns({"v": F.lit(0), "_INGESTED_AT": F.expr("timestamp'2023-01-01'")})
    for again in (late, later, late):
        committed(store, lambda c, b=again: scheduled.merge_loads(c, b, buckets=16))
    got = store.read("RAW")
    want = revisions.dedup_latest_ingest(rows.unionByName(later).unionByName(late))
    assert got.count() == 2000 and got.exceptAll(want).isEmpty() and want.exceptAll(got.select(want.columns)).isEmpty()
    assert committed(store, lambda c: scheduled.merge_loads(c, rows.limit(0), buckets=16)) == []
    with pytest.raises(ValueError):
        scheduled.merge_loads(store.change(), rows, buckets=8)
    with pytest.raises(ValueError):
        store.change().append("RAW", rows)


def test_rows_of_one_large_file_lie_in_many_buckets(spark, store, monkeypatch):
    monkeypatch.setattr(scheduled, "ROWS_PER_BUCKET", 100)
    rows = spark.range(1, 1001).selectExpr("'k' AS _FILE_CONTENT_KEY", "id AS _FILE_ROW_NUMBER", "timestamp'2024-01-01' AS _INGESTED_AT", "'p' AS _SOURCE_FILE_PATH", "'n' AS _SOURCE_FILE_NAME")
    assert len(committed(store, lambda c: scheduled.merge_loads(c, rows, buckets=16))) == 11
    assert len(committed(store, lambda c: scheduled.merge_loads(c, rows.filter("_FILE_ROW_NUMBER < 50"), buckets=16))) == 1
    assert store.read("RAW").count() == 1000


def discovered(spark, n, etag="e"):
    return spark.range(n).selectExpr(
        "concat('u', id) AS source_url", "concat('f', id, '.csv') AS file_name", "concat('area/s/f', id, '.csv') AS target_path", "'area/s' AS path_prefix",
        "sha2(concat('c', id), 256) AS content_hash", "'20240101T000000' AS publication_date", "'20240102T000000' AS downloaded_at", "'s' AS series_id", "'d' AS sub_dataset_id",
        "'automated' AS acquisition_method", "'' AS fallback_reason", "'' AS _SUBJECT_PERIOD_FROM", "'' AS _SUBJECT_PERIOD_TO", "'' AS _SUBJECT_PERIOD_COVERAGE_TYPE",
        "'' AS _SUBJECT_PERIOD_INFERENCE_METHOD", "'' AS _SUBJECT_PERIOD_INFERENCE_SOURCE", "'' AS _SUBJECT_PERIOD_INFERENCE_CONFIDENCE", "'' AS duration_type", "1 AS duration_value",
        "'' AS duration_unit", "1 AS fiscal_year_start_month", "array('month') AS breakdown_granularity", f"concat('{etag}', id) AS etag", "cast(null AS string) AS last_modified",
    )


@pytest.mark.parametrize("writes", [0, 1, 2, 3])
def test_a_run_killed_between_two_writes_leaves_nothing(spark, store, monkeypatch, writes):
    rows = spark.range(30).selectExpr("concat('u', id % 10) AS source_url", "concat('f', id % 10, '.csv') AS file_name", "id")
    assert scheduled.scheduled_run(store, discovered(spark, 4), rows, "r1", "2024-01-01T00:00:00Z") == 1
    done = []
    with monkeypatch.context() as m:
        for name in ("append", "commit"):
            real = getattr(scheduled.Change, name)

            def counted(self, *args, real=real, **kwargs):
                if len(done) == writes:
                    raise KeyboardInterrupt
                done.append(1)
                return real(self, *args, **kwargs)

            m.setattr(scheduled.Change, name, counted)
        with pytest.raises(KeyboardInterrupt):
            scheduled.scheduled_run(store, discovered(spark, 10), rows, "r2", "2024-01-02T00:00:00Z")
    seen = lambda: tuple(store.read(t).count() for t in (scheduled.LANDING, scheduled.SIDECAR, scheduled.EVENTS))
    assert store.version() == 1 and seen() == (12, 4, 4)
    assert scheduled.scheduled_run(store, discovered(spark, 10), rows, "r2", "2024-01-02T00:00:00Z") == 2 and seen() == (30, 10, 14)
    assert scheduled.scheduled_run(store, discovered(spark, 10), rows, "r2", "2024-01-02T00:00:00Z") is None
    assert scheduled.scheduled_run(store, discovered(spark, 10, "new"), rows, "r3", "2024-01-03T00:00:00Z") == 3 and seen() == (30, 10, 24)
    skipped = store.read(scheduled.EVENTS).filter("RUN_ID = 'r3'").groupBy("STAGE", "STATUS", "SKIP_REASON").count().collect()
    assert [tuple(r) for r in skipped] == [("UPLOAD", "SKIPPED", "content_unchanged", 10)]


def test_runs_write_hashes_small_and_skip_by_file(spark, store):
    none = spark.createDataFrame([], "source_url string, file_name string, id long")
    first = discovered(spark, 3)
    assert scheduled.scheduled_run(store, first, none, "r1", "2024-01-01T00:00:00Z") == 1
    folders = [f for t in store.contents().values() for fs in t["folders"].values() for f in fs]
    names = [n for f in folders for n in store._names(f"{store.path}/{f}") if n.endswith(".parquet")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)
    # The same headers; new headers and the same contents; new contents; a file without a name; one that comes twice.
    odd = F.when(F.col("source_url") == "u2", "No Hash").when(F.col("source_url") == "u3", F.lit(None)).otherwise(F.col("content_hash"))
    later = discovered(spark, 6, "x").withColumn("content_hash", odd)
    later = later.withColumn("file_name", F.when(F.col("source_url") != "u5", F.col("file_name")))
    later = first.filter("source_url = 'u0'").unionAll(later.filter("source_url <> 'u0'")).unionAll(later.filter("source_url = 'u4'"))
    found = scheduled.decide(later, store.read(scheduled.SIDECAR)).select("source_url", "content_hash", "skip_reason").collect()
    told = sorted(((r.source_url, r.skip_reason) for r in found), key=str)
    assert told == [("u0", "source_unchanged"), ("u1", "content_unchanged"), ("u2", None), ("u3", None), *[("u4", None)] * 8, ("u5", "source_unchanged")]
    assert {r.content_hash for r in found if r.source_url in ("u2", "u3")} == {"No Hash", None}
    counted = store.read(scheduled.EVENTS).filter("SKIP_REASON IS NULL").select("NORMALIZED_ROW_COUNT").collect()
    assert [r[0] for r in counted] == [0, 0, 0]


def test_a_stream_into_a_table_repeats_no_batch(spark, store, workdir):
    landing = f"{workdir}/landing"
    put(landing, "downloaded_at=1/a.csv", "a,b\n1,2\n3,4,5\n")
    nothing = lambda: spark.createDataFrame([], SIDECAR_SCHEMA)

    def run(checkpoint):
        ingest.run_available(ingest.stream_ingest_table(spark, landing, ["a", "b"], nothing, store, "T", f"{workdir}/{checkpoint}"))

    run("one")
    put(landing, "downloaded_at=2/b.csv", "b,c\n6,7\n")
    run("one")
    assert (store.version(), store.read("T").count(), store.read("T_REJECTED").count()) == (2, 2, 1)
    assert store.read("T").columns[-3:] == ["a", "b", "c"]
    run("two")  # another stream begins with the batch numbers of the first
    assert (store.version(), store.read("T").count()) == (3, 4)
