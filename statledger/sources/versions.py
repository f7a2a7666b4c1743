"""Tables that readers see in whole versions.

A :class:`Store` is a folder with any number of tables. Data files are written below ``data/`` and never changed; what
the tables hold is said by one small document per version below ``_versions/``: for each table its columns in order,
with the version that brought them, and the folders its rows are in. A reader takes the last document and reads those
folders with that schema, so neither footers are merged nor folders listed for what is not there.

A :class:`Change` writes data first and then its document, under the next number and by a rename that fails if the
number is taken. Until then nothing of it is visible, whatever happens; afterwards all of it is, in all its tables.
The file system must refuse to rename onto a file that exists (HDFS and local ones do; object stores need a store that
can create a file only if it is absent).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statledger.operators.ordering import first_per_key

BUCKET = "__bucket"
#: Of data files: hashes in hex take half of what Spark's default leaves of them.
COMPRESSION = "zstd"


class Conflict(RuntimeError):
    """Another change was committed after this one was begun."""


class Store:
    """Tables below ``path``. A table is ``{"columns": [...], "folders": {bucket: [...]}, "buckets": n}``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _hadoop(self, path: str) -> tuple[Any, Any, Any]:
        """(package, file system, path) of Hadoop's API, by which Spark reaches every store."""
        fs = self.spark._jvm.org.apache.hadoop.fs
        place = fs.Path(path)
        return fs, place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, path: str) -> list[str]:
        _, system, place = self._hadoop(path)
        return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []

    def _document(self, version: int) -> str:
        return f"{self.path}/_versions/{version:010d}.json"

    def version(self) -> int:
        """Number of the last version; 0 before the first."""
        return max((int(n[:-5]) for n in self._names(f"{self.path}/_versions") if n.endswith(".json") and not n.startswith((".", "_"))), default=0)

    def contents(self, version: int | None = None) -> dict[str, dict]:
        """The tables of a version, the last unless told."""
        version = self.version() if version is None else version
        if not version:
            return {}
        _, system, place = self._hadoop(self._document(version))
        stream = system.open(place)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)["tables"]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """Rows of a table as of a version; columns that a file lacks are NULL."""
        held = self.contents(version).get(table)
        if held is None:
            raise KeyError(f"no table {table!r} in version {self.version() if version is None else version} of {self.path}")
        return self.of(held, [f for folders in held["folders"].values() for f in folders])

    def of(self, held: dict, folders: Sequence[str]) -> DataFrame:
        schema = schema_of(held)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def change(self) -> Change:
        return Change(self)

    def expire(self, keep: int = 2) -> list[str]:
        """Delete the documents before the last ``keep`` and the folders that no kept version names; returns those.

        Data of changes that were never committed goes, too: run it when no change is under way.
        """
        last = self.version()
        first = max(1, last - max(keep, 1) + 1)
        named = {f.split("/")[1] for v in range(first, last + 1) for t in self.contents(v).values() for fs in t["folders"].values() for f in fs}
        gone = [f"data/{n}" for n in self._names(f"{self.path}/data") if n not in named]
        for path in [*gone, *[f"_versions/{v:010d}.json" for v in range(1, first)]]:
            _, system, place = self._hadoop(f"{self.path}/{path}")
            system.delete(place, True)
        return gone


def schema_of(held: dict) -> T.StructType:
    return T.StructType.fromJson({"type": "struct", "fields": [c["field"] for c in held["columns"]]})


class Change:
    """A version under way: tables are appended to, replaced or merged into, and become visible by :meth:`commit`."""

    def __init__(self, store: Store) -> None:
        self.store, self.base = store, store.version()
        self.tables = store.contents(self.base)

    def _evolved(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` under the table's names; columns that the table lacks are added behind its own."""
        held = self.tables.setdefault(table, {"columns": [], "folders": {}, "buckets": 0})
        known = {f.name.lower(): f for f in schema_of(held)}
        names, seen = [], set()
        for field in df.schema:
            low = field.name.lower()
            if low in seen:
                raise ValueError(f"column {field.name!r} occurs twice in what is written to {table}")
            seen.add(low)
            kind = T.StringType() if isinstance(field.dataType, T.NullType) else field.dataType
            if low in known:
                if known[low].dataType != kind:
                    raise ValueError(f"column {field.name!r} of {table} is {known[low].dataType.simpleString()}, not {kind.simpleString()}")
                name = known[low].name
            else:
                name = field.name
                held["columns"].append({"field": T.StructField(name, kind).jsonValue(), "since": self.base + 1})
            names.append(F.col(f"`{field.name}`").cast(kind).alias(name))
        return df.select(*names)

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows; the table is made if there is none, and gains the columns it lacks (names in any case). A column
        of another type raises an error. Returns the rows as written."""
        rows = self._evolved(table, df)
        held = self.tables[table]
        if held["buckets"]:
            raise ValueError(f"{table} keeps the latest rows by key: merge into it")
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.option("compression", COMPRESSION).parquet(f"{self.store.path}/{folder}")
        held["folders"].setdefault("", []).append(folder)
        return self.store.spark.read.schema(rows.schema).parquet(f"{self.store.path}/{folder}")

    def replace(self, table: str, df: DataFrame) -> None:
        """These rows and columns instead of all the table has."""
        self.tables.pop(table, None)
        self.append(table, df)

    def merge_latest(self, table: str, df: DataFrame, keys: Sequence[str], order: Sequence[Column], by: Column, buckets: int = 64) -> list[int]:
        """Keep one row per key, the first in ``order`` of what the table has and of ``df``.

        Rows lie in ``buckets`` by ``by``, which must be one for all rows of a key. Only buckets that ``df`` has rows
        for are read and written anew; they are returned (a number at most of ``buckets``). ``df`` is evaluated twice.
        """
        rows = self._evolved(table, df)
        held = self.tables[table]
        if held["folders"] and held["buckets"] != buckets:
            raise ValueError(f"{table} has {held['buckets']} buckets, not {buckets}")
        held["buckets"] = buckets
        bucket = F.pmod(by, F.lit(buckets)).cast("int")
        touched = sorted(r[0] for r in rows.select(bucket.alias("b")).distinct().collect())
        if not touched:
            return []
        before = [f for b in touched for f in held["folders"].get(str(b), [])]
        whole = self.store.of(held, before).unionByName(rows, allowMissingColumns=True)
        latest = first_per_key(whole, list(keys), list(order)).withColumn(BUCKET, bucket)
        folder = f"data/{uuid.uuid4().hex}"
        latest.hint("rebalance", BUCKET).write.option("compression", COMPRESSION).partitionBy(BUCKET).parquet(f"{self.store.path}/{folder}")
        written = {n.split("=")[1] for n in self.store._names(f"{self.store.path}/{folder}") if n.startswith(BUCKET)}
        if written != {str(b) for b in touched}:
            raise RuntimeError(f"rows of {table} changed their buckets while they were merged: {sorted(written)} and {touched}")
        for b in touched:
            held["folders"][str(b)] = [f"{folder}/{BUCKET}={b}"]
        return touched

    def commit(self, **note: str) -> int:
        """Make the change visible as the next version; raises :class:`Conflict` if another was first."""
        version = self.base + 1
        text = json.dumps({"version": version, "note": note, "tables": self.tables})
        fs, system, target = self.store._hadoop(self.store._document(version))
        _, _, draft = self.store._hadoop(f"{self.store.path}/_versions/_{uuid.uuid4().hex}")
        out = system.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = fs.FileContext.getFileContext(target.toUri(), self.store.spark._jsc.hadoopConfiguration())
        options = self.store.spark._sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(target), options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
                raise
            system.delete(draft, False)
            raise Conflict(f"version {version} of {self.store.path} was committed by another change") from None
        return version
