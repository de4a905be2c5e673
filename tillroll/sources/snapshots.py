"""Tables whose versions go live as a whole: data folders and a manifest.

A :class:`Snapshots` store is a folder of named tables. Data files are written
once, each commit into folders of its own, and never changed. What a version of
the store consists of stands in a *manifest*, a small file that names the live
folders of every table; the manifest with the highest number is the store. A
commit writes all its data first and then renames the new manifest into place,
which the file system does in one step and refuses if that number is taken. So

* a driver or executor lost at any time before that leaves the store as it was,
  with some folders that nothing names;
* tables changed in one commit go live together;
* readers of an older version keep their files until :meth:`Snapshots.vacuum`;
* of two writers one fails with :class:`Conflict` and can start again.

Three kinds of change: ``replace`` (the whole table), ``append``, and ``upsert``.
An upserted table keeps the latest version of each key. It is dealt to buckets
by a hash of the key, and a commit adds a small *delta* folder to each bucket it
touches. Readers merge a bucket's folders; a bucket is rewritten as one folder
only when its deltas have become as large as the rest or many, so a row is
rewritten a logarithmic number of times, not in every commit.

With ``line`` a key stands for several rows (the items of a receipt) that are
replaced together: rows of older versions of the key vanish, also where the new
version has fewer rows. A row whose ``line`` is NULL only tells the version.
Rows with a true ``_deleted`` column delete their key.

The folders lie at ``<table>/v=<commit>``. Spark also reads ``<table>`` as a
table partitioned by ``v``, which then shows every version that is still there.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators.upsert import latest_per_key

BUCKET = "_bucket"
DELETED = "_deleted"
#: A bucket with more deltas than this is rewritten whatever their size.
MOST_DELTAS = 8
#: Bytes of files whose rows are moved at once: shuffle files take some times that.
ROUND_BYTES = 64 << 20
#: Tasks that a bucket of lines is dealt to, and the lines of a key that stay together.
BUCKET_SHARES, LINE_BLOCK = 4, 1000
_MANIFEST = re.compile(r"v(\d{12})\.json")


class Conflict(RuntimeError):
    """Another writer committed first."""


class Files:
    """The few file operations a store needs, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str) -> tuple[Any, Any]:
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if it isn't there."""
        p, fs = self._open(folder)
        return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []

    def age_ms(self, path: str, now_ms: int) -> int:
        p, fs = self._open(path)
        return now_ms - fs.getFileStatus(p).getModificationTime()

    def size(self, path: str) -> int:
        p, fs = self._open(path)
        return fs.getContentSummary(p).getLength()

    def read(self, path: str) -> str:
        p, fs = self._open(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A whole new file in one step; an error if there is one already."""
        p, fs = self._open(path)
        part = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(part, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(fs.makeQualified(part), fs.makeQualified(p), self._gateway.new_array(rename, 0))
        except Exception as error:
            fs.delete(part, False)
            if fs.exists(p):
                raise Conflict(f"{path} was written by another writer") from error
            raise

    def remove(self, path: str) -> None:
        p, fs = self._open(path)
        fs.delete(p, True)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(buckets)).cast("int")


def rounds(sizes: dict[str, int]) -> list[list[str]]:
    """Names in groups of at most ``ROUND_BYTES``, or of one that is larger."""
    found: list[list[str]] = []
    total = 0
    for name, size in sizes.items():
        if not found or total + size > ROUND_BYTES:
            found.append([])
            total = 0
        found[-1].append(name)
        total += size
    return found


def latest_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], line: str | None = None, few: bool = False) -> DataFrame:
    """The rows of each key's latest version: one, or with ``line`` one a line.

    Both steps combine rows in the map tasks before they shuffle. Versions that
    are equal in ``order`` count as the same one, delivered again. Where a key has
    ``few`` versions, a key's rows are dealt to one task and shuffled only once.
    """
    if line is None:
        return latest_per_key(df, key, order[0], tie_breakers=order[1:])
    if few:
        newest = F.max(F.struct(*order)).over(Window.partitionBy(*key))
        rows = df.withColumn("_newest", newest).where(F.struct(*order).eqNullSafe(F.col("_newest"))).drop("_newest")
        return latest_per_key(rows, [*key, line], order[0], tie_breakers=order[1:])
    lines = latest_per_key(df, [*key, line], order[0], tie_breakers=order[1:])
    newest = df.groupBy(*key).agg(F.max(F.struct(*order)).alias("_newest"))
    same = [lines[k].eqNullSafe(newest[k]) for k in key]
    current = F.struct(*[lines[c] for c in order]).eqNullSafe(newest["_newest"])
    joined = lines.join(newest, [*same, current], "left_semi")
    return joined.select(*df.columns)


class Snapshots:
    """The tables of one folder. See the module's text."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    # --- reading ----------------------------------------------------------

    def versions(self) -> list[int]:
        found = (_MANIFEST.fullmatch(n) for n in self.files.names(f"{self.root}/_manifest"))
        return sorted(int(m[1]) for m in found if m)

    def manifest(self, version: int | None = None) -> dict:
        """A version's manifest (the latest by default; version 0: no tables)."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return {"version": 0, "tables": {}, "done": {}}
        return json.loads(self.files.read(self._path(version)))

    def _path(self, version: int) -> str:
        return f"{self.root}/_manifest/v{version:012d}.json"

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self.manifest(version)["tables"])

    def folders(self, table: str, version: int | None = None) -> list[str]:
        """The live data folders of a table."""
        parts = self.manifest(version)["tables"][table]["parts"].values()
        return [f"{self.root}/{folder}" for part in parts for folder, _ in part]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a version (default: the latest)."""
        described = self.manifest(version)["tables"].get(table)
        if described is None:
            raise ValueError(f"{self.root} has no table {table!r}")
        return self._visible(self._merged(described, list(described["parts"].values())), described)

    def _load(self, described: dict, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(described["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).format(described.get("format", "parquet"))
        return reader.load([f"{self.root}/{f}" for f in folders])

    def _merged(self, described: dict, parts: list[list]) -> DataFrame:
        """The rows of some buckets; only buckets with deltas need a merge."""
        single = [part[0][0] for part in parts if len(part) == 1]
        several = [folder for part in parts if len(part) > 1 for folder, _ in part]
        if not described.get("key"):
            return self._load(described, single + several)
        if not several:
            return self._load(described, single)
        # A folder has a version of each key at most, and a bucket has few folders.
        merged = latest_rows(self._load(described, several), described["key"], described["order"], described["line"], few=True)
        return self._load(described, single).unionByName(merged) if single else merged

    @staticmethod
    def _visible(df: DataFrame, described: dict) -> DataFrame:
        if described.get("line"):
            df = df.where(F.col(described["line"]).isNotNull())
        if DELETED in df.columns:
            df = df.where(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED)
        return df

    # --- writing ----------------------------------------------------------

    def change(self) -> "Change":
        """Begin a commit on top of the latest version."""
        return Change(self)

    def vacuum(self, keep: int = 2, orphans_after_hours: float = 24.0) -> list[str]:
        """Remove what the last ``keep`` versions don't name; the removed folders.

        Folders that no manifest names belong to a commit that is still being
        written or was lost: they go when they are ``orphans_after_hours`` old.
        """
        versions = self.versions()
        if not versions:
            return []
        kept, old = versions[-keep:], versions[:-keep]
        now = int(self.spark.sparkContext._jvm.System.currentTimeMillis())
        live, dead, tables = set(), set(), set()
        for number in versions:
            for name, described in self.manifest(number)["tables"].items():
                tables.add(name)
                named = {folder for part in described["parts"].values() for folder, _ in part}
                (live if number in kept else dead).update(named)
        gone = sorted(dead - live)
        commits = {folder.split("/")[1] for folder in live | dead}
        for name in tables:
            for commit in self.files.names(f"{self.root}/{name}"):
                old_enough = self.files.age_ms(f"{self.root}/{name}/{commit}", now) > orphans_after_hours * 3_600_000
                if commit not in commits and old_enough:
                    gone.append(f"{name}/{commit}")
        # Manifests go first: no version ever names a folder that is gone.
        for number in old:
            self.files.remove(self._path(number))
        for folder in gone:
            self.files.remove(f"{self.root}/{folder}")
        return gone


class Change:
    """One commit being made: tables are written as they are given, and go live
    together in :meth:`commit`. A change that is dropped changes nothing."""

    def __init__(self, store: Snapshots):
        self.store, self.spark = store, store.spark
        self.base = store.manifest()
        self.tables: dict[str, dict] = dict(self.base["tables"])
        self.name = f"c{uuid.uuid4().hex}"
        self.written = 0

    def _folder(self, table: str) -> str:
        """A folder of this commit that nothing has been written to."""
        self.written += 1
        return f"{table}/v={self.name}" + (f"-{self.written}" if self.written > 1 else "")

    def _write(self, df: DataFrame, folder: str, partition_by: Sequence[str] = (), format: str = "parquet") -> None:
        writer = df.write.mode("error").format(format)
        if format == "parquet":
            writer = writer.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{self.store.root}/{folder}")

    def replace(self, table: str, df: DataFrame, format: str = "parquet", partition_by: Sequence[str] = ()) -> None:
        """The table becomes ``df``, in files of ``format``, with a folder for
        each value of ``partition_by``."""
        folder = self._folder(table)
        self._write(df, folder, partition_by, format)
        self.tables[table] = {"schema": df.schema.jsonValue(), "format": format, "parts": {"": [[folder, 0]]}}

    def append(self, table: str, df: DataFrame) -> None:
        """``df`` is added to the table, which it begins if there is none."""
        described = self.tables.get(table)
        if described is None:
            return self.replace(table, df)
        folder = self._folder(table)
        columns = [f["name"] for f in described["schema"]["fields"]]
        self._write(df.select(*columns), folder, format=described.get("format", "parquet"))
        self.tables[table] = {**described, "parts": {"": [*described["parts"][""], [folder, 0]]}}

    def upsert(
        self,
        table: str,
        df: DataFrame,
        key: str | Sequence[str],
        order: str | Sequence[str],
        buckets: int | None = None,
        line: str | None = None,
        merged: bool = False,
    ) -> None:
        """Rows of ``df`` with the latest ``order`` of their key replace older ones.

        ``buckets`` sizes a new table (default: the session's number of shuffle
        partitions) and holds from then on. With ``merged`` the rows of ``df`` are
        of one version of each key already, and no line comes twice.
        """
        key = [key] if isinstance(key, str) else list(key)
        order = [order] if isinstance(order, str) else list(order)
        described = self.tables.get(table)
        if described is None:
            n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            described = {"schema": df.schema.jsonValue(), "key": key, "order": order, "line": line, "buckets": n, "parts": {}}
        if buckets is not None and buckets != described["buckets"]:
            raise ValueError(f"{table} has {described['buckets']} buckets, not {buckets}")
        if (described["key"], described["order"], described["line"]) != (key, order, line):
            raise ValueError(f"{table} is kept by {described['key']}, {described['order']}, {described['line']}")
        columns = [f["name"] for f in described["schema"]["fields"]]
        rows = df.select(*columns)
        rows = (rows if merged else latest_rows(rows, key, order, line)).withColumn(BUCKET, bucket_of(key, described["buckets"]))
        folder = self._folder(table)
        self._write(self._dealt(rows, described), folder, [BUCKET])
        parts = {b: list(p) for b, p in described["parts"].items()}
        for name in self.store.files.names(f"{self.store.root}/{folder}"):
            if name.startswith(f"{BUCKET}="):
                new = [f"{folder}/{name}", self.store.files.size(f"{self.store.root}/{folder}/{name}")]
                parts.setdefault(name.split("=")[1], []).append(new)
        self.tables[table] = self._compacted(table, {**described, "parts": parts})

    @staticmethod
    def _dealt(rows: DataFrame, described: dict) -> DataFrame:
        """Rows dealt to their buckets. A bucket is one file or, with ``line``, one a
        task that has rows of it; the lines of a key stand together, where what they
        share takes little room, but for so many that they are dealt in blocks."""
        key, line = described["key"], described["line"]
        if line is None:
            return rows.repartition(BUCKET)
        share = F.pmod(F.hash(*key), F.lit(BUCKET_SHARES))
        block = F.floor(F.col(line).cast("double") / LINE_BLOCK)
        return rows.repartition(BUCKET, share, block).sortWithinPartitions(BUCKET, *key, line)

    def compact(self, table: str) -> None:
        """Rewrite every bucket that has deltas, so that readers merge nothing."""
        described = self.tables[table]
        self.tables[table] = self._rewritten(table, described, [b for b, part in described["parts"].items() if len(part) > 1])

    def _compacted(self, table: str, described: dict) -> dict:
        """The table with those buckets rewritten whose deltas have outgrown the rest."""
        due = [
            b for b, part in described["parts"].items()
            if len(part) > 1 + MOST_DELTAS or len(part) > 1 and sum(size for _, size in part[1:]) >= part[0][1]
        ]
        return self._rewritten(table, described, due)

    def _rewritten(self, table: str, described: dict, due: list[str]) -> dict:
        """The table with some buckets rewritten, as many at a time as are moved at once."""
        parts = dict(described["parts"])
        for some in rounds({b: sum(size for _, size in parts[b]) for b in due}):
            rows = self.store._merged(described, [parts[b] for b in some])
            folder = f"{self._folder(table)}-whole"
            rows = rows.withColumn(BUCKET, bucket_of(described["key"], described["buckets"]))
            self._write(self._dealt(rows, described), folder, [BUCKET])
            for b in some:
                path = f"{folder}/{BUCKET}={b}"
                parts[b] = [[path, self.store.files.size(f"{self.store.root}/{path}")]]
        return {**described, "parts": parts}

    def done(self, source: str) -> int:
        """The last batch of a source that a commit has named (-1: none)."""
        return int(self.base["done"].get(source, -1))

    def commit(self, source: str | None = None, batch: int | None = None) -> int:
        """Let the change go live; the new version. ``source`` and ``batch`` note
        what has been taken in, so that a batch run again is told from a new one."""
        version = self.base["version"] + 1
        done = self.base["done"] if source is None else {**self.base["done"], source: batch}
        text = json.dumps({"version": version, "tables": self.tables, "done": done})
        self.store.files.create(self.store._path(version), text)
        return version
