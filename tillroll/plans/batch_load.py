"""The batch load: three document sources into four tables.

``load_all`` reads ``brands.json``, ``users.json`` and ``receipts.json``
from a source folder, flattens them with the loaders and writes the tables
``brands``, ``users``, ``receipts`` and ``rewards_receipt_items``. Receipt
documents are parsed once: the parsed documents are staged as parquet in the
shared checkpoint folder and both receipt tables are derived from that copy.
Files of one JSON array are read in parallel (:mod:`tillroll.sources.arrays`).

All four tables are written beside the live ones and go live together: in a
folder as one version of a :class:`tillroll.sources.snapshots.Snapshots` store,
in a database by renaming staged tables. A load that fails before that leaves
the tables of the last load as they were.

:class:`LoadedTables` reads the written tables back with the same column
names as :class:`tillroll.sources.tables.Tables`, so every report operator
runs on loaded data unchanged.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.dates import month_start
from tillroll.operators.brands import CREATE_MONTH, RECEIPT_MONTH
from tillroll.sources import schemas as S
from tillroll.sources.arrays import read_arrays
from tillroll.sources.documents import (
    load_brands,
    load_items,
    load_receipts,
    load_users,
    read_documents,
)
from tillroll.sources.sinks import create_namespace, go_live, remove_path, stage, write_table
from tillroll.sources.snapshots import Snapshots

SOURCES = {"brands": "brands.json", "users": "users.json", "receipts": "receipts.json"}
TABLE_NAMES = ("brands", "users", "receipts", "rewards_receipt_items")
DATES = {"receipts": "create_date", "rewards_receipt_items": "receipt_create_date"}
# table -> (source documents, schema, loader)
TABLE_SOURCES = {
    "brands": ("brands", S.BRAND, load_brands),
    "users": ("users", S.USER, load_users),
    "receipts": ("receipts", S.RECEIPT, load_receipts),
    "rewards_receipt_items": ("receipts", S.RECEIPT, load_items),
}


def load_table(
    spark: SparkSession,
    table: str,
    source_path: str,
    target_path: str,
    format: str = "parquet",
    multiline: bool = True,
    on_missing: str = "error",
    on_corrupt: str = "fail",
) -> str:
    """One table on its own: read its source documents, flatten, replace the target."""
    _, schema, loader = TABLE_SOURCES[table]
    docs = read_documents(spark, source_path, schema, multiline, on_missing=on_missing, on_corrupt=on_corrupt)
    return write_table(loader(docs), target_path, format=format)


def load_all(
    spark: SparkSession,
    src_dir: str,
    target_dir: str | None = None,
    format: str = "parquet",
    multiline: bool = True,
    on_missing: str = "error",
    on_corrupt: str = "fail",
    strip_dollar: bool = True,
    drop_missing_id: bool = False,
    database: str | None = None,
    receipt_buckets: int | None = None,
    keep_stage: bool = False,
    keep_versions: int = 2,
) -> dict[str, str]:
    """Load the three sources and write the four tables; returns name -> target.

    Tables go to ``target_dir`` as one version of a store, read back with
    :meth:`LoadedTables.from_dir` (``keep_versions`` of them stay, for readers
    that began earlier), or, with ``database``, to catalog tables
    ``database.<name>``. In both cases the four tables go live together. In a
    folder, receipts and items are partitioned by the receipt's month of
    creation, unless receipt ids repeat. ``receipt_buckets=n`` (catalog tables
    only) buckets ``receipts`` by ``id`` and ``rewards_receipt_items`` by
    ``receipt_id`` into the same ``n`` buckets: the receipt-item join of every
    report then reads matching buckets side by side without a shuffle.

    ``on_missing="empty"`` writes an empty table (with its columns) for a
    missing source file; ``on_corrupt`` tells what a malformed document does
    (:func:`tillroll.sources.arrays.read_arrays`). Staged documents are removed
    when the load ends, also by an error, unless ``keep_stage``. A database that isn't there is created.
    """
    if (target_dir is None) == (database is None):
        raise ValueError("give exactly one of target_dir and database")
    if receipt_buckets is not None and database is None:
        raise ValueError("bucketed tables need a database (catalog tables)")
    src = src_dir.rstrip("/")
    staged: list[str] = []

    def docs(name: str, schema) -> DataFrame:
        """The parsed documents of a source; those of receipts, which two tables
        read, and those of array files are staged."""
        path = f"{src}/{SOURCES[name]}"
        if multiline:
            read, folder = read_arrays(spark, path, schema, on_missing=on_missing, on_corrupt=on_corrupt)
        else:
            read = read_documents(spark, path, schema, False, on_missing=on_missing, on_corrupt=on_corrupt)
            if name != "receipts":
                return read
            read, folder = stage(read, "receipt-documents")
        staged.append(folder)
        return read

    if database is not None:
        create_namespace(spark, database)
    try:
        receipts_docs = docs("receipts", S.RECEIPT)
        tables = {
            "brands": load_brands(docs("brands", S.BRAND)),
            "users": load_users(docs("users", S.USER)),
            "receipts": load_receipts(receipts_docs, drop_missing_id=drop_missing_id),
            "rewards_receipt_items": load_items(receipts_docs, strip_dollar=strip_dollar),
        }
        if database is None:
            out = _load_folder(spark, target_dir, tables, format, keep_versions)
        else:
            out = _load_database(spark, database, tables, format, receipt_buckets)
    finally:
        for folder in () if keep_stage else staged:
            remove_path(spark, folder)
    return out


def _load_folder(spark: SparkSession, target_dir: str, tables: dict[str, DataFrame], format: str, keep: int) -> dict[str, str]:
    store = Snapshots(spark, target_dir)
    change = store.change()
    tables, months = dict(tables), {}
    if not tables["receipts"].groupBy("id").count().where("count > 1").take(1):
        # An item's month is its receipt's, so reports can join on it as well,
        # which prunes the folders of the other months.
        months = {"receipts": CREATE_MONTH, "rewards_receipt_items": RECEIPT_MONTH}
        for name, month in months.items():
            tables[name] = tables[name].withColumn(month, month_start(DATES[name]).cast("date"))
    for name, df in tables.items():
        if name in months:
            # Few files a month, several where a month is large.
            df = df.hint("rebalance", months[name])
        # Row groups sorted by creation time carry tight min/max values, so
        # date-window filters pushed into the reader skip most of them.
        order = [c for c in (months.get(name), DATES.get(name)) if c]
        df = df.sortWithinPartitions(*order) if order else df
        change.replace(name, df, format, [months[name]] if name in months else [])
    change.commit()
    store.vacuum(keep)
    return {name: f"{store.root}/{name}" for name in tables}


def _load_database(spark: SparkSession, database: str, tables: dict[str, DataFrame], format: str, n: int | None) -> dict[str, str]:
    buckets = {"receipts": ["id"], "rewards_receipt_items": ["receipt_id"]}
    load = uuid.uuid4().hex[:8]
    staged = {f"{database}.{name}": f"{database}.{name}__new_{load}" for name in tables}
    try:
        for name, df in tables.items():
            spec = (n, buckets[name]) if n and name in buckets else None
            write_table(df, staged[f"{database}.{name}"], format=format, as_table=True, bucket_by=spec)
        go_live(spark, staged)
    except Exception:
        for name in staged.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    return {name: f"{database}.{name}" for name in tables}


@dataclass
class LoadedTables:
    """The batch load's output tables, read back."""

    receipts: DataFrame
    items: DataFrame
    users: DataFrame
    brands: DataFrame

    def register(self, prefix: str = "") -> None:
        """Temp views ``receipts``, ``items``, ``users``, ``brands`` for Spark SQL."""
        for name in ("receipts", "items", "users", "brands"):
            getattr(self, name).createOrReplaceTempView(prefix + name)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str) -> "LoadedTables":
        """The tables written by :func:`load_all` with ``database``."""
        return cls(
            receipts=spark.table(f"{database}.receipts"),
            items=spark.table(f"{database}.rewards_receipt_items"),
            users=spark.table(f"{database}.users"),
            brands=spark.table(f"{database}.brands"),
        )

    @classmethod
    def from_dir(cls, spark: SparkSession, target_dir: str, format: str = "parquet") -> "LoadedTables":
        """The tables written by :func:`load_all` with ``target_dir``; tables
        loaded one by one (:func:`load_table`) are read from ``target_dir/<name>``."""
        store = Snapshots(spark, target_dir)
        versioned = bool(store.versions())

        def read(name: str) -> DataFrame:
            return store.read(name) if versioned else spark.read.format(format).load(f"{store.root}/{name}")

        return cls(
            receipts=read("receipts"),
            items=read("rewards_receipt_items"),
            users=read("users"),
            brands=read("brands"),
        )
