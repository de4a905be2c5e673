"""Incremental load: changed documents into the four tables, batch by batch.

Documents carry ``db_last_modified`` and perhaps ``deleted``. Each batch of a
source becomes one commit of a :class:`tillroll.sources.snapshots.Snapshots`
store, in which the tables keep the latest version of each document:

* a document that comes late, behind a newer version of itself, changes nothing;
* one that is delivered again changes nothing (versions are compared by time
  and, where that is equal, by a digest of the document, in all tables alike);
* a newer receipt replaces its row and *all* its items: lines that it no longer
  lists are gone;
* a deleted document takes its rows away, until a newer version brings it back.

The receipts and the items of a batch go live together. Documents without an id
can't be told apart and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from tillroll.functions.dates import epoch_millis_to_ts
from tillroll.operators.upsert import latest_per_key
from tillroll.plans.batch_load import LoadedTables
from tillroll.sources import schemas as S
from tillroll.sources.documents import load_brands, load_items, load_receipts, load_users
from tillroll.sources.sinks import freed_shuffles, remove_path, stage
from tillroll.sources.snapshots import DELETED, Change, Conflict, Snapshots, bucket_of, rounds
from tillroll.streaming.upsert import document_stream, start_batches

MODIFIED, DIGEST, KEY = "_modified", "_digest", "_key"
VERSION = [MODIFIED, DIGEST]
#: The fields by which a document tells its version.
VERSION_FIELDS = [StructField("db_last_modified", S.DATE), StructField("deleted", BooleanType())]
#: Commits that another writer may get ahead of.
TRIES = 5
#: Groups of buckets that a batch is staged in.
GROUP, GROUPS = "_group", 16


def versioned(schema: StructType) -> StructType:
    return StructType(schema.fields + VERSION_FIELDS)


SCHEMAS = {"receipts": versioned(S.RECEIPT), "users": versioned(S.USER), "brands": versioned(S.BRAND)}


def _with_version(docs: DataFrame) -> DataFrame:
    return docs.withColumns(
        {
            MODIFIED: epoch_millis_to_ts(F.col("db_last_modified.$date")),
            DIGEST: F.md5(F.to_json(F.struct(*docs.columns))),
            DELETED: F.coalesce("deleted", F.lit(False)),
        }
    ).where(F.coalesce(F.col("_id.$oid"), F.lit("")) != "")


def latest_documents(docs: DataFrame) -> DataFrame:
    """The latest version of each document of a batch, as rows of their own that
    tell their version. A document's lines need no comparison after that."""
    versions = _with_version(docs).withColumn(KEY, F.col("_id.$oid"))
    return latest_per_key(versions, KEY, MODIFIED, tie_breakers=[DIGEST]).drop(KEY)


def take_in(change: Change, source: str, docs: DataFrame, buckets: int | None = None) -> None:
    """Add a batch of documents of ``source`` (or their latest versions) to a commit."""
    docs, carry = docs if DIGEST in docs.columns else latest_documents(docs), [*VERSION, DELETED]
    new = lambda table: None if table in change.tables else buckets
    if source == "receipts":
        change.upsert("receipts", load_receipts(docs, carry=carry), "id", VERSION, new("receipts"), merged=True)
        # A row without a line for each document: a receipt without items has a version too.
        heads = docs.select(F.col("_id.$oid").alias("receipt_id"), F.lit(None).cast("int").alias("line_no"), *carry)
        lines = load_items(docs, carry=carry).unionByName(heads, allowMissingColumns=True)
        change.upsert("rewards_receipt_items", lines, "receipt_id", VERSION, new("rewards_receipt_items"), line="line_no", merged=True)
    else:
        loader = {"users": load_users, "brands": load_brands}[source]
        change.upsert(source, loader(docs, carry=carry), "id", VERSION, new(source), merged=True)


def apply_batch(
    spark: SparkSession,
    root: str,
    source: str,
    docs: DataFrame,
    stream: str | None = None,
    epoch: int | None = None,
    buckets: int | None = None,
) -> None:
    """Commit one batch of documents. If another writer commits first, the batch
    is merged again on top of that; a batch the store already holds is passed over.

    The documents are moved some buckets at a time (:data:`snapshots.ROUND_BYTES`),
    so the disk that shuffles take doesn't grow with the batch.
    """
    store = Snapshots(spark, root)
    if stream is not None and epoch is not None and epoch <= store.change().done(stream):
        return
    described = store.change().tables.get("receipts" if source == "receipts" else source)
    n = described["buckets"] if described else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.pmod(bucket_of(["_id.$oid"], n), F.lit(GROUPS)).alias(GROUP)
    with freed_shuffles(spark), freed_shuffles(docs.sparkSession):
        staged, folder = stage(docs.select("*", group), f"{source}-documents", partition_by=GROUP)
        try:
            sizes = {name: store.files.size(f"{folder}/{name}") for name in store.files.names(folder) if name.startswith(f"{GROUP}=")}
            groups = [[int(name.split("=")[1]) for name in some] for some in rounds(sizes)]
            for left in range(TRIES - 1, -1, -1):
                change = store.change()
                for some in groups or [[]]:
                    _take_in_once(change, source, staged.where(F.col(GROUP).isin(some)).drop(GROUP), buckets)
                try:
                    change.commit(stream, epoch)
                    return
                except Conflict:
                    if not left:
                        raise
        finally:
            remove_path(spark, folder)


def _take_in_once(change: Change, source: str, docs: DataFrame, buckets: int | None) -> None:
    """Add documents to a commit; they are compared once for both receipt tables."""
    latest, folder = stage(latest_documents(docs), f"{source}-changes")
    try:
        take_in(change, source, latest, buckets)
    finally:
        remove_path(change.spark, folder)


def start_load_stream(
    spark: SparkSession,
    source: str,
    source_dir: str,
    root: str,
    checkpoint_location: str | None = None,
    buckets: int | None = None,
    available_now: bool = True,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Take in the document files (JSON lines) that arrive in ``source_dir``."""
    docs = document_stream(spark, source_dir, SCHEMAS[source], options=options)
    return start_batches(docs, lambda batch, stream, epoch: apply_batch(spark, root, source, batch, stream, epoch, buckets), checkpoint_location, available_now)


def compact(spark: SparkSession, root: str) -> None:
    """Merge the deltas of all tables into files that are read as they are, and
    remove what earlier versions consisted of."""
    store = Snapshots(spark, root)
    with freed_shuffles(spark):
        change = store.change()
        for table in store.tables():
            change.compact(table)
        change.commit()
    store.vacuum(keep=1)


def current_tables(spark: SparkSession, root: str) -> LoadedTables:
    """The four tables as of the latest commit; a source that has sent nothing has none."""
    store = Snapshots(spark, root)
    there = store.tables()
    read = lambda name: store.read(name).drop(*VERSION) if name in there else None
    return LoadedTables(receipts=read("receipts"), items=read("rewards_receipt_items"), users=read("users"), brands=read("brands"))
