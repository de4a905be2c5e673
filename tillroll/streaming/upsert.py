"""Incremental loading with Structured Streaming: keep the latest record per key.

New documents arrive as files in a folder. A streaming query reads them
(``readStream`` with a declared schema), and every micro-batch is merged into a
table of a :class:`tillroll.sources.snapshots.Snapshots` store that keeps only
the latest version of each key.

A micro-batch becomes one commit of that store: its rows are written as deltas
of the buckets they belong to, beside the live files, and go live with the
store's next manifest. The manifest also notes the stream and the number of the
batch. A batch that was lost half way is run again from the stream's own
checkpoint on the unchanged table; one that was committed just before the loss
is recognised by its number and passed over.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.snapshots import Snapshots

TABLE = "latest"


def _store(spark: SparkSession, target_dir: str) -> Snapshots:
    """The store of a target; a folder that holds anything else is an error."""
    store = Snapshots(spark, target_dir)
    if not store.versions():
        others = [n for n in store.files.names(target_dir) if n not in ("_manifest", TABLE)]
        if others:
            raise ValueError(f"{target_dir} holds other data: {others[:3]}")
    return store


def upsert_batch(
    batch: DataFrame,
    target_dir: str,
    key: str | Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] = (),
    buckets: int | None = None,
    source: str | None = None,
    epoch: int | None = None,
) -> None:
    """Merge one batch of records into the latest-per-key table of ``target_dir``.

    ``buckets`` sizes a new table (default: ``spark.sql.shuffle.partitions``);
    it is stored with the table, whose number holds from then on. With ``source``
    and ``epoch`` a batch that the table already holds is passed over.
    """
    change = _store(batch.sparkSession, target_dir).change()
    if source is not None and epoch is not None and epoch <= change.done(source):
        return
    change.upsert(TABLE, batch, key, [order_col, *tie_breakers], buckets)
    change.commit(source, epoch)


def start_upsert_stream(
    stream: DataFrame,
    target_dir: str,
    key: str | Sequence[str],
    order_col: str,
    checkpoint_location: str | None = None,
    tie_breakers: Sequence[str] = (),
    buckets: int | None = None,
    available_now: bool = True,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the streaming upsert of ``stream`` into ``target_dir``.

    ``transform`` is applied to every micro-batch first (for example a
    document loader). With ``available_now`` the query processes what is
    there and stops; otherwise it keeps running on new files.
    """

    def each(batch: DataFrame, source: str, epoch: int) -> None:
        rows = transform(batch) if transform is not None else batch
        upsert_batch(rows, target_dir, key, order_col, tie_breakers, buckets, source, epoch)

    return start_batches(stream, each, checkpoint_location, available_now)


def start_batches(
    stream: DataFrame,
    each: Callable[[DataFrame, str, int], None],
    checkpoint_location: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``each(batch, source, epoch)`` on every micro-batch of ``stream``.

    ``source`` names the stream for good: it is the place of its checkpoint, on
    which the numbers of its batches depend.
    """
    if checkpoint_location is None:
        base = ensure_checkpoint_dir(stream.sparkSession).rstrip("/")
        checkpoint_location = f"{base}/tillroll-streams/{uuid.uuid4().hex}"
    writer = stream.writeStream.foreachBatch(lambda batch, epoch: each(batch, checkpoint_location, epoch))
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def document_stream(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    format: str = "json",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A file stream of documents (JSON lines by default) with a declared schema."""
    return spark.readStream.schema(schema).options(**(options or {})).format(format).load(source_dir)


def read_latest(spark: SparkSession, target_dir: str, schema: StructType | str | None = None) -> DataFrame:
    """The upserted table. The store knows its schema; one that is given selects
    its columns and their types."""
    latest = Snapshots(spark, target_dir).read(TABLE)
    if schema is None:
        return latest
    fields = spark.createDataFrame([], schema).schema.fields
    return latest.select(*[F.col(f.name).cast(f.dataType) for f in fields])


def scratch_target(spark: SparkSession, name: str) -> str:
    """A fresh folder for a streaming target under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return os.path.join(base, "tillroll-targets", f"{name}-{uuid.uuid4().hex}")
