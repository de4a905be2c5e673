"""Table sinks: replace a table in a file format, a catalog table or over JDBC."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import ensure_checkpoint_dir

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def create_namespace(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS name`` in the session catalog."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    format: str = "parquet",
    partition_by: Sequence[str] | None = None,
    as_table: bool = False,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    options: dict[str, str] | None = None,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
) -> str:
    """Write ``df`` to ``target`` and return the target.

    * default: files of ``format`` at path ``target`` (``mode="overwrite"``
      replaces the table, as a load with replace semantics does);
    * ``as_table=True``: a catalog table named ``target`` (``db.table``);
      with ``bucket_by=(n, cols)`` it is bucketed and sorted on ``cols``, so
      joins between tables bucketed the same way on the join key need no
      shuffle;
    * ``jdbc_url``: a database table named ``target`` over JDBC (the driver
      jar must be on the classpath).

    The write runs as one distributed job; Spark's commit protocol makes the
    output visible only when every task has finished, and a task lost with
    its executor is re-run.
    """
    if jdbc_url is not None:
        df.write.mode(mode).jdbc(jdbc_url, target, properties=dict(jdbc_properties or {}))
        return target
    writer = df.write.mode(mode).format(format).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        if not as_table:
            raise ValueError("bucketing needs a catalog table (as_table=True)")
        buckets, cols = bucket_by
        writer = writer.bucketBy(buckets, *cols).sortBy(*cols)
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)
    return target


def go_live(spark: SparkSession, staged: dict[str, str]) -> None:
    """Let staged catalog tables take the places of live ones (live name -> staged name).

    Nothing is written here, only renamed. If a rename fails, those made before
    it are taken back, so either all tables are new or all are as they were; the
    old ones are dropped last.
    """
    old = {live: f"{live}__old_{uuid.uuid4().hex[:8]}" for live in staged if spark.catalog.tableExists(live)}
    renames = [pair for live, new in staged.items() for pair in ([(live, old[live])] if live in old else []) + [(new, live)]]
    made: list[tuple[str, str]] = []
    try:
        for before, after in renames:
            spark.sql(f"ALTER TABLE {before} RENAME TO {after}")
            made.append((before, after))
    except Exception:
        for before, after in reversed(made):
            spark.sql(f"ALTER TABLE {after} RENAME TO {before}")
        raise
    for name in old.values():
        spark.sql(f"DROP TABLE {name}")


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` (recursively) through the Hadoop FileSystem of the session."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(jpath, True))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs in here go when their job has ended, not when the
    driver happens to collect its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def stage(df: DataFrame, name: str = "stage", format: str = "parquet", partition_by: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared checkpoint folder; its copy and the copy's folder.

    Used where one expensive input (parsed JSON) feeds several outputs: the
    parse runs once, the lineage is cut at the written files, and each output
    reads only the columns it needs from the columnar copy. The caller removes
    the folder when it is done with it. ``partition_by``: a column whose values
    get a folder each.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tillroll-stage/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("error").format(format)
    if format == "parquet":
        writer = writer.option("compression", "zstd")
    if partition_by is None:
        writer.save(path)
        return spark.read.format(format).load(path), path
    writer.partitionBy(partition_by).save(path)
    return spark.read.schema(df.schema).format(format).load(path), path  # there are no files without rows
