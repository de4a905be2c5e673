"""Spark session defaults for the receipt analytics jobs.

The settings below are the ones the queries in this package rely on:

* session time zone UTC, so ``date_trunc`` on TIMESTAMP_NTZ columns and the
  epoch-millisecond conversions give wall-clock values that match Postgres /
  DuckDB ``timestamp`` semantics;
* adaptive query execution with partition coalescing and skew-join splitting,
  so a hot key (one brand, one month, one receipt) is split at run time instead
  of landing in one task;
* broadcast joins only through Spark's own size checks
  (``autoBroadcastJoinThreshold`` on the estimated size when planning, and the
  adaptive threshold on the measured shuffle size at run time); no query in
  this package forces a broadcast of a table whose size grows with the data;
* checkpoint files are removed by Spark's cleaner once unreferenced;
* the Spark UI is off.

On a cluster the launcher's configuration wins: :func:`get_session` only fills
in settings that are not already present.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete reliable-checkpoint files once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "tillroll",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with :data:`DEFAULTS`.

    ``master`` defaults to ``$SPARK_MASTER`` or ``local[*]``. An already
    running session is reused as is (its configuration is the cluster's).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name).master(
        master or os.environ.get("SPARK_MASTER", "local[*]")
    )
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``checkpoint()`` has a directory and return it.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is. Only a local-mode session with nothing configured (tests) gets a
    fresh scratch folder; on a cluster a machine-local folder would not be
    visible to the executors, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
