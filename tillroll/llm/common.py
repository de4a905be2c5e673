"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

#: The white space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package.

    A launcher does this with ``--py-files`` or ``PYTHONPATH``; a session that
    was made without either gets the package's sources through Spark, once.
    """
    package = Path(__file__).resolve().parents[1]
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    name = f"{package.name}-sources.zip"
    if any(f.rstrip("/").endswith(name) for f in spark.sparkContext.listFiles):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tillroll-sources-"), name)
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    This cuts the lineage: a lost executor costs only the tasks it was running,
    since the files live in the folder of ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Shuffle files of the step just written go as soon as the driver's JVM
    # notices that nothing refers to them; a long chain needs their disk.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    """Partitions for a hand-made shuffle: what the session uses for its own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order (null: none)."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(plain, " ", -1), "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; behind it the Python worker, which Spark keeps
    for later tasks, gives the memory it no longer uses back to the machine."""

    @functools.wraps(run)
    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(parts)
        finally:
            give_back()

    return whole


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim is not None:
        trim(0)
