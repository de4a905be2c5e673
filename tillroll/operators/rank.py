"""Ranking operators: top-k per group with ties, and global dense ranks.

Three shapes occur in the analytics:

* :func:`top_k_dense` -- ``DENSE_RANK() OVER (PARTITION BY g ORDER BY v DESC)``
  followed by ``rank <= k``. Spark plans this as a partial
  ``WindowGroupLimit`` before the shuffle and a final one after it, so each map
  task ships at most the top-k (with ties) rows of every group; a group that
  holds a third of all rows costs no more shuffle than a small one.
* :func:`global_dense_rank` -- ``DENSE_RANK() OVER (ORDER BY v DESC)`` with no
  partition and no limit. A plain window would move every row into one task.
  Here the distinct values are dealt to ranges once, and the range of each value
  is written down beside it (:func:`in_ranges`); every later step reads that
  copy. A value's rank is its rank within its range plus the number of values in
  earlier ranges (one row per range). The ranks are joined back on the value;
  rows sharing one hot value are split by adaptive skew-join handling. The input
  is checkpointed once, so its upstream plan is not run once per reference.
* :func:`number_in_order` -- consecutive numbers in a given order over the whole
  input, by the same ranges.
* :func:`top_n_ranked` -- the first ``n`` rows by rank (``LIMIT n``). The
  ordered limit runs as a distributed top-n; the dense rank of a row in that
  prefix equals its rank in the whole input, because every larger value
  appears before it.

NULL values order first under ``DESC`` by default, as in Postgres.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir


def sort_order(col: str | Column, descending: bool = True, nulls_first: bool = True) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def top_k_dense(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    k: int,
    rank_col: str = "rank",
    descending: bool = True,
    nulls_first: bool = True,
) -> DataFrame:
    """Rows whose dense rank within their group is at most ``k`` (ties kept)."""
    w = Window.partitionBy(*group_cols).orderBy(sort_order(value_col, descending, nulls_first))
    return df.withColumn(rank_col, F.dense_rank().over(w)).where(F.col(rank_col) <= k)


RANGE = "_range"


def in_ranges(df: DataFrame, order: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """``df`` dealt to ranges of ``order``, with the number of each row's range in ``_range``.

    The bounds of a range partitioning come from a sample, and a plan that is
    run twice may draw them differently. So the numbered rows are materialised
    once, with a reliable ``checkpoint()`` in the shared folder: from then on
    the range of a row is data. Rows equal in ``order`` share a range.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).withColumn(RANGE, F.spark_partition_id()).checkpoint(eager=True)


def _rows_before(ranged: DataFrame) -> DataFrame:
    """(_range, _before): how many rows stand in earlier ranges; one row per range."""
    sizes = ranged.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.select(RANGE, (F.sum("_n").over(Window.orderBy(RANGE)) - F.col("_n")).alias("_before"))


def _numbered(ranged: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Each row's place in ``order``, from 1: its place within its range, whose
    rows one task sorts, behind the rows of earlier ranges."""
    within = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    placed = ranged.withColumn("_place", within).join(F.broadcast(_rows_before(ranged)), RANGE)
    return placed.withColumn(name, F.col("_before") + F.col("_place")).drop(RANGE, "_place", "_before")


def number_in_order(df: DataFrame, order: Sequence[str], name: str = "number", num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` = 1, 2, 3, ... in ascending ``order`` (BIGINT).

    ``order`` should tell rows apart: the columns may tie only in rows that may
    change places. Rows equal in all of them share one task.
    """
    columns = [F.col(c).asc_nulls_first() for c in order]
    return _numbered(in_ranges(df, columns, num_partitions), columns, name)


def global_dense_rank(
    df: DataFrame,
    value_col: str,
    rank_col: str = "rank",
    descending: bool = True,
    nulls_first: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` = dense rank of ``value_col`` over the whole input.

    Runs without a single-partition window over rows. The input is read twice
    (distinct values, join-back), so it is first materialised once with a
    reliable ``checkpoint()`` in the shared checkpoint folder: the upstream plan
    (scans, joins, aggregations) runs once, every reference sees the same values
    (a re-run sum of doubles could differ in its last bits and miss the
    join-back), and the files survive the loss of an executor. The input is
    typically an aggregate (one row per group), so the checkpoint is small next
    to the work that produced it. The result doesn't depend on exchanges being
    reused.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    order = [sort_order("_v", descending, nulls_first)]
    values = df.select(F.col(value_col).alias("_v")).distinct()
    ranks = _numbered(in_ranges(values, order, num_partitions), order, rank_col).withColumn(rank_col, F.col(rank_col).cast("int"))
    joined = df.join(ranks, df[value_col].eqNullSafe(ranks["_v"]), "inner")
    return joined.drop("_v")


def top_n_ranked(
    df: DataFrame,
    value_col: str,
    n: int,
    tie_cols: Sequence[str] = (),
    rank_col: str = "rank",
    descending: bool = True,
    nulls_first: bool = True,
) -> DataFrame:
    """The first ``n`` rows ordered by dense rank, then ``tie_cols``.

    The result holds at most ``n`` rows, so the final window over it runs on
    a bounded input.
    """
    order = [sort_order(value_col, descending, nulls_first)] + [F.col(c).asc() for c in tie_cols]
    head = df.orderBy(*order).limit(n)
    w = Window.orderBy(sort_order(value_col, descending, nulls_first))
    return head.withColumn(rank_col, F.dense_rank().over(w))
