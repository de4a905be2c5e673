"""Keep the latest version of each record (incremental upsert).

Records carry a key and a modification time. The latest version per key is
found with ``max(struct(order, tie-breakers, rest))`` in a partial and a final sort aggregation:
the partial aggregation keeps one row per key in every map task before the
shuffle, so a key that holds a third of all versions costs one row per task,
not a third of the data in one task (as a ``row_number`` window over the key
would). Ties on the order column are broken by the remaining columns in
order, so the result does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the row with the greatest ``order_col``.

    A NULL ``order_col`` loses to any non-NULL one. Output columns are those
    of ``df`` in their original order.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order_col and c not in tie_breakers]
    ordered = [order_col, *tie_breakers, *rest]
    packed = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ordered)])
    agg = df.groupBy(*keys).agg(F.max(packed).alias("_latest"))
    out = agg.select(*keys, *[F.col(f"_latest._{i}").alias(c) for i, c in enumerate(ordered)])
    return out.select(*df.columns)


def merge_latest(
    current: DataFrame,
    changes: DataFrame,
    key: str | Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Upsert ``changes`` into ``current``: the latest version of every key."""
    return latest_per_key(current.unionByName(changes, allowMissingColumns=True), key, order_col, tie_breakers)
