"""Data-quality audits: coverage, completeness and consistency checks.

Each audit is one DataFrame plan. Counting distinct keys goes through
Spark's partial/final aggregation (distinct keys are combined on the map side
before the shuffle); coverage ratios de-duplicate both sides before joining,
so an item list of any length adds one row per receipt, not one per item.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.cleaning import both_present_and_different, is_blank_description
from tillroll.functions.dates import day_start, month_start, truncate, ts_literal

TimeBound = str | _dt.date | _dt.datetime | None


def counts_by_bucket(
    df: DataFrame,
    ts_col: str,
    unit: str,
    id_col: str,
    bucket_name: str | None = None,
    count_name: str = "total",
    latest_day_only: bool = False,
) -> DataFrame:
    """``count(id)`` per ``date_trunc(unit, ts)`` bucket.

    With ``latest_day_only`` only rows on the calendar day of the latest
    timestamp are counted (the day is a scalar subquery, applied as a
    half-open range on the raw timestamp).
    """
    if latest_day_only:
        latest_day = df.select(day_start(F.max(ts_col))).scalar()
        df = df.where(
            (F.col(ts_col) >= latest_day) & (F.col(ts_col) < latest_day + F.expr("INTERVAL 1 DAY"))
        )
    bucket = truncate(unit, ts_col).alias(bucket_name or unit)
    return df.groupBy(bucket).agg(F.count(id_col).alias(count_name))


def range_by_month(df: DataFrame, ts_col: str) -> DataFrame:
    """Latest and earliest month of ``ts_col``: columns max_month, min_month."""
    return df.agg(
        month_start(F.max(ts_col)).alias("max_month"),
        month_start(F.min(ts_col)).alias("min_month"),
    )


def totals_by(
    df: DataFrame,
    key: str,
    value: str,
    keep: Sequence[str] | None = None,
    total_name: str = "total",
    share_name: str | None = None,
) -> DataFrame:
    """``sum(value)`` per ``key``, optionally only for keys in ``keep``.

    With ``share_name`` each total is also divided by the sum of all totals
    (the window runs over one row per key, after aggregation).
    """
    if keep is not None:
        df = df.where(F.col(key).isin(*keep))
    out = df.groupBy(key).agg(F.sum(value).alias(total_name))
    if share_name:
        grand = F.sum(total_name).over(Window.partitionBy())
        out = out.withColumn(share_name, F.try_divide(F.col(total_name).cast("double"), grand))
    return out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def coverage(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    right_filter: Column | None = None,
    ts_col: str | None = None,
    start: TimeBound = None,
    end: TimeBound = None,
    inclusive_end: bool = True,
    names: tuple[str, str, str] = ("total", "matched", "share"),
) -> DataFrame:
    """How many distinct left keys have at least one matching right row.

    Same result as ``count(DISTINCT l.key), count(DISTINCT r.key)`` over
    ``left LEFT JOIN right ON r.key = l.key [AND right_filter]`` with an
    optional ``ts_col`` window on the left (``start <= ts``; ``ts <= end``
    when ``inclusive_end``, else ``ts < end``). Both sides are reduced to
    their distinct keys first, so the join is one-to-one.

    Columns: ``names`` = (total, matched, share).
    """
    if ts_col is not None:
        if start is not None:
            left = left.where(F.col(ts_col) >= ts_literal(start))
        if end is not None:
            bound = ts_literal(end)
            left = left.where(F.col(ts_col) <= bound if inclusive_end else F.col(ts_col) < bound)
    keys = left.select(F.col(left_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    if right_filter is not None:
        right = right.where(right_filter)
    hits = right.select(F.col(right_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    hits = hits.select("_k", F.lit(True).alias("_hit"))
    total, matched, share = names
    return (
        keys.join(hits, "_k", "left")
        .agg(F.count(F.lit(1)).alias(total), F.count("_hit").alias(matched))
        .select(total, matched, _ratio(F.col(matched), F.col(total)).alias(share))
    )


def distinct_count_pair(
    left: DataFrame,
    left_key: str,
    right: DataFrame,
    right_key: str,
    names: tuple[str, str, str] = ("left_total", "right_total", "share"),
) -> DataFrame:
    """Two independent distinct counts and their ratio (right / left).

    The right count is a scalar subquery on the left's one-row aggregate.
    """
    a, b, share = names
    right_count = right.agg(F.countDistinct(right_key)).scalar()
    return left.agg(F.countDistinct(left_key).alias(a)).select(
        a, right_count.alias(b), _ratio(right_count, F.col(a)).alias(share)
    )


def mismatch_count(df: DataFrame, a: str, b: str, name: str = "mismatches") -> DataFrame:
    """Rows where both columns are present and differ."""
    return df.where(both_present_and_different(a, b)).agg(F.count(F.lit(1)).alias(name))


def presence(df: DataFrame, col: str, names: tuple[str, str, str] = ("present", "absent", "share")) -> DataFrame:
    """Non-null count, null count and non-null share of ``col``."""
    present, absent, share = names
    return df.agg(
        F.count(col).alias(present),
        F.count_if(F.col(col).isNull()).alias(absent),
    ).select(present, absent, _ratio(F.col(present), F.col(present) + F.col(absent)).alias(share))


def blank_count(
    df: DataFrame, col: str, markers: tuple[str, ...] = ("ITEM NOT FOUND",), name: str = "blank"
) -> DataFrame:
    """Rows whose ``col`` is missing, blank, or one of ``markers``."""
    return df.agg(F.count_if(is_blank_description(col, markers)).alias(name))


def rows_with_null_parent_value(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    parent_value: str,
    select: Sequence[Column | str],
) -> DataFrame:
    """Child rows whose parent row has a NULL ``parent_value`` (inner join)."""
    p = parents.where(F.col(parent_value).isNull())
    joined = children.join(p, children[child_key] == p[parent_key])
    return joined.select(*select)


def rows_by_parent_key(
    parents: DataFrame,
    children: DataFrame,
    parent_key: str,
    child_key: str,
    group_col: str,
    keep: Sequence[str] | None = None,
    name: str = "total",
) -> DataFrame:
    """Number of child rows per parent ``group_col`` value (inner join).

    Child rows are counted per key before the join, so a key with many rows
    comes to it as one.
    """
    p = parents.select(F.col(parent_key).alias("_pk"), group_col)
    if keep is not None:
        p = p.where(F.col(group_col).isin(*keep))
    c = children.groupBy(F.col(child_key).alias("_pk")).agg(F.count(F.lit(1)).alias("_n"))
    return c.join(p, "_pk").groupBy(group_col).agg(F.sum("_n").alias(name))


def month_gaps(df: DataFrame, ts_col: str, name: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """Calendar months without rows between the first and last month of ``ts_col``.

    With ``by``, for each value of these columns by its own first and last
    month. The months seen are a distinct aggregate, at most one row per
    calendar month and value; each is set against the next one, and the months
    between them are the gap. The rows themselves are read once.
    """
    month = F.expr("INTERVAL 1 MONTH")
    seen = df.where(F.col(ts_col).isNotNull()).select(*by, month_start(ts_col).alias("_seen")).distinct()
    following = F.lead("_seen").over(Window.partitionBy(*by).orderBy("_seen"))
    gaps = seen.withColumn("_next", following).where(F.col("_next") > F.col("_seen") + month)
    return gaps.select(*by, F.explode(F.sequence(F.col("_seen") + month, F.col("_next") - month, month)).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Key values that occur in more than one row, with their row count.

    A join on such a key fans out (every matching row pairs with every
    copy); this audit lists where that happens.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
