"""Brand rankings: receipts per brand and month, spend and transactions.

All joins are equi-joins left to Spark's planner. A join side is broadcast
only when Spark's own size check allows it (estimated size when planning,
measured shuffle size with adaptive execution); otherwise the join shuffles.
For spend, items are reduced to one row per brand code before the brand join,
so that join sees aggregated rows, not item rows. Distinct receipt counts rely
on Spark's distinct-aggregate plan, which de-duplicates (group, receipt) pairs
on the map side before the shuffle. A brand code that appears in several
brand rows still fans out exactly as the SQL join does.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.cleaning import clean_price, clean_quantity, spend
from tillroll.functions.dates import month_start, ts_literal
from tillroll.operators.cohort import recent_users
from tillroll.operators.rank import global_dense_rank, top_k_dense, top_n_ranked

TimeBound = str | _dt.date | _dt.datetime | Column | None

#: Partition columns of loaded receipts and items whose receipt ids are unique:
#: the month of the receipt's creation, as a date.
CREATE_MONTH, RECEIPT_MONTH = "create_month", "receipt_month"


def cents(amount: Column) -> Column:
    """An amount rounded to whole cents (half a cent to the even one), as DECIMAL(18,0).

    Money is summed exactly in cents, so a total does not depend on the order
    in which thousands of tasks add their partial sums. An amount beyond 18
    digits (a price text such as ``1e30``) isn't money: it counts as missing.
    """
    return F.rint(amount * 100).try_cast("decimal(18,0)")


def _window(df: DataFrame, col: str, start: TimeBound, end: TimeBound) -> DataFrame:
    """``start <= col < end`` on the raw timestamp (reaches the parquet filter)."""
    if start is not None:
        df = df.where(F.col(col) >= _bound(start))
    if end is not None:
        df = df.where(F.col(col) < _bound(end))
    return df


def _bound(value: TimeBound) -> Column:
    return value if isinstance(value, Column) else ts_literal(value)


def _months(df: DataFrame, col: str, start: TimeBound, end: TimeBound) -> DataFrame:
    """The month folders that can hold dates of the window."""
    if start is not None:
        df = df.where(F.col(col) >= month_start(_bound(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(col).cast("timestamp_ntz") < _bound(end))
    return df


def _brand_names(brands: DataFrame) -> DataFrame:
    return brands.select("brand_code", F.col("name").alias("brand_name"))


def brand_receipts_by_month(
    receipts: DataFrame,
    items: DataFrame,
    brands: DataFrame,
    start: TimeBound = None,
    end: TimeBound = None,
    k: int = 5,
    prune_items_by_date: bool = False,
) -> DataFrame:
    """Distinct receipts per (month, brand), dense-ranked per month, rank <= k.

    ``prune_items_by_date=True`` also applies the window to the items'
    ``receipt_create_date`` (tables from :func:`tillroll.plans.batch_load.load_all`).
    That is exact when receipt ids are unique, as the item date then equals
    the joined receipt's date; with duplicate ids carrying different dates,
    leave it off.

    On tables partitioned by month (``create_month``, ``receipt_month``) a
    bounded report also joins on the month, which is the same for a receipt and
    its items. So only the month folders of the window are read on both sides,
    and Spark may prune further by the receipts it finds.

    ``start``/``end`` bound the receipt creation time (start inclusive, end
    exclusive). Because the month is the window's partition key, restricting
    the months before ranking gives the same ranks as ranking every month and
    filtering afterwards, and the restriction reaches the receipts scan.

    Columns: month, brand_name, total_receipts, rank; latest month first, then
    by rank and brand name.
    """
    bounded = start is not None or end is not None  # then no date is NULL
    by_month = bounded and CREATE_MONTH in receipts.columns and RECEIPT_MONTH in items.columns
    month = [F.col(CREATE_MONTH).alias("_month")] if by_month else []
    r = _window(receipts.select(F.col("id").alias("receipt_id"), "create_date", *month), "create_date", start, end)
    if by_month:
        r = _months(r, "_month", start, end)
        items = _months(items, RECEIPT_MONTH, start, end).withColumn("_month", F.col(RECEIPT_MONTH))
    if prune_items_by_date:
        # Loaded items carry their receipt's creation time. With unique receipt
        # ids the same window on it changes nothing in the result, and it lets
        # the item scan skip row groups.
        items = _window(items, "receipt_create_date", start, end)
    pairs = (
        items.select("receipt_id", "brand_code", *(["_month"] if by_month else []))
        .where(F.col("brand_code").isNotNull())
        .join(r, ["receipt_id", "_month"] if by_month else "receipt_id")
        .select("receipt_id", "brand_code", month_start("create_date").alias("month"))
    )
    # count(DISTINCT receipt_id) de-duplicates (month, brand, receipt) with a
    # map-side partial aggregation; no separate distinct step is needed.
    counts = (
        pairs.join(_brand_names(brands), "brand_code")
        .groupBy("month", "brand_name")
        .agg(F.countDistinct("receipt_id").alias("total_receipts"))
    )
    # At most k ranks a month are left to sort.
    top = top_k_dense(counts, ["month"], "total_receipts", k)
    return top.orderBy(F.col("month").desc(), "rank", "brand_name")


def _cohort_receipts(
    receipts: DataFrame, users: DataFrame, months: int, exclude_roles: Sequence[str] | None
) -> DataFrame:
    cohort = recent_users(users, months, exclude_roles).select(F.col("id").alias("user_id"))
    return receipts.select(F.col("id").alias("receipt_id"), "user_id").join(cohort, "user_id")


def brand_spend(
    receipts: DataFrame,
    items: DataFrame,
    brands: DataFrame,
    users: DataFrame,
    months: int = 6,
    exclude_roles: Sequence[str] | None = ("staff",),
    nulls_first: bool = True,
) -> DataFrame:
    """Total cleaned spend per brand for receipts of recently created users.

    Spend per item is cleaned quantity times cleaned price, rounded to whole
    cents; totals are exact sums of cents, returned as DOUBLE. Brands are
    dense-ranked by total, largest first; a NULL total (a brand whose every
    item lacks a quantity or price) ranks first, as in Postgres.

    Columns: brand_name, total_spend, rank.
    """
    cohort_receipts = _cohort_receipts(receipts, users, months, exclude_roles)
    # Cents per brand code (map-side partial sums), then a DECIMAL(38,0) sum over the per-code rows per brand name.
    per_code = (
        items.select("receipt_id", "brand_code", cents(spend(clean_quantity(), clean_price())).alias("c"))
        .join(cohort_receipts, "receipt_id")
        .groupBy("brand_code")
        .agg(F.sum("c").alias("c"))
    )
    totals = (
        per_code.join(_brand_names(brands), "brand_code")
        .groupBy("brand_name")
        .agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("total_cents"))
    )
    # Ranked on the exact total (same value on every evaluation), returned as
    # DOUBLE currency units.
    ranked = global_dense_rank(totals, "total_cents", "rank", descending=True, nulls_first=nulls_first)
    return ranked.select(
        "brand_name", (F.col("total_cents").cast("double") / 100).alias("total_spend"), "rank"
    )


def brand_code_spend(items: DataFrame) -> DataFrame:
    """Total cleaned spend per brand code over all items, dense-ranked.

    Brand codes are many, so this ranks a key whose values don't fit one task.

    Columns: brand_code, total_spend, rank.
    """
    totals = (
        items.where(F.col("brand_code").isNotNull())
        .select("brand_code", cents(spend(clean_quantity(), clean_price())).alias("c"))
        .groupBy("brand_code")
        .agg(F.sum("c").alias("total_cents"))
    )
    ranked = global_dense_rank(totals, "total_cents")
    return ranked.select("brand_code", (F.col("total_cents").cast("double") / 100).alias("total_spend"), "rank")


def brand_transactions(
    receipts: DataFrame,
    items: DataFrame,
    brands: DataFrame,
    users: DataFrame,
    months: int = 6,
    exclude_roles: Sequence[str] | None = ("staff",),
    limit: int | None = 15,
) -> DataFrame:
    """Distinct receipts per brand for recently created users, dense-ranked.

    With ``limit`` the first ``limit`` rows by (rank, brand_name) are
    returned; without it, every brand.

    Columns: brand_name, total_transactions, rank.
    """
    cohort_receipts = _cohort_receipts(receipts, users, months, exclude_roles)
    pairs = items.select("receipt_id", "brand_code").join(cohort_receipts, "receipt_id")
    totals = (
        pairs.join(_brand_names(brands), "brand_code")
        .groupBy("brand_name")
        .agg(F.countDistinct("receipt_id").alias("total_transactions"))
    )
    if limit is None:
        return global_dense_rank(totals, "total_transactions", "rank")
    return top_n_ranked(totals, "total_transactions", limit, tie_cols=("brand_name",))


def brand_receipts_latest_month(
    receipts: DataFrame, items: DataFrame, brands: DataFrame, k: int = 5
) -> DataFrame:
    """:func:`brand_receipts_by_month` for the latest month that has receipts.

    The month is a scalar subquery (``date_trunc('month', max(create_date))``)
    rather than a fixed date, so the report follows the data.
    """
    latest = receipts.select(month_start(F.max("create_date"))).scalar()
    return brand_receipts_by_month(receipts, items, brands, start=latest, k=k)


def receipts_without_brands(receipts: DataFrame, items: DataFrame, brands: DataFrame) -> DataFrame:
    """Receipts none of whose items joins to a brand (left anti join).

    Columns: id, status, create_date.
    """
    branded = (
        items.select("receipt_id", "brand_code")
        .join(brands.select("brand_code"), "brand_code", "left_semi")
        .select("receipt_id")
        .distinct()  # a receipt once, however many branded items it has
    )
    r = receipts.select("id", "status", "create_date")
    return r.join(branded, r["id"] == branded["receipt_id"], "left_anti")
