"""Item totals per receipt status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.cleaning import clean_quantity
from tillroll.functions.dates import month_start

# The statuses compared by the status reports.
FINISHED_AND_REJECTED = ("FINISHED", "REJECTED")


def item_totals_by_status(
    receipts: DataFrame,
    items: DataFrame,
    statuses: Sequence[str] | None = FINISHED_AND_REJECTED,
    total_name: str = "total_items",
    share_name: str | None = None,
) -> DataFrame:
    """Sum of cleaned item quantities per receipt status.

    Items are first summed per receipt (map-side partial aggregation), so the
    join with receipts sees one row per receipt rather than one per item.
    With ``share_name`` each status's share of the listed statuses' total is
    added (window over one row per status).

    Columns: status, ``total_name`` [, ``share_name``].
    """
    r = receipts.select(F.col("id").alias("receipt_id"), "status")
    if statuses is not None:
        r = r.where(F.col("status").isin(*statuses))
    per_receipt = (
        items.select("receipt_id", clean_quantity().alias("q"))
        .groupBy("receipt_id")
        .agg(F.sum("q").alias("q"))
    )
    out = per_receipt.join(r, "receipt_id").groupBy("status").agg(F.sum("q").alias(total_name))
    if share_name:
        grand = F.sum(total_name).over(Window.partitionBy())
        out = out.withColumn(share_name, F.try_divide(F.col(total_name).cast("double"), grand))
    return out


def quantity_with_receipt_fallback(receipts: DataFrame, items: DataFrame) -> DataFrame:
    """Items per receipt with a three-way fallback.

    Per receipt: the sum of cleaned item quantities (purchased, else
    user-flagged); when a receipt has no item quantity at all, its
    ``purchased_item_count``. The receipt-level count is used once per
    receipt, never multiplied by the number of item rows.

    Columns: receipt_id, status, item_quantity, purchased_item_count, items_total.
    """
    per_receipt = (
        items.select("receipt_id", clean_quantity().alias("q"))
        .groupBy("receipt_id")
        .agg(F.sum("q").alias("item_quantity"))
    )
    r = receipts.select(F.col("id").alias("receipt_id"), "status", "purchased_item_count")
    return r.join(per_receipt, "receipt_id", "left").select(
        "receipt_id",
        "status",
        "item_quantity",
        "purchased_item_count",
        F.coalesce("item_quantity", "purchased_item_count").alias("items_total"),
    )


def status_totals_by_month(
    receipts: DataFrame, items: DataFrame, statuses: Sequence[str] | None = FINISHED_AND_REJECTED
) -> DataFrame:
    """Cleaned item quantities per (month, status) with ROLLUP subtotals.

    Rows with a NULL status are month totals; the row with NULL month and
    status is the grand total.

    Columns: month, status, total_items.
    """
    r = receipts.select(F.col("id").alias("receipt_id"), "status", month_start("create_date").alias("month"))
    if statuses is not None:
        r = r.where(F.col("status").isin(*statuses))
    per_receipt = (
        items.select("receipt_id", clean_quantity().alias("q"))
        .groupBy("receipt_id")
        .agg(F.sum("q").alias("q"))
    )
    # Summed per (month, status) first: the rollup triples that handful of rows,
    # not the row of each receipt.
    totals = per_receipt.join(r, "receipt_id").groupBy("month", "status").agg(F.sum("q").alias("q"))
    return totals.rollup("month", "status").agg(F.sum("q").alias("total_items"))


def item_totals_with_fallback(
    receipts: DataFrame, items: DataFrame, statuses: Sequence[str] | None = FINISHED_AND_REJECTED
) -> DataFrame:
    """Items per status using :func:`quantity_with_receipt_fallback`.

    Columns: status, total_items.
    """
    per_receipt = quantity_with_receipt_fallback(receipts, items)
    if statuses is not None:
        per_receipt = per_receipt.where(F.col("status").isin(*statuses))
    return per_receipt.groupBy("status").agg(F.sum("items_total").alias("total_items"))


def status_totals_by_item_attribute(
    receipts: DataFrame,
    items: DataFrame,
    attribute: str = "rewards_group",
    statuses: Sequence[str] | None = FINISHED_AND_REJECTED,
) -> DataFrame:
    """Cleaned item quantities per (item attribute, status), by default per rewards group.

    Items without the attribute form a group of their own (NULL).

    Columns: ``attribute``, status, total_items.
    """
    r = receipts.select(F.col("id").alias("receipt_id"), "status")
    if statuses is not None:
        r = r.where(F.col("status").isin(*statuses))
    rows = items.select("receipt_id", attribute, clean_quantity().alias("q"))
    return rows.join(r, "receipt_id").groupBy(attribute, "status").agg(F.sum("q").alias("total_items"))


def status_totals_by_brand_attribute(
    receipts: DataFrame,
    items: DataFrame,
    brands: DataFrame,
    attribute: str = "category",
    statuses: Sequence[str] | None = FINISHED_AND_REJECTED,
) -> DataFrame:
    """Cleaned item quantities per (brand attribute, status).

    The (attribute, status) groups are few, so the final aggregation combines
    each task's rows to a handful before its shuffle; pre-summing items per
    (receipt, brand code) would add a shuffle of nearly every item row for no
    reduction. Items without a brand code, or whose code has no brand, are
    left out (inner join, as in SQL).

    Columns: ``attribute``, status, total_items.
    """
    r = receipts.select(F.col("id").alias("receipt_id"), "status")
    if statuses is not None:
        r = r.where(F.col("status").isin(*statuses))
    per_pair = items.select("receipt_id", "brand_code", clean_quantity().alias("q"))
    b = brands.select("brand_code", attribute)
    return (
        per_pair.join(r, "receipt_id")
        .join(b, "brand_code")
        .groupBy(attribute, "status")
        .agg(F.sum("q").alias("total_items"))
    )
