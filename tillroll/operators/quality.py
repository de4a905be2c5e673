"""Data-quality rules: text standardisation, value maps and rule flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.cleaning import (
    both_present_and_different,
    clean_price,
    clean_quantity,
    is_blank_description,
    spend,
)


def clean_items(items: DataFrame) -> DataFrame:
    """Items with ``clean_item_count``, ``clean_price`` and ``spend`` added.

    Quantity falls back to the user-flagged quantity, price to the user-flagged
    price text (parsed leniently); spend is their product (NULL if either is).
    """
    return items.select(
        "*",
        clean_quantity().alias("clean_item_count"),
        clean_price().alias("clean_price"),
        spend(clean_quantity(), clean_price()).alias("spend"),
    )


def standardize_text(c: str | Column) -> Column:
    """Trim, collapse inner whitespace to one space, upper-case; blank -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    squeezed = F.upper(F.trim(F.regexp_replace(col, r"\s+", " ")))
    return F.when(squeezed != "", squeezed)


def apply_value_map(df: DataFrame, col: str, mapping: Mapping[str, str | None], out_col: str | None = None) -> DataFrame:
    """Replace known-equal values of ``col`` through a lookup table.

    The lookup is built from ``mapping`` (its size is known when the plan is
    built), so it is broadcast; values without an entry are kept.
    """
    spark = df.sparkSession
    lookup = spark.createDataFrame(list(mapping.items()), "_from string, _to string")
    out = out_col or col
    joined = df.join(F.broadcast(lookup), df[col] == F.col("_from"), "left")
    mapped = F.when(F.col("_from").isNotNull(), F.col("_to")).otherwise(df[col])
    return joined.withColumn(out, mapped).drop("_from", "_to")


def item_flags(items: DataFrame) -> DataFrame:
    """Per-item rule flags (known-bad or incomplete values)."""
    return items.select(
        "*",
        is_blank_description("description").alias("flag_blank_description"),
        both_present_and_different("quantity_purchased", "user_flagged_quantity").alias("flag_quantity_mismatch"),
        (F.col("quantity_purchased").isNull() & F.col("user_flagged_quantity").isNull()).alias("flag_no_quantity"),
        clean_price().isNull().alias("flag_no_price"),
        F.col("brand_code").isNull().alias("flag_no_brand"),
    )


FLAGS = ("flag_blank_description", "flag_quantity_mismatch", "flag_no_quantity", "flag_no_price", "flag_no_brand")


def flag_counts(items: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """How many items raise each flag, plus the item count (one row)."""
    flagged = item_flags(items)
    return flagged.agg(
        F.count(F.lit(1)).alias("items"),
        *[F.count_if(F.col(f)).alias(f.removeprefix("flag_")) for f in flags],
    )
