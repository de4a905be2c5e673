"""Distinct counts that add up: stored day by day, reported for any period.

``count(DISTINCT receipt)`` can't be summed over days or brands. What can be
merged is a *set*, so a store keeps one for each day and brand, in two forms:

* an exact bitmap of receipt numbers (``bitmap_construct_agg``), merged with
  ``bitmap_or_agg``. Receipts are numbered 1, 2, 3, ... in order of creation, so
  the receipts of a day stand in few 32,768-bit pieces, and a piece of a busy
  day is well filled;
* an HLL sketch of receipt ids (``hll_sketch_agg``), merged with
  ``hll_union_agg``: a few kilobytes whatever the count, within about
  ``3 * relative_error(lg_k)`` of it.

:func:`add_receipts` takes in the receipts that have arrived since; a receipt
that comes again has its number already and changes no set. Reports read the
stored sets alone, not the items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import day_start, month_start, ts_literal
from tillroll.operators.rank import number_in_order
from tillroll.sources.snapshots import Snapshots

NUMBERS, BITMAPS, SKETCHES = "receipt_numbers", "brand_day_bitmaps", "brand_day_sketches"
LG_K = 12


def relative_error(lg_k: int = LG_K) -> float:
    """The standard error of an HLL estimate with 2 ** lg_k registers."""
    return 1.04 / 2 ** (lg_k / 2)


def add_receipts(
    store: Snapshots,
    receipts: DataFrame,
    items: DataFrame,
    brands: DataFrame,
    source: str | None = None,
    batch: int | None = None,
    lg_k: int = LG_K,
) -> None:
    """Add ``receipts`` (id, create_date) with their items to the stored sets, in
    one commit. With ``source`` and ``batch`` a batch that is stored is passed over."""
    change = store.change()
    if source is not None and batch is not None and batch <= change.done(source):
        return
    day = receipts.select("id", "create_date").where("id is not null and create_date is not null").groupBy("id").agg(F.min("create_date").alias("create_date"))
    known = store.read(NUMBERS) if NUMBERS in store.tables() else None
    if known is None:
        new, used = day, 0
    else:
        new = day.join(known, "id", "left_anti")
        used = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    fresh = number_in_order(new, ["create_date", "id"]).select("id", (F.col("number") + used).alias("number"))
    change.append(NUMBERS, fresh)
    # From here on the numbers are read back: a set must hold what is stored.
    numbers = store.spark.read.schema(fresh.schema).parquet(f"{store.root}/{NUMBERS}/v={change.name}")
    if known is not None:
        numbers = numbers.unionByName(known.select("id", "number"))
    numbered = day.join(numbers, "id").select("id", "number", day_start("create_date").alias("day"))
    names = brands.select("brand_code", F.col("name").alias("brand_name"))
    sold = (
        items.select(F.col("receipt_id").alias("id"), "brand_code").where("brand_code is not null")
        .join(numbered, "id")
        .join(names, "brand_code")
    )
    bits = sold.groupBy("day", "brand_name", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )
    sketches = sold.groupBy("day", "brand_name").agg(F.hll_sketch_agg(F.col("id").cast("string"), F.lit(lg_k)).alias("sketch"))
    change.append(BITMAPS, bits)
    change.append(SKETCHES, sketches)
    change.commit(source, batch)


def _period(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("day") >= ts_literal(start))
    return df if end is None else df.where(F.col("day") < ts_literal(end))


def receipts_by_brand(store: Snapshots, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct receipts by month and brand from the stored bitmaps: month, brand_name, total_receipts."""
    pieces = _period(store.read(BITMAPS), start, end).groupBy(month_start("day").alias("month"), "brand_name", "bucket")
    merged = pieces.agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy("month", "brand_name").agg(F.sum("n").alias("total_receipts"))


def estimated_receipts_by_brand(store: Snapshots, start: str | None = None, end: str | None = None) -> DataFrame:
    """The same from the stored sketches: month, brand_name, estimate."""
    days = _period(store.read(SKETCHES), start, end).groupBy(month_start("day").alias("month"), "brand_name")
    return days.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def branded_receipts(store: Snapshots, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct receipts with a branded item on the days from ``start`` to before
    ``end``, over all brands, exactly and estimated: total_with_brand, estimate."""
    pieces = _period(store.read(BITMAPS), start, end).groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    exact = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_with_brand"))
    sketch = _period(store.read(SKETCHES), start, end).agg(F.hll_union_agg("sketch").alias("s"))
    one = F.lit(None).cast("long")
    estimate = sketch.select(one.alias("total_with_brand"), F.hll_sketch_estimate("s").alias("estimate"))
    # Two rows become one.
    both = exact.select("total_with_brand", one.alias("estimate")).unionAll(estimate)
    return both.agg(F.max("total_with_brand").alias("total_with_brand"), F.coalesce(F.max("estimate"), F.lit(0)).alias("estimate"))
