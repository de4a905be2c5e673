"""Render receipt tables back into extended-JSON documents.

This is the inverse of :mod:`tillroll.sources.documents`: it writes the
document shape the loaders read (``{"$oid": ..}`` ids, ``{"$date": ms}``
dates, prices as text, items nested in ``rewardsReceiptItemList``). Loading
the rendered documents must give back the table, which is how the loaders are
checked on the full driver tables.

A document field is rendered from the column of its snake_case name; columns
that a table lacks and NULL values are left out of the JSON. A receipt's items
stand in one list in its document, as in the source.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillroll.functions.dates import ts_to_epoch_millis
from tillroll.sources import schemas as S

CPG_REF = "category"
#: Level of gzip texts: half the time of the default, a third more bytes.
GZIP_LEVEL = "THREE"


def _oid(c: Column) -> Column:
    return F.struct(c.cast("string").alias("$oid"))


def _date(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(ts_to_epoch_millis(c).alias("$date")))


def _value(c: Column, field: StructField) -> Column:
    return _date(c) if field.dataType == S.DATE else c.cast(field.dataType.simpleString())


def _fields(table: DataFrame, schema: StructType) -> list[Column]:
    """The document fields that ``table`` has a column for."""
    named = [(S.snake_case(f.name), f) for f in schema.fields]
    return [_value(F.col(name), f).alias(f.name) for name, f in named if f.name != "_id" and name in table.columns]


#: Columns that an item always has; their order is that of a receipt's items.
ITEM_COLUMNS = (
    "line_no",
    "brand_code",
    "description",
    "final_price",
    "quantity_purchased",
    "user_flagged_quantity",
    "user_flagged_price",
    "original_meta_brite_item_price",
)


def item_struct(item: Column | Mapping[str, Column], columns: Sequence[str], dollar_prices: bool = True) -> Column:
    """One item document (source field names) from a struct, or a mapping, of items-table ``columns``."""
    named = [(S.snake_case(f.name), f) for f in S.ITEM.fields]
    final_price = item["final_price"].cast("string")
    return F.struct(
        *[_value(item[name], f).alias(f.name) for name, f in named if name in columns and name not in ("final_price", "item_number")],
        (F.concat(F.lit("$"), final_price) if dollar_prices else final_price).alias("finalPrice"),
        item["line_no"].cast("string").alias("itemNumber"),
    )


def item_lists(items: DataFrame, dollar_prices: bool = True, more: Mapping[str, str] | None = None, dealt: bool = False) -> DataFrame:
    """(receipt_id, item_list): the items of each receipt, in one list.

    Items stand by line number and, where line numbers repeat, by their other
    fields, so the order is total up to equal items. A document holds all of
    its receipt, as a source record does; the source format bounds its size.

    Only the table's columns are dealt by receipt; the documents' fields are made
    behind that. ``more`` adds columns by SQL rules over an item named ``line``.
    With ``dealt`` a receipt's items are in one task already.
    """
    named = [(S.snake_case(f.name), f) for f in S.ITEM.fields]
    others = [(name, f) for name, f in named if name in items.columns and name not in (*ITEM_COLUMNS, "item_number")]
    columns = [*ITEM_COLUMNS, *[name for name, _ in others]]
    entry = F.struct(*ITEM_COLUMNS, *[_value(F.col(name), f).alias(name) for name, f in others])
    # Nothing combines before the shuffle, where a partial aggregation would only sort.
    lines = items.select("receipt_id", entry.alias("line"))
    lines = lines if dealt else lines.repartition("receipt_id")
    if not more:
        lists = lines.groupBy("receipt_id").agg(F.array_sort(F.collect_list("line")).alias("l"))
        return lists.select("receipt_id", F.transform("l", lambda e: item_struct(e, columns, dollar_prices)).alias("item_list"))
    # Behind the shuffle, but row by row: that is compiled, rules over an array's elements are not.
    rows = lines.selectExpr("receipt_id", "line", *[f"{rule} as {c}" for c, rule in more.items()])
    fields = {c: F.col("line")[c] for c in columns} | {c: F.col(c) for c in more}
    item = item_struct(fields, list(fields), dollar_prices).alias("item")
    lists = rows.select("receipt_id", F.struct("line", item).alias("e")).groupBy("receipt_id").agg(F.array_sort(F.collect_list("e")).alias("l"))
    return lists.select("receipt_id", F.transform("l", lambda e: e["item"]).alias("item_list"))


def receipt_documents(
    receipts: DataFrame,
    items: DataFrame | None = None,
    dollar_prices: bool = True,
    document_id: Column | None = None,
    item_fields: Mapping[str, str] | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Receipt documents as JSON text (column ``value``).

    Without ``items`` there is one document per receipt and no item list.
    With ``items`` it holds the receipt's items in one list; a receipt without
    items has none. ``document_id`` stands in for the receipt's id in the text;
    ``item_fields`` adds to the items, and ``dealt`` tells how they come, see
    :func:`item_lists`.
    """
    columns = _fields(receipts, S.RECEIPT)
    oid = _oid(F.col("id") if document_id is None else document_id).alias("_id")
    if items is not None:
        lists = item_lists(items, dollar_prices, item_fields, dealt)
        receipts = receipts.join(lists, receipts["id"] == lists["receipt_id"], "left")
        columns.append(F.col("item_list").alias("rewardsReceiptItemList"))
    return receipts.select(F.to_json(F.struct(oid, *columns)).alias("value"))


def user_documents(users: DataFrame) -> DataFrame:
    doc = F.struct(_oid(F.col("id")).alias("_id"), *_fields(users, S.USER))
    return users.select(F.to_json(doc).alias("value"))


def brand_documents(brands: DataFrame, barcode_width: int = 12) -> DataFrame:
    """Brand documents; without a ``barcode`` column the barcode is the numeric
    part of the brand code, zero-padded to ``barcode_width`` digits."""
    if "barcode" not in brands.columns:
        digits = F.regexp_extract(F.col("brand_code"), r"([0-9]+)$", 1)
        brands = brands.withColumn("barcode", F.lpad(digits, barcode_width, "0"))
    doc = F.struct(
        _oid(F.col("brand_code")).alias("_id"),
        *_fields(brands, S.BRAND),
        F.struct(F.lit(CPG_REF).alias("$ref"), _oid(F.col("category")).alias("$id")).alias("cpg"),
    )
    return brands.select(F.to_json(doc).alias("value"))


def write_arrays(docs: DataFrame, folder: str, most: int, compression: str = "none") -> None:
    """Write documents (column ``value``) as files of one JSON array each, of at
    most ``most`` documents. Each task writes its own, so the number of files
    follows the documents and nothing is shuffled."""

    def lines(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for part in parts:
            # The writer begins a file after each ``most`` lines.
            at = np.arange(n, n + part.num_rows) % most
            opens = pa.array(["[", ","]).take(pa.array((at > 0).astype(np.int8)))
            closes = pa.array(["]", ""]).take(pa.array((at < most - 1).astype(np.int8)))
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(opens, part.column(0).cast(pa.string()), closes, "")], ["value"])
            n += part.num_rows
        if n % most or n == 0:
            yield pa.RecordBatch.from_arrays([pa.array(["]" if n else "[]"])], ["value"])

    writer = docs.select("value").mapInArrow(lines, "value string").write.option("maxRecordsPerFile", most)
    writer.options(**{"compression": compression, "zlib.compress.level": GZIP_LEVEL}).text(folder)
