"""Read extended-JSON documents and flatten them into the four receipt tables.

``read_documents`` reads files of documents (one JSON array per file, or one
document per line) with a declared schema. ``parse_documents`` does the same
for a column of JSON text (a table or a stream of messages). The ``load_*``
functions turn parsed documents into tables:

* receipts -- one row per document; ids and dates unwrapped, dates as
  TIMESTAMP_NTZ, the item list dropped;
* items    -- one row per element of ``rewardsReceiptItemList``, carrying the
  receipt id and the 1-based position; documents without an id (NULL or
  empty) or without a list are skipped; price text becomes DOUBLE;
* users    -- one row per document, dates unwrapped;
* brands   -- one row per document, reference unwrapped into ``cpg_ref`` and
  ``cpg_id``, barcode parsed leniently to BIGINT with the text kept.

Everything is a column expression or ``posexplode``; nothing leaves the
executors. Here a JSON-array file is read by one task; JSON lines split by block.
:mod:`tillroll.sources.arrays` reads array files in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, StringType, StructField, StructType

from tillroll.functions.casts import lenient_bigint, lenient_double
from tillroll.functions.dates import epoch_millis_to_ts
from tillroll.sources import schemas as S

CORRUPT = "_corrupt_record"
_MODES = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None,
    multiline: bool = True,
    on_missing: str = "error",
    on_corrupt: str = "fail",
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Read JSON documents with a declared schema.

    ``schema=None`` infers the schema from the data instead (an extra pass
    over ``sampling_ratio`` of the input; for exploration). The loaders accept
    either: a field missing from an inferred schema loads as NULL.

    ``multiline=True`` reads files holding one JSON array (or one document)
    each; ``False`` reads one document per line. ``on_missing="empty"``
    returns an empty table with the schema when the path does not exist.
    ``on_corrupt``: ``"fail"`` raises on malformed input, ``"drop"`` skips
    malformed records, ``"keep"`` keeps them with the raw text in
    ``_corrupt_record`` (all other columns NULL).
    """
    if on_corrupt not in _MODES:
        raise ValueError(f"on_corrupt must be one of {sorted(_MODES)}")
    read_schema = schema
    if schema is not None and on_corrupt == "keep":
        read_schema = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    reader = spark.read.schema(read_schema) if read_schema is not None else spark.read.option(
        "samplingRatio", sampling_ratio
    )
    reader = (
        reader.option("multiLine", multiline)
        .option("mode", _MODES[on_corrupt])
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if on_missing == "empty":
        # Only the absent paths drop out; the others are read as usual.
        paths = [path] if isinstance(path, str) else list(path)
        path = [p for p in paths if path_exists(spark, p)]
        if not path:
            return spark.createDataFrame([], read_schema if read_schema is not None else StructType([]))
    return reader.json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a glob of paths, names anything; other failures rise."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return found is not None and len(found) > 0


def parse_documents(
    text: DataFrame, schema: StructType, column: str = "value", on_corrupt: str = "fail"
) -> DataFrame:
    """Parse a column of JSON documents (one per row) into top-level columns.

    ``on_corrupt`` as in :func:`read_documents`: malformed text raises, drops
    out, or stays with the raw text in ``_corrupt_record``.
    """
    if on_corrupt not in _MODES:
        raise ValueError(f"on_corrupt must be one of {sorted(_MODES)}")
    if on_corrupt == "fail":
        parsed = F.from_json(F.col(column), schema, {"mode": "FAILFAST"})
        return text.select(parsed.alias("_doc")).select("_doc.*")
    marked = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    parsed = F.from_json(F.col(column), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    docs = text.select(parsed.alias("_doc")).select("_doc.*")
    return docs if on_corrupt == "keep" else docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_counts(text: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """How many documents there are, and how many of them are malformed: documents, corrupt."""
    docs = parse_documents(text, schema, column, on_corrupt="keep")
    return docs.agg(F.count(F.lit(1)).alias("documents"), F.count(CORRUPT).alias("corrupt"))


def _has(schema: StructType, path: str) -> bool:
    t = schema
    for part in path.split("."):
        if not isinstance(t, StructType) or part not in t.fieldNames():
            return False
        t = t[part].dataType
    return True


def _field(schema: StructType, path: str, dtype: DataType) -> Column:
    """``path`` cast to ``dtype``, or a typed NULL when the documents lack it.

    With declared schemas every field exists; with an inferred schema a
    field that never occurs in the data is absent and loads as NULL.
    ``schema`` is the documents' schema, fetched once by the caller (each
    ``DataFrame.schema`` call is a round trip to the JVM).
    """
    # Casting by type name is one JVM call; a DataType object is serialised
    # through the JVM first.
    if _has(schema, path):
        return F.col(path).cast(dtype.simpleString())
    return F.lit(None).cast(dtype.simpleString())


def _date(schema: StructType, field: str) -> Column:
    return epoch_millis_to_ts(_field(schema, f"{field}.$date", LongType())).alias(S.snake_case(field))


def load_receipts(docs: DataFrame, drop_missing_id: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Receipt documents to the receipts table (14 columns).

    Here and in the other loaders, ``carry`` names further columns of ``docs``
    that every row keeps.
    """
    sch = docs.schema
    oid = _field(sch, "_id.$oid", StringType())
    if drop_missing_id:
        docs = docs.where(oid.isNotNull() & (oid != ""))
    text, long = StringType(), LongType()
    return docs.select(
        oid.alias("id"),
        _field(sch, "userId", text).alias("user_id"),
        _field(sch, "rewardsReceiptStatus", text).alias("status"),
        *[_date(sch, f) for f in S.RECEIPT_DATE_FIELDS],
        _field(sch, "bonusPointsEarned", long).alias("bonus_points_earned"),
        _field(sch, "bonusPointsEarnedReason", text).alias("bonus_points_earned_reason"),
        _field(sch, "pointsEarned", text).alias("points_earned"),
        _field(sch, "purchasedItemCount", long).alias("purchased_item_count"),
        _field(sch, "totalSpent", text).alias("total_spent"),
        *carry,
    )


def load_items(
    docs: DataFrame, strip_dollar: bool = True, receipt_date: bool = True, carry: Sequence[str] = ()
) -> DataFrame:
    """Receipt documents to the items table (one row per listed item).

    ``strip_dollar`` removes a leading ``$`` from price text before the
    lenient DOUBLE parse; ``False`` parses the text as is (``'$1.50'`` gives
    NULL). With ``receipt_date`` each item also carries its receipt's
    creation time as ``receipt_create_date`` (read from the same document, no
    join), so date windows can be applied to the item scan itself.
    """
    sch = docs.schema
    rid = _field(sch, "_id.$oid", StringType())
    if not _has(sch, "rewardsReceiptItemList"):
        docs = docs.withColumn("rewardsReceiptItemList", F.lit(None).cast(ArrayType(S.ITEM)))
    # The id test sits inside the generator rather than in a filter: a filter
    # would be pushed below a ``from_json`` projection and re-parse each
    # document once per reference to the id.
    items_of_valid = F.when(rid.isNotNull() & (rid != ""), F.col("rewardsReceiptItemList"))
    exploded = docs.select(
        rid.alias("receipt_id"),
        _date(sch, "createDate").alias("_receipt_date"),
        *carry,
        F.posexplode(items_of_valid).alias("_pos", "_item"),
    )
    numeric = set(S.ITEM_NUMERIC_TEXT_FIELDS)
    item_sch = exploded.schema
    cols = [
        lenient_double(_field(item_sch, f"_item.{f.name}", StringType()), strip_dollar).alias(S.snake_case(f.name))
        if f.name in numeric
        else _field(item_sch, f"_item.{f.name}", f.dataType).alias(S.snake_case(f.name))
        for f in S.ITEM.fields
    ]
    extra = [F.col("_receipt_date").alias("receipt_create_date")] if receipt_date else []
    return exploded.select("receipt_id", (F.col("_pos") + 1).alias("line_no"), *cols, *extra, *carry)


def load_users(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """User documents to the users table (7 columns)."""
    sch = docs.schema
    text = StringType()
    return docs.select(
        _field(sch, "_id.$oid", text).alias("id"),
        _field(sch, "active", BooleanType()).alias("active"),
        *[_date(sch, f) for f in S.USER_DATE_FIELDS],
        _field(sch, "role", text).alias("role"),
        _field(sch, "signUpSource", text).alias("sign_up_source"),
        _field(sch, "state", text).alias("state"),
        *carry,
    )


def load_brands(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Brand documents to the brands table.

    ``barcode`` is the lenient BIGINT of the text (leading zeros and letters
    do not survive a number); ``barcode_text`` keeps the text.
    """
    sch = docs.schema
    text = StringType()
    barcode = _field(sch, "barcode", text)
    return docs.select(
        _field(sch, "_id.$oid", text).alias("id"),
        lenient_bigint(barcode).alias("barcode"),
        barcode.alias("barcode_text"),
        _field(sch, "category", text).alias("category"),
        _field(sch, "categoryCode", text).alias("category_code"),
        _field(sch, "name", text).alias("name"),
        _field(sch, "topBrand", BooleanType()).alias("top_brand"),
        _field(sch, "brandCode", text).alias("brand_code"),
        _field(sch, "cpg.$ref", text).alias("cpg_ref"),
        _field(sch, "cpg.$id.$oid", text).alias("cpg_id"),
        *carry,
    )


def explode_outer_items(docs: DataFrame) -> DataFrame:
    """Exploration view: one row per item, and one row with NULL item for a
    receipt whose list is missing or empty."""
    return docs.select(F.col("_id.$oid").alias("receipt_id"), F.explode_outer("rewardsReceiptItemList").alias("item"))


def drop_null_elements(docs: DataFrame, array_col: str = "rewardsReceiptItemList") -> DataFrame:
    """Remove NULL elements from an array column (struct fields stay NULL)."""
    return docs.withColumn(array_col, F.array_compact(array_col))


def _has_array(dtype: DataType) -> bool:
    return isinstance(dtype, ArrayType) or isinstance(dtype, StructType) and any(_has_array(f.dataType) for f in dtype.fields)


def _without_nulls(c: Column, dtype: DataType) -> Column:
    if isinstance(dtype, ArrayType):
        compact = F.array_compact(c)
        return F.transform(compact, lambda e: _without_nulls(e, dtype.elementType)) if _has_array(dtype.elementType) else compact
    if isinstance(dtype, StructType) and _has_array(dtype):
        fields = [_without_nulls(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def drop_nulls(docs: DataFrame) -> DataFrame:
    """Remove NULL elements from arrays at every depth; a NULL struct or array
    stays NULL, an array of NULLs alone becomes empty."""
    return docs.select(*[_without_nulls(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in docs.schema.fields])
