"""Named analytics queries over one data directory.

Every entry is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables of
``sf_dir`` through the receipt views of :mod:`tillroll.sources.tables`. The
fixed parameters (month windows, cohort length, statuses, limits) are listed
once below. The test data's receipts run from 1995 to 2001, so the reference's
February-2021 windows become February 1998 here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.operators import audit, rollups
from tillroll.operators.brands import (
    brand_code_spend,
    brand_receipts_by_month,
    brand_receipts_latest_month,
    brand_spend,
    brand_transactions,
    receipts_without_brands,
)
from tillroll.operators.clusters import value_clusters
from tillroll.operators.cohort import recent_users
from tillroll.operators.quality import apply_value_map, clean_items, flag_counts, standardize_text
from tillroll.operators.status import (
    FINISHED_AND_REJECTED,
    item_totals_by_status,
    item_totals_with_fallback,
    status_totals_by_brand_attribute,
    status_totals_by_item_attribute,
    status_totals_by_month,
)
from tillroll.operators.upsert import latest_per_key
from tillroll.plans import incremental
from tillroll.plans.batch_load import load_table
from tillroll.sources import drift, schemas
from tillroll.sources.arrays import read_arrays
from tillroll.sources.documents import (
    corrupt_counts,
    drop_nulls,
    explode_outer_items,
    load_brands,
    load_items,
    load_receipts,
    load_users,
    parse_documents,
    read_documents,
)
from tillroll.sources.roundtrip import brand_documents, receipt_documents, user_documents, write_arrays
from tillroll.sources.sinks import freed_shuffles, remove_path, stage
from tillroll.sources.snapshots import Snapshots
from tillroll.sources.tables import (
    BRAND_FIELDS,
    ITEM_FIELDS_OF_LINE,
    ITEM_FIELDS_WRITTEN,
    RECEIPT_FIELDS,
    STAFF_ROLE,
    TABLE_SCHEMAS,
    USER_FIELDS,
    Tables,
    with_fields,
)
from tillroll.streaming.upsert import read_latest, scratch_target, start_upsert_stream

# Fixed parameters of the registered queries.
TOP_MONTH = ("1998-02-01", "1998-03-01")  # Q1: one month, end exclusive
TOP_MONTHS = ("1998-01-01", "1998-03-01")  # Q2: two months, end exclusive
AUDIT_WINDOW = ("1998-02-01", "1998-03-01")  # D6, R2: BETWEEN, both ends inclusive
DRIFT_YEARS = (1996, 1999)  # S3: where the second and third batch of users begin
STORED_UNTIL = ("1997-06-15", "1999-01-01")  # A3: where the batches of stored counts begin
TOP_K = 5
COHORT_MONTHS = 6
EXCLUDED_ROLES = (STAFF_ROLE,)
TRANSACTIONS_LIMIT = 15

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables.from_dir(spark, sf_dir)


# --- brand rankings ---------------------------------------------------------


def top_brands_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return brand_receipts_by_month(t.receipts, t.items, t.brands, *TOP_MONTH, k=TOP_K)


def top_brands_month_over_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return brand_receipts_by_month(t.receipts, t.items, t.brands, *TOP_MONTHS, k=TOP_K)


def brand_spend_recent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return brand_spend(t.receipts, t.items, t.brands, t.users, COHORT_MONTHS, EXCLUDED_ROLES)


def brand_transactions_recent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return brand_transactions(
        t.receipts, t.items, t.brands, t.users, COHORT_MONTHS, EXCLUDED_ROLES, limit=TRANSACTIONS_LIMIT
    )


def brand_spend_all_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report variant without the role filter."""
    t = _t(spark, sf_dir)
    return brand_spend(t.receipts, t.items, t.brands, t.users, COHORT_MONTHS, None)


def brand_transactions_all_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report variant without the role filter and without the row limit."""
    t = _t(spark, sf_dir)
    return brand_transactions(t.receipts, t.items, t.brands, t.users, COHORT_MONTHS, None, limit=None)


# --- status reports ---------------------------------------------------------


def item_totals_by_status_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return item_totals_by_status(t.receipts, t.items, FINISHED_AND_REJECTED)


def item_share_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return item_totals_by_status(t.receipts, t.items, FINISHED_AND_REJECTED, share_name="share")


def receipt_totals_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.totals_by(
        t.receipts, "status", "purchased_item_count", FINISHED_AND_REJECTED, total_name="total_items"
    )


def receipt_share_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.totals_by(
        t.receipts, "status", "purchased_item_count", FINISHED_AND_REJECTED, total_name="total_items", share_name="share"
    )


def item_rows_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.rows_by_parent_key(
        t.receipts, t.items, "id", "receipt_id", "status", FINISHED_AND_REJECTED, name="total_items"
    )


# --- time audits --------------------------------------------------------------


def receipts_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.counts_by_bucket(t.receipts, "create_date", "month", "id", count_name="total_receipts")


def last_day_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.counts_by_bucket(
        t.events, "ts", "hour", "event_id", count_name="total_events", latest_day_only=True
    )


def user_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.range_by_month(_t(spark, sf_dir).users, "created_date")


def recent_users_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_users(_t(spark, sf_dir).users, COHORT_MONTHS)


# --- item cleaning and consistency -------------------------------------------


def clean_items_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_items(_t(spark, sf_dir).items).select("receipt_id", "brand_code", "clean_item_count", "clean_price")


def quantity_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _t(spark, sf_dir).items
    return audit.mismatch_count(items, "quantity_purchased", "user_flagged_quantity")


def distinct_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_values(_t(spark, sf_dir).receipts, "status")


def missing_item_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.rows_with_null_parent_value(
        t.receipts,
        t.items,
        "id",
        "receipt_id",
        "purchased_item_count",
        ["status", "purchased_item_count", "quantity_purchased"],
    )


def blank_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.blank_count(_t(spark, sf_dir).items, "description", name="blank_descriptions")


def brand_code_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.presence(_t(spark, sf_dir).items, "brand_code")


def metabrite_price_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _t(spark, sf_dir).items
    return items.where(F.col("original_meta_brite_item_price").isNotNull())


# --- coverage -----------------------------------------------------------------


def brand_code_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.coverage(
        t.receipts,
        t.items,
        "id",
        "receipt_id",
        right_filter=F.col("brand_code").isNotNull(),
        ts_col="create_date",
        start=AUDIT_WINDOW[0],
        end=AUDIT_WINDOW[1],
        inclusive_end=True,
        names=("total_receipts", "total_with_brand", "percentage"),
    )


def receipts_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.distinct_count_pair(
        t.receipts, "id", t.items, "receipt_id", names=("total_receipts", "total_with_items", "percentage")
    )


def items_saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.coverage(t.receipts, t.items, "id", "receipt_id").select(
        F.col("share").alias("rewards_items_saturation")
    )


def items_saturation_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return audit.coverage(
        t.receipts,
        t.items,
        "id",
        "receipt_id",
        ts_col="create_date",
        start=AUDIT_WINDOW[0],
        end=AUDIT_WINDOW[1],
        inclusive_end=True,
    ).select(F.col("share").alias("rewards_items_saturation"))


# --- document loading (documents rendered from the tables, parsed back) ------


def _receipt_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipt documents with every field and the receipt's items."""
    t = _t(spark, sf_dir)
    receipts = with_fields(t.by_receipt("receipts"), RECEIPT_FIELDS)
    return receipt_documents(receipts, t.by_receipt("items"), item_fields=ITEM_FIELDS_OF_LINE, dealt=True)


def load_receipts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return load_receipts(parse_documents(receipt_documents(with_fields(t.receipts, RECEIPT_FIELDS)), schemas.RECEIPT))


def load_items_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_items(parse_documents(_receipt_source(spark, sf_dir), schemas.RECEIPT))


def load_users_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = user_documents(with_fields(_t(spark, sf_dir).users, USER_FIELDS))
    return load_users(parse_documents(docs, schemas.USER))


def load_brands_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = brand_documents(with_fields(_t(spark, sf_dir).brands, BRAND_FIELDS))
    return load_brands(parse_documents(docs, schemas.BRAND))


#: Documents of a file that a source is written to as JSON arrays, at most.
ARRAY_DOCUMENTS = 50_000


def _from_files(spark: SparkSession, docs: DataFrame, name: str, schema, compression: str = "none") -> DataFrame:
    """Documents written to files of one JSON array each, and read back from them
    in byte ranges (a compressed file is one range)."""
    folder = scratch_target(spark, name)
    with freed_shuffles(spark):
        write_arrays(docs, folder, ARRAY_DOCUMENTS, compression)
    try:
        return read_arrays(spark, folder, schema)[0]
    finally:
        remove_path(spark, folder)  # what was read is staged


def load_receipts_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = receipt_documents(with_fields(_t(spark, sf_dir).receipts, RECEIPT_FIELDS))
    return load_receipts(_from_files(spark, docs, "receipt-files", schemas.RECEIPT))


def load_items_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The texts take about a kilobyte an item: some fifty times the table.
    return load_items(_from_files(spark, _receipt_source(spark, sf_dir), "item-files", schemas.RECEIPT, "gzip"))


def _as_version(docs: DataFrame, day: int, deleted: bool = False) -> DataFrame:
    """Document texts with the fields that tell their version."""
    fields = f'{{"db_last_modified":{{"$date":{day * 86_400_000}}},"deleted":{str(deleted).lower()},'
    return docs.select(F.concat(F.lit(fields), F.expr("substr(value, 2)")).alias("value"))


def _take_in(spark: SparkSession, source: str, batches: list[DataFrame]) -> str:
    """Let the batches arrive one after another as files of a stream, each gone
    when it has been taken in; the store's folder. Only its last version is kept."""
    arriving, root, checkpoint = (scratch_target(spark, f"{source}-{part}") for part in ("arriving", "store", "stream"))
    with freed_shuffles(spark):
        for batch in batches:
            batch.write.text(arriving, compression="gzip")
            incremental.start_load_stream(spark, source, arriving, root, checkpoint).awaitTermination()
            remove_path(spark, arriving)
            Snapshots(spark, root).vacuum(keep=1)
    incremental.compact(spark, root)
    return root


def incremental_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts and items after three batches: first versions of all receipts, with
    other quantities and more lines; the final ones of finished receipts; then the
    final ones of the others, with the first versions of finished ones again, late."""
    t = _t(spark, sf_dir)
    finished = F.coalesce(F.col("status"), F.lit("")) == "FINISHED"
    receipts, items = t.by_receipt("receipts"), t.by_receipt("items")

    def of(some: DataFrame) -> DataFrame:
        return items.join(some.select(F.col("id").alias("receipt_id")), "receipt_id", "left_semi")

    def wrong(items: DataFrame) -> DataFrame:
        """Each item twice, where it is: with another quantity, and on a further line."""
        both = items.withColumn("_more", F.explode(F.array(F.lit(0), F.lit(100))))
        quantity = F.col("quantity_purchased") + F.when(F.col("_more") == 0, 1).otherwise(0)
        return both.withColumns({"line_no": F.col("line_no") + F.col("_more"), "quantity_purchased": quantity}).drop("_more")

    first = lambda some, items: _as_version(receipt_documents(some, wrong(items), dealt=True), 1)
    final = lambda some, items: _as_version(receipt_documents(some, items, dealt=True), 2)
    done, others = receipts.where(finished), receipts.where(~finished)
    late = final(others, of(others)).unionAll(first(done, of(done)))
    root = _take_in(spark, "receipts", [first(receipts, items), final(done, of(done)), late])
    now = incremental.current_tables(spark, root)
    receipts = now.receipts.select(F.col("id").alias("receipt_id"), "status")
    return now.items.join(receipts, "receipt_id").select("receipt_id", "status", "item_number", "brand_code", "quantity_purchased", "final_price")


def incremental_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users after two batches: all as consumers, then those of another role as
    they are, and staff deleted; consumers are delivered twice."""
    users = with_fields(_t(spark, sf_dir).users, USER_FIELDS)
    staff = F.coalesce(F.col("role"), F.lit("")) == STAFF_ROLE
    consumers = users.withColumn("role", F.lit("consumer"))
    first = _as_version(user_documents(consumers), 1)
    others = _as_version(user_documents(users.where(~staff)), 2).unionAll(_as_version(user_documents(users.where(staff)), 2, deleted=True))
    root = _take_in(spark, "users", [first, others.unionAll(first)])
    return incremental.current_tables(spark, root).users


def _stored_counts(spark: SparkSession, sf_dir: str) -> Snapshots:
    """The daily sets of all receipts, taken in as three batches; the last one
    brings a month of the first again."""
    t = _t(spark, sf_dir)
    store = Snapshots(spark, scratch_target(spark, "brand-days"))
    created = F.col("create_date")
    again = created.between(F.lit(TOP_MONTH[0]).cast("timestamp_ntz"), F.lit(TOP_MONTH[1]).cast("timestamp_ntz"))
    one, two = (F.lit(d).cast("timestamp_ntz") for d in STORED_UNTIL)
    for batch in (created < one, (created >= one) & (created < two), (created >= two) | again):
        rollups.add_receipts(store, t.receipts.where(batch), t.items, t.brands)
    return store


def _near(estimate: str, exact: str):
    bound = F.greatest(F.lit(1.0), 3 * rollups.relative_error() * F.col(exact))
    return F.abs(F.col(estimate) - F.col(exact)) <= bound


def stored_receipts_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct receipts by month and brand from stored daily sets, and whether
    the sketches' estimate is within three standard errors."""
    store = _stored_counts(spark, sf_dir)
    both = rollups.receipts_by_brand(store).join(rollups.estimated_receipts_by_brand(store), ["month", "brand_name"])
    return both.select("month", "brand_name", "total_receipts", _near("estimate", "total_receipts").alias("sketch_agrees"))


def stored_branded_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct receipts with a branded item in two months, over all brands, from stored daily sets."""
    counts = rollups.branded_receipts(_stored_counts(spark, sf_dir), *TOP_MONTHS)
    return counts.select("total_with_brand", _near("estimate", "total_with_brand").alias("sketch_agrees"))


# Pending receipts stand for the documents without an id, or cut short.
_PENDING = "status = 'PENDING'"


def load_items_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a source where some documents have an empty id: those are skipped."""
    t = _t(spark, sf_dir)
    oid = F.when(F.expr(_PENDING), "").otherwise(F.col("id").cast("string"))
    docs = parse_documents(receipt_documents(t.receipts, t.items, document_id=oid), schemas.RECEIPT)
    return load_items(docs).groupBy("receipt_id").agg(F.count(F.lit(1)).alias("items"))


def load_receipts_with_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts of a source where some documents have no id, those dropped."""
    t = _t(spark, sf_dir)
    oid = F.when(~F.expr(_PENDING), F.col("id").cast("string"))
    docs = parse_documents(receipt_documents(t.receipts, document_id=oid), schemas.RECEIPT)
    return load_receipts(docs, drop_missing_id=True).select("id", "status", "create_date")


def exploded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each item, and one without an item for a receipt that has none."""
    t = _t(spark, sf_dir)
    docs = parse_documents(receipt_documents(t.receipts, t.items), schemas.RECEIPT)
    return explode_outer_items(docs).select("receipt_id", "item.itemNumber", "item.brandCode")


def corrupt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of a source with texts cut short are malformed."""
    whole = receipt_documents(_t(spark, sf_dir).receipts)
    pending = F.col("value").contains('"PENDING"')
    cut = whole.select(F.when(pending, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value"))
    return corrupt_counts(cut, schemas.RECEIPT)


def status_totals_by_rewards_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    items = with_fields(t.items, {"rewards_group": ITEM_FIELDS_WRITTEN["rewards_group"]})
    return status_totals_by_item_attribute(t.receipts, items, "rewards_group", FINISHED_AND_REJECTED)


# --- extensions described in the reference as next steps ---------------------

# Fixed value: known-equal description values mapped to one value (NULL = unknown).
DESCRIPTION_MAP = {"ITEM NOT FOUND": None}


def top_brands_latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return brand_receipts_latest_month(t.receipts, t.items, t.brands, k=TOP_K)


def status_totals_by_month_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return status_totals_by_month(t.receipts, t.items, FINISHED_AND_REJECTED)


def status_totals_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return status_totals_by_brand_attribute(t.receipts, t.items, t.brands, "category", FINISHED_AND_REJECTED)


def item_totals_with_fallback_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return item_totals_with_fallback(t.receipts, t.items, FINISHED_AND_REJECTED)


def receipts_without_brands_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return receipts_without_brands(t.receipts, t.items, t.brands)


def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.month_gaps(_t(spark, sf_dir).receipts, "create_date")


def missing_months_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without a receipt between a user's first and last one."""
    return audit.month_gaps(_t(spark, sf_dir).receipts, "create_date", by=["user_id"])


def brand_code_spend_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brand_code_spend(_t(spark, sf_dir).items)


def description_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _t(spark, sf_dir).items.select(standardize_text("description").alias("description"))
    mapped = apply_value_map(items, "description", DESCRIPTION_MAP)
    return mapped.groupBy("description").agg(F.count(F.lit(1)).alias("items"))


def item_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_counts(_t(spark, sf_dir).items)


def duplicate_brand_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys(_t(spark, sf_dir).brands, ["brand_code"])


def duplicate_item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys(_t(spark, sf_dir).items, ["receipt_id", "line_no"])


def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(_t(spark, sf_dir).events, "user_id", "ts", tie_breakers=("event_id",))


def latest_event_per_user_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result through a Structured Streaming upsert.

    The events are first laid out as files of successive times, as they would
    arrive; the stream takes a quarter of the files at a time, so later
    micro-batches update the keys of earlier ones.
    """
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _, folder = stage(_t(spark, sf_dir).events.repartitionByRange(files, "ts"), "event-files")
    try:
        stream = (
            spark.readStream.schema(TABLE_SCHEMAS["events"])
            .option("maxFilesPerTrigger", max(1, files // 4))
            .parquet(folder)
        )
        target = scratch_target(spark, "latest-event-per-user")
        start_upsert_stream(stream, target, "user_id", "ts", tie_breakers=("event_id",)).awaitTermination()
    finally:
        remove_path(spark, folder)
    return read_latest(spark, target, TABLE_SCHEMAS["events"])


# Names of items as they might be typed, over lineitem and part; Spark and DuckDB read it alike.
TYPED_NAME = """case l_linenumber % 4
    when 0 then upper(p_name)
    when 1 then split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
    when 2 then substr(p_name, 1, cast(l_orderkey % (length(p_name) - 1) as int)) || substr(p_name, cast(l_orderkey % (length(p_name) - 1) as int) + 2)
    else p_name || '!' end"""


def clustered_item_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item names typed in several ways, and the one that stands for each."""
    lines, parts = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet") for name in ("lineitem", "part"))
    typed = lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).select(F.expr(TYPED_NAME).alias("name"))
    return value_clusters(typed, "name", rows="items")


def load_inferred_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from files that lack some fields altogether, read without a declared
    schema from two paths of which one is absent."""
    users = with_fields(_t(spark, sf_dir).users, USER_FIELDS).drop("state", "last_login")
    folder = scratch_target(spark, "inferred-users")
    user_documents(users).write.text(folder)
    docs = read_documents(spark, [folder, f"{folder}-absent"], None, multiline=False, on_missing="empty")
    return load_users(docs)


def load_users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table loaded on its own from array files, replaced by a second load, and read back."""
    docs = user_documents(with_fields(_t(spark, sf_dir).users, USER_FIELDS))
    source, target = (scratch_target(spark, name) for name in ("user-files", "users-table"))
    write_arrays(docs, source, ARRAY_DOCUMENTS)
    for _ in range(2):
        load_table(spark, "users", source, target)
    return spark.read.parquet(target)


def null_free_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items listed in each receipt once the NULL elements of its list are removed:
    those of an even line number have been made NULL."""
    docs = parse_documents(_receipt_source(spark, sf_dir), schemas.RECEIPT)
    odd = F.transform("rewardsReceiptItemList", lambda i: F.when(i["itemNumber"].cast("int") % 2 == 1, i))
    kept = drop_nulls(docs.select("_id", odd.alias("rewardsReceiptItemList")))
    size = F.coalesce(F.size("rewardsReceiptItemList"), F.lit(0))
    return kept.select(F.col("_id.$oid").alias("receipt_id"), F.greatest(size, F.lit(0)).cast("long").alias("items"))


def _drifting_users(spark: SparkSession, sf_dir: str) -> list[str]:
    """Users in three batches of files by creation year: later ones have a state,
    a balance that was whole becomes a decimal number and then text, and the last
    ones have no sign-up source."""
    users = _t(spark, sf_dir).users.select(F.col("id").cast("string").alias("id"), "role", F.year("created_date").alias("year"), F.length("id").alias("n"))
    source, state = F.lit("Email").alias("source"), F.struct(F.col("role").alias("code")).alias("state")
    batches = [
        (F.col("year") < DRIFT_YEARS[0], [source, F.col("n").cast("long").alias("balance")]),
        (F.col("year").between(DRIFT_YEARS[0], DRIFT_YEARS[1] - 1), [source, state, (F.col("n") + 0.5).cast("double").alias("balance")]),
        (F.col("year") >= DRIFT_YEARS[1], [state, F.concat(F.lit("$"), F.col("n").cast("string")).alias("balance")]),
    ]
    paths = []
    for number, (part, columns) in enumerate(batches, 1):
        paths.append(scratch_target(spark, f"drift-{number}"))
        users.where(part).select("id", *columns).write.json(paths[-1])
    return paths


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of changing documents does to the fields."""
    return drift.drift_report(spark, _drifting_users(spark, sf_dir))


def drifted_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches of changing documents under one schema."""
    known = StructType.fromDDL("state struct<code: string>")
    docs = drift.read_batches(spark, _drifting_users(spark, sf_dir), known=known)
    return docs.select("id", "source", F.col("balance").cast("string").alias("balance"), F.col("state.code").alias("state"))


QUERIES: dict[str, Query] = {
    # composites of SURVEY 2.12
    "top_brands_by_month": top_brands_by_month,
    "top_brands_month_over_month": top_brands_month_over_month,
    "item_totals_by_status": item_totals_by_status_q,
    "item_share_by_status": item_share_by_status,
    "brand_spend_recent_users": brand_spend_recent_users,
    "brand_transactions_recent_users": brand_transactions_recent_users,
    "brand_spend_all_roles": brand_spend_all_roles,
    "brand_transactions_all_brands": brand_transactions_all_brands,
    "receipts_by_month": receipts_by_month,
    "last_day_hourly": last_day_hourly,
    "clean_items": clean_items_q,
    "user_date_range": user_date_range,
    "receipt_totals_by_status": receipt_totals_by_status,
    "receipt_share_by_status": receipt_share_by_status,
    "brand_code_saturation": brand_code_saturation,
    "receipts_with_items": receipts_with_items,
    "quantity_mismatch": quantity_mismatch,
    "distinct_status": distinct_status,
    "items_saturation": items_saturation,
    "items_saturation_window": items_saturation_window,
    "missing_item_count": missing_item_count,
    "item_rows_by_status": item_rows_by_status,
    "recent_users": recent_users_q,
    "blank_descriptions": blank_descriptions,
    "brand_code_presence": brand_code_presence,
    "metabrite_price_present": metabrite_price_present,
    "load_receipts": load_receipts_q,
    "load_items": load_items_q,
    "load_users": load_users_q,
    "load_brands": load_brands_q,
    "load_items_without_ids": load_items_without_ids,
    "load_receipts_with_ids": load_receipts_with_ids,
    "exploded_items": exploded_items,
    "corrupt_documents": corrupt_documents,
    # extensions
    "top_brands_latest_month": top_brands_latest_month,
    "status_totals_by_month": status_totals_by_month_q,
    "status_totals_by_category": status_totals_by_category,
    "item_totals_with_fallback": item_totals_with_fallback_q,
    "receipts_without_brands": receipts_without_brands_q,
    "missing_months": missing_months,
    "missing_months_by_user": missing_months_by_user,
    "status_totals_by_rewards_group": status_totals_by_rewards_group,
    "brand_code_spend": brand_code_spend_q,
    "description_values": description_values,
    "item_flag_counts": item_flag_counts,
    "duplicate_brand_codes": duplicate_brand_codes,
    "duplicate_item_lines": duplicate_item_lines,
    "latest_event_per_user": latest_event_per_user,
    "latest_event_per_user_stream": latest_event_per_user_stream,
    "load_receipts_from_files": load_receipts_from_files,
    "load_items_from_files": load_items_from_files,
    "incremental_items": incremental_items,
    "incremental_users": incremental_users,
    "stored_receipts_by_brand": stored_receipts_by_brand,
    "stored_branded_receipts": stored_branded_receipts,
    "clustered_item_names": clustered_item_names,
    "load_inferred_users": load_inferred_users,
    "load_users_table": load_users_table,
    "null_free_items": null_free_items,
    "schema_drift": schema_drift,
    "drifted_users": drifted_users,
}
