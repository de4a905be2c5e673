"""End to end: JSON sources -> four tables -> reports on the loaded tables."""

import json
import os

from tillroll.operators.brands import brand_spend, brand_transactions
from tillroll.operators.status import item_totals_by_status
from tillroll.plans.batch_load import TABLE_NAMES, LoadedTables, load_table, load_all
from tillroll.sources.sinks import create_namespace, stage, write_table

DAY = 86_400_000
FEB_1_2021 = 1612137600000

RECEIPTS = [
    {"_id": {"$oid": "r1"}, "userId": "u1", "rewardsReceiptStatus": "FINISHED",
     "createDate": {"$date": FEB_1_2021 + DAY}, "purchasedItemCount": 3,
     "rewardsReceiptItemList": [
         {"brandCode": "B1", "finalPrice": "$2.50", "quantityPurchased": 2},
         {"brandCode": "B2", "userFlaggedPrice": "1.00", "userFlaggedQuantity": 1},
     ]},
    {"_id": {"$oid": "r2"}, "userId": "u2", "rewardsReceiptStatus": "REJECTED",
     "createDate": {"$date": FEB_1_2021 + 2 * DAY},
     "rewardsReceiptItemList": [{"brandCode": "B1", "finalPrice": "4", "quantityPurchased": 1}]},
    {"_id": {"$oid": "r3"}, "userId": "u1", "rewardsReceiptStatus": "PENDING",
     "createDate": {"$date": FEB_1_2021 + 3 * DAY}},
]
USERS = [
    {"_id": {"$oid": "u1"}, "createdDate": {"$date": FEB_1_2021}, "role": "consumer"},
    {"_id": {"$oid": "u2"}, "createdDate": {"$date": FEB_1_2021 - 400 * DAY}, "role": "consumer"},
]
BRANDS = [
    {"_id": {"$oid": "b1"}, "brandCode": "B1", "name": "One", "barcode": "0012"},
    {"_id": {"$oid": "b2"}, "brandCode": "B2", "name": "Two"},
]


def _sources(folder):
    for name, docs in (("receipts", RECEIPTS), ("users", USERS), ("brands", BRANDS)):
        with open(os.path.join(folder, f"{name}.json"), "w") as f:
            json.dump(docs, f)


def test_batch_load_and_reports(spark, scratch):
    src = os.path.join(scratch, "src")
    out = os.path.join(scratch, "out")
    os.makedirs(src)
    _sources(src)
    written = load_all(spark, src, out)
    assert sorted(written) == sorted(TABLE_NAMES)
    t = LoadedTables.from_dir(spark, out)
    assert t.receipts.count() == 3 and t.items.count() == 3
    assert t.users.count() == 2 and t.brands.count() == 2

    totals = {r.status: r.total_items for r in item_totals_by_status(t.receipts, t.items).collect()}
    assert totals == {"FINISHED": 3, "REJECTED": 1}
    spend = {r.brand_name: (r.total_spend, r.rank) for r in brand_spend(t.receipts, t.items, t.brands, t.users, 6, None).collect()}
    # only u1 is in the 6-month cohort: r1 -> One 2 * 2.50, Two 1 * 1.00
    assert spend == {"One": (5.0, 1), "Two": (1.0, 2)}
    tx = [(r.brand_name, r.total_transactions, r.rank) for r in brand_transactions(t.receipts, t.items, t.brands, t.users, 60, None).collect()]
    assert tx == [("One", 2, 1), ("Two", 1, 2)]

    # replace semantics: a second run overwrites, it does not append
    load_all(spark, src, out)
    assert LoadedTables.from_dir(spark, out).items.count() == 3


def test_batch_load_missing_source_gives_empty_table(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    with open(os.path.join(src, "users.json"), "w") as f:
        json.dump(USERS, f)
    out = os.path.join(scratch, "out")
    load_all(spark, src, out, on_missing="empty")
    t = LoadedTables.from_dir(spark, out)
    assert t.users.count() == 2
    assert t.receipts.count() == 0 and "purchased_item_count" in t.receipts.columns
    assert t.items.count() == 0 and "final_price" in t.items.columns


def test_sinks(spark, scratch):
    df = spark.range(5).selectExpr("id as k", "id % 2 as part")
    path = os.path.join(scratch, "t")
    write_table(df, path, partition_by=["part"])
    assert spark.read.parquet(path).count() == 5
    write_table(df.limit(2), path)
    assert spark.read.parquet(path).count() == 2
    staged, _ = stage(df, "unit")
    assert sorted(r.k for r in staged.collect()) == [0, 1, 2, 3, 4]
    create_namespace(spark, "tillroll_test_ns")
    assert any(d.name == "tillroll_test_ns" for d in spark.catalog.listDatabases())


def test_load_single_table(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _sources(src)
    target = os.path.join(scratch, "items")
    load_table(spark, "rewards_receipt_items", os.path.join(src, "receipts.json"), target)
    rows = sorted((r.receipt_id, r.line_no, r.final_price) for r in spark.read.parquet(target).collect())
    assert rows == [("r1", 1, 2.5), ("r1", 2, None), ("r2", 1, 4.0)]


def test_bucketed_catalog_tables_join_without_shuffle(spark, scratch):
    from tillroll.plans.inspect import plan_text

    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _sources(src)
    db = "tillroll_bucketed_test"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{os.path.join(scratch, 'db')}'")
    load_all(spark, src, database=db, receipt_buckets=4)
    t = LoadedTables.from_catalog(spark, db)
    totals = {r.status: r.total_items for r in item_totals_by_status(t.receipts, t.items).collect()}
    assert totals == {"FINISHED": 3, "REJECTED": 1}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = t.items.join(t.receipts, t.items["receipt_id"] == t.receipts["id"])
        text = plan_text(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sql_over_registered_tables(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _sources(src)
    out = os.path.join(scratch, "out")
    load_all(spark, src, out)
    LoadedTables.from_dir(spark, out).register("loaded_")
    rows = spark.sql(
        """
        select r.status, sum(coalesce(i.quantity_purchased, i.user_flagged_quantity)) as total_items
        from loaded_receipts r join loaded_items i on i.receipt_id = r.id
        where r.status in ('FINISHED', 'REJECTED')
        group by r.status
        """
    ).collect()
    assert {r.status: r.total_items for r in rows} == {"FINISHED": 3, "REJECTED": 1}


def test_command_line(spark, scratch, capsys):
    from tillroll.__main__ import main

    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _sources(src)
    out = os.path.join(scratch, "cli-out")
    assert main(["load", src, out]) == 0
    assert "rewards_receipt_items" in capsys.readouterr().out
    assert spark.read.parquet(os.path.join(out, "rewards_receipt_items")).count() == 3
    assert main(["list"]) == 0
    assert "top_brands_by_month" in capsys.readouterr().out
    assert main(["query", "distinct_status", "/root/testdata/sf0.001", "--show", "5"]) == 0
    assert "FINISHED" in capsys.readouterr().out


def test_stage_is_removed_after_the_load(spark, scratch):
    _, path = stage(spark.range(3), "probe")
    assert path.rstrip("/").split("/")[-2] == "tillroll-stage"
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _sources(src)
    before = set(os.listdir(path.replace("file:", "").rsplit("/", 1)[0]))
    load_all(spark, src, os.path.join(scratch, "out"))
    after = set(os.listdir(path.replace("file:", "").rsplit("/", 1)[0]))
    assert after == before  # the load's own stage folder is gone again


def test_jdbc_sink_reaches_the_jdbc_writer(spark):
    import pytest

    # No driver accepts this URL, so nothing is contacted; the error shows the
    # write went to Spark's JDBC data source.
    with pytest.raises(Exception) as err:
        write_table(spark.range(1), "t", jdbc_url="jdbc:tillroll-none:x", jdbc_properties={"user": "u"})
    assert "driver" in str(err.value).lower()


def test_item_dates_prune_the_item_scan(spark, scratch):
    from tillroll.operators.brands import brand_receipts_by_month
    from tillroll.plans.inspect import pushed_filters

    src = os.path.join(scratch, "src")
    os.makedirs(src)
    _sources(src)
    out = os.path.join(scratch, "out")
    load_all(spark, src, out)
    t = LoadedTables.from_dir(spark, out)
    assert "receipt_create_date" in t.items.columns
    plain = brand_receipts_by_month(t.receipts, t.items, t.brands, "2021-02-01", "2021-03-01")
    pruned = brand_receipts_by_month(t.receipts, t.items, t.brands, "2021-02-01", "2021-03-01", prune_items_by_date=True)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, pruned.collect()))
    assert len(plain.collect()) == 2
    assert any("receipt_create_date" in f for f in pushed_filters(pruned))


def test_month_folders_are_pruned_without_a_flag(spark, scratch):
    from tillroll.operators.brands import brand_receipts_by_month, brand_receipts_latest_month
    from tillroll.plans.inspect import plan_text

    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    os.makedirs(src)
    _sources(src)
    receipts = [{**RECEIPTS[0], "_id": {"$oid": f"m{m}"}, "createDate": {"$date": FEB_1_2021 + (31 * m + 3) * DAY}} for m in range(-6, 6)]
    receipts += [{**RECEIPTS[0], "_id": {"$oid": "undated"}, "createDate": None}]

    def load(docs):
        with open(os.path.join(src, "receipts.json"), "w") as f:
            json.dump(docs, f)
        load_all(spark, src, out)
        return LoadedTables.from_dir(spark, out)

    def reports(t):
        window = brand_receipts_by_month(t.receipts, t.items, t.brands, "2021-02-01", "2021-04-01")
        return window, brand_receipts_latest_month(t.receipts, t.items, t.brands), brand_receipts_by_month(t.receipts, t.items, t.brands)

    t = load(receipts)
    plain = LoadedTables(t.receipts.drop("create_month"), t.items.drop("receipt_month"), t.users, t.brands)
    for pruned, whole in zip(reports(t), reports(plain)):
        assert [tuple(r) for r in pruned.collect()] == [tuple(r) for r in whole.collect()] != []
    window, latest, _ = reports(t)
    items_scan = next(s for s in plan_text(window).split("Scan parquet")[1:] if "brand_code" in s.split("ReadSchema")[0] + s[:3000])
    assert "receipt_month" in items_scan and "PartitionFilters" in items_scan
    assert "dynamicpruning" in plan_text(window).lower() and "dynamicpruning" in plan_text(latest).lower()
    files = lambda df: {f.split("receipt_month=")[1][:10] for f in df.inputFiles()}
    assert len(files(t.items)) == 13
    # Repeated ids may carry two dates: such tables aren't partitioned.
    again = load([*receipts, {**receipts[0], "createDate": receipts[5]["createDate"]}])
    assert "receipt_month" not in again.items.columns and again.receipts.count() == 14
