"""Odd values, fresh catalogs, malformed texts and ordered output."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tillroll.operators.audit import month_gaps, rows_by_parent_key
from tillroll.operators.brands import brand_code_spend, cents
from tillroll.operators.status import status_totals_by_item_attribute
from tillroll.plans import catalog
from tillroll.plans.batch_load import load_all
from tillroll.sources import schemas as S
from tillroll.sources.documents import corrupt_counts, drop_nulls, parse_documents


def test_cents_round_half_to_even_and_absurd_amounts_count_as_missing(spark):
    amounts = [0.125, 0.375, -0.125, 1.25, 1e30, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(amounts)], "i int, a double")
    got = [r.c for r in df.select("i", cents(F.col("a")).alias("c")).orderBy("i").collect()]
    assert [None if c is None else int(c) for c in got] == [12, 38, -12, 125, None, None, None, None]


def test_an_absurd_price_text_leaves_the_spend_report_standing(spark):
    rows = [("A", 2, None, None, "1e30"), ("A", 2, None, 1.5, None), ("B", 1, None, 9e15, None), ("B", 1, None, 9e15, None)]
    schema = "brand_code string, quantity_purchased long, user_flagged_quantity long, final_price double, user_flagged_price string"
    got = {r.brand_code: (r.total_spend, r.rank) for r in brand_code_spend(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"B": (1.8e16, 1), "A": (3.0, 2)}


def test_month_reports_come_ordered(spark):
    rows = [(r.month, r.rank, r.brand_name) for r in catalog.top_brands_month_over_month(spark, SF01).collect()]
    assert len({m for m, _, _ in rows}) == 2
    assert rows == sorted(rows, key=lambda r: (-r[0].timestamp(), r[1], r[2]))


def test_month_gaps_by_key(spark):
    rows = [(1, "1998-01-05"), (1, "1998-04-01"), (1, "1998-04-30"), (2, "1998-02-01"), (3, None), (None, "1997-12-31"), (None, "1998-02-02")]
    df = spark.createDataFrame(rows, "u int, d string").select("u", F.col("d").cast("timestamp_ntz").alias("ts"))
    got = {(r.u, r.month.date()) for r in month_gaps(df, "ts", by=["u"]).collect()}
    assert got == {(1, dt.date(1998, 2, 1)), (1, dt.date(1998, 3, 1)), (None, dt.date(1998, 1, 1))}
    assert month_gaps(df.limit(0), "ts").count() == 0


def test_child_rows_are_counted_per_key_first(spark):
    parents = spark.createDataFrame([(1, "F"), (2, "F"), (3, "R"), (4, "P")], "id int, status string")
    children = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,), (None,)], "rid int")
    got = rows_by_parent_key(parents, children, "id", "rid", "status", ["F", "R"])
    assert {(r.status, r.total) for r in got.collect()} == {("F", 3), ("R", 1)}


def test_totals_by_rewards_group(spark):
    receipts = spark.createDataFrame([(1, "FINISHED"), (2, "REJECTED"), (3, "PENDING")], "id int, status string")
    rows = [(1, "G", 2, None), (1, "G", None, 3), (2, None, 4, None), (3, "G", 9, None)]
    items = spark.createDataFrame(rows, "receipt_id int, rewards_group string, quantity_purchased long, user_flagged_quantity long")
    got = {(r.rewards_group, r.status, r.total_items) for r in status_totals_by_item_attribute(receipts, items).collect()}
    assert got == {("G", "FINISHED", 5), (None, "REJECTED", 4)}


def test_malformed_texts_are_counted_or_raise(spark):
    texts = ['{"_id": {"$oid": "u1"}, "role": "consumer"}', '{"_id": {"$oid": "u2"}', "not json"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert corrupt_counts(df, S.USER).collect()[0].asDict() == {"documents": 3, "corrupt": 2}
    with pytest.raises(Exception):
        parse_documents(df, S.USER).collect()
    assert [r["_id"][0] for r in parse_documents(df, S.USER, on_corrupt="drop").collect()] == ["u1"]
    kept = parse_documents(df, S.USER, on_corrupt="keep")
    assert sorted(r["_corrupt_record"] for r in kept.collect() if r["_corrupt_record"]) == sorted(texts[1:])
    with pytest.raises(ValueError):
        parse_documents(df, S.USER, on_corrupt="ignore")


def test_nulls_go_from_arrays_at_every_depth(spark):
    schema = "id int, a array<array<int>>, s struct<b: array<struct<c: array<string>>>>"
    rows = [(1, [[1, None], None, [None]], ([None, (["x", None],), (None,)],)), (2, None, None)]
    got = drop_nulls(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert got[0].a == [[1], []]
    assert [e.c for e in got[0].s.b] == [["x"], None]
    assert got[1].a is None and got[1].s is None


def test_load_into_a_database_that_is_not_there(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    oid = {"_id": {"$oid": "x"}}
    for name in ("brands", "users", "receipts"):
        with open(os.path.join(src, f"{name}.json"), "w") as f:
            json.dump([{**oid, "rewardsReceiptItemList": [{"brandCode": "B"}]} if name == "receipts" else oid], f)
    spark.sql("DROP DATABASE IF EXISTS tillroll_fresh CASCADE")
    try:
        load_all(spark, src, database="tillroll_fresh")
        assert spark.table("tillroll_fresh.rewards_receipt_items").count() == 1
    finally:
        spark.sql("DROP DATABASE IF EXISTS tillroll_fresh CASCADE")


def test_stream_query_updates_keys_over_several_batches(spark, monkeypatch):
    merged = []
    plain = catalog.start_upsert_stream

    def watched(stream, target, key, order, **kw):
        def see(batch):
            merged.append({r[0] for r in batch.select("user_id").distinct().collect()})
            return batch

        return plain(stream, target, key, order, transform=see, **kw)

    monkeypatch.setattr(catalog, "start_upsert_stream", watched)
    rows = catalog.latest_event_per_user_stream(spark, SF01).count()
    assert len(merged) >= 3 and merged[0] & merged[1] & merged[2]
    assert rows == len(set().union(*merged))
