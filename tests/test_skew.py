"""Hot keys: one receipt, one brand code and one user hold a third of the rows.

The brand reports run once with default settings and once with broadcasts
off and tiny skew thresholds, so the shuffled joins go through adaptive
skew-join splitting. Both runs must agree with each other and with Python.
"""

import datetime as dt
from collections import defaultdict

from pyspark.sql import functions as F

from tillroll.operators.brands import brand_spend, brand_transactions
from tillroll.operators.status import item_totals_by_status
from tillroll.operators.upsert import latest_per_key

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _tables(spark, n=30000):
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    items = ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("receipt_id"),
        F.when(F.col("id") % 2 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("B"), (F.col("id") % 40).cast("string"))).alias("brand_code"),
        (F.col("id") % 5 + 1).alias("quantity_purchased"),
        F.lit(None).cast("bigint").alias("user_flagged_quantity"),
        ((F.col("id") % 100) / 4).alias("final_price"),
        F.lit(None).cast("string").alias("user_flagged_price"),
    )
    receipts = spark.range(998).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 100).alias("user_id"),
        F.when(F.col("id") % 2 == 0, F.lit("FINISHED")).otherwise(F.lit("REJECTED")).alias("status"),
        F.lit(dt.datetime(2021, 2, 1)).cast("timestamp_ntz").alias("create_date"),
    )
    users = spark.range(200).select(
        F.col("id"), F.lit(dt.datetime(2021, 1, 1)).cast("timestamp_ntz").alias("created_date"), F.lit("consumer").alias("role")
    )
    codes = ["HOT"] + [f"B{i}" for i in range(40)]
    brands = spark.createDataFrame([(c, "Hot" if c == "HOT" else f"N{int(c[1:]) % 7}") for c in codes], "brand_code string, name string")
    return receipts, items, brands, users


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _expected(n=30000):
    spend, receipts_of = defaultdict(int), defaultdict(set)
    for i in range(n):
        rid = 0 if i % 3 == 0 else i % 997 + 1
        code = "HOT" if i % 2 == 0 else f"B{i % 40}"
        name = "Hot" if code == "HOT" else f"N{int(code[1:]) % 7}"
        spend[name] += round((i % 5 + 1) * (i % 100) / 4 * 100)
        receipts_of[name].add(rid)
    return {k: v / 100 for k, v in spend.items()}, {k: len(v) for k, v in receipts_of.items()}


def test_brand_reports_under_skew(spark):
    receipts, items, brands, users = _tables(spark)
    spend_expected, tx_expected = _expected()

    def run():
        spend = {r.brand_name: r.total_spend for r in brand_spend(receipts, items, brands, users, 6, None).collect()}
        tx = {r.brand_name: r.total_transactions for r in brand_transactions(receipts, items, brands, users, 6, None, limit=None).collect()}
        totals = {r.status: r.total_items for r in item_totals_by_status(receipts, items).collect()}
        return spend, tx, totals

    plain = run()
    skewed = _with_conf(spark, SKEW_CONF, run)
    assert plain == skewed
    assert plain[0] == spend_expected
    assert plain[1] == tx_expected


def test_latest_per_key_with_hot_key(spark):
    df = spark.range(50000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("t"),
    )
    got = {r.k: r.t for r in latest_per_key(df, "k", "t").collect()}
    assert got[-1] == 49998 and len(got) == 1001
