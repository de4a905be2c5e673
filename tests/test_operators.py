"""Operators against brute-force Python on small random and hand-made inputs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillroll.operators import audit
from tillroll.operators.brands import brand_receipts_by_month, brand_spend, brand_transactions
from tillroll.operators.cohort import recent_users
from tillroll.operators.rank import global_dense_rank, number_in_order, top_k_dense, top_n_ranked
from tillroll.operators.status import item_totals_by_status, quantity_with_receipt_fallback


def _dense_rank(values, nulls_first=True):
    distinct = sorted({v for v in values if v is not None}, reverse=True)
    order = ([None] if None in values and nulls_first else []) + distinct
    if None in values and not nulls_first:
        order.append(None)
    return {v: i + 1 for i, v in enumerate(order)}


def test_global_dense_rank_matches_brute_force(spark):
    rng = random.Random(3)
    for n, spread in ((0, 5), (1, 5), (50, 3), (500, 40), (2000, 2000)):
        values = [rng.choice([None] + list(range(spread))) if rng.random() < 0.95 else None for _ in range(n)]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v bigint")
        for nulls_first in (True, False):
            expect = _dense_rank(values, nulls_first)
            ranked = global_dense_rank(df, "v", nulls_first=nulls_first, num_partitions=7)
            got = {r.k: r.rank for r in ranked.collect()}
            assert got == {i: expect[v] for i, v in enumerate(values)}


def test_global_dense_rank_without_reused_exchanges(spark):
    df = spark.range(100_000).selectExpr("id", "(id * 7919) % 100003 as v")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ranked = global_dense_rank(df, "v", num_partitions=16)
        # Distinct values: the rank of v is the number of values at least as large.
        bad = ranked.selectExpr("rank", "row_number() over (order by v desc) as place").where("rank <> place")
        assert ranked.count() == 100_000 and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_number_in_order_counts_through_all_ranges(spark):
    rows = [(k % 5 if k % 11 else None, k, "x") for k in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, c string").repartition(4)
    got = [(r.a, r.b) for r in sorted(number_in_order(df, ["a", "b"], num_partitions=6).collect(), key=lambda r: r.number)]
    assert got == sorted(((a, b) for a, b, _ in rows), key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    numbers = [r.number for r in number_in_order(df, ["a"], num_partitions=6).collect()]
    assert sorted(numbers) == list(range(1, 301))
    assert number_in_order(df.limit(0), ["a"]).count() == 0


def test_global_dense_rank_on_doubles_checkpoints(spark):
    df = spark.createDataFrame([(1, 0.1 + 0.2), (2, 0.3), (3, 0.3), (4, None)], "k int, v double")
    got = {r.k: r.rank for r in global_dense_rank(df, "v").collect()}
    assert got == {4: 1, 1: 2, 2: 3, 3: 3}


def test_top_k_dense_keeps_ties(spark):
    rows = [("m1", "a", 5), ("m1", "b", 5), ("m1", "c", 4), ("m1", "d", 3), ("m2", "a", 1), ("m2", "b", None)]
    df = spark.createDataFrame(rows, "g string, name string, v bigint")
    got = sorted((r.g, r.name, r.rank) for r in top_k_dense(df, ["g"], "v", 2).collect())
    assert got == [("m1", "a", 1), ("m1", "b", 1), ("m1", "c", 2), ("m2", "a", 2), ("m2", "b", 1)]


def test_top_n_ranked_equals_prefix_of_full_rank(spark):
    rng = random.Random(5)
    rows = [(f"n{i:03d}", rng.randint(0, 20)) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, v bigint")
    full = sorted(((r.rank, r.name, r.v) for r in global_dense_rank(df, "v").collect()))
    head = [(r.rank, r.name, r.v) for r in top_n_ranked(df, "v", 15, tie_cols=("name",)).collect()]
    assert sorted(head) == full[:15]


def _receipt_tables(spark):
    receipts = spark.createDataFrame(
        [
            (1, 10, dt.datetime(2021, 2, 1), "FINISHED", 2),
            (2, 10, dt.datetime(2021, 2, 14, 13), "REJECTED", None),
            (3, 11, dt.datetime(2021, 3, 1), "FINISHED", 5),
            (4, 12, dt.datetime(2021, 1, 20), "PENDING", 1),
            (5, 13, dt.datetime(2020, 11, 2), "FINISHED", 7),
        ],
        "id bigint, user_id bigint, create_date timestamp_ntz, status string, purchased_item_count bigint",
    )
    items = spark.createDataFrame(
        [
            (1, 1, "B1", 2, None, 1.5, None),
            (1, 2, "B2", None, 3, None, "2.00"),
            (2, 1, "B1", 1, 1, 4.0, None),
            (3, 1, "B3", None, None, 9.0, None),
            (3, 2, None, 4, None, 1.0, None),
            (4, 1, "B2", 2, None, None, "abc"),
            (5, 1, "B4", 1, None, 2.25, None),
        ],
        "receipt_id bigint, line_no int, brand_code string, quantity_purchased bigint, "
        "user_flagged_quantity bigint, final_price double, user_flagged_price string",
    )
    brands = spark.createDataFrame(
        [("B1", "One"), ("B2", "Two"), ("B3", "Three"), ("B4", "Four"), ("B4", "Four")],
        "brand_code string, name string",
    )
    users = spark.createDataFrame(
        [
            (10, dt.datetime(2020, 9, 1), "consumer"),
            (11, dt.datetime(2021, 2, 10), "staff"),
            (12, dt.datetime(2020, 8, 1), None),
            (13, dt.datetime(2019, 1, 1), "consumer"),
        ],
        "id bigint, created_date timestamp_ntz, role string",
    )
    return receipts, items, brands, users


def test_brand_receipts_by_month(spark):
    receipts, items, brands, _ = _receipt_tables(spark)
    out = brand_receipts_by_month(receipts, items, brands, "2021-02-01", "2021-03-01", k=5)
    got = sorted((r.month, r.brand_name, r.total_receipts, r.rank) for r in out.collect())
    feb = dt.datetime(2021, 2, 1)
    assert got == [(feb, "One", 2, 1), (feb, "Two", 1, 2)]
    every = brand_receipts_by_month(receipts, items, brands, k=1)
    assert sorted((r.month.month, r.brand_name) for r in every.collect()) == [
        (1, "Two"), (2, "One"), (3, "Three"), (11, "Four")
    ]


def test_recent_users_and_brand_spend(spark):
    receipts, items, brands, users = _receipt_tables(spark)
    # latest creation month is 2021-02, cohort starts 2020-08-01
    assert sorted(r.id for r in recent_users(users, 6).collect()) == [10, 11, 12]
    # role filter drops staff and (as SQL does) the NULL role
    assert [r.id for r in recent_users(users, 6, ["staff"]).collect()] == [10]
    spend = {r.brand_name: (r.total_spend, r.rank) for r in brand_spend(receipts, items, brands, users, 6, ["staff"]).collect()}
    # user 10 -> receipts 1, 2. One: 2*1.5 + 1*4.0 = 7.0; Two: 3 * 2.00 = 6.0
    assert spend == {"One": (7.0, 1), "Two": (6.0, 2)}
    everyone = {r.brand_name: (r.total_spend, r.rank) for r in brand_spend(receipts, items, brands, users, 6, None).collect()}
    # receipt 4 (user 12): Two, qty 2, price NULL ('abc') -> no spend; receipt 3: Three 0 qty NULL
    assert everyone == {"Three": (None, 1), "One": (7.0, 2), "Two": (6.0, 3)}
    # fan-out: brand code B4 appears twice, spend counts twice (as the SQL join does)
    old = {r.brand_name: r.total_spend for r in brand_spend(receipts, items, brands, users, 36, None).collect()}
    assert old["Four"] == 2 * 2.25


def test_brand_transactions(spark):
    receipts, items, brands, users = _receipt_tables(spark)
    got = [(r.brand_name, r.total_transactions, r.rank) for r in brand_transactions(receipts, items, brands, users, 6, None, limit=2).collect()]
    # cohort users 10, 11, 12 -> receipts 1, 2, 3, 4; One: {1, 2}, Two: {1, 4}, Three: {3}
    assert got == [("One", 2, 1), ("Two", 2, 1)]
    full = sorted((r.brand_name, r.total_transactions, r.rank) for r in brand_transactions(receipts, items, brands, users, 6, None, limit=None).collect())
    assert full == [("One", 2, 1), ("Three", 1, 2), ("Two", 2, 1)]


def test_status_totals(spark):
    receipts, items, _, _ = _receipt_tables(spark)
    got = {r.status: (r.total_items, r.share) for r in item_totals_by_status(receipts, items, share_name="share").collect()}
    # FINISHED: receipt 1 (2 + 3) + receipt 3 (4) + receipt 5 (1) = 10; REJECTED: receipt 2 (1)
    assert got == {"FINISHED": (10, 10 / 11), "REJECTED": (1, 1 / 11)}
    fallback = {r.receipt_id: r.items_total for r in quantity_with_receipt_fallback(receipts, items).collect()}
    assert fallback == {1: 5, 2: 1, 3: 4, 4: 2, 5: 1}


def test_coverage_and_counts(spark):
    receipts, items, _, _ = _receipt_tables(spark)
    cov = audit.coverage(receipts, items, "id", "receipt_id").first()
    assert (cov.total, cov.matched) == (5, 5)
    branded = audit.coverage(
        receipts, items.where("receipt_id <> 4"), "id", "receipt_id", right_filter=F.col("brand_code").isNotNull(),
        ts_col="create_date", start="2021-02-01", end="2021-03-01", inclusive_end=True,
    ).first()
    assert (branded.total, branded.matched, branded.share) == (3, 3, 1.0)
    exclusive = audit.coverage(
        receipts, items, "id", "receipt_id", ts_col="create_date", start="2021-02-01", end="2021-03-01", inclusive_end=False
    ).first()
    assert exclusive.total == 2
    hourly = audit.counts_by_bucket(receipts, "create_date", "hour", "id", latest_day_only=True).collect()
    assert [(r.hour, r.total) for r in hourly] == [(dt.datetime(2021, 3, 1), 1)]
    pair = audit.distinct_count_pair(receipts, "id", items.where("receipt_id < 3"), "receipt_id").first()
    assert (pair.left_total, pair.right_total, pair.share) == (5, 2, 0.4)
    pres = audit.presence(items, "brand_code").first()
    assert (pres.present, pres.absent) == (6, 1)


def test_month_gaps(spark):
    receipts, _, _, _ = _receipt_tables(spark)
    gaps = sorted(r.month for r in audit.month_gaps(receipts, "create_date").collect())
    assert gaps == [dt.datetime(2020, 12, 1)]


def test_rows_by_parent(spark):
    receipts, items, _, _ = _receipt_tables(spark)
    got = {r.status: r.total for r in audit.rows_by_parent_key(receipts, items, "id", "receipt_id", "status", ["FINISHED", "REJECTED"]).collect()}
    assert got == {"FINISHED": 5, "REJECTED": 1}
    missing = audit.rows_with_null_parent_value(
        receipts, items, "id", "receipt_id", "purchased_item_count", ["status", "quantity_purchased"]
    ).collect()
    assert [(r.status, r.quantity_purchased) for r in missing] == [("REJECTED", 1)]
