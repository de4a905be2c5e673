
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry_mod
from tests.conftest import SF01
from tillroll.operators import audit
from tillroll.operators.upsert import latest_per_key

QUERIES = entry_mod.queries()


def _dense(ranks):
    got = sorted(set(ranks))
    return got == list(range(1, len(got) + 1))


def test_ranks_start_at_one_without_gaps(spark):
    for name in ("top_brands_by_month", "top_brands_month_over_month", "top_brands_latest_month"):
        by_month = defaultdict(list)
        for r in QUERIES[name](spark, SF01).collect():
            by_month[r.month].append(r.rank)
        assert by_month and all(_dense(v) for v in by_month.values()), name
    for name in ("brand_spend_recent_users", "brand_spend_all_roles", "brand_transactions_all_brands",
                 "brand_transactions_recent_users"):
        rows = QUERIES[name](spark, SF01).collect()
        assert rows and _dense([r.rank for r in rows]), name


def test_ranks_follow_totals(spark):
    rows = QUERIES["brand_transactions_all_brands"](spark, SF01).collect()
    for a in rows:
        for b in rows:
            if a.total_transactions > b.total_transactions:
                assert a.rank < b.rank


def test_ratios_are_shares(spark):
    checks = {
        "brand_code_saturation": "percentage",
        "receipts_with_items": "percentage",
        "items_saturation": "rewards_items_saturation",
        "items_saturation_window": "rewards_items_saturation",
        "brand_code_presence": "share",
        "item_share_by_status": "share",
        "receipt_share_by_status": "share",
    }
    for name, col in checks.items():
        values = [r[col] for r in QUERIES[name](spark, SF01).collect()]
        assert values and all(0.0 <= v <= 1.0 for v in values), name
    for name in ("item_share_by_status", "receipt_share_by_status"):
        shares = [r.share for r in QUERIES[name](spark, SF01).collect()]
        assert abs(sum(shares) - 1.0) < 1e-12, name


def test_item_rows_equal_list_sizes(spark):
    loaded = QUERIES["load_items"](spark, SF01).count()
    assert loaded == spark.read.parquet(f"{SF01}/lineitem.parquet").count()


records = st.lists(
    st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 20)), st.integers(0, 3)), max_size=40
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=records)
def test_latest_per_key_property(spark, rows):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)], "k int, t int, id int, v int")
    got = {r.k: (r.t, r.id) for r in latest_per_key(df, "k", "t", ("id",)).collect()}
    expect = {}
    for i, (k, t, _) in enumerate(rows):
        key = (-1 if t is None else t, i)
        if k not in expect or key > (-1 if expect[k][0] is None else expect[k][0], expect[k][1]):
            expect[k] = (t, i)
    assert got == expect


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(st.one_of(st.none(), st.integers(0, 10)), max_size=30),
    right=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.booleans()), max_size=30),
)
def test_coverage_property(spark, left, right):
    l_df = spark.createDataFrame([(x,) for x in left], "id int")
    r_df = spark.createDataFrame(right, "rid int, flag boolean")
    from pyspark.sql import functions as F

    got = audit.coverage(l_df, r_df, "id", "rid", right_filter=F.col("flag")).first()
    keys = {x for x in left if x is not None}
    hits = {k for k, f in right if k is not None and f}
    assert (got.total, got.matched) == (len(keys), len(keys & hits))
    assert got.share == (len(keys & hits) / len(keys) if keys else None)


groups = st.lists(
    st.tuples(st.integers(0, 3), st.text("abcdef", min_size=1, max_size=2), st.one_of(st.none(), st.integers(0, 6))),
    max_size=40,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=groups, k=st.integers(1, 4))
def test_top_k_dense_property(spark, rows, k):
    from tillroll.operators.rank import top_k_dense

    df = spark.createDataFrame(rows, "g int, name string, v int")
    key = lambda t: (t[0], t[1], -1 if t[2] is None else t[2], t[3])
    got = sorted(((r.g, r.name, r.v, r.rank) for r in top_k_dense(df, ["g"], "v", k).collect()), key=key)
    expect = []
    for g in {r[0] for r in rows}:
        values = [r[2] for r in rows if r[0] == g]
        order = ([None] if None in values else []) + sorted({v for v in values if v is not None}, reverse=True)
        rank_of = {v: i + 1 for i, v in enumerate(order)}
        expect += [(g, n, v, rank_of[v]) for gg, n, v in rows if gg == g and rank_of[v] <= k]
    assert got == sorted(expect, key=key)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(months=st.sets(st.integers(0, 40), min_size=1, max_size=15))
def test_month_gaps_property(spark, months):
    import datetime as dt

    def month(i):
        return dt.datetime(2019 + i // 12, i % 12 + 1, 1)

    df = spark.createDataFrame([(month(i) + dt.timedelta(days=3),) for i in months], "t timestamp_ntz")
    got = sorted(r.month for r in audit.month_gaps(df, "t").collect())
    expect = [month(i) for i in range(min(months), max(months) + 1) if i not in months]
    assert got == expect
