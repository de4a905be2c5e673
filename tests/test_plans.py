"""Plan shape of the registered queries: the properties that matter at scale."""

import re

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF001
from tillroll.plans.inspect import plan_text, pushed_filters, read_schemas, summary

QUERIES = entry_mod.queries()
BATCH = sorted(n for n in QUERIES if not n.endswith("_stream"))


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_no_python(spark, name):
    s = summary(QUERIES[name](spark, SF001))
    assert s["cross_joins"] == 0, name
    assert s["python"] == 0, name


def test_month_window_reaches_the_scan(spark):
    df = QUERIES["top_brands_by_month"](spark, SF001)
    orders_scan = [f for f in pushed_filters(df) if "o_orderdate" in f]
    assert orders_scan and "GreaterThanOrEqual(o_orderdate" in orders_scan[0] and "LessThan(o_orderdate" in orders_scan[0]


def test_top_k_uses_partial_window_group_limit(spark):
    text = plan_text(QUERIES["top_brands_month_over_month"](spark, SF001))
    assert re.search(r"WindowGroupLimit .*Partial", text) and re.search(r"WindowGroupLimit .*Final", text)


def test_scans_are_pruned(spark):
    # Q1 reads two lineitem columns, not eleven.
    schemas = read_schemas(QUERIES["top_brands_by_month"](spark, SF001))
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") <= 3 for s in lineitem)


def test_distributed_rank_has_no_single_partition_exchange_over_rows(spark):
    from tillroll.operators.rank import global_dense_rank

    df = spark.range(5000).selectExpr("id", "id % 97 as v")
    text = plan_text(global_dense_rank(df, "v"))
    blocks = text.split("Exchange SinglePartition")[1:]
    # the only single-partition exchange carries the counts of the ranges
    assert len(blocks) == 1 and "_range" in "".join(blocks[0].split("\n")[1:3])
    # the ranges are data by now: no plan that could draw their bounds anew
    assert "rangepartitioning" not in text.lower() and "monotonically" not in text


def test_latest_per_key_is_an_aggregation_not_a_window(spark):
    text = plan_text(QUERIES["latest_event_per_user"](spark, SF001))
    assert "Window" not in text and "partial_max" in text
