"""What the loading queries shuffle and write, and that their rows are whole."""

from __future__ import annotations

import glob
import gzip
import json
import os
import random

from pyspark.sql import functions as F

from tillroll.plans import catalog, incremental
from tillroll.sources import arrays, sinks, snapshots
from tillroll.sources import schemas as S
from tillroll.sources.arrays import read_arrays
from tillroll.sources.documents import drop_nulls, parse_documents
from tillroll.sources.roundtrip import ITEM_COLUMNS, item_lists, receipt_documents, write_arrays
from tillroll.sources.snapshots import Snapshots, latest_rows
from tillroll.sources.tables import ITEM_FIELDS_OF_LINE, ITEM_FIELDS_WRITTEN, with_fields

_ITEMS = (
    "receipt_id long, line_no int, brand_code string, description string, final_price double, quantity_purchased long, "
    "user_flagged_quantity long, user_flagged_price string, original_meta_brite_item_price string"
)


def _items(spark):
    rows = [(r, n, f"B{n}", None, n / 4 if n and n % 3 else None, n, None, None, None) for r in (1, 2, None) for n in (7, 3, 3, 1, 2, None)]
    return spark.createDataFrame(rows, _ITEMS)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _texts(lists):
    return [(r[0], [i.asDict() for i in r[1]]) for r in lists.collect()]


def test_items_are_dealt_before_they_are_rendered(spark):
    items = _items(spark)
    wide = item_lists(with_fields(items, ITEM_FIELDS_WRITTEN))
    narrow = item_lists(items, more=ITEM_FIELDS_OF_LINE)
    plan = _plan(narrow)
    assert sorted(_texts(narrow), key=lambda r: str(r[0])) == sorted(_texts(wide), key=lambda r: str(r[0]))
    below = plan[plan.index("Exchange hashpartitioning(receipt_id") :]
    assert "collect_list" not in below and "needsFetchReview" not in below and "Exchange" not in plan[: plan.index("collect_list")]
    docs = receipt_documents(spark.createDataFrame([(1, "x"), (3, "y")], "id long, status string"), items, item_fields=ITEM_FIELDS_OF_LINE)
    sizes = {r[0]: r[1] for r in parse_documents(docs, S.RECEIPT).select("_id.$oid", F.size("rewardsReceiptItemList")).collect()}
    assert sizes["1"] == 6 and set(sizes) == {"1", "3"} and len(ITEM_COLUMNS) == 8


def test_structs_without_arrays_are_not_rebuilt(spark):
    docs = spark.createDataFrame([([("a", None), None], ([[1, None], None],)), (None, None)], "l array<struct<x: string, y: string>>, s struct<n: array<array<int>>>")
    kept = drop_nulls(docs)
    assert [(r.l, r.s) for r in kept.select("l").crossJoin(kept.select("s")).collect()][0] == ([("a", None)], ([[1]],))
    assert "transform" not in _plan(kept.select("l")) and "transform" in _plan(kept.select("s"))


def test_array_files_hold_so_many_documents_at_most(spark, scratch):
    docs = spark.range(0, 11, 1, 2).select(F.format_string('{"_id":{"$oid":"%d"}}', "id").alias("value"))
    for kind, suffix, most in (("none", ".txt", 2), ("gzip", ".gz", 3), ("none", ".txt", 100), ("none", ".txt", 5)):
        folder = os.path.join(scratch, f"arrays-{kind}-{most}")
        write_arrays(docs, folder, most, kind)
        opened = gzip.open if kind == "gzip" else open
        files = [json.loads(opened(f, "rt").read()) for f in glob.glob(f"{folder}/*{suffix}")]
        assert max(map(len, files)) <= most and sum(map(len, files)) == 11 and len(files) >= 2
        read, _ = read_arrays(spark, folder, S.RECEIPT)
        assert sorted(int(r[0]) for r in read.select("_id.$oid").collect()) == list(range(11))
    write_arrays(docs.limit(0), os.path.join(scratch, "none"), 2)
    assert read_arrays(spark, os.path.join(scratch, "none"), S.RECEIPT)[0].count() == 0


def test_a_batch_keeps_one_version_of_each_document(spark):
    texts = [json.dumps({"db_last_modified": {"$date": day}, "_id": {"$oid": key}, "rewardsReceiptStatus": f"s{day}"} | ({} if day else {"deleted": True}))
             for key in ("a", "b", "") for day in (2, 1, 2, 0)]
    docs = parse_documents(spark.createDataFrame([(t,) for t in texts], "value string"), incremental.SCHEMAS["receipts"])
    latest = incremental.latest_documents(docs)
    assert sorted((r[0], r[1]) for r in latest.select("_id.$oid", "rewardsReceiptStatus").collect()) == [("a", "s2"), ("b", "s2")]


def test_lines_of_few_versions_are_shuffled_once(spark):
    rows = [("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 2, 1, "z"), ("a", 2, 1, "z"), ("a", 2, None, None), ("b", 1, None, None), (None, 1, 1, "n"), ("b", None, 1, "o")]
    df = spark.createDataFrame(rows, "k string, v int, line int, text string")
    many, few = (latest_rows(df, ["k"], ["v"], "line", few=f) for f in (False, True))
    assert _plan(few).count("Exchange hashpartitioning") == 1 < _plan(many).count("Exchange hashpartitioning")
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_compressed_array_files_are_read_once(spark, scratch, monkeypatch):
    def twice(parts):
        for part in parts:
            raise AssertionError(f"{part.num_rows} pieces were read before they are cut")
        yield from ()

    folder = os.path.join(scratch, "whole")
    docs = spark.range(0, 9, 1, 2).select(F.format_string('{"_id":{"$oid":"%d"},"userId":"\\\\\\"}{[%s"}', "id", F.repeat(F.lit("\\"), 40)).alias("value"))
    write_arrays(docs, folder, 4, "gzip")
    with gzip.open(os.path.join(folder, "lines.json.gz"), "wt") as f:
        f.write(' {"_id":{"$oid":"9"}}\n{"_id":{"$oid":"10"},"rewardsReceiptItemList":[{"itemNumber":"1"}]}')
    with gzip.open(os.path.join(folder, "cut.json.gz"), "wt") as f:
        f.write('[{"_id":{"$oid":"11"}},{"_id":{"$oid":"12"},"userId":"cut')
    monkeypatch.setattr(arrays, "_summaries", twice)
    read, _ = read_arrays(spark, folder, S.RECEIPT, on_corrupt="keep")
    rows = read.select("_id.$oid", "userId", "_corrupt_record").collect()
    assert sorted(int(r[0]) for r in rows if r[2] is None) == list(range(12))
    assert {r[1] for r in rows if r[0] and int(r[0]) < 9} == {'\\"}{[' + "\\" * 20} and [r[2][:5] for r in rows if r[2]] == ['{"_id']


def test_quotes_behind_any_number_of_backslashes():
    rng = random.Random(7)
    for n in range(200):
        text = "".join(rng.choice(['"', "\\", "{", "}", "x", "\\" * rng.choice([1, 2, 17, 40])]) for _ in range(60)).encode()
        inside, want = False, []
        for at, c in enumerate(text.decode()):
            run = len(text[:at]) - len(text[:at].rstrip(b"\\"))
            if c == '"' and run % 2 == 0:
                inside = not inside
            elif c in "{}":
                want.append((at, 1 if c == "{" else -1, inside))
        found = arrays.marks(text)
        assert list(zip(found.at.tolist(), found.step.tolist(), found.odd.tolist())) == want and found.flips == inside


def test_source_documents_move_the_tables_columns(spark):
    plan = _plan(catalog._receipt_source(spark, "/root/testdata/sf0.001"))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and all("o_orderkey" in line or "l_orderkey" in line for line in moved)


def test_a_batch_is_moved_in_rounds(spark, scratch, monkeypatch):
    def batch(day, keys, lines):
        texts = [json.dumps({"db_last_modified": {"$date": day}, "_id": {"$oid": k}, "rewardsReceiptItemList": [{"itemNumber": f"{day}.{n}"} for n in range(lines)]}) for k in keys]
        return parse_documents(spark.createDataFrame([(t,) for t in texts], "value string"), incremental.SCHEMAS["receipts"])

    found = []
    for size in (1, 1 << 30):
        monkeypatch.setattr(snapshots, "ROUND_BYTES", size)
        root = os.path.join(scratch, f"rounds-{size}")
        for day, keys, lines in ((1, "abcdefgh", 3), (2, "abcd", 1), (1, "aei", 2)):
            incremental.apply_batch(spark, root, "receipts", batch(day, keys, lines), buckets=8)
        store = Snapshots(spark, root)
        shuffled = {f.split("/v=")[1].split("/")[0] for f in store.folders("rewards_receipt_items", 1)}
        assert (len(shuffled) > 1) == (size == 1)
        rows = lambda: sorted(map(str, incremental.current_tables(spark, root).items.select("receipt_id", "line_no", "item_number").collect()))  # noqa: E731, B023
        found.append(rows())
        incremental.compact(spark, root)
        parts = store.manifest()["tables"]["rewards_receipt_items"]["parts"]
        assert rows() == found[-1] and all(len(p) == 1 for p in parts.values()) and len(store.versions()) == 1
    assert found[0] == found[1] and len(found[0]) == 4 * 1 + 4 * 3 + 2
    incremental.apply_batch(spark, os.path.join(scratch, "none"), "receipts", batch(1, "", 1), buckets=8)


def test_lines_of_a_key_stand_together(spark, scratch, monkeypatch):
    monkeypatch.setattr(snapshots, "LINE_BLOCK", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(f"k{k}", 1, n) for n in range(4) for k in range(50)] + [("long", 1, n) for n in range(3000)]
    change = Snapshots(spark, os.path.join(scratch, "lines")).change()
    change.upsert("t", spark.createDataFrame(rows, "k string, v int, line int").repartition(4), "k", "v", 2, line="line", merged=True)
    change.commit()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    written = Snapshots(spark, os.path.join(scratch, "lines")).read("t").withColumn("f", F.input_file_name())
    files = {r[0]: r[1] for r in written.groupBy("k").agg(F.countDistinct("f")).collect()}
    assert written.count() == 3200 and files.pop("long") > 1 and set(files.values()) == {1}


def test_shuffle_files_go_with_their_job(spark):
    before = spark.conf.get(sinks.FREE_SHUFFLES, None)
    with sinks.freed_shuffles(spark):
        assert spark.conf.get(sinks.FREE_SHUFFLES) == "true"
    assert spark.conf.get(sinks.FREE_SHUFFLES, None) == before
