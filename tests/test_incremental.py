"""The incremental load against plain Python, and stored distinct counts."""

import datetime as dt
import json
import os
import random

import pytest

from tillroll.operators import rollups
from tillroll.plans import incremental
from tillroll.sources import schemas as S
from tillroll.sources.documents import parse_documents
from tillroll.sources.snapshots import Change, Conflict, Snapshots

DAY = 86_400_000


def _receipt(rid, version, items, deleted=False, status="FINISHED"):
    doc = {"_id": {"$oid": rid}, "rewardsReceiptStatus": status, "createDate": {"$date": DAY}, "db_last_modified": {"$date": version * DAY}}
    if items is not None:
        doc["rewardsReceiptItemList"] = [{"brandCode": b} for b in items]
    return {**doc, "deleted": True} if deleted else doc


def _docs(spark, rows, source="receipts"):
    text = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    return parse_documents(text, incremental.SCHEMAS[source])


def _now(spark, root):
    t = incremental.current_tables(spark, root)
    lines = {}
    for r in t.items.collect():
        lines.setdefault(r.receipt_id, []).append((r.line_no, r.brand_code))
    return {r.id: (r.status, [b for _, b in sorted(lines.get(r.id, []))]) for r in t.receipts.collect()}, set(lines)


def test_batches_in_any_order_give_the_latest_documents(spark, scratch):
    rng = random.Random(4)
    root, latest = os.path.join(scratch, "store"), {}
    for batch in range(4):
        rows = []
        for _ in range(12):
            rid, version = f"r{rng.randrange(6)}", rng.randrange(9)
            # One document a version, so that equal versions are deliveries of one.
            own = random.Random(f"{rid}/{version}")
            doc = _receipt(rid, version, own.choice([None, [], ["A"], ["A", "B", "C"], ["B", "B"]]), own.random() < 0.2, own.choice(["FINISHED", "PENDING"]))
            rows.append(doc)
            if version >= latest.get(rid, (-1,))[0]:
                latest[rid] = (version, doc)
        rows.append({"_id": {"$oid": ""}, "db_last_modified": {"$date": 0}})
        incremental.apply_batch(spark, root, "receipts", _docs(spark, rows), buckets=2)
        got, with_items = _now(spark, root)
        expect = {
            rid: (d["rewardsReceiptStatus"], [i["brandCode"] for i in d.get("rewardsReceiptItemList", [])])
            for rid, (_, d) in latest.items() if not d.get("deleted")
        }
        assert got == expect and with_items <= set(got)
    # The same batch again under the number of one that is stored is passed over.
    incremental.apply_batch(spark, root, "receipts", _docs(spark, [_receipt("new", 1, [])]), "s", 3)
    incremental.apply_batch(spark, root, "receipts", _docs(spark, [_receipt("newer", 1, [])]), "s", 3)
    assert "new" in _now(spark, root)[0] and "newer" not in _now(spark, root)[0]


def test_a_batch_that_meets_another_writer_is_merged_again(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "store")
    incremental.apply_batch(spark, root, "receipts", _docs(spark, [_receipt("a", 1, ["A"])]), buckets=2)
    commit, met = Change.commit, []

    def late(self, source=None, batch=None):
        if not met:
            met.append(1)
            other = Snapshots(spark, root).change()
            incremental.take_in(other, "receipts", _docs(spark, [_receipt("b", 1, ["B"]), _receipt("a", 3, ["X"])]))
            commit(other)
        return commit(self, source, batch)

    monkeypatch.setattr(Change, "commit", late)
    incremental.apply_batch(spark, root, "receipts", _docs(spark, [_receipt("a", 2, ["A", "A"]), _receipt("c", 1, [])]))
    assert _now(spark, root)[0] == {"a": ("FINISHED", ["X"]), "b": ("FINISHED", ["B"]), "c": ("FINISHED", [])}
    monkeypatch.setattr(incremental, "TRIES", 1)
    met.clear()
    with pytest.raises(Conflict):
        incremental.apply_batch(spark, root, "receipts", _docs(spark, [_receipt("d", 1, [])]))


def test_document_files_stream_into_all_tables(spark, scratch):
    root = os.path.join(scratch, "store")
    batches = [
        {"receipts": [_receipt("r", 1, ["A", "B"])], "users": [{"_id": {"$oid": "u"}, "role": "x"}], "brands": [{"_id": {"$oid": "b"}, "brandCode": "A", "barcode": "007"}]},
        {"receipts": [_receipt("r", 2, ["C"])], "users": [{"_id": {"$oid": "u"}, "role": "y", "db_last_modified": {"$date": 5}}], "brands": []},
    ]
    for n, batch in enumerate(batches):
        for source, docs in batch.items():
            folder = os.path.join(scratch, source)
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{n}.json", "w") as f:
                f.write("\n".join(json.dumps(d) for d in docs))
            incremental.start_load_stream(spark, source, folder, root, os.path.join(scratch, f"stream-{source}"), buckets=2).awaitTermination()
    t = incremental.current_tables(spark, root)
    assert [(r.receipt_id, r.line_no, r.brand_code) for r in t.items.collect()] == [("r", 1, "C")]
    assert [(r.id, r.role) for r in t.users.collect()] == [("u", "y")]
    assert [(r.id, r.barcode, r.barcode_text) for r in t.brands.collect()] == [("b", 7, "007")]
    assert "_modified" not in t.receipts.columns and "_deleted" not in t.users.columns
    assert incremental.current_tables(spark, os.path.join(scratch, "none")).receipts is None
    assert set(incremental.SCHEMAS["users"].fieldNames()) == {*S.USER.fieldNames(), "db_last_modified", "deleted"}


def test_stored_counts_equal_plain_sets(spark, scratch):
    rng = random.Random(9)
    store = Snapshots(spark, os.path.join(scratch, "counts"))
    receipts = [(f"r{i}", dt.datetime(2021, rng.randrange(1, 4), rng.randrange(1, 28), rng.randrange(24))) for i in range(60)]
    items = [(f"r{rng.randrange(70)}", rng.choice(["A", "B", "C", "Z", None])) for _ in range(300)]
    brands = [("A", "One"), ("B", "Two"), ("C", "Two")]
    item_rows = spark.createDataFrame(items, "receipt_id string, brand_code string")
    brand_rows = spark.createDataFrame(brands, "brand_code string, name string")
    # Out of order, with receipts that come again, and a batch that is run twice.
    for number, part in [(0, receipts[20:40]), (1, receipts[:25]), (1, receipts[:25]), (2, [*receipts[35:], (None, None), receipts[0], receipts[0]])]:
        rows = spark.createDataFrame(part, "id string, create_date timestamp_ntz")
        rollups.add_receipts(store, rows, item_rows, brand_rows, "s", number)
    created, names = dict(receipts), dict(brands)
    seen = {(created[r], names[b], r) for r, b in items if r in created and b in names}
    expect = {}
    for when, name, r in seen:
        expect.setdefault((dt.datetime(2021, when.month, 1), name), set()).add(r)
    got = {(r.month, r.brand_name): r.total_receipts for r in rollups.receipts_by_brand(store).collect()}
    assert got == {k: len(v) for k, v in expect.items()}
    near = {(r.month, r.brand_name): r.estimate for r in rollups.estimated_receipts_by_brand(store).collect()}
    assert near == got  # few values are counted exactly by a sketch, too
    within = rollups.branded_receipts(store, "2021-02-03", "2021-02-20").first()
    days = {r for when, _, r in seen if dt.datetime(2021, 2, 3) <= when < dt.datetime(2021, 2, 20)}
    assert (within.total_with_brand, within.estimate) == (len(days), len(days))
    none = rollups.branded_receipts(store, "2031-01-01", "2031-02-01").first()
    assert (none.total_with_brand, none.estimate) == (0, 0)
    numbers = sorted(r.number for r in store.read(rollups.NUMBERS).collect())
    assert numbers == list(range(1, 61))
