"""Document loaders on hand-made edge documents (FIXTURES.md section 2)."""

import datetime as dt
import json
import os

import pytest

from tillroll.sources import schemas as S
from tillroll.sources.documents import (
    CORRUPT,
    drop_null_elements,
    explode_outer_items,
    load_brands,
    load_items,
    load_receipts,
    load_users,
    read_documents,
)

RECEIPTS = [
    {
        "_id": {"$oid": "r1"},
        "userId": "u1",
        "rewardsReceiptStatus": "FINISHED",
        "createDate": {"$date": 1614556799999},
        "dateScanned": {"$date": 1614556799999},
        "modifyDate": {"$date": 1614556800000},
        "purchasedItemCount": 3,
        "totalSpent": "10.00",
        "rewardsReceiptItemList": [
            {"barcode": "4011", "finalPrice": "$1.50", "quantityPurchased": 1, "brandCode": "B1",
             "needsFetchReview": False, "priceAfterCoupon": "1.25"},
            {"finalPrice": "1.50", "userFlaggedQuantity": 2, "userFlaggedPrice": "2.00",
             "description": "ITEM NOT FOUND", "lateField": "ignored"},
            {"finalPrice": "", "pointsEarned": "abc", "targetPrice": "1.5d"},
        ],
    },
    {"_id": {"$oid": "r2"}, "userId": "u2", "createDate": None, "rewardsReceiptItemList": None},
    {"_id": {"$oid": "r3"}, "userId": "u2", "rewardsReceiptItemList": []},
    {"userId": "u3", "rewardsReceiptItemList": [{"finalPrice": "5"}]},
    {"_id": {"$oid": ""}, "rewardsReceiptItemList": [{"finalPrice": "6"}]},
    {"_id": {"$oid": "r6"}, "finishedDate": None, "purchaseDate": {"$date": 0}},
]

USERS = [
    {"_id": {"$oid": "u1"}, "active": True, "createdDate": {"$date": 1609459200000},
     "lastLogin": {"$date": 1609459260000}, "role": "consumer", "signUpSource": "Email", "state": "WI"},
    {"_id": {"$oid": "u2"}, "createdDate": {"$date": 1612137600000}, "role": None},
]

BRANDS = [
    {"_id": {"$oid": "b1"}, "barcode": "511111519874", "brandCode": "B1", "name": "One",
     "cpg": {"$ref": "Cogs", "$id": {"$oid": "c1"}}, "topBrand": True},
    {"_id": {"$oid": "b2"}, "barcode": "0012", "name": "Two"},
    {"_id": {"$oid": "b3"}, "barcode": "B07X", "cpg": {"$ref": "Cpgs"}},
    {"_id": {"$oid": "b4"}, "barcode": "12.5"},
]


def _write(folder, name, docs, lines=False):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        if lines:
            f.write("\n".join(json.dumps(d) for d in docs))
        else:
            json.dump(docs, f)
    return path


def test_receipts_table(spark, scratch):
    docs = read_documents(spark, _write(scratch, "receipts.json", RECEIPTS), S.RECEIPT)
    rows = {r.id: r for r in load_receipts(docs).collect()}
    assert len(load_receipts(docs).columns) == 14
    assert set(rows) == {"r1", "r2", "r3", None, "", "r6"}
    r1 = rows["r1"]
    assert r1.create_date == dt.datetime(2021, 2, 28, 23, 59, 59, 999000)
    assert r1.modify_date == dt.datetime(2021, 3, 1)
    assert r1.status == "FINISHED" and r1.purchased_item_count == 3 and r1.total_spent == "10.00"
    assert rows["r2"].create_date is None  # explicit null date: row kept
    assert rows["r6"].finished_date is None and rows["r6"].purchase_date == dt.datetime(1970, 1, 1)
    kept = load_receipts(docs, drop_missing_id=True)
    assert sorted(r.id for r in kept.collect()) == ["r1", "r2", "r3", "r6"]


def test_items_table(spark, scratch):
    docs = read_documents(spark, _write(scratch, "receipts.json", RECEIPTS), S.RECEIPT)
    items = load_items(docs)
    rows = items.orderBy("line_no").collect()
    # r2 (null list), r3 (empty list), missing id and empty id are skipped.
    assert [(r.receipt_id, r.line_no) for r in rows] == [("r1", 1), ("r1", 2), ("r1", 3)]
    assert [r.final_price for r in rows] == [1.5, 1.5, None]
    assert rows[0].price_after_coupon == 1.25 and rows[0].needs_fetch_review is False
    assert rows[1].user_flagged_price == "2.00" and rows[1].description == "ITEM NOT FOUND"
    assert rows[2].points_earned is None and rows[2].target_price is None
    assert "late_field" not in items.columns
    literal = load_items(docs, strip_dollar=False).orderBy("line_no").collect()
    assert [r.final_price for r in literal] == [None, 1.5, None]
    # invariant: item rows = sum of list sizes over receipts with a non-empty id
    expected = sum(len(d.get("rewardsReceiptItemList") or []) for d in RECEIPTS if (d.get("_id") or {}).get("$oid"))
    assert items.count() == expected


def test_json_lines_equal_array(spark, scratch):
    a = read_documents(spark, _write(scratch, "a.json", RECEIPTS), S.RECEIPT)
    b = read_documents(spark, _write(scratch, "b.json", RECEIPTS, lines=True), S.RECEIPT, multiline=False)
    assert sorted(map(tuple, load_items(a).collect())) == sorted(map(tuple, load_items(b).collect()))


def test_users_and_brands(spark, scratch):
    users = load_users(read_documents(spark, _write(scratch, "users.json", USERS), S.USER))
    u = {r.id: r for r in users.collect()}
    assert u["u1"].created_date == dt.datetime(2021, 1, 1) and u["u1"].last_login == dt.datetime(2021, 1, 1, 0, 1)
    assert u["u2"].last_login is None and u["u2"].role is None and u["u2"].active is None
    brands = load_brands(read_documents(spark, _write(scratch, "brands.json", BRANDS), S.BRAND))
    b = {r.id: r for r in brands.collect()}
    assert [b[k].barcode for k in ("b1", "b2", "b3", "b4")] == [511111519874, 12, None, None]
    assert b["b2"].barcode_text == "0012"
    assert (b["b1"].cpg_ref, b["b1"].cpg_id) == ("Cogs", "c1")
    assert (b["b3"].cpg_ref, b["b3"].cpg_id) == ("Cpgs", None)
    assert b["b2"].cpg_ref is None


def test_missing_path(spark, scratch):
    missing = os.path.join(scratch, "nope.json")
    empty = read_documents(spark, missing, S.USER, on_missing="empty")
    assert empty.count() == 0 and empty.schema == S.USER
    with pytest.raises(Exception):
        read_documents(spark, missing, S.USER).count()


def test_truncated_file(spark, scratch):
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write(json.dumps(USERS)[:-20])
    with pytest.raises(Exception):
        read_documents(spark, path, S.USER).collect()
    kept = read_documents(spark, path, S.USER, on_corrupt="keep").collect()
    assert len(kept) == 1 and kept[0][CORRUPT] is not None and kept[0]["_id"] is None
    assert read_documents(spark, path, S.USER, on_corrupt="drop").count() == 0


def test_exploration_helpers(spark, scratch):
    docs = read_documents(spark, _write(scratch, "receipts.json", RECEIPTS), S.RECEIPT)
    outer = explode_outer_items(docs)
    # r1 has 3 items; every other document gives one row with a NULL item.
    assert outer.count() == 3 + 5
    with_nulls = spark.createDataFrame(
        [("r", [{"barcode": "1"}, None])], "id string, rewardsReceiptItemList array<struct<barcode:string>>"
    )
    compact = drop_null_elements(with_nulls).first()
    assert len(compact.rewardsReceiptItemList) == 1


def test_inferred_schema_loads_like_declared(spark, scratch):
    path = _write(scratch, "receipts.json", RECEIPTS)
    declared = read_documents(spark, path, S.RECEIPT)
    inferred = read_documents(spark, path, None)
    # fields such as pointsAwardedDate never occur, so they are absent from the inferred schema
    assert "pointsAwardedDate" not in inferred.columns
    for load in (load_receipts, load_items):
        a, b = load(declared), load(inferred)
        assert a.schema == b.schema
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    users = _write(scratch, "users.json", USERS)
    assert load_users(read_documents(spark, users, None)).schema == load_users(read_documents(spark, users, S.USER)).schema
    brands = _write(scratch, "brands.json", BRANDS)
    got = sorted(map(tuple, load_brands(read_documents(spark, brands, None)).collect()), key=repr)
    assert got == sorted(map(tuple, load_brands(read_documents(spark, brands, S.BRAND)).collect()), key=repr)


def test_gzip_json_lines(spark, scratch):
    import gzip

    path = os.path.join(scratch, "receipts.json.gz")
    with gzip.open(path, "wt") as f:
        f.write("\n".join(json.dumps(d) for d in RECEIPTS))
    docs = read_documents(spark, path, S.RECEIPT, multiline=False)
    plain = read_documents(spark, _write(scratch, "plain.json", RECEIPTS), S.RECEIPT)
    assert sorted(map(tuple, load_items(docs).collect())) == sorted(map(tuple, load_items(plain).collect()))


def test_only_the_absent_paths_of_a_list_drop_out(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"_id": {"$oid": "1"}}, {"_id": {"$oid": "2"}}]')
    paths = [str(tmp_path / "a.json"), str(tmp_path / "absent.json")]
    assert read_documents(spark, paths, S.USER, on_missing="empty").count() == 2
