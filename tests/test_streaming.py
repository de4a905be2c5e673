"""Streaming upsert across micro-batches, and the batch latest-per-key rule."""

import datetime as dt
import json
import os

import pytest

from tillroll.operators.upsert import latest_per_key, merge_latest
from tillroll.sources import schemas as S
from tillroll.sources.documents import load_users
from tillroll.streaming.upsert import document_stream, read_latest, start_upsert_stream, upsert_batch


def _user(uid, day, role):
    return {"_id": {"$oid": uid}, "createdDate": {"$date": 1609459200000 + day * 86_400_000}, "role": role}


def _drop(folder, name, docs):
    tmp = os.path.join(folder, f".{name}.tmp")
    with open(tmp, "w") as f:
        f.write("\n".join(json.dumps(d) for d in docs))
    os.replace(tmp, os.path.join(folder, name))


def test_stream_upsert_keeps_latest(spark, scratch):
    src = os.path.join(scratch, "incoming")
    os.makedirs(src)
    target = os.path.join(scratch, "users_latest")
    ckpt = os.path.join(scratch, "stream-ckpt")
    opts = {"pathGlobFilter": "*.json"}

    def run():
        q = start_upsert_stream(
            document_stream(spark, src, S.USER, options=opts), target, "id", "created_date",
            checkpoint_location=ckpt, buckets=4, transform=load_users,
        )
        q.awaitTermination()

    # a hot key: u1 has many versions in one batch
    _drop(src, "batch1.json", [_user("u1", d, f"v{d}") for d in range(50)] + [_user("u2", 1, "a")])
    run()
    got = {r.id: r.role for r in read_latest(spark, target).collect()}
    assert got == {"u1": "v49", "u2": "a"}

    # a later batch updates u2, adds u3, and carries an older u1 version that must lose
    _drop(src, "batch2.json", [_user("u2", 5, "b"), _user("u3", 2, "c"), _user("u1", 3, "old")])
    run()
    got = {r.id: (r.role, r.created_date) for r in read_latest(spark, target).collect()}
    assert got == {
        "u1": ("v49", dt.datetime(2021, 1, 1) + dt.timedelta(days=49)),
        "u2": ("b", dt.datetime(2021, 1, 6)),
        "u3": ("c", dt.datetime(2021, 1, 3)),
    }
    # re-running with nothing new changes nothing
    run()
    assert read_latest(spark, target).count() == 3
    typed = read_latest(spark, target, load_users(spark.createDataFrame([], S.USER)).schema)
    assert sorted(r.id for r in typed.collect()) == ["u1", "u2", "u3"]


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, 10, "x"), ("a", 2, 11, "y"), ("a", 2, 12, "z"), ("b", None, 1, "n"), ("b", 0, 2, "m"), ("c", None, 3, "q")],
        "k string, t int, id int, v string",
    )
    got = {r.k: (r.t, r.id, r.v) for r in latest_per_key(df, "k", "t", tie_breakers=("id",)).collect()}
    assert got == {"a": (2, 12, "z"), "b": (0, 2, "m"), "c": (None, 3, "q")}
    assert latest_per_key(df, "k", "t").columns == df.columns
    changes = spark.createDataFrame([("a", 3, 1, "new")], "k string, t int, id int, v string")
    merged = {r.k: r.v for r in merge_latest(df, changes, "k", "t", ("id",)).collect()}
    assert merged == {"a": "new", "b": "m", "c": "q"}


def test_bucket_count_is_stored_and_unreadable_targets_are_errors(spark, tmp_path):
    target = str(tmp_path / "latest")
    rows = spark.createDataFrame([(k, 1) for k in range(40)], "k int, v int")
    upsert_batch(rows, target, "k", "v", buckets=4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")  # another session setting
    try:
        for k in range(6):
            upsert_batch(spark.createDataFrame([(k, 2)], "k int, v int"), target, "k", "v")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = {r.k: r.v for r in read_latest(spark, target, "k int, v int").collect()}
    assert got == {k: 2 if k < 6 else 1 for k in range(40)}
    assert read_latest(spark, target, "k int, v int").count() == 40
    with pytest.raises(ValueError):
        upsert_batch(rows, target, "k", "v", buckets=5)
    for broken in (tmp_path / "latest").glob("latest/*/_bucket=0/*.parquet"):
        broken.write_bytes(b"not parquet")
        for crc in broken.parent.glob("*.crc"):
            crc.unlink()
    with pytest.raises(Exception):  # at the latest when the deltas are merged with it
        upsert_batch(spark.createDataFrame([(k, 3) for k in range(40)], "k int, v int"), target, "k", "v")
        read_latest(spark, target).collect()
    assert list((tmp_path / "latest").glob("latest/*/_bucket=1/*.parquet"))
