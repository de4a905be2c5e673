"""Versioned stores: what goes live, what a lost commit leaves, and loads that fail half way."""

import os
import shutil

import pytest

from tests.test_batch_load import BRANDS, RECEIPTS, USERS, _sources
from tillroll.plans import batch_load
from tillroll.plans.batch_load import LoadedTables, load_all
from tillroll.sources.snapshots import MOST_DELTAS, Conflict, Files, Snapshots
from tillroll.streaming.upsert import read_latest, upsert_batch


def _rows(spark, pairs):
    return spark.createDataFrame(pairs, "k int, t int, v string")


def _latest(df):
    return {r.k: r.v for r in df.collect()}


def test_a_lost_commit_leaves_the_table_and_its_batch_can_run_again(spark, scratch, monkeypatch):
    target = os.path.join(scratch, "t")
    upsert_batch(_rows(spark, [(k, 1, "first") for k in range(30)]), target, "k", "t", buckets=4, source="s", epoch=0)
    second = _rows(spark, [(k, 2, "second") for k in range(10, 40)])

    def lost(self, path, text):
        # The driver goes away between the data and the manifest, and a folder
        # that the batch had written goes with it.
        written = [d for d in os.listdir(f"{target}/latest") if d not in named]
        shutil.rmtree(f"{target}/latest/{written[0]}/_bucket=0", ignore_errors=True)
        raise OSError("lost")

    named = os.listdir(f"{target}/latest")
    with monkeypatch.context() as m:
        m.setattr(Files, "create", lost)
        with pytest.raises(OSError, match="lost"):
            upsert_batch(second, target, "k", "t", source="s", epoch=1)
    assert _latest(read_latest(spark, target)) == {k: "first" for k in range(30)}
    for _ in range(2):  # run again, and once more after it was committed
        upsert_batch(second, target, "k", "t", source="s", epoch=1)
        assert _latest(read_latest(spark, target)) == {k: "second" if k >= 10 else "first" for k in range(40)}
    store = Snapshots(spark, target)
    assert store.versions() == [1, 2] and store.change().done("s") == 1
    assert _latest(store.read("latest", version=1)) == {k: "first" for k in range(30)}


def test_deltas_are_merged_by_readers_and_rewritten_when_they_have_grown(spark, scratch):
    store = Snapshots(spark, os.path.join(scratch, "t"))
    expect = {}
    for step in range(MOST_DELTAS + 4):
        rows = [(k, step if k % 3 else -step, f"v{step}") for k in (range(2000) if step == 0 else range(step, step + 5))]
        for k, t, v in rows:
            if k not in expect or t > expect[k][0]:
                expect[k] = (t, v)
        change = store.change()
        change.upsert("latest", _rows(spark, rows), "k", ["t", "v"], buckets=2)
        change.commit()
        assert _latest(store.read("latest")) == {k: v for k, (_, v) in expect.items()}
        parts = store.manifest()["tables"]["latest"]["parts"]
        assert all(len(p) <= 1 + MOST_DELTAS for p in parts.values())
    first = store.manifest(1)["tables"]["latest"]["parts"]
    assert any(store.manifest()["tables"]["latest"]["parts"][b][0] != first[b][0] for b in first)  # rewritten
    live = set(store.folders("latest")) | set(store.folders("latest", store.versions()[-2]))
    gone = store.vacuum(keep=2)
    assert gone and len(store.versions()) == 2 and all(os.path.isdir(f) for f in live)
    assert _latest(store.read("latest")) == {k: v for k, (_, v) in expect.items()}
    with pytest.raises(ValueError, match="buckets"):
        store.change().upsert("latest", _rows(spark, []), "k", ["t", "v"], buckets=3)
    with pytest.raises(ValueError, match="kept by"):
        store.change().upsert("latest", _rows(spark, []), "k", "t")
    with pytest.raises(ValueError, match="no table"):
        store.read("other")


def test_of_two_writers_one_must_start_again(spark, scratch):
    store = Snapshots(spark, os.path.join(scratch, "t"))
    one, two = store.change(), store.change()
    one.replace("a", spark.range(3))
    two.replace("a", spark.range(5))
    assert one.commit() == 1
    with pytest.raises(Conflict):
        two.commit()
    assert store.read("a").count() == 3 and store.tables() == ["a"]
    third = store.change()
    third.append("a", spark.range(10, 12))
    third.replace("b", spark.range(1))
    third.commit()
    assert store.read("a").count() == 5 and store.tables() == ["a", "b"] and store.tables(1) == ["a"]
    # What was never named goes when it is old enough, and not before.
    assert store.vacuum() == []
    assert [g.split("/")[0] for g in store.vacuum(orphans_after_hours=-1)] == ["a"]
    assert store.read("a").count() == 5


def test_lines_of_a_key_are_replaced_together(spark, scratch):
    store = Snapshots(spark, os.path.join(scratch, "t"))
    schema = "r string, line int, t int, v string, _deleted boolean"
    batches = [
        [("a", None, 1, None, False), ("a", 1, 1, "x", False), ("a", 2, 1, "y", False), ("b", None, 1, None, False), ("b", 1, 1, "z", False)],
        [("a", None, 2, None, False), ("a", 1, 2, "x2", False), ("a", None, 2, None, False), ("a", 1, 2, "x2", False)],  # fewer lines, delivered twice
        [("a", None, 1, None, False), ("a", 3, 1, "late", False), ("b", None, 2, None, False)],  # a late version; b without lines
        [("c", None, 1, None, False), ("c", 1, 1, "w", False), ("d", None, 5, None, True), ("d", 1, 4, "old", False)],
    ]
    expect = [{("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")}, {("a", 1, "x2"), ("b", 1, "z")}, {("a", 1, "x2")}, {("a", 1, "x2"), ("c", 1, "w")}]
    for rows, now in zip(batches, expect):
        change = store.change()
        change.upsert("items", spark.createDataFrame(rows, schema), "r", "t", buckets=2, line="line")
        change.commit()
        got = [(r.r, r.line, r.v) for r in store.read("items").collect()]
        assert len(got) == len(now) and set(got) == now


@pytest.mark.parametrize("database", [None, "tillroll_swap_test"])
def test_a_load_that_fails_in_the_third_table_changes_none(spark, scratch, monkeypatch, database):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    os.makedirs(src)
    _sources(src)
    to = {"target_dir": out} if database is None else {"database": database, "receipt_buckets": 2}
    if database:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch}/db'")

    def counts():
        t = LoadedTables.from_dir(spark, out) if database is None else LoadedTables.from_catalog(spark, database)
        return [df.count() for df in (t.receipts, t.items, t.users, t.brands)]

    load_all(spark, src, **to)
    first = [len(RECEIPTS), 3, len(USERS), len(BRANDS)]
    assert counts() == first
    # Other documents, and a third table (receipts) whose rows can't be computed.
    with open(f"{src}/users.json", "w") as f:
        f.write("[]")
    with monkeypatch.context() as m:
        broken = lambda docs, **_: docs.selectExpr("_id.`$oid` as id", "raise_error('no')::timestamp_ntz as create_date")
        m.setattr(batch_load, "load_receipts", broken)
        with pytest.raises(Exception, match="no"):
            load_all(spark, src, **to)
    assert counts() == first
    load_all(spark, src, **to)
    assert counts() == [len(RECEIPTS), 3, 0, len(BRANDS)]
    if database:
        kept = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
        assert sorted(kept) == sorted(batch_load.TABLE_NAMES)
