"""The parallel reader of JSON arrays against Python's json and the one-task reader."""

import json
import os
import random

import numpy as np
import pytest

from tests.test_batch_load import RECEIPTS
from tillroll.sources import schemas as S
from tillroll.sources.arrays import _Cutter, _summaries, array_documents, compose, marks, read_arrays
from tillroll.sources.documents import read_documents

SCHEMA = "id long, t string, n struct<a:array<struct<b:string>>, c:string>"


def _docs(n, seed=0):
    rng = random.Random(seed)
    odd = ["}", "{", "]", "[", '"', "\\", '\\"', '\\\\"', "é", "日本語", "😀", ",", "\n", "}{", '"}', "x" * 40, "[{", "\\\\", "\t"]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(8)))
    return [
        {"id": i, "t": text(), "n": {"a": [{"b": text()} for _ in range(rng.randrange(4))], "c": text()}} if i % 7 else {"id": i, "t": text() * 60}
        for i in range(n)
    ]


@pytest.fixture()
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "397", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "3"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _rows(df):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


def test_ranges_give_the_rows_of_the_one_task_reader(spark, scratch, small_ranges):
    texts = {
        "plain.json": json.dumps(_docs(20, 1)),
        "utf8.json": json.dumps(_docs(24, 2), ensure_ascii=False, separators=(",", ":")),
        "indented.json": json.dumps(_docs(10, 3), indent=2, ensure_ascii=False),
        "spaces.json": " \r\n [ \n" + " ,\n ".join(json.dumps(d) for d in _docs(8, 4)) + "\n ]\n\n",
        "empty.json": "[]",
        "one.json": json.dumps(_docs(1, 5)[0]),
    }
    for name, text in texts.items():
        with open(os.path.join(scratch, name), "w", encoding="utf-8") as f:
            f.write(text)
    for name, text in texts.items():
        path, schema = os.path.join(scratch, name), _schema(spark)
        docs, folder = read_arrays(spark, path, schema)
        assert docs.schema == schema and _rows(docs) == _rows(read_documents(spark, path, schema)), name
    docs, _ = read_arrays(spark, [os.path.join(scratch, n) for n in texts], _schema(spark))
    assert docs.count() == 20 + 24 + 10 + 8 + 0 + 1
    cut = array_documents(spark, os.path.join(scratch, "utf8.json"))
    assert cut.rdd.getNumPartitions() > 5 and cut.where("path is not null").count() > 5


def test_documents_one_after_another_and_lines(spark, scratch, small_ranges):
    docs = _docs(12, 6)
    for sep in ("\n", ""):
        path = os.path.join(scratch, f"d{len(sep)}{ord(sep or 'x')}.json")
        with open(path, "w") as f:
            f.write(sep.join(json.dumps(d) for d in docs))
        got, _ = read_arrays(spark, path, _schema(spark))
        assert sorted(r.id for r in got.collect()) == list(range(12))


def test_malformed_documents_count_one_by_one(spark, scratch, small_ranges):
    good = _docs(12, 7)
    texts = [json.dumps(d) for d in good]
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write("[" + ",".join(texts[:6]) + ', 17, {"id": x}, ' + ",".join(texts[6:]) + ', {"id": 99, "t": "cut')
    kept, _ = read_arrays(spark, path, _schema(spark), on_corrupt="keep")
    bad = [r._corrupt_record for r in kept.collect() if r._corrupt_record is not None]
    assert sorted(b.strip()[:8] for b in bad) == ["17", '{"id": 9', '{"id": x']
    dropped, _ = read_arrays(spark, path, _schema(spark), on_corrupt="drop")
    assert sorted(r.id for r in dropped.collect()) == list(range(12))
    with pytest.raises(ValueError, match="malformed"):
        read_arrays(spark, path, _schema(spark))
    for cut in ('[{"id": 1}, {"id": 23', '[{"id": 1}, {"id": 2}', '{"id": 1} {"id": 2'):
        with open(path, "w") as f:
            f.write(cut)
        kept, _ = read_arrays(spark, path, _schema(spark), on_corrupt="keep")
        assert sorted((r.id, r._corrupt_record is None) for r in kept.collect() if r.id == 1) == [(1, True)]
        assert [r for r in kept.collect() if r._corrupt_record is not None], cut
    none, _ = read_arrays(spark, os.path.join(scratch, "absent.json"), _schema(spark), on_missing="empty")
    assert none.count() == 0
    with pytest.raises(Exception):
        read_arrays(spark, os.path.join(scratch, "absent.json"), _schema(spark))
    with open(path, "wb") as f:
        f.write(b'[{"id": 1, "t": "\xff\xfe"}, {"id": 2}]')
    assert sorted(r.id for r in read_arrays(spark, path, _schema(spark))[0].collect()) == [1, 2]


def test_receipts_read_in_ranges_load_as_before(spark, scratch, small_ranges):
    path = os.path.join(scratch, "receipts.json")
    with open(path, "w") as f:
        json.dump(RECEIPTS, f)
    docs, _ = read_arrays(spark, path, S.RECEIPT)
    assert _rows(docs) == _rows(read_documents(spark, path, S.RECEIPT))


def test_cuts_at_every_place_compose():
    import pyarrow as pa

    docs = _docs(9, 8)
    text = json.dumps(docs, ensure_ascii=False).encode()
    pieces = [p + b"}" for p in text.split(b"}")[:-1]] + [text.split(b"}")[-1]]
    rng = np.random.default_rng(1)
    for _ in range(40):
        # Any grouping of the pieces to ranges gives the same documents.
        group = np.cumsum(rng.random(len(pieces)) < 0.3)
        rows = [("f", int(g), len(text), p.removesuffix(b"}").decode()) for g, p in zip(group, pieces)]
        batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], ["path", "start", "size", "value"])
        lines = [r for b in _summaries(iter([batch])) for r in b.to_pylist()]
        states = compose(lines)
        whole, torn = [], {}
        for g in dict.fromkeys(group.tolist()):
            cutter = _Cutter(states["f", g], g)
            for i in np.flatnonzero(group == g):
                cutter.add(pieces[i] if pieces[i].endswith(b"}") else pieces[i] + b"}")
            cutter.end()
            for t, begun in cutter.rows:
                if begun is None:
                    whole.append(t)
                else:
                    torn.setdefault(begun, []).append(t)
        got = [json.loads(t) for t in whole] + [json.loads(b"".join(p)) for p in torn.values()]
        assert sorted(got, key=lambda d: d["id"]) == docs


def test_quotes_behind_backslashes():
    data = np.frombuffer(rb'{"a\\":"\"{","b":"\\\"}"}', np.uint8)
    found = marks(data)
    outside = found.at[~found.odd]
    assert outside.tolist() == [0, len(data) - 1] and not found.flips
