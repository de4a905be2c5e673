"""Clashing ids, empty tables, long white space and crowded pages in the operators and stages."""

import hashlib

import numpy as np
import pytest

import __spark_entry__
from tests.llm.test_operators import SCHEMA, _prose
from tests.llm.test_queries import _bpe, _cut
from tillroll.llm import blocks, bpe, hashing, minhash, repeats
from tillroll.llm.common import ship


def _table(spark, rows):
    ship(spark)
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "q", "m") for i, t in rows], SCHEMA).repartition(3)


def test_op3_of_long_white_space(spark, tmp_path):
    texts = {0: " " * 1_200_000, 1: "\n" * 1_200_000 + "word", 2: "a" + " \t" * 40_000 + "b" + "\n" * 70_000, 3: "x" * 1_000}
    _table(spark, texts.items()).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in __spark_entry__.queries()["op3_byte_bpe"](spark, str(tmp_path)).collect()}
    assert got[2] == _bpe(texts[2]) and got[3] == _bpe(texts[3])
    for i in (0, 1):
        assert got[i][2] == hashlib.sha256(texts[i].encode()).hexdigest()
    enc = bpe.encoder(bpe.default_ranks())
    for text in (" " * 200_000 + "w", "a" + "\n" * 200_000, "\x1c" * 70_000 + " a" + " " * 70_000 + "\x1cb"):
        assert bpe.encode(enc, text).tolist() == enc.encode_ordinary(text)


def test_op8_of_ids_that_stand_for_several_texts(spark):
    passage = _prose(99, 40)
    rows = [(1, _prose(1, 30) + passage), (2, passage + _prose(2, 200)), (2, "short"), (2, _prose(3, 20) + passage), (2, "short"), (3, passage), (None, passage)]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digests(_table(spark, rows)).collect() if r.doc_id is not None)
    texts = sorted({(i, hashlib.sha256(t.encode()).hexdigest(), t) for i, t in rows if i is not None})
    cut = {(i, t): c for (i, _, t), c in zip(texts, _cut([t.encode() for *_, t in texts]))}
    expect = []
    for i, t in rows:
        if i is not None:
            kept, n, spans = cut[i, t]
            expect.append((i, len(t.encode()), n, spans, hashlib.sha256(kept).hexdigest()))
    assert got == sorted(expect) and sum(r[2] for r in got) > 400


def test_near_duplicates_keep_all_texts_of_a_clashing_id(spark):
    one, two, copy = _prose(1, 90), _prose(2, 90), _prose(3, 90)
    rows = [(1, one), (1, two), (1, one), (2, copy), (3, copy), (4, None), (None, copy)]
    kept = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in minhash.first_of_each(_table(spark, rows)).collect()))
    assert kept == sorted([(False, 1, one), (False, 1, two), (False, 2, copy), (False, 4, ""), (True, 0, copy)])


def test_op6_of_empty_tables_and_repeated_ids(spark):
    ship(spark)
    schema = "page_id long, url string, html string"
    assert blocks.main_texts(spark.createDataFrame([], schema)).count() == 0
    page = "<html><body><nav>Menu</nav><article><p>" + _prose(1, 60) + "</p></article></body></html>"
    none = spark.createDataFrame([(None, "u", page), (None, "v", None)], schema)
    assert sorted((r.url, r.n_chars == len(r.text)) for r in blocks.main_texts(none).collect()) == [("u", True), ("v", True)]
    same = spark.createDataFrame([(1, f"u{i}", page) for i in range(50)], schema)
    texts = {r.text for r in blocks.main_texts(same).collect()}
    assert len(texts) == 1


def test_a_crowded_page_has_a_lane_alone(monkeypatch):
    widths = []
    real = blocks.Vectors
    monkeypatch.setattr(blocks, "Vectors", lambda pages, slots: widths.append([len(p) for p in pages]) or real(pages, slots))
    tiny = "<p>" + _prose(1, 12) + "</p>"
    pages = [tiny] * 70 + ["<div>" + "<p>a b c</p>" * 5000 + "</div>"]
    texts = blocks.extract(pages, blocks.new_net())
    assert len(texts) == 71 and all(len(w) * max(w) <= blocks.CELLS or len(w) == 1 for w in widths)
    assert max(map(len, widths)) > 1


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 10000])
def test_powers_are_those_of_repeated_products(n):
    factor = 0x9E3779B97F4A7C15
    assert hashing.powers(factor, n).tolist() == [pow(factor, k, 1 << 64) for k in range(n)]
    data = np.arange(n, dtype=np.uint8)
    rolling = hashing.Rolling(data)
    if n > 10:
        assert rolling.names(np.array([3]), np.array([9]))[0] == hashing.Rolling(data[3:9]).names(np.array([0]), np.array([6]))[0]
