"""The registered queries and the pipeline on a small table, against plain libraries and brute force."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from tests import oracle_util
from tests.llm.test_operators import SCHEMA, _prose, _words
from tillroll.llm import bpe, bytebpe, repair, wordbpe


def _cut(raws):
    """(kept bytes, bytes gone, spans) of each text, in order of the list."""
    seen, out = set(), []
    for raw in raws:
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(raw[s : s + 100])
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((bytes(x for x, g in zip(raw, gone) if not g), sum(gone), spans))
    return out


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    passage = _prose(99, 40)
    long = "  \n".join(_prose(200 + k, 300) + " 'll 12é 日本語 \t x" for k in range(70))
    assert len(long) > 2 * bpe.PIECE_CHARS
    texts = {
        0: _prose(1, 120), 1: _prose(1, 120), 2: "too short.", 3: passage + " " + _prose(3, 90), 4: _prose(4, 90) + " " + passage,
        5: long, 6: None, 7: "", 8: _prose(8, 70) + "\nHome | About | Shop | Contact us.", 9: "<|endoftext|> é日本 " + _prose(9, 60),
    }
    path = str(tmp_path_factory.mktemp("queries"))
    rows = [(i, t, "en", "s", len(t or ""), "q", "m") for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, texts


def _rows(spark, table, name):
    return {r.doc_id: tuple(r)[1:] for r in __spark_entry__.queries()[name](spark, table[0]).collect()}


def _bpe(text):
    ids = bpe.encoder(bpe.default_ranks()).encode_ordinary(text)  # in one piece
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_op2_gives_the_ids_of_the_tokenizers_library(spark, table):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(repair.default_tokenizer())
    tokenizer.encode_special_tokens = True
    start, expect = 0, {}
    for i, text in sorted(table[1].items()):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, repair.END_ID], "<u4")
        expect[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert _rows(spark, table, "op2_repair_shards") == expect


def test_stretches_have_the_ids_of_whole_texts(monkeypatch):
    path = repair.default_tokenizer()
    own = bytebpe.Encoder(path)
    assert own.by_stretch
    rng = np.random.default_rng(7)
    parts = [" ", "  ", "\n", "\t", "a", "foo", "\x1c", "\x85", "\xa0", "\u3000", "1", "!", "é", "日", "\u200b", "'s", "'ll", "<|endoftext|>", "\r\n", "Ġ", "\0"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), n)) for n in rng.integers(0, 14, 3000)]

    def ids(text):
        return np.array(own.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    expect = [ids(t) for t in texts]
    assert own.encode(texts) == expect
    assert own.encode(texts) == expect  # all from memory
    own.stretches = bytebpe.Lately(5)  # generations change with each text
    assert [own.encode([t])[0] for t in texts] == expect
    long = " ".join(texts)
    monkeypatch.setattr(bytebpe, "windows", lambda t: wordbpe.windows(t, 50))
    assert own.encode([long, "", "x"]) == [ids(long), b"", ids("x")]
    own.by_stretch = False
    assert own.encode(texts[:50]) == expect[:50]


def test_words_of_letters_go_to_the_merges_without_the_pattern():
    own = bytebpe.Encoder(repair.default_tokenizer())
    letters = [c for c in wordbpe.PLAIN if c.isalpha()]
    text = "x " + " ".join(f"{c}ab a{c} {c}{c}" for c in letters) + " river, ends  " + "\u3000 ".join("ab")
    expect = np.array(own.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    asked, ask = [], own._asked
    own._asked = lambda texts: asked.extend(texts) or ask(texts)
    assert own.encode([text, text]) == [expect, expect] and own.encode([text]) == [expect]
    assert sum(map(len, asked)) < 100  # the text's first and last stretches and those with marks, each once


def test_stretches_end_where_pieces_always_end(monkeypatch):
    own = bytebpe.Encoder(repair.default_tokenizer())
    monkeypatch.setattr(bytebpe, "CUT_BYTES", 40)
    rng = np.random.default_rng(9)
    parts = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x7f", "\0", "\xa0", "ab", "Cd", "12", "٣", "é", "日", ",", ".", "-", "'", "''", "'s", "'ll", "'T", "\u0301"]
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), n)) for n in rng.integers(0, 14, 4000)]
    expect = [np.array(own.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode(texts) == expect == own.encode(texts) and own.encode([]) == []


def test_words_are_asked_once_whatever_mark_follows():
    own = bytebpe.Encoder(repair.default_tokenizer())
    words, asked = [a + b + c for a in "bcdfgh" for b in "aeiou" for c in "lmnrst"], []
    for name in ("_asked", "_merged"):
        setattr(own, name, lambda texts, ask=getattr(own, name): asked.extend(texts) or ask(texts))
    text = " ".join(f"{w}{m}" for m in [",", ".", ";", ")", "'s", "-x", " 1", ".\nSo"] for w in words)
    assert own.encode([text])[0] == np.array(own.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert sum(map(len, asked)) < 2 * sum(map(len, words))


def test_the_stretches_used_last_are_kept():
    own = bytebpe.Encoder(repair.default_tokenizer())
    own.stretches = bytebpe.Lately(50)
    learnt, learn = [], own._learn
    own._learn = lambda new: learnt.append(new.to_pylist()) or learn(new)
    for k in range(40):
        text = " always" + "".join(f" w{k}x{i}" for i in range(10))
        assert own.encode([text])[0] == np.array(own.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(own.stretches.numbers) == len(own.stretches.last) <= 2 * 50 + 50
    assert sum(new.count(" always") for new in learnt) == 1 and sum(new.count("x") for new in learnt) == 1


def test_op2_describes_documents_where_they_are_decoded(spark, table):
    df = __spark_entry__.queries()["op2_repair_shards"](spark, table[0])
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_grammar_rounds_look_at_new_symbols_only(monkeypatch):
    rng = np.random.default_rng(8)
    ids = np.concatenate([rng.integers(0, 50_000, 200_000), np.tile(rng.integers(0, 50_000, 50), 512)]).astype(np.uint32)
    looked, frequent = [], repair._frequent

    def count(seq, look=None):
        looked.append(len(seq) if look is None else len(look))
        return frequent(seq, look)

    monkeypatch.setattr(repair, "_frequent", count)
    grammar = repair.compress(ids)
    assert (repair.decompress(*grammar) == ids).all() and len(looked) > 5
    assert sum(looked) < 2 * len(ids)


def test_op3_gives_the_ids_of_tiktoken(spark, table):
    assert _rows(spark, table, "op3_byte_bpe") == {i: _bpe(t or "") for i, t in table[1].items()}


def test_op8_gives_the_repeats_of_brute_force(spark, table):
    raws = {i: (t or "").encode() for i, t in sorted(table[1].items())}
    expect = {i: (len(raw), n, spans, hashlib.sha256(kept).hexdigest()) for (i, raw), (kept, n, spans) in zip(raws.items(), _cut(raws.values()))}
    assert expect[1][1] == expect[1][0] and expect[4][1] > 100
    assert _rows(spark, table, "op8_repeated_strings") == expect


@pytest.mark.parametrize("name", ["op4_curriculum_mix", "op5_line_rules", "op7_ngram_jaccard", "op8_repeated_strings"])
def test_queries_equal_their_sql_on_awkward_texts(spark, table, tmp_path, name):
    marks = ["Fin\u2028", "no mark here", "ends.\r", "a » b » c » d.", "!!!!!! Buy!", "$$$ |||.", "Powered by us.", "Ελληνικά;", "日本語です。"]
    more = [(i, t, "en", src, 0, "q", "m") for i, t, src in [
        (20, "\n".join([_prose(20, 80), *marks]), "b"), (21, "\n".join(marks * 4), "a"), (22, " ".join(["same words"] * 40), None),
        (23, _prose(1, 120) + "x", None), (24, "é" * 99, "c"), (25, "é" * 150, "c"), (26, "\n \t\n", "d"), (27, "w. " * 60, "d"),
    ]]
    path = f"{tmp_path}/documents.parquet"
    spark.read.parquet(f"{table[0]}/documents.parquet").union(spark.createDataFrame(more, SCHEMA)).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{path}/*.parquet')")
    df = __spark_entry__.queries()[name](spark, str(tmp_path))
    assert oracle_util.compare(df, con, __spark_entry__.oracle_sql()[name]) == ([], len(table[1]) + len(more))


def test_pipeline_gives_the_rows_of_its_plain_stages(spark, table):
    texts = {i: t for i, t in table[1].items() if i not in (1, 2, 6, 7)}  # copy, too short, no text
    texts[8] = texts[8].split("\n")[0]
    texts = {i: kept.decode() for i, (kept, _, _) in zip(texts, _cut([t.encode() for t in texts.values()]))}
    got = corpus_pipeline.run(spark, table[0]).collect()
    assert {tuple(r) for r in got} == {(i, *_bpe(t)) for i, t in texts.items()}
    # One source: the mix takes 1.5 times its words, to half a document.
    times, words = collections.Counter(r.doc_id for r in got), {i: len(_words(t)) for i, t in texts.items()}
    assert set(times.values()) <= {1, 2}
    assert abs(sum(n * words[i] for i, n in times.items()) - 1.5 * sum(words.values())) <= max(words.values()) / 2
