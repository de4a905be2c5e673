"""The training-data operators against brute force, on awkward small tables."""

import collections
import hashlib
import re

import numpy as np
import pytest

from tillroll.llm import blocks, bpe, covertree, curriculum, language, line_rules, minhash, repair, repeats, toxicity
from tillroll.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, quality string, mix string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def _prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    words = [WORDS[i] + str(rng.integers(50)) for i in rng.integers(0, len(WORDS), n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words)) + "."


def _rows() -> list[tuple]:
    base, passage = _prose(1, 120), _prose(99, 60)
    near = base.replace(base.split()[60], "changed", 1)
    texts = [
        (0, base, "s1"), (1, base, "s1"), (2, near, None), (3, None, "s2"), (4, "", "s2"), (5, " \t\n\x0b ", "s2"),
        (6, "one two", "s3"), (7, "one two", "s3"), (8, passage + " " + _prose(3, 80), "s3"), (9, _prose(4, 80) + " " + passage, None),
        (10, "x" * 5000, "s1"), (11, "ab" * 300, "s1"), (12, "é" * 120 + " ñandú 日本語", "s1"), (13, _prose(5, 6000), "s1"),
        (14, _prose(6, 60) + "\n" + "Home | About | Shop | Contact us today.\nAll rights reserved.", "s1"),
        (None, base, "s1"), (6, "one two", "s3"),
    ]
    return [(i, t, "en", s, len(t or ""), "q", "m") for i, t, s in texts]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    ship(spark)
    return spark.createDataFrame([], SCHEMA)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_line_rules_count_as_brute_force(docs, empty):
    got = {r.doc_id: r for r in line_rules.verdicts(docs).collect()}
    for i, text, *_ in _rows():
        words, r = _words(text), got[i]
        windows = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if _words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
    assert not got[3].kept and got[0].kept
    cleaned = {r.doc_id: r.text for r in line_rules.clean(docs).collect()}
    assert cleaned[14] == _prose(6, 60) and line_rules.clean(docs).columns == docs.columns
    assert line_rules.verdicts(empty).count() == 0


def test_line_rules_keep_clean_prose_of_other_scripts(spark):
    ship(spark)
    marks = "\u0964 \u0965 \u06d4 \u061f \u3002 \uff01 \uff1f \u1362 \u104b \u17d4 \u0589 \u037e \u0f0d \uff61 \U00011047".split()
    words = {
        "\u0964": "\u092f\u0939 \u090f\u0915 \u0938\u093e\u092b \u0935\u093e\u0915\u094d\u092f \u0939\u0948",
        "\u06d4": "\u06cc\u06c1 \u0627\u06cc\u06a9 \u0635\u0627\u0641 \u062c\u0645\u0644\u06c1 \u06c1\u06d2",
        "\u061f": "\u0647\u0630\u0647 \u062c\u0645\u0644\u0629 \u0639\u0631\u0628\u064a\u0629 \u0646\u0638\u064a\u0641\u0629 \u0647\u0646\u0627",
        "\u3002": "\u8fd9 \u662f \u4e00\u4e2a \u5e72\u51c0 \u53e5\u5b50",
    }
    rows = []
    for i, mark in enumerate(marks):
        line = words.get(mark, "\u0561\u0562 \u0563\u0564 \u0565\u0566 \u0567\u0568 \u0569\u056a")
        lines = [" ".join(f"{w}{k}x{j}" for w in line.split()) + mark for k in range(5) for j in range(3)]
        rows.append((i, "\n".join(lines), "xx", "s", 0, "q", "m"))
    # No blank after a mark, a bracket after it, and the last sentence cut off.
    rows.append((100, "\n".join(f"\u4ed6 \u8bf4{k} \u300c\u597d{k}\u3002\u300d\u7136\u540e {k} \u8d70" for k in range(15)), "xx", "s", 0, "q", "m"))
    # Menus have no mark in any script.
    rows.append((101, "\n".join(f"\u0918\u0930{k} \u0926\u0941\u0915\u093e\u0928{k} \u0938\u0902\u092a\u0930\u094d\u0915{k} \u092a\u0924\u093e{k}" for k in range(15)), "xx", "s", 0, "q", "m"))
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in line_rules.verdicts(docs).collect()}
    assert all(not r.base_failed for r in got.values())
    assert [i for i, r in got.items() if not r.kept or r.n_bad_lines] == [101] and not got[101].kept
    assert {r.doc_id: r.text for r in line_rules.clean(docs).collect()} == {i: t for i, t, *_ in rows if i != 101}


def _brute_links(rows):
    sets = []
    for _, text in rows:
        w = _words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    links = collections.Counter()
    for a in range(len(rows)):
        for b in range(len(rows)):
            both = len(sets[a] & sets[b])
            if a != b and both and 5 * both >= 4 * len(sets[a] | sets[b]):
                links[rows[a][0]] += 1
    return links


def test_ngram_join_finds_all_links(docs, empty):
    rows = [(i, t) for i, t, *_ in _rows() if i is not None]
    got = minhash.near_duplicates(docs).collect()
    links = _brute_links(rows)
    assert len(got) == len(rows)
    # Doc 6 is there twice: each of its rows has the links of one.
    assert all(r.n_links == links[r.doc_id] // (2 if r.doc_id == 6 else 1) for r in got)
    classes = {r.doc_id: r.class_id for r in got}
    assert classes[1] == classes[2] == 0 and classes[7] == 6 and classes[3] == 3 and classes[9] == 9
    kept = sorted((r.doc_id for r in minhash.first_of_each(docs).collect()), key=str)
    assert kept == sorted([0, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14, None], key=str)
    assert minhash.near_duplicates(empty).count() == 0


def test_bands_reach_the_recall():
    bands, rows = minhash.bands_for()
    assert 1 - (1 - 0.8**rows) ** bands >= minhash.RECALL and bands * rows <= minhash.MAX_HASHES


def test_repeats_are_those_of_brute_force(docs, empty):
    rows = sorted((i, (t or "").encode()) for i, t, *_ in _rows() if i is not None and i != 6) + [(6, b"one two")]
    seen, expect = set(), {}
    for i, raw in sorted(rows):
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(raw[s : s + 100])
        keep = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        expect[i] = (len(raw), sum(gone), spans, hashlib.sha256(keep).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in repeats.digests(docs).collect()}
    assert got[None][1] == 0
    assert {i: got[i] for i in expect} == expect
    assert expect[10][1] > 0 and expect[9][1] > 0
    assert repeats.digests(empty).count() == 0


def test_mix_meets_targets_and_caps(docs, empty):
    rows = curriculum.shares(docs).collect()
    assert len(rows) == len(_rows()) and all(r.taken <= 2 * r.size for r in rows)
    assert [tuple(r) for r in curriculum.shares(docs.repartition(5)).collect()] == [tuple(r) for r in rows]
    sizes = collections.Counter()
    for _, t, _, s, *_ in _rows():
        sizes[s] += len(_words(t))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight, left = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values())
    target, active = {}, set(order)
    while True:
        level = left / sum(weight[s] for s in active)
        over = [s for s in active if level * weight[s] >= 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            active.remove(s)
    target.update({s: level * weight[s] for s in active})
    by_size = {r.source_size: r.target for r in rows}
    assert all(by_size[sizes[s]] == pytest.approx(target[s]) for s in order)
    mixed = curriculum.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(len(r.positions) for r in rows)
    assert curriculum.shares(empty).count() == 0


def test_bpe_round_trip_and_safe_pieces(docs, empty):
    enc = bpe.encoder(bpe.default_ranks())
    text = _prose(8, 400) + "  \n\n x'll 12ab " + "é" * 50
    cut = list(bpe.pieces(text, 64))
    assert "".join(cut) == text and sum((enc.encode_ordinary(p) for p in cut), []) == enc.encode_ordinary(text)
    got = {r.doc_id: r for r in bpe.digests(docs).collect()}
    for i, t, *_ in _rows():
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    raw = {r.doc_id: bytes(r.bytes) for r in bpe.decoded(bpe.encoded(docs)).collect()}
    assert raw[12] == _rows()[12][1].encode() and bpe.digests(empty).count() == 0


def test_repair_round_trip_and_starts(docs, empty):
    ids = np.random.default_rng(0).integers(0, 9, 20_000).astype(np.uint32)
    grammar = repair.compress(ids)
    assert len(grammar[2]) < len(ids) and (repair.decompress(*grammar) == ids).all()
    assert (repair.decompress(*grammar, 777, 1234) == ids[777:1234]).all()
    rows = sorted(repair.digests(docs).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows[:-1])]).tolist()
    assert [r.doc_id for r in rows] == sorted((i for i, *_ in _rows()), key=lambda i: (i is not None, i))
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4)} == {1} and repair.digests(empty).count() == 0


def test_repair_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 50_000, 1000).astype(np.uint32)
    for ids in (np.tile(one, 300), np.concatenate([rng.integers(0, 300, 50_000).astype(np.uint32), np.tile(one, 60)]), np.zeros(5000, np.uint32)):
        rules, lengths, seq = repair.compress(ids)
        pairs = collections.Counter(zip(seq[:-1].tolist(), seq[1:].tolist()))
        assert max(pairs.values(), default=0) < repair.MIN_COUNT
        assert (repair.decompress(rules, lengths, seq) == ids).all()
    rules, lengths, seq = repair.compress(np.tile(one, 300))
    assert lengths.max() > 64 and len(seq) < 2000


def test_dual_tree_search_is_exact(spark):
    ship(spark)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(700, 8))
    vectors[100:300] = vectors[100]  # equal vectors rank by id
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1001, [None] * 8), (1020, [float("nan")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = np.floor(64 * vectors.astype(np.float32).astype(float))
    expect = set()
    for q in range(0, 700, 20):
        score = v @ v[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(700), -score))[:20]
        expect |= {(q, k + 1, int(j), int(score[j])) for k, j in enumerate(best)}
    assert {tuple(r) for r in covertree.top_k(df).collect()} == expect
    assert covertree.top_k(df.where("vec_id < 0")).count() == 0
    assert covertree.top_k(df.where("vec_id < 5")).count() == 4


def test_dual_tree_search_takes_every_length_and_rejects_inexact_scores(spark):
    ship(spark)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=(8, 8, 3)[i % 3])]) for i in range(240)] + [(500, [])]
    expect = set()
    for q in range(0, 240, 20):
        v = {i: np.floor(64 * np.array(x, np.float32).astype(float)) for i, x in rows if len(x) == len(rows[q][1])}
        best = sorted((-int(v[q] @ x), i) for i, x in v.items() if i != q)[:20]
        expect |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    kind = "vec_id long, embedding array<float>"
    assert {tuple(r) for r in covertree.top_k(spark.createDataFrame(rows, kind)).collect()} == expect
    with pytest.raises(ValueError, match="scores pass"):
        covertree.top_k(spark.createDataFrame([*rows, (501, [1e9] * 8)], kind))


def test_blocks_of_awkward_pages(spark):
    ship(spark)
    page = (
        "<html><head><title>t</title><script>var t='</p>';</script></head><body><nav><ul><li><a href='/'>Menu</a></ul></nav>"
        "<article><h1>Head &amp; more</h1><p>One\n two <b>bold<br>line<p>Next &copy; para</article><footer>Foot</footer>"
    )
    found = blocks.leaves(page)
    assert [x[0] for x in found] == ["Menu", "Head & more", "One two bold line", "Next © para", "Foot"]
    rows = [(i, "u", page.replace("One", f"One{i}")) for i in range(40)] + [(100, None, None), (101, "u", ""), (None, "u", page)]
    got = {r.page_id: r for r in blocks.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[7].text == "Head & more\nOne7 two bold line\nNext © para" and got[7].n_chars == len(got[7].text)
    assert got[100].text == "" and got[101].n_chars == 0 and len(got) == 43


def test_blocks_read_on_after_svg_math_object_and_select(spark):
    ship(spark)

    def texts(part):
        return [x[0] for x in blocks.leaves(f"<body><article><p>First</p>{part}<p>Last one</p></article><footer>Foot</footer>")]

    assert texts("<svg class='i'/><p>Icon</p><svg><title>No</title><path d='M0'/></svg>") == ["First", "Icon", "Last one", "Foot"]
    assert texts("<p>See <svg width='1' /> here <svg><g><svg/></g>no</svg>too</p>") == ["First", "See here too", "Last one", "Foot"]
    assert texts("<p>Open <svg><path>") == ["First", "Open", "Last one", "Foot"]
    assert texts("<p>Open <svg><path></p>after") == ["First", "Open", "after", "Last one", "Foot"]
    assert texts("<svg><foreignObject><p>no</p></foreignObject></svg>") == ["First", "Last one", "Foot"]
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='t'>x=2</annotation></semantics></math>"
    assert texts(f"<p>So {formula} holds <math/> and <math><mi>y</mi></p>") == ["First", "So x=2 holds and y", "Last one", "Foot"]
    assert texts("<object data='a'><p>Instead</p></object>") == ["First", "Instead", "Last one", "Foot"]
    assert texts("<object data='a'>") == texts("<noscript>") == texts("<template>") == texts("<annotation>") == ["First", "Last one", "Foot"]
    assert texts("<select><option>A<option>B</select>") == ["First", "A", "B", "Last one", "Foot"]
    assert texts("<select><option>A") == ["First", "A", "Last one", "Foot"]
    last = [x for x in blocks.leaves("<article><p>a</p><select><option>A<p>Last") if x[0] == "Last"][0]
    assert blocks.weak_label(last[1]) == 1

    page = (
        "<body><nav><ul><li><a href='/'>Menu</a></ul></nav><article><h1>Head{0}</h1><p>One{0} two, three.</p>{1}<p>Last{0} words, here.</p></article>"
        "<footer>Foot</footer>"
    )
    odd = {40: "<svg viewBox='0 0 1 1'/>", 41: "<object data='a.swf'>", 42: "<svg/><p>Mid<svg></svg></p>", 43: "<select>"}
    rows = [(i, "u", page.format(i, odd.get(i, ""))) for i in range(44)]
    got = {r.page_id: r.text for r in blocks.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Head{i}\nOne{i} two, three.\n" + "Mid\n" * (i == 42) + f"Last{i} words, here." for i in range(44))


def test_blocks_of_pages_without_article(spark):
    ship(spark)
    for kind in ("class='has-sidebar'", "class='with-comments nav-open'"):
        assert blocks.weak_label(blocks.leaves(f"<html {kind}><body {kind} id='menu'><div {kind}><article><p>x</article>")[0][1]) == 1
    assert blocks.weak_label(blocks.leaves("<body><article><div class='x sidebar'><p>x</article>")[0][1]) == 0

    def page(i, around):
        rng = np.random.default_rng(i)
        links = "".join(f"<li><a href='/'>{WORDS[k]}</a></li>" for k in rng.permutation(6)[:4])
        main = [_prose(1000 * i + k, int(rng.integers(12, 60))) for k in range(3)]
        body = "".join(f"<p>{x}</p>" for x in main)
        return f"<body class='has-sidebar'><nav><ul>{links}</ul></nav><{around}>{body}</{around}><footer>Copyright, legal notice {i}</footer>", "\n".join(main)

    def share(rows, texts):
        df = spark.createDataFrame([(i, "u", h) for i, h in rows.items()], "page_id long, url string, html string")
        got = {r.page_id: r.text for r in blocks.main_texts(df).collect()}
        return sum(got[i] == text for i, text in texts.items()) / len(texts)

    pages = {i: page(i, "article" if i < 60 else "div") for i in range(120)}
    assert share({i: h for i, (h, _) in pages.items()}, {i: t for i, (_, t) in pages.items()}) > 0.95
    # No page of the table has a main element.
    pages = {i: page(i, "div") for i in range(60)}
    assert share({i: h for i, (h, _) in pages.items()}, {i: t for i, (_, t) in pages.items()}) > 0.95


def test_toxicity_learns_and_scores_awkward_texts(spark, empty):
    ship(spark)
    rows = [(i, _prose(i, 30) + (" you idiot scum" if i % 3 == 0 else ""), "en", "s", 0, "", "") for i in range(240)]
    rows += [(1000, None, "en", "s", 0, "", ""), (1001, "", "en", "s", 0, "", ""), (None, "x", "en", "s", 0, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(5000, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert all((got[i].predicted == 1) == (i % 3 == 0) for i in range(240))
    assert got[1000].score == got[1001].score and 0 <= got[1000].score <= 1 and len(got) == 243
    assert toxicity.scores(empty, labels).count() == 0


def test_language_of_mixed_and_awkward_texts(spark, empty):
    ship(spark)
    en, fr = "the and with this that from of to in is was".split(), "le la les dans avec est une pour que qui des".split()
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(en if i % 2 else fr, 40)), "en" if i % 2 else "fr", "s", 0, "", "") for i in range(120)]
    rows += [(1000, None, None, "s", 0, "", ""), (1001, "123 !!", None, "s", 0, "", ""), (1002, " ".join(en * 6 + fr * 2), None, "s", 0, "", "")]
    got = {r.doc_id: r for r in language.languages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "fr") for i in range(120))
    assert got[1000].lang_pred == got[1001].lang_pred == "und"
    assert got[1002].lang_pred == "en" and got[1002].n_spans == 2
    assert language.languages(empty).count() == 0
