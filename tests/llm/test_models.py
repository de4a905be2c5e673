"""The trained operators' arithmetic against plain loops, and their bounds on awkward tables."""

import itertools
import math
import re

import numpy as np
import pytest

from tests.llm.test_operators import SCHEMA, _prose
from tillroll.llm import blocks, language, toxicity
from tillroll.llm.common import ship
from tillroll.llm.hashing import Rolling


def _plain_ftrl(rows, bias):
    z, n = {}, {}

    def weight(i):
        l1 = 0.0 if i == bias else toxicity.L1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2
        return -(z[i] - math.copysign(l1, z[i])) / rate

    for _ in range(toxicity.EPOCHS):
        for slots, label in rows:
            at = [*slots, bias]
            w = {i: weight(i) for i in at}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(w.values())))))
            g = (p - label) * (toxicity.POSITIVE_WEIGHT if label else 1)
            for i in at:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_ftrl_learns_the_weights_of_a_plain_loop():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(300):
        label = int(rng.random() < 0.3)
        rows.append((np.unique(np.append(rng.integers(0, 60, 8), 100 + label)), label))
    bias, slots, weights = toxicity.train(rows)
    plain = _plain_ftrl([(s.tolist(), y) for s, y in rows], 1 << toxicity.BITS)
    assert bias == pytest.approx(plain.pop(1 << toxicity.BITS))
    assert dict(zip(slots.tolist(), weights.tolist())) == pytest.approx({i: w for i, w in plain.items() if w})
    assert 0 < len(slots) < 60 and {100, 101} & set(slots.tolist())  # sparse, and the telling ones are there


def test_toxicity_features_are_words_stems_pairs_and_skips():
    texts = ["You, fool! you FOOL indeed", "", "...", "élan vital 42 élan", _prose(3, 200)]
    found = {i: set() for i in range(len(texts))}
    for first, owner, slot in toxicity.features([t.encode() for t in texts]):
        for i, s in zip(owner.tolist(), slot.tolist()):
            found[first + i].add(s)
    for i, text in enumerate(texts):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
        plain = {("w", w) for w in words} | {(n, w[:n]) for w in words for n in toxicity.STEMS}
        plain |= {("pair", *p) for p in zip(words, words[1:])} | {("skip", *p) for p in zip(words, words[2:])}
        assert len(plain) - 2 <= len(found[i]) <= len(plain)  # two slots may meet


def _model(n_langs, seed=2):
    rng = np.random.default_rng(seed)
    scripts = rng.random((language.N_SCRIPTS, n_langs)) < 0.7
    return language.Model([f"l{i:02}" for i in range(n_langs)], rng.normal(-9, 2, (1 << language.BITS, n_langs)).astype(np.float32), scripts)


def test_word_scores_are_mean_log_probabilities_times_the_root_of_their_number():
    model, texts = _model(3), ["Ab cde\tΩμέγα 日本", "", "x ñandú!"]
    found = language.words_of([t.encode() for t in texts])
    got = language.word_scores(found, model)
    words = [w for t in texts for w in re.findall(rb"[^ \t]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode()))]
    assert len(got) == len(words) and found.owner.tolist() == [0, 0, 0, 0, 2, 2]
    for k, word in enumerate(words):
        padded = np.frombuffer(b" " + word + b" ", np.uint8)
        slots = [int(x >> np.uint64(64 - language.BITS)) for n in language.SIZES if len(padded) >= n for x in Rolling(padded).windows(n)[: len(padded) - n + 1]]
        plain = model.score[slots].astype(float).sum(axis=0) / math.sqrt(len(slots))
        allowed = model.scripts[found.script[k]]
        if allowed.any():
            plain = plain + np.where(allowed, 0, language.EXCLUDED)
        assert got[k] == pytest.approx(plain, rel=1e-4)


def test_viterbi_finds_the_best_of_all_paths(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.normal(0, 6, (n, 3)).astype(np.float32) for n in (0, 1, 2, 6, 5, 7, 3)]

    def value(s, path):
        return sum(float(s[t, x]) for t, x in enumerate(path)) - language.SWITCH_PENALTY * sum(a != b for a, b in zip(path, path[1:]))

    for cells in (language.CELLS, 1):  # side by side, and one by one
        monkeypatch.setattr(language, "CELLS", cells)
        for s, path in zip(texts, language.viterbi(texts), strict=True):
            assert len(path) == len(s)
            if len(s):
                best = max(value(s, p) for p in itertools.product(range(3), repeat=len(s)))
                assert value(s, path.tolist()) == pytest.approx(best, abs=1e-4)


@pytest.mark.parametrize("n_langs", [2, 11])
def test_long_texts_are_decoded_part_by_part_as_whole(monkeypatch, n_langs):
    model = _model(n_langs)
    text = " ".join(_prose(k, 60) + "   \n" + "日本 ελ" for k in range(20)).encode() + b" " * 900 + b"x" * 700 + b" end"
    whole = language.label([text, b"a"], model)[0]
    monkeypatch.setattr(language, "BATCH_BYTES", 256)
    assert b"".join(language._parts(text)) == text and len(list(language._parts(text))) > 20
    path, letters = language.label([text], model)[0]
    assert path.tolist() == whole[0].tolist() and letters.tolist() == whole[1].tolist()
    assert len(set(path.tolist())) > 1
    blank = language.label([b" \n" * 300], model)[0]
    assert len(blank[0]) == len(blank[1]) == 0


def test_samples_hold_one_text_of_an_id_and_at_most_so_many_languages(spark, monkeypatch):
    ship(spark)
    rows = [(1, _prose(k % 5, 30), "en", "s", 0, "", "") for k in range(200)]
    rows += [(i, _prose(i, 30), f"l{i % 9}", "s", 0, "", "") for i in range(2, 60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(language, "MAX_LANGS", 3)
    sample = [i for i in {r[0] for r in rows} if _fold(i, language) != language.HELD_OUT]
    number = {}
    for i in sample:
        lang = "en" if i == 1 else f"l{i % 9}"
        number[lang] = number.get(lang, 0) + 1
    expect = sorted(sorted(number, key=lambda x: (-number[x], x))[:3])
    assert language.fit(docs).langs == expect
    labels = spark.createDataFrame([(1, 1)] * 50 + [(1, 0)] + [(i, 0) for i in range(2, 60)], "doc_id long, toxic int")
    calls = toxicity.scores(docs, labels).collect()
    assert len(calls) == len(rows)


def _fold(i, module):
    import zlib

    return zlib.crc32(str(i).encode()) % module.FOLDS


def _plain_side(net, side, rows):
    """Hidden states of one direction, one step and one unit at a time."""
    n = blocks.HIDDEN
    h, c, out = [0.0] * n, [0.0] * n, []
    for x in rows:
        gates = [
            float(net[f"b{side}"][k]) + sum(float(a) * float(w) for a, w in zip(x, net[f"x{side}"][:, k])) + sum(a * float(w) for a, w in zip(h, net[f"h{side}"][:, k]))
            for k in range(4 * n)
        ]
        s = [1 / (1 + math.exp(-v)) for v in gates[: 3 * n]]
        c = [s[n + j] * c[j] + s[j] * math.tanh(gates[3 * n + j]) for j in range(n)]
        h = [s[2 * n + j] * math.tanh(c[j]) for j in range(n)]
        out.append(h)
    return out


def test_the_network_scores_as_a_plain_bidirectional_lstm():
    html = "<html><body><nav><a>Home</a></nav><article><h1>One</h1><p>Some words here.</p><p>More.</p></article><footer>Foot</footer></body></html>"
    pages = [blocks.leaves(html), blocks.leaves("<p>alone</p>"), blocks.leaves("<div><p>a b</p><ul><li>c</li></ul></div>")]
    assert min(map(len, pages)) == 1 and len(pages[0]) >= 4
    rng, net = np.random.default_rng(4), blocks.new_net()
    net = {k: v + rng.normal(0, 0.3, v.shape) for k, v in net.items()}
    got = blocks.scores(net, blocks.Vectors(pages, {}))
    at = 0
    for page in pages:
        flat = blocks.Vectors([page], {}).means(net)
        f, b = _plain_side(net, "f", flat), _plain_side(net, "b", flat[::-1])[::-1]
        for k in range(len(page)):
            total = float(net["o"][0]) + sum(a * float(w) for a, w in zip(f[k], net["of"])) + sum(a * float(w) for a, w in zip(b[k], net["ob"]))
            assert got[at + k] == pytest.approx(1 / (1 + math.exp(-total)))
        at += len(page)


def test_gradients_are_those_of_small_steps():
    rng, net = np.random.default_rng(6), blocks.new_net()
    net = {k: v + rng.normal(0, 0.2, v.shape) for k, v in net.items()}
    x = rng.normal(size=(5, 2, net["xf"].shape[0]))
    pull = rng.normal(size=(5, 2, blocks.HIDDEN))

    def loss():
        return float((blocks._lstm(net, "f", x)[0] * pull).sum())

    grad = {k: np.zeros_like(v) for k, v in net.items()}
    dx = blocks._lstm_back(net, grad, "f", x, blocks._lstm(net, "f", x, keep=True)[1], pull)
    for array, slope in ((net["xf"], grad["xf"]), (net["hf"], grad["hf"]), (net["bf"], grad["bf"]), (x, dx)):
        for _ in range(8):
            i = tuple(int(rng.integers(n)) for n in array.shape)
            old = array[i]
            array[i] = old + 1e-5
            up = loss()
            array[i] = old - 1e-5
            down = loss()
            array[i] = old
            assert (up - down) / 2e-5 == pytest.approx(slope[i], rel=1e-4, abs=1e-7)
