"""Hard negatives, packing and the conversation trie against brute force."""

import collections
import hashlib
import math
import unicodedata
import zlib

import numpy as np
import pytest

import __spark_entry__
from tillroll.llm import bond, packing, prefix_trie, wordbpe
from tillroll.llm.common import ship

VECTORS = "vec_id long, embedding array<float>, label int, rank string, score double, id int, block string"
DOCS = "doc_id long, text string, lang string, length string, part string, ids string"
TURNS = "conv_id long, turn long, role string, text string, depth string, kind string"


def _query(spark, tmp_path, name, table, df):
    df.write.parquet(f"{tmp_path}/{table}.parquet")
    return [tuple(r) for r in __spark_entry__.queries()[name](spark, str(tmp_path)).collect()]


# --- hard negatives -----------------------------------------------------------


def _vectors():
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1000):
        v = rng.normal(0, 0.3, 12).astype(np.float32)
        if i % 4 == 1:  # one very common vector, whose scores all tie
            v = np.full(12, 0.25, np.float32)
        rows.append([i, [float(x) for x in v], int(rng.integers(0, 10))])
    rows[100][1] = rows[1][1]
    rows[200][1] = [0.0] * 12
    rows[300][1] = [-x for x in rows[1][1]]
    rows[301][1], rows[302][1], rows[303][1] = None, [], [0.1, None] + [0.0] * 10
    rows[304][1], rows[305][1] = [math.nan] + [0.0] * 11, [math.inf] + [0.0] * 11
    rows[306][2], rows[400][2] = None, None
    rows[307][1] = rows[308][1] = rows[700][1] = [0.5, 0.5, 0.25]
    rows[307][2] = (rows[700][2] + 1) % 10  # 700 is shifted to this label
    rows += [rows[101], [None, rows[5][1], 1], [800, [9.0] * 12, 9], [800, [-9.0] * 12, 9]]
    return rows


def _shifted(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


def _brute_negatives(rows):
    known = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            row = (_shifted(i, label), [math.floor(256 * float(np.float32(x))) for x in v])
            known[i] = min(known.get(i, row), row)
    out = []
    for a in (i for i in known if i % 100 == 0):
        label, v = known[a]
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in known.items() if i != a and len(w) == len(v)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if known[i][0] == label][:5]:
            fit = [i for i in order if known[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k, n, score[p], score[n]) for k, n in enumerate(fit[:10], 1)]
    return out


def test_op11_gives_the_negatives_of_brute_force(spark, tmp_path):
    rows = _vectors()
    table = spark.createDataFrame([(*r, "x", 1.0, 7, "b") for r in rows], VECTORS).repartition(5)
    got = _query(spark, tmp_path, "op11_bond_hard_negatives", "embeddings", table)
    expect = _brute_negatives(rows)
    assert len(expect) > 200 and sorted(got) == sorted(expect)


def test_op11_does_not_depend_on_blocks_and_takes_empty_tables(spark, monkeypatch):
    ship(spark)
    table = spark.createDataFrame([(*r, "x", 1.0, 7, "b") for r in _vectors()], VECTORS)
    whole = sorted(tuple(r) for r in bond.hard_negatives(table).collect())
    monkeypatch.setattr(bond, "LEAST_BLOCK", 50)
    monkeypatch.setattr(bond, "BLOCK_ROWS", 50)
    assert sorted(tuple(r) for r in bond.hard_negatives(table).collect()) == whole
    assert bond.hard_negatives(table.limit(0)).count() == 0


def test_scan_drops_candidates_early_and_keeps_ties():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.integers(-30, 30, (500, 32)), np.tile(rng.integers(100, 200, 32), (6, 1))])
    block = bond.Block(np.arange(506)[::-1].copy(), np.zeros(506, int), rows)
    [(ids, score)] = bond.scan(block, rows[-1], np.arange(506), np.array([-bond.LONGEST]), np.array([bond.LONGEST]), 3)
    assert ids.tolist() == [0, 1, 2] and len(set(score.tolist())) == 1
    big = bond.Block(np.arange(4), np.zeros(4, int), np.array([[2**30, 5], [2**30, 6], [-(2**30), 1], [1, 1]]))
    [(ids, score)] = bond.scan(big, np.array([2**29, 1]), np.arange(4), np.array([0]), np.array([bond.LONGEST]), 2)
    assert list(zip(ids.tolist(), score.tolist())) == [(1, 2**59 + 6), (0, 2**59 + 5)]
    with pytest.raises(ValueError, match="long"):
        bond.scan(big, np.array([2**40, 1]), np.arange(4), np.array([0]), np.array([1]), 2)


# --- packing ------------------------------------------------------------------


def test_plain_letters_are_classed_as_the_library_does():
    library = wordbpe.encoder(packing.default_tokenizer())
    assert library.by_word
    for c in wordbpe.PLAIN:
        assert unicodedata.normalize("NFC", c) == c and library.library.normalizer.normalize_str(c) == (" " if c.isspace() else c.lower())
        for text in (f"a{c}b", f"7{c}7", f"!{c}?", f"'{c}s {c}{c}'s", f"{c}'RE x{c}\n{c}"):
            assert library.encode([text]) == [library.whole(text)], hex(ord(c))


def _texts():
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "Stone river don't über naïve 42nd (it's) l'eau".split() for b in ("", ".", ",", "ing", "'s", "!!")]
    prose = lambda n: " ".join(words[i] for i in rng.integers(0, len(words), n))
    return [
        (0, None), (1, ""), (2, " \n\t"), (3, prose(9000)), (4, prose(2500)), (5, "日本語 текст ΑΣ İstanbul é " + prose(20)), (6, "a\x1cb\x1dc d e"),
        (7, "x" * 30000), (8, " " * 5000 + "end"), (9, "<|endoftext|> <|startoftext|>"), (None, prose(10)), (3, "again"), (3, "again"),
        *((100 + i, prose(int(n))) for i, n in enumerate(rng.integers(1, 1800, 60))), *((200 + i, "one and the same") for i in range(40)),
    ]


def _check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_tokenizer())
    library.encode_special_tokens = True
    expect = []
    for i, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        expect += [(i, k, at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
    assert collections.Counter(r[:5] for r in rows) == collections.Counter(expect)
    by = collections.defaultdict(list)
    for r in rows:
        by[r[5]].append((r[6], r[3]))
    for parts in by.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(by), max(-(-sum(r[3] for r in rows) // capacity), sum(r[3] > capacity / 2 for r in rows))


def test_op12_packs_the_ids_of_the_library_into_the_fewest_sequences(spark, tmp_path):
    texts = _texts()
    table = spark.createDataFrame([(i, t, "en", "l", "p", "x") for i, t in texts], DOCS).repartition(4)
    used, least = _check_packing(_query(spark, tmp_path, "op12_complement_packing", "documents", table), texts, 4096)
    assert used == least


def test_packed_sequences_hold_the_ids_and_long_texts_are_cut_safely(spark, monkeypatch):
    ship(spark)
    texts = _texts()
    table = spark.createDataFrame([(i, t, "en", "l", "p", "x") for i, t in texts], DOCS).repartition(3)
    packed = packing.pack(packing.pieces(table, 512), 512)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.digests(table.limit(0)).count() == 0
    short = wordbpe.Encoder(packing.default_tokenizer())
    long = "".join(t or "" for _, t in texts)
    plain = "".join(c for c in long if c in wordbpe.PLAIN)
    expect = [short.whole(long), short.whole(plain)]
    monkeypatch.setattr(wordbpe, "WINDOW", 1000)
    short.stretches.limit = short.words.limit = 50  # both generations turn over
    assert short.encode([long, plain]) == expect and short.encode([plain, long]) == expect[::-1]


def test_new_words_go_to_the_merges_once_and_without_the_pattern():
    own = wordbpe.Encoder(packing.default_tokenizer())
    text = "x" + " ".join(f"{c}ab A{c}, don't{c}{c}\t7{c}" for c in wordbpe.PLAIN)
    expect, library, asked = own.whole(text), own.library, []
    own.library = None  # not needed for such letters

    class Merges:
        def encode_batch_fast(self, texts, **options):
            asked.extend(w for t in texts for w in t.split(" "))
            return merges.encode_batch_fast(texts, **options)

    merges, own.merges = own.merges, Merges()
    assert own.encode([text, "", text]) == [expect, b"", expect] and own.encode([text]) == [expect]
    assert len(asked) == len(set(asked)) > 300
    own.library = library
    assert own.encode(["日本語 " + text]) == [own.whole("日本語 " + text)]


def _fewest(lengths, capacity):
    """The least number of sequences, by trying all ways."""
    best = len(lengths)

    def place(i, spaces):
        nonlocal best
        if len(spaces) >= best:
            return
        if i == len(lengths):
            best = len(spaces)
            return
        for s in sorted(set(spaces)):
            if s >= lengths[i]:
                rest = list(spaces)
                rest[rest.index(s)] = s - lengths[i]
                place(i + 1, rest)
        place(i + 1, [*spaces, capacity - lengths[i]])

    place(0, [])
    return best


def test_plans_take_every_piece_once_and_come_near_the_least_number():
    rng = np.random.default_rng(7)
    for case in range(60):
        capacity = int(rng.integers(4, 40))
        lengths = sorted(rng.integers(1, capacity + 1, int(rng.integers(0, 10))).tolist(), reverse=True)
        made = packing.plan(np.bincount(np.array(lengths, int), minlength=capacity + 1))
        taken = collections.Counter()
        for parts, n in made:
            assert sum(parts) <= capacity and n > 0
            for p in parts:
                taken[p] += n
        assert taken == collections.Counter(lengths)
        assert sum(n for _, n in made) <= _fewest(lengths, capacity) + 1
    counts = np.zeros(4097, int)
    counts[1:4096] = rng.integers(0, 50, 4095)
    made = packing.plan(counts)
    total = int((counts * np.arange(4097)).sum())
    assert sum(n for _, n in made) <= 1.003 * max(total / 4096, counts[2049:].sum())


# --- the trie -----------------------------------------------------------------


def _turns():
    rng = np.random.default_rng(2)
    say = lambda: " ".join(rng.choice(["é日", "yes", "no", "maybe", "why?"], 3))
    rows = []
    for c in [*range(0, 130), *range(250, 275), 1000, 1001, 1007, 5000, -3, -100, 32100]:
        for t in range(int(rng.integers(0, 9)) if c not in (0, 100) else 4):
            rows.append((c, t, "user" if t % 2 else "assistant", say()))
    for c in (1003, 1013, 1023, 1033):  # copies of a whole conversation
        rows += [(c, t, "user", f"copied {t}") for t in range(12)]
    for c in (700, 701):  # long ones with a long common part
        rows += [(c, t, "user", f"turn {t}" if t < 300 or c == 700 else f"other {t}") for t in range(400)]
    rows += [(40, None, None, None), (40, None, "user", None), (40, 2, None, "x"), (41, 0, "a", "bc"), (42, 0, "ab", "c"), (None, 1, "user", "nobody")]
    rows += [(43, 5, "user", "twice"), (43, 5, "user", "twice"), (1000, 0, "user", "z" * 70000)]
    return rows


def _trie(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [(r, x) for *_, r, x in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        paths[c] = own.get(base, [])[:h] + turns[h:]
    nodes = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    children = collections.Counter(k[:-1] for k in nodes if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (
            min(m), len(k), -(10**9) if not k else min(nodes[k[:-1]]), len(m), children[k], leaves[k], saved[k],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(k)).encode()).hexdigest(),
        )
        for k, m in nodes.items()
    )


def _sorted(rows):
    return sorted((*r[:2], -(10**9) if r[2] is None else r[2], *r[3:8]) for r in map(tuple, rows))


def test_op13_gives_the_nodes_of_a_plain_trie(spark, tmp_path):
    rows = _turns()
    table = spark.createDataFrame([(*r, "d", "k") for r in rows], TURNS).repartition(5)
    assert _sorted(_query(spark, tmp_path, "op13_prefix_trie", "conversations", table)) == _trie(rows)


def test_op13_with_a_crowded_sketch_and_a_conversation_over_many_tasks(spark, monkeypatch):
    ship(spark)
    rows = [r for r in _turns() if r[0] is not None and r[0] >= 600]
    table = spark.createDataFrame([(*r, "d", "k") for r in rows], TURNS).repartition(5)
    for cells in (4096, 1 << 16):  # nearly all prefixes look shared, or hardly any
        monkeypatch.setattr(prefix_trie, "LEAST_CELLS", cells)
        monkeypatch.setattr(prefix_trie, "MOST_CELLS", cells)
        assert _sorted(prefix_trie.prefix_trie(table).collect()) == _trie(rows)


def test_op13_of_tables_without_turns(spark):
    ship(spark)
    none = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(none).count() == 0
    # 2 has no turns left: its first one goes, and there is no conversation 0.
    rows = [(2, 0, "user", "x")]
    table = spark.createDataFrame([(*r, "d", "k") for r in rows], TURNS)
    assert zlib.crc32(b"2") % 6 > 0 and _sorted(prefix_trie.prefix_trie(table).collect()) == _trie(rows)


def test_digests_go_on_over_many_tasks(spark):
    ship(spark)
    rows = [(c, t, "user", f"turn {t % 7}") for c in (1, 2, 3) for t in range(700 if c == 2 else 3)]
    table = spark.createDataFrame([(*r, "d", "k") for r in rows], TURNS)
    got = {(r.conv_id, r.pos): (r.s1, r.s2) for r in prefix_trie.digests(table).collect()}
    for c in (1, 2, 3):
        sums = [0, 0]
        for t in range(700 if c == 2 else 3):
            text = f"turn {t % 7}"
            raw = np.frombuffer(hashlib.sha256(f"4:user{text}".encode()).digest(), "<u8")
            for half, base in enumerate(prefix_trie.BASES):
                sums[half] = (sums[half] + int(raw[half]) * pow(base, t, 1 << 64)) & (2**64 - 1)
            assert tuple(x & (2**64 - 1) for x in got[c, t]) == tuple(sums)
