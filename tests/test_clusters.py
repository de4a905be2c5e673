"""Clusters of values against brute force."""

import itertools
import random

from tillroll.operators.clusters import NEAR_FROM, canonical_values, connected, fingerprint, one_edit_apart, value_clusters


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _print(v):
    words = sorted(set("".join(c.lower() if c.isalnum() else " " for c in v).split()))
    return " ".join(words) or None


def _clusters(counts):
    prints = {v: _print(v) for v in counts if v is not None}
    tops = {p: p for p in set(prints.values()) if p}
    near = [(a, b) for a, b in itertools.combinations(sorted(tops), 2) if min(len(a), len(b)) >= NEAR_FROM and _distance(a, b) == 1]
    for _ in tops:
        for a, b in near:
            tops[a] = tops[b] = min(tops[a], tops[b])
    out = {}
    for v in counts:
        top = tops.get(prints.get(v))
        same = [w for w in counts if top is not None and tops.get(prints.get(w)) == top]
        out[v] = min(same, key=lambda w: (-counts[w], w)) if same else v
    return out


def test_clusters_equal_brute_force(spark):
    rng = random.Random(3)
    counts = {None: 3, "": 2, " - ": 1, "Abc": 1, "Abd": 1}
    for base in ("Chocolate Milk 2%", "Doritos", "Crème brûlée", "7up zero", "Pepsi, Max"):
        for _ in range(14):
            v = base
            if rng.random() < 0.5:
                v = " ".join(rng.sample(v.split(), len(v.split())))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(v))
                v = rng.choice([v[:at] + v[at + 1 :], v[:at] + "x" + v[at:], v[:at] + "y" + v[at + 1 :], v.upper(), v + "!"])
            counts[v] = counts.get(v, 0) + rng.randrange(1, 4)
    rows = [(v, i) for v, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "name string, _print int").repartition(3)
    expect = _clusters(counts)
    got = {r.name: (r.canonical, r.rows) for r in value_clusters(df.select("name"), "name").collect()}
    assert got == {v: (expect[v], n) for v, n in counts.items()}
    assert len({c for c, _ in got.values()}) < len(counts) / 2
    mapped = canonical_values(df.select("name"), "name", "clean").collect()
    assert len(mapped) == len(rows) and all(r.clean == expect[r.name] for r in mapped)
    assert value_clusters(df.limit(0).select("name"), "name").count() == 0


def test_pairs_and_chains(spark):
    texts = ["aaaaa", "aaaab", "aaaabc", "aaa", "aab", "bbbbb", "abbbb", "bbbbbb"]
    df = spark.createDataFrame([(t,) for t in texts], "print string")
    got = {(r.a, r.b) for r in one_edit_apart(df).collect()}
    assert got == {tuple(sorted(p)) for p in itertools.combinations(texts, 2) if min(map(len, p)) >= NEAR_FROM and _distance(*p) == 1}
    chain = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(20)] + [("x", "z"), ("z", "y")], "a string, b string")
    assert {(r.text, r.top) for r in connected(chain).collect()} == {(f"n{i:02}", "n00") for i in range(21)} | {(c, "x") for c in "xyz"}
    one = spark.createDataFrame([("B, a  A",), (" ",), (None,)], "v string").select(fingerprint("v").alias("p"))
    assert [r.p for r in one.collect()] == ["a b", None, None]
