"""N-gram Jaccard join by MinHash banding.

1. *Classes.* Documents of equal text are one class, named by its smallest id;
   everything below is about one representative a class.
2. *Signatures.* The set of a text is its n-grams of ``N`` words
   (``[^\\x20\\x09-\\x0D]+``; a shorter text is one n-gram of all its words, a
   text without words has none). Each n-gram has a 64-bit name; a signature
   keeps, for each of many hash functions, the smallest value in the set.
3. *Banding.* ``bands_for`` picks the most rows a band, and then the fewest
   bands, that find a pair at the threshold with the target recall. Band hashes
   are counted, those seen once drop out, and the members of the others are
   tied to the smallest id of their bucket: one row a member, never a pair.
   The components of these ties are the *neighbourhoods*; every pair that
   shares a band lies within one.
4. *Verification on full n-gram sets.* A neighbourhood is cut into blocks of
   ``BLOCK`` members, and each pair of blocks is compared in one task, by
   counting the shared n-grams of all its pairs with a matrix product over
   slices of the n-grams. A task sends on one row a member: how many documents
   it is linked to, and the smallest member it is connected to; pairs aren't
   sent.
5. *Result.* Links are summed by representative, and the components of the
   links are the classes of near-duplicates.

All pairs of a neighbourhood are compared, so links are found with at least
the banding's recall, and no pair below the threshold is ever linked.

Defined results: null and empty texts have an empty set and no links, not even
to each other; equal texts are linked to each other; repeated rows (the same
id and text again) are documents of their own in the counts and share a class;
rows without an id take no part and :func:`first_of_each` keeps them; an empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import SPACES, fresh, give_back, tidy, written
from tillroll.llm.components import components
from tillroll.llm.hashing import Rolling, batches, mix

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
#: Members of a neighbourhood that one side of a comparison holds.
BLOCK = 1024
#: n-grams that a comparison looks at together.
SLICE = 4096
#: Bytes of text that are hashed together.
BATCH_BYTES = 1 << 20


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the longest band with which ``hashes`` hash functions
    still find a pair at the threshold with the target recall."""
    for rows in range(hashes, 0, -1):
        for bands in range(1, hashes // rows + 1):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                return bands, rows
    raise ValueError("too few hash functions for this recall")


_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True


def ngram_names(texts: list[bytes], n: int = N) -> Iterator[np.ndarray]:
    """The distinct n-gram names of each text, sorted."""
    for first, last in batches([len(t) + 1 for t in texts], BATCH_BYTES):
        part = texts[first:last]
        data = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
        space = _SPACE[data]
        word_start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        word_end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
        words = Rolling(data).names(word_start, word_end)
        ends = np.cumsum([len(t) + 1 for t in part])
        bounds = np.concatenate([[0], np.searchsorted(word_start, ends)])
        m = max(0, len(words) - n + 1)
        grams = np.zeros(m, np.uint64)
        for k in range(n):
            grams = mix(grams + words[k : k + m])
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                short = np.zeros(1, np.uint64)
                for w in words[a:b]:
                    short = mix(short + w)
                yield mix(short + np.uint64(b - a))
            else:
                yield np.empty(0, np.uint64)


def signature(grams: np.ndarray, hashes: int) -> np.ndarray:
    """The smallest value of each hash function over a set of n-gram names."""
    factors = mix(np.arange(1, hashes + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        part = grams[at : at + 2048, None] * factors[None, :]
        np.minimum(out, (part ^ (part >> np.uint64(32))).min(axis=0), out=out)
    return out


def _bands(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, hashes) of every document with a word: one hash a band."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [(t or "").encode() for t in part.column(1).to_pylist()]
            ids, keys = [], []
            for i, grams in enumerate(ngram_names(texts)):
                if len(grams):
                    sig = signature(grams, bands * rows).reshape(bands, rows)
                    key = np.arange(bands, dtype=np.uint64)
                    for r in range(rows):
                        key = mix(key + sig[:, r])
                    ids.append(i)
                    keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(ids, pa.int64())), pa.array(keys, pa.list_(pa.int64()))], ["id", "hashes"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "id long, hashes array<long>")


def _ngram_sets(members: DataFrame) -> DataFrame:
    """``members`` with their n-gram names as bytes in place of their text."""
    names = [c for c in members.columns if c != "text"]

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            sets = [g.tobytes() for g in ngram_names(texts)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(sets, pa.binary())], [*names, "grams"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema if f.name != "text")
    return members.mapInArrow(run, f"{schema}, grams binary")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of every left with every right set."""
    counts = np.zeros((len(left), len(right)), np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(a, b)
    a_row = np.repeat(np.arange(len(left)), [len(x) for x in left])
    b_row = np.repeat(np.arange(len(right)), [len(x) for x in right])

    def column(names: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(common, names)
        at[at == len(common)] = 0
        hit = common[at] == names
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], row[hit][order]

    if not len(common):
        return counts
    (a_at, a_row), (b_at, b_row) = column(a, a_row), column(b, b_row)
    for start in range(0, len(common), SLICE):
        stop = min(start + SLICE, len(common))
        x = np.zeros((len(left), stop - start), np.float32)
        y = np.zeros((len(right), stop - start), np.float32)
        for m, at, row in ((x, a_at, a_row), (y, b_at, b_row)):
            lo, hi = np.searchsorted(at, [start, stop])
            m[row[lo:hi], at[lo:hi] - start] = 1
        counts += x @ y.T
    return counts


def _links(left: pd.DataFrame, right: pd.DataFrame | None = None) -> pd.DataFrame:
    """Links and the smallest connected member, by member, of all pairs of one
    block (right: None) or of two."""
    alone = right is None
    right = left if alone else right
    a, b = ([np.frombuffer(x, np.uint64) for x in side["grams"]] for side in (left, right))
    shared = shared_counts(a, b).astype(np.int64)
    union = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - shared
    least = Fraction(THRESHOLD).limit_denominator(1000)
    linked = least.denominator * shared >= least.numerator * union
    if alone:
        np.fill_diagonal(linked, False)
    sides = [(linked, left, right)] if alone else [(linked, left, right), (linked.T, right, left)]
    out = [
        pd.DataFrame(
            {"id": own["id"].to_numpy(), "links": one @ other["copies"].to_numpy(), "near": _smallest(one, own["id"].to_numpy(), other["id"].to_numpy())}
        )
        for one, own, other in sides
    ]
    return pd.concat(out).query("links > 0")


def _compared(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """A pair of blocks of one neighbourhood, or many small neighbourhoods."""
    _, i, j = key
    try:
        if i != j:
            return _links(group[group["block"] == i], group[group["block"] == j])
        return pd.concat([_links(part) for _, part in group.groupby("component")])
    finally:
        give_back()


def _smallest(linked: np.ndarray, own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The smallest id among each row's links and the row itself, carried over
    the links until nothing changes."""
    label = own.copy()
    far = others.copy()
    top = np.iinfo(np.int64).max
    while True:
        step = np.minimum(label, np.where(linked, far[None, :], top).min(axis=1, initial=top))
        back = np.minimum(far, np.where(linked, step[:, None], top).min(axis=0, initial=top))
        if (step == label).all() and (back == far).all():
            return label
        label, far = step, back


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, rep_id, class_id, n_links) of every document with an id.

    ``rep_id`` is the smallest id with the same text, ``class_id`` the smallest
    id of the near-duplicate class, ``n_links`` the number of other documents
    at the threshold or above.
    """
    named = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    wordless = F.length(F.translate("text", SPACES, "")) == 0
    marked = named.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), wordless.alias("wordless"))
    classes = marked.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    members = written(
        marked.join(classes, "digest").select(
            "doc_id",
            F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("rep")).alias("rep"),
            F.when(F.col("wordless"), F.lit(1)).otherwise(F.col("copies")).alias("copies"),
        ),
        "near-members",
    )
    reps = members.where("doc_id = rep").select(F.col("doc_id").alias("id"), "copies").distinct()
    bands, rows = bands_for()
    # Copies have the bands of their representative, whose row is enough.
    hashed = written(_bands(named, bands, rows).join(reps, "id", "left_semi"), "near-bands")
    each = hashed.select("id", F.posexplode("hashes").alias("band", "hash"))
    buckets = each.groupBy("band", "hash").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    ties = (
        each.join(buckets.where("least < most"), ["band", "hash"])
        .where("id <> least")
        .select(F.col("id").alias("a"), F.col("least").alias("b"))
    )
    around = components(ties).withColumnRenamed("id", "member")
    links = written(_verified(named, reps, around), "near-links")
    classed = components(links.select(F.col("id").alias("a"), F.col("near").alias("b"))).withColumnRenamed("id", "rep")
    counted = links.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    return (
        members.join(counted, "rep", "left")
        .join(classed, "rep", "left")
        .select(
            "doc_id",
            F.col("rep").alias("rep_id"),
            F.coalesce("component", "rep").alias("class_id"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        )
    )


def _verified(named: DataFrame, reps: DataFrame, around: DataFrame) -> DataFrame:
    """(id, links, near): a row for each member of a neighbourhood and each
    comparison in which it has links."""
    sizes = around.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    total = around.count()
    cut = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (
        around.join(sizes, "component")
        .join(reps, F.col("member") == reps["id"])
        .select("id", "copies", "component", cut.alias("blocks"), F.pmod(F.xxhash64("id"), cut).cast("int").alias("block"))
    )
    sets = _ngram_sets(
        named.join(placed, named["doc_id"] == placed["id"]).select("id", "copies", "component", "blocks", "block", "text")
    )
    # A block meets each block of its neighbourhood once; small neighbourhoods
    # share a task, about BLOCK members together.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = sets.withColumn("other", other).select(
        "id",
        "copies",
        "component",
        "block",
        "grams",
        F.when(F.col("blocks") > 1, F.col("component"))
        .otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(total // BLOCK + 1)))
        .alias("unit"),
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )
    return pairs.groupBy("unit", "i", "j").applyInPandas(_compared, "id long, links long, near long")


def first_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the one with
    the smallest id. Rows without an id stay. Of rows equal in id and text one
    stays. An id that stands for several texts names none of them, so all of
    these stay."""
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    texts = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_kept")).agg(F.min(digest).alias("a"), F.max(digest).alias("b"))
    kept = near_duplicates(docs).where("doc_id = class_id").select(F.col("doc_id").alias("_kept")).union(texts.where("a <> b").select("_kept")).distinct()
    turn = fresh(docs, "_turn")
    one = Window.partitionBy("doc_id", "text").orderBy(F.lit(0))
    named = (
        docs.join(kept, docs["doc_id"] == kept["_kept"], "left_semi")
        .withColumn(turn, F.row_number().over(one))
        .where(F.col(turn) == 1)
        .drop(turn)
    )
    return named.unionByName(docs.where("doc_id is null"))
