"""Toxicity scores by FTRL-proximal logistic regression.

Features are hashed unigrams, bigrams and skip-grams (a word and the next but
one) of lower-cased words, and words cut to their first bytes (``STEMS``, for
inflected forms), present or not, in ``1 << BITS`` slots. FTRL-proximal
keeps a learning rate for each slot, and its L1 term leaves most weights at
exactly zero, so what is broadcast is small, and at most ``1 << BITS`` pairs.

Training reads a bounded sample: the ``MAX_TRAIN`` labelled documents with the
smallest hash of their id, among those that aren't held out (crc32 of the id as
text, modulo ``FOLDS``, equal to ``HELD_OUT``). Features are made where the
documents are; one task runs over the sample in hash order, ``EPOCHS`` times.
Every document is scored, over its whole text.

Defined results: null and empty texts get the score of the bias alone; a null
id counts as empty text in the fold; repeated rows are scored each on their
own; labels that are null, or whose document is missing, aren't learnt from; of an
id that stands for several texts the first in order is learnt, with each of its
labels;
without any labelled document all scores are 0.5; an empty table gives an empty
result. Of the documents only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import Rolling, batches, mix

BITS = 20
MAX_TRAIN = 12_000
EPOCHS = 6
#: Words count as a whole and cut to so many bytes.
STEMS = (4, 6)
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: FTRL-proximal: rate, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 16.0, 0.1
#: A toxic document counts as this many, since few are.
POSITIVE_WEIGHT = 3.0
BATCH_BYTES = 1 << 20

#: ASCII letters and digits and all bytes of longer characters make words;
#: capitals of ASCII become small.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first, text, slot): for texts from ``first`` on, the features found;
    a feature comes as often as it is found."""
    for first, last in batches([len(t) + 1 for t in texts], BATCH_BYTES):
        part = texts[first:last]
        raw = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
        inside = _WORD[raw]
        start = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        end = np.flatnonzero(~inside & np.concatenate([[False], inside[:-1]]))
        rolling = Rolling(_LOWER[raw])
        words = rolling.names(start, end)
        ends = np.cumsum([len(t) + 1 for t in part])
        owner = np.searchsorted(ends, start, side="right")
        slots, owners = [words], [owner]
        for stem in STEMS:  # inflected forms share their beginnings
            slots.append(mix(rolling.names(start, np.minimum(end, start + stem)) + np.uint64(stem)))
            owners.append(owner)
        for step in (1, 2):
            if len(words) > step:
                same = owner[:-step] == owner[step:]
                pair = mix(words[:-step] + np.uint64(step) * mix(words[step:] + np.uint64(step)))
                slots.append(pair[same])
                owners.append(owner[:-step][same])
        yield first, np.concatenate(owners), (np.concatenate(slots) >> np.uint64(64 - BITS)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, int]]) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, slots, weights) learnt from (distinct slots, label) in order."""
    size = (1 << BITS) + 1  # the last slot is the bias
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zs, l1 = z[at], np.where(at == size - 1, 0.0, L1)
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for slots, label in rows:
            at = np.append(slots, size - 1)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            gradient *= POSITIVE_WEIGHT if label else 1.0
            more = gradient * gradient
            sigma = (np.sqrt(n[at] + more) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += more
    w = weights(np.arange(size))
    slots = np.flatnonzero(w[:-1])
    return float(w[-1]), slots, w[:-1][slots]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    """Learn from the bounded sample; the sparse weights reach the driver."""
    known = labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = (
        known.where(fold(F.col("_id")) != HELD_OUT)
        .distinct()
        .withColumn("place", F.xxhash64("_id"))
        .orderBy("place", "_id", "toxic")
        .limit(MAX_TRAIN)
    )
    # One text for each id and label, however often they occur.
    sample = docs.select("doc_id", "text").join(chosen, docs["doc_id"] == chosen["_id"]).groupBy("place", "_id", "toxic").agg(F.min("text").alias("text")).drop("_id")

    def extract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [(t or "").encode() for t in part.column(2).to_pylist()]
            found = []
            for first, owner, slot in features(texts):
                order = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[order], np.arange(owner.max() + 2 if len(owner) else 1))
                found += [(first + i, np.unique(slot[order[a:b]])) for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
            sets = dict(found)
            none = np.empty(0, np.int64)
            raw = [sets.get(i, none).astype("<u4").tobytes() for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())], ["place", "toxic", "slots"])

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for part in parts:
            rows += zip(part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(1).to_pylist())
        rows.sort()
        bias, slots, weights = train([(np.frombuffer(x, "<u4").astype(np.int64), y) for _, x, y in rows])
        yield pa.RecordBatch.from_pydict(
            {"bias": [bias], "slots": [slots.astype("<u4").tobytes()], "weights": [weights.astype("<f4").tobytes()]},
            schema=pa.schema([("bias", pa.float64()), ("slots", pa.binary()), ("weights", pa.binary())]),
        )

    extracted = sample.mapInArrow(extract, "place long, toxic int, slots binary")
    model = extracted.repartition(1).mapInArrow(learn, "bias double, slots binary, weights binary").collect()
    if not model:
        return 0.0, np.empty(0, np.int64), np.empty(0, np.float32)
    row = model[0]
    return row["bias"], np.frombuffer(row["slots"], "<u4").astype(np.int64), np.frombuffer(row["weights"], "<f4")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted label of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, slots, values = model.value
        weight = np.zeros(1 << BITS, np.float64)
        weight[slots] = values
        for part in parts:
            texts = [(t or "").encode() for t in part.column(2).to_pylist()]
            total = np.full(len(texts), bias)
            for first, owner, slot in features(texts):
                hit = weight[slot] != 0
                each = np.unique(np.stack([owner[hit] + first, slot[hit]]), axis=1)
                np.add.at(total, each[0], weight[each[1]])
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            predicted = (score >= THRESHOLD).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(score), pa.array(predicted)], ["doc_id", "held_out", "score", "predicted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (fold(docs["doc_id"]) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
