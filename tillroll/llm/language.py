"""Language identification of mixed-language texts.

A word is a run of non-space bytes, lower-cased in ASCII. Its script (by the
ranges of UTF-8 lead bytes) narrows the candidates to the languages in which
the script was seen in training; its score in a candidate is the mean log
probability of its byte n-grams (2 to 4 bytes, with the blanks around it),
times the square root of their number. Viterbi decoding over a text's words,
with a penalty for each switch of language, labels spans; the text's language
is the one with the most letters in its spans, and the score is its share.

Training reads a bounded sample: the ``MAX_TRAIN`` documents with a language and
the smallest hash of their id, among those that aren't held out (crc32 of the
id as text, modulo ``FOLDS``, equal to ``HELD_OUT``). n-grams are counted where
the documents are and summed by Spark; at most ``1 << BITS`` counts a language
reach the driver, for at most ``MAX_LANGS`` languages (those with the most
documents in the sample).

Texts are decoded side by side, as many as ``CELLS`` allows. A text of more than
``BATCH_BYTES`` is scored in parts cut at white space; the decoding goes on from
part to part and keeps only its back pointers, so the result is that of the
whole text. A single word is never cut.

Defined results: ``und`` with score 0 where the text is null, empty or has no
letter, or where no language was learnt; ties go to the language first in
code-point order; a null id counts as empty text in the fold; repeated rows are
labelled each on their own; of an id that stands for several texts in one
language the first in order is learnt; an empty table gives an empty result. A text of any
length is labelled whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.hashing import Rolling, batches

BITS = 16
SIZES = (2, 3, 4)
MAX_TRAIN = 6_000
MAX_LANGS = 128
FOLDS, HELD_OUT = 4, 2
SWITCH_PENALTY = 6.0
#: Pseudo-count of an n-gram slot.
SMOOTHING = 0.5
#: A script belongs to a language from this share of its words on.
MIN_SCRIPT_SHARE = 0.001
#: What a language that doesn't use the word's script gets for it.
EXCLUDED = -50.0
BATCH_BYTES = 1 << 19
#: Texts that are decoded together, and the steps times lanes times languages of one decoding.
LANES = 64
CELLS = 1 << 22
_BLANK = re.compile(rb"[ \t-\r]")

#: Scripts by the first lead byte beyond ASCII: Latin, Greek, Cyrillic,
#: Armenian and Hebrew, Arabic and neighbours, Indic and South-East Asian,
#: general punctuation and symbols, Kana and CJK, Hangul, rest.
_SCRIPT_FROM = ((0, 0), (0xCD, 1), (0xD0, 2), (0xD5, 3), (0xD8, 4), (0xE0, 5), (0xE2, 0), (0xE3, 6), (0xEA, 7), (0xEE, 8))
N_SCRIPTS = 9
_SCRIPT = np.zeros(256, np.int8)
for _from, _name in _SCRIPT_FROM:
    _SCRIPT[_from:] = _name
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 256)]] = True


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


class Words(NamedTuple):
    """The words of some texts: owner (text), script, letters, and the n-gram
    slots of all of them with the word that each belongs to."""

    owner: np.ndarray
    script: np.ndarray
    letters: np.ndarray
    slots: list[np.ndarray]
    words: list[np.ndarray]


def words_of(texts: list[bytes]) -> Words:
    raw = np.frombuffer(b" " + b"  ".join(texts) + b"  ", np.uint8)
    data = _LOWER[raw]
    inside = data != 32
    start = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    end = np.flatnonzero(~inside & np.concatenate([[False], inside[:-1]]))
    begins = np.cumsum([0, *(len(t) + 2 for t in texts[:-1])]) + 1
    owner = np.searchsorted(begins, start, side="right") - 1
    # A word's letters and its script: the largest of its bytes' scripts.
    letters = np.concatenate([[0], np.cumsum(_LETTER[raw] & ((raw < 128) | (raw >= 0xC3)))])
    script = np.maximum.reduceat(_SCRIPT[raw] * inside, start) if len(start) else np.empty(0, np.int8)
    # n-grams start at the blank before a word and end at the blank after it.
    word_at = np.cumsum(np.concatenate([inside[1:] & ~inside[:-1], [False]])) - 1
    last = np.concatenate([end, [0]])[word_at]
    rolling = Rolling(data)
    slots, words = [], []
    for n in SIZES:
        names = rolling.windows(n)
        at = np.arange(len(names))
        ok = (word_at[: len(names)] >= 0) & (at + n - 1 <= last[: len(names)])
        slots.append((names[ok] >> np.uint64(64 - BITS)).astype(np.int64))
        words.append(word_at[: len(names)][ok])
    return Words(owner, script, letters[end] - letters[start], slots, words)


class Model(NamedTuple):
    langs: list[str]
    score: np.ndarray  # slots x languages, log probabilities
    scripts: np.ndarray  # scripts x languages, bool


def fit(docs: DataFrame) -> Model:
    sample = (
        docs.where("doc_id is not null and lang is not null")
        .where(fold(F.col("doc_id")) != HELD_OUT)
        .select("doc_id", "lang", "text")
    )
    # Choose by narrow rows; texts join afterwards, one for each id and language.
    own, most = Window.partitionBy("_lang"), Window.orderBy(F.col("n").desc(), "_lang")
    chosen = (
        sample.select(F.xxhash64("doc_id").alias("place"), F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
        .distinct()
        .orderBy("place", "_id", "_lang")
        .limit(MAX_TRAIN)
        .withColumn("n", F.count(F.lit(1)).over(own))
        .withColumn("kept", F.dense_rank().over(most) <= MAX_LANGS)
        .where("kept")
        .select("_id", "_lang")
    )
    same = (sample["doc_id"] == chosen["_id"]) & (sample["lang"] == chosen["_lang"])
    sample = sample.join(chosen, same).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << BITS) + N_SCRIPTS
        for part in parts:
            langs = part.column(0).to_pylist()
            texts = [(t or "").encode() for t in part.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs) if x == lang]
                total = np.zeros(size, np.int64)
                for a, b in batches([len(t) for t in own], BATCH_BYTES):
                    found = words_of(own[a:b])
                    for s in found.slots:
                        total[: 1 << BITS] += np.bincount(s, minlength=1 << BITS)
                    total[1 << BITS :] += np.bincount(found.script, minlength=N_SCRIPTS)
                slot = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(slot), pa.string()), pa.array(slot.astype(np.int32)), pa.array(total[slot])], ["lang", "slot", "n"]
                )

    counts = sample.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counts.column("lang").to_pylist(), object)
    langs = sorted(set(names.tolist()))
    total = np.zeros(((1 << BITS) + N_SCRIPTS, len(langs)))
    place = {x: i for i, x in enumerate(langs)}
    total[counts.column("slot").to_numpy(), [place[x] for x in names]] = counts.column("n").to_numpy()
    grams, scripts = total[: 1 << BITS] + SMOOTHING, total[1 << BITS :]
    return Model(
        langs,
        np.log(grams / grams.sum(axis=0)).astype(np.float32),
        scripts >= MIN_SCRIPT_SHARE * scripts.sum(axis=0),
    )


def word_scores(found: Words, model: Model) -> np.ndarray:
    """words x languages."""
    n_words, n_langs = len(found.owner), len(model.langs)
    total, number = np.zeros((n_words, n_langs), np.float32), np.zeros(n_words, np.float32)
    for slot, word in zip(found.slots, found.words):
        if len(word):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            total[word[first]] += np.add.reduceat(model.score[slot], first, axis=0)
            number[word[first]] += np.diff(np.append(first, len(word)))
    total /= np.sqrt(np.maximum(number, 1))[:, None]
    allowed = model.scripts[found.script]
    # Where no language has the script, all of them stay candidates.
    return np.where(allowed | ~allowed.any(axis=1, keepdims=True), total, total + EXCLUDED)


def viterbi(scores: list[np.ndarray]) -> list[np.ndarray]:
    """The best language of each word of each text, all texts in step."""
    order = np.argsort([-len(s) for s in scores], kind="stable")
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    lo = 0
    while lo < len(order):
        steps, n_langs = scores[order[lo]].shape
        if not steps:
            break
        # The longest text sets the steps of all lanes beside it.
        lane = order[lo : lo + min(LANES, max(1, CELLS // (steps * n_langs)))]
        lo += len(lane)
        lengths = np.array([len(scores[i]) for i in lane])
        emit = np.zeros((steps, len(lane), n_langs), np.float32)
        for k, i in enumerate(lane):
            emit[: lengths[k], k] = scores[i]
        best = emit[0].astype(np.float64)
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # texts longer than t
        switched = np.zeros((steps, len(lane), n_langs), bool)
        leader = np.zeros((steps, len(lane)), np.int16)
        for t in range(1, steps):
            a = active[t]
            b = best[:a]
            lead = b.argmax(axis=1)
            jump = b[np.arange(a), lead][:, None] - SWITCH_PENALTY
            switched[t, :a] = jump > b
            leader[t, :a] = lead
            best[:a] = np.maximum(b, jump) + emit[t, :a]
        state = best.argmax(axis=1)
        path = np.zeros((steps, len(lane)), np.int16)
        rows = np.arange(len(lane))
        for t in range(steps - 1, -1, -1):
            a = active[t]
            path[t, :a] = state[:a]
            if t:
                jumped = switched[t, rows[:a], state[:a]]
                state[:a] = np.where(jumped, leader[t, :a], state[:a])
        for k, i in enumerate(lane):
            out[i] = path[: lengths[k], k]
    return out


def _parts(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of ``BATCH_BYTES`` or, up to the next white space, more."""
    at = 0
    while len(text) - at > BATCH_BYTES:
        cut = _BLANK.search(text, at + BATCH_BYTES)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def label_long(text: bytes, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """As ``label``, for one text, whose scores are in memory a part at a time."""
    best, letters, back = None, [], []
    for part in _parts(text):
        found = words_of([part])
        emit = word_scores(found, model)
        letters.append(found.letters.astype(np.int32))
        switched, leader = np.zeros(emit.shape, bool), np.zeros(len(emit), np.int16)
        for t, one in enumerate(emit):
            if best is None:
                best = one.astype(np.float64)
                continue
            lead = best.argmax()
            jump = best[lead] - SWITCH_PENALTY
            switched[t], leader[t] = jump > best, lead
            best = np.maximum(best, jump) + one
        back.append((np.packbits(switched, axis=1), leader))
    if best is None:
        return np.empty(0, np.int16), np.empty(0, np.int32)
    state, paths = int(best.argmax()), []
    for packed, leader in reversed(back):
        switched = np.unpackbits(packed, axis=1, count=len(best))
        path = np.empty(len(leader), np.int16)
        for t in range(len(leader) - 1, -1, -1):
            path[t] = state
            if switched[t, state]:
                state = int(leader[t])
        paths.append(path)
    return np.concatenate(paths[::-1]), np.concatenate(letters)


def label(texts: list[bytes], model: Model) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, the language number and the letters of each word."""
    if len(texts) == 1 and len(texts[0]) > BATCH_BYTES:
        return [label_long(texts[0], model)]
    found = words_of(texts)
    scores = word_scores(found, model)
    bounds = np.searchsorted(found.owner, np.arange(len(texts) + 1))
    paths = viterbi([scores[a:b] for a, b in zip(bounds[:-1], bounds[1:])])
    return [(path, found.letters[a:b]) for path, a, b in zip(paths, bounds[:-1], bounds[1:])]


def spans(path: np.ndarray, langs: list[str]) -> list[tuple[int, int, str]]:
    """(first word, words, language) of each span of equal language."""
    cut = np.flatnonzero(np.concatenate([[True], path[1:] != path[:-1]])) if len(path) else np.empty(0, np.int64)
    return [(int(a), int(b - a), langs[path[a]]) for a, b in zip(cut, np.append(cut[1:], len(path)))]


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, and the number
    of spans found in it."""
    model_of = docs.sparkSession.sparkContext.broadcast(fit(docs))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of.value
        for part in parts:
            texts = [t or "" for t in part.column(2).to_pylist()]
            raw = [t.encode() for t in texts]
            pred, score, n_spans = [], [], []
            for a, b in batches([len(t) for t in raw], BATCH_BYTES):
                labelled = label(raw[a:b], model) if model.langs else [(np.empty(0, np.int64),) * 2] * (b - a)
                for text, (path, letters) in zip(texts[a:b], labelled):
                    if not len(path) or not _has_letter(text):
                        pred.append("und")
                        score.append(0.0)
                        n_spans.append(0)
                        continue
                    weight = np.bincount(path, weights=np.maximum(letters, 1e-9), minlength=len(model.langs))
                    pred.append(model.langs[int(weight.argmax())])
                    score.append(float(weight.max() / weight.sum()))
                    n_spans.append(len(spans(path, model.langs)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(n_spans, pa.int32())],
                ["doc_id", "held_out", "lang_pred", "score", "n_spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (fold(docs["doc_id"]) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, n_spans int")
