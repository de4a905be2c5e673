"""Removal of long repeated byte strings by ranks of growing length.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts
earlier (in a document of a smaller id, or at an earlier place of the same
one). Strings never cross documents.

Like prefix doubling, this ranks positions by their first h bytes and goes on,
with longer h, until a rank is unique or the threshold length is passed; unlike
it, positions are not sorted and ranks of pairs of positions not ranked again. A
round ranks *sampled* positions, and later rounds only look at strings that the
ranks so far leave open:

1. *Sample.* In each ``LENGTH``-byte string the one of its h-byte strings with
   the smallest hash (the first of them) is its anchor. Equal strings have
   equal anchors, and neighbouring strings mostly share one, so the strings
   fall into *runs* with a common anchor: 3 for each 100 bytes where h is 32.
2. *Rank by h bytes.* Runs whose anchor is unique hold no repeated string.
3. *Rank pair* (anchor, all bytes that the run's strings cover), past the
   threshold. Of equal runs the earliest represents the rest; the others are
   repeats from end to end.
4. *Next round.* Where representatives share an anchor but differ as a whole,
   their strings go on to the next h. At h = ``LENGTH`` a run is one string, its
   anchor is the string itself, and no string stays open.

Every first occurrence lies in a representative, so each round finds exactly
the repeats that the rounds before left. Ranks are equality classes, named by
64-bit hashes of the bytes (in pairs with a second hash), not places in a
sorted order, which the result doesn't need. Counts and smallest positions of a
rank are pre-aggregated, and runs come back to their rank by an equi-join, so
one passage in a third of all documents is split over tasks.

Defined results: a null or empty text has 0 bytes; texts under ``LENGTH``
bytes stay; rows equal in id and text share its positions and stay or go alike;
where an id stands for several texts, they follow each other by their digests;
rows without an id stay whole and remove nothing; an empty table gives an
empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, tidy, written
from tillroll.llm.hashing import Rolling, batches

LENGTH = 100
#: Anchor lengths of the rounds; the last one is LENGTH.
ROUNDS = (32, 84, LENGTH)
#: A run's start holds, above this many bits, which text of its id it is in.
PLACE_BITS = 40
#: Bytes of text that are hashed together.
BATCH_BYTES = 1 << 20


def _smallest_from(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values."""
    m = len(h) - width + 1
    top = np.iinfo(np.uint64).max
    rows = np.concatenate([h, np.full(-len(h) % width, top, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])


Places = tuple[np.ndarray, np.ndarray]  # starts and lengths of runs


def runs(texts: list[bytes], h: int, listed: list[Places] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, strings, rank by h bytes, second rank) of all runs: which
    text, where its first string starts, how many strings it has. Only strings
    that start in the places ``listed`` for their text count (None: all)."""
    long = [i for i, t in enumerate(texts) if len(t) >= LENGTH]
    for first, last in batches([len(texts[i]) for i in long], BATCH_BYTES):
        chosen = long[first:last]
        part = [texts[i] for i in chosen]
        data = np.frombuffer(b"".join(part), np.uint8)
        ends = np.cumsum([len(t) for t in part])
        starts = ends - [len(t) for t in part]
        change = np.zeros(len(data) + 1, np.int32)
        if listed is None:
            np.add.at(change, starts, 1)
            np.add.at(change, ends - LENGTH + 1, -1)
        else:
            for i, at in zip(chosen, starts):
                np.add.at(change, at + listed[i][0], 1)
                np.add.at(change, at + listed[i][0] + listed[i][1], -1)
        rolling = Rolling(data, 1)
        seeds = rolling.windows(h)
        least = _smallest_from(seeds, LENGTH - h + 1)
        inside = np.cumsum(change)[: len(least)] > 0
        # The next string has another anchor if the smallest value changes, or
        # if it was at this string's very start (and may come again later).
        new = np.empty(len(least), bool)
        new[1:] = (least[1:] != least[:-1]) | (seeds[: len(least) - 1] == least[:-1]) | (inside[1:] != inside[:-1])
        new[starts] = True
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(least)))
        open_ = inside[begin]
        begin, count = begin[open_], count[open_]
        text = np.searchsorted(ends, begin, side="right")
        whole = Rolling(data, 2).names(begin, begin + count + LENGTH - 1)
        yield np.array(chosen)[text], begin - starts[text], count, least[begin], whole


def _runs(texts: DataFrame, h: int) -> DataFrame:
    """The runs of (id, which, text), or of (id, which, text, runs) with the runs listed."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, which = (part.column(i).to_numpy() for i in (0, 1))
            source = [(t or "").encode() for t in part.column(2).to_pylist()]
            listed = None
            if part.num_columns > 3:
                listed = [_places(part.column(3)[i]) for i in range(part.num_rows)]
            for text, start, count, seed, whole in runs(source, h, listed):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seed.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(ids[text]),
                        pa.array(start.astype(np.int64) + (which[text] << PLACE_BITS)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["seed", "whole", "id", "start", "n"],
                )

    return texts.mapInArrow(run, "seed long, whole long, id long, start long, n int")


def _by_text(rows: DataFrame, name: str) -> DataFrame:
    """(_id, _which, runs): the runs (start, n) of each document, in one array."""
    which = F.shiftright("start", PLACE_BITS).alias("_which")
    return rows.groupBy(F.col("id").alias("_id"), which).agg(F.collect_list(F.struct("start", "n")).alias(name))


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_which``: 0, or where an id stands for several texts, the
    number of the row's text among them, in order of their digests."""
    which = fresh(docs, "_which")
    again = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count().where("count > 1").select("_again")
    if not again.take(1):
        return docs.withColumn(which, F.lit(0).cast("long"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    texts = docs.join(again, docs["doc_id"] == again["_again"], "left_semi").select(F.col("doc_id").alias("_again"), digest.alias("_digest")).distinct()
    number = F.row_number().over(Window.partitionBy("_again").orderBy("_digest")).cast("long") - 1
    numbered = written(texts.withColumn("_number", number).where("_number > 0"), "repeat-texts")
    same = (docs["doc_id"] == numbered["_again"]) & (digest == numbered["_digest"])
    return docs.join(numbered, same, "left").select(*[docs[c] for c in docs.columns], F.coalesce("_number", F.lit(0)).alias(which))


def repeats(docs: DataFrame, which: str) -> DataFrame:
    """(id, start, n): runs of n strings, from a start on, that are repeats;
    ``which`` tells the texts of an id apart."""
    named = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("id"), F.col(which).alias("which"), F.coalesce("text", F.lit("")).alias("text")
    )
    found, results = _runs(named, ROUNDS[0]), []
    for h, following in zip(ROUNDS, (*ROUNDS[1:], None)):
        ranks = found.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("seed")
        shared = written(found.join(ranks, "seed"), f"repeat-runs-{h}")
        place = F.struct("id", "start")
        classes = written(
            shared.groupBy("seed", "whole", "n").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")),
            f"repeat-classes-{h}",
        )
        copied = classes.where("c > 1").select("seed", "whole", "n", "first")
        results.append(
            written(
                shared.join(copied, ["seed", "whole", "n"]).where(place > F.col("first")).select("id", "start", "n"),
                f"repeat-found-{h}",
            )
        )
        if following is None:
            return functools.reduce(DataFrame.union, results)
        several = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("seed")
        left = classes.join(several, "seed", "left_semi").select("first.id", "first.start", "n")
        listed = _by_text(left, "runs")
        texts = named.join(listed, (named["id"] == listed["_id"]) & (named["which"] == listed["_which"])).select("id", "which", "text", "runs")
        found = written(_runs(texts, following), f"repeat-open-{following}")


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def _places(listed: pa.Scalar) -> Places:
    return _numbers(listed.values.field(0)) & ((1 << PLACE_BITS) - 1), _numbers(listed.values.field(1))


def _covered(size: int, found: pa.Scalar) -> np.ndarray | None:
    """Which bytes of a text of ``size`` bytes go (None: none)."""
    if not found.is_valid:
        return None
    start, n = _places(found)
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + n + LENGTH - 1, -1)
    return np.cumsum(change)[:size] > 0


def _with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` and, as its last column, the runs that are repeats."""
    apart = _told_apart(docs)
    which = apart.columns[-1]
    found = _by_text(repeats(apart, which), fresh(docs, "_found")).withColumnRenamed("_which", "_place")
    same = (apart["doc_id"].cast("long") == found["_id"]) & (apart[which] == found["_place"])
    return apart.join(found, same, "left").drop("_id", "_place", which)


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: byte counts, removed runs, digest of what stays."""

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for i in range(part.num_rows):
                data = np.frombuffer((part.column(1)[i].as_py() or "").encode(), np.uint8)
                gone = _covered(len(data), part.column(2)[i])
                gone = np.zeros(len(data), bool) if gone is None else gone
                spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1))
                out.append((len(data), int(gone.sum()), spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_repeats(docs.select("doc_id", "text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated bytes cut out of the texts (and ``n_chars``, if
    there, counted anew). A text of which nothing stays is left out. Bytes of a
    character that was cut through are dropped with it."""
    marked = _with_repeats(docs)
    names = docs.columns
    at = {c: i for i, c in enumerate(marked.columns)}

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(at["text"]).to_pylist()
            gone = set()
            for i in range(part.num_rows):
                data = np.frombuffer((texts[i] or "").encode(), np.uint8)
                cut = _covered(len(data), part.column(len(names))[i])
                if cut is not None:
                    texts[i] = data[~cut].tobytes().decode("utf-8", "ignore")
                    if not texts[i]:
                        gone.add(i)
            keep = pa.array([i for i in range(part.num_rows) if i not in gone], pa.int64())
            columns = []
            for c in names:
                column = part.column(at[c])
                if c == "text":
                    column = pa.array(texts, column.type)
                elif c == "n_chars":
                    column = pa.array([len(t or "") for t in texts], column.type)
                columns.append(column.take(keep))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = docs.schema
    return marked.mapInArrow(run, docs.schema)
