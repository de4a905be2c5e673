"""Hard negatives by a vertical branch-and-bound scan (BOND).

Vectors become integers, floor(scale * x) by component. Rows are dealt by a
hash of their id to *blocks* of about the same number of rows, and every anchor
is sent to every block: a stated set of anchors against all rows, in blocks. A
task holds one block at a time, as one array a dimension, with each dimension's
least and greatest value; anchors stream past it.

An anchor reads the dimensions in descending order of its own magnitudes. After
each step a candidate's score lies between its partial score plus the least and
plus the greatest that the dimensions still unread can add. Candidates whose
range misses every window, or that ``k`` others surely beat in each window they
may be in, leave the candidate bitmap; what is left at the last dimension has
its exact score. Ties never leave, so the smaller id can win them.

The scan runs twice. The first finds each anchor's positives: the best rows of
its own label, one window without limits. The second finds the negatives of
each positive: rows of other labels in the window from ``LOW`` to ``HIGH``
percent of the positive's score. A block returns ``k`` rows a window at most; a
window function with a partial limit takes the best of all blocks.

Nothing is collected or broadcast. The anchors are shuffled once for each
block; blocks grow with the table up to ``BLOCK_ROWS`` rows, so their number
stays small against the rows.

Defined results: rows take part that have an id, a label and a vector of one or
more finite components; only vectors of one length meet; rows that repeat an id
are one row, the one with the smallest label and vector; equal scores go by the
smaller id; an anchor without another row of its label has no result, nor has a
positive with an empty window (negative scores have none); an empty table gives
an empty result. Scores that a long cannot hold raise an error. Columns other
than vec_id, embedding and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

SCALE = 256
ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 10
#: A negative's score, in percent of its positive's.
LOW, HIGH = 30, 90
#: Rows of a block: a sixteenth of the table within these bounds.
LEAST_BLOCK, BLOCK_ROWS = 4096, 32768
#: Dimensions read between two looks at the bounds.
STEP = 8
#: Doubles are exact below the first, longs below the second.
EXACT, LONGEST = 2**53, 2**62


class Block:
    """Rows of one length, stored by dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(rows.T)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        self.largest = int(np.abs(self.columns).max())
        self.doubles: np.ndarray | None = None

    def for_anchor(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The columns and the anchor, in numbers that hold every score."""
        top = len(a) * int(np.abs(a).max()) * self.largest
        if top >= LONGEST:
            raise ValueError(f"scores of up to {top} pass what a long can hold")
        if top >= EXACT:
            return self.columns, a
        if self.doubles is None:
            self.doubles = self.columns.astype(np.float64)
        return self.doubles, a.astype(np.float64)


def scan(block: Block, a: np.ndarray, candidates: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window [low, high]: (ids, scores) of its ``k`` best candidates,
    best first. ``candidates``: places in the block."""
    columns, weight = block.for_anchor(a)
    order = np.argsort(-np.abs(a), kind="stable")
    ends = np.stack([weight * block.least, weight * block.most])[:, order]
    # What the dimensions from each place of the order on can still add.
    rest = np.zeros((2, len(a) + 1), ends.dtype)
    rest[:, :-1] = np.stack([ends.min(axis=0), ends.max(axis=0)])[:, ::-1].cumsum(axis=1)[:, ::-1]
    left, partial = candidates, np.zeros(len(candidates), ends.dtype)
    for at in range(0, len(a), STEP):
        if not len(left):
            break
        dims = order[at : at + STEP]
        part = columns[dims] if len(left) == len(block.ids) else columns[dims[:, None], left]
        partial = partial + weight[dims] @ part
        floor, ceiling = rest[:, min(at + STEP, len(a))]
        least, most = partial.min(), partial.max()
        # Without this nothing can be told apart yet.
        if most - least <= ceiling - floor and least + ceiling >= low.min() and most + floor <= high.max():
            continue
        keep = np.zeros(len(left), bool)
        for lo, hi in zip(low, high):
            inside = (partial + ceiling >= lo) & (partial + floor <= hi)
            sure = partial[(partial + floor >= lo) & (partial + ceiling <= hi)]
            if len(sure) >= k:
                inside &= partial + ceiling >= np.partition(sure, -k)[-k] + floor
            keep |= inside
        left, partial = left[keep], partial[keep]
    found = []
    for lo, hi in zip(low, high):
        at = np.flatnonzero((partial >= lo) & (partial <= hi))
        if len(at) > k:
            at = at[partial[at] >= np.partition(partial[at], -k)[-k]]
        ids = block.ids[left[at]]
        best = np.lexsort((ids, -partial[at]))[:k]
        found.append((ids[best], partial[at][best].astype(np.int64)))
    return found


def _by_length(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the batch, vectors) of its rows, by length."""
    v = part.column("v")
    starts, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False)
    size = np.diff(starts)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield int(n), at, flat[starts[at][:, None] + np.arange(n)]


def _scans(k: int, other_labels: bool):
    """Rows sorted by block, a block's members before its anchors."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, gathered, blocks = None, {}, None
        for whole in parts:
            block = whole.column("block").to_numpy()
            kind = whole.column("kind").to_numpy()
            turns = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 0) | (np.diff(kind) != 0)])) if len(block) else []
            for first, last in zip(turns, [*turns[1:], len(block)]):
                part = whole.slice(first, last - first)
                if block[first] != number:
                    number, gathered, blocks = block[first], {}, None
                if kind[first] == 0:
                    ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
                    for n, at, rows in _by_length(part):
                        gathered.setdefault(n, []).append((ids[at], labels[at], rows))
                    continue
                if blocks is None:
                    blocks = {n: Block(*(np.concatenate(x) for x in zip(*lists))) for n, lists in gathered.items()}
                    gathered = {}
                yield _meet(part, blocks, k, other_labels)

    return run


def _meet(part: pa.RecordBatch, blocks: dict[int, Block], k: int, other_labels: bool) -> pa.RecordBatch:
    ids, labels = part.column("id").to_numpy(), part.column("label").to_numpy()
    low, high = (part.column(c).to_pylist() for c in ("low", "high"))
    out: list[list] = [[], [], [], []]
    for n, at, rows in _by_length(part):
        if n not in blocks:
            continue
        block = blocks[n]
        for i, a in zip(at.tolist(), rows):
            ours = (block.labels != labels[i]) if other_labels else (block.labels == labels[i]) & (block.ids != ids[i])
            for w, (who, score) in enumerate(scan(block, a, np.flatnonzero(ours), np.array(low[i]), np.array(high[i]), k)):
                for column, x in zip(out, (np.full(len(who), ids[i]), np.full(len(who), w, np.int32), who, score)):
                    column.append(x)
    arrays = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, ["anchor", "window", "id", "score"])


def integers(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """(id, label, v): the rows that take part, one an id."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~bad).select(
        F.col("vec_id").cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("v"),
    )
    one = rows.where("label is not null").groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("id", "row.label", "row.v")


def _meetings(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, other_labels: bool) -> DataFrame:
    """(anchor, window, id, score): of each block the ``k`` best rows of each
    window of each anchor; anchors: id, label, v, low, high."""
    none = F.lit(None).cast("array<long>")
    members = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "label", "v", none.alias("low"), none.alias("high"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "label", "v", "low", "high")
    met = members.unionAll(sent).repartition(blocks, "block").sortWithinPartitions("block", "kind")
    return met.mapInArrow(_scans(k, other_labels), "anchor long, window int, id long, score long")


def hard_negatives(
    vectors: DataFrame,
    label: Column | None = None,
    anchor_step: int = ANCHOR_STEP,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of the anchors, the rows whose id is divisible by
    ``anchor_step``. ``label``: an expression over the table's columns."""
    rows = written(integers(vectors, F.col("label") if label is None else label, scale), "bond-rows")
    n = rows.count()
    blocks = max(1, -(-n // min(BLOCK_ROWS, max(LEAST_BLOCK, n // 16))))
    anchors = rows.where(F.col("id") % anchor_step == 0)
    ends = [F.array(F.lit(x).cast("long")).alias(name) for x, name in ((-LONGEST, "low"), (LONGEST, "high"))]
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    near = _meetings(rows, anchors.select("*", *ends), blocks, positives, other_labels=False)
    near = written(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives).select("anchor", "id", "score"), "bond-positives")

    windows = near.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(F.struct(F.col("id").alias("positive"), "score"))).alias("found"))
    # Whole numbers: up for the low end, down for the high one; a negative score's window is empty.
    low = F.expr(f"transform(found, p -> if(p.score < 0, 1, (p.score * {LOW} + 99) div 100))")
    high = F.expr(f"transform(found, p -> if(p.score < 0, 0, p.score * {HIGH} div 100))")
    ready = anchors.join(windows, "id").select("id", "label", "v", low.alias("low"), high.alias("high"))
    far = _meetings(rows, ready, blocks, negatives, other_labels=True)
    best = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), "id")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = windows.select(F.col("id").alias("anchor"), F.posexplode("found").alias("window", "p"))
    return far.join(named, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), F.col("p.positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )
