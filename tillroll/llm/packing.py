"""Packing documents into as few sequences of fixed length as possible, by exact
complements and best fit.

1. Each task encodes its texts, cuts documents that are longer than a sequence
   (no others), and writes the pieces with their number among the task's pieces
   of the same length.
2. How pieces are combined depends on their lengths alone, so the plan is made
   from the count of each length, ``capacity`` numbers at most, whatever the
   number of documents. Lengths are taken from the longest down. For the gap
   that a length leaves, indexes of the sums of single lengths, pairs and triples
   tell whether a combination fills it exactly; it is consumed as often as the
   counts of its lengths allow. Rests that no combination fills go by best fit:
   each into the open sequences with the least space that is enough.
3. The plan is a list of slots (length, numbers from, to, sequence, offset), of a
   size bounded by ``capacity``, and is broadcast. A piece's number among all of
   its length is its number in its task plus those of earlier tasks, so no
   length is gathered anywhere, however many pieces have it.

Defined results: a null or empty text is its end id alone; a null id stays null;
repeated rows are documents of their own; ids of texts of any length are cut in
place; an empty table gives an empty result. Columns other than doc_id and text
are not read. Sequence numbers depend on how the rows are dealt to tasks; the
number of sequences does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm import wordbpe
from tillroll.llm.common import written
from tillroll.llm.hashing import batches

CAPACITY = 4096
END_ID = 1


def default_tokenizer() -> str:
    """The file of the 49k vocabulary with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- pieces -------------------------------------------------------------------


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_file: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(part, number, doc_id, piece, start, length, ids) of all documents,
    written to the shared folder; ids: little-endian uint32."""
    path = tokenizer_file or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, enc = TaskContext.get().partitionId(), wordbpe.encoder(path)
        numbers = np.zeros(capacity + 1, np.int64)
        for batch in parts:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0)
            for first, last in batches(sizes.to_pylist(), wordbpe.TOGETHER):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                ids = [x + end for x in enc.encode([t or "" for t in texts])]
                doc = np.repeat(np.arange(first, last), [-(-len(x) // (4 * capacity)) for x in ids])
                cuts = [x[at : at + 4 * capacity] for x in ids for at in range(0, len(x), 4 * capacity)]
                piece = np.concatenate([np.arange(-(-len(x) // (4 * capacity))) for x in ids])
                length = np.array([len(x) // 4 for x in cuts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(cuts), here, np.int32)), pa.array(_number(length, numbers)), batch.column(0).take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)), pa.array(piece * capacity), pa.array(length), pa.array(cuts, pa.binary()),
                    ],
                    ["part", "number", "doc_id", "piece", "start", "length", "ids"],
                )

    kinds = f"part int, number long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids binary"
    return written(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, kinds), "packing-pieces")


def _number(length: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length; ``numbers`` holds how
    many came before and is brought up to date."""
    order = np.argsort(length, kind="stable")
    which, first, n = np.unique(length[order], return_index=True, return_counts=True)
    out = np.empty(len(length), np.int64)
    out[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(numbers[which], n)
    numbers[which] += n
    return out


# --- the plan -----------------------------------------------------------------


class Complements:
    """Sums of one, two and three lengths of which pieces are left."""

    def __init__(self, left: np.ndarray):
        self.left = left
        self.renew()

    def renew(self) -> None:
        """Index the sums. Pieces only become fewer, so an old index tells too
        many sums, never too few; each hit is looked up in the counts."""
        size = len(self.left)
        one = (self.left > 0).astype(np.float64)
        self.pairs = np.convolve(one, one)[:size] > 0.5
        self.triples = np.convolve(self.pairs.astype(np.float64), one)[:size] > 0.5
        self.age = 0

    def _pair(self, total: int, most: int) -> tuple[int, int] | None:
        """Two lengths of that sum, the longer one as long as possible."""
        if total < 2 or not self.pairs[total]:
            return None
        a = np.arange(min(total - 1, most), (total - 1) // 2, -1)
        fit = np.flatnonzero((self.left[a] > 0) & (self.left[total - a] > (2 * a == total)))
        return (int(a[fit[0]]), total - int(a[fit[0]])) if len(fit) else None

    def of(self, gap: int, most: int, parts: int) -> tuple[int, ...] | None:
        """Up to ``parts`` lengths of at most ``most`` that fill ``gap`` exactly."""
        if gap <= most and self.left[gap]:
            return (gap,)
        if parts > 1 and (pair := self._pair(gap, most)):
            return pair
        if parts < 3 or gap < 3 or not self.triples[gap]:
            return None
        a = np.arange(min(gap - 2, most), (gap - 1) // 3, -1)
        for length in a[(self.left[a] > 0) & self.pairs[gap - a]].tolist():
            self.left[length] -= 1
            pair = self._pair(gap - length, length)
            self.left[length] += 1
            if pair:
                return (length, *pair)
        return None


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, number of such sequences)] that take ``counts[n]``
    pieces of each length n; the capacity is the last length.

    Small pieces that fill gaps in pairs and triples may be missed elsewhere, so
    the plan is made three times, with combinations of one, up to two and up to
    three lengths, and the one with the fewest sequences counts.
    """
    return min((_plan(counts, parts) for parts in (3, 2, 1)), key=lambda made: sum(n for _, n in made))


def _plan(counts: np.ndarray, parts: int) -> list[tuple[tuple[int, ...], int]]:
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    left[0] = 0
    made = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    index = Complements(left)
    for length in range(capacity - 1, (capacity - 1) // 4, -1):
        while left[length]:
            left[length] -= 1
            rest = index.of(capacity - length, length, parts)
            left[length] += 1
            if rest is None:
                break
            lengths, times = np.unique([length, *rest], return_counts=True)
            n = int((left[lengths] // times).min())
            left[lengths] -= n * times
            made.append(((length, *rest), n))
            index.age += 1
            if index.age == 64:
                index.renew()
    return made + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The longest first, each into the least space that is enough."""
    spaces: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    open_ = np.zeros(capacity + 1, bool)

    def add(space: int, lengths: tuple[int, ...], n: int) -> None:
        if n:
            spaces[space].append((lengths, n))
            open_[space] = True

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            space = length + int(open_[length:].argmax())
            if not open_[space]:
                # New sequences, with as many of this length as they hold.
                each = capacity // length
                add(capacity - each * length, (length,) * each, n // each)
                add(capacity - n % each * length, (length,) * (n % each), min(1, n % each))
                break
            lengths, m = spaces[space].pop()
            open_[space] = bool(spaces[space])
            used = min(n, m)
            add(space, lengths, m - used)
            add(space - length, (*lengths, length), used)
            n -= used
    return [group for groups in spaces for group in groups]


def slots(made: list[tuple[tuple[int, ...], int]], capacity: int) -> np.ndarray:
    """Rows (length, first number, first sequence, offset), sorted: pieces of that
    length, from that number on, stand in that and the following sequences."""
    used, sequence, rows = np.zeros(capacity + 1, np.int64), 0, []
    for lengths, n in made:
        offset = 0
        for length in lengths:
            rows.append((length, int(used[length]), sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


# --- packing ------------------------------------------------------------------


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces, each with its sequence_id and offset."""
    spark = cut.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").count().collect():  # capacity rows at most
        counts[r["length"]] = r["count"]
    table = spark.sparkContext.broadcast(slots(plan(counts), capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy("part", "length").count().select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    named = cut.join(before, ["part", "length"]).withColumn("number", F.col("number") + F.col("before"))
    columns = [c for c in cut.columns if c not in ("part", "number")]

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        starts = (rows[:, 0] << 48) + rows[:, 1]
        for batch in parts:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(starts, (length << 48) + number, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(rows[at, 2] + number - rows[at, 1]), pa.array(rows[at, 3])],
                [*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in columns)
    return named.select(*columns, "number").mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces: the ids of each sequence put together."""
    whole = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.reduce(whole, F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def digests(docs: DataFrame, capacity: int = CAPACITY, tokenizer_file: str | None = None) -> DataFrame:
    """Where each piece of each document stands, and the checksum of its ids."""
    cut = pieces(docs, capacity, tokenizer_file)
    packed = pack(cut.select("part", "number", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
