"""Token ids in a file format compressed by Re-Pair grammars.

Documents are range-sorted by id; each task encodes its texts, appends the end
id, cuts the ids into shards of about ``SHARD_TOKENS`` (whole documents), and
compresses every shard on its own: frequent pairs of neighbouring ids become
nonterminals, round after round, until no pair occurs ``MIN_COUNT`` times. Spark's Parquet
writer commits the shards, one row each, so a lost executor's files never count:

=============  ===============================================================
part, shard    place of the shard: task in id order, number within the task
before         ids of the task's earlier shards
n_tokens       ids in the shard
doc_ids        ids of its documents, in order
doc_tokens     number of ids of each document
rules          pairs (left, right) of uint32: nonterminal ``BASE + i``
lengths        number of ids (uint32) that each rule stands for
sequence       the compressed sequence (uint32)
=============  ===============================================================

The lengths give the place of every symbol in the shard's ids, so a document,
or any range, is decoded without the symbols before it.

Encoding goes through the tokenizers library, which is asked once for stretches
of text that come again (``bytebpe``). Strings of special tokens are ordinary text.

Defined results: a null or empty text has only its end id; a null id sorts
first; rows that repeat an id follow each other, ordered by text; an empty
table gives an empty result. Only doc_id and text are read. A batch of texts
(Spark's Arrow batch) is in memory at a time, with a shard's ids and those of a
list of texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bytebpe import encoder
from tillroll.llm.common import spread, tidy, written
from tillroll.llm.hashing import batches

END_ID = 2
#: Nonterminals are numbered from here; ids are below.
BASE = 1 << 20
SHARD_TOKENS = 1 << 20
#: A round replaces up to this many pairs that occur at least MIN_COUNT times.
PAIRS_PER_ROUND = 2048
MIN_COUNT = 16
#: Texts are encoded in lists of about this many bytes.
LIST_CHARS = 1 << 23

SCHEMA = (
    "part int, shard int, before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "rules binary, lengths binary, sequence binary"
)


def default_tokenizer() -> str:
    """The file of the 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(tokenizer, texts: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each text and the end id."""
    end = np.array([END_ID], "<u4").tobytes()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for first, last in batches(sizes, LIST_CHARS):
        for raw in tokenizer.encode([t or "" for t in texts.slice(first, last - first).to_pylist()]):
            yield np.frombuffer(raw + end, "<u4")


def _frequent(seq: np.ndarray, look: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """The most frequent pairs, best first; the places of ``seq`` where they
    start, and which of them starts there; whether these are all that occur
    ``MIN_COUNT`` times. ``look``: the places where such pairs start, if known."""
    if look is None:
        pair = seq[:-1].astype(np.uint64)
        pair <<= np.uint64(32)
        pair |= seq[1:]
        # Counts by hash bound the pairs' own counts; only likely ones are counted.
        slot = pair * np.uint64(0x9E3779B97F4A7C15)
        slot >>= np.uint64(46)
        slot = slot.view(np.int64)
        counts = np.bincount(slot, minlength=1 << 18)
        best = int(np.partition(counts, -PAIRS_PER_ROUND)[-PAIRS_PER_ROUND])
        bounds = sorted({max(MIN_COUNT, best), MIN_COUNT}, reverse=True)
    else:
        pair, bounds = (seq[look].astype(np.uint64) << np.uint64(32)) | seq[look + 1], [MIN_COUNT]
    for least in bounds:
        hot = np.flatnonzero((counts >= least)[slot]) if look is None else np.arange(len(look))
        coded = pa.array(pair[hot]).dictionary_encode()
        found, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        n = np.bincount(which, minlength=len(found))
        often = np.flatnonzero(n >= MIN_COUNT)
        order = often[np.lexsort((found[often], -n[often]))][:PAIRS_PER_ROUND]
        if len(order):  # else the fullest slots only hold rare pairs
            break
    place = np.full(len(found), -1, np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    rank = place[which]
    at = hot[rank >= 0]
    return found[order], at if look is None else look[at], rank[rank >= 0], least == MIN_COUNT and len(order) == len(often)


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules, lengths, sequence) of a grammar that gives ``ids``."""
    seq = ids.astype(np.uint32)
    rules = [np.empty((0, 2), np.uint32)]
    lengths = np.empty(0, np.uint32)
    look = None
    while len(seq) > MIN_COUNT:
        pairs, at, rank, every = _frequent(seq, look)
        if not len(pairs):
            break
        # Overlapping candidates: of a chain of neighbours, every other one.
        chain = np.concatenate([[True], np.diff(at) > 1])
        first = np.maximum.accumulate(np.where(chain, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - first) & 1 == 0
        at, rank = at[taken], rank[taken]
        occurs = np.bincount(rank, minlength=len(pairs)) > 0
        used, new = np.flatnonzero(occurs), (np.cumsum(occurs) - 1)[rank]
        known = len(lengths)
        rule = np.stack([pairs[used] >> np.uint64(32), pairs[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        rules.append(rule)
        lengths = np.concatenate([lengths, _lengths(rule, lengths).sum(axis=1, dtype=np.uint32)])
        seq[at] = BASE + known + new
        seq = np.delete(seq, at + 1)
        # A candidate that was not replaced lost its first id to the one before it. So
        # where every frequent pair was a candidate, only pairs of new symbols can be frequent.
        look = None
        if every:
            now = at - np.arange(len(at))
            look = np.union1d(now[now > 0] - 1, now[now < len(seq) - 1])
    return np.concatenate(rules), lengths, seq


def _lengths(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if not len(lengths):
        return np.ones(symbols.shape, np.uint32)
    known = symbols >= BASE
    return np.where(known, lengths[np.where(known, symbols - BASE, 0)], 1).astype(np.uint32)


def _expansions(rules: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rules in one array, and where each rule's begin."""
    begin = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    flat = BASE + np.arange(len(rules), dtype=np.uint32)
    while (deep := flat >= BASE).any():
        pairs = rules[flat[deep] - BASE]
        flat = np.repeat(flat, 1 + deep)
        left = np.flatnonzero(deep) + np.arange(len(pairs))
        flat[left], flat[left + 1] = pairs[:, 0], pairs[:, 1]
    return flat, begin


def decompress(rules: np.ndarray, lengths: np.ndarray, seq: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids from place ``start`` up to ``stop`` of what a grammar gives."""
    size = _lengths(seq, lengths).astype(np.int64)
    ends = np.cumsum(size)
    stop = int(ends[-1]) if stop is None and len(ends) else (stop or 0)
    if stop <= start:
        return np.empty(0, np.uint32)
    lo, hi = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop - 1, side="right") + 1
    part, size, skip = seq[lo:hi], size[lo:hi], start - (ends[lo] - size[lo])
    flat, begin = _expansions(rules, lengths)
    # One table: each terminal of the part, then the rules' ids.
    rule = part >= BASE
    source = np.where(rule, len(part) + begin[np.where(rule, part - BASE, 0)], np.arange(len(part)))
    table = np.concatenate([part, flat])
    shift = np.repeat(source - (np.cumsum(size) - size), size)
    return table[shift + np.arange(int(size.sum()))][skip : skip + stop - start]


def encode_shards(docs: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """The shards of all texts, written to the shared folder and read back."""
    path = tokenizer_file or default_tokenizer()

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, place = encoder(path), TaskContext.get().partitionId()
        shard, before = 0, 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal shard, before, doc_ids, ids
            whole = np.concatenate(ids)
            rules, lengths, seq = compress(whole)
            row = {
                "part": [place], "shard": [shard], "before": [before], "n_tokens": [len(whole)],
                "doc_ids": [doc_ids], "doc_tokens": [[len(x) for x in ids]],
                "rules": [rules.astype("<u4").tobytes()], "lengths": [lengths.astype("<u4").tobytes()], "sequence": [seq.astype("<u4").tobytes()],
            }
            shard, before, doc_ids, ids = shard + 1, before + len(whole), [], []
            return pa.RecordBatch.from_pydict(row, schema=_ARROW)

        held = 0
        for batch in parts:
            for i, one in enumerate(encoded(enc, batch.column(1))):
                doc_ids.append(batch.column(0)[i].as_py())
                ids.append(one)
                held += len(one)
                if held >= SHARD_TOKENS:
                    yield flush()
                    held = 0
        if ids:
            yield flush()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(spread(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return written(ordered.mapInArrow(run, SCHEMA), "token-shards")


_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", _LONGS),
     ("doc_tokens", _LONGS), ("rules", pa.binary()), ("lengths", pa.binary()), ("sequence", pa.binary())]
)


def read_documents(
    shards: DataFrame,
    each: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str = "doc_id long, start long, ids binary",
) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded from its shard; start:
    number of ids of all documents before it. ``each`` turns batches of these
    rows into others, of ``schema``, where they are decoded."""
    spark = shards.sparkSession
    # One total a task of the writer; their number is the session's setting.
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    first, at = {}, 0
    for part in sorted(totals):
        first[part] = at
        at += totals[part]
    first_of = spark.sparkContext.broadcast(first)

    @tidy
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
                ids = decompress(rules, np.frombuffer(row["lengths"], "<u4"), np.frombuffer(row["sequence"], "<u4"))
                ends = np.cumsum(row["doc_tokens"])
                begins = ends - row["doc_tokens"]
                start = first_of.value[row["part"]] + row["before"] + begins
                raw = ids.astype("<u4").tobytes()
                for lo in range(0, len(ends), 256):
                    pick = slice(lo, lo + 256)
                    docs = pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][pick], pa.int64()), pa.array(start[pick]), pa.array([raw[4 * b : 4 * e] for b, e in zip(begins[pick], ends[pick])], pa.binary())],
                        ["doc_id", "start", "ids"],
                    )
                    yield docs if each is None else each(docs)

    return shards.mapInArrow(run, schema)


def digests(docs: DataFrame, tokenizer_file: str | None = None) -> DataFrame:
    """Write all ids, read them back, and describe each document's."""

    def describe(docs: pa.RecordBatch) -> pa.RecordBatch:
        raw = docs.column(2).to_pylist()
        return pa.RecordBatch.from_arrays(
            [docs.column(0), docs.column(1), pa.array([len(x) // 4 for x in raw], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    shards = encode_shards(docs, tokenizer_file)
    return read_documents(shards, describe, "doc_id long, start long, n_tokens long, ids_crc32 long")
