"""A trie of conversations that share their first turns, screened by a
count-min sketch.

A *path* is a conversation as a list of turns; a node of the trie is a
distinct sequence of first turns, a *member* a path that starts with it.

1. Turns are range-sorted by conversation and order. Each task scans its rows
   once and gives every turn a rolling digest of the turns before it, 128 bits
   built from SHA-256 of single turns; a conversation that spans tasks, however
   long, is carried on from one line of totals a task.
2. Paths are rebuilt from the digests alone: the first turns of one
   conversation, then the rest of another (`Heads`).
3. A count-min sketch counts the digests of all prefixes, saturating at two.
   It is built in every task, merged by piece, and broadcast; its size follows
   the rows up to ``MOST_CELLS`` bytes a row of the sketch. An estimate is never
   too low: an estimate of one proves that the prefix is a singleton, and so are
   all longer ones of that path. Such tails are written out where they are, as
   they need nothing but their own path.
4. Only the other prefixes are shuffled and grouped exactly, by digest and depth.
   What a false alarm of the sketch sends here comes out as a group of one.
5. Sums over a subtree are sums over the members of its top: each path adds, at
   each of its nodes, what the nodes below on the same path have of which it is
   the smallest member. That is a running sum along the path from its deepest
   node, taken by a second range-sorted scan, and one more grouping.

No list of members is gathered. The ids that end at one node are hashed in
sorted order from a stream of texts of at most ``LISTED`` ids.

Defined results: rows without a conv_id take no part; a null role or text is
empty; turns go by their number, null first, then by role, then by the first
``HEAD_CHARS`` characters of the text, then by digest, and repeated rows stay
repeated turns; texts of any length are read whole, once, into their digests;
``%`` keeps the sign of a negative id, as in SQL; a conversation without turns
belongs to the root alone; an empty table gives an empty result, without a
root. Columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import spread, written
from tillroll.llm.hashing import mix

#: Turns that a rebuilt path can take from another conversation.
MOST_HEAD = 5
HEAD_CHARS = 32
#: Rows of the sketch; cells of a row (a byte each) follow the prefixes within bounds.
ROWS, LEAST_CELLS, MOST_CELLS = 3, 1 << 16, 1 << 23
#: The sketch is merged in pieces of so many cells.
PIECE = 4096
#: Ids in one text of a list that is being hashed.
LISTED = 1 << 14
NO_IDS = hashlib.sha256(b"").hexdigest()

_U = np.uint64
_WORD = (1 << 64) - 1
#: Odd multipliers of the two halves of a digest (any odd numbers do).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(_U)


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(max(0, n - 1), base, _U)]))


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


# --- turns and their running digests ------------------------------------------


def hashed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, head, digest, chars) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.left(text, F.lit(HEAD_CHARS)).alias("head"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), F.length(text).cast("long").alias("chars"),
    )


def _running(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and order: of each, the place k within its
    conversation in this task, its digest times base ** k, and their sum."""
    here = TaskContext.get().partitionId()
    before: tuple | None = None  # conversation, rows, sums so far
    powers = [np.ones(1, _U)] * 2
    for part in parts:
        n = part.num_rows
        if not n:
            continue
        conv = part.column("conv_id").to_numpy()
        first = _runs(conv)
        run = np.repeat(first, np.diff([*first, n]))
        k = np.arange(n) - run
        goes_on = before is not None and before[0] == conv[0]
        if goes_on:
            k[: first[1] if len(first) > 1 else n] += before[1]
        turn = np.frombuffer(b"".join(part.column("digest").to_pylist()), "<u8").reshape(n, 4)
        out, sums = [], []
        for half, base in enumerate(BASES):
            if len(powers[half]) <= k.max():
                powers[half] = _powers(base, 2 * int(k.max()) + 1)
            x = turn[:, half] * powers[half][k]
            total = np.cumsum(x)
            s = total - (total - x)[run]
            if goes_on:
                s[: first[1] if len(first) > 1 else n] += _U(before[2][half])
            out += [_signed(x), _signed(s)]
            sums.append(int(s[-1]))
        before = (conv[-1], int(k[-1]) + 1, sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, here, np.int32)), part.column("conv_id"), pa.array(k), *out, part.column("chars")],
            ["part", "conv_id", "k", "x1", "s1", "x2", "s2", "chars"],
        )


def _carried(rows: DataFrame, order: str, values: list[str], add) -> dict[int, tuple]:
    """For each task whose first conversation began in earlier ones: the
    conversation and its totals there. One line a task reaches the driver.

    ``order`` grows within a conversation; its last row in a task holds the
    totals ``values`` there; ``add`` puts (totals before, totals here) together.
    """
    lines = rows.groupBy("part").agg(
        F.min(F.struct("conv_id", (-F.col(order)).alias("o"), *values)).alias("first"),
        F.max(F.struct("conv_id", F.col(order).alias("o"), *values)).alias("last"),
    ).orderBy("part").collect()
    carry, before = {}, None
    for line in lines:
        first, last = ((r["conv_id"], tuple(r[v] for v in values)) for r in (line["first"], line["last"]))
        if before is not None and before[0] == first[0]:
            carry[line["part"]] = before
            first = (first[0], add(before[1], first[1]))
        before = first if first[0] == last[0] else last
    return carry


def _sum_digests(a: tuple, b: tuple) -> tuple:
    """Totals (last k, sums) of two neighbouring stretches of a conversation."""
    n = a[0] + 1
    return (n + b[0], *(((x + pow(base, n, 1 << 64) * y) & _WORD) for base, x, y in zip(BASES, a[1:], b[1:])))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, x1, s1, x2, s2, chars): of each turn its place from 0, its
    own part of the digest (x) and the digest up to it (s), in two halves."""
    spark = turns.sparkSession
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "head", "digest"]
    hashed = written(hashed_turns(turns), "trie-turns")
    placed = hashed.repartitionByRange(spread(spark), *order).sortWithinPartitions(*order)
    kinds = "part int, conv_id long, k long, x1 long, s1 long, x2 long, s2 long, chars long"
    rows = written(placed.select("conv_id", "digest", "chars").mapInArrow(_running, kinds), "trie-running")
    carry = spark.sparkContext.broadcast(_carried(rows, "k", ["k", "s1", "s2"], _sum_digests))

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            part, conv, pos = (batch.column(c).to_numpy().copy() for c in ("part", "conv_id", "k"))
            values = {c: _unsigned(batch.column(c)).copy() for c in ("x1", "s1", "x2", "s2")}
            for p in np.unique(part):
                if int(p) not in carry.value:
                    continue
                before, (last, *sums) = carry.value[int(p)]
                at = (part == p) & (conv == before)
                pos[at] += last + 1
                for half, base in enumerate(BASES, 1):
                    shift = _U(pow(base, last + 1, 1 << 64))
                    values[f"x{half}"][at] *= shift
                    values[f"s{half}"][at] = values[f"s{half}"][at] * shift + _U(sums[half - 1] & _WORD)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(pos), *map(_signed, values.values()), batch.column("chars")],
                ["conv_id", "pos", *values, "chars"],
            )

    return rows.mapInArrow(whole, "conv_id long, pos long, x1 long, s1 long, x2 long, s2 long, chars long")


# --- paths --------------------------------------------------------------------


class Heads:
    """How paths are rebuilt: conversation c takes its first ``turns(c)`` turns
    (at most ``MOST_HEAD``) from conversation ``of(c)`` and goes on with its own
    turns behind its first ``turns(c)``."""

    def __init__(self, of: Column, turns: Column):
        self.of, self.turns = of, turns


def hundreds() -> Heads:
    """Each hundred of ids shares the first 0 to 5 turns of its first id."""
    c = F.col("conv_id")
    return Heads(c - c % 100, (F.crc32(c.cast("string").cast("binary")) % 6).cast("int"))


def _digest_paths(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests in the places that turns have on their paths: a turn that was at
    ``pos`` stands behind ``taken`` turns of another conversation instead of
    behind its own first ``gone``."""
    for batch in parts:
        pos, taken, gone = (batch.column(c).to_numpy().astype(np.int64) for c in ("pos", "taken", "gone"))
        shift = taken - gone + 1
        out = []
        for half, base in enumerate(BASES, 1):
            x, s, head, own = (_unsigned(batch.column(f"{c}{half}")) for c in ("x", "s", "head", "own"))
            power = np.array([pow(base, int(e), 1 << 64) for e in range(-MOST_HEAD, 2)], _U)[shift + MOST_HEAD]
            d = _U(base) * head + power * (s - own)
            out.append((d, d - power * x))
        (d1, p1), (d2, p2) = out
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(pos + shift), batch.column("n_turns"), *map(_signed, (d1, d2, p1, p2)), batch.column("chars")],
            ["conv_id", "depth", "n_turns", "d1", "d2", "p1", "p2", "chars"],
        )


def paths(turns: DataFrame, heads: Heads) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) of every path, and a row for each of its turns:
    conv_id, depth (from 1), n_turns, d1, d2 (digest of its first ``depth``
    turns), p1, p2 (of one turn less), chars."""
    rows = digests(turns)
    early = F.when(F.col("pos") < MOST_HEAD, F.struct("pos", "x1", "s1", "x2", "s2", "chars"))
    convs = rows.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"), F.array_sort(F.collect_list(early)).alias("own"))
    convs = written(convs.withColumns({"of": heads.of, "gone": heads.turns}), "trie-convs")
    others = convs.select(F.col("conv_id").alias("of"), F.col("own").alias("head"))
    taken = F.least("gone", F.coalesce(F.size("head"), F.lit(0)))
    # What stands before the first own turn, on the path and in the conversation.
    last = lambda turns, n, name: F.coalesce(F.try_element_at(turns, F.greatest(n, F.lit(1)))[name], F.lit(0))
    joined = convs.join(others, "of", "left").withColumn("taken", F.when(F.col("head").isNull(), 0).otherwise(taken))
    ends = {f"{to}{half}": F.when(F.col(n) > 0, last(turns, F.col(n), f"s{half}")).otherwise(F.lit(0)).cast("long") for half in (1, 2) for to, turns, n in (("head", "head", "taken"), ("own", "own", "gone"))}
    info = written(
        joined.select(
            "conv_id", "gone", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("gone"), F.lit(0))).cast("long").alias("n_turns"),
            F.when(F.col("taken") > 0, F.slice("head", 1, F.greatest("taken", F.lit(1)))).alias("first"),
            *(c.alias(f"e_{name}") for name, c in ends.items()),
        ),
        "trie-heads",
    )
    zero = [F.lit(0).cast("long").alias(f"{c}{half}") for c in ("head", "own") for half in (1, 2)]
    columns = ["conv_id", "n_turns", "pos", "taken", "gone", "x1", "s1", "x2", "s2", "chars"]
    kept = rows.join(info, "conv_id").where("pos >= gone").select(*columns, *(F.col(f"e_{c}{half}").alias(f"{c}{half}") for c in ("head", "own") for half in (1, 2)))
    lent = info.select("conv_id", "n_turns", F.lit(0).alias("taken"), F.lit(0).alias("gone"), F.explode("first").alias("t"))
    lent = lent.select("conv_id", "n_turns", "t.pos", "taken", "gone", "t.x1", "t.s1", "t.x2", "t.s2", "t.chars", *zero)
    kinds = "conv_id long, depth long, n_turns long, d1 long, d2 long, p1 long, p2 long, chars long"
    steps = written(kept.unionByName(lent).mapInArrow(_digest_paths, kinds), "trie-paths")
    return info.select("conv_id", "n_turns"), steps


# --- the sketch ---------------------------------------------------------------


def _cells(d1: np.ndarray, d2: np.ndarray, depth: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each prefix in each row of the sketch."""
    key = d1 ^ mix(d2 + depth.astype(_U))
    return [(mix(key + _U(r * 0x9E3779B97F4A7C15 & _WORD)) & _U(cells - 1)).astype(np.int64) for r in range(ROWS)]


def sketch(steps: DataFrame, cells: int) -> np.ndarray:
    """ROWS x cells counts of the prefixes, where 2 stands for 2 and more."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((ROWS, cells), np.uint8)
        for batch in parts:
            for row, at in zip(table, _cells(*(_unsigned(batch.column(c)) for c in ("d1", "d2", "depth")), cells)):
                which, n = np.unique(at, return_counts=True)
                row[which] = np.minimum(2, row[which] + np.minimum(n, 2))
        pieces = table.reshape(-1, PIECE)
        used = np.flatnonzero(pieces.any(axis=1))
        for at in range(0, len(used), 1024):
            some = used[at : at + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([zlib.compress(pieces[i].tobytes(), 1) for i in some], pa.binary())], ["piece", "counts"])

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, counts = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], ["piece", "counts"])

        for batch in parts:
            for i in range(batch.num_rows):
                number = batch.column("piece")[i].as_py()
                more = np.frombuffer(zlib.decompress(batch.column("counts")[i].as_py()), np.uint8)
                if number != piece:
                    if piece is not None:
                        yield done()
                    piece, counts = number, more
                else:
                    counts = np.minimum(2, counts + more)
        if piece is not None:
            yield done()

    made = steps.select("d1", "d2", "depth").mapInArrow(count, "piece int, counts binary")
    merged = made.repartition(spread(steps.sparkSession), "piece").sortWithinPartitions("piece").mapInArrow(merge, "piece int, counts binary")
    table = np.zeros((ROWS * cells // PIECE, PIECE), np.uint8)
    for r in merged.collect():  # ROWS * MOST_CELLS bytes at most
        table[r["piece"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint8)
    return table.reshape(ROWS, cells)


SHARED, FIRST, TAIL = 0, 1, 2


def screened(steps: DataFrame) -> DataFrame:
    """``steps`` with ``kind``: SHARED if more than one path may have the
    prefix; else FIRST if more may have the prefix of one turn less, or TAIL."""
    spark = steps.sparkSession
    wanted = 1 << max(0, int(4 * steps.count()) - 1).bit_length()
    cells = min(MOST_CELLS, max(LEAST_CELLS, wanted))
    shared = spark.sparkContext.broadcast(sketch(steps, cells))

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in parts:
            d1, d2, p1, p2, depth = (_unsigned(batch.column(c)) for c in ("d1", "d2", "p1", "p2", "depth"))

            def alone(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
                return np.min([row[c] for row, c in zip(table, _cells(a, b, at, cells))], axis=0) < 2

            tail = alone(p1, p2, depth - _U(1)) & (depth > 1)
            kind = np.where(tail, TAIL, np.where(alone(d1, d2, depth), FIRST, SHARED)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kind)], [*batch.schema.names, "kind"])

    kinds = ", ".join(f"{c} long" for c in steps.columns)
    return written(steps.mapInArrow(judge, f"{kinds}, kind int"), "trie-screened")


# --- exact groups -------------------------------------------------------------

NODE = ["depth", "d1", "d2"]


def _below(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, deepest first: the running sum of ``saved``
    and the ``leaf`` of the first row, within the conversation in this task."""
    here = TaskContext.get().partitionId()
    before: tuple | None = None
    for part in parts:
        n = part.num_rows
        if not n:
            continue
        conv, saved, leaf = (part.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "saved", "leaf"))
        first = _runs(conv)
        run = np.repeat(first, np.diff([*first, n]))
        total = np.cumsum(saved)
        sums, leaf = total - (total - saved)[run], leaf[run]
        if before is not None and before[0] == conv[0]:
            to = first[1] if len(first) > 1 else n
            sums[:to] += before[1]
            leaf[:to] = before[2]
        before = (conv[-1], sums[-1], leaf[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, here, np.int32)), *(part.column(c) for c in ("conv_id", *NODE)), pa.array(sums), pa.array(leaf)],
            ["part", "conv_id", *NODE, "saved", "leaf"],
        )


def _subtrees(members: DataFrame) -> DataFrame:
    """(depth, d1, d2, n_leaves, saved_tokens) from rows conv_id, node, saved,
    leaf: what each path adds at a node by itself, and whether the path ends in
    a leaf of which it is the smallest member (told by its deepest row)."""
    spark = members.sparkSession
    order = ["conv_id", F.col("depth").desc()]
    kinds = "part int, conv_id long, depth long, d1 long, d2 long, saved long, leaf long"
    placed = members.repartitionByRange(spread(spark), *order).sortWithinPartitions(*order)
    rows = written(placed.mapInArrow(_below, kinds), "trie-below").withColumn("up", -F.col("depth"))
    carry = _carried(rows, "up", ["saved", "leaf"], lambda a, b: (a[0] + b[0], a[1]))
    lines = [(part, conv, *totals) for part, (conv, totals) in carry.items()]  # one a task at most
    more = F.broadcast(spark.createDataFrame(lines, "part int, conv_id long, more long, told long"))
    whole = rows.join(more, ["part", "conv_id"], "left")
    return whole.groupBy(*NODE).agg(
        F.sum(F.coalesce("told", "leaf")).alias("n_leaves"), F.sum(F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved_tokens")
    )


def _list_digests(ends: DataFrame) -> DataFrame:
    """(depth, d1, d2, ends_sha256) of the ids that end at each node: each task
    of a range sort joins its ids to texts, which are hashed in their order."""

    def listed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column("conv_id").to_numpy()
            keys = np.stack([batch.column(c).to_numpy() for c in NODE], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(ids) else []
            out: list[tuple] = []
            for first, last in zip(starts, [*starts[1:], len(ids)]):
                for at in range(first, last, LISTED):
                    some = ids[at : min(last, at + LISTED)].tolist()
                    out.append((*keys[first].tolist(), some[0], ",".join(map(str, some))))
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], pa.int64()) for i in range(4)), pa.array([r[4] for r in out], pa.string())], [*NODE, "from_id", "ids"])

    def hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([r[0][i] for r in rows], pa.int64()) for i in range(3)), pa.array([r[1] for r in rows], pa.string())], [*NODE, "ends_sha256"])

        for batch in parts:
            rows = []
            for *at, text in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if at != key:
                    if key is not None:
                        rows.append((key, state.hexdigest()))
                    key, state = at, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield made(rows)
        if key is not None:
            yield made([(key, state.hexdigest())])

    n = spread(ends.sparkSession)
    order = [*NODE, "conv_id"]
    texts = ends.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(listed, "depth long, d1 long, d2 long, from_id long, ids string")
    return texts.repartition(n, *NODE).sortWithinPartitions(*NODE, "from_id").mapInArrow(hashed, "depth long, d1 long, d2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, heads: Heads | None = None) -> DataFrame:
    """Every node: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and its digest d1, d2."""
    convs, steps = paths(turns, heads or hundreds())
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    kinds = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, d1 long, d2 long"
    if not root["n"]:
        return turns.sparkSession.createDataFrame([], kinds)
    steps = screened(steps)
    members = steps.where(F.col("kind") == SHARED)
    ends = F.col("depth") == F.col("n_turns")
    groups = written(
        members.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("least"), F.count(F.when(ends, 1)).alias("n_ends"),
            F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"),
        ),
        "trie-groups",
    )
    smallest = F.col("least") == F.col("conv_id")
    told = members.select(*NODE, "conv_id", "n_turns").join(groups, NODE).select(
        "conv_id", *NODE,
        F.when(smallest, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0).cast("long").alias("saved"),
        # A path that goes on alone behind its deepest shared node ends in a leaf of its own.
        F.when(~ends | (smallest & (F.col("n_ends") == F.col("n_convs"))), 1).otherwise(0).cast("long").alias("leaf"),
    )
    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    firsts = steps.where(F.col("kind") == FIRST)
    children = groups.select(*parent).unionAll(firsts.select(*parent)).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    none = convs.where("n_turns = 0").select(*(F.lit(0).cast("long").alias(c) for c in NODE), "conv_id")
    lists = written(_list_digests(members.where(ends).select(*NODE, "conv_id").unionAll(none)), "trie-ends")
    above = groups.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("least").alias("above"))

    def parent_id(own: str) -> Column:
        # No group holds a parent that is the root or proven to be alone.
        return F.when(F.col("depth") == 1, F.lit(root["least"])).otherwise(F.coalesce("above", own)).alias("parent_conv_id")

    shared = written(
        groups.join(_subtrees(told), NODE).join(children, NODE, "left").join(lists, NODE, "left").join(above, ["depth", "p1", "p2"], "left").select(
            F.col("least").alias("conv_id"), "depth", parent_id("least"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"), "d1", "d2",
        ),
        "trie-shared",
    )
    own_end = F.when(ends, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_IDS)).alias("ends_sha256")
    one = lambda n, name: F.lit(n).cast("long").alias(name)
    goes_on = F.when(ends, 0).otherwise(1).cast("long").alias("n_children")
    alone = [one(1, "n_convs"), goes_on, one(1, "n_leaves"), one(0, "saved_tokens"), own_end, "d1", "d2"]
    begun = firsts.where("depth > 1").join(above, ["depth", "p1", "p2"], "left").select("conv_id", "depth", parent_id("conv_id"), *alone)
    tails = steps.where((F.col("kind") == TAIL) | ((F.col("kind") == FIRST) & (F.col("depth") == 1)))
    tails = tails.select("conv_id", "depth", F.when(F.col("depth") == 1, F.lit(root["least"])).otherwise(F.col("conv_id")).alias("parent_conv_id"), *alone)
    at_top = shared.where("depth = 1").agg(F.coalesce(F.sum("n_leaves"), F.lit(0)).alias("l"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("s"), F.count(F.lit(1)).alias("c")).first()
    lone = firsts.where("depth = 1").count()
    of_root = lists.where("depth = 0").select("ends_sha256").first()
    spark: SparkSession = turns.sparkSession
    top = (root["least"], 0, None, root["n"], at_top["c"] + lone, (at_top["l"] + lone) or 1, at_top["s"], of_root[0] if of_root else NO_IDS, 0, 0)
    return spark.createDataFrame([top], kinds).unionByName(shared).unionByName(begun).unionByName(tails)
