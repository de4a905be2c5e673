"""Exact top-k inner-product search with two cover trees.

Vectors are turned into integers, floor(64 * x) by component. The rows are dealt
to *cells* by the nearest of ``CELLS`` pivots (spread-out rows of a bounded
sample), and a cell to *shards* of about ``SHARD_ROWS`` rows by a hash of the
id, so any number of equal vectors is split. Each shard has a cover tree: a
node's children lie within its radius and further than half of that from each
other, and each node keeps the distance to its farthest descendant. The queries
of a cell get a tree in the same way.

A query group and a shard meet if the bound of their roots,

    <q, r> <= <cq, cr> + |cr| * Rq + |cq| * Rr + Rq * Rr

reaches the group's worst kth score so far; then the two trees are searched
together, pruning pairs of nodes by the same bound. The kth scores begin with
each query's best rows of a bounded sample, which are rows like any other, so
they never exceed the true ones; a pair is pruned only if its bound is lower, so
ties to smaller ids are kept. Each meeting returns k rows a query at most, and
a window takes the best k of each query.

Groups are paired with shards by an equi-join on the shard. Only the pivots,
the sample and one line of bounds for each cell reach the driver.

Defined results: vectors that are null or hold null, NaN or infinite components
take no part, nor do empty ones and rows without an id; vectors of each length
are searched among themselves; components so large that a score might pass
2 ** 53, where doubles stop being exact, raise an error; equal vectors rank by id; a row is
never its own candidate; rows that repeat an id are the same row, of which the
smallest vector counts; fewer candidates than k give fewer rows; an empty table
gives an empty result. Only vec_id and embedding are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import written

SCALE = 64
K = 20
QUERY_STEP = 20
SAMPLE = 2048
CELLS = 32
SHARD_ROWS = 4096
GROUP_ROWS = 256
#: Rows of a leaf, which are scored by one product, and children of a node.
LEAF = 256
CHILDREN = 16
#: Scores below this are exact in doubles.
EXACT = 2.0**53


class Tree(NamedTuple):
    """Points in tree order; a node holds points [lo, hi), its children are
    nodes, and its radius reaches from its centre to each of its points."""

    points: np.ndarray
    ids: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    children: list[list[int]]


def cover_tree(points: np.ndarray, ids: np.ndarray) -> Tree:
    order: list[np.ndarray] = []
    nodes: list[list] = []
    placed = 0

    def build(rows: np.ndarray, distance: np.ndarray) -> int:
        """rows[0] is the centre, ``distance`` the rows' distances from it."""
        nonlocal placed
        me = len(nodes)
        radius = float(distance.max())
        nodes.append([placed, 0, rows[0], radius, []])
        if len(rows) <= LEAF or radius == 0:
            order.append(rows)
            placed += len(rows)
        else:
            # Centres over half the radius apart, until all rows are covered.
            centres, nearest, owner = [0], distance.copy(), np.zeros(len(rows), np.int64)
            while len(centres) < len(rows):
                far = int(nearest.argmax())
                if nearest[far] <= radius / 2:
                    break
                d = np.sqrt(((points[rows] - points[rows[far]]) ** 2).sum(axis=1))
                closer = d < nearest
                nearest[closer] = d[closer]
                owner[closer] = len(centres)
                centres.append(far)
                if len(centres) >= CHILDREN:
                    break
            for k, at in enumerate(centres):
                own = np.flatnonzero(owner == k)
                own = np.concatenate([[at], own[own != at]])
                nodes[me][4].append(build(rows[own], nearest[own]))
        nodes[me][1] = placed
        return me

    if len(ids):
        build(np.arange(len(ids)), np.sqrt(((points - points[0]) ** 2).sum(axis=1)))
    at = np.concatenate(order) if order else np.empty(0, np.int64)
    lo, hi, centre, radius, children = map(list, zip(*nodes)) if nodes else ([], [], [], [], [])
    return Tree(points[at], ids[at], np.array(lo, int), np.array(hi, int), points[np.array(centre, int)], np.array(radius), children)


class Best:
    """The k best (score, id) of each query, best first."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.least = least.astype(np.float64)  # known lower bounds of the kth scores

    def worst(self, lo: int, hi: int) -> float:
        return float(np.maximum(self.score[lo:hi, -1], self.least[lo:hi]).min())

    def add(self, lo: int, hi: int, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        # Only rows that reach some query's worst kth score can change anything.
        worst = np.maximum(self.score[lo:hi, -1], self.least[lo:hi])
        better = (scores >= worst[:, None]).any(axis=0)
        if not better.any():
            return
        scores, ids = scores[:, better], ids[better]
        score = np.concatenate([self.score[lo:hi], scores], 1)
        who = np.concatenate([self.id[lo:hi], np.broadcast_to(ids, scores.shape)], 1)
        best = np.lexsort((who, -score), axis=1)[:, :k]
        self.score[lo:hi] = np.take_along_axis(score, best, 1)
        self.id[lo:hi] = np.take_along_axis(who, best, 1)


def search(queries: Tree, rows: Tree, k: int, least: np.ndarray) -> Best:
    """Both trees from their roots down, nearest pairs first; ``least``: lower
    bounds of the kth scores, in the queries' tree order."""
    best = Best(len(queries.ids), k, least)
    if not len(queries.ids) or not len(rows.ids):
        return best
    q_norm, r_norm = (np.sqrt((t.centre**2).sum(axis=1)) for t in (queries, rows))

    def bound(q: np.ndarray, r: np.ndarray) -> np.ndarray:
        dot = (queries.centre[q] * rows.centre[r]).sum(axis=1)
        return dot + q_norm[q] * rows.radius[r] + r_norm[r] * queries.radius[q] + queries.radius[q] * rows.radius[r]

    stack = [(0, 0, float(bound(np.array([0]), np.array([0]))[0]))]
    while stack:
        q, r, top = stack.pop()
        lo, hi = queries.lo[q], queries.hi[q]
        # Roundings must never prune: bounds are real, scores whole numbers.
        if top + 1e-6 * (1 + abs(top)) < best.worst(lo, hi):
            continue
        q_leaf, r_leaf = not queries.children[q], not rows.children[r]
        if q_leaf and r_leaf:
            ids = rows.ids[rows.lo[r] : rows.hi[r]]
            scores = queries.points[lo:hi] @ rows.points[rows.lo[r] : rows.hi[r]].T
            own = queries.ids[lo:hi, None] == ids[None, :]
            best.add(lo, hi, np.where(own, -np.inf, scores), ids)
            continue
        split_rows = q_leaf or (not r_leaf and rows.radius[r] >= queries.radius[q])
        below = np.array(rows.children[r] if split_rows else queries.children[q])
        same = np.full(len(below), q if split_rows else r)
        pairs = (same, below) if split_rows else (below, same)
        tops = bound(*pairs)
        for i in np.argsort(tops):  # the best bound is taken from the stack first
            stack.append((int(pairs[0][i]), int(pairs[1][i]), float(tops[i])))
    return best


def _components(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: floor(64 * x) by component."""
    v = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")))
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def integers(vectors: DataFrame) -> DataFrame:
    """The same, one row an id."""
    return _components(vectors).groupBy("vec_id").agg(F.min("v").alias("v"))


def _spread_out(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` points, each the farthest from those before (first: the first)."""
    chosen, nearest = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(points)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def top_k(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each query, the
    rows whose id is divisible by ``query_step``."""
    largest = F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))
    widths = _components(vectors).groupBy(F.size("v").alias("width")).agg(largest.alias("largest")).where("width > 0").orderBy("width").collect()
    for width, top in widths:
        if width * top**2 >= EXACT:
            raise ValueError(f"vectors of {width} components hold floor({SCALE} * x) of {top:.0f}: their scores pass {EXACT:.0f}")
    if not widths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    whole = integers(vectors)
    found = [_top_k_of(whole.where(F.size("v") == width), width, k, query_step) for width, _ in widths]
    return functools.reduce(DataFrame.union, found)


def _top_k_of(whole: DataFrame, width: int, k: int, query_step: int) -> DataFrame:
    """The same for integer vectors (vec_id, v) of one length."""
    spark = whole.sparkSession
    sample = whole.select("vec_id", "v", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id").limit(SAMPLE).collect()
    schema = "query_id long, rank int, vec_id long, score long"
    if not sample:
        return spark.createDataFrame([], schema)
    points = np.array([r["v"] for r in sample], np.float64).reshape(len(sample), width)
    shared = spark.sparkContext.broadcast((points, np.array([r["vec_id"] for r in sample]), _spread_out(points, CELLS)))

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, some_ids, pivots = shared.value
        for part in parts:
            if not part.num_rows:
                continue
            x = _matrix(part.column(1), width)
            distance = np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * x @ pivots.T))
            cell = distance.argmin(axis=1)
            ids = part.column(0).to_numpy()
            # A lower bound of each query's kth score: its kth in the sample.
            least = np.full(len(ids), -np.inf)
            query = np.flatnonzero(ids % query_step == 0)
            for at in range(0, len(query), 256):
                q = query[at : at + 256]
                scores = np.where(ids[q, None] == some_ids[None, :], -np.inf, x[q] @ some.T)
                if scores.shape[1] >= k:
                    least[q] = np.partition(scores, -k, axis=1)[:, -k]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary()),
                    pa.array(cell.astype(np.int32)),
                    pa.array(distance[np.arange(len(cell)), cell]),
                    pa.array(np.sqrt((pivots[cell] ** 2).sum(1))),
                    pa.array(least),
                ],
                ["vec_id", "v", "cell", "far", "norm", "least"],
            )

    dealt = written(
        whole.mapInArrow(deal, "vec_id long, v binary, cell int, far double, norm double, least double"),
        "search-rows",
    )
    is_query = F.col("vec_id") % query_step == 0
    cells = {
        r["cell"]: r
        for r in dealt.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"),
            F.max("far").alias("far"),
            F.count(F.when(is_query, 1)).alias("queries"),
            F.max(F.when(is_query, F.col("far"))).alias("q_far"),
            F.min(F.when(is_query, F.col("least"))).alias("least"),
        ).collect()
    }  # at most CELLS rows
    pivots = shared.value[2]
    norm = np.sqrt((pivots**2).sum(axis=1))
    meets = {}
    for q, a in cells.items():
        if a["queries"]:
            tops = [
                (c, pivots[q] @ pivots[c] + norm[c] * a["q_far"] + norm[q] * b["far"] + a["q_far"] * b["far"])
                for c, b in cells.items()
            ]
            meets[q] = [int(c) for c, top in tops if top + 1e-6 * (1 + abs(top)) >= a["least"]]

    def number(counts: dict[int, int], size: int):
        """The slice of its cell that a row belongs to."""
        slices = F.create_map(*(F.lit(x) for c, n in counts.items() for x in (int(c), -(-n // size))))
        return F.pmod(F.xxhash64("vec_id"), F.get(F.map_values(F.map_filter(slices, lambda c, _: c == F.col("cell"))), 0)).cast("int")

    shard = number({c: r["n"] for c, r in cells.items()}, SHARD_ROWS)
    sides = dealt.withColumn("slice", shard).groupBy("cell", "slice").agg(
        F.collect_list(F.struct("vec_id", "v")).alias("rows")
    )
    shards = sides.select(F.col("cell").alias("r_cell"), F.col("slice").alias("r_slice"), "rows")
    # Which cells the groups of a cell meet, and their numbers of slices: at
    # most CELLS ** 2 lines.
    plan = [(q, c, -(-cells[c]["n"] // SHARD_ROWS)) for q, cs in meets.items() for c in cs]
    if not plan:
        return spark.createDataFrame([], schema)
    meetings = spark.createDataFrame(plan, "cell int, r_cell int, n int").select(
        "cell", "r_cell", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("r_slice")
    )
    group = number({c: max(1, r["queries"]) for c, r in cells.items()}, GROUP_ROWS)
    groups = (
        dealt.where(is_query)
        .withColumn("slice", group)
        .groupBy("cell", "slice")
        .agg(F.collect_list(F.struct("vec_id", "v", "least")).alias("queries"))
    )
    sent = groups.join(meetings, "cell").select("r_cell", "r_slice", "queries")
    found = sent.join(shards, ["r_cell", "r_slice"]).select("queries", "rows").mapInArrow(_search_batches(width, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_batches(width: int, k: int):
    def tree(rows: pa.Scalar) -> tuple[Tree, np.ndarray]:
        table = rows.values
        ids = table.field("vec_id").to_numpy()
        raw = table.field("v").to_pylist()
        points = np.frombuffer(b"".join(raw), "<i4").reshape(-1, width).astype(np.float64)
        order = np.argsort(ids, kind="stable")
        return cover_tree(points[order], ids[order]), table

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = (None, None)
        for part in parts:
            for i in range(part.num_rows):
                queries, table = tree(part.column(0)[i])
                rows = part.column(1)[i]
                # Meetings of one shard follow each other after the join.
                key = (len(rows.values), rows.values.field("vec_id")[0].as_py())
                if kept[0] != key:
                    kept = (key, tree(rows)[0])
                least = dict(zip(table.field("vec_id").to_pylist(), table.field("least").to_pylist()))
                best = search(queries, kept[1], k, np.array([least[x] for x in queries.ids.tolist()]))
                ok = (best.score > -np.inf) & (best.score >= best.least[:, None])
                who = np.repeat(queries.ids, k).reshape(ok.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who[ok]), pa.array(best.id[ok]), pa.array(best.score[ok].astype(np.int64))], ["query_id", "vec_id", "score"]
                )

    return run
