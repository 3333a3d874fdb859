"""Exact top-k search by inner product, with cover trees over queries and data.

Vectors become whole numbers, so scores are exact and ties are real. The data are dealt into cells around
centres of a bounded sample (the upper level of the tree) and indexed where they lie, a cover tree for
each run of up to ``BLOCK_BYTES`` of a cell; queries are indexed the same way, in passes of bounded size that are broadcast.
A node's children are centres at least a separation apart, and every point of it is within that
separation of its child's centre; a node knows its centre and its covering radius. Both trees are
descended together: of a query node (centre q, radius a) and a data node (centre r, radius b) no score
exceeds q.r + a|r| + b|q| + ab, and where that is less than the worst k-th score of the node's queries, the pair is left
out with all below it. Scores start from a floor, each query's k-th best in the sample, so that tasks prune
from their first pair on. A task returns its k best per query; a window keeps the best of all tasks.

The data are shuffled once and never collected; passes bound what is broadcast, however many queries
there are. In data without structure (independent directions in many dimensions) radii are as large as the
space and little is pruned: the search is then a blocked product of queries and data.

Cases: a row without an id, without a vector or with a component that is NULL or not finite takes no
part; shorter vectors count as filled up with zeros; a row with the query's own id is not its candidate;
rows that repeat id and vector count once, queries that share an id but not a vector have ranks of their own;
equal scores go to the smaller id; a score beyond 64 bits ends the job; an empty table gives no rows;
other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridsight.llm.common import kept

#: Results of a query; whole numbers to one of a component.
K, SCALE = 10, 1024
#: Rows of the sample, and centres of cells taken from it.
SAMPLE, CELLS = 4096, 64
#: Bytes of vectors in one tree, and of queries in one pass.
BLOCK_BYTES, PASS_BYTES = 4 << 20, 16 << 20
#: Data and queries that are compared directly, and children of a node.
LEAF, GROUP, FAN = 128, 32, 16

_HITS = "pass int, query bigint, query_id bigint, vec_id bigint, score bigint"


@dataclass
class Node:
    """Points ``start`` to ``end`` of a tree's order, all within ``radius`` of ``centre``."""

    start: int
    end: int
    centre: np.ndarray
    radius: float
    children: list[Node]

    @property
    def length(self) -> float:
        return float(np.linalg.norm(self.centre))


def cover_tree(points: np.ndarray, leaf: int, fan: int = FAN) -> tuple[np.ndarray, Node]:
    """An order of the points and the tree over it. Children's centres are the node's own and points each
    farthest from those before, so they are as far apart as they cover."""
    wide = points.astype(np.float64)
    order = np.arange(len(points))

    def grow(start: int, end: int, centre: int) -> Node:
        own = order[start:end]
        far = np.linalg.norm(wide[own] - wide[centre], axis=1)
        node = Node(start, end, wide[centre], float(far.max(initial=0.0)), [])
        if end - start <= leaf or not node.radius:
            return node
        centres, nearest = [centre], np.zeros(len(own), np.int64)
        while len(centres) < fan and far.max() > node.radius / 2:
            new = int(own[far.argmax()])
            away = np.linalg.norm(wide[own] - wide[new], axis=1)
            closer = away < far
            nearest[closer], far = len(centres), np.minimum(far, away)
            centres.append(new)
        by_child = np.argsort(nearest, kind="stable")
        order[start:end] = own[by_child]
        ends = start + np.cumsum(np.bincount(nearest, minlength=len(centres)))
        for child, (a, b) in enumerate(zip([start, *ends[:-1].tolist()], ends.tolist())):
            if a < b:
                node.children.append(grow(a, b, centres[child]))
        return node

    return order, grow(0, len(points), 0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if max((abs(x) for x in exact.ravel()), default=0) >= 1 << 63:
        raise OverflowError("a score does not fit into 64 bits")
    return exact.astype(np.int64)


class Queries:
    """A pass's queries under a cover tree, with the best candidates seen so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floors: np.ndarray, k: int):
        self.order, self.root = cover_tree(vectors, GROUP)
        self.ids, self.vectors, self.k = ids[self.order], vectors[self.order], k
        self.worst = floors[self.order].copy()
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Meet a block of data under its own tree."""
        order, root = cover_tree(vectors, LEAF)
        ids, vectors = ids[order], vectors[order]
        pairs = [(self._bound(self.root, root), self.root, root)]
        while pairs:
            bound, mine, data = pairs.pop()
            if bound < self.worst[mine.start:mine.end].min():
                continue
            if not mine.children and not data.children:
                self._meet(mine, ids[data.start:data.end], vectors[data.start:data.end])
            elif data.children and (not mine.children or data.radius >= mine.radius):
                below = [(self._bound(mine, child), mine, child) for child in data.children]
                pairs += sorted(below, key=lambda p: p[0])
            else:
                pairs += [(self._bound(child, data), child, data) for child in mine.children]

    @staticmethod
    def _bound(mine: Node, data: Node) -> float:
        """No score of the two nodes' points is above this; a little is added for rounding."""
        most = float(mine.centre @ data.centre) + mine.radius * data.length + data.radius * mine.length
        most += mine.radius * data.radius
        return most + 1 + abs(most) * 1e-9

    def _meet(self, mine: Node, ids: np.ndarray, vectors: np.ndarray) -> None:
        at = np.arange(mine.start, mine.end)
        scores = products(self.vectors[at], vectors)
        good = (scores >= self.worst[at][:, None]) & (ids[None, :] != self.ids[at][:, None])
        for row in np.flatnonzero(good.any(axis=1)):
            query = mine.start + int(row)
            old_scores, old_ids = self.held.get(query, (np.empty(0, np.int64), np.empty(0, np.int64)))
            new_scores = np.concatenate([old_scores, scores[row][good[row]]])
            new_ids = np.concatenate([old_ids, ids[good[row]]])
            rank = np.lexsort((new_ids, -new_scores))
            new_scores, new_ids = new_scores[rank], new_ids[rank]
            first = np.r_[True, (np.diff(new_scores) != 0) | (np.diff(new_ids) != 0)]
            new_scores, new_ids = new_scores[first][: self.k], new_ids[first][: self.k]
            self.held[query] = new_scores, new_ids
            if len(new_scores) == self.k:
                self.worst[query] = max(self.worst[query], new_scores[-1])


def whole(vector: str | Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, or NULL where a vector takes no part."""
    column = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    fits = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fits, F.transform(column, lambda x: F.floor(x * float(scale)).cast("bigint")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _floors(ids: np.ndarray, vectors: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among distinct rows of the sample; the least number where it has fewer."""
    out = np.full(len(ids), np.iinfo(np.int64).min)
    for start in range(0, len(ids), 1024):
        scores = products(vectors[start:start + 1024], sample)
        other = sample_ids[None, :] != ids[start:start + 1024, None]
        if sample.shape[0] > k:
            least = np.where(other, scores, np.iinfo(np.int64).min)
            out[start:start + 1024] = np.partition(least, -k, axis=1)[:, -k]
    return out


def _cells(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Each row with the nearest centre and a number that deals out a cell's rows."""
    width, lengths = centres.shape[1], (centres.astype(np.float64) ** 2).sum(axis=1)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = lengths[None, :] - 2 * (_matrix(batch.column(1), width).astype(np.float64) @ centres.T.astype(np.float64))
            yield batch.append_column("cell", pa.array(far.argmin(axis=1).astype(np.int32)))

    return rows.mapInArrow(near, "vec_id bigint, vector array<bigint>, cell int")


def _sample(rows: DataFrame, size: int) -> pa.Table:
    """Distinct rows with the least hashes, at most ``size``."""
    hashed = rows.withColumn("h", F.xxhash64("vec_id", "vector"))
    return hashed.orderBy("h", "vec_id").limit(size).drop("h").distinct().orderBy("vec_id").toArrow()


def search(
    table: DataFrame, queries: Column, id: str = "vec_id", vector: str = "embedding", k: int = K,
    scale: int = SCALE, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` rows of highest score for every row that meets the
    condition ``queries`` on its id."""
    spark = table.sparkSession
    own = table.select(F.col(id).cast("bigint").alias("vec_id"), whole(vector, scale).alias("vector"), queries.alias("asks"))
    rows = kept(own.where("vec_id IS NOT NULL AND vector IS NOT NULL"), "vectors")
    width, asked = rows.agg(F.max(F.size("vector")), F.count_if("asks")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not asked:
        return empty
    bare = rows.select("vec_id", "vector")
    sample = _sample(bare, max(k + 1, min(SAMPLE, pass_bytes // (8 * max(width, 1)))))
    sample_ids, sample_rows = sample.column("vec_id").to_numpy(), _matrix(sample.column("vector"), width)
    _, top = cover_tree(sample_rows, leaf=1, fan=CELLS)
    centres = np.array([node.centre for node in top.children or [top]]).astype(np.int64)
    # A range of (cell, hash) is near in space, and a cell of many rows is many ranges.
    data = kept(_cells(bare, centres).repartitionByRange("cell", F.xxhash64("vec_id")).sortWithinPartitions("cell"), "cells")
    passes = 1 + asked * (8 * width + 16) // pass_bytes
    number = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(passes))
    asking = kept(rows.where("asks").select("vec_id", "vector", number.cast("int").alias("pass")).distinct(), "queries")
    block = max(LEAF, BLOCK_BYTES // (8 * max(width, 1)))
    found = None
    for turn in range(passes):
        told = asking.where(F.col("pass") == turn).select("vec_id", "vector").toArrow().sort_by("vec_id")
        ids, vectors = told.column("vec_id").to_numpy(), _matrix(told.column("vector"), width)
        sent = spark.sparkContext.broadcast((ids, vectors, _floors(ids, vectors, sample_ids, sample_rows, k)))
        hits = kept(data.mapInArrow(_task(sent, width, block, k, turn), _HITS), "hits")
        found = hits if found is None else found.unionByName(hits)
    best = found.distinct().withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY pass, query ORDER BY score DESC, vec_id)"))
    return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _task(sent, width: int, block: int, k: int, turn: int):
    """The search of one pass in a task: its rows in blocks, cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, held, size, cell = None, [], 0, None
        for batch in batches:
            cells = batch.column(2).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for a, b in zip(cuts, cuts[1:]):
                for start in range(a, b, block):
                    part = batch.slice(start, min(block, b - start))
                    if held and (cells[start] != cell and size >= LEAF or size + part.num_rows > block):
                        queries = _search(queries or Queries(*sent.value, k), held, width)
                        held, size = [], 0
                    held.append(part)
                    size, cell = size + part.num_rows, cells[start]
        if held:
            queries = _search(queries or Queries(*sent.value, k), held, width)
        if queries and queries.held:
            rows = [(q, s, i) for q, (scores, ids) in queries.held.items() for s, i in zip(scores.tolist(), ids.tolist())]
            at = np.array([q for q, _, _ in rows], np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(rows), turn, np.int32)), pa.array(queries.order[at]), pa.array(queries.ids[at]),
                pa.array([i for _, _, i in rows], pa.int64()), pa.array([s for _, s, _ in rows], pa.int64()),
            ], names=["pass", "query", "query_id", "vec_id", "score"])

    return run


def _search(queries: Queries, held: list[pa.RecordBatch], width: int) -> Queries:
    rows = pa.Table.from_batches(held)
    queries.search(rows.column(0).to_numpy(), _matrix(rows.column(1), width))
    return queries
