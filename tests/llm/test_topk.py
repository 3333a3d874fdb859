import numpy as np
import pytest
from pyspark.sql import functions as F

from gridsight.llm import topk


def plain(rows, asks, k=10):
    """Every query against every row."""
    good = {(i, tuple(int(np.floor(1024 * x)) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, q in good:
        if asks(i):
            hits = sorted({(-sum(a * b for a, b in zip(q, c)), j) for j, c in good if j != i})[:k]
            out += [(i, rank, j, -score) for rank, (score, j) in enumerate(hits, 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, cell int, score int")


def clustered(seed, many, width, spread=0.05):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(7, width))
    return [(int(i), (centres[i % 7] + spread * pick.normal(size=width)).tolist()) for i in range(many)]


@pytest.mark.parametrize("width, spread, passes", [(2, 0.05, 1), (8, 0.3, 3), (33, 1.0, 1)])
def test_against_every_pair(spark, monkeypatch, width, spread, passes):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 200 * 8 * width)
    monkeypatch.setattr(topk, "SAMPLE", 64)
    monkeypatch.setattr(topk, "LEAF", 16)
    rows = clustered(width, 900, width, spread)
    size = (8 * width + 16) * 90 // passes + 1
    found = topk.search(table(spark, rows), F.col("vec_id") % 10 == 0, pass_bytes=size)
    assert got(found) == plain(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 0.5]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.1]), (3, []), (4, None),
            (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [9.0, 9.0]), (8, [1e9, -3e9]), (100, [-0.0001, 2.0]),
            (-100, [1.0, 2.0]), (9, [2.0, 1.0, 7.0])]
    assert got(topk.search(table(spark, rows), F.col("vec_id") % 100 == 0)) == plain(rows, lambda i: i % 100 == 0)


def test_one_vector_many_times(spark):
    """A hot vector: all ties, broken by id; and rows that repeat themselves."""
    rows = [(i % 300, [0.5, -0.25, 1.0]) for i in range(1200)] + [(i, [float(i), 1.0, 0.0]) for i in range(300, 330)]
    assert got(topk.search(table(spark, rows), F.col("vec_id") % 100 == 0)) == plain(rows, lambda i: i % 100 == 0)


def test_scores_beyond_64_bits_end_the_job(spark):
    with pytest.raises(Exception, match="64 bits"):
        topk.search(table(spark, [(0, [1e15]), (1, [1e15]), (2, [1.0])]), F.col("vec_id") == 0).collect()


def test_empty_and_few(spark):
    rows = clustered(1, 4, 3)
    asks = F.col("vec_id") % 100 == 0
    assert got(topk.search(table(spark, rows), asks)) == plain(rows, lambda i: i % 100 == 0)
    assert topk.search(table(spark, rows).limit(0), asks).count() == 0
    assert topk.search(table(spark, rows).where("vec_id = 0"), asks).count() == 0
    assert topk.search(table(spark, rows).where("vec_id = 1"), asks).count() == 0


def test_trees_cover_and_prune(monkeypatch):
    points = np.floor(1024 * np.array([v for _, v in clustered(3, 2000, 6)])).astype(np.int64)
    order, root = topk.cover_tree(points, leaf=20)
    assert sorted(order.tolist()) == list(range(2000))

    def check(node):
        own = points[order[node.start:node.end]]
        assert np.linalg.norm(own - node.centre, axis=1).max() <= node.radius + 1e-6
        assert not node.children or [node.start, node.end] == [node.children[0].start, node.children[-1].end]
        gaps = [np.linalg.norm(a.centre - b.centre) for i, a in enumerate(node.children) for b in node.children[:i]]
        assert not gaps or min(gaps) > 0
        for child in node.children:
            check(child)

    check(root)
    met = []
    monkeypatch.setattr(topk.Queries, "_meet", lambda self, mine, ids, vectors, own=topk.Queries._meet: (
        met.append((mine.end - mine.start) * len(ids)), own(self, mine, ids, vectors)))
    ids = np.arange(2000)
    queries = topk.Queries(ids, points, np.full(2000, np.iinfo(np.int64).min), 10)
    queries.search(ids, points)
    assert sum(met) < 0.5 * 2000 * 2000
