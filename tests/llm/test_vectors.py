"""Clustering by the threshold algorithm and M-tree search, against plain comparisons."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import centroids, mtree, vectors

SCHEMA = "vec_id long, embedding array<float>, x string, uid int, cluster string, score int, rank int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "c", 2, 3) for i, v in rows], SCHEMA).repartition(3)


def odd_rows(width, rng):
    rows = [(i, rng.normal(rng.integers(-2, 3), 1, width).round(2).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a group of copies
    rows += [(7, rows[7][1]), (50, rows[9][1])]  # a repeated row, a repeated id
    rows += [(2000, None), (2001, []), (2002, [1.0] * (width - 1)), (2003, [None] + [1.0] * (width - 1)), (2050, [math.nan] * width), (2051, [math.inf] * width), (None, rows[0][1])]
    return rows


def whole(rows, scale, width):
    kept = []
    for i, v in rows:
        if v is not None and (width is None or len(v) == width) and all(e is not None and math.isfinite(e) for e in v):
            kept.append((i, [math.floor(float(np.float32(e)) * scale) for e in v]))
    return kept


def brute_clusters(rows, width=64, many=16, rounds=3):
    kept = whole(rows, 64, width)
    key = lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    cs = [x for _, x in sorted((r for r in kept if r[0] is not None), key=key)[:many]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        cs = [[sum(col) // len(groups[k]) for col in zip(*groups[k])] if k in groups else c for k, c in enumerate(cs)]
    got = [(i, nearest(x)) for i, x in kept]
    total = sum(d for _, (d, _) in got)
    by = {k: sum(d for _, (d, j) in got if j == k) for k in range(len(cs))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, k, d, by[k], total, digest[k]) for i, (d, k) in got), key=str)


COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("rows", [0, 5, None])
def test_clusters_equal_comparing_all_centroids(spark, rows):
    data = odd_rows(64, np.random.default_rng(1))[:rows]
    out = centroids.with_inertia(spark, *centroids.cluster(spark, table_of(spark, data)))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str) == brute_clusters(data)


def test_the_walk_stops_early_and_keeps_ties():
    rng = np.random.default_rng(2)
    cs = rng.integers(-500, 500, (64, 8))
    cs[40] = cs[3]  # equal centroids: the smaller number wins
    x = np.concatenate([cs + rng.integers(-3, 4, cs.shape), cs[[40, 3]], rng.integers(-900, 900, (50, 8)), np.array([[0] * 8])])
    number, distance, computed = centroids.Lists(cs).nearest(x)
    exact = np.square(x[:, None] - cs[None]).sum(2)
    assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all() and computed < exact.size * 0.8
    tie = np.array([[-2], [2], [2]])
    assert centroids.Lists(tie).nearest(np.array([[0], [9]]))[0].tolist() == [0, 1]


def brute_top(rows, k=5):
    kept = whole(rows, 256, None)
    out = []
    for at, (q, x) in enumerate(kept):
        if q is not None and q % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(x, y)), math.inf if v is None else v) for i, (v, y) in enumerate(kept) if i != at and len(x) == len(y)]
            out += [(q, r + 1, None if v == math.inf else v, -s) for r, (s, v) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("rows", [0, 3, None])
def test_search_equals_comparing_all_vectors(spark, monkeypatch, rows, small):
    if small:  # many pages, trees, blocks and tasks
        monkeypatch.setattr(mtree, "PAGE", 4)
        monkeypatch.setattr(mtree, "TREE_ROWS", 20)
        monkeypatch.setattr(mtree, "QUERY_BLOCK", 2)
        monkeypatch.setattr(mtree, "TREES_A_TASK", 2)
    data = odd_rows(6, np.random.default_rng(3))[:rows]
    got = mtree.top_k(spark, table_of(spark, data), F.col("vec_id") % 50 == 0).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == brute_top(data)


@pytest.mark.parametrize("scale", [1, 1 << 20])
def test_bounds_save_products(scale):
    rng = np.random.default_rng(4)
    centers = rng.normal(0, 400, (20, 16))
    x = np.floor(np.repeat(centers, 100, axis=0) + rng.normal(0, 10, (2000, 16))).astype(np.int64) * scale
    tree = mtree.Tree.build(x, np.arange(2000), np.arange(2000), 32)
    assert all(len(p.x) <= 64 for p in tree.pages)
    own = np.arange(0, 2000, 97)
    for group in (own, own[:1]):
        best = mtree.Best(len(group), 5)
        computed = mtree.search(tree, x[group], group, best)
        for i, q in enumerate(group.tolist()):
            want = sorted(((-int(x[q] @ x[j]), j) for j in range(2000) if j != q))[:5]
            assert best.rows(i) == [(-s, j) for s, j in want]
        assert computed < len(group) * 1000


def test_copies_are_split_over_pages():
    copies = mtree.Tree.build(np.ones((500, 3), np.int64), np.arange(500), np.arange(500), 8)
    best = mtree.Best(1, 5)
    mtree.search(copies, np.ones((1, 3), np.int64), np.array([0]), best)
    assert best.rows(0) == [(3, i) for i in range(1, 6)] and max(len(p.x) for p in copies.pages) <= 8
    few = mtree.Best(1, 5)
    mtree.search(mtree.Tree.build(np.ones((2, 3), np.int64), np.arange(2), np.arange(2)), np.ones((1, 3), np.int64), np.array([0]), few)
    assert few.rows(0) == [(3, 1)]


def test_components_beyond_64_bit_scores_are_named(spark):
    with pytest.raises(Exception, match="would not fit"):
        vectors.whole_vectors(table_of(spark, [(1, [1e30])]), "vec_id", "embedding", 256).collect()
