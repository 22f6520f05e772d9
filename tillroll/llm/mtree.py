"""Exact top-k search by inner product with M-trees.

All vectors are indexed in M-trees: paged metric nodes whose entries hold an object, its covering
radius and its distance to the node's own routing object (Ciaccia, Patella and Zezula 1997). Queries are
searched best-first: the page with the highest upper bound next, until no page can hold a score as
high as the k-th best found. With p a routing object, r a covering radius and d a stored parent distance,
the triangle inequality (with Cauchy and Schwarz) bounds the scores below an entry twice:

    q.x <= q.parent + |q| (d + r)      from what is stored, before q.p is computed
    q.x <= q.p + |q| r                 once it is

so an entry, or a single vector (r = 0), that the first bound rules out costs no product. Bounds
are rounded up by more than floating point can lose, and scores are exact whole numbers.

On Spark: rows go to the nearest of a few routing objects (``REGIONS``, chosen by hash: a bounded
sample, only its choice of regions depends on it), a region of more than ``TREE_ROWS`` rows to several
trees, so that a region with a third of all rows, or a third of equal vectors, is many trees. Trees are stored
as rows of pages. Queries are cut into blocks; every block meets every tree in tasks of
``TREES_A_TASK`` trees, a tree at a time, keeping each query's best; a window over these
few rows gives the final ranks. Nothing that grows with the data is broadcast or collected.

Defined cases: null vectors and those with null or non-finite components take no part; a query meets
the vectors of its own width only, and of those every row but itself (a repeated ``vec_id`` is another
row); a null ``vec_id`` is a candidate, last among equal scores, and no query; an empty vector
scores 0 with the other empty ones; fewer candidates than ``k`` give as many ranks; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import session_workspace, slices
from tillroll.llm.vectors import whole_vectors

#: Entries a page; children a page splits into; vectors a tree; routing objects of the regions.
PAGE, TREE_ROWS, REGIONS = 128, 1 << 14, 32
QUERY_BLOCK, TREES_A_TASK = 1024, 4
#: Relative room for rounding in bounds.
ROOM = 1e-9
NO_ID = np.int64(np.iinfo(np.int64).max)  # a null vec_id, last among equals
NOTHING = np.int64(-(1 << 63) + 1)  # the score of no candidate

TREES = "tree long, width int, rows long, pages array<binary>"
BLOCKS = "block int, width int, queries long, data binary"
FOUND = "query_uid long, query_id long, score long, vec_id long"


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of x and those of y."""
    fx, fy = x.astype(np.float64), y.astype(np.float64)
    square = np.square(fx).sum(1)[:, None] + np.square(fy).sum(1)[None, :] - 2 * fx @ fy.T
    return np.sqrt(np.maximum(square, 0))


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of x and the vector y (differences first: no cancellation)."""
    return np.sqrt(np.square((x - y).astype(np.float64)).sum(axis=1))


@dataclass(frozen=True)
class Page:
    """Entries: objects, their distance to the page's routing object, covering radii, and either
    child pages (inner) or the vectors' own keys (leaf)."""

    leaf: bool
    x: np.ndarray
    to_parent: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    uid: np.ndarray
    vec_id: np.ndarray


class Tree:
    """``pages[0]`` is the root; its routing object is ``center``."""

    def __init__(self, center: np.ndarray, pages: list[Page]):
        self.center, self.pages = center, pages

    @classmethod
    def build(cls, x: np.ndarray, uid: np.ndarray, vec_id: np.ndarray, page: int = PAGE) -> Tree:
        """Bulk load: members go to the nearest of some of them, level by level, until they fit a page."""
        pages: list[Page | None] = [None]
        none = np.empty(0, np.int64)
        todo = [(0, np.arange(len(x)), x[0])]
        while todo:
            at, rows, center = todo.pop()
            if len(rows) <= page:
                pages[at] = Page(True, x[rows], distance(x[rows], center), np.zeros(len(rows)), none, uid[rows], vec_id[rows])
                continue
            picked = rows[np.linspace(0, len(rows) - 1, min(page, 1 + len(rows) // page)).astype(np.int64)]
            nearest = distances(x[rows], x[picked]).argmin(axis=1)
            groups = [rows[nearest == i] for i in range(len(picked))]
            if max(len(g) for g in groups) == len(rows):  # equal vectors: even pieces of them
                groups = np.array_split(rows, len(picked))
            routes, radii, children = [], [], []
            for route, members in zip(picked, groups):
                if len(members):
                    pages.append(None)
                    todo.append((len(pages) - 1, members, x[route]))
                    routes.append(route)
                    radii.append(distance(x[members], x[route]).max())
                    children.append(len(pages) - 1)
            pages[at] = Page(False, x[routes], distance(x[routes], center), np.array(radii), np.array(children), none, none)
        return cls(x[0], pages)

    def packed(self) -> list[bytes]:
        return [pickle.dumps(self.center)] + [pickle.dumps(p) for p in self.pages]

    @classmethod
    def unpacked(cls, rows: list[bytes]) -> Tree:
        return cls(pickle.loads(rows[0]), [pickle.loads(r) for r in rows[1:]])


class Best:
    """The best candidates of a block of queries: scores and ids, the best first."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), NOTHING)
        self.vec_id = np.full((queries, k), NO_ID)

    @property
    def least(self) -> np.ndarray:
        """Per query: a lower score can't be among its best."""
        return self.score[:, -1]

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates (a column each) to the queries ``rows``; ``NOTHING`` is none."""
        better = (scores >= self.least[rows, None]).any(axis=1)
        rows, scores = rows[better], scores[better]
        if len(rows):
            k = self.score.shape[1]
            score = np.concatenate([self.score[rows], scores], axis=1)
            vec_id = np.concatenate([self.vec_id[rows], np.broadcast_to(ids, scores.shape)], axis=1)
            first = np.lexsort((vec_id, -score), axis=1)[:, :k]
            self.score[rows] = np.take_along_axis(score, first, 1)
            self.vec_id[rows] = np.take_along_axis(vec_id, first, 1)

    def rows(self, query: int) -> list[tuple[int, int]]:
        """(score, vec_id) of a query, the best first."""
        return [(s, v) for s, v in zip(self.score[query].tolist(), self.vec_id[query].tolist()) if s != NOTHING]


def _up(bound: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return bound + ROOM * scale + 1


def products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of the rows; in floating point where that is ``exact``."""
    return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else q @ x.T


def search(tree: Tree, q: np.ndarray, own: np.ndarray, best: Best) -> int:
    """Offers to ``best`` what can be among the best of the queries ``q`` (but each one's row ``own``).

    The block goes through the tree together: the page with the highest bound of any of its queries
    is next, and of the queries only those whose own bound reaches their own k-th best go into it.
    Returns how many products of a query and an entry were not ruled out.
    """
    norm = np.sqrt(np.square(q.astype(np.float64)).sum(axis=1))
    most = max((float(np.abs(p.x).max(initial=0)) for p in tree.pages), default=0) * float(np.abs(q).max(initial=0))
    exact = most * q.shape[1] < 1 << 52
    everyone = np.arange(len(q))
    start = (0, everyone, np.full(len(q), np.inf), products(q, tree.center[None], exact)[:, 0])
    queue: list[tuple] = [(-np.inf, 0, *start)]
    computed, pushed = len(q), 0
    while queue:
        top, _, at, rows, bounds, parent = heapq.heappop(queue)
        if -top < best.least.min():
            break  # no page left is better for any query
        alive = bounds >= best.least[rows]
        rows, parent, page = rows[alive], parent[alive], tree.pages[at]
        if not len(rows):
            continue
        reach = norm[rows, None] * (page.to_parent + page.radius)
        stay = _up(parent[:, None] + reach, np.abs(parent)[:, None] + reach) >= best.least[rows, None]
        some, cols = np.flatnonzero(stay.any(axis=1)), np.flatnonzero(stay.any(axis=0))
        if not len(some):
            continue
        stay, rows = stay[np.ix_(some, cols)], rows[some]
        scores = products(q[rows], page.x[cols], exact)
        computed += int(stay.sum())
        if page.leaf:
            mine = page.uid[cols] == own[rows, None]
            best.offer(rows, np.where(stay & ~mine, scores, NOTHING), page.vec_id[cols])
            continue
        reach = norm[rows, None] * page.radius[cols]
        bounds = _up(scores + reach, np.abs(scores) + reach)
        stay &= bounds >= best.least[rows, None]
        for j in np.flatnonzero(stay.any(axis=0)).tolist():
            go, pushed = stay[:, j], pushed + 1
            heapq.heappush(queue, (-float(bounds[go, j].max()), pushed, int(page.child[cols[j]]), rows[go], bounds[go, j], scores[go, j]))
    return computed


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by ``keys``, those of each value of them together."""
    held: list[pd.DataFrame] = []
    for b in batches:
        rows = b.to_pandas()
        if rows.empty:
            continue
        cut = np.flatnonzero((rows[keys].to_numpy()[1:] != rows[keys].to_numpy()[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(rows)]):
            part = rows.iloc[lo:hi]
            if held and (held[0][keys].iloc[0] != part[keys].iloc[0]).any():
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _dealt(rows: DataFrame, keys: list[str], run: Callable, schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """``run`` on the batches of rows that are clustered and sorted by ``keys``."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _region(vectors: DataFrame, routes: dict[int, np.ndarray]) -> DataFrame:
    """The vectors with the number of the nearest routing object of their width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "x"):
            widths = np.asarray(b.column("x").value_lengths())
            region = np.zeros(b.num_rows, np.int32)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                if width in routes:
                    x = np.array(b.column("x").take(pa.array(rows)).flatten()).reshape(-1, width)
                    region[rows] = distances(x, routes[width]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("vec_id"), b.column("x"), pa.array(widths, pa.int32()), pa.array(region)],
                ["uid", "vec_id", "x", "width", "region"],
            )

    return vectors.select("uid", "vec_id", "x").mapInArrow(run, "uid long, vec_id long, x array<long>, width int, region int")


def index(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The stored trees of all rows of ``vectors`` (uid, vec_id, x)."""
    ws = session_workspace(spark)
    by_hash = vectors.orderBy(F.xxhash64("uid")).limit(REGIONS).collect()
    routes: dict[int, list] = {}
    for r in by_hash:
        if len(r["x"]):
            routes.setdefault(len(r["x"]), []).append(r["x"])
    placed = ws.stage(_region(vectors, {w: np.array(x, np.int64) for w, x in routes.items()}), "regions")
    sizes = placed.groupBy("width", "region").count()
    pieces = F.ceil(F.col("count") / TREE_ROWS).cast("int")
    dealt = placed.join(sizes.filter(F.col("count") > TREE_ROWS), ["width", "region"], "left").select(
        "uid", "vec_id", "x", "width", "region", F.pmod(F.xxhash64("uid"), F.coalesce(pieces, F.lit(1))).cast("int").alias("piece")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["width", "region", "piece"]):
            width = int(rows["width"].iloc[0])
            x = np.concatenate(rows["x"].to_list()).reshape(len(rows), width) if width else np.zeros((len(rows), 0), np.int64)
            tree = Tree.build(x.astype(np.int64), rows["uid"].to_numpy(), rows["vec_id"].fillna(NO_ID).to_numpy(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(rows["uid"].min())]), pa.array([width], pa.int32()), pa.array([len(rows)]), pa.array([tree.packed()], pa.list_(pa.binary()))],
                ["tree", "width", "rows", "pages"],
            )

    return ws.stage(_dealt(dealt, ["width", "region", "piece"], run, TREES), "trees")


def query_blocks(queries: DataFrame, many: int) -> DataFrame:
    """Queries (uid, vec_id, x) in ``many`` blocks for each width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["block", "width"]):
            data = (rows["uid"].to_numpy(), rows["vec_id"].to_numpy(np.int64), np.array(rows["x"].to_list(), np.int64).reshape(len(rows), -1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(rows["block"].iloc[0])], pa.int32()), pa.array([int(rows["width"].iloc[0])], pa.int32()), pa.array([len(rows)]),
                 pa.array([pickle.dumps(data)], pa.binary())],
                ["block", "width", "queries", "data"],
            )

    block = F.pmod(F.xxhash64("uid"), F.lit(many)).cast("int").alias("block")
    return _dealt(queries.select(block, F.size("x").alias("width"), "uid", "vec_id", "x"), ["block", "width"], run, BLOCKS)


def top_k(
    spark: SparkSession, embeddings: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """Per query (a row with a ``vec_id`` that ``is_query``, a condition on the column ``vec_id``, holds
    for) its ``k`` highest scores: query_id, rank, vec_id, score."""
    ws = session_workspace(spark)
    vectors = ws.stage(whole_vectors(embeddings, vec_id, vector, scale).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    queries = vectors.filter(F.col("vec_id").isNotNull() & is_query)
    many = max(1, -(-queries.count() // QUERY_BLOCK))
    trees = index(spark, vectors)
    tasks = max(1, -(-trees.count() // TREES_A_TASK))
    share = F.pmod(F.xxhash64("tree"), F.lit(tasks)).cast("int").alias("share")
    nothing = [F.lit(None).cast("array<binary>").alias("pages"), F.lit(None).cast("binary").alias("data")]
    sides = trees.select(F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("block"), share, "width", F.lit(1).alias("kind"), "tree", "pages", nothing[1])
    sides = sides.unionByName(
        query_blocks(queries, many).select(
            "block", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("share"), "width", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("tree"), nothing[0], "data"
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, held = None, None
        for b in batches:
            for i in range(b.num_rows):
                key = tuple(b.column(c)[i].as_py() for c in ("block", "share", "width"))
                if key != met:
                    yield from _best_rows(held)
                    met, held = key, None
                if b.column("kind")[i].as_py() == 0:
                    uid, ids, x = pickle.loads(b.column("data")[i].as_py())
                    held = uid, ids, x, Best(len(uid), k)
                elif held is not None:
                    search(Tree.unpacked(b.column("pages")[i].as_py()), held[2], held[0], held[3])
        yield from _best_rows(held)

    found = _dealt(sides, ["block", "share", "width"], run, FOUND, ("kind", "tree"))
    first = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _best_rows(held: tuple | None) -> Iterator[pa.RecordBatch]:
    if held is not None:
        uid, ids, _, best = held
        rows = [(u, q, s, None if v == NO_ID else v) for i, (u, q) in enumerate(zip(uid.tolist(), ids.tolist())) for s, v in best.rows(i)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["query_uid", "query_id", "score", "vec_id"])
