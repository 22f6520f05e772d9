"""Centroid clustering by the threshold algorithm.

Vectors are assigned to the nearest of a few centroids (squared Euclidean distance on whole numbers,
ties to the smaller number) in rounds that move each centroid to the exact floor of its vectors' mean.

The nearest centroid is found without comparing a vector with all of them: every dimension has its
centroids in a sorted list, and from the vector's value the lists are walked outward, the nearer
neighbour first. A centroid met for the first time gets its exact distance. One not met in any
list is at least as far in each dimension as that list's frontier, so once the sum of the squared
frontier gaps strictly exceeds the best exact distance, no other centroid can be nearer or as near
(Fagin, Lotem and Naor 2003). Tasks do this for blocks of vectors at once.

Spark reads the stored whole vectors once a round. A task sends its clusters' counts and
component sums, at most (clusters x (width + 1)) numbers; Spark adds them up exactly (DECIMAL), and only
the sums of the clusters reach the driver, which are bounded by the parameters. A cluster that holds
all vectors is therefore summed by all tasks.

Defined cases: vectors of another width, null ones and those with null or non-finite components take
no part; fewer vectors than ``clusters`` start as many centroids; an empty centroid stays where it is;
a null ``vec_id`` is assigned like any other but starts no centroid; repeated rows are rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import session_workspace, slices
from tillroll.llm.vectors import matrix, whole_vectors

BLOCK = 4096
ASSIGNED = "vec_id long, cluster int, distance long"
SUMS = "cluster int, sums array<long>"
#: The gap beyond the end of a list: more than any gap between two components.
NO_MORE = np.int64(1) << np.int64(29)


class Lists:
    """Per dimension the centroids sorted by their value."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, 0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of each row's nearest centroid, and how many distances were computed."""
        k, width = self.centroids.shape
        above = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(width)], axis=1)
        below, dims = above - 1, np.arange(width)
        exact = np.full((len(x), k), np.iinfo(np.int64).max)
        left, computed = np.arange(len(x)), 0
        for _ in range(k):  # each step takes one centroid from every list
            rows = x[left]
            lo, hi = below[left], above[left]
            gap_lo = np.where(lo >= 0, rows - self.values[np.maximum(lo, 0), dims], NO_MORE)
            gap_hi = np.where(hi < k, self.values[np.minimum(hi, k - 1), dims] - rows, NO_MORE)
            down = gap_lo <= gap_hi
            met = self.order[np.where(down, lo, hi), dims]
            new = np.zeros((len(left), k), bool)
            np.put_along_axis(new, met, True, 1)
            new &= exact[left] == np.iinfo(np.int64).max
            at, who = np.nonzero(new)
            exact[left[at], who] = np.square(rows[at] - self.centroids[who]).sum(axis=1)
            computed += len(at)
            below[left], above[left] = lo - down, hi + ~down
            frontier = np.square(np.minimum(gap_lo, gap_hi)).sum(axis=1)
            left = left[frontier <= exact[left].min(axis=1)]
            if not len(left):
                break
        number = exact.argmin(axis=1)  # the first, so the smaller number, of equals
        return number, exact[np.arange(len(x)), number], computed


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in slices(batches, "x"):
        for lo in range(0, b.num_rows, BLOCK):
            part = b.slice(lo, BLOCK)
            yield part, matrix(part.column("x"))


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int]]]:
    """Per non-empty cluster the exact sums of its vectors' components, then their count."""
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, sums = Lists(centroids), np.zeros((k, width + 1), np.int64)
        for _, x in _blocks(batches):
            number, _, _ = lists.nearest(x)
            np.add.at(sums, number, np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1))
        used = np.flatnonzero(sums[:, -1])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["cluster", "sums"])

    added = (
        vectors.select("vec_id", "x").mapInArrow(run, SUMS).select("cluster", F.posexplode("sums").alias("at", "value"))
        .groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    )
    found: dict[int, list[int]] = {}
    for r in added.collect():  # clusters * (width + 1) rows at most
        found.setdefault(r["cluster"], [0] * (width + 1))[r["at"]] = int(r["value"])
    return sorted(found.items())


def first_centroids(vectors: DataFrame, many: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``<seed>:<vec_id>``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter(F.col("vec_id").isNotNull()).withColumn("_key", key).orderBy("_key", "x").limit(many).collect()
    return np.array([r["x"] for r in rows], np.int64)


def cluster(
    spark: SparkSession,
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    width: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    seed: int = 1,
) -> tuple[DataFrame, np.ndarray]:
    """Per vector: vec_id, cluster, distance; and the final centroids."""
    ws = session_workspace(spark)
    vectors = ws.stage(whole_vectors(embeddings, vec_id, vector, scale, width), "vectors")
    centroids = first_centroids(vectors, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED), centroids
    for _ in range(rounds):
        moved = centroids.copy()
        for number, sums in cluster_sums(vectors, centroids):
            moved[number] = [s // sums[-1] for s in sums[:-1]]  # floor, for negative sums too
        centroids = moved

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for b, x in _blocks(batches):
            number, distance, _ = lists.nearest(x)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return ws.stage(vectors.mapInArrow(run, ASSIGNED), "assigned"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(spark: SparkSession, assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignment with its cluster's and the whole inertia and its centroid's digest."""
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(k, s, sum(sums.values()), centroid_digest(centroids[k])) for k, s in sorted(sums.items())]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster")  # a row for each cluster
