"""Centroid clustering by equal-average equal-variance search, in exact integers.

Centroids are sorted by the mean of their components.  A vector scans them outward
from its own mean: the squared difference of means times the number of components is
a lower bound of the squared distance, so the scan ends where it exceeds the best
distance so far, and what stays is also rejected by its deviation from its mean,
which adds a second square to the bound.  Centroids that neither inequality rejects
are compared by their exact integer distance.  Vectors never leave their tasks: each
task sums its vectors by centroid, and only those sums are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import keep

#: The largest magnitude of an integer component: squared distances of vectors of up to 64 of them fit a long.
LARGEST = 1 << 27


def deviation(v: np.ndarray) -> np.ndarray:
    """The length of each row's difference from its own mean."""
    away = v.shape[1] * v.astype(float) - v.sum(1, dtype=np.int64)[:, None]
    return np.sqrt(np.einsum("ij,ij->i", away, away)) / v.shape[1]


def nearest_centroids(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of the nearest centroid of each row of integers, ties to
    the smaller number, and how many distances were computed."""
    k, dims = centroids.shape
    sums, mean = centroids.sum(1), v.sum(1)
    order = np.argsort(sums, kind="stable")
    means, spread, own = sums[order], deviation(centroids)[order], deviation(v)
    best, who = np.full(len(v), np.iinfo(np.int64).max), np.full(len(v), k)
    live, computed = np.arange(len(v)), 0
    above = np.searchsorted(means, mean)
    below = above - 1
    while len(live):
        up, down = above[live], below[live]
        gap_up = np.where(up < k, means[np.minimum(up, k - 1)] - mean[live], np.inf)
        gap_down = np.where(down >= 0, mean[live] - means[np.maximum(down, 0)], np.inf)
        upward = gap_up <= gap_down
        by_mean = np.square(np.minimum(gap_up, gap_down)) / dims
        open_ = by_mean * (1 - 1e-9) <= best[live]
        live, upward, by_mean = live[open_], upward[open_], by_mean[open_]
        at = np.where(upward, above[live], below[live])
        above[live[upward]] += 1
        below[live[~upward]] -= 1
        apart = np.maximum(np.abs(own[live] - spread[at]) - 1e-12 * (own[live] + spread[at]), 0)
        stays = (by_mean + np.square(apart)) * (1 - 1e-9) <= best[live]
        rows, number = live[stays], order[at[stays]]
        away = v[rows] - centroids[number]
        distance = np.einsum("ij,ij->i", away, away)
        nearer = (distance < best[rows]) | (distance == best[rows]) & (number < who[rows])
        best[rows[nearer]], who[rows[nearer]] = distance[nearer], number[nearer]
        computed += len(rows)
    return who, best, computed


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers floor(``scale`` * x)."""
    v = F.col(vector_col).cast("array<double>")
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST / scale)
    taken = vectors.where((F.size(v) == dims) & F.coalesce(F.forall(v, fits), F.lit(False)))
    return taken.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * scale).cast("int")).alias("v"))


def rows_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance), one row for each vector that takes part, and the centroids.

    Vectors with exactly ``dims`` components take part, none of them null, non-finite or
    beyond LARGEST once scaled; a component x counts as the integer floor(scale * x).  The
    first centroids are the ``k`` vectors with the smallest sha256 of ``seed:vec_id`` (all,
    if there are fewer; vectors without an id come last, and of rows that share an id the
    smaller vector first).  Each round assigns every vector to its nearest centroid and
    replaces each that has vectors by their floored mean.  Rows that repeat an id are
    vectors of their own; an empty table gives no rows; other columns are ignored.  What
    the driver holds are the ``k`` centroids.
    """
    kept = keep(whole_vectors(vectors, dims, scale, id_col, vector_col))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = np.array([r.v for r in first], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(first) else 0):
        for number, sums, n in summed(kept, centroids):
            centroids[number] = [s // n for s in sums]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, distance, _ = nearest_centroids(rows_of(batch, dims), centroids)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(who.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return kept.mapInArrow(assign, "vec_id long, cluster int, distance long"), centroids.tolist()


def summed(kept: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int], int]]:
    """(number, sums of components, vectors) of each centroid that has vectors."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            v = rows_of(batch, dims)
            who = nearest_centroids(v, centroids)[0]
            np.add.at(sums, who, v)
            counts += np.bincount(who, minlength=k)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at]), pa.array(sums[at].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    partial = kept.mapInArrow(run, "cluster long, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("i", "s"))
    total = partial.groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    by_cluster = total.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("i", "s"))).alias("sums"), F.max("n").alias("n"))
    return [(r.cluster, [x.s for x in r.sums], r.n) for r in by_cluster.collect()]


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned``, which is read twice, with cluster_inertia, inertia and centroid_sha256;
    an inertia beyond a long is null."""
    spark = assigned.sparkSession
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    held = lambda x: x if x < 1 << 63 else None
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    rows = [(i, held(sums.get(i, 0)), held(sum(sums.values())), digest(c)) for i, c in enumerate(centroids)]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
