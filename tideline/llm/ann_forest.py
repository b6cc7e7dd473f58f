"""Nearest neighbours by inner product from a hash-prefix forest.

Every tree gives each vector a long string of hyperplane signs and keeps the
strings in a sorted array, so the vectors that share a prefix of any length with
a query are one stretch of it.  A query descends to its longest match in each
tree and then all trees ascend together, one bit at a time, until the stretches
hold enough candidates.  The index is cut into shards of bounded size, each with
its own forest; blocks of queries meet every shard, and the nearest of all
shards are merged.  For inner products of unlike lengths, vectors are lifted onto
a sphere by one more coordinate, which leaves the order of products unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import by_key, keep, whole_groups
from tideline.llm.embedding_dedup import hyperplanes, matrix, usable

DEPTH = 24


def codes(points: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """(trees, n) hash strings of DEPTH bits as integers, the first bit on top."""
    places = 1 << np.arange(DEPTH - 1, -1, -1, dtype=np.int64)
    return np.stack([(points @ hyperplanes(points.shape[1], t, DEPTH, seed) > 0) @ places for t in range(trees)])


def candidates(index: np.ndarray, queries: np.ndarray, target: float) -> np.ndarray:
    """A (queries, index) mask of the candidates that the ascent gathers.

    ``index`` and ``queries`` are codes by tree; ``target`` is the number of
    places in all stretches, repeats counted, at which a query stops ascending.
    """
    order = np.argsort(index, axis=1, kind="stable")
    arrays = np.take_along_axis(index, order, axis=1)
    trees, n = queries.shape
    low, high = np.zeros((trees, n), np.int64), np.full((trees, n), index.shape[1], np.int64)
    open_ = np.ones(n, bool)
    for length in range(DEPTH, -1, -1):
        at = np.flatnonzero(open_)
        if not len(at):
            break
        drop = DEPTH - length
        start = queries[:, at] >> drop << drop
        lo = np.stack([np.searchsorted(a, s, "left") for a, s in zip(arrays, start)])
        hi = np.stack([np.searchsorted(a, s + (1 << drop), "left") for a, s in zip(arrays, start)])
        done = (hi - lo).sum(0) >= target
        low[:, at[done]], high[:, at[done]] = lo[:, done], hi[:, done]
        open_[at[done]] = False
    mask = np.zeros((n, index.shape[1]), bool)
    for t in range(trees):
        for q in range(n):
            mask[q, order[t, low[t, q] : high[t, q]]] = True
    return mask


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, trees: int = 64, share: float = 1.5, shard_rows: int = 8192,
    query_rows: int = 1024, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query.

    Queries are the rows where ``is_query`` holds, candidates all rows but the
    query's own; only vectors of equal length meet.  Null, empty and zero
    vectors, vectors with null or non-finite components and null ids take no
    part.  Ties go to the smaller id.  All rows are indexed.  ``share`` is the
    number of places, as a share of a shard and repeats counted, at which the
    ascent ends; a query for which fewer than ``k`` candidates come up in a
    shard meets the whole shard.  Ids are taken to be unique.
    """
    rows = vectors.where(usable(vector_col, F.col(id_col))).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).withColumn("dims", F.size("v"))
    rows = keep(rows)
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("nq"), F.max(F.aggregate(F.transform("v", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, b: a + b)).alias("most"))
    rows = rows.join(keep(sizes), "dims").withColumn("shards", F.ceil(F.col("n") / shard_rows)).withColumn("blocks", F.ceil(F.col("nq") / query_rows))
    deal = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    index = rows.where("blocks > 0").withColumn("shard", deal(1, F.col("shards"))).withColumn("block", each(F.col("blocks"))).withColumn("asks", F.lit(False))
    asking = rows.where("q").withColumn("block", deal(2, F.col("blocks"))).withColumn("shard", each(F.col("shards"))).withColumn("asks", F.lit(True))
    met = index.unionByName(asking).select(F.xxhash64("dims", "shard", "block").alias("key"), "asks", "id", "v", "dims", "most")

    def answer(ids, points, asks, radius2) -> Iterator[tuple]:
        lift = np.sqrt(np.maximum(0, radius2 - np.einsum("ij,ij->i", points, points)))
        x, q = points[~asks], points[asks]
        code_x = codes(np.c_[x, lift[~asks]], trees, seed)
        code_q = codes(np.c_[q, np.zeros(len(q))], trees, seed)
        x_ids, q_ids = ids[~asks], ids[asks]
        for at in range(0, len(q), 256):
            part = slice(at, at + 256)
            mask = candidates(code_x, code_q[:, part], share * len(x))
            mask[mask.sum(1) <= k] = True
            rough = np.where(mask, q[part] @ x.T, -np.inf)
            rough[q_ids[part][:, None] == x_ids[None, :]] = -np.inf
            kth = np.partition(rough, -min(k, len(x)), axis=1)[:, -min(k, len(x))]
            for i, row in enumerate(rough):
                near = np.flatnonzero((row >= kth[i] - 1e-9 * (1 + abs(kth[i]) if np.isfinite(kth[i]) else 1)) & np.isfinite(row))
                score = np.multiply(x[near], q[at + i]).sum(1)
                best = np.lexsort((x_ids[near], -score))[:k]
                yield q_ids[at + i], x_ids[near[best]], score[best]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            key = table["key"].to_numpy()
            for s, e in zip(f := np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), np.r_[f[1:], len(key)]):
                one = table.slice(s, e - s)
                for dims in np.unique(one["dims"].to_numpy()):
                    of = one.filter(pa.array(one["dims"].to_numpy() == dims))
                    asks = of["asks"].to_numpy()
                    if asks.all() or not asks.any():
                        continue
                    for q, found, score in answer(of["id"].to_numpy(), matrix(of["v"], int(dims)), asks, of["most"].to_numpy().max()):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), q)), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    best = by_key(met).mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
