"""What several operators of this folder share: sorted group streams, block
splitting of large groups and distributed connected components, with intermediate
tables in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.sources.scratch import delete, keep

#: A run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with the session's Arrow batches limited to ``rows``: texts may be long,
    and a worker and its executor each hold a whole batch."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    return df


def drop(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`keep`."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete(spark, folder)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str = "key") -> Iterator[pa.Table]:
    """Re-cut a stream sorted by ``key`` so that no run of equal keys is split."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        k = table[key].to_numpy()
        last = int(np.searchsorted(k, k[-1], "left"))
        if last:
            yield table.slice(0, last).combine_chunks()
        rest = table.slice(last)
    if rest is not None:
        yield rest.combine_chunks()


def pairs_in_runs(key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of equal keys in a sorted array, by distance."""
    n = len(key)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    end = np.repeat(np.r_[first[1:], n], np.diff(np.r_[first, n]))
    live, d = np.arange(n), 1
    while True:
        live = live[live + d < end[live]]
        if not len(live):
            return
        yield live, live + d
        d += 1


class Forest:
    """Union of links among ``n`` places, kept as one root for each place."""

    def __init__(self, n: int):
        self.root, self.a, self.b, self.waiting = np.arange(n), [], [], 0

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.a.append(a)
        self.b.append(b)
        self.waiting += len(a)
        if self.waiting > 2_000_000:
            self.settle()

    def settle(self) -> np.ndarray:
        if self.waiting:
            a, b = np.concatenate(self.a), np.concatenate(self.b)
            root = self.root
            while True:
                ra, rb = root[a], root[b]
                apart = ra != rb
                if not apart.any():
                    break
                a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
                np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
                while not np.array_equal(up := root[root], root):
                    root = up
            self.root, self.a, self.b, self.waiting = root, [], [], 0
        return self.root


def block_pairs(df: DataFrame, group: list[str], member: Column, limit: int = 1024) -> DataFrame:
    """Split groups so that no task meets more than about ``2 * limit`` of one.

    Rows of groups of one are dropped.  Others get ``key`` (long), equal for the
    rows of one pair of blocks, ``block`` and ``same`` (the pair is one block
    twice).  Two rows of a group meet for exactly one key if rows of one block
    are compared only where ``same``, and rows of two only elsewhere.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("group_n")).where("group_n > 1")
    blocks = F.ceil(F.col("group_n") / limit)
    split = (
        df.join(sizes, group)
        .withColumn("block", F.pmod(F.xxhash64(member, F.lit(7)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    )
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return split.withColumns({"key": F.xxhash64(*group, low, high), "same": F.col("block") == F.col("other")}).drop("other", "group_n")


def by_key(df: DataFrame) -> DataFrame:
    """Deal rows out by ``key`` and sort each partition by it."""
    return df.repartition("key").sortWithinPartitions("key")


def among(df: DataFrame, ids: DataFrame, col: str, scattered: bool = False) -> DataFrame:
    """The rows of ``df`` whose ``col``, a long, is one of those of ``ids``.

    64 ids in a row are one bit mask.  Row numbers so take a few bits each, and
    Catalyst broadcasts the masks of many millions of rows where it would shuffle
    the rows of ``df`` for as many ids; beyond its bound it joins by mask.
    ``scattered`` ids, as hashes are, share a field of 16 to 32 bits for each id:
    then up to one in 16 of the other rows is let through too.
    """
    ids = ids.where(F.col(col).isNotNull())
    chunk = F.shiftright(col, 6)
    if scattered:
        chunk = chunk.bitwiseAND(F.lit((1 << (ids.count() // 4).bit_length()) - 1))
    masks = keep(ids.groupBy(chunk.alias("_chunk")).agg(F.expr(f"bit_or(shiftleft(1L, int({col} & 63)))").alias("_mask")))
    held = df.withColumn("_chunk", chunk).join(masks, "_chunk").where(f"shiftright(_mask, int({col} & 63)) & 1 = 1")
    return held.select(*df.columns)


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) longs to (id, component): the smallest id that links reach.

    Random contraction: in each round every vertex moves to the vertex with the
    smallest random rank among itself and its neighbours, and the links are drawn
    anew between those.  The number of vertices falls by a constant factor in
    expectation, so rounds grow with the logarithm of the input, chains and
    stars included.  Only the emptiness of a table reaches the driver.  Ids
    without links do not appear; null ends and loops are ignored.
    """
    spark = edges.sparkSession
    links = keep(edges.select(F.col("src").cast("long"), F.col("dst").cast("long")).where("src <> dst").distinct())
    moves: list[DataFrame] = []
    while not links.isEmpty():
        salt = F.lit(len(moves))
        both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), salt), F.col(c).alias("v"))
        move = keep(both.groupBy("src").agg(F.min(rank("dst")).alias("m")).select(F.col("src").alias("id"), F.least("m", F.struct(F.xxhash64("src", salt), F.col("src").alias("v")))["v"].alias("head")))
        moves.append(move)
        at_src = move.select(F.col("id").alias("src"), F.col("head").alias("s"))
        at_dst = move.select(F.col("id").alias("dst"), F.col("head").alias("d"))
        fewer = keep(links.join(at_src, "src").join(at_dst, "dst").where("s <> d").select(F.least("s", "d").alias("src"), F.greatest("s", "d").alias("dst")).distinct())
        drop(links)
        links = fewer
    if not moves:
        return spark.createDataFrame([], "id long, component long")
    heads = moves[0]
    for move in moves[1:]:
        heads = heads.join(move.select(F.col("id").alias("head"), F.col("head").alias("next")), "head", "left").select("id", F.coalesce("next", "head").alias("head"))
    heads = keep(heads)
    least = keep(heads.groupBy("head").agg(F.min("id").alias("component")))
    return heads.join(least, "head").select("id", "component")
