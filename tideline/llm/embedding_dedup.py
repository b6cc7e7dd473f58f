"""Near-duplicate embeddings by random-hyperplane sign hashing.

Each of several tables hashes a vector to the signs of its products with random
hyperplanes.  Vectors that meet in a bucket are verified by their exact cosine,
and links are gathered to components.  A pair that meets in several tables is
counted in the first of them only, so no list of pairs is ever made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Forest, block_pairs, by_key, connected_components, keep, pairs_in_runs, whole_groups


def tables_needed(bits: int, cosine: float, recall: float) -> int:
    """Tables that find a pair at ``cosine`` with probability ``recall``."""
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(1 - recall) / math.log(1 - agree))


def hyperplanes(dims: int, table: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, table, dims]).standard_normal((dims, bits))


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """A column of equally long lists without nulls as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def usable(vector_col: str, *needed: Column) -> Column:
    """Whether a vector is not null, empty or zero, holds finite numbers only, and nothing ``needed`` is null."""
    v = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    for c in needed:
        ok = ok & c.isNotNull()
    return F.coalesce(ok, F.lit(False))


def sign_hashes(reps: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """(rep, label, dims, sigs): a long of sign bits for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["dims"].to_numpy(zero_copy_only=False)
            sigs = np.zeros((batch.num_rows, tables), np.int64)
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                m = matrix(batch["v"].take(pa.array(at)), int(dims))
                for t in range(tables):
                    positive = m @ hyperplanes(int(dims), t, bits, seed) > 0
                    sigs[at, t] = positive @ (1 << np.arange(bits, dtype=np.int64))
            lists = pa.ListArray.from_arrays(np.arange(0, sigs.size + 1, tables, dtype=np.int32), pa.array(sigs.ravel()))
            yield pa.RecordBatch.from_arrays([batch["rep"], batch["label"], batch["dims"], lists], ["rep", "label", "dims", "sigs"])

    return reps.select("rep", "label", "dims", "v").mapInArrow(run, "rep long, label string, dims int, sigs array<long>")


def embedding_near_dups(
    vectors: DataFrame, cosine: float = 0.98, bits: int = 16, recall: float = 0.9999, seed: int = 11,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
) -> DataFrame:
    """(id, n_links, component_id), one row for each row of ``vectors``.

    Only vectors with equal labels that are not null are compared (all, where
    ``label_col`` is None) and only vectors of equal length.  Null, empty and
    zero vectors, vectors with null or non-finite components, null labels and
    null ids have no link.  ``bits`` are those of one table; the number of tables
    follows from ``recall`` for a pair exactly at the threshold, closer pairs are
    found more surely, and a pair below it is never linked.  Exact copies with
    one label are compared once, as one vector with a weight.  Ids are taken to
    be unique; a repeated id is linked with itself.
    """
    tables = tables_needed(bits, cosine, recall)
    label = F.lit("") if label_col is None else F.col(label_col).cast("string")
    takes_part = usable(vector_col, F.col(id_col), label)
    rows = vectors.where(takes_part).select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).alias("v"))
    rows = rows.withColumn("copy", F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256))
    reps = keep(rows.groupBy("label", "copy").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("v").alias("v")).withColumn("dims", F.size("v")))
    sigs = keep(sign_hashes(reps, bits, tables, seed))
    buckets = sigs.select("rep", "label", "dims", F.posexplode("sigs").alias("t", "sig"))
    meet = block_pairs(buckets, ["label", "dims", "t", "sig"], F.col("rep"), limit=512)
    full = meet.select("rep", "label", "t", "key", "block", "same").join(sigs.select("rep", "label", "sigs"), ["rep", "label"]).join(reps.select("rep", "label", "weight", "v"), ["rep", "label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            key, t, rep = (table[c].to_numpy() for c in ("key", "t", "rep"))
            block, same, weight = (table[c].to_numpy() for c in ("block", "same", "weight"))
            size = np.diff(table["v"].combine_chunks().offsets.to_numpy())
            label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
            sig = table["sigs"].combine_chunks().flatten().to_numpy().reshape(len(key), tables)
            v = np.zeros((len(key), size.max()))
            for dims in np.unique(size):
                at = np.flatnonzero(size == dims)
                v[at, :dims] = matrix(table["v"].take(pa.array(at)), int(dims))
            norm = np.sqrt(np.einsum("ij,ij->i", v, v))
            n_links, forest = np.zeros(len(key), np.int64), Forest(len(key))
            for i, j in pairs_in_runs(key):
                meets = (same[i] | (block[i] != block[j])) & (label[i] == label[j]) & (size[i] == size[j]) & (t[i] == t[j])
                i, j = i[meets], j[meets]
                near = np.einsum("ij,ij->i", v[i], v[j]) / (norm[i] * norm[j]) >= cosine
                i, j = i[near], j[near]
                first = np.argmax(sig[i] == sig[j], axis=1) == t[i]
                i, j = i[first], j[first]
                if len(i):
                    np.add.at(n_links, i, weight[j])
                    np.add.at(n_links, j, weight[i])
                    forest.link(i, j)
            root = forest.settle()
            yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(rep[root]), pa.array(n_links)], ["src", "dst", "n"])

    seen = keep(by_key(full).mapInArrow(run, "src long, dst long, n long").where("n > 0"))
    found = connected_components(seen.select("src", "dst"))
    linked = seen.groupBy(F.col("src").alias("rep")).agg(F.sum("n").alias("n"))
    named = keep(reps.select("label", "copy", "rep", "weight").join(linked, "rep", "left").join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "label", "copy", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    joined = rows.select("id", "label", "copy").join(named, ["label", "copy"]).select("id", "n_links", "component_id")
    alone = vectors.where(~takes_part).select(F.col(id_col).cast("long").alias("id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).cast("long").alias("component_id"))
    return joined.unionByName(alone)

