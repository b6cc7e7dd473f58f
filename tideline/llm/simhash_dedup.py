"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 16 segments of 4 bits.  The vector of their bit
counts is an embedding in a 16-dimensional grid in which the Manhattan distance
never exceeds the Hamming distance.  Two fingerprints within Manhattan distance
2 have a grid point within 1 of each, so every fingerprint goes to its own cell
and the 32 next to it, and a range join is an equality join on cells.  Pairs
that meet are verified on all 64 bits.

Texts whose shingles have a Jaccard similarity of 0.8 are about 10 bits apart, out
of reach of a grid of 16 counts from 0 to 4: of random fingerprints, 2 % of all pairs
lie within Manhattan distance 10 and 20 % within 14.  :func:`near_duplicates` therefore takes candidates from MinHash bands
as well as from the grid, and verifies all of them by exact Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Forest, among, block_pairs, by_key, connected_components, keep, pairs_in_runs, small_batches, whole_groups
from tideline.llm.substring_dedup import SAMPLED, band_hashes, bands_needed, busy_bands, linear_hashes, similar

SEGMENTS, WIDTH = 16, 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def hashes(text: bytes, shingle: int = 5, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of one text, some at a time: of the whole sequence if it is shorter, of nothing without words."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words) - shingle + 1 if len(words) >= shingle else min(1, len(words))
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    each = map(xxhash.xxh64_intdigest, parts, repeat(seed))
    for at in range(0, n, 16384):
        yield np.fromiter(each, np.uint64, min(16384, n - at))


def fingerprint(text: bytes, shingle: int = 5, seed: int = 42) -> int:
    """The fingerprint of one text; 0 for a text without words."""
    ones, n = np.zeros(64, np.int64), 0
    for h in hashes(text, shingle, seed):
        ones += bit_sums(h)
        n += len(h)
    return majority(ones, n)


def bit_sums(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): one row for each row of ``docs``; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def cells(fps: DataFrame) -> DataFrame:
    """(cell, fp) for the cell of each fingerprint and the 32 cells at distance 1.

    A cell packs the 16 bit counts, each plus one, into 3 bits apiece: exact.
    """
    own = sum((F.shiftleft(F.bit_count(F.shiftrightunsigned("fp", WIDTH * i).bitwiseAND(F.lit(15))).cast("long") + 1, 3 * i) for i in range(SEGMENTS)), F.lit(0).cast("long"))
    steps = [0] + [s << (3 * i) for i in range(SEGMENTS) for s in (1, -1)]
    return fps.withColumn("own", own).select("fp", F.explode(F.array(*[F.col("own") + F.lit(s).cast("long") for s in steps])).alias("cell"))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (src, dst) between distinct fingerprints that span the same
    components as all pairs within ``max_bits`` (at most 2, the reach of the grid)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the grid of cells reaches 2 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches):
            key, fp = table["key"].to_numpy(), table["fp"].to_numpy().view(np.uint64)
            block, same = table["block"].to_numpy(), table["same"].to_numpy()
            forest = Forest(len(key))
            for i, j in pairs_in_runs(key):
                near = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
                near &= same[i] | (block[i] != block[j])
                if near.any():
                    forest.link(i[near], j[near])
            root = forest.settle()
            at = np.flatnonzero(root != np.arange(len(root)))
            s, d = fp.view(np.int64)[at], fp.view(np.int64)[root[at]]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(d)], ["src", "dst"])

    distinct = fps.select("fp").distinct()
    meet = block_pairs(keep(cells(distinct)), ["cell"], F.col("fp"))
    return by_key(meet.select("key", "fp", "block", "same")).mapInArrow(run, "src long, dst long")


def simhash_components(docs: DataFrame, shingle: int = 5, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for each row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints that differ
    in at most ``max_bits`` bits; exact copies share a fingerprint and meet once.
    Null and empty texts have fingerprint 0 and are linked like others.  Rows
    with a null id keep their fingerprint and take part in no minimum; repeated
    ids give repeated rows; an empty table gives none; other columns are ignored.
    """
    return fingerprint_components(keep(fingerprints(docs, shingle, id_col, text_col)), max_bits)


def fingerprint_components(fps: DataFrame, max_bits: int) -> DataFrame:
    """(id, fp, component_id) for (id, fp)."""
    smallest = keep(fps.groupBy("fp").agg(F.min("id").alias("own_min")))
    found = connected_components(links(smallest, max_bits))
    named = smallest.join(found.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "own_min", F.coalesce("component", "fp").alias("component"))
    named = keep(named)
    least = keep(named.groupBy("component").agg(F.min("own_min").alias("component_id")))
    by_fp = keep(named.join(least, "component").select("fp", "component_id"))
    return fps.join(by_fp, "fp").select("id", "fp", "component_id")


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, h, fp, bands) of each text: a digest without regard to case (A-Z) and white
    space, the fingerprint, and the MinHash bands, all from one pass over its shingles."""
    odd, add = linear_hashes(bands * rows, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, fps, signatures = [], [], np.full((batch.num_rows, bands * rows), np.iinfo(np.uint64).max, np.uint64)
            for i, text in enumerate(batch.column(1)):
                text = (text.as_py() or "").encode("utf-8", "surrogatepass")
                digests.append(hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest())
                ones, n = np.zeros(64, np.int64), 0
                for h in hashes(text, shingle):
                    ones += bit_sums(h)
                    n += len(h)
                    for at in range(0, len(h), 1024):
                        np.minimum(signatures[i], (h[at : at + 1024, None] * odd + add).min(0), out=signatures[i])
                fps.append(majority(ones, n))
            key = band_hashes(signatures, bands, rows)
            lists = pa.ListArray.from_arrays(np.arange(0, key.size + 1, bands, dtype=np.int32), pa.array(key.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(np.array(fps, np.uint64).view(np.int64)), lists], ["id", "h", "fp", "bands"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, h binary, fp long, bands array<long>")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, max_bits: int = 2, rows: int = 4, recall: float = 0.9998, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component_id) for each row of ``docs``: the smallest id reachable over pairs of
    texts whose sets of ``shingle``-word shingles have at least this Jaccard similarity.

    Texts that differ in case (A-Z) or white space only are one, as are null texts and
    those without words.  Candidates are the members of a component within ``max_bits`` in
    the SimHash grid, with its first one, and pairs that meet in MinHash bands, a pair at
    the threshold with probability ``recall`` and closer ones more surely; all are verified.  Ids are distinct and not null;
    an empty table gives no rows; other columns are ignored.
    """
    bands = bands_needed(rows, similarity, recall)
    made = keep(sketches(docs, shingle, bands, rows, id_col, text_col))
    reps = keep(made.groupBy("h").agg(F.min(F.struct("id", "fp", "bands")).alias("m")).select("h", "m.*"))
    grid = fingerprint_components(reps.select("id", "fp"), max_bits).where("id <> component_id")
    near = keep(grid.select(F.col("id").alias("pid"), F.col("component_id").alias("rep")))
    words = F.regexp_replace(F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, UPPER.lower()), r"[\x20\x09-\x0D]+", " ")
    texts = docs.select(F.col(id_col).cast("long").alias("pid"), F.col(text_col).alias("text"))
    listed = reps.select(F.col("id").alias("pid"), F.explode("bands").alias("band"))
    busy = busy_bands(listed.where(F.pmod(F.xxhash64("pid"), F.lit(SAMPLED)) == 0))
    met = similar(lambda wanted: among(texts, wanted, "pid").select("pid", F.encode(F.trim(words), "UTF-8").alias("text")), listed, busy, shingle, similarity, near)
    groups = connected_components(met)
    named = keep(reps.select("h", "id").join(groups, "id", "left").select("h", F.coalesce("component", "id").alias("component_id")))
    return made.select("id", "h").join(named, "h").select("id", "component_id")
