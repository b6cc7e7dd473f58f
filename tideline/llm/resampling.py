"""Resampling of documents by importance for a target distribution.

Features are the runs of one to three words; hashed to buckets, they are counted
over the whole corpus and over the target's texts, and the logarithm of the two
smoothed shares' ratio is a bucket's gain.  A document's weight is the sum of the
gains of its features, looked up in one array; Gumbel noise added to the weight makes
the highest scores a sample without replacement in proportion to importance.  The
order of scores is that of a distributed radix sort.

Features are never made as texts.  The crc32 of each word is computed for all words
of a batch at once, and that of a run of words from those of its parts: the checksum
is linear, so appending n bytes to a prefix is a table lookup by n.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import keep, small_batches
from tideline.llm.radix_sort import radix_sorted
from tideline.llm.substring_dedup import text_groups

#: Fixed value: the reversed polynomial of crc32.
POLYNOMIAL = 0xEDB88320
#: Whether a byte of a lower-cased text belongs to a word: digits, letters and all of characters beyond ASCII.
IN_WORD = np.array([chr(b).isdigit() or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Words longer than this are summed one by one, and bytes appended beyond it in powers of two.
SHORT = 64
#: Words whose features are made at once.
CHUNK = 200_000


def byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(POLYNOMIAL), c >> 1)
    return c


BYTES = byte_table()


def shift_tables(steps: int) -> np.ndarray:
    """[n, k, v]: byte k of a checksum, of value v, after n more zero bytes."""
    table = np.empty((steps + 1, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(steps):
        table[n + 1] = BYTES[table[n] & 255] ^ table[n] >> 8
    return table


SHIFTS = shift_tables(SHORT)


def shifted_by(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """``c`` moved by one table of four times 256 entries for all."""
    return table[0, c & 255] ^ table[1, c >> 8 & 255] ^ table[2, c >> 16 & 255] ^ table[3, c >> 24]


def doubled(table: np.ndarray) -> np.ndarray:
    """The table of twice as many bytes."""
    return shifted_by(table, table)


def shifted(c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The checksums ``c`` after ``n`` more zero bytes each."""
    at, flat = np.minimum(n, SHORT) * 1024, SHIFTS.ravel()
    out = flat[at + (c & 255)] ^ flat[at + 256 + (c >> 8 & 255)] ^ flat[at + 512 + (c >> 16 & 255)] ^ flat[at + 768 + (c >> 24)]
    rest, table = np.maximum(n - SHORT, 0), SHIFTS[1]
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = shifted_by(out[odd], table)
        rest, table = rest >> 1, doubled(table)
    return out


def word_sums(b: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """The crc32 of each of the words ``b[first:past]``."""
    n = past - first
    order = np.argsort(-n, kind="stable")
    start, size = first[order], n[order]
    state = np.full(len(n), 0xFFFFFFFF, np.uint32)
    for j in range(int(min(size[0], SHORT)) if len(size) else 0):
        live = np.searchsorted(-size, -j)  # the words of more than j bytes
        state[:live] = BYTES[(state[:live] ^ b[start[:live] + j]) & 255] ^ state[:live] >> 8
    out = np.empty(len(n), np.uint32)
    out[order] = ~state
    for i in np.flatnonzero(n > SHORT).tolist():
        out[i] = zlib.crc32(b[first[i] : past[i]])
    return out


def features(texts: list[bytes], longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The number of words, and (text, bucket) of runs of so many words within a text, for
    every run of one to ``longest``."""
    b = np.frombuffer(b" ".join(texts).lower(), np.uint8)  # bytes.lower() changes A-Z only
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    edge = np.diff(np.r_[False, IN_WORD[b], False].astype(np.int8))
    first, past = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    of = np.searchsorted(begin, first, "right") - 1
    for s in range(0, len(first), CHUNK):
        lo, e = max(0, s - longest + 1), min(s + CHUNK, len(first))
        size, here = past[lo:e] - first[lo:e], of[lo:e]
        one = word_sums(b, first[lo:e], past[lo:e])
        after_space = shifted(np.full(e - lo, zlib.crc32(b" "), np.uint32), size) ^ one
        run = one
        for k in range(longest):  # the runs of k + 1 words that end at each word
            if k:
                run = shifted(run[:-1], size[k:] + 1) ^ after_space[k:]
            ends = np.arange(max(s - lo - k, 0), len(run))
            ends = ends[here[ends] == here[ends + k]]
            yield k + 1, here[ends], (run[ends] % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(bucket, n): the features of all rows of a table of one text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for _, some in text_groups(batches):
            for _, _, bucket in features(some, longest, buckets):
                n += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    return small_batches(texts).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in ``target`` by that in ``docs``; the
    driver holds one number a bucket."""
    counts = [{r.bucket: r.n for r in bucket_counts(t, longest, buckets).collect()} for t in (docs, target)]
    every, wanted = (float(sum(c.values()) + buckets) for c in counts)
    ratio = lambda b: (counts[1].get(b, 0) + 1.0) * every / ((counts[0].get(b, 0) + 1.0) * wanted)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise in thousandths that depends on the id only; without one, on the seed only."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight, score) of the rows (row, doc_id, text)."""
    names = ["row", "doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_groups(batches):
            words, n, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for k, of, bucket in features(texts, longest, len(gains)):
                count = np.bincount(of, minlength=len(texts))
                n += count
                words += count if k == 1 else 0
                edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
                weight[of[edges]] += np.add.reduceat(gains[bucket], edges) if len(of) else 0
            score = weight + np.array([noise(k[1], seed) for k in keys], np.int64)
            columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), *map(pa.array, (words, n, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return small_batches(docs).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, longest: int = 3, buckets: int = 10_000, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row for each row of ``docs``.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred with the
    highest scores are drawn, ties to the smaller id, and have their rank from 1; others
    have none.  Words are runs of ASCII digits and letters, A-Z lower-cased, and characters
    beyond ASCII.  Null and empty texts have no features and weight 0.  Rows without an id
    share one noise and come after others of their score; rows that share an id and a score
    are drawn in the table's order.  Empty tables give no rows, or leave all gains to the
    other table; other columns are ignored.
    """
    gains = bucket_gains(docs.select(F.col(text_col).alias("text")), target.select(F.col(target_col).alias("text")), longest, buckets)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = keep(scored(rows, gains, longest, seed))
    able = found.where(F.col("n_words") >= least_words)
    edge = able.agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    low, high = edge.low or 0, edge.high or 0
    by_id = F.col("doc_id") - low if high - low < 1 << 63 else F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))
    keyed = able.select("row", (F.lit(edge.top) - F.col("score")).cast("long").alias("fall"), F.col("doc_id").isNull().cast("long").alias("without"), F.coalesce(by_id, F.lit(0)).cast("long").alias("id"))
    drawn = radix_sorted(keyed, ["fall", "without", "id"]).where(F.col("pos") < percent * edge.n // 100)
    return found.join(drawn, "row", "left").select("doc_id", "n_features", "weight", "score", (F.col("pos") + 1).alias("rank"))
