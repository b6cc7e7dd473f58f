"""Token counts by distinct pre-token, without making any document's ids.

Documents are read in blocks.  A block lists each of its pre-tokens once, with
the block's documents that hold it and how often, and deals those lists out to
buckets by the pre-token's hash.  A bucket so meets every block's list of its
pre-tokens: it has the library count the pieces of each distinct pre-token once,
joins the counts to the lists, and sums products of counts and frequencies by
document.  Pre-tokens that are a vocabulary entry of their own are one piece each,
known from the vocabulary, and are summed in the block.  Short pre-tokens here may
reach from one single space to the next: what the library cuts further lies within
them, and nothing reaches across.  Longer ones are cut by the library's own pattern.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches
from tideline.llm.tokens import encoder, tokenizer_path

#: A block ends at so many documents or characters.
BLOCK_DOCS, BLOCK_CHARS = 60_000, 32_000_000
#: Buckets of pre-tokens at least; a task's memory holds the distinct pre-tokens of its buckets.
BUCKETS = 4096
#: A pre-token in more than this share of a block's documents is dealt by block as
#: well and counted in each bucket it meets, so that no bucket gathers all its lists.
COMMON = 1 / 64


def single(path: str) -> frozenset[str]:
    """Vocabulary entries that the library encodes as one token: a bounded set."""
    library = encoder(path).library
    texts = (library.decode([i], skip_special_tokens=False) for i in range(library.get_vocab_size()))
    return frozenset(t for t in texts if len(encoder(path).ids(t)) == 1)


def packed(texts: list[bytes], sizes: np.ndarray, at: np.ndarray, times: np.ndarray) -> bytes:
    """Pre-tokens, the length of each one's list, and the lists, compressed."""
    parts = [np.array([len(texts), len(at)], "<u4"), np.fromiter(map(len, texts), "<u4", len(texts)), sizes.astype("<u4"), times.astype("<u4"), at.astype("<u2")]
    return zstandard.compress(b"".join([*(p.tobytes() for p in parts), *texts]), 3)


def unpacked(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.decompress(data)
    n, m = np.frombuffer(raw, "<u4", 2)
    lengths, sizes = np.frombuffer(raw, "<u4", n, 8), np.frombuffer(raw, "<u4", n, 8 + 4 * n)
    times, at = np.frombuffer(raw, "<u4", m, 8 + 8 * n), np.frombuffer(raw, "<u2", m, 8 + 8 * n + 4 * m)
    ends = np.cumsum(lengths, dtype=np.int64) + (8 + 8 * int(n) + 6 * int(m))
    starts = ends - lengths
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())], sizes, at, times


def bucket_of(name: int, buckets: int) -> int:
    """The bucket that takes the row of a block's ids, sizes and counts."""
    return xxhash.xxh32_intdigest(name.to_bytes(8, "little")) % buckets


def dealt_lists(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """(block, bucket, lists, ids, sizes, counts): packed lists by bucket, and for each
    block one row with its documents' ids, sizes in bytes and the number of their
    single-token pre-tokens."""
    alone = docs.sparkSession.sparkContext.broadcast(single(path))  # at most the vocabulary
    names = ["block", "bucket", "lists", "ids", "sizes", "counts"]

    def block(name: int, ids: list, sizes: list[int], texts: list[str]) -> Iterator[pa.RecordBatch]:
        one, held, often, lengths, ones = alone.value, [], [], [], []
        for text in texts:
            count = encoder(path).pre_tokens(text)
            ones.append(sum(map(count.pop, one.intersection(count))))
            held.extend(count)
            often.extend(count.values())
            lengths.append(len(count))
        of = lambda x: pa.array([x], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([bucket_of(name, buckets)], pa.int32()), pa.array([None], pa.binary()), of(ids), of(sizes), of(ones)], names)
        coded = pa.array(held, pa.string()).dictionary_encode()
        if not len(coded):
            return
        which, raw = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary()).to_pylist()
        bucket = np.fromiter(map(xxhash.xxh32_intdigest, raw), np.uint32, len(raw)) % buckets
        for i in np.flatnonzero(np.bincount(which, minlength=len(raw)) > max(64, len(texts) * COMMON)):
            bucket[i] = xxhash.xxh32_intdigest(raw[i], name & 0xFFFFFFFF) % buckets
        order = np.lexsort((which, bucket[which]))
        at = np.repeat(np.arange(len(texts)), lengths)[order]
        times, which = np.array(often)[order], which[order]
        first = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        listed, size = which[first], np.diff(np.r_[first, len(which)])
        cuts = np.searchsorted(bucket[listed], np.arange(buckets + 1))
        first = np.r_[first, len(which)]
        full = np.flatnonzero(np.diff(cuts))
        for some in np.array_split(full, max(1, len(full) // 256)):
            rows = [packed([raw[i] for i in listed[s:e]], size[s:e], at[first[s] : first[e]], times[first[s] : first[e]]) for s, e in zip(cuts[some], cuts[some + 1])]
            none = pa.nulls(len(some), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), name)), pa.array(some.astype(np.int32)), pa.array(rows, pa.binary()), none, none, none], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 24
        ids, sizes, texts, chars = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids.append(doc)
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                texts.append(text)
                chars += len(text)
                if chars > BLOCK_CHARS or len(ids) == BLOCK_DOCS:
                    yield from block(name, ids, sizes, texts)
                    name, ids, sizes, texts, chars = name + 1, [], [], [], 0
        if ids:
            yield from block(name, ids, sizes, texts)

    return small_batches(docs).mapInArrow(run, "block long, bucket int, lists binary, ids array<long>, sizes array<long>, counts array<long>")


def token_counts(docs: DataFrame, limit: int = 512, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row of ``docs``.

    Counts are those of the tokenizers library for the whole text (null: empty)
    without begin, end or added special tokens; special strings inside texts
    count as the library has them.  ``over_limit`` is n_tokens > ``limit``.
    Null and repeated ids keep their rows; an empty table gives none; other
    columns are ignored.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    buckets = max(BUCKETS, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt_lists(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), path, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block: sums by document of all of a block's lists that this task has."""
        known: dict[bytes, int] = {}
        block, places, sums = None, [], []

        def summed() -> pa.RecordBatch:
            place, where = np.unique(np.concatenate(places), return_inverse=True)
            total = np.bincount(where, np.concatenate(sums)).astype("<u4")
            none = pa.nulls(1, pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([place.astype("<u2").tobytes()]), pa.array([total.tobytes()]), none, none, none], ["block", "at", "sums", "ids", "sizes", "counts"])

        for batch in batches:
            heads = batch.filter(batch["lists"].is_null())
            if heads.num_rows:
                none = pa.nulls(heads.num_rows, pa.binary())
                yield pa.RecordBatch.from_arrays([heads["block"], none, none, heads["ids"], heads["sizes"], heads["counts"]], ["block", "at", "sums", "ids", "sizes", "counts"])
            for name, lists in zip(batch["block"].to_pylist(), batch["lists"]):
                if not lists.is_valid:
                    continue
                if name != block and places:
                    yield summed()
                    places, sums = [], []
                block = name
                texts, sizes, at, times = unpacked(lists.as_py())
                for t in texts:
                    if t not in known:
                        known[t] = len(encoder(path).ids(t.decode()))
                places.append(at)
                sums.append(np.repeat(np.fromiter(map(known.__getitem__, texts), np.int64, len(texts)), sizes) * times)
        if places:
            yield summed()

    counted = dealt.repartition("bucket").sortWithinPartitions("block").mapInArrow(count, "block long, at binary, sums binary, ids array<long>, sizes array<long>, counts array<long>")

    def total(rows: pa.Table) -> pa.Table:
        head = rows.filter(rows["ids"].is_valid()).combine_chunks()
        n = head["counts"].chunk(0).flatten().to_numpy().copy()
        for at, s in zip(rows["at"], rows["sums"]):
            if at.is_valid:
                n[np.frombuffer(at.as_py(), "<u2")] += np.frombuffer(s.as_py(), "<u4")  # each place once in a row
        return pa.table([head["ids"].chunk(0).flatten(), head["sizes"].chunk(0).flatten(), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return counted.groupBy("block").applyInArrow(total, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
