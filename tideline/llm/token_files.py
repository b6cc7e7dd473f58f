"""Token ids as flat files of unsigned integers with 64-bit document offsets.

Documents are dealt out by ranges of their id, so shards follow each other in
ascending order.  A shard is three flat little-endian files: its ids (16 bits
each if the vocabulary allows, else 32), the 64-bit offsets of its documents
within it, and their 64-bit ids.  Prefix sums over the shards give each one's
base, from which a document's place among all ids follows.  The manifest, a
small Parquet table with a row for each shard, is written last and names the
files of the task attempts that ended well: files of lost attempts are in no
manifest.  Readers map the files to memory and take any document or range.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import small_batches
from tideline.llm.tokens import encoder, tokenizer_path

#: Documents that a reading task takes at once, and bytes of ids in a batch.
SLICE, HELD = 4096, 8_000_000
SHARD = "shard int, name string, width int, n_docs long, n_null long, n_tokens long"


def write_tokens(
    docs: DataFrame, folder: str, end_id: int = 2, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None
) -> DataFrame:
    """Write the token files of ``docs`` below ``folder``, a new folder that all
    executors reach, and return the manifest: shard, name, width (bytes of an id),
    n_docs, n_null (leading documents without an id), n_tokens, base_docs, base.

    A document's ids are those of its whole text (null: empty) by the tokenizers
    library, without added special tokens, and then ``end_id``.  Documents stand in
    ascending order of their id, those without one first; rows that share an id
    stand in the order of a hash of their texts, and each has its own entry.
    ``shards`` is the number of ranges, by default that of shuffle partitions; ranges
    without rows have no files.  An empty table gives an empty manifest; other
    columns are ignored.
    """
    spark, path = docs.sparkSession, tokenizer or tokenizer_path("byte_bpe_50k.json")
    width = 2 if max(encoder(path).library.get_vocab_size() - 1, end_id) < 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        target, end, offsets, ids, nulls, out = None, np.array([end_id], f"<u{width}").tobytes(), [0], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                target, at = FileSystem.from_uri(folder)
                target.create_dir(at, recursive=True)
                out = target.open_output_stream(f"{at}/{name}.ids")
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                coded = encoder(path).ids(text.as_py() or "").astype(f"<u{width}", copy=False)
                out.write(coded.tobytes() + end)
                offsets.append(offsets[-1] + len(coded) + 1)
                nulls += doc is None
                ids.append(doc or 0)
        if out is None:
            return
        out.close()
        for kind, values in (("offsets", offsets), ("docs", ids)):
            with target.open_output_stream(f"{at}/{name}.{kind}") as f:
                f.write(np.array(values, "<i8").tobytes())
        row = {"shard": task.partitionId(), "name": name, "width": width, "n_docs": len(ids), "n_null": nulls, "n_tokens": offsets[-1]}
        yield pa.RecordBatch.from_pydict({"shard": pa.array([row["shard"]], pa.int32()), "name": [name], "width": pa.array([width], pa.int32()), **{k: [row[k]] for k in ("n_docs", "n_null", "n_tokens")}})

    # Ties are split by text and row: not even copies of one row have to meet in one shard.
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"), F.monotonically_increasing_id().alias("row"))
    ranges = rows.repartitionByRange(shards or int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("id").asc_nulls_first(), "tie", "row")
    written = ranges.sortWithinPartitions(F.col("id").asc_nulls_first(), "tie", "row").select("id", "text").mapInArrow(run, SHARD)
    written.write.parquet(f"{folder}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    base = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    spark.read.schema(SHARD).parquet(f"{folder}/shards").withColumns({"base_docs": base("n_docs"), "base": base("n_tokens")}).coalesce(1).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{SHARD}, base_docs long, base long").parquet(f"{folder}/manifest")


def part(uri: str, kind: str, start: int, end: int) -> np.ndarray:
    """Entries ``start`` to ``end`` of a flat file: mapped to memory where it is local, else read by range."""
    files, path = FileSystem.from_uri(uri)
    size = np.dtype(kind).itemsize
    if isinstance(files, LocalFileSystem):
        return np.memmap(path, kind, "r", start * size, (end - start,))
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read_at((end - start) * size, start * size), kind)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32), one row for each document of the token
    files below ``folder``: ``start`` counts the ids of all documents before it, ``ids``
    are little-endian unsigned 32-bit integers, if ``with_ids``, and ids_crc32 their crc32."""
    names = ["doc_id", "start", "n_tokens", *["ids"] * with_ids, "ids_crc32"]
    types = [pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids, pa.int64()]
    made = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                first, last = s["first"], min(s["first"] + SLICE, s["n_docs"])
                docs = part(f"{folder}/{s['name']}.docs", "<i8", first, last)
                offsets = part(f"{folder}/{s['name']}.offsets", "<i8", first, last + 1).astype(np.int64)
                ids = part(f"{folder}/{s['name']}.ids", f"<u{s['width']}", int(offsets[0]), int(offsets[-1]))
                rows, held = [], 0
                for i, (doc, start, end) in enumerate(zip(docs.tolist(), offsets[:-1].tolist(), offsets[1:].tolist()), first):
                    coded = ids[start - offsets[0] : end - offsets[0]].astype("<u4").tobytes()
                    rows.append((doc if i >= s["n_null"] else None, s["base"] + start, end - start, *[coded] * with_ids, zlib.crc32(coded)))
                    held += len(coded)
                    if held > HELD:
                        yield made(rows)
                        rows, held = [], 0
                if rows:
                    yield made(rows)

    slices = manifest(spark, folder).select("name", "width", "n_docs", "n_null", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(SLICE).cast("long"))).alias("first"))
    dealt = slices.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, " + "ids binary, " * with_ids + "ids_crc32 long")
