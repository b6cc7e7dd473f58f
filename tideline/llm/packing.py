"""Packing without padding: power-of-two decomposition of documents.

A document's ids are cut into pieces whose lengths are powers of two, the longest
first: as many of the longest length as fit, then one for each binary digit of
the rest.  Every piece is a sequence of its own, and sequences of one length form
a bucket from which batches are drawn; no sequence crosses documents and none
holds padding.  The work is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import small_batches
from tideline.llm.tokens import encoder, tokenizer_path

#: Bytes of text whose ids a worker holds at once.
HELD = 8_000_000


def lengths(n: int, most: int) -> list[int]:
    """``n`` as a sum of powers of two up to ``most``, in falling order."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, most: int = 2048, end_id: int = 1, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian unsigned
    32-bit, if ``with_ids``), ids_crc32, doc_tokens, sequence_id, offset, bucket.

    A document's ids are those of its whole text (null: empty) and then
    ``end_id``, so every document has a piece.  ``most`` is a power of two.
    ``bucket`` is the logarithm of the piece's length.  Null and repeated ids of
    documents are kept as they are; an empty table gives no rows; other columns
    are ignored.  sequence_id is unique and offset 0, as a piece is a sequence.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the longest length must be a power of two")
    path, end = tokenizer or tokenizer_path("byte_bpe_50k.json"), int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", *["ids"] * with_ids, "ids_crc32", "doc_tokens"]
    types = [pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids, pa.int64(), pa.int64()]

    def cut(ids: list, texts: list[str]) -> pa.RecordBatch:
        rows = []
        for doc, text in zip(ids, texts):
            coded = encoder(path).ids(text).astype("<u4", copy=False).tobytes() + end
            n, start = len(coded) // 4, 0
            for length in lengths(n, most):
                piece = coded[4 * start : 4 * (start + length)]
                rows.append((doc, start, length, *[piece] * with_ids, zlib.crc32(piece), n))
                start += length
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held > HELD:
                    yield cut(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield cut(ids, texts)

    schema = "doc_id long, start long, length long, " + "ids binary, " * with_ids + "ids_crc32 long, doc_tokens long"
    packed = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return packed.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "bucket": F.log2("length").cast("int")})
