"""Mixing sources to target weights by pivotal dependent rounding.

A source that is to give r times its words takes every document floor(r) times,
and one more time with probability r - floor(r).  Those probabilities are rounded
in pairs: words move at random from one document of a pair to the other until
one of the two probabilities is 0 or 1; the expected copies of each document and
the source's expected words stay exact.  The one that is still fractional meets
the next.  Blocks of a source are rounded independently and each leaves at most
one fractional document; these residuals meet in the next level of a reduction
tree, until one is left for each source.  That last one has no partner: the mix
takes the matching part of its words, so a source meets its target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import WORD, by_key, keep, whole_groups

#: Documents whose probabilities are rounded together.
BLOCK = 4096
SCHEMA = "row long, source string, size long, r double, p double, h long, place long"


def targets(sizes: DataFrame, weights: list[float], most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn and share all
    words; a target stops at ``most`` times its source's size and the excess is
    shared again by weight until none is above.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("cap") / F.col("weight"))
    # Sources reach their caps in the order of cap / weight; a source is capped if the level
    # that the words left after those before it would give exceeds its own ratio.
    every = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    filled = ranked.withColumn("level", left / weight_left).withColumn("capped", F.col("level") >= F.col("ratio"))
    level = F.coalesce(F.min(F.when(~F.col("capped"), F.struct("ratio", "level"))).over(every)["level"], F.lit(0.0))
    return filled.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight")).alias("target"))


def uniform(a: int, b: int) -> float:
    """A number in [0, 1) that depends on the two documents only."""
    x = (int(a) * 0x9E3779B97F4A7C15 + int(b) * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & (1 << 64) - 1
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x = (x ^ x >> 32) * 0x94D049BB133111EB & (1 << 64) - 1
    return ((x ^ x >> 30) >> 11) / (1 << 53)


def settle(size: np.ndarray, p: np.ndarray, h: np.ndarray, tiny: float = 1e-12) -> np.ndarray:
    """Round the probabilities of one block; at most one stays fractional."""
    p, held = p.copy(), -1
    for i in np.flatnonzero((p > tiny) & (p < 1 - tiny)):
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min((1 - p[a]) * size[a], p[b] * size[b])  # words from b to a
        down = min(p[a] * size[a], (1 - p[b]) * size[b])  # words from a to b
        move = up if uniform(h[a], h[b]) * (up + down) < down else -down
        p[a] += move / size[a]
        p[b] -= move / size[b]
        for x in (a, b):
            p[x] = 0.0 if p[x] < tiny else 1.0 if p[x] > 1 - tiny else p[x]
        open_ = [x for x in (a, b) if 0 < p[x] < 1]
        held = open_[0] if open_ else -1
    return p


def _round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches):
        key, h = table["key"].to_numpy(), table["h"].to_numpy()
        size, p, row = table["size"].to_numpy(), table["p"].to_numpy(), table["row"].to_numpy()
        out = np.empty(len(p))
        order = np.lexsort((row, h, key))
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        for s, e in zip(cuts, cuts[1:]):
            at = order[s:e]
            out[at] = settle(size[at].astype(float), p[at], h[at])
        yield pa.RecordBatch.from_arrays([*(table[c].combine_chunks() for c in ("row", "source", "size", "r")), pa.array(out), table["h"].combine_chunks(), table["place"].combine_chunks()], ["row", "source", "size", "r", "p", "h", "place"])


def mix(
    docs: DataFrame, weights: list[float] = [5, 2, 1], most: float = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copies, taken), one row for each row of ``docs``.

    Size is the number of runs of anything but ASCII white space; null texts and
    texts without words have size 0 and are not taken.  ``copies`` is how often
    the mix takes the document, with a fraction for the one last document of a
    source; ``taken`` counts its words, at most ceil of ``most`` times the size.
    A null source is a source.  Reruns over equal rows agree: chance and blocks come from
    hashes of id and text; rows without an id are dealt to blocks by their place in the
    table as well, so copies of one text do not meet in one block, and may swap roles.  ``row`` is ``row_col``, distinct
    longs, or else numbered here.  An empty table gives no rows.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = keep(docs.select((F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), F.xxhash64(text_col).alias("text_hash")))
    sources = keep(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    planned = rows.join(F.broadcast(sources) if sources.count() <= 100_000 else sources, rows["source"].eqNullSafe(sources["source"])).select("row", "doc_id", rows["source"], "size", "source_size", "target", ratio.alias("r"), "text_hash")
    h = F.xxhash64(F.col("doc_id").cast("string"), F.col("size"), "text_hash", F.lit(17))
    start = planned.select("row", "source", "size", "r", F.when(F.col("size") > 0, F.col("r") - F.floor("r")).otherwise(0.0).alias("p"), h.alias("h"), F.when(F.col("doc_id").isNull(), F.col("row")).alias("place"))
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    open_, done = start.where(fractional), [start.where(~fractional)]
    blocks = max(1, -(-(open_.groupBy("source").count().agg(F.max("count")).first()[0] or 0) // BLOCK))
    while True:
        level = len(done)
        # Copies without an id share a hash: their places deal them out to blocks, the hash alone decides by chance.
        dealt = open_.withColumn("key", F.xxhash64("source", F.col("source").isNull(), F.pmod(F.xxhash64("h", "place", F.lit(level)), F.lit(blocks))))
        rounded = keep(by_key(dealt).mapInArrow(_round, SCHEMA))
        if blocks == 1:
            done.append(rounded)
            break
        done.append(rounded.where(~fractional))
        open_ = rounded.where(fractional)
        blocks = -(-blocks // BLOCK)
    decided = done[0]
    for part in done[1:]:
        decided = decided.unionByName(part)
    copies = F.floor("r") + F.col("p")
    result = planned.drop("r", "text_hash").join(decided.select("row", copies.alias("copies")), "row")
    return result.select("row", "doc_id", "source", "size", "source_size", "target", "copies", F.round(F.col("size") * F.col("copies")).cast("long").alias("taken"))
