"""A distributed LSD radix sort: stable counting-sort passes over the digits of a composite key.

Rows have places from 0, and blocks of a fixed number of places.  A pass counts the
rows of each (digit, block), takes prefix sums over digits first and blocks second,
and so knows where the rows of each (digit, block) go; within it rows keep their
order.  Passes go from the least to the most significant digit, so the last one
leaves every row at its final rank.  Only narrow rows of keys are shuffled, once a
pass, and no task meets more than a block of one digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import drop, keep


def digits(rows: DataFrame, keys: list[str], bits: int) -> list[Column]:
    """The digits of the composite key that differ among the rows, the least significant first."""
    varied = rows.agg(*[F.expr(f"bit_or({k}) ^ bit_and({k})").alias(k) for k in keys]).first()
    mask = (1 << bits) - 1
    found = []
    for k in reversed(keys):
        differ = (varied[k] or 0) & (1 << 64) - 1
        found += [F.shiftrightunsigned(k, shift).bitwiseAND(F.lit(mask)).cast("int") for shift in range(0, 64, bits) if differ >> shift & mask]
    return found or [F.shiftrightunsigned(keys[-1], 0).bitwiseAND(F.lit(mask)).cast("int")]


def radix_sorted(rows: DataFrame, keys: list[str], row_col: str = "row", bits: int = 12, block: int = 16) -> DataFrame:
    """(row, pos): the place from 0 of each row in ascending order of ``keys``, the most
    significant first.

    Keys are longs without nulls and count as unsigned.  ``row_col`` is a distinct long
    that is not negative; rows with equal keys keep its order.  ``bits`` are those of a
    digit, and 2^``block`` the places of a block.  ``rows`` is read twice; an empty
    table gives no rows.
    """
    state = keep(rows.select(F.col(row_col).alias("row"), *keys, F.col(row_col).alias("pos")))
    for digit in digits(state, keys, bits):
        placed = state.withColumns({"digit": digit, "block": F.shiftright("pos", block)})
        counts = placed.groupBy("digit", "block").agg(F.count(F.lit(1)).alias("n"))
        up_to_here = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
        totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # at most 2^bits rows
        bases = totals.select("digit", F.coalesce(F.sum("n").over(up_to_here(Window.orderBy("digit"))), F.lit(0)).alias("base"))
        ahead = F.coalesce(F.sum("n").over(up_to_here(Window.partitionBy("digit").orderBy("block"))), F.lit(0))
        starts = counts.select("digit", "block", ahead.alias("ahead")).join(F.broadcast(bases), "digit").select("digit", "block", (F.col("base") + F.col("ahead")).alias("start"))
        within = F.row_number().over(Window.partitionBy("digit", "block").orderBy("pos")) - 1
        moved = keep(placed.withColumn("within", within).join(starts, ["digit", "block"]).select("row", *keys, (F.col("start") + F.col("within")).alias("pos")))
        drop(state)
        state = moved
    return state.select("row", "pos")
