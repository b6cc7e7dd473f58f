"""Reduction of event rows to one row per group, and lookups back onto a grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_record(rows: DataFrame, by: list[str], order: list[str], values: list[str], count: str | None = None) -> DataFrame:
    """The values of each group's last row, all from that row, nulls kept (AG-02);
    ``count`` names a column for the group's size (AG-03)."""
    whole = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    size = [F.count(F.lit(1)).alias(count)] if count else []
    return rows.groupBy(*by).agg(whole, *size).select(*by, "_last.*", *[c for c in [count] if c])


def first_known(rows: DataFrame, by: list[str], order: list[str], values: list[str]) -> DataFrame:
    """For each value the first in order that is not null (AG-04)."""
    first = lambda v: F.min_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct(*order))).alias(v)
    return rows.groupBy(*by).agg(*[first(v) for v in values])


def first_row(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first whole row of each group (ST-04); rows with a null key are dropped."""
    return rows.na.drop(subset=by).groupBy(*by).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")).select("_row.*")


def lookup(left: DataFrame, right: DataFrame, on: list[str], order: list[str], values: list[str]) -> DataFrame:
    """``left`` with the values of the first row of ``right`` for its key (JN-06)."""
    return left.join(first_row(right, on, order).select(*on, *values), on, "left")


def count_onto(left: DataFrame, events: DataFrame, on: list[str], name: str) -> DataFrame:
    """``left`` with the number of events of its key, 0 for none (JN-07)."""
    counts = events.na.drop(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias(name))
    return left.join(counts, on, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def merge_on_grain(left: DataFrame, right: DataFrame, grain: list[str]) -> DataFrame:
    """A left join that keeps the number of rows, as ``right`` has one for each grain (JN-05)."""
    return left.join(right, grain, "left")


def surplus(rows: DataFrame, grain: list[str]) -> DataFrame:
    """(groups, surplus): keys that repeat, and the rows beyond the first of each (AG-06, AG-11)."""
    sizes = rows.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return sizes.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"))


def examples(rows: DataFrame, by: list[str], order: str, value: str, n: int = 5) -> DataFrame:
    """(by, pos, value): the first ``n`` values of each group in order (SO-03, SO-04, AG-14)."""
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy(*by).orderBy(order))).where(F.col("pos") <= n).select(*by, "pos", value)


def coverage(expected: DataFrame, axis: DataFrame, present: DataFrame, reasons: DataFrame | None = None) -> DataFrame:
    """Combinations of two small axes that are absent, with the first reason known for each (JN-12, JN-14)."""
    on = expected.columns + axis.columns
    absent = expected.crossJoin(F.broadcast(axis)).join(present.select(*on).distinct(), on, "left_anti")
    return absent if reasons is None else absent.join(reasons, on, "left")


def null_shares(rows: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """(column, nulls, share) for each column in one pass (AG-13)."""
    counted = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counted.unpivot(["_n"], columns, "column", "nulls")
    return long.select("column", "nulls", F.round(F.col("nulls") / F.col("_n"), digits).alias("share"))


def masked(value: Column, allowed: Column) -> Column:
    """The value where it is allowed, else null: the row stays (FLT-05)."""
    return F.when(allowed, value)
