"""Alignment of time-stamped rows: windows from successive starts, and backward
as-of joins as one exchange, one sort and one window function.

An as-of join unites both sides, tags them, and takes the last tagged value up to
each row.  No pair of rows is ever made, so its cost does not depend on how many
rows of one side fall between two of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import plus_seconds, seconds_between


def interval_windows(rows: DataFrame, by: list[str], order: list[str], start: str, duration: str, prefix: str = "window") -> DataFrame:
    """Half-open windows that tile each group's time (WN-01).

    Adds ``<prefix>_end``, the next row's start or else start + duration seconds,
    ``is_last`` (there is no next start) and ``has_complete_window``.  Rows whose
    start is null keep their place in the order, so the row before one is last.
    """
    following = F.lead(start).over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_next", following).withColumns(
        {f"{prefix}_end": F.coalesce("_next", plus_seconds(F.col(start), F.col(duration))), "is_last": F.col("_next").isNull()}
    ).withColumn("has_complete_window", F.col(start).isNotNull() & F.col(f"{prefix}_end").isNotNull()).drop("_next")


def _united(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, tie: list[str]) -> DataFrame:
    """Rows of both sides as (by, t, side, tie, l, r); those of the right come first at equal t."""
    ties = lambda df: F.struct(*[F.col(c) for c in tie]) if tie else F.struct(F.lit(0))
    r = right.where(F.col(right_on).isNotNull())
    for key in by:
        r = r.where(F.col(key).isNotNull())
    a = left.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col(left_on).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"))
    b = r.select(*[F.col(b).alias(f"_by_{b}") for b in by], F.col(right_on).alias("_t"), F.lit(0).alias("_side"), ties(r).alias("_tie"), F.struct(*right.columns).alias("_r"))
    return b.unionByName(a, allowMissingColumns=True)


def asof_last(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str] | None = None, tie: list[str] | None = None,
    into: str = "match", bucket: str | None = None,
) -> DataFrame:
    """``left`` with a struct ``into``: the last row of ``right`` whose ``right_on`` is
    not after ``left_on``, among those with equal ``by`` (JN-02, JN-04).

    Of rows of ``right`` at one point the last by ``tie`` counts.  Rows of
    ``right`` with a null point or key never match; rows of ``left`` with one get
    null.  Every row of ``left`` is kept once.

    Without ``by``, or where one key may hold much of the data, ``bucket`` (a unit
    of ``date_trunc``, or a number for numeric points) cuts each key's line into
    stretches that are aligned on their own; what stands before the first match of
    a stretch is taken from a small table with the last row of each stretch.
    """
    by, tie = by or [], tie or []
    both = _united(left, right, by, left_on, right_on, tie)
    keys = [f"_by_{b}" for b in by]
    so_far = lambda parts: Window.partitionBy(*parts).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    if bucket is None:
        found = both.withColumn(into, F.last("_r", ignorenulls=True).over(so_far(keys)))
    else:
        cut = F.floor(F.col("_t") / F.lit(float(bucket))) if bucket.replace(".", "").isdigit() else F.date_trunc(bucket, "_t")
        both = both.withColumn("_cut", cut)
        ends = both.where("_side = 0").groupBy(*keys, "_cut").agg(F.max_by("_r", F.struct("_t", "_tie")).alias("_end"))
        stretches = both.where("_side = 1").select(*keys, "_cut").distinct().join(ends, [*keys, "_cut"], "full")
        before = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
        carried = stretches.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).select(*keys, "_cut", "_carried")
        own = both.withColumn("_own", F.last("_r", ignorenulls=True).over(so_far([*keys, "_cut"])))
        same = F.lit(True)
        for key in [*keys, "_cut"]:
            same &= own[key].eqNullSafe(carried[key])
        found = own.where("_side = 1").join(carried, same, "left").select(own["_l"], own["_t"], own["_side"], *[own[k] for k in keys], F.coalesce("_own", "_carried").alias(into))
    valid = F.col("_t").isNotNull()
    for key in keys:
        valid &= F.col(key).isNotNull()
    return found.where("_side = 1").select("_l.*", F.when(valid, F.col(into)).alias(into))


def asof_within(left: DataFrame, right: DataFrame, left_on: str, right_on: str, tolerance_seconds: float, by: list[str] | None = None, tie: list[str] | None = None, into: str = "match", age: str = "age_s", bucket: str | None = None) -> DataFrame:
    """:func:`asof_last` for matches no older than the tolerance, itself included,
    with their ``age`` in seconds (JN-03); older ones leave both null."""
    found = asof_last(left, right, left_on, right_on, by, tie, into, bucket)
    old = seconds_between(F.col(left_on), F.col(f"{into}.{right_on}"))
    return found.withColumn(age, F.when(old <= tolerance_seconds, old)).withColumn(into, F.when(F.col(age).isNotNull(), F.col(into)))


def assign_to_windows(
    records: DataFrame, windows: DataFrame, at: str, start: str, end: str, by: list[str], carry: list[str], tie: list[str] | None = None, complete: Column | None = None
) -> DataFrame:
    """Records inside a window, with the window's ``carry`` columns (JN-01).

    A record belongs to the window with the last start not after it, if it is
    before that window's end; others are dropped, as are records with a null
    point.  ``complete`` tells which windows may receive records.
    """
    usable = windows.where(complete if complete is not None else F.col(start).isNotNull() & F.col(end).isNotNull())
    usable = usable.select(*dict.fromkeys([*by, start, end, *carry, *(tie or [])]))
    found = asof_last(records.where(F.col(at).isNotNull()), usable, at, start, by, tie or [], "_window")
    names = [c for c in carry if c not in records.columns]
    return found.where(F.col(at) < F.col(f"_window.{end}")).select(*records.columns, *[F.col(f"_window.{c}").alias(c) for c in names])


def range_confirmed(left: DataFrame, ranges: DataFrame, on: str, low: str, high: str, by: list[str], tie: list[str] | None = None, into: str = "range") -> DataFrame:
    """The last range that begins at or before an integer key, null if the key is past its end (JN-04)."""
    found = asof_last(left, ranges, on, low, by, tie or [low], into)
    return found.withColumn(into, F.when(F.col(f"{into}.{high}").isNull() | (F.col(on) <= F.col(f"{into}.{high}")), F.col(into)))
