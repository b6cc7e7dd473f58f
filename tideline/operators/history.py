"""Features from a row's own past, and the next value as a target.

All share one window specification, so one exchange and one sort serve them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def temporal_names(value: str = "lap_time", windows: tuple[int, ...] = (3, 5)) -> list[str]:
    """Names that :func:`add_history` gives (PRJ-17)."""
    named = [f"{value}_prev_1", f"{value}_delta_1", *[f"{value}_roll_{f}_{k}" for f in ("mean", "std", "min") for k in windows]]
    return named + [f"{value}_vs_roll_mean_5"] * (5 in windows) + [f"{value}_expanding_mean"]


def add_history(rows: DataFrame, by: list[str], order: list[str], value: str, name: str = "lap_time", windows: tuple[int, ...] = (3, 5)) -> DataFrame:
    """Previous value, difference, trailing mean, minimum and sample deviation over
    rows, distance from the 5-row mean and expanding mean (WN-02 to WN-06)."""
    w, v = Window.partitionBy(*by).orderBy(*order), F.col(value)
    trail = {k: w.rowsBetween(1 - k, 0) for k in windows}
    new = {f"{name}_prev_1": F.lag(v).over(w), f"{name}_delta_1": v - F.lag(v).over(w)}
    for k, frame in trail.items():
        new |= {f"{name}_roll_mean_{k}": F.avg(v).over(frame), f"{name}_roll_min_{k}": F.min(v).over(frame), f"{name}_roll_std_{k}": F.stddev_samp(v).over(frame)}
    if 5 in trail:
        new[f"{name}_vs_roll_mean_5"] = v - F.avg(v).over(trail[5])
    new[f"{name}_expanding_mean"] = F.avg(v).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns(new)


def add_target(rows: DataFrame, by: list[str], number: str, value: str, target: str = "next_lap_time") -> DataFrame:
    """The next row's value if its number follows directly, and ``has_target`` (WN-07)."""
    w = Window.partitionBy(*by).orderBy(number)
    follows = F.lead(number).over(w) == F.col(number) + 1
    return rows.withColumn(target, F.when(follows, F.lead(value).over(w))).withColumn("has_target", F.col(target).isNotNull())


def target_reasons(rows: DataFrame, by: list[str], number: str, value: str, target: str = "next_lap_time") -> DataFrame:
    """Why rows have no target: one row of counters (AG-24)."""
    w = Window.partitionBy(*by).orderBy(number)
    seen = rows.withColumns({"_next": F.lead(number).over(w), "_value": F.lead(value).over(w)})
    gap = F.col("_next") != F.col(number) + 1
    return seen.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("has_target").alias("with_target"), F.count_if(~F.col("has_target")).alias("without_target"),
        F.count_if(F.col("_next").isNull()).alias("last_of_group"), F.count_if(gap).alias("gap_in_numbers"),
        F.count_if(~gap & F.col("_value").isNull()).alias("next_value_null"), F.count_if(F.col(value).isNull()).alias("own_value_null"),
    )


def session_start(rows: DataFrame, session: str, at: str, name: str = "session_date") -> DataFrame:
    """Each session's earliest time on all its rows (WN-08), by a small aggregate joined back."""
    least = rows.groupBy(session).agg(F.min(at).alias(name))
    return rows.join(least, session, "left")


def order_inversions(rows: DataFrame, by: list[str], pos: str, value: str) -> DataFrame:
    """Rows whose value is below the last one before that was not null (WN-09): (by, inversions)."""
    before = F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_before", before).groupBy(*by).agg(F.count_if(F.col(value) < F.col("_before")).alias("inversions"))


def every_kth(rows: DataFrame, order: list[str], k: int, bucket: Column) -> DataFrame:
    """Every k-th row of the whole order, the first included (WN-11).

    ``bucket`` is any coarse value that does not fall along the order.  Rows are
    numbered within buckets and a small table of bucket sizes adds what stands
    before, so no task sees all rows.
    """
    dealt = rows.withColumn("_bucket", bucket)
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select("_bucket", before.alias("_before"))
    number = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order)) - 1 + F.col("_before")
    return dealt.join(offsets, "_bucket").withColumn("_number", number).where(F.col("_number") % k == 0).drop("_bucket", "_before", "_number")
