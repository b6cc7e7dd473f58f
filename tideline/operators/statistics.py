"""Statistics of many columns from one pass over the rows, mergeable over splits.

The pass counts the distinct values of every column, with a count for each split.
Those counts are a small table that answers for any union of splits without
another look at the rows: nulls, sums, exact medians, means and deviations of
imputed columns, and the sorted levels of categories.  Medians are selected in
the counts' order: range partitions by (column, value), offsets by partition, and a
running sum only in the few partitions that hold a middle rank.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import real
from tideline.sources.scratch import keep

#: Stands for a missing category.
MISSING = "__MISSING__"
#: Levels of one category column beyond which learning is refused: they are parameters that the driver holds.
MOST_LEVELS = 100_000


def prepared(name: str) -> Column:
    """A raw numeric or boolean column as a double without NaN (PRJ-11)."""
    return real(F.col(f"`{name}`").cast("double"))


def category(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(MISSING))


@dataclass
class Summary:
    """What one set of rows says: by numeric column its nulls, fill, and mean and population
    deviation once filled; by category column its sorted levels."""

    rows: int = 0
    nulls: dict[str, int] = field(default_factory=dict)
    fill: dict[str, float | None] = field(default_factory=dict)
    mean: dict[str, float] = field(default_factory=dict)
    deviation: dict[str, float] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)


@dataclass
class Counts:
    """(col, value, level, n_0, n_1, ...): how often each split of ``splits`` holds each value
    of each column; numeric columns stand before category columns in ``col``."""

    table: DataFrame
    numeric: list[str]
    categorical: list[str]
    splits: list[str]

    def times(self, names: list[str]) -> Column:
        """How often a value stands in the union of some splits."""
        return sum((F.col(f"n_{self.splits.index(s)}") for s in names), F.lit(0).cast("long"))


def value_counts(rows: DataFrame, numeric: list[str], categorical: list[str], split: str | None = None, splits: list[str] = ["all"]) -> Counts:
    """Count every column's values in one pass (AG-19 to AG-21, ML-01 to ML-04).

    Tasks combine equal values before anything is shuffled.  Rows of no listed
    split are left out; without ``split`` all rows are those of the only one.
    """
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cell = lambda i, v, t: F.struct(F.lit(i).alias("col"), v.alias("value"), t.alias("level"))
    cells = [*(cell(i, prepared(c), text) for i, c in enumerate(numeric)), *(cell(i, none, category(c)) for i, c in enumerate(categorical, len(numeric))), cell(len(numeric) + len(categorical), none, text)]
    of = F.col(split) if split else F.lit(splits[0])
    held = rows.where(of.isin(splits)).select(of.alias("_split"), F.explode(F.array(*cells)).alias("_cell"))
    counted = held.groupBy("_cell.col", "_cell.value", "_cell.level").agg(*[F.count_if(F.col("_split") == s).alias(f"n_{k}") for k, s in enumerate(splits)])
    return Counts(keep(counted), numeric, categorical, splits)


def middle_values(counts: Counts, sets: list[list[str]], parts: int | None = None) -> dict[tuple[int, int], float | None]:
    """The exact median of each numeric column in each union of splits, by (set, column)."""
    spark = counts.table.sparkSession
    n = [F.col(f"m_{k}") for k in range(len(sets))]
    known = counts.table.where(f"value is not null and col < {len(counts.numeric)}").select("col", "value", *[counts.times(s).alias(f"m_{k}") for k, s in enumerate(sets)])
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = keep(known.repartitionByRange(parts, "col", "value").withColumn("part", F.spark_partition_id()))
    # One row for each column and partition: what stands before it, and the column's total.
    of_col = Window.partitionBy("col")
    before = of_col.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("col", "part").agg(*[F.sum(x).alias(f"m_{k}") for k, x in enumerate(n)])
    placed = sums.select("col", "part", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"b_{k}") for k, x in enumerate(n)], *[F.sum(x).over(of_col).alias(f"t_{k}") for k, x in enumerate(n)], *n)
    low, high = (lambda k: F.floor((F.col(f"t_{k}") - 1) / 2)), (lambda k: F.floor(F.col(f"t_{k}") / 2))
    holds = lambda k, rank, start, size: (rank(k) >= start) & (rank(k) < start + size) & (F.col(f"t_{k}") > 0)
    middle = F.lit(False)
    for k, x in enumerate(n):
        middle |= holds(k, low, F.col(f"b_{k}"), x) | holds(k, high, F.col(f"b_{k}"), x)
    wanted = placed.where(middle).drop(*[f"m_{k}" for k in range(len(sets))])  # two for each set and column at most
    inside = Window.partitionBy("col", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    near = ranged.join(F.broadcast(wanted), ["col", "part"])
    start = [F.col(f"b_{k}") + F.coalesce(F.sum(x).over(inside), F.lit(0)) for k, x in enumerate(n)]
    ranked = near.select("*", *[s.alias(f"s_{k}") for k, s in enumerate(start)])
    picks = [F.max(F.when(holds(k, rank, F.col(f"s_{k}"), x), F.col("value"))).alias(f"{name}_{k}") for k, x in enumerate(n) for name, rank in (("low", low), ("high", high))]
    found = {r["col"]: r for r in ranked.groupBy("col").agg(*picks).collect()}
    pick = lambda k, i: None if i not in found or found[i][f"low_{k}"] is None else found[i][f"low_{k}"] + (found[i][f"high_{k}"] - found[i][f"low_{k}"]) / 2
    return {(k, i): pick(k, i) for k in range(len(sets)) for i in range(len(counts.numeric))}


def summaries(counts: Counts, sets: list[list[str]], imputation: str = "median") -> list[Summary]:
    """A summary of each union of splits.

    A column without any value is filled with 0.  Deviations are taken around the
    fill, so no large squares cancel.  What reaches the driver are a few numbers for
    each column and set, and the levels of the category columns.
    """
    numeric, last = counts.numeric, len(counts.numeric) + len(counts.categorical)
    n = [counts.times(s) for s in sets]
    table = counts.table
    totals = {r["col"]: r for r in table.groupBy("col").agg(*[f(x).alias(f"{name}_{k}") for k, x in enumerate(n) for name, f in (
        ("rows", F.sum), ("nulls", lambda x: F.sum(F.when(F.col("value").isNull(), x).otherwise(0))), ("sum", lambda x: F.sum(F.when(x > 0, F.col("value") * x))), ("levels", lambda x: F.count_if((x > 0) & F.col("level").isNotNull())))]).collect()}
    many = [c for i, c in enumerate(counts.categorical, len(numeric)) if i in totals and max(totals[i][f"levels_{k}"] for k in range(len(sets))) > MOST_LEVELS]
    if many:
        raise ValueError(f"more than {MOST_LEVELS} levels: {', '.join(many)}")
    found = [Summary(rows=totals[last][f"rows_{k}"] if last in totals else 0) for k in range(len(sets))]
    middle = middle_values(counts, sets) if imputation == "median" and numeric else {}
    for k, s in enumerate(found):
        for i, c in enumerate(numeric):
            s.nulls[c] = totals[i][f"nulls_{k}"] if i in totals else 0
            there = s.rows - s.nulls[c]
            s.fill[c] = 0.0 if not there else float(middle[k, i] if middle else totals[i][f"sum_{k}"] / there)
    if numeric and any(s.rows for s in found):
        fills = F.array(*[F.array(*[F.lit(s.fill[c]) for c in numeric]) for s in found])
        away = lambda k: F.col("value") - fills[k][F.col("col")]
        moments = table.where(f"value is not null and col < {len(numeric)}").groupBy("col").agg(*[F.sum(F.when(x > 0, x * away(k) ** p)).alias(f"p{p}_{k}") for k, x in enumerate(n) for p in (1, 2)])
        moments = {r["col"]: r for r in moments.collect()}
        for k, s in enumerate(found):
            for i, c in enumerate(numeric):
                one, two = ((moments[i][f"p{p}_{k}"] or 0.0) / s.rows if i in moments and s.rows else 0.0 for p in (1, 2))
                s.mean[c], s.deviation[c] = s.fill[c] + one, max(two - one * one, 0.0) ** 0.5
                if s.deviation[c] <= 1e-14 * abs(s.mean[c]):  # a constant whose mean was rounded
                    s.deviation[c] = 0.0
    level = table.where(F.col("level").isNotNull()).select("col", "level", *[(x > 0).alias(f"in_{k}") for k, x in enumerate(n)]).collect() if counts.categorical else []
    for k, s in enumerate(found):
        s.levels = {c: sorted(r["level"] for r in level if r["col"] == i and r[f"in_{k}"]) for i, c in enumerate(counts.categorical, len(numeric))}
    return found
