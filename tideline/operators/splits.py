"""Chronological splits by whole sessions: only the small calendar is ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = ["train", "validation", "test"]


def calendar(rows: DataFrame, session: str, at: str, year: str) -> DataFrame:
    """(session, year, session_date, rows, place): one row a session, places from 0 in time (AG-08, WN-12)."""
    sessions = rows.groupBy(session).agg(F.min(year).alias("year"), F.min(at).alias("session_date"), F.count(F.lit(1)).alias("rows"))
    in_time = Window.orderBy(F.col("session_date").asc_nulls_last(), session)
    return sessions.withColumn("place", F.row_number().over(in_time) - 1)


def by_fraction(sessions: DataFrame, train: float = 0.6, validation: float = 0.2) -> DataFrame:
    """Cut the calendar at rounded shares, halves to even; training has a session at least (SP-01)."""
    n = F.count(F.lit(1)).over(Window.partitionBy())
    first = F.greatest(F.lit(1), F.bround(n * F.lit(train)))
    second = first + F.bround(n * F.lit(validation))
    return sessions.withColumn("split", F.when(F.col("place") < first, "train").when(F.col("place") < second, "validation").otherwise("test"))


def by_years(sessions: DataFrame, train: list[int], validation: list[int], test: list[int]) -> DataFrame:
    """Whole seasons; a season in two lists is an error, and so is a session in none (SP-02)."""
    given = [*train, *validation, *test]
    if len(given) != len(set(given)):
        raise ValueError("a season stands in two splits")
    inside = lambda years: F.col("year").isin(years) if years else F.lit(False)
    lost = F.raise_error(F.concat(F.lit("no split for season "), F.coalesce(F.col("year").cast("string"), F.lit("null"))))
    return sessions.withColumn("split", F.when(inside(train), "train").when(inside(validation), "validation").when(inside(test), "test").otherwise(lost.cast("string")))


def train_years_then_split(sessions: DataFrame, train: list[int], validation_share: float = 0.5) -> DataFrame:
    """Given seasons train; of the rest, in time, the first ceil(n x share) validate (SP-03)."""
    in_train = F.coalesce(F.col("year").isin(train), F.lit(False)) if train else F.lit(False)
    rest = Window.partitionBy("_train")
    place = F.row_number().over(rest.orderBy("place")) - 1
    cut = F.ceil(F.count(F.lit(1)).over(rest) * F.lit(validation_share))
    split = F.when(F.col("_train"), "train").when(place < cut, "validation").otherwise("test")
    return sessions.withColumn("_train", in_train).withColumn("split", split).drop("_train")


def assign(rows: DataFrame, sessions: DataFrame, session: str) -> DataFrame:
    """Rows with their session's split (JN-13)."""
    return rows.join(sessions.select(session, "split"), session)


def describe(sessions: DataFrame) -> DataFrame:
    """(split, sessions, rows, first, last, years) (AG-18)."""
    return sessions.groupBy("split").agg(F.count(F.lit(1)).alias("sessions"), F.sum("rows").alias("rows"), F.min("session_date").alias("first"), F.max("session_date").alias("last"), F.count_distinct("year").alias("years"))


def chronology(sessions: DataFrame) -> DataFrame:
    """(earlier, later, last_earlier, first_later, ordered) for adjacent splits (AG-23, G6-7)."""
    rank = F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split"))
    bounds = sessions.groupBy("split").agg(F.min("session_date").alias("lo"), F.max("session_date").alias("hi")).withColumn("rank", rank)
    w = Window.orderBy("rank")
    pairs = bounds.select(F.col("split").alias("earlier"), F.lead("split").over(w).alias("later"), F.col("hi").alias("last_earlier"), F.lead("lo").over(w).alias("first_later"))
    return pairs.where("later is not null").withColumn("ordered", F.col("last_earlier") < F.col("first_later"))


def thin(sessions: DataFrame, least: int = 3) -> DataFrame:
    """Splits with fewer sessions than ``least`` (SP-04)."""
    return sessions.groupBy("split").agg(F.count(F.lit(1)).alias("sessions")).where(F.col("sessions") < least)
