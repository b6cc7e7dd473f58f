"""Typed frames of records and scans of stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.scalars import instant, number
from tideline.operators.quality import kind

#: Columns of each kind of record as the lap table reads them: number, instant, text, flag or gap.
COLUMNS = {
    "laps": [
        ("driver_number", "number"),
        ("lap_number", "number"),
        ("lap_duration", "number"),
        ("duration_sector_1", "number"),
        ("duration_sector_2", "number"),
        ("duration_sector_3", "number"),
        ("i1_speed", "number"),
        ("i2_speed", "number"),
        ("st_speed", "number"),
        ("date_start", "instant"),
        ("is_pit_out_lap", "flag"),
    ],
    "drivers": [
        ("driver_number", "number"),
        ("team_name", "text"),
        ("name_acronym", "text"),
    ],
    "stints": [
        ("driver_number", "number"),
        ("stint_number", "number"),
        ("lap_start", "number"),
        ("lap_end", "number"),
        ("tyre_age_at_start", "number"),
        ("compound", "text"),
    ],
    "pit": [
        ("driver_number", "number"),
        ("lap_number", "number"),
        ("pit_duration", "number"),
        ("lane_duration", "number"),
    ],
    "position": [
        ("driver_number", "number"),
        ("position", "number"),
        ("date", "instant"),
    ],
    "intervals": [
        ("driver_number", "number"),
        ("date", "instant"),
        ("gap_to_leader", "gap"),
        ("interval", "gap"),
    ],
    "weather": [
        ("air_temperature", "number"),
        ("track_temperature", "number"),
        ("humidity", "number"),
        ("pressure", "number"),
        ("rainfall", "number"),
        ("wind_speed", "number"),
        ("wind_direction", "number"),
        ("date", "instant"),
    ],
    "race_control": [
        ("driver_number", "number"),
        ("lap_number", "number"),
        ("date", "instant"),
    ],
    "car_data": [
        ("driver_number", "number"),
        ("speed", "number"),
        ("rpm", "number"),
        ("n_gear", "number"),
        ("throttle", "number"),
        ("brake", "number"),
        ("drs", "number"),
        ("date", "instant"),
    ],
}


def field(name: str, what: str) -> Column:
    """A field of ``rec``; absent, null and unreadable values are null.  Booleans count as 1 and 0, numeric text as its number."""
    v = F.try_variant_get("rec", f"$.{name}", "variant")
    text = F.try_variant_get("rec", f"$.{name}", "string")
    if what in ("number", "gap"):
        k = kind(v)
        return F.when(k.isin("int", "float"), F.try_variant_get("rec", f"$.{name}", "double")).when(k == "bool", (text == "true").cast("double")).when(k == "str", number(text))
    if what == "instant":
        return F.when(kind(v) == "str", instant(text))
    return F.try_variant_get("rec", f"$.{name}", "boolean" if what == "flag" else "string")


def typed(records: DataFrame, endpoint: str) -> DataFrame:
    """Records of one kind as columns, with session_key (the record's, else the path's) and pos (PRJ-01 to PRJ-03, PRJ-07)."""
    cols = {"session_key": F.coalesce(F.try_variant_get("rec", "$.session_key", "long"), F.col("session_key"))}
    if endpoint == "laps":
        cols |= {"meeting_key": F.coalesce(F.try_variant_get("rec", "$.meeting_key", "long"), F.col("meeting_key")), "year": F.col("year").cast("long")}
    for n, what in COLUMNS[endpoint]:
        cols[n] = field(n, what)
        if what == "gap":
            cols[f"{n}_is_text"] = F.coalesce(kind(F.try_variant_get("rec", f"$.{n}", "variant")) == "str", F.lit(False))
    pos = F.struct("file", "pos").alias("pos")
    return records.where((F.col("endpoint") == endpoint) & F.schema_of_variant("rec").startswith("OBJECT")).select(*[c.alias(n) for n, c in cols.items()], pos)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files below a path, without columns taken from folder names (SRC-09)."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def sessions_of(table: DataFrame, years: list[int] | None = None, session_keys: list[int] | None = None) -> DataFrame:
    """A stored table restricted to seasons and sessions (SRC-10, FLT-06)."""
    if years:
        table = table.where(F.col("year").isin(years))
    return table.where(F.col("session_key").isin(session_keys)) if session_keys else table


def training_rows(features: DataFrame, target: str = "next_lap_time", years: list[int] | None = None, session_keys: list[int] | None = None) -> DataFrame:
    """Feature rows with a usable target (SRC-11, FLT-08)."""
    return sessions_of(features, years, session_keys).where(F.col("has_target") & F.col(target).isNotNull())


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256, length) of the files below a path (AG-26, ML-10); bytes stay on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), F.sha2("content", 256).alias("sha256"), "length")


def content_digest(table: DataFrame) -> str:
    """A digest of a table's rows that depends neither on their order nor on files.

    Digests of rows are summed in four parts modulo 2**61 - 1, so it is one aggregate.
    """
    row = F.sha2(F.to_json(F.struct(*sorted(table.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.sum(F.pmod(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)"), F.lit(2**61 - 1).cast("decimal(38,0)"))).alias(f"p{i}")
    sums = table.select(row.alias("h")).agg(F.count(F.lit(1)).alias("n"), *[part(i) for i in range(4)]).first()
    return "-".join(f"{int(x or 0):x}" for x in sums)
