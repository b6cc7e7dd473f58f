"""Consolidation: nine kinds of records reduced to one row a session, driver and lap.

Every source is reduced to the lap grain before it is joined, so each join is a
left equality join on the grain that keeps the number of rows.  All sessions are
one plan; the exchange on (session, driver) serves windows and as-of joins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import real, whole
from tideline.operators import align, reduce
from tideline.operators.specs import BRAKE_MOST, DRS_OPEN, GEAR_MOST, THROTTLE_MOST

GRAIN = ["session_key", "driver_number", "lap_number"]
DRIVER = GRAIN[:2]
#: The fields of weather that a lap carries.
WEATHER = [
    "air_temperature",
    "track_temperature",
    "humidity",
    "pressure",
    "rainfall",
    "wind_speed",
    "wind_direction",
]
#: The table's columns and their types, in the order of the contract.
TYPED = [
    ("year", "bigint"),
    ("meeting_key", "bigint"),
    ("session_key", "bigint"),
    ("driver_number", "bigint"),
    ("lap_number", "bigint"),
    ("team_name", "string"),
    ("driver_acronym", "string"),
    ("lap_start_time", "timestamp"),
    ("lap_end_time", "timestamp"),
    ("lap_duration", "double"),
    ("duration_sector_1", "double"),
    ("duration_sector_2", "double"),
    ("duration_sector_3", "double"),
    ("i1_speed", "bigint"),
    ("i2_speed", "bigint"),
    ("st_speed", "bigint"),
    ("is_pit_out_lap", "boolean"),
    ("is_last_lap_for_driver", "boolean"),
    ("has_complete_window", "boolean"),
    ("stint_number", "bigint"),
    ("compound", "string"),
    ("tyre_age", "bigint"),
    ("stint_lap", "bigint"),
    ("pit_in_lap", "boolean"),
    ("pit_duration", "double"),
    ("pit_lane_duration", "double"),
    ("position_at_lap_start", "bigint"),
    ("position_at_lap_end", "bigint"),
    ("position_changes_in_lap", "bigint"),
    ("gap_to_leader_s", "double"),
    ("interval_s", "double"),
    ("is_lapped", "boolean"),
    ("interval_samples", "bigint"),
    ("air_temperature", "double"),
    ("track_temperature", "double"),
    ("humidity", "double"),
    ("pressure", "double"),
    ("rainfall", "bigint"),
    ("wind_speed", "double"),
    ("wind_direction", "bigint"),
    ("weather_age_s", "double"),
    ("speed_min", "bigint"),
    ("speed_mean", "double"),
    ("speed_max", "bigint"),
    ("rpm_min", "bigint"),
    ("rpm_mean", "double"),
    ("rpm_max", "bigint"),
    ("throttle_mean", "double"),
    ("brake_applied_share", "double"),
    ("drs_active_share", "double"),
    ("n_gear_max", "bigint"),
    ("car_data_samples", "bigint"),
    ("car_data_invalid_samples", "bigint"),
    ("rc_events_in_lap", "bigint"),
    ("rc_driver_events_in_lap", "bigint"),
]
COLUMNS = [name for name, _ in TYPED]


def laps_with_windows(laps: DataFrame) -> DataFrame:
    """Windows first, then laps without a driver or number go (WN-01, FLT-01)."""
    windows = align.interval_windows(laps.withColumnRenamed("date_start", "lap_start_time"), DRIVER, ["lap_number", "pos"], "lap_start_time", "lap_duration", "lap_window")
    named = windows.withColumnsRenamed({"lap_window_end": "lap_end_time", "is_last": "is_last_lap_for_driver"})
    return named.na.drop(subset=["driver_number", "lap_number"]).drop("pos")


def inside_laps(records: DataFrame, laps: DataFrame) -> DataFrame:
    windows = laps.select(*GRAIN, "lap_start_time", "lap_end_time", "has_complete_window")
    return align.assign_to_windows(records, windows, "date", "lap_start_time", "lap_end_time", DRIVER, ["lap_number"], ["lap_number"], F.col("has_complete_window"))


def telemetry(records: DataFrame, laps: DataFrame) -> DataFrame:
    """Samples in a lap, impossible values masked and counted (AG-01, FLT-05)."""
    return reduced_telemetry(inside_laps(records, laps))


def reduced_telemetry(inside: DataFrame) -> DataFrame:
    """One row a lap from samples that lie in one."""
    gear, throttle, brake = F.col("n_gear") <= GEAR_MOST, F.col("throttle") <= THROTTLE_MOST, F.col("brake") <= BRAKE_MOST
    wrong = F.coalesce(~gear, F.lit(False)) | F.coalesce(~throttle, F.lit(False)) | F.coalesce(~brake, F.lit(False))
    share = lambda yes: F.avg(yes.cast("double"))
    pressed = reduce.masked(F.col("brake"), brake)
    return inside.groupBy(*GRAIN).agg(
        *[f(c).alias(f"{c}_{n}") for c in ("speed", "rpm") for f, n in ((F.min, "min"), (F.avg, "mean"), (F.max, "max"))],
        F.avg(reduce.masked(F.col("throttle"), throttle)).alias("throttle_mean"), share(pressed > 0).alias("brake_applied_share"), share(F.col("drs").isin(*DRS_OPEN)).alias("drs_active_share"),
        F.max(reduce.masked(F.col("n_gear"), gear)).alias("n_gear_max"), F.count(F.lit(1)).alias("car_data_samples"), F.count_if(wrong).alias("car_data_invalid_samples"),
    )


def intervals(records: DataFrame, laps: DataFrame) -> DataFrame:
    """The lap's last record, all its fields from one instant (AG-02, JN-15)."""
    named = records.withColumnsRenamed({"gap_to_leader": "gap_to_leader_s", "interval": "interval_s", "gap_to_leader_is_text": "is_lapped"})
    return reduce.last_record(inside_laps(named, laps), GRAIN, ["date", "pos"], ["gap_to_leader_s", "interval_s", "is_lapped"], "interval_samples")


def positions(records: DataFrame, laps: DataFrame) -> DataFrame:
    """The last known position at a lap's start and end, and changes in it (JN-02, WN-14).

    Changes are 0 in a session with records and null in one without.
    """
    known = records.select("session_key", "driver_number", "date", "position", "pos")
    at = lambda df, when, name: align.asof_last(df, known, when, "date", DRIVER, ["pos"]).withColumn(name, F.col("match.position")).drop("match")
    bounds = at(at(laps.select(*GRAIN, "lap_start_time", "lap_end_time"), "lap_start_time", "position_at_lap_start"), "lap_end_time", "position_at_lap_end")
    changes = inside_laps(records, laps).groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("changes"))
    recorded = records.select("session_key").distinct().withColumn("recorded", F.lit(True))
    joined = bounds.join(changes, GRAIN, "left").join(recorded, "session_key", "left")
    return joined.withColumn("position_changes_in_lap", F.when(F.col("recorded"), F.coalesce("changes", F.lit(0)))).drop("changes", "recorded", "lap_start_time", "lap_end_time")


def stints(laps: DataFrame, records: DataFrame) -> DataFrame:
    """The stint that covers a lap, and tyre age from it (JN-04, PRJ-10)."""
    usable = records.na.drop(subset=["driver_number", "lap_start"])
    found = align.range_confirmed(laps.select(*GRAIN), usable, "lap_number", "lap_start", "lap_end", DRIVER, ["pos"], "s")
    into = F.col("lap_number") - F.col("s.lap_start")
    return found.select(*GRAIN, F.col("s.stint_number").alias("stint_number"), F.col("s.compound").alias("compound"), (F.col("s.tyre_age_at_start") + into).alias("tyre_age"), (into + 1).alias("stint_lap"))


def pit_stops(records: DataFrame) -> DataFrame:
    """Stops by their in-lap, each value the first that is known (AG-04, JN-08)."""
    found = reduce.first_known(records.na.drop(subset=["driver_number", "lap_number"]), GRAIN, ["pos"], ["pit_duration", "lane_duration"])
    return found.withColumnRenamed("lane_duration", "pit_lane_duration")


def weather(laps: DataFrame, records: DataFrame, tolerance_seconds: float) -> DataFrame:
    """Conditions last measured before a lap began, if recent enough (JN-03).

    A few sessions may hold all laps, so each is aligned by the hour.
    """
    found = align.asof_within(laps.select(*GRAIN, "lap_start_time"), records, "lap_start_time", "date", tolerance_seconds, ["session_key"], ["pos"], "w", "weather_age_s", bucket="hour")
    return found.select(*GRAIN, *[F.col(f"w.{c}").alias(c) for c in WEATHER], "weather_age_s")


def lap_table(sources: Mapping[str, DataFrame], tolerance_seconds: float = 120) -> DataFrame:
    """The 55 columns of a lap, from typed frames by kind of record; a kind may be absent.

    Left joins in a fixed order: drivers, stints, pit, position, intervals,
    weather, race control, telemetry.  Repeated laps keep their rows.
    """
    laps = laps_with_windows(sources["laps"])
    table = laps
    add = lambda df: table.join(df, GRAIN, "left")
    if "drivers" in sources:
        names = reduce.first_row(sources["drivers"], DRIVER, ["pos"]).select(*DRIVER, "team_name", F.col("name_acronym").alias("driver_acronym"))
        table = table.join(names, DRIVER, "left")
    unique = laps.dropDuplicates(GRAIN)
    if "stints" in sources:
        table = add(stints(unique, sources["stints"]))
    if "pit" in sources:
        table = add(pit_stops(sources["pit"]))
    if "position" in sources:
        table = add(positions(sources["position"], unique))
    if "intervals" in sources:
        table = add(intervals(sources["intervals"], unique))
    if "weather" in sources:
        table = add(weather(unique, sources["weather"], tolerance_seconds))
    if "race_control" in sources:
        events = sources["race_control"].na.drop(subset=["lap_number"])
        table = reduce.count_onto(table, events.select("session_key", "lap_number"), ["session_key", "lap_number"], "rc_events_in_lap")
        table = reduce.count_onto(table, events.select(*GRAIN), GRAIN, "rc_driver_events_in_lap")
    if "car_data" in sources:
        table = add(telemetry(sources["car_data"], unique))
    return finished(table)


def finished(table: DataFrame) -> DataFrame:
    """Absent columns as null, forced types and the fixed order (PRJ-03 to PRJ-06)."""
    has = lambda c: F.col(c) if c in table.columns else F.lit(None)
    new: dict[str, Column] = {}
    for c, kind in TYPED:
        if kind == "bigint":
            new[c] = whole(has(c).cast("double"))
        elif kind == "double":
            new[c] = real(has(c).cast("double"))
        else:
            new[c] = has(c).cast(kind)
    new["pit_in_lap"] = new["pit_duration"].isNotNull() | new["pit_lane_duration"].isNotNull()
    for c in ("rc_events_in_lap", "rc_driver_events_in_lap"):
        new[c] = F.coalesce(new[c], F.lit(0).cast("bigint"))
    return table.select(*[new[c].alias(c) for c in COLUMNS])


def checks(table: DataFrame) -> DataFrame:
    """One row of soundness counters for each session (G4-1, AG-05, AG-07)."""
    laps = table.groupBy("session_key", "driver_number").agg(F.count(F.lit(1)).alias("laps"))
    spread = laps.groupBy("session_key").agg(F.count(F.lit(1)).alias("drivers"), F.min("laps").alias("fewest_laps"), F.max("laps").alias("most_laps"))
    repeated = table.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("n")).groupBy("session_key").agg(F.sum(F.col("n") - 1).alias("duplicate_rows"))
    lacking = lambda c: F.count_if(F.col(c).isNull())
    sums = table.groupBy("session_key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("has_complete_window")).alias("without_window"), lacking("car_data_samples").alias("without_telemetry"),
        lacking("weather_age_s").alias("without_weather"), lacking("stint_number").alias("without_stint"), lacking("position_at_lap_start").alias("without_position"),
    )
    return sums.join(repeated, "session_key").join(spread, "session_key")
