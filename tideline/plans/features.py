"""Features of a lap from its own past, the next lap's time, and their guards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tideline.operators import guards, history

BY, NUMBER, VALUE, TARGET = ["session_key", "driver_number"], "lap_number", "lap_duration", "next_lap_time"
#: The columns that say where a row comes from.
KEYS = ["year", "meeting_key", "session_key", "driver_number", "lap_number", "session_date"]


@dataclass(frozen=True)
class Decision:
    """What becomes of a column: role key, feature, target or excluded, and why."""

    name: str
    role: str
    kind: str = "numeric"
    reason: str = ""
    derived: bool = False


#: Every column of the lap table and of this stage, in the order of the result.
CATALOGUE = [
    Decision("year", "key", kind="key", reason="says where a row comes from"),
    Decision("meeting_key", "key", kind="key", reason="says where a row comes from"),
    Decision("session_key", "key", kind="key", reason="says where a row comes from"),
    Decision("driver_number", "key", kind="key", reason="says where a row comes from"),
    Decision("lap_number", "key", kind="key", reason="says where a row comes from"),
    Decision("session_date", "key", kind="key", reason="says where a row comes from"),
    Decision("lap_number", "feature", reason="fuel burns off"),
    Decision("lap_duration", "feature", reason="the lap just driven"),
    Decision("duration_sector_1", "feature", reason="the lap just driven"),
    Decision("duration_sector_2", "feature", reason="the lap just driven"),
    Decision("duration_sector_3", "feature", reason="the lap just driven"),
    Decision("is_pit_out_lap", "feature", kind="boolean"),
    Decision("stint_number", "feature"),
    Decision("compound", "feature", kind="categorical"),
    Decision("tyre_age", "feature"),
    Decision("stint_lap", "feature"),
    Decision("pit_in_lap", "feature", kind="boolean"),
    Decision("position_at_lap_start", "feature"),
    Decision("position_at_lap_end", "feature"),
    Decision("position_changes_in_lap", "feature"),
    Decision("gap_to_leader_s", "feature"),
    Decision("interval_s", "feature"),
    Decision("is_lapped", "feature", kind="boolean"),
    Decision("speed_min", "feature"),
    Decision("speed_mean", "feature"),
    Decision("speed_max", "feature"),
    Decision("rpm_min", "feature"),
    Decision("rpm_mean", "feature"),
    Decision("rpm_max", "feature"),
    Decision("throttle_mean", "feature"),
    Decision("brake_applied_share", "feature"),
    Decision("drs_active_share", "feature"),
    Decision("air_temperature", "feature"),
    Decision("track_temperature", "feature"),
    Decision("wind_speed", "feature"),
    Decision("rc_events_in_lap", "feature"),
    Decision("rc_driver_events_in_lap", "feature"),
    Decision("driver_acronym", "feature", kind="categorical"),
    Decision("team_name", "feature", kind="categorical"),
    *(Decision(name, "feature", reason="the driver's own past", derived=True) for name in history.temporal_names()),
    Decision("i1_speed", "feature"),
    Decision("i2_speed", "feature"),
    Decision("st_speed", "feature"),
    Decision("humidity", "feature"),
    Decision("pressure", "feature"),
    Decision("n_gear_max", "feature"),
    Decision("car_data_samples", "feature"),
    Decision("interval_samples", "feature"),
    Decision(TARGET, "target", reason="the next lap's time", derived=True),
    Decision("pit_duration", "excluded", reason="known only after the lap, or tells that there is a next one"),
    Decision("pit_lane_duration", "excluded", reason="known only after the lap, or tells that there is a next one"),
    Decision("lap_end_time", "excluded", reason="known only after the lap, or tells that there is a next one"),
    Decision("is_last_lap_for_driver", "excluded", reason="known only after the lap, or tells that there is a next one"),
    Decision("has_complete_window", "excluded", reason="known only after the lap, or tells that there is a next one"),
    Decision("lap_start_time", "excluded", reason="bookkeeping or hardly varies"),
    Decision("rainfall", "excluded", reason="bookkeeping or hardly varies"),
    Decision("weather_age_s", "excluded", reason="bookkeeping or hardly varies"),
    Decision("car_data_invalid_samples", "excluded", reason="bookkeeping or hardly varies"),
    Decision("wind_direction", "excluded", reason="bookkeeping or hardly varies"),
    Decision("has_target", "excluded", kind="boolean", reason="says whether there is a target", derived=True),
]
FORBIDDEN = [TARGET, "has_target", "lap_end_time", "is_last_lap_for_driver", "has_complete_window", "pit_duration", "pit_lane_duration"]
FEATURES = [d.name for d in CATALOGUE if d.role == "feature"]
CATEGORICAL = [d.name for d in CATALOGUE if d.role == "feature" and d.kind == "categorical"]


def with_history(laps: DataFrame, windows: tuple[int, ...] = (3, 5)) -> DataFrame:
    """Session date, target and history on all columns of the lap table."""
    dated = history.session_start(laps, "session_key", "lap_start_time")
    targeted = history.add_target(dated, BY, NUMBER, VALUE, TARGET)
    return history.add_history(targeted, BY, [NUMBER], VALUE, "lap_time", windows)


def feature_table(laps: DataFrame, windows: tuple[int, ...] = (3, 5)) -> DataFrame:
    """Keys, features in the catalogue's order (the lap number is both and stands once), target and has_target; columns that a
    lap table lacks are left out (PRJ-08)."""
    return selected(with_history(laps, windows))


def selected(full: DataFrame) -> DataFrame:
    """The feature table's columns of laps with their history."""
    wanted = dict.fromkeys([*KEYS, *FEATURES, TARGET, "has_target"])
    return full.select(*[c for c in wanted if c in full.columns])


def numeric_and_categorical(columns: list[str]) -> tuple[list[str], list[str]]:
    """The catalogue's features that are there, booleans as numbers (PRJ-13)."""
    there = [c for c in FEATURES if c in columns]
    return [c for c in there if c not in CATEGORICAL], [c for c in there if c in CATEGORICAL]


def check(features: DataFrame, windows: tuple[int, ...] = (3, 5), threshold: float = 0.99, marked: DataFrame | None = None) -> list[guards.Result]:
    """The seven guards of this stage (G5-1 to G5-7); ``marked`` are the same rows with the
    lap table's mark of last laps, which is no feature."""
    numeric, _ = numeric_and_categorical(features.columns)
    return [
        guards.grain_unique(features, [*BY, NUMBER]), guards.target_independently(features, BY, NUMBER, VALUE, TARGET), guards.last_has_no_target(features if marked is None else marked, "is_last_lap_for_driver", TARGET),
        guards.target_stays_in_group(features, BY, NUMBER, TARGET), guards.no_forbidden([c for c in features.columns if c not in (*KEYS, TARGET, "has_target")], FORBIDDEN),
        guards.rolling_from_past(features, BY, NUMBER, VALUE, "lap_time", windows), guards.no_near_copy_of_target(features, numeric, TARGET, threshold),
    ]
