"""Expectations of raw records as data: one spec for each kind of document.

The values below are fixed: they describe the public timing feed's documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Field:
    """What a key of a record may hold.

    ``kinds`` are JSON kinds: int, float, str, bool, list, time (a str that is an
    instant).  ``above`` excludes the minimum itself.  ``sparse`` nulls are usual.
    """

    name: str
    kinds: tuple[str, ...]
    required: bool = False
    nullable: bool = True
    low: float | None = None
    high: float | None = None
    above: bool = False
    plausible: tuple[float, float] | None = None
    documented: tuple[float, float] | None = None
    allowed: tuple = ()
    pattern: str | None = None
    sparse: bool = False


@dataclass(frozen=True)
class Endpoint:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    order: str | None = None
    group: str | None = None
    ordered_pairs: tuple[tuple[str, str], ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _int(name, low=None, high=None, needed=False, **more):
    return Field(name, ("int",), needed, not needed, low, high, **more)


def _num(name, **more):
    return Field(name, ("int", "float"), **more)


def _text(names: str, needed=False, **more):
    return [Field(n, ("str",), needed, not needed, **more) for n in names.split()]


def _time(name, needed=True, **more):
    return Field(name, ("time",), needed, not needed, **more)


SESSION = _int("session_key", 0, needed=True)
MEETING = Field("meeting_key", ("int",), nullable=False, low=0)
DRIVER = _int("driver_number", 1, 99, needed=True)
COMPOUNDS = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "UNKNOWN", "TEST_UNKNOWN")
DRS = (0, 1, 2, 3, 8, 10, 12, 14)
DRS_OPEN = (10, 12, 14)
GEAR_MOST, THROTTLE_MOST, BRAKE_MOST = 8, 100, 100
GAP = r"^\+\d+ LAPS?$"

ENDPOINTS = {
    e.name: e
    for e in (
        Endpoint("meetings", (_int("meeting_key", 0, needed=True), _int("year", 1950, 2100, True), *_text("meeting_name", True), *_text("meeting_official_name country_code country_name circuit_short_name location"), Field("gmt_offset", ("str", "int")), _time("date_start"), _time("date_end", False), Field("is_cancelled", ("bool",))), ("meeting_key",)),
        Endpoint("sessions", (SESSION, _int("meeting_key", 0, needed=True), _int("year", 1950, 2100), *_text("session_name session_type", True), _time("date_start"), _time("date_end"), *_text("circuit_short_name country_name location"), Field("is_cancelled", ("bool",))), ("session_key",)),
        Endpoint("drivers", (SESSION, MEETING, DRIVER, *_text("full_name first_name last_name broadcast_name name_acronym team_name team_colour country_code headshot_url")), ("session_key", "driver_number")),
        Endpoint("laps", (SESSION, MEETING, DRIVER, _int("lap_number", 1, 100, True), _num("lap_duration", low=0, above=True, plausible=(40, 400)), *[_num(f"duration_sector_{i}", low=0, above=True, plausible=(10, 200)) for i in (1, 2, 3)], *[_int(n, 0, 400) for n in ("i1_speed", "i2_speed", "st_speed")], Field("is_pit_out_lap", ("bool",)), _time("date_start", False), *[Field(f"segments_sector_{i}", ("list",)) for i in (1, 2, 3)]), ("session_key", "driver_number", "lap_number"), "lap_number", "driver_number"),
        Endpoint("car_data", (SESSION, MEETING, DRIVER, _time("date"), _int("speed", 0, 400), _int("rpm", 0, 20000), _int("n_gear", 0, 8), *[_int(n, 0, 110, documented=(0, 100)) for n in ("throttle", "brake")], _int("drs", 0, allowed=DRS)), ("session_key", "driver_number", "date"), "date"),
        Endpoint("position", (SESSION, MEETING, DRIVER, _time("date"), _int("position", 1, 30, True)), ("session_key", "driver_number", "date"), "date", "driver_number"),
        Endpoint("intervals", (SESSION, MEETING, DRIVER, _time("date"), *[Field(n, ("int", "float", "str"), low=0, pattern=GAP, sparse=True) for n in ("gap_to_leader", "interval")]), ("session_key", "driver_number", "date"), "date", "driver_number"),
        Endpoint("stints", (SESSION, MEETING, DRIVER, _int("stint_number", 1, 50, True), _int("lap_start", 1, 100, True), _int("lap_end", 1, 100, True), *_text("compound", allowed=COMPOUNDS), _int("tyre_age_at_start", 0, 100)), ("session_key", "driver_number", "stint_number"), ordered_pairs=(("lap_start", "lap_end"),)),
        Endpoint("pit", (SESSION, MEETING, DRIVER, _int("lap_number", 0, 100, True), _time("date"), *[_num(n, low=0, above=True, plausible=(1, 300)) for n in ("pit_duration", "lane_duration", "stop_duration")]), ("session_key", "driver_number", "lap_number")),
        Endpoint("weather", (SESSION, MEETING, _time("date"), _num("air_temperature", low=-30, high=70, plausible=(-10, 50)), _num("track_temperature", low=-30, high=100, plausible=(-10, 70)), _num("humidity", low=0, high=100), _num("pressure", low=800, high=1100), _num("rainfall", allowed=(0, 1)), _int("wind_direction", 0, 360), _num("wind_speed", low=0, high=150, plausible=(0, 50))), ("session_key", "date"), "date"),
        Endpoint("race_control", (SESSION, MEETING, _time("date"), *_text("message", True), *_text("category"), _int("lap_number", 0, 100), _int("driver_number", 1, 99, sparse=True), *_text("flag scope", sparse=True), _int("sector", 0, 40, sparse=True), _int("qualifying_phase", sparse=True)), ("session_key", "date", "message"), "date"),
    )
}
