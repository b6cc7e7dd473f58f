"""A data source for a JSON-over-HTTP timing feed, for batches and streams.

``spark.read.format("timing")`` with options ``endpoint`` and, as filters, any of
the feed's parameters.  Filters of a query are pushed to the request where the
feed knows them (set ``spark.sql.python.filterPushdown.enabled``); telemetry without a driver or a span of dates is refused.  A scan
is one partition, so that one limiter spaces all its requests; failed ones are tried
again.  With ``endpoints``, one scan reads several kinds of records.

``spark.readStream.format("timing")`` reads the sessions of a season one after the
other: its offsets are places in a stored catalogue, so a stopped scan goes on at the
next session.
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections import deque
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from tideline.sources.scratch import keep

#: The feed's endpoints and the parameters each takes.
PARAMETERS = {
    "meetings": ["year", "country_name", "meeting_key"],
    "sessions": ["year", "country_name", "session_name", "session_type", "meeting_key", "session_key"],
    "drivers": ["session_key", "driver_number"],
    "laps": ["session_key", "driver_number", "lap_number"],
    "car_data": ["session_key", "driver_number", "date"],
    "position": ["session_key", "driver_number", "date"],
    "intervals": ["session_key", "driver_number", "date"],
    "stints": ["session_key", "driver_number", "stint_number"],
    "pit": ["session_key", "driver_number", "lap_number"],
    "weather": ["session_key", "meeting_key", "date"],
    "race_control": ["session_key", "driver_number", "lap_number", "flag", "date"],
}
RETRIED = {429, 500, 502, 503, 504}


class Limiter:
    """At most so many requests in the last second and the last minute."""

    def __init__(self, per_second: int = 3, per_minute: int = 30, clock=time.monotonic, sleep=time.sleep):
        self.spans, self.clock, self.sleep, self.sent = ((1.0, per_second), (60.0, per_minute)), clock, sleep, deque()

    def acquire(self) -> None:
        while True:
            now = self.clock()
            while self.sent and now - self.sent[0] >= 60:
                self.sent.popleft()
            waits = [self.sent[-n] + span - now for span, n in self.spans if len(self.sent) >= n]
            if max(waits, default=0) <= 0:
                self.sent.append(now)
                return
            self.sleep(max(waits))


def http(url: str, timeout: float = 30) -> tuple[int, dict, bytes]:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as got:  # noqa: S310  (the address is the user's option)
            return got.status, dict(got.headers), got.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


def fetch(url: str, limiter: Limiter, transport=http, tries: int = 5, sleep=time.sleep) -> list[dict]:
    """Records of one request; an absent resource has none."""
    return answered(url, limiter, transport, tries, sleep)[1]


def answered(url: str, limiter: Limiter, transport=http, tries: int = 5, sleep=time.sleep) -> tuple[int, list[dict]]:
    """Status and records of one request, 200 or 404; others are errors."""
    for n in range(tries):
        limiter.acquire()
        try:
            status, headers, body = transport(url)
        except (TimeoutError, ConnectionError, urllib.error.URLError):
            status, headers, body = 503, {}, b""
        if status == 200:
            found = json.loads(body)
            return 200, found if isinstance(found, list) else [found]
        if status == 404:
            return 404, []
        if status not in RETRIED or n + 1 == tries:
            raise OSError(f"{url}: status {status}")
        asked = headers.get("Retry-After", "")
        sleep(float(asked) if asked.replace(".", "", 1).isdigit() else min(60.0, 2.0**n + random.random()))
    return 404, []


class TimingSource(DataSource):
    """Records as (pos, record), ``record`` in JSON; parse it with ``try_parse_json``."""

    @classmethod
    def name(cls) -> str:
        return "timing"

    def schema(self) -> str:
        if self.options.get("units"):
            return "unit int, session_key long, driver_number long, status int, pos int, record string"
        if self.options.get("endpoints"):
            return "endpoint string, session_key long, driver_number long, pos int, record string"
        kinds = {"date": "timestamp", "country_name": "string", "session_name": "string", "session_type": "string", "flag": "string"}
        return ", ".join([f"{p} {kinds.get(p, 'long')}" for p in PARAMETERS[self.options["endpoint"]]] + ["pos int", "record string"])

    def reader(self, schema) -> TimingReader:
        return SeveralReader(dict(self.options)) if self.options.get("endpoints") else TimingReader(dict(self.options))

    def streamReader(self, schema) -> UnitReader:
        return UnitReader(dict(self.options))


class Requests:
    """The requests that one scan of an endpoint makes."""

    transport = staticmethod(http)

    def __init__(self, options: dict[str, str]):
        self.options, self.endpoint = options, options.get("endpoint", "")
        self.known = PARAMETERS.get(self.endpoint, [])
        self.asked = [(p, "=", options[p]) for p in self.known if options.get(p)]

    def partitions(self) -> list[InputPartition]:
        """One partition: the feed's limits hold for all requests of a scan together."""
        by_session = bool(self.listed("session_keys")) or any(a[:2] == ("session_key", "=") for a in self.asked)
        if self.endpoint == "car_data" and not by_session and not self.listed("drivers") and not {"driver_number", "date"} & {a[0] for a in self.asked}:
            raise ValueError("telemetry is only read for a session, a driver or a span of dates")
        return [InputPartition(None)]

    def listed(self, option: str) -> list[str]:
        return [x for x in self.options.get(option, "").split(",") if x]

    def url(self, endpoint: str, asked: list[tuple[str, str, str]]) -> str:
        query = "&".join(f"{urllib.parse.quote(k)}{'=' if s == '=' else s}{urllib.parse.quote(str(v))}" for k, s, v in asked)
        return f"{self.options['url'].rstrip('/')}/{endpoint}?{query}"

    def requests(self, limiter: Limiter) -> Iterator[list[tuple[str, str, str]]]:
        """What each request asks for: one for each session of the option ``session_keys``
        and, for telemetry, for each driver, as listed or else as the session has them (SRC-16, SRC-17)."""
        for session in self.listed("session_keys") or [None]:
            asked = self.asked + ([("session_key", "=", session)] if session else [])
            drivers = self.listed("drivers")
            if self.endpoint == "car_data" and not drivers and not {"driver_number", "date"} & {a[0] for a in asked}:
                of_session = [a for a in asked if a[0] == "session_key"]
                drivers = sorted({d["driver_number"] for d in fetch(self.url("drivers", of_session), limiter, self.transport) if d.get("driver_number") is not None})
                yield from (asked + [("driver_number", "=", d)] for d in drivers)
            else:
                yield from (asked + ([("driver_number", "=", d)] if d else []) for d in drivers or [None])


class TimingReader(Requests, DataSourceReader):
    """One endpoint with its filters in the requests; the session must have
    ``spark.sql.python.filterPushdown.enabled`` set."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        signs = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            sign = signs.get(type(f))
            if sign and len(f.attribute) == 1 and f.attribute[0] in self.known and f.value is not None:
                wanted = (f.attribute[0], sign, f.value.isoformat() if hasattr(f.value, "isoformat") else str(f.value))
                if wanted not in self.asked:
                    self.asked.append(wanted)
            yield f  # Spark applies every filter again: the feed may ignore one

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        limiter = Limiter()
        for asked in self.requests(limiter):
            for pos, record in enumerate(fetch(self.url(self.endpoint, asked), limiter, self.transport)):
                yield (*(_typed(p, record.get(p)) for p in self.known), pos, json.dumps(record))


class SeveralReader(Requests, DataSourceReader):
    """The records of several endpoints, one after the other under one limiter."""

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        limiter = Limiter()
        limiter.sent.extend([limiter.clock()] * int(self.options.get("sent", 0)))  # requests that have just been made elsewhere
        for endpoint in self.listed("endpoints"):
            one = Requests(self.options | {"endpoint": endpoint})
            one.transport = self.transport
            for asked in one.requests(limiter):
                told = {p: v for p, _, v in asked}
                for pos, record in enumerate(fetch(self.url(endpoint, asked), limiter, self.transport)):
                    keys = (_typed(p, record.get(p, told.get(p))) for p in ("session_key", "driver_number"))
                    yield (endpoint, *(int(k) if k is not None else None for k in keys), pos, json.dumps(record))


#: Age from which a stored catalogue is read again.
STALE = timedelta(hours=24)


def stored(uri: str):
    """A small JSON document, None where there is none."""
    files, path = FileSystem.from_uri(uri)
    if files.get_file_info(path).type != FileType.File:
        return None
    with files.open_input_stream(path) as f:
        return json.loads(f.read())


def store(uri: str, value) -> None:
    """Replace a small JSON document in one step."""
    files, path = FileSystem.from_uri(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(f"{path}.tmp") as f:
        f.write(json.dumps(value).encode())
    files.move(f"{path}.tmp", path)


def work_units(folder: str) -> list[int]:
    """The sessions of a stored catalogue in the order of their places, without asking the feed (PV-06)."""
    known = stored(f"{folder}/catalogue.json")
    if known is None:
        raise FileNotFoundError(f"no stored catalogue in {folder}")
    return known["sessions"]


class UnitReader(DataSourceStreamReader):
    """A season's sessions as a stream (SRC-16, SRC-18).

    The option ``units`` names a folder for the catalogue and the progress.  The catalogue
    lists sessions in the order they were first seen, so an offset, the number of sessions
    done, means the same after every refresh; it is read again once it is a day old.
    ``per_batch`` bounds the sessions of a micro-batch.  A session that the feed does not
    have is a row with status 404, one whose answer is no JSON a row with status 0: both
    are done.  Any other failure ends the query, which starts again at that session.
    """

    transport = staticmethod(http)
    now = staticmethod(lambda: datetime.now(timezone.utc))

    def __init__(self, options: dict[str, str]):
        self.options, self.folder, self.done = options, options["units"], None
        self.per_batch = int(options.get("per_batch", 0))

    def sessions(self) -> list[int]:
        known = stored(f"{self.folder}/catalogue.json") or {"sessions": []}
        if "retrieved_at" not in known or self.now() - datetime.fromisoformat(known["retrieved_at"]) > STALE:
            reader = Requests({"endpoint": "sessions", "url": self.options["url"]})
            found = fetch(reader.url("sessions", [("year", "=", self.options["year"])]), Limiter(), self.transport)
            kinds = {k.strip().lower() for k in self.options.get("kinds", "").split(",") if k.strip()}
            keys = sorted({r["session_key"] for r in found if r.get("session_key") is not None and (not kinds or {str(r.get("session_name")).lower(), str(r.get("session_type")).lower()} & kinds)})
            known = {"retrieved_at": self.now().isoformat(), "sessions": known["sessions"] + [k for k in keys if k not in set(known["sessions"])]}
            store(f"{self.folder}/catalogue.json", known)
        return known["sessions"]

    def initialOffset(self) -> dict:
        return {"sessions": 0}

    def latestOffset(self) -> dict:
        """So many sessions further than what is known to be done; the progress on disk is one batch behind at most."""
        total = len(self.sessions())
        if self.done is None:
            self.done = (stored(f"{self.folder}/progress.json") or {"sessions": 0})["sessions"]
        self.done = min(total, self.done + self.per_batch) if self.per_batch else total
        return {"sessions": self.done}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.done = max(self.done or 0, end["sessions"])
        return [InputPartition((start["sessions"], end["sessions"]))] if start["sessions"] < end["sessions"] else []

    def commit(self, end: dict) -> None:
        store(f"{self.folder}/progress.json", end)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        limiter, (first, last) = Limiter(), partition.value
        for unit, session in enumerate(work_units(self.folder)[first:last], first):
            one = Requests({k: v for k, v in self.options.items() if k != "units"} | {"session_keys": str(session)})
            one.transport = self.transport
            for asked in one.requests(limiter):
                driver = next((int(v) for p, s, v in asked if (p, s) == ("driver_number", "=")), None)
                try:
                    status, records = answered(one.url(one.endpoint, asked), limiter, self.transport)
                except ValueError:
                    status, records = 0, []
                for pos, record in enumerate(records):
                    yield (unit, session, driver if driver is not None else _typed("driver_number", record.get("driver_number")), status, pos, json.dumps(record))
                if status != 200:
                    yield (unit, session, driver, status, None, None)


def season_of(spark, url: str, year: int, endpoints: list[str], kinds: list[str] | None = None) -> dict:
    """Frames of a season: its meetings and sessions, and for each of ``endpoints`` the records
    (session_key, driver_number, pos, record) of all its sessions, of those whose name or type is in ``kinds`` if given (SRC-16).

    One scan reads the catalogue and one all records, each written before the next begins:
    every request is made once, under one limiter.
    """
    scan = lambda **options: keep(spark.read.format("timing").options(url=url, **options).load())
    catalogue = scan(endpoints="meetings,sessions", year=str(year))
    of = lambda df, e: df.where(F.col("endpoint") == e).drop("endpoint")
    text = lambda name: F.lower(F.try_variant_get(F.try_parse_json("record"), f"$.{name}", "string"))
    sessions = of(catalogue, "sessions")
    wanted = sessions.where(text("session_name").isin([k.lower() for k in kinds]) | text("session_type").isin([k.lower() for k in kinds])) if kinds else sessions
    keys = sorted(r.session_key for r in wanted.select("session_key").na.drop().distinct().collect())  # a season's catalogue: some hundred rows
    found = {"meetings": of(catalogue, "meetings"), "sessions": sessions}
    if keys and endpoints:
        records = scan(endpoints=",".join(endpoints), session_keys=",".join(map(str, keys)), sent="2")
        found |= {e: of(records, e) for e in endpoints}
    return found


def _typed(name: str, value):
    if value is None:
        return None
    if name == "date":
        try:
            return datetime.fromisoformat(value)
        except ValueError:
            return None
    return value if isinstance(value, (int, str)) and not isinstance(value, bool) else None
