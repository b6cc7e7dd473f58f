"""The feed as scans and as a resumable stream, against a local server."""

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from tideline.sources import rest

SESSIONS = [7, 9, 8]


class Feed(BaseHTTPRequestHandler):
    asked: list[str] = []
    broken = False

    def do_GET(self):
        url = urlparse(self.path)
        endpoint, q = url.path.rpartition("/")[2], {k: v[0] for k, v in parse_qs(url.query).items()}
        type(self).asked.append(f"{endpoint}?{url.query}")
        session = int(q.get("session_key", 0))
        status, body = 200, []
        if endpoint == "meetings":
            body = [{"meeting_key": 1, "year": 2023}]
        elif endpoint == "sessions":
            body = [{"session_key": s, "session_name": "Race" if s != 8 else "Practice", "session_type": "Race", "year": 2023} for s in SESSIONS]
        elif endpoint == "drivers":
            body = [{"driver_number": 44}, {"driver_number": 1}]
        elif session == 8:
            status, body = 404, None
        elif session == 9 and type(self).broken:
            status, body = 400, None
        elif session == 7 and endpoint == "pit":
            body = b"{damaged"
        else:
            body = [{"session_key": session, "driver_number": int(q.get("driver_number", 1)), "lap_number": n} for n in (1, 2)]
        data = body if isinstance(body, bytes) else json.dumps(body).encode()
        self.send_response(status)
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *_):
        pass


@pytest.fixture
def feed(spark):
    server = ThreadingHTTPServer(("127.0.0.1", 0), Feed)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Feed.asked, Feed.broken = [], False
    spark.dataSource.register(rest.TimingSource)
    yield f"http://127.0.0.1:{server.server_port}/v1"
    server.shutdown()


def test_season_asks_for_everything_once(spark, feed):
    found = rest.season_of(spark, feed, 2023, ["laps", "weather"], ["race"])
    assert set(found) == {"meetings", "sessions", "laps", "weather"} and found["sessions"].count() == 3
    both = found["laps"].join(found["weather"], ["session_key", "pos"])
    assert both.count() == 4 and found["laps"].select("session_key").distinct().count() == 2  # 8 has no records
    times = Counter(Feed.asked)
    assert max(times.values()) == 1 and set(times) == {"meetings?year=2023", "sessions?year=2023", *(f"{e}?session_key={s}" for e in ("laps", "weather") for s in SESSIONS)}


def test_filters_reach_the_feed_through_spark(spark, feed):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        laps = spark.read.format("timing").options(url=feed, endpoint="laps").load().where("session_key = 7 and lap_number > 1")
        assert [(r.session_key, r.lap_number, r.pos) for r in laps.collect()] == [(7, 2, 1)]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert Feed.asked == ["laps?session_key=7&lap_number%3E1"] or Feed.asked == ["laps?session_key=7&lap_number>1"]


def test_one_limiter_for_all_requests_of_a_scan(feed):
    now, slept = [0.0], []
    reader = rest.SeveralReader({"endpoints": "laps,weather", "session_keys": "1,2,3,4,5", "url": feed, "sent": "2"})
    reader.transport = lambda url: (200, {}, b"[{}]")
    made = []
    real = rest.Limiter
    try:
        rest.Limiter = lambda: made.append(real(3, 30, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))) or made[-1]
        assert len(list(reader.read(None))) == 10
    finally:
        rest.Limiter = real
    assert len(made) == 1 and slept == [1.0, 1.0, 1.0]  # 2 before, 10 here: three in any second


def run(spark, feed, tmp_path, endpoint="laps", **options):
    stream = spark.readStream.format("timing").options(url=feed, endpoint=endpoint, year="2023", units=f"file://{tmp_path}/units", **options).load()
    q = stream.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted((r.unit, r.session_key, r.status, -1 if r.pos is None else r.pos) for r in spark.read.parquet(f"file://{tmp_path}/out").collect())


def test_a_stopped_scan_goes_on_at_the_next_session(spark, feed, tmp_path):
    one = run(spark, feed, tmp_path, per_batch="1")
    assert one == [(0, 7, 200, 0), (0, 7, 200, 1)]
    with pytest.raises(FileNotFoundError):
        rest.work_units(f"file://{tmp_path}/none")
    assert rest.work_units(f"file://{tmp_path}/units") == [7, 8, 9]
    two = run(spark, feed, tmp_path, per_batch="2")
    assert two[2:] in ([(1, 8, 404, -1)], [(1, 8, 404, -1), (2, 9, 200, 0), (2, 9, 200, 1)])  # an absent session is done, too
    SESSIONS.insert(0, 3)
    try:
        whole = run(spark, feed, tmp_path)
        assert whole == [(0, 7, 200, 0), (0, 7, 200, 1), (1, 8, 404, -1), (2, 9, 200, 0), (2, 9, 200, 1)]  # the catalogue is a day old at most
        known = rest.stored(f"file://{tmp_path}/units/catalogue.json")
        rest.store(f"file://{tmp_path}/units/catalogue.json", known | {"retrieved_at": "2020-01-01T00:00:00+00:00"})
        again = run(spark, feed, tmp_path)
        assert again == [*whole, (3, 3, 200, 0), (3, 3, 200, 1)] and rest.work_units(f"file://{tmp_path}/units") == [7, 8, 9, 3]
    finally:
        SESSIONS.remove(3)
    laps = [u for u in Feed.asked if u.startswith("laps?")]
    assert len(laps) == len(set(laps)) == 4  # nothing twice


def test_damaged_answers_are_done_and_failures_are_not(spark, feed, tmp_path):
    Feed.broken = True
    with pytest.raises(Exception, match="400|status"):
        run(spark, feed, tmp_path, "pit")
    Feed.broken = False
    assert run(spark, feed, tmp_path, "pit") == [(0, 7, 0, -1), (1, 8, 404, -1), (2, 9, 200, 0), (2, 9, 200, 1)]


def test_telemetry_units_fan_out_over_drivers(spark, feed, tmp_path):
    got = run(spark, feed, tmp_path, "car_data")
    assert len(got) == 2 * 2 * 2 + 2 and {r[:3] for r in got} == {(0, 7, 200), (1, 8, 404), (2, 9, 200)}
