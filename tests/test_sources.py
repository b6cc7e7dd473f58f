"""Raw documents, quality rules, sinks, the feed's reader and ingestion."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tideline.functions import scalars as fn
from tideline.operators import quality
from tideline.operators.specs import ENDPOINTS
from tideline.plans import features, lap_table, modelling
from tideline.sources import envelopes, rest, scratch, sinks, tables
from tideline.streaming import ingest

def stamp(s):
    return f"2023-03-05T{15 + s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}Z"


def documents(session=7953, drivers=(1, 44), laps=8):
    key = {"session_key": session, "meeting_key": 1141}
    yield "laps", None, [key | {"driver_number": d, "lap_number": n, "lap_duration": 100.0 + (n * d) % 7, "date_start": stamp((n - 1) * 100), "is_pit_out_lap": n == 4, "i1_speed": 300} for d in drivers for n in range(1, laps + 1)] + ["junk"]
    yield "drivers", None, [key | {"driver_number": d, "team_name": "T", "name_acronym": f"D{d}"} for d in drivers]
    yield "stints", None, [key | {"driver_number": d, "stint_number": 1, "lap_start": 1, "lap_end": laps, "compound": "SOFT", "tyre_age_at_start": 2} for d in drivers]
    yield "pit", None, [key | {"driver_number": 1, "lap_number": 3, "pit_duration": None, "lane_duration": 22.5, "date": stamp(290)}]
    yield "position", None, [key | {"driver_number": d, "date": stamp(5), "position": i + 1} for i, d in enumerate(drivers)]
    yield "intervals", None, [key | {"driver_number": 44, "date": stamp(150), "gap_to_leader": 3.5, "interval": 3.5}, key | {"driver_number": 44, "date": stamp(190), "gap_to_leader": "+1 LAP", "interval": None}]
    yield "weather", None, [key | {"date": stamp(s), "air_temperature": 25.5, "rainfall": 0, "wind_direction": 90} for s in (0, 170)]
    yield "race_control", None, [key | {"date": stamp(120), "message": "FLAG", "lap_number": 2, "driver_number": 44}, key | {"date": stamp(121), "message": "NOTE", "lap_number": 2}]
    yield "car_data", 1, [key | {"driver_number": 1, "date": stamp(s), "speed": v, "rpm": r, "n_gear": g, "throttle": 50, "brake": 0, "drs": 12} for s, v, r, g in ((10, 100, 9000, 3), (20, 300, 12000, 9), (110, 200, 10000, 4))]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("raw")
    for session in (7953, 9001, 9002, 9003, 9004, 9005):
        for endpoint, driver, data in documents(session):
            folder = top / endpoint / "year=2023" / "meeting_key=1141" / f"session_key={session}"
            folder.mkdir(parents=True)
            (folder / (f"driver_{driver}.json" if driver else f"session_{session}.json")).write_text(json.dumps({"endpoint": endpoint, "parameters": {}, "retrieved_at": "2023-01-01T00:00:00Z", "data": data}))
    (top / "laps/year=2023/meeting_key=1141/session_key=9001/session_bad.json").write_text("{broken")
    (top / "laps/year=2023/meeting_key=1141/session_key=9001/.hidden.json").write_text("{}")
    lake = top / "lake/raw/year=2024/meeting=5/session=77/endpoint=weather"
    lake.mkdir(parents=True)
    (lake / "session_77.json").write_text(json.dumps({"endpoint": "weather", "data": []}))
    return f"file://{top}"


@pytest.fixture(scope="module")
def records(spark, root):
    return envelopes.records(envelopes.discover(spark, root))


def test_discovery_keys_and_damage(spark, root, records):
    docs = envelopes.discover(spark, root)
    lake = docs.where("year = 2024").first()
    assert (lake.endpoint, lake.meeting_key, lake.session_key) == ("weather", 5, 77)
    assert docs.where("endpoint = 'car_data'").first().driver_number == 1
    assert [os.path.basename(r.file) for r in envelopes.damaged(docs).collect()] == ["session_bad.json"]
    assert envelopes.discover(spark, root, ["laps"], envelopes.Scope(session_key=7953)).count() == 1
    assert envelopes.sessions(records).count() == 6
    assert envelopes.objects(records).where("endpoint = 'laps'").count() == 6 * 16
    stored = docs.select("endpoint", "session_key").distinct()
    wanted = spark.createDataFrame([("laps", 7953), ("laps", 1)], "endpoint string, session_key long")
    assert [r.session_key for r in envelopes.missing_units(wanted, stored, ["endpoint", "session_key"]).collect()] == [1]


@pytest.fixture(scope="module")
def laps(records):
    return lap_table.lap_table({e: tables.typed(records, e) for e in tables.COLUMNS})


def test_lap_table_of_the_canonical_timeline(laps):
    assert laps.columns == lap_table.COLUMNS and len(laps.columns) == 55
    got = {(r.driver_number, r.lap_number): r for r in laps.where("session_key = 7953").collect()}
    assert len(got) == 16
    one, two, other = got[1, 1], got[1, 2], got[44, 2]
    assert (one.car_data_samples, one.speed_min, one.speed_max, one.n_gear_max, one.car_data_invalid_samples, one.drs_active_share) == (2, 100, 300, 3, 1, 1.0)
    assert two.speed_mean == 200.0 and got[1, 3].car_data_samples is None
    assert (got[1, 3].pit_in_lap, got[1, 3].pit_duration, got[1, 3].pit_lane_duration, two.pit_in_lap) == (True, None, 22.5, False)
    assert (other.gap_to_leader_s, other.is_lapped, other.interval_s, other.interval_samples) == (None, True, None, 2)
    assert (one.position_at_lap_start, one.position_at_lap_end, one.position_changes_in_lap) == (None, 1, 1)
    assert (two.weather_age_s, two.air_temperature, got[1, 5].weather_age_s) == (100.0, 25.5, None)
    assert (two.tyre_age, two.stint_lap, two.compound) == (3, 2, "SOFT")
    assert (two.rc_events_in_lap, two.rc_driver_events_in_lap, other.rc_driver_events_in_lap, one.rc_events_in_lap) == (2, 0, 1, 0)
    assert got[1, 8].is_last_lap_for_driver and two.driver_acronym == "D1" and two.year == 2023


def test_lap_table_of_laps_only(records):
    only = lap_table.lap_table({"laps": tables.typed(records, "laps")})
    assert only.columns == lap_table.COLUMNS and only.where("position_changes_in_lap is not null or speed_min is not null").count() == 0
    assert lap_table.checks(only).where("session_key = 7953").first().asDict() | {"rows": 16, "duplicate_rows": 0} == lap_table.checks(only).where("session_key = 7953").first().asDict()


def test_season_end_to_end(spark, laps, tmp_path):
    path = f"file://{tmp_path}/laps"
    sinks.write_sessions(laps, path)
    sinks.write_sessions(laps.where("session_key = 9001"), path)
    stored = tables.scan(spark, path)
    assert stored.count() == 96 and "p_year" not in stored.columns and tables.content_digest(stored) == tables.content_digest(laps)
    table = scratch.keep(features.feature_table(stored))
    assert table.where("has_target").count() == 6 * 14
    by_name = {r.name: r for r in features.check(table)}
    assert not [r for r in by_name.values() if r.blocks] and by_name["last_lap_has_no_target"].status == "SKIPPED"
    dated = scratch.keep(table.withColumn("session_date", F.col("session_date") + F.make_dt_interval(F.col("session_key").cast("int") % 1000)))
    prepared = modelling.prepare(dated, modelling.Config(train=0.5, validation=0.2))
    assert {r.name for r in prepared.results} == set(modelling.REQUIRED)
    assert not [r for r in prepared.results if r.status == "FAIL"]
    scores = {(r.model, r.split): r for r in modelling.train_and_judge(prepared).collect()}
    assert len(scores) == 6 and scores["linear", "train"].mae <= scores["mean", "train"].mae
    folder = sinks.publish(spark, f"file://{tmp_path}", "run-1", {"matrix": prepared.matrix}, {"verdict": prepared.verdict})
    assert sinks.verify(spark, folder) == [] and sinks.read_json(spark, f"{folder}/report.json") == {"verdict": prepared.verdict}
    with pytest.raises(FileExistsError):
        sinks.publish(spark, f"file://{tmp_path}", "run-1", {}, {})
    spark.read.parquet(f"{folder}/matrix").limit(3).write.mode("append").parquet(f"{folder}/matrix")
    assert sinks.verify(spark, folder) == ["matrix"]
    assert tables.file_digests(spark, f"{folder}/matrix").count() > 1


def test_json_sinks(spark, tmp_path):
    path = f"file://{tmp_path}/a.json"
    assert sinks.write_json_unique(spark, path, {"b": 1, "a": "é"}) == path
    assert sinks.write_json_unique(spark, path, {}) == f"file://{tmp_path}/a-1.json"
    assert (tmp_path / "a.json").read_bytes() == '{"a":"é","b":1}'.encode()
    with pytest.raises(ValueError):
        sinks.safe_name("../x")
    docs = spark.createDataFrame([("laps", "{}", '[{"a": 1}]')], "endpoint string, parameters string, data string").withColumn("retrieved_at", F.lit("2023-01-01").cast("timestamp"))
    sinks.write_documents(docs, f"file://{tmp_path}/docs")
    assert json.loads(spark.read.text(f"file://{tmp_path}/docs").first().value)["data"] == [{"a": 1}]


def found(spark, endpoint, texts, **more):
    rows = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file string, pos int, t string").select("file", "pos", F.try_parse_json("t").alias("rec"))
    return {(r.rule, r.field, r.finding): (r.severity, r.n) for r in quality.document_findings(rows, ENDPOINTS[endpoint], **more).collect()}


def test_quality_rules(spark):
    good = {"session_key": 1, "meeting_key": 2, "driver_number": 1, "date": "2023-03-05T15:00:00Z", "speed": 100, "rpm": 9000, "n_gear": 8, "throttle": 100, "brake": 0, "drs": 8}
    assert found(spark, "car_data", [json.dumps(good)]) == {}
    bad = [good | {"date": "2023-03-05T15:00:01Z", "speed": True, "n_gear": 3.0, "throttle": 104, "brake": 111, "drs": 9}, good | {"date": "soon", "speed": None, "extra": 1}, {k: v for k, v in good.items() if k != "driver_number"} | {"date": "2023-03-05T14:00:00Z"}, good, good]
    got = found(spark, "car_data", [json.dumps(b) for b in bad] + ["[1]"])
    assert got["types", "speed", "wrong_type"] == ("ERROR", 1) and got["types", "n_gear", "wrong_type"] == ("ERROR", 1)
    assert got["values", "throttle", "undocumented"] == ("INFO", 1) and got["values", "brake", "above_maximum"] == ("ERROR", 1) and got["values", "drs", "unexpected"] == ("INFO", 1)
    assert got["temporal", "date", "unparseable"] == ("ERROR", 1) and got["temporal", "date", "order_inversion"] == ("WARNING", 1)
    assert got["schema", "extra", "unknown_field"] == ("INFO", 1) and got["schema", "driver_number", "required_absent"] == ("ERROR", 1)
    assert got["duplicates", "session_key,driver_number,date", "surplus"] == ("ERROR", 1) and got["structure", "", "non_object"] == ("ERROR", 1)
    assert got["structure", "", "several_key_sets"] == ("INFO", 3)
    assert found(spark, "car_data", [json.dumps(b) for b in bad], most=0) == {}
    stint = {"session_key": 1, "meeting_key": 2, "driver_number": 1, "stint_number": 1, "lap_start": 5, "lap_end": 4, "compound": "CHEESE"}
    got = found(spark, "stints", [json.dumps(stint)])
    assert got["cross_field", "lap_end", "before_lap_start"] == ("ERROR", 1) and got["values", "compound", "unexpected"] == ("INFO", 1)
    gaps = [{"session_key": 1, "meeting_key": 2, "driver_number": 1, "date": stamp(i), "gap_to_leader": g} for i, g in enumerate(["+1 LAP", "+2 LAPS", "late", None])]
    got = found(spark, "intervals", [json.dumps(g) for g in gaps])
    assert got["values", "gap_to_leader", "bad_pattern"] == ("INFO", 1) and got["missing_values", "gap_to_leader", "null"][0] == "INFO"


def test_every_spec_is_consistent():
    for e in ENDPOINTS.values():
        assert len(set(e.names)) == len(e.names) and set(e.key) <= set(e.names) and all(n in e.names for n in (e.order, e.group) if n)


def test_coverage_and_status(spark):
    sessions = spark.createDataFrame([(1,), (2,)], "session_key long")
    present = spark.createDataFrame([("laps", 1), ("pit", 1)], "endpoint string, session_key long")
    failures = spark.createDataFrame([("laps", 2, 500, 0), ("pit", 2, 404, 1)], "endpoint string, session_key long, status int, pos int")
    got = {(r.endpoint, r.finding): (r.severity, r.n) for r in quality.coverage(["laps", "pit", "weather", "drivers"], sessions, present, failures, ["laps", "pit", "weather"]).collect()}
    assert got == {("laps", "failed"): ("WARNING", 1), ("pit", "not_found"): ("INFO", 1), ("weather", "never_recorded"): ("WARNING", 2), ("drivers", "not_targeted"): ("INFO", 2)}
    findings = spark.createDataFrame([("laps", "f", "types", "a", "wrong_type", "ERROR", 2)], "endpoint string, file string, rule string, field string, finding string, severity string, n long")
    status = {(r.endpoint, r.rule): r.status for r in quality.report(findings, sessions.select(F.lit("laps").alias("endpoint")), ["types", "values"]).collect()}
    assert status == {("laps", "types"): "FAIL", ("laps", "values"): "PASS"} and quality.overall(findings).first().status == "FAIL"
    assert quality.sampling_disclosed(None, 1, 2) == [] and quality.sampling_disclosed(5, 1, 2)[0]["severity"] == "WARNING"


def test_scalars(spark):
    df = spark.createDataFrame([("1.5", "2023-03-05T15:00:00.123456Z", 2.5), ("1.5d", "2023", 3.5), ("NaN", "2023-13-01", float("nan")), (" -2e3 ", "2023-03-05", None)], "n string, t string, x double")
    got = df.select(fn.number(F.col("n")), fn.instant(F.col("t")).isNotNull(), fn.whole(F.col("x"))).collect()
    assert [tuple(r) for r in got] == [(1.5, True, 2), (None, False, 4), (None, False, None), (-2000.0, True, None)]
    band = fn.band(F.col("x"), low=2.5, above_low=True, plausible=(0, 3))
    assert [r[0] for r in df.select(band).collect()][:2] == ["below", "implausible"] and df.select(fn.close(F.lit(None).cast("double"), F.lit(None).cast("double"))).first()[0]


def test_limiter_and_retries():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limiter = rest.Limiter(2, 3, lambda: now[0], sleep)
    for _ in range(4):
        limiter.acquire()
    assert slept == [1.0, 59.0]
    answers = [(503, {}, b""), (429, {"Retry-After": "7"}, b""), (200, {}, b'[{"a": 1}]')]
    waits = []
    assert rest.fetch("u", rest.Limiter(99, 99), lambda url: answers.pop(0), sleep=waits.append) == [{"a": 1}]
    assert waits[1] == 7.0 and rest.fetch("u", limiter, lambda url: (404, {}, b"")) == []
    with pytest.raises(OSError):
        rest.fetch("u", limiter, lambda url: (400, {}, b""))


def test_reader_pushes_filters_and_bounds_telemetry():
    reader = rest.TimingReader({"endpoint": "laps", "url": "http://x/v1", "session_key": "7"})
    asked = []
    reader.transport = lambda url: (asked.append(url), (200, {}, b'[{"session_key": 7, "driver_number": 1, "lap_number": 3}]'))[1]
    list(reader.pushFilters([rest.GreaterThan(("lap_number",), 2), rest.EqualTo(("unknown",), 1)]))
    assert list(reader.read(reader.partitions()[0]))[0][:4] == (7, 1, 3, 0) and asked == ["http://x/v1/laps?session_key=7&lap_number>2"]
    with pytest.raises(ValueError):
        rest.TimingReader({"endpoint": "car_data", "url": "u"}).partitions()
    assert len(rest.TimingReader({"endpoint": "car_data", "url": "u", "drivers": "1,44"}).partitions()) == 1


def test_ingestion_reads_each_document_once(spark, root, tmp_path):
    table, state = f"file://{tmp_path}/t", f"file://{tmp_path}/c"
    for _ in range(2):
        ingest.ingest(spark, root, table, state).awaitTermination()
    rows = spark.read.parquet(table)
    assert rows.where("record is not null").count() == envelopes.records(envelopes.discover(spark, root)).count()
    assert rows.where("not readable").count() == 1


def test_stream_and_batch_windows_agree(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(2).write.parquet(f"file://{tmp_path}/e")
    stream = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/e")
    q = ingest.window_counts(stream, "ts", "event_type", lateness="60 days").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(spark.table("windows").collect()) == sorted(ingest.window_counts(events, "ts", "event_type").collect())


def test_telemetry_fans_out_over_a_sessions_drivers():
    asked = []

    def feed(url):
        asked.append(url)
        return 200, {}, b'[{"driver_number": 44}, {"driver_number": 1}]' if "/drivers?" in url else b'[{"speed": 300}]'

    reader = rest.TimingReader({"endpoint": "car_data", "url": "http://x/v1", "session_keys": "7,8"})
    reader.transport = feed
    (only,) = reader.partitions()  # one partition, so one limiter for all requests
    list(reader.pushFilters([rest.GreaterThan(("session_key",), 2), rest.GreaterThan(("session_key",), 2)]))
    assert len(list(reader.read(only))) == 4
    assert [u.rsplit("/", 1)[1] for u in asked[:3]] == ["drivers?session_key>2&session_key=7", "car_data?session_key>2&session_key=7&driver_number=1", "car_data?session_key>2&session_key=7&driver_number=44"]


def test_saved_package_scores_alike_and_refuses_changes(spark, tmp_path):
    from tideline.operators import encode, regress
    from tideline.plans import scoring

    rows = spark.range(50).selectExpr("cast(id as double) / 3 as a", "if(id % 4 = 0, null, cast(id % 7 as double)) as b", "concat('k', id % 3) as c", "id * 1.7 + 2 as y")
    encoder = encode.fit(rows, ["a", "b"], ["c"])
    model = regress.least_squares(encoder.apply(rows, "y"), encoder.names, "y")
    contract, folder = scoring.Contract.of(encoder, []), f"file://{tmp_path}/pkg"
    scoring.save_package(spark, folder, contract, encoder, model, {"rows": 50})
    again = scoring.load_package(spark, folder)
    assert again == (contract, encoder, model)
    assert scoring.provenance(spark, folder, {"rows": 50}) == {"rows": 50}
    with pytest.raises(ValueError, match="elsewhere: rows"):
        scoring.provenance(spark, folder, {"rows": 51})
    (tmp_path / "pkg" / "model.json").write_text('{"intercept": 0, "coefficients": {}}')
    for crc in tmp_path.glob("pkg/.model.json.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="changed"):
        scoring.load_package(spark, folder)
    with pytest.raises(ValueError, match="not published"):
        scoring.load_package(spark, f"file://{tmp_path}/none")
