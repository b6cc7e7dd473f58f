"""Trees of digests, the index of reports, and counters of a pass."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.plans import counted, digests, lap_table, report_index
from tideline.sources import envelopes


def stages(spark, n=3000):
    raw = spark.range(n).select((F.lit(2021) + F.col("id") % 2).alias("year"), (F.col("id") % 30).alias("session_key"), F.col("id").alias("k"), (F.col("id") * 1.5).alias("v"), F.when(F.col("id") % 7 != 0, "x").alias("t"))
    return {"m3": raw, "m4": raw.where("k % 2 = 0").withColumn("w", F.lit(1)), "m5": raw.where("k % 4 = 0")}


def test_one_changed_row_is_named_after_reading_few_digests(spark, tmp_path):
    now, key = stages(spark, 20_000), ["session_key", "k"]
    before = dict(now)
    before["m4"] = now["m4"].withColumn("v", F.when(F.col("k") == 1234, -1.0).otherwise(F.col("v")))
    for tables, name in ((now, "now"), (before, "before")):
        digests.write_tree({s: t.repartition(3) for s, t in tables.items()}, f"file://{tmp_path}/{name}", key)
    found = digests.compare(spark, f"file://{tmp_path}/now", f"file://{tmp_path}/before")
    whole = sum(digests.level(spark, f"file://{tmp_path}/now", n).count() for n in range(5))
    assert found.buckets.count() == 1 and found.read <= 2 * (3 + 2 + 15 + 2 * digests.FANOUT) < whole / 50
    assert [tuple(r) for r in digests.changed_rows(found, now, before, key).collect()] == [("m4", 1234 % 30, 1234, "changed")]
    first = {r.session_key: r.first_changed for r in digests.first_changed(found, list(now), now["m3"]).collect()}
    assert first == {s: "m4" if s == 1234 % 30 else None for s in range(30)}


def test_equal_trees_read_their_roots_only(spark, tmp_path):
    now, key = stages(spark, 200), ["session_key", "k"]
    for name, parts in (("a", 2), ("b", 5)):
        digests.write_tree({s: t.repartition(parts) for s, t in now.items()}, f"file://{tmp_path}/{name}", key)
    found = digests.compare(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/b")
    assert found.read == 6 and found.buckets.isEmpty() and digests.changed_rows(found, now, now, key).isEmpty()
    digests.write_tree({s: t.limit(0) for s, t in now.items()}, f"file://{tmp_path}/none", key)
    gone = digests.compare(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/none")
    assert digests.changed_rows(gone, now, {s: t.limit(0) for s, t in now.items()}, key).groupBy("change").count().collect() == [("added", 200 + 100 + 50)]


def test_null_keys_and_repeated_rows(spark, tmp_path):
    schema, key = "year int, session_key long, k long, v string", ["session_key", "k"]
    a = {"m3": spark.createDataFrame([(None, None, 1, "a"), (2021, 5, None, "b"), (2021, 5, None, "b"), (2021, 5, 2, None)], schema)}
    b = {"m3": spark.createDataFrame([(None, None, 1, "z"), (2021, 5, None, "b"), (2021, 5, 2, None)], schema)}
    for t, name in ((a, "a"), (b, "b")):
        digests.write_tree(t, f"file://{tmp_path}/{name}", key)
    found = digests.compare(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/b")
    got = {tuple(r)[1:] for r in digests.changed_rows(found, a, b, key).collect()}
    assert got == {(None, 1, "changed"), (5, None, "changed")}  # a row more under one key is a change


def test_reports_of_all_shapes(spark):
    s = {"year": 2023, "meeting_key": 1, "session_key": 7}
    rows = [
        ("m2/1", {"pipeline_name": "historical_extraction", "entries": [s, s, {"year": 2023}], "sessions_processed": [7], "started_at": "a", "finished_at": "b"}),
        ("m2/2", {"pipeline_name": "historical_extraction", "entries": [{**s, "session_key": 8}], "sessions_processed": []}),
        ("m3/1", {"pipeline_name": "data_validation", "global_status": "PASS", "source": {"filter": s}}), ("m3/2", {"pipeline_name": "data_validation", "global_status": "PASS", "source": {}}),
        ("m4/1", {"pipeline_name": "data_consolidation", "sessions": [{**s, "output_path": "x", "blocking_failures": []}]}), ("m4/2", {"pipeline_name": "data_consolidation", "sessions": [{**s, "output_path": "x", "blocking_failures": ["g"]}]}),
        ("m5/1", {"pipeline_name": "feature_engineering", "sessions": [{**s, "output_path": None}, "junk", None]}), ("x", {"pipeline_name": "other"}), ("y", [1]),
    ]
    reports = spark.createDataFrame([(n, json.dumps(v)) for n, v in rows] + [("z", "{broken"), ("n", None)], "name string, value string")
    indexed = report_index.index(reports)
    assert indexed.count() == 2 + 1 + 1 + 2 + 1
    got = {(r.stage, r.session_key): (r.name, r.reason) for r in report_index.judged(report_index.newest(indexed)).collect()}
    assert got == {("m2", 7): ("m2/1", None), ("m2", 8): ("m2/2", "no execution times"), ("m3", 7): ("m3/1", None), ("m4", 7): ("m4/2", "not processed"), ("m5", 7): ("m5/1", "no output")}


@pytest.mark.parametrize("drivers", [(1, 44), ()])
def test_totals_come_from_the_pass_that_writes(spark, tmp_path, drivers):
    stamp = lambda s: f"2023-03-05T15:{s // 60:02d}:{s % 60:02d}Z"
    laps = lap_table.laps_with_windows(spark.createDataFrame([(7, float(d), float(n), stamp((n - 1) * 100), 100.0, n) for d in (1, 44) for n in (1, 2)], "session_key long, driver_number double, lap_number double, t string, lap_duration double, pos int").withColumn("date_start", F.col("t").cast("timestamp")).drop("t"))
    folder = tmp_path / "endpoint=car_data/year=2023/session_key=7"
    folder.mkdir(parents=True)
    for d in drivers:
        samples = [{"session_key": 7, "driver_number": d, "date": stamp(s), "speed": 100, "rpm": 1, "n_gear": g, "throttle": 5, "brake": 0, "drs": 0} for s, g in ((10, 3), (110, 9), (190, 4), (500, 2))]
        (folder / f"driver_{d}.json").write_text(json.dumps({"endpoint": "car_data", "data": [*samples, "junk", [1]]}))
    (folder / "driver_3.json").write_text("{broken")
    table, totals = counted.telemetry_with_totals(envelopes.discover(spark, f"file://{tmp_path}"), laps)
    n = len(drivers)
    assert totals == {"files": n, "files_unreadable": 1, "samples_read": 4 * n, "samples_in_window": 3 * n, "invalid_samples": n}
    assert table.count() == 2 * n and (table.agg(F.sum("car_data_samples")).first()[0] or 0) == 3 * n


def test_the_index_carries_no_report_and_judges_reports_in_rows(spark):
    """A report of many sessions would stand once for each of them; its rows of one name are one report."""
    s = lambda k: {"year": 2023, "meeting_key": 1, "session_key": k}
    m2 = lambda entries, done: json.dumps({"pipeline_name": "historical_extraction", "entries": [s(k) for k in entries], "sessions_processed": done, "started_at": "a", "finished_at": "b"})
    reports = spark.createDataFrame([("m2/1", m2(range(0, 500), list(range(0, 500, 2)))), ("m2/1", m2(range(500, 1000), [None, *range(500, 1000, 2), 3])), ("m2/0", m2([7], [7])), (None, m2([8], []))], "name string, value string")
    indexed = report_index.index(reports)
    assert "report" not in indexed.columns and indexed.count() == 1002
    got = {r.session_key: (r.name, r.reason) for r in report_index.judged(report_index.newest(indexed)).collect()}
    assert got == {k: ("m2/1", "session not processed" if k % 2 else None) for k in range(1000)}
