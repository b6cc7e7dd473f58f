"""Windows and as-of joins on a clock where every lap takes 100 s."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators import align, history, reduce

START = datetime(2023, 3, 5, 15)


def at(seconds):
    return START + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def laps(spark):
    rows = [(d, n, at((n - 1) * 100), 100.0) for d in (1, 44) for n in (1, 2, 3)]
    return spark.createDataFrame(rows, "driver int, lap int, start timestamp, seconds double")


@pytest.fixture(scope="module")
def windows(laps):
    return align.interval_windows(laps, ["driver"], ["lap"], "start", "seconds", "lap")


def test_windows_tile(windows):
    got = {(r.driver, r.lap): r for r in windows.collect()}
    assert all(got[d, n].lap_end == at(n * 100) for d in (1, 44) for n in (1, 2, 3))
    assert [got[1, n].is_last for n in (1, 2, 3)] == [False, False, True] and all(r.has_complete_window for r in got.values())


def test_window_without_next_start_or_duration(spark):
    rows = [(1, 1, at(0), 50.0), (1, 2, None, 60.0), (1, 3, at(200), None)]
    got = {r.lap: r for r in align.interval_windows(spark.createDataFrame(rows, "driver int, lap int, start timestamp, seconds double"), ["driver"], ["lap"], "start", "seconds", "lap").collect()}
    assert got[1].lap_end == at(50) and got[1].is_last and not got[2].has_complete_window and not got[3].has_complete_window


def test_containment_is_half_open(spark, windows):
    rows = [(1, at(s), float(s)) for s in (-5, 0, 99, 100, 299, 300, 400)] + [(44, at(10), 1.0), (7, at(10), 1.0), (1, None, 1.0)]
    records = spark.createDataFrame(rows, "driver int, date timestamp, v double")
    got = align.assign_to_windows(records, windows, "date", "start", "lap_end", ["driver"], ["lap"], complete=F.col("has_complete_window")).collect()
    assert sorted((r.driver, r.v, r.lap) for r in got) == [(1, 0.0, 1), (1, 99.0, 1), (1, 100.0, 2), (1, 299.0, 3), (44, 1.0, 1)]


@pytest.mark.parametrize("bucket", [None, "minute", "hour"])
def test_last_value_includes_ties_and_takes_the_later_of_equals(spark, bucket):
    left = spark.createDataFrame([(1, at(0)), (1, at(100)), (1, at(5000)), (2, at(100)), (None, at(100)), (1, None)], "driver int, t timestamp")
    right = spark.createDataFrame([(1, at(-10), 5, 0), (1, at(100), 6, 1), (1, at(100), 7, 2), (1, None, 8, 3), (None, at(0), 9, 4)], "driver int, date timestamp, position int, pos int")
    got = align.asof_last(left, right, "t", "date", ["driver"], ["pos"], bucket=bucket).collect()
    assert sorted((str(r.driver), str(r.t), r.match and r.match.position) for r in got) == sorted([("1", str(at(0)), 5), ("1", str(at(100)), 7), ("1", str(at(5000)), 7), ("2", str(at(100)), None), ("None", str(at(100)), None), ("1", "None", None)])


def test_tolerance_is_inclusive_and_ages_are_kept(spark):
    left = spark.createDataFrame([(1, at(120)), (2, at(121)), (3, at(-1))], "lap int, t timestamp")
    right = spark.createDataFrame([(at(0), 20.0)], "date timestamp, air double")
    got = {r.lap: (r.age_s, r.match and r.match.air) for r in align.asof_within(left, right, "t", "date", 120, bucket="minute").collect()}
    assert got == {1: (120.0, 20.0), 2: (None, None), 3: (None, None)}


def test_integer_ranges(spark):
    laps = spark.createDataFrame([(1, n) for n in range(1, 8)], "driver int, lap int")
    stints = spark.createDataFrame([(1, 1, 3, "SOFT"), (1, 4, 5, "HARD"), (1, 7, None, "WET")], "driver int, low int, high int, compound string")
    got = {r.lap: r.range and r.range.compound for r in align.range_confirmed(laps, stints, "lap", "low", "high", ["driver"]).collect()}
    assert got == {1: "SOFT", 2: "SOFT", 3: "SOFT", 4: "HARD", 5: "HARD", 6: None, 7: "WET"}


def test_last_record_keeps_nulls_of_that_record(spark):
    rows = spark.createDataFrame([(1, 1, 5.0, False), (1, 2, None, True)], "g int, t int, gap double, lapped boolean")
    assert reduce.last_record(rows, ["g"], ["t"], ["gap", "lapped"], "n").first() == (1, None, True, 2)


def test_first_known_skips_nulls_by_column(spark):
    rows = spark.createDataFrame([(1, 1, None, 7.0), (1, 2, 3.0, None)], "g int, t int, a double, b double")
    assert reduce.first_known(rows, ["g"], ["t"], ["a", "b"]).first() == (1, 3.0, 7.0)


def test_target_needs_the_next_number(spark):
    rows = spark.createDataFrame([(1, 1, 10.0), (1, 2, 11.0), (1, 4, 12.0), (2, 1, 9.0)], "g int, lap int, v double")
    got = {(r.g, r.lap): r.t for r in history.add_target(rows, ["g"], "lap", "v", "t").collect()}
    assert got == {(1, 1): 11.0, (1, 2): None, (1, 4): None, (2, 1): None}
    why = history.target_reasons(history.add_target(rows, ["g"], "lap", "v", "t"), ["g"], "lap", "v", "t").first()
    assert (why.rows, why.with_target, why.last_of_group, why.gap_in_numbers) == (4, 1, 2, 1)


def test_history_of_three_rows(spark):
    rows = spark.createDataFrame([(1, n, v) for n, v in ((1, 10.0), (2, None), (3, 13.0), (4, 16.0))], "g int, lap int, v double")
    got = {r.lap: r for r in history.add_history(rows, ["g"], ["lap"], "v", "v").collect()}
    assert got[1].v_roll_std_3 is None and got[3].v_roll_mean_3 == 11.5 and got[4].v_roll_mean_3 == 14.5 and got[4].v_expanding_mean == 13.0
    assert got[3].v_prev_1 is None and got[4].v_delta_1 == 3.0 and got[4].v_vs_roll_mean_5 == 3.0


def test_order_inversions_compare_with_the_last_readable(spark):
    rows = spark.createDataFrame([(1, p, v) for p, v in enumerate([3, None, 2, 5, 4])], "g int, pos int, v int")
    assert history.order_inversions(rows, ["g"], "pos", "v").first().inversions == 2
