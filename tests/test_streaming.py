"""Stateful streams against their batch forms, with shuffled arrivals and restarts."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tideline.operators import align as batch
from tideline.streaming import align

from conftest import SF


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(key, old)


def season(spark):
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("date", F.col("ts").cast("timestamp")).withColumn("user_id", F.col("user_id") % 6)
    laps = e.where("event_type = 'signup'").selectExpr("user_id", "date AS lap_start", "if(event_id % 9 = 0, null, value * 60) AS lap_seconds", "cast(row_number() over (partition by user_id order by date) as long) AS lap_number")
    return laps, e.where("event_type in ('view', 'click')").select("user_id", "event_id", "date", "value")


def test_stream_of_open_windows_equals_the_batch_join(rocks, tmp_path):
    spark = rocks
    laps, records = season(spark)
    windows = batch.interval_windows(laps, ["user_id"], ["lap_number"], "lap_start", "lap_seconds", "lap")
    want = batch.assign_to_windows(records, windows, "date", "lap_start", "lap_end", ["user_id"], ["lap_number"]).select("user_id", "event_id", "date", "value", F.col("lap_number").cast("long").alias("lap_number"))
    want = sorted(map(tuple, want.collect()))
    assert 100 < len(want) < records.count()

    # Rows of both kinds arrive up to a day late, in six files of each; the last lap is far ahead and lets the watermark pass all.
    rng, folders = np.random.default_rng(0), {}
    last = pd.DataFrame({"user_id": [-1], "lap_start": [pd.Timestamp("2031-01-01")], "lap_seconds": [1.0], "lap_number": [1]})
    for name, df, at in (("laps", laps, "lap_start"), ("records", records, "date")):
        rows = df.toPandas()
        come = rows[at] + pd.to_timedelta(rng.integers(0, 86_400, len(rows)), "s")
        part = pd.cut(come, pd.date_range("2023-12-31", "2024-02-02", 7), labels=False)
        folders[name] = [rows[part == k].sample(frac=1, random_state=k) for k in range(6)]
    folders["laps"][5] = pd.concat([folders["laps"][5], last])

    def arrive(parts):
        for name, df in (("laps", laps), ("records", records)):
            for k in parts:
                path = tmp_path / name / f"part-{k}.parquet"
                os.makedirs(path.parent, exist_ok=True)
                folders[name][k].to_parquet(path, coerce_timestamps="us", index=False)

    def run():
        read = lambda name, df: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/{name}")
        found = align.assign_to_open_windows(read("records", records), read("laps", laps), "date", "lap_start", "lap_seconds", "lap_number", ["user_id"], "3 days", 90 * 86_400)
        q = found.writeStream.format("parquet").option("path", f"file://{tmp_path}/out").option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start()
        q.awaitTermination()

    arrive(range(3))
    run()
    half = spark.read.parquet(f"file://{tmp_path}/out").count()
    assert 0 < half < len(want)
    arrive(range(3, 6))
    run()  # a new query over the same checkpoint
    got = spark.read.parquet(f"file://{tmp_path}/out").select("user_id", "event_id", "date", "value", "lap_number")
    assert sorted(map(tuple, got.collect())) == want


class Timers:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


class Held(list):
    """A state variable in memory."""

    def get(self):
        return iter(self) if not (len(self) == 1 and len(self[0]) == 1) else self[0]

    def put(self, rows):
        self[:] = rows

    def update(self, row):
        self[:] = [row]

    def exists(self):
        return bool(self)


class Handle:
    def __init__(self):
        self.timers = set()

    def getListState(self, *_):
        return Held()

    getValueState = getListState

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_state_keeps_the_open_lap_only_and_gives_up_after_the_patience():
    p, handle = align.OpenWindows(patience=60_000_000), Handle()
    p.init(handle)
    s = 1_000_000
    told = lambda found: [tuple(r) for df in found for r in df.itertuples(index=False)]
    assert told(p.decided([(i * 100 * s, i, 100.0) for i in range(5)], [(450 * s, "late"), (120 * s, "b"), (520 * s, "after")], Timers(0))) == []
    assert told(p.decided([], [], Timers(200_000))) == [("b", 1)]
    assert [x[1] for x in p.laps] == [2, 3, 4] and len(handle.timers) == 1
    assert told(p.decided([], [], Timers(530_000))) == [("late", 4)]
    assert [x[1] for x in p.laps] == [4] and [x[1] for x in p.waiting] == ["after"] and handle.timers == {580_001}
    assert told(p.decided([(570 * s, 5, None)], [], Timers(560_000))) == [("after", 4)]  # a next lap makes the last one longer
    assert told(p.decided([], [(900 * s, "lost")], Timers(1_000_000))) == [] and not p.waiting
