"""The backward as-of join of records and laps as a stream.

A driver's state holds the laps from the open one on and the records that wait.  A
record is decided once the watermark has passed it: every lap that began before it
is then known, whatever order rows arrived in.  State lives in Spark's state store and
checkpoints, so a restarted query goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Timestamps in the state are whole texts.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class OpenWindows(StatefulProcessor):
    """Laps (start, number, duration) and waiting records (t, payload) of one driver; times in microseconds."""

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.laps = handle.getListState("laps", "start long, number long, duration double")
        self.waiting = handle.getListState("waiting", "t long, payload string")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        laps, waiting = [], []
        for some in rows:
            for t, number, duration, payload in zip(some["micros"], some["number"], some["duration"], some["payload"]):
                if payload is None:
                    laps.append((int(t), int(number), None if pd.isna(duration) else float(duration)))
                else:
                    waiting.append((int(t), payload))
        yield from self.decided(laps, waiting, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        yield from self.decided([], [], timerValues)

    def decided(self, laps: list[tuple], waiting: list[tuple], timers) -> Iterator[pd.DataFrame]:
        """Take in new rows and hand out the records that the watermark has passed."""
        now = max(0, timers.getCurrentWatermarkInMs()) * 1000
        laps = sorted([*map(tuple, self.laps.get()), *laps], key=lambda x: x[:2])
        waiting = sorted([*map(tuple, self.waiting.get()), *waiting], key=lambda x: x[0])
        out, held, i = [], [], -1
        for t, payload in waiting:
            while i + 1 < len(laps) and laps[i + 1][0] <= t:
                i += 1
            if t >= now:
                held.append((t, payload))
            elif i >= 0 and (i + 1 < len(laps) or laps[i][2] is not None and not pd.isna(laps[i][2]) and t < laps[i][0] + round(laps[i][2] * 1e6)):
                out.append((payload, laps[i][1]))
            elif i >= 0 and t + self.patience >= now:  # past the last lap's time: a next lap would still make it longer
                held.append((t, payload))
        oldest = min([now, *(t for t, _ in held)])
        first = max((j for j, x in enumerate(laps) if x[0] <= oldest), default=0)
        self.put(self.laps, laps[first:])
        self.put(self.waiting, held)
        self.wake([t if t >= now else t + self.patience for t, _ in held])
        if out:
            yield pd.DataFrame(out, columns=["payload", "number"])

    def put(self, state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def wake(self, times: list[int]) -> None:
        """One timer, for the first record that waits."""
        last = self.timer.get()[0] if self.timer.exists() else None
        at = min(times) // 1000 + 1 if times else None
        if last is not None and last != at:
            self.handle.deleteTimer(last)
            self.timer.clear()
        if at is not None and last != at:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def close(self) -> None:
        pass


def assign_to_open_windows(
    records: DataFrame, laps: DataFrame, at: str, start: str, duration: str, number: str, by: list[str], lateness: str = "10 minutes", patience_seconds: float = 6 * 3600
) -> DataFrame:
    """A stream of ``records`` inside a lap with the lap's ``number`` (JN-01, WN-01), as
    ``interval_windows`` and ``assign_to_windows`` give them for batches.

    A lap lasts until the driver's next one starts, else for ``duration`` seconds.  Laps of
    a driver start in the order of their numbers.  Rows may come up to ``lateness`` behind the
    latest one; records after a driver's last known lap wait ``patience_seconds`` for
    another, which bounds the state, and are then dropped, as are rows without a time, a
    number or a key.  ``records`` keep all their columns; ``number`` is a long.  The
    session's state store must be RocksDB's, as for any query with timers.
    """
    keyed = lambda df: df.na.drop(subset=by)
    none = lambda kind: F.lit(None).cast(kind)
    a = keyed(records.where(F.col(at).isNotNull())).select(*by, F.col(at).cast("timestamp").alias("t"), none("long").alias("number"), none("double").alias("duration"), F.to_json(F.struct(*records.columns), _JSON).alias("payload"))
    b = keyed(laps.where(F.col(start).isNotNull() & F.col(number).isNotNull())).select(*by, F.col(start).cast("timestamp").alias("t"), F.col(number).cast("long").alias("number"), F.col(duration).cast("double").alias("duration"), none("string").alias("payload"))
    both = a.unionByName(b).withColumn("micros", F.unix_micros("t")).withWatermark("t", lateness)
    found = both.groupBy(*by).transformWithStateInPandas(OpenWindows(int(patience_seconds * 1e6)), "payload string, number long", "Append", "EventTime")
    return found.select(F.from_json("payload", records.schema, _JSON).alias("r"), "number").select("r.*", F.col("number").alias(number))
