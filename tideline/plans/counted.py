"""Counters taken in the same pass that writes a table, by metrics on its plan."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.operators.specs import BRAKE_MOST, GEAR_MOST, THROTTLE_MOST
from tideline.plans import lap_table
from tideline.sources import envelopes, tables
from tideline.sources.scratch import keep


@dataclass
class Counters:
    """Observed numbers by name; they are there once the plan has run."""

    parts: list[Observation] = field(default_factory=list)

    def on(self, rows: DataFrame, **counts: Column) -> DataFrame:
        """``rows`` with aggregates of them counted on their way."""
        self.parts.append(Observation())
        return rows.observe(self.parts[-1], *[x.alias(name) for name, x in counts.items()])

    @property
    def values(self) -> dict[str, int]:
        return {k: v or 0 for part in self.parts for k, v in part.get.items()}


@contextmanager
def whole_plan(spark: SparkSession) -> Iterator[None]:
    """Keep branches that turn out empty in the plan, as their metrics would go with them; the session's setting comes back."""
    key, rule = "spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    before = spark.conf.get(key, None)
    spark.conf.set(key, f"{before},{rule}" if before else rule)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def telemetry_with_totals(documents: DataFrame, laps: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Telemetry by lap, written, and what its pass saw: files, files_unreadable, samples_read,
    samples_in_window, invalid_samples (AG-16, AG-27).

    ``documents`` are raw documents of telemetry; entries that are no objects are no
    samples.  The documents are read and parsed once: the totals come from the same
    scan.  Without documents all totals are 0.
    """
    seen = Counters()
    held = seen.on(envelopes.parsed(documents), files=F.count_if("readable"), files_unreadable=F.count_if(~F.col("readable")))
    records = held.where("readable and data is not null").select("endpoint", "year", "meeting_key", "session_key", "driver_number", "file", F.posexplode("data").alias("pos", "rec"))
    samples = seen.on(tables.typed(records, "car_data"), samples_read=F.count(F.lit(1)))
    inside = lap_table.inside_laps(samples, laps)
    wrong = F.coalesce((F.col("n_gear") > GEAR_MOST) | (F.col("throttle") > THROTTLE_MOST) | (F.col("brake") > BRAKE_MOST), F.lit(False))
    counted = seen.on(inside, samples_in_window=F.count(F.lit(1)), invalid_samples=F.count_if(wrong))
    with whole_plan(documents.sparkSession):
        return keep(lap_table.reduced_telemetry(counted)), seen.values
