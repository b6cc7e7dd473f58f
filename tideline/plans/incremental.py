"""Which sessions need work: digests of what each stage read and wrote, compared as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.sources import archive, sinks

STAGES = ["raw", "laps", "features"]


def session_digests(table: DataFrame, stage: str, session: str = "session_key") -> DataFrame:
    """(session, stage, rows, digest): a digest of each session's rows that does not
    depend on their order: one aggregate over hashes of rows (PV-01, PV-09)."""
    row = F.xxhash64(F.to_json(F.struct(*sorted(table.columns)), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    return table.groupBy(F.col(session).alias("session_key")).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).cast("string").alias("digest")).select("session_key", F.lit(stage).alias("stage"), "rows", "digest")


def reuse(now: DataFrame, recorded: DataFrame, stages: list[str] = STAGES) -> DataFrame:
    """(session_key, reusable, first_changed): a session is reusable if every stage is
    recorded and unchanged; else the first stage that is not (PV-02, PV-08, JN-17)."""
    known = recorded.select("session_key", "stage", F.col("digest").alias("recorded"))
    every = now.select("session_key").distinct().select("session_key", F.posexplode(F.array(*map(F.lit, stages))).alias("n", "stage"))
    state = every.join(now.select("session_key", "stage", "digest"), ["session_key", "stage"], "left").join(known, ["session_key", "stage"], "left")
    changed = ~F.coalesce(F.col("digest") == F.col("recorded"), F.lit(False))
    return state.groupBy("session_key").agg((~F.bool_or(changed)).alias("reusable"), F.min_by("stage", F.when(changed, F.col("n"))).alias("first_changed"))


def completeness(sessions: DataFrame, verified: DataFrame, years: list[int]) -> DataFrame:
    """(year, sessions, verified, complete) for each required season: complete if it has
    sessions and all are verified (AG-25, PV-04)."""
    spark = sessions.sparkSession
    wanted = spark.createDataFrame([(y,) for y in years], "year int")
    marked = sessions.join(verified.select("session_key").distinct().withColumn("ok", F.lit(True)), "session_key", "left")
    found = marked.groupBy("year").agg(F.count(F.lit(1)).alias("sessions"), F.count("ok").alias("verified"))
    counted = wanted.join(found, "year", "left").na.fill(0, ["sessions", "verified"])
    return counted.withColumn("complete", (F.col("sessions") > 0) & (F.col("sessions") == F.col("verified")))


def missing_artifacts(expected: DataFrame, stored: DataFrame, absences: DataFrame, on: list[str]) -> DataFrame:
    """Expected documents that are neither stored nor known to be absent at the source (PV-03, PV-07, JN-18)."""
    return expected.join(stored.select(*on).distinct(), on, "left_anti").join(absences.select(*on).distinct(), on, "left_anti")


def config_fingerprint(config: dict, ignored: dict[str, set[str]]) -> str:
    """A digest of a configuration's sections without what does not change results (PV-05).

    ``ignored`` names those settings by section, such as years and overwrite, which only
    say what a run covers.  The order of keys does not matter.
    """
    return sinks.digest({section: {k: v for k, v in values.items() if k not in ignored.get(section, ())} if isinstance(values, dict) else values for section, values in config.items()})


def write_plan(units: DataFrame, uri: str) -> int:
    """Write a plan's work units, some hundred sessions, as one JSON document that appears whole; the number of units (SNK-11)."""
    rows = [r.asDict() for r in units.orderBy(*units.columns).collect()]
    archive.write_json(uri, sinks.canonical_json({"units": rows}), replace=True)
    return len(rows)
