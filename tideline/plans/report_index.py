"""An inverted index of reports: which report mentions which session, the newest first.

Reports of all stages are JSON documents of different shapes.  Each is parsed once to
VARIANT and exploded to one row for each session that it mentions, with the part
about that session and the few fields that judge the whole report, never the report
itself; the newest report of a session and stage is then the first of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Stages by the name of the pipeline in their reports.
STAGES = {"historical_extraction": "m2", "data_validation": "m3", "data_consolidation": "m4", "feature_engineering": "m5"}
INDEX = ["stage", "year", "meeting_key", "session_key", "name", "part", "timed", "processed", "global_status"]


def _get(of: str | Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(of, f"$.{path}", kind)


def index(reports: DataFrame) -> DataFrame:
    """(stage, year, meeting_key, session_key, name, part, timed, processed, global_status) from
    (name, value), value a JSON text.

    An extraction manifest mentions the sessions of its entries, a validation report the
    session that it was filtered by, other reports those they list (AG-12, PV-10).
    Texts that are no JSON object, reports of unknown pipelines and mentions without
    year or session are left out; a session that one report mentions often stands once for each.
    ``timed``: the report holds both times; ``processed``: it lists the session as processed.
    """
    stage = F.create_map(*[F.lit(x) for pair in STAGES.items() for x in pair])
    parsed = reports.select("name", F.try_parse_json("value").alias("report")).withColumn("stage", F.element_at(stage, _get("report", "pipeline_name"))).where("stage is not null")
    one = F.array(_get("report", "source.filter", "variant"))
    many = lambda path: F.coalesce(_get("report", path, "array<variant>"), F.array().cast("array<variant>"))
    parts = F.when(F.col("stage") == "m3", one).when(F.col("stage") == "m2", many("entries")).otherwise(many("sessions"))
    none = F.lit(None).cast("variant")
    done = F.when(F.col("stage") == "m2", _get("report", "sessions_processed", "array<bigint>"))
    mention = lambda done, session, part: F.struct(done.alias("done"), session.cast("long").alias("session_key"), part.alias("part"))
    told = F.concat(
        F.transform(parts, lambda p: mention(F.lit(False), _get(p, "session_key", "long"), p)),
        F.coalesce(F.transform(done, lambda s: mention(F.lit(True), s, none)), F.array().cast("array<struct<done:boolean,session_key:bigint,part:variant>>")),
    )
    timed = _get("report", "started_at").isNotNull() & _get("report", "finished_at").isNotNull()
    rows = parsed.select(F.monotonically_increasing_id().alias("_row"), "stage", "name", timed.alias("timed"), _get("report", "global_status").alias("global_status"), told.alias("_told"))
    each = rows.select("*", F.explode("_told").alias("_one")).select("_row", "stage", "name", "timed", "global_status", "_one.*").where("session_key is not null")
    processed = each.withColumn("processed", F.max("done").over(Window.partitionBy("_row", "session_key"))).where("not done")
    keyed = processed.withColumns({"year": _get("part", "year", "int"), "meeting_key": _get("part", "meeting_key", "long")})
    return keyed.where("year is not null").select(*INDEX)


def newest(indexed: DataFrame) -> DataFrame:
    """The newest report by name of each stage, season and session, with one of its parts."""
    pick = F.row_number().over(Window.partitionBy("stage", "year", "session_key").orderBy(F.desc("name"), F.to_json("part")))
    return indexed.where("name is not null").withColumn("_n", pick).where("_n = 1").select(*INDEX)


def judged(found: DataFrame) -> DataFrame:
    """``found`` reports with ``reason``: why a report does not prove its stage, null where it does (PV-10).

    A manifest needs both times and must list the session as processed; a validation
    must have passed or warned; other reports must have written the session's table
    without an error or a blocking failure.
    """
    m2 = F.when(~F.col("timed"), "no execution times").when(~F.col("processed"), "session not processed")
    m3 = F.when(~F.coalesce(F.col("global_status").isin("PASS", "WARNING"), F.lit(False)), "validation failed")
    blocked = F.coalesce(F.size(_get("part", "blocking_failures", "array<variant>")), F.lit(0)) > 0
    rest = F.when(_get("part", "error").isNotNull() | blocked, "not processed").when(_get("part", "output_path").isNull(), "no output")
    return found.withColumn("reason", F.when(F.col("stage") == "m2", m2).when(F.col("stage") == "m3", m3).otherwise(rest))
