"""Registered queries of what runs leave behind: digests of stages, reports and
their index, counters of a pass, archived documents and replaced sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import rounded
from tideline.plans import counted, digests, report_index
from tideline.plans.registry import query, table
from tideline.plans.source_queries import DOCUMENTS, KINDS, new_folder, raw_documents
from tideline.sources import archive, envelopes


def _stages(spark, sf_dir) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Three stages of one chain, now and as recorded: some rows of each have changed since, one user's are new, one's are gone."""
    e = table(spark, sf_dir, "events").select((F.lit(2020) + F.col("user_id") % 3).alias("year"), F.col("user_id").alias("session_key"), "event_id", "event_type", "value")
    changed = lambda m: F.when(F.col("event_id") % m == 0, F.col("value") + 1).otherwise(F.col("value"))
    now = {"raw": e, "laps": e.where("event_type = 'signup'"), "features": e.where("event_type = 'signup' and event_id % 2 = 0")}
    before = {"raw": now["raw"].withColumn("value", changed(997)).where("event_id <> 500"), "laps": now["laps"].withColumn("value", changed(331)), "features": now["features"].unionByName(now["features"].where("event_id % 500 = 0").withColumn("event_id", -1 - F.col("event_id")))}
    return now, before


_CHANGES = """
SELECT 'raw' AS stage, user_id AS session_key, event_id, CASE WHEN event_id = 500 THEN 'added' ELSE 'changed' END AS change FROM events WHERE event_id % 997 = 0 OR event_id = 500 UNION ALL
SELECT 'laps', user_id, event_id, 'changed' FROM events WHERE event_type = 'signup' AND event_id % 331 = 0 UNION ALL
SELECT 'features', user_id, -1 - event_id, 'removed' FROM events WHERE event_type = 'signup' AND event_id % 500 = 0
"""


def _compared(spark, sf_dir):
    now, before = _stages(spark, sf_dir)
    folders = [new_folder(spark) for _ in range(2)]
    for tables, folder in zip((now, before), folders):
        digests.write_tree(tables, folder, ["session_key", "event_id"])
    return now, before, digests.compare(spark, *folders)


@query(_CHANGES)
def changed_rows(spark, sf_dir):
    """Rows that differ between two states of three stages, found by descending trees of digests (PV-01, PV-08, PV-09, AG-26)."""
    now, before, found = _compared(spark, sf_dir)
    return digests.changed_rows(found, now, before, ["session_key", "event_id"])


@query(f"""
WITH c AS ({_CHANGES}), f AS (SELECT session_key, min(CASE stage WHEN 'raw' THEN 1 WHEN 'laps' THEN 2 ELSE 3 END) AS n FROM c GROUP BY session_key)
SELECT DISTINCT user_id AS session_key, n IS NULL AS reusable, CASE n WHEN 1 THEN 'raw' WHEN 2 THEN 'laps' WHEN 3 THEN 'features' END AS first_changed FROM events LEFT JOIN f ON f.session_key = user_id
""")
def session_chain(spark, sf_dir):
    """The first of three stages at which each session is not what was recorded (PV-02, PV-08, JN-17)."""
    now, _, found = _compared(spark, sf_dir)
    return digests.first_changed(found, list(now), now["raw"])


def _reports(spark, sf_dir) -> DataFrame:
    """(name, value): a report for each day and stage of the users seen that day, of different shapes and some
    flaws; a day's report comes in one row for each 4,096 user numbers, so no text grows with the input."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("user_id").alias("u"), (F.lit(2020) + F.col("user_id") % 3).alias("y"), "event_id")
    by_day = e.groupBy("day", "u", "y").agg(F.min("event_id").alias("i"))
    key = F.format_string('"year": %d, "meeting_key": 1, "session_key": %d', "y", "u")
    entry = F.concat(F.lit("{"), key, F.lit("}"))
    session = F.concat(F.lit("{"), key, F.when(F.col("i") % 7 == 0, ', "error": "x"').otherwise(""), F.when(F.col("i") % 5 == 0, ', "blocking_failures": ["g"]').otherwise(', "blocking_failures": []'), F.when(F.col("i") % 3 == 0, "").otherwise(', "output_path": "o"'), F.lit("}"))
    day = F.date_format("day", "yyyyMMdd")
    joined = lambda c: F.array_join(F.array_sort(F.collect_list(c)), ", ")
    times = F.when(F.dayofmonth("day") % 2 == 0, ', "started_at": "a", "finished_at": "b"').otherwise(', "started_at": "a"')
    runs = by_day.groupBy("day", F.floor(F.col("u") / 4096)).agg(joined(entry).alias("entries"), joined(session).alias("sessions"), F.array_join(F.transform(F.array_sort(F.collect_set(F.when(F.col("u") % 4 != 0, F.col("u")))), lambda u: u.cast("string")), ", ").alias("done"))
    m2 = runs.select(F.concat(F.lit("m2/"), day).alias("name"), F.concat(F.lit('{"pipeline_name": "historical_extraction", "entries": ['), "entries", F.lit('], "sessions_processed": ['), "done", F.lit("]"), times, F.lit("}")).alias("value"))
    status = F.element_at(F.array(F.lit("PASS"), F.lit("WARNING"), F.lit("FAIL")), (F.col("i") % 3 + 1).cast("int"))
    m3 = by_day.select(F.concat(F.lit("m3/"), day, F.lit("-"), F.col("u").cast("string")).alias("name"), F.concat(F.lit('{"pipeline_name": "data_validation", "global_status": "'), status, F.lit('", "source": {"filter": '), entry, F.lit("}}")).alias("value"))
    listed = [runs.select(F.concat(F.lit(f"{s}/"), day).alias("name"), F.concat(F.lit(f'{{"pipeline_name": "{p}", "sessions": ['), "sessions", F.lit("]}")).alias("value")) for s, p in (("m4", "data_consolidation"), ("m5", "feature_engineering"))]
    broken = runs.select(F.concat(F.lit("m9/"), day).alias("name"), F.lit('{"pipeline_name": "data_').alias("value"))
    return m2.unionByName(m3).unionByName(listed[0]).unionByName(listed[1]).unionByName(broken)


@query("""
WITH d AS (SELECT ts::DATE AS day, user_id AS u, min(event_id) AS i FROM events GROUP BY ALL), n AS (SELECT u, max(day) AS day, arg_max(i, day) AS i FROM d GROUP BY u), s(stage) AS (VALUES ('m2'), ('m3'), ('m4'), ('m5'))
SELECT stage, CAST(2020 + u % 3 AS INT) AS year, u AS session_key, stage || '/' || strftime(day, '%Y%m%d') || CASE stage WHEN 'm3' THEN '-' || u ELSE '' END AS name,
  CASE stage WHEN 'm2' THEN CASE WHEN day(day) % 2 = 1 THEN 'no execution times' WHEN u % 4 = 0 THEN 'session not processed' END WHEN 'm3' THEN CASE WHEN i % 3 = 2 THEN 'validation failed' END
    ELSE CASE WHEN i % 7 = 0 OR i % 5 = 0 THEN 'not processed' WHEN i % 3 = 0 THEN 'no output' END END AS reason
FROM n, s
""")
def newest_reports(spark, sf_dir):
    """The newest report of each session by stage, and why it does not prove it (PV-10)."""
    found = report_index.judged(report_index.newest(report_index.index(_reports(spark, sf_dir))))
    return found.select("stage", "year", "session_key", "name", "reason")


@query(f"""
WITH {DOCUMENTS}, w AS (SELECT *, lead(ts) OVER (PARTITION BY session_key, user ORDER BY ts) AS nx FROM (SELECT user_id % 40 AS session_key, user_id % 99 AS user, date_trunc('second', ts) AS ts, value FROM events WHERE event_type = 'signup')),
s AS (SELECT session_key, driver, date_trunc('second', ts) AS ts, event_id FROM ev WHERE endpoint = 'car_data' AND NOT broken AND event_id % 10 <> 0),
i AS (SELECT s.*, w.nx, w.value, w.ts AS start FROM s ASOF JOIN w ON w.session_key = s.session_key AND w.user = s.driver AND s.ts >= w.ts)
SELECT (SELECT count(DISTINCT (session_key, event_id // 100000)) FROM ev WHERE endpoint = 'car_data' AND NOT broken) AS files, (SELECT count(DISTINCT (session_key, event_id // 100000)) FROM ev WHERE endpoint = 'car_data' AND broken) AS files_unreadable,
  (SELECT count(*) FROM s) AS samples_read, (SELECT count(*) FROM i WHERE ts < coalesce(nx, start + to_microseconds(CAST(round(value * 1e6) AS BIGINT)))) AS samples_in_window, 0 AS invalid_samples
""")
def telemetry_totals(spark, sf_dir):
    """Files, samples read and samples in a lap, counted by the pass that reduces them (AG-16, AG-27)."""
    laps = table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        (F.col("user_id") % 40).alias("session_key"), (F.col("user_id") % 99).cast("double").alias("driver_number"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("date_start"), F.col("value").alias("lap_duration"), F.col("event_id").cast("double").alias("lap_number"), F.col("event_id").alias("pos"))
    from tideline.plans.lap_table import laps_with_windows

    documents = raw_documents(spark, sf_dir).where("endpoint = 'car_data'")
    _, totals = counted.telemetry_with_totals(documents, laps_with_windows(laps))
    return spark.createDataFrame([totals], ", ".join(f"{k} long" for k in ("files", "files_unreadable", "samples_read", "samples_in_window", "invalid_samples")))


@query("""
SELECT CASE event_type WHEN 'signup' THEN 'laps' WHEN 'view' THEN 'car_data' ELSE 'position' END AS endpoint, CAST(2020 + user_id % 4 AS INT) AS year, user_id AS session_key, count(*) AS records, CAST(sum(event_id) AS BIGINT) AS ids
FROM events WHERE event_type IN ('signup', 'view', 'purchase') GROUP BY ALL
""")
def archived_documents(spark, sf_dir):
    """Raw documents written by the committing writer under names that say what they hold, and read back (SNK-01, SRC-03)."""
    spark.dataSource.register(archive.DocumentSink)
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin(*KINDS))
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), F.col("event_type"))
    ids = F.array_join(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("i"), F.format_string('{"event_id": %d}', "event_id").alias("t"))))["t"], ", ")
    docs = e.groupBy(kind.alias("endpoint"), (F.lit(2020) + F.col("user_id") % 4).alias("year"), F.col("user_id").alias("session_key")).agg(F.concat(F.lit("["), ids, F.lit("]")).alias("data"))
    rows = docs.select("endpoint", "year", F.lit(7).alias("meeting_key"), "session_key", F.lit(None).cast("int").alias("driver_number"), F.lit("{}").alias("parameters"), "data", F.lit("2024-01-01").cast("timestamp").alias("retrieved_at"))
    root = new_folder(spark)
    archive.envelopes_of(rows).write.format("raw_documents").option("path", root).mode("append").save()
    found = envelopes.records(envelopes.discover(spark, root))
    return found.groupBy("endpoint", "year", "session_key").agg(F.count(F.lit(1)).alias("records"), F.sum(F.try_variant_get("rec", "$.event_id", "long")).alias("ids"))


@query("SELECT user_id AS session_key, event_id, round(CASE WHEN user_id % 5 = 0 THEN value * 2 ELSE value END, 6) AS value FROM events WHERE NOT (user_id % 5 = 0 AND event_id % 2 = 0)")
def replaced_sessions(spark, sf_dir):
    """A table of sessions of which some were replaced, read from its newest snapshot (SNK-02, SRC-09)."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_key"), "event_id", "value")
    root = new_folder(spark)
    archive.replace_sessions(e, root)
    archive.replace_sessions(e.where("session_key % 5 = 0 and event_id % 2 = 1").withColumn("value", F.col("value") * 2), root)
    return archive.read_sessions(spark, root).select("session_key", "event_id", rounded(F.col("value")).alias("value"))


@query(f"""
WITH {DOCUMENTS}, d AS (SELECT DISTINCT endpoint, year, meeting_key, session_key FROM ev)
SELECT endpoint, year, session_key, 'copied' AS first, 'skipped' AS second FROM d
""")
def copied_documents(spark, sf_dir):
    """Raw documents copied to another layout and found there under their keys; a second run copies none (SNK-07, SRC-03)."""
    from tideline.sources import sinks

    source, target = raw_documents(spark, sf_dir).select("file").first()[0].split("/endpoint=")[0], new_folder(spark)
    once, again = (sinks.copy_documents(spark, source, target, "lake").select("target", "status") for _ in range(2))
    runs = once.withColumnRenamed("status", "first").join(again.withColumnRenamed("status", "second"), "target")
    found = envelopes.discover(spark, target).withColumn("target", F.regexp_extract("file", "(raw/.*)$", 1))
    return found.join(runs, "target").select("endpoint", "year", "session_key", "first", "second").distinct()


@query(f"""
WITH {DOCUMENTS}, d AS (SELECT DISTINCT CASE endpoint WHEN 'laps' THEN 'meetings' WHEN 'car_data' THEN 'sessions' ELSE endpoint END AS endpoint, year, meeting_key, session_key FROM ev)
SELECT endpoint, year, meeting_key, session_key FROM d WHERE (year = 2021 AND session_key = 5) OR (year = 2021 AND (endpoint = 'meetings' OR endpoint = 'sessions' AND meeting_key = 0))
""")
def scoped_documents(spark, sf_dir):
    """The documents of a session with the catalogues of its season (DQ-12)."""
    named = F.when(F.col("endpoint") == "laps", "meetings").when(F.col("endpoint") == "car_data", "sessions").otherwise(F.col("endpoint"))
    documents = raw_documents(spark, sf_dir).withColumn("endpoint", named)
    found = envelopes.in_scope(documents, envelopes.Scope(2021, 0, 5))
    return found.select("endpoint", "year", "meeting_key", "session_key").distinct()
