"""Registered queries of the quality engine, over records derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators import quality
from tideline.operators.specs import ENDPOINTS
from tideline.plans.registry import query, registered_sql, table
from tideline.sources.scratch import keep


def telemetry_records(spark, sf_dir) -> DataFrame:
    """(file, pos, rec): events as telemetry documents, one a user, with flaws by event_id."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    speed = F.when(i % 13 == 0, "null").when(i % 17 == 0, F.lit('"fast"')).when(i % 19 == 0, "450").otherwise(F.floor("value").cast("string"))
    gear = F.when(i % 7 == 0, "2.5").when(i % 23 == 0, "true").otherwise((i % 9).cast("string"))
    date = F.when(i % 29 == 0, "yesterday").otherwise(F.date_format(F.when(i % 41 == 0, F.col("ts") - F.expr("interval 2 days")).otherwise(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    body = F.concat(
        F.lit('{"session_key": 1, "meeting_key": 2, "date": "'), date, F.lit('", "driver_number": '), (F.col("user_id") % 120).cast("string"), F.lit(', "speed": '), speed, F.lit(', "n_gear": '), gear,
        F.lit(', "throttle": '), (i % 112).cast("string"), F.lit(', "drs": '), (i % 15).cast("string"), F.when(i % 31 == 0, ', "new": 1').otherwise(""), F.lit("}"),
    )
    text = F.when(i % 37 == 0, F.lit("[1]")).otherwise(body)
    return e.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("file"), F.col("event_id").alias("pos"), F.try_parse_json(text).alias("rec"))


def telemetry_facts(spark, sf_dir) -> DataFrame:
    return quality.facts(telemetry_records(spark, sf_dir), ENDPOINTS["car_data"])


_RECORDS = """r AS (SELECT 'user_' || user_id AS file, event_id AS i, ts, value, user_id % 120 AS driver FROM events WHERE event_id % 37 <> 0),
f AS (SELECT *, i % 13 = 0 AS speed_null, i % 13 <> 0 AND i % 17 = 0 AS speed_text, i % 13 <> 0 AND i % 17 <> 0 AND i % 19 = 0 AS speed_high, i % 7 = 0 AS gear_float, i % 7 <> 0 AND i % 23 = 0 AS gear_bool, i % 29 = 0 AS bad_time FROM r)"""


@query(f"""
WITH {_RECORDS}, c AS (
  SELECT file, 'speed' AS field, 'types' AS rule, 'wrong_type' AS finding, count(*) FILTER (speed_text) AS n FROM f GROUP BY file UNION ALL
  SELECT file, 'speed', 'values', 'above_maximum', count(*) FILTER (speed_high OR (NOT speed_null AND NOT speed_text AND value >= 401)) FROM f GROUP BY file UNION ALL
  SELECT file, 'speed', 'missing_values', 'null', count(*) FILTER (speed_null) FROM f GROUP BY file UNION ALL
  SELECT file, 'n_gear', 'types', 'wrong_type', count(*) FILTER (gear_float OR gear_bool) FROM f GROUP BY file UNION ALL
  SELECT file, 'date', 'temporal', 'unparseable', count(*) FILTER (bad_time) FROM f GROUP BY file UNION ALL
  SELECT file, 'throttle', 'values', 'undocumented', count(*) FILTER (i % 112 BETWEEN 101 AND 110) FROM f GROUP BY file UNION ALL
  SELECT file, 'throttle', 'values', 'above_maximum', count(*) FILTER (i % 112 = 111) FROM f GROUP BY file UNION ALL
  SELECT file, 'drs', 'values', 'unexpected', count(*) FILTER (i % 15 NOT IN (0, 1, 2, 3, 8, 10, 12, 14)) FROM f GROUP BY file UNION ALL
  SELECT file, 'driver_number', 'values', 'below_minimum', count(*) FILTER (driver < 1) FROM f GROUP BY file UNION ALL
  SELECT file, 'driver_number', 'values', 'above_maximum', count(*) FILTER (driver > 99) FROM f GROUP BY file UNION ALL
  SELECT file, 'speed', 'missing_values', 'null_share', CASE WHEN count(*) FILTER (speed_null) > 0.03 * (SELECT count(*) FROM events e WHERE 'user_' || e.user_id = f.file) THEN count(*) FILTER (speed_null) ELSE 0 END FROM f GROUP BY file UNION ALL
  SELECT 'user_' || user_id, '', 'structure', 'non_object', count(*) FILTER (event_id % 37 = 0) FROM events GROUP BY user_id)
SELECT file, rule, field, finding, n FROM c WHERE n > 0
""")
def quality_profile(spark, sf_dir):
    """All field rules over telemetry documents in one aggregate (AG-09, AG-13, FLT-12, FLT-13, DQ-01 to DQ-06, DQ-08)."""
    with quality.short_methods(spark):
        return keep(quality.profile(telemetry_facts(spark, sf_dir), ENDPOINTS["car_data"], 0.03)).select("file", "rule", "field", "finding", "n")


@query("""
WITH k AS (SELECT 'user_' || user_id AS file, event_id % 31 = 0 AS extra FROM events WHERE event_id % 37 <> 0)
SELECT file, 'schema' AS rule, 'new' AS field, 'unknown_field' AS finding, count(*) AS n FROM k WHERE extra GROUP BY file UNION ALL
SELECT file, 'structure', '', 'several_key_sets', count(DISTINCT extra) FROM k GROUP BY file HAVING count(DISTINCT extra) > 1
""")
def quality_key_sets(spark, sf_dir):
    """Unknown keys and documents with several sets of keys (AG-10, DQ-01, DQ-02)."""
    return quality.key_sets(telemetry_facts(spark, sf_dir), ENDPOINTS["car_data"]).select("file", "rule", "field", "finding", "n")


@query("""
WITH k AS (SELECT 'user_' || user_id AS file, user_id % 120 AS d, CASE WHEN event_id % 29 = 0 THEN 'yesterday' ELSE strftime(CASE WHEN event_id % 41 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END, '%Y-%m-%dT%H:%M:%SZ') END AS t FROM events WHERE event_id % 37 <> 0),
g AS (SELECT file, count(*) AS n FROM k GROUP BY file, d, t HAVING count(*) > 1)
SELECT file, CAST(sum(n - 1) AS BIGINT) AS n FROM g GROUP BY file
""")
def quality_duplicates(spark, sf_dir):
    """Surplus records of the natural key of a document (AG-11, DQ-07)."""
    return quality.duplicates(telemetry_facts(spark, sf_dir), ENDPOINTS["car_data"]).select("file", "n")


@query("""
WITH k AS (SELECT 'user_' || user_id AS file, event_id AS i, CASE WHEN event_id % 29 <> 0 THEN date_trunc('second', CASE WHEN event_id % 41 = 0 THEN ts - INTERVAL 2 DAY ELSE ts END) END AS t FROM events WHERE event_id % 37 <> 0),
b AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY file ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM k)
SELECT file, count(*) FILTER (t < p) AS n FROM b GROUP BY file HAVING count(*) FILTER (t < p) > 0
""")
def quality_inversions(spark, sf_dir):
    """Records before their last readable predecessor in a document (WN-09, DQ-08)."""
    return quality.inversions(telemetry_facts(spark, sf_dir), ENDPOINTS["car_data"]).select("file", "n")


def _report_sql() -> str:
    """The findings of the four queries above, by rule and severity."""
    found = registered_sql("quality_profile", "quality_key_sets", "quality_duplicates", "quality_inversions")
    severity = "CASE WHEN finding IN ('wrong_type', 'above_maximum', 'below_minimum', 'unparseable', 'non_object', 'surplus') THEN 'ERROR' WHEN finding = 'order_inversion' THEN 'WARNING' ELSE 'INFO' END"
    rules = ", ".join(f"('{r}')" for r in quality.RULES[:8])
    count = lambda s: f"CAST(coalesce(sum(n) FILTER (severity = '{s}'), 0) AS BIGINT)"
    return f"""WITH p AS ({found[0]}), k AS ({found[1]}), d AS ({found[2]}), v AS ({found[3]}), e(rule) AS (VALUES {rules}),
a AS (SELECT *, {severity} AS severity FROM (SELECT rule, finding, n FROM p WHERE finding <> 'null_share' UNION ALL SELECT rule, finding, n FROM k UNION ALL SELECT 'duplicates', 'surplus', n FROM d UNION ALL SELECT 'temporal', 'order_inversion', n FROM v))
SELECT 'car_data' AS endpoint, rule, {count('ERROR')} AS errors, {count('WARNING')} AS warnings, {count('INFO')} AS infos, CASE WHEN {count('ERROR')} > 0 THEN 'FAIL' WHEN {count('WARNING')} > 0 THEN 'WARNING' ELSE 'PASS' END AS status
FROM e LEFT JOIN a USING (rule) GROUP BY rule"""


@query(_report_sql())
def envelope_quality_report(spark, sf_dir):
    """Status of every rule over the telemetry documents (DQ-01 to DQ-08, AG-28)."""
    records = telemetry_records(spark, sf_dir)
    return quality.report(quality.document_findings(records, ENDPOINTS["car_data"]), records.select(F.lit("car_data").alias("endpoint")), quality.RULES[:8])


@query("""
WITH u AS (SELECT DISTINCT o_custkey % 40 AS s, o_orderkey % 9 AS d FROM orders)
SELECT CAST('unknown_session' AS VARCHAR) AS finding, count(DISTINCT s) AS n FROM u WHERE s NOT IN (SELECT n_nationkey FROM nation) HAVING count(*) > 0 UNION ALL
SELECT 'unknown_meeting', count(DISTINCT s) FROM u WHERE s NOT IN (SELECT r_regionkey FROM region) HAVING count(*) > 0 UNION ALL
SELECT 'driver_not_listed', count(DISTINCT (s, d)) FROM u WHERE (s, d) NOT IN (SELECT (n_nationkey, n_regionkey) FROM nation) HAVING count(*) > 0
""")
def quality_identifiers(spark, sf_dir):
    """References to sessions, meetings and drivers that no catalogue lists (JN-11, DQ-09)."""
    used = table(spark, sf_dir, "orders").select(F.lit("laps").alias("endpoint"), (F.col("o_custkey") % 40).alias("session_key"), (F.col("o_custkey") % 40).alias("meeting_key"), (F.col("o_orderkey") % 9).alias("driver_number"))
    nation = table(spark, sf_dir, "nation")
    sessions = nation.select(F.col("n_nationkey").alias("session_key"))
    meetings = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("meeting_key"))
    return quality.identifiers(used, sessions, meetings, nation.select(F.col("n_nationkey").alias("session_key"), F.col("n_regionkey").alias("driver_number"))).select("finding", "n")
