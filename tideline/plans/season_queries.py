"""Registered queries of the season pipeline, over records derived from ``events``:
users drive laps that sign-ups open, and other events are telemetry, positions,
gaps, weather and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.scalars import rounded
from tideline.operators import guards, history
from tideline.plans import features, lap_table, modelling
from tideline.plans.registry import query, table
from tideline.sources.scratch import keep


def season(spark, sf_dir) -> dict[str, DataFrame]:
    """Typed frames of all nine kinds, each derived from the events table."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 6 + 1).alias("session_key"), F.col("user_id").alias("driver_number"), "event_id", F.col("ts").cast("timestamp").alias("date"), F.col("value").alias("v"), "event_type", F.col("event_id").alias("pos"))
    of = lambda kind: e.where(F.col("event_type") == kind)
    n, i, v = F.col("lap_number"), F.col("event_id"), F.col("v")
    key = ["session_key", "driver_number"]
    lap = of("signup").withColumn("lap_number", F.row_number().over(Window.partitionBy(*key).orderBy("date")))
    none = F.lit(None).cast("double")
    laps = lap.select(
        (F.lit(2020) + F.col("session_key")).alias("year"), (F.col("session_key") * 10).alias("meeting_key"), *key, "lap_number", "pos", F.col("date").alias("date_start"), v.alias("lap_duration"),
        *[(v / k).alias(f"duration_sector_{k}") for k in (1, 2, 3)], *[(v * k).alias(f"{c}_speed") for k, c in ((1, "i1"), (2, "i2"), (3, "st"))], (i % 5 == 0).alias("is_pit_out_lap"),
    )
    return {
        "laps": laps,
        "drivers": e.select(*key, "pos", F.concat(F.lit("T"), (F.col("driver_number") % 4).cast("string")).alias("team_name"), F.concat(F.lit("D"), F.col("driver_number").cast("string")).alias("name_acronym")),
        "stints": lap.where(n % 3 == 1).select(*key, "pos", F.floor((n + 2) / 3).alias("stint_number"), n.alias("lap_start"), (n + 1).alias("lap_end"), F.element_at(F.array(F.lit("SOFT"), F.lit("HARD")), (i % 2 + 1).cast("int")).alias("compound"), (i % 4).alias("tyre_age_at_start")),
        "pit": lap.where(i % 6 == 0).select(*key, "pos", n.alias("lap_number"), v.alias("pit_duration"), (v + 1).alias("lane_duration")),
        "position": of("purchase").select(*key, "pos", "date", (i % 20 + 1).cast("double").alias("position")),
        "intervals": of("click").select(*key, "pos", "date", F.when(i % 10 != 0, v).alias("gap_to_leader"), (i % 10 == 0).alias("gap_to_leader_is_text"), (v / 2).alias("interval")),
        "weather": of("error").select("session_key", "pos", "date", *[(v / k).alias(c) for k, c in enumerate(lap_table.WEATHER, 1)]),
        "race_control": of("view").where(i % 11 == 0).select(*key, "pos", "date", (i % 4 + 1).alias("lap_number")),
        "car_data": of("view").select(*key, "pos", "date", v.alias("speed"), (v * 100).alias("rpm"), *[F.when(i % 17 != 0, (i % m).cast("double")).otherwise(none).alias(c) for m, c in ((10, "n_gear"), (105, "throttle"), (103, "brake"), (15, "drs"))]),
    }


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[rounded(F.col(c)).alias(c) if t == "double" else F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


_WEATHER = ", ".join(f"round(CASE WHEN age <= 7200 THEN w.v / {k}.0 END, 6) AS {c}" if c not in ("rainfall", "wind_direction") else f"CAST(round_even(CASE WHEN age <= 7200 THEN w.v / {k}.0 END, 0) AS BIGINT) AS {c}" for k, c in enumerate(lap_table.WEATHER, 1))


_LAPS = f"""
WITH e AS (SELECT user_id % 6 + 1 AS s, user_id AS d, event_id AS i, ts, value AS v, event_type AS k FROM events),
l AS (SELECT *, row_number() OVER p AS n, lead(ts) OVER p AS nx FROM e WHERE k = 'signup' WINDOW p AS (PARTITION BY s, d ORDER BY ts)),
w0 AS (SELECT *, coalesce(nx, ts + to_microseconds(CAST(round(v * 1e6) AS BIGINT))) AS te FROM l),
inside AS (SELECT e.*, w0.n FROM e ASOF JOIN w0 ON e.s = w0.s AND e.d = w0.d AND e.ts >= w0.ts WHERE e.ts < w0.te),
st AS (SELECT s, d, n AS low, n + 1 AS high, (n + 2) // 3 AS num, CASE i % 2 WHEN 0 THEN 'SOFT' ELSE 'HARD' END AS compound, i % 4 AS age0 FROM l WHERE n % 3 = 1),
wx AS (SELECT w0.s, w0.d, w0.n, x.v, (epoch_us(w0.ts) - epoch_us(x.ts)) / 1e6 AS age FROM w0 ASOF LEFT JOIN (SELECT * FROM e WHERE k = 'error') x ON w0.s = x.s AND w0.ts >= x.ts),
p AS (SELECT s, d, ts, i % 20 + 1 AS pos FROM e WHERE k = 'purchase'),
p1 AS (SELECT w0.s, w0.d, w0.n, p.pos FROM w0 ASOF LEFT JOIN p ON w0.s = p.s AND w0.d = p.d AND w0.ts >= p.ts),
p2 AS (SELECT w0.s, w0.d, w0.n, p.pos FROM w0 ASOF LEFT JOIN p ON w0.s = p.s AND w0.d = p.d AND w0.te >= p.ts),
pc AS (SELECT s, d, n, count(*) AS c FROM inside WHERE k = 'purchase' GROUP BY ALL),
iv AS (SELECT s, d, n, arg_max(CASE WHEN i % 10 <> 0 THEN v ELSE -1e9 END, ts) AS gap, arg_max(v / 2, ts) AS itv, count(*) AS c FROM inside WHERE k = 'click' GROUP BY ALL),
cd AS (SELECT *, CASE WHEN i % 17 <> 0 THEN i % 10 END AS gear, CASE WHEN i % 17 <> 0 THEN i % 105 END AS thr, CASE WHEN i % 17 <> 0 THEN i % 103 END AS brk, CASE WHEN i % 17 <> 0 THEN i % 15 END AS drs FROM inside WHERE k = 'view'),
tm AS (SELECT s, d, n, min(v) AS smin, avg(v) AS smean, max(v) AS smax, avg(CASE WHEN thr <= 100 THEN thr END) AS tmean, avg(CASE WHEN brk <= 100 THEN CAST(brk > 0 AS DOUBLE) END) AS bshare,
  avg(CAST(drs IN (10, 12, 14) AS DOUBLE)) AS dshare, max(CASE WHEN gear <= 8 THEN gear END) AS gmax, count(*) AS c, count(*) FILTER (gear > 8 OR thr > 100 OR brk > 100) AS bad FROM cd GROUP BY ALL),
rc AS (SELECT s, d, i % 4 + 1 AS n FROM e WHERE k = 'view' AND i % 11 = 0),
r1 AS (SELECT s, n, count(*) AS c FROM rc GROUP BY ALL), r2 AS (SELECT s, d, n, count(*) AS c FROM rc GROUP BY ALL),
sx AS (SELECT l.s, l.d, l.n, CASE WHEN l.n <= st.high THEN st.num END AS num, CASE WHEN l.n <= st.high THEN compound END AS compound, CASE WHEN l.n <= st.high THEN age0 + l.n - low END AS tyre_age, CASE WHEN l.n <= st.high THEN l.n - low + 1 END AS stint_lap
  FROM l ASOF LEFT JOIN st ON l.s = st.s AND l.d = st.d AND l.n >= st.low)
SELECT CAST(2020 + w0.s AS BIGINT) AS year, CAST(w0.s * 10 AS BIGINT) AS meeting_key, w0.s AS session_key, w0.d AS driver_number, w0.n AS lap_number, 'T' || (w0.d % 4) AS team_name, 'D' || w0.d AS driver_acronym,
  w0.ts AS lap_start_time, w0.te AS lap_end_time, round(w0.v, 6) AS lap_duration, round(w0.v, 6) AS duration_sector_1, round(w0.v / 2, 6) AS duration_sector_2, round(w0.v / 3, 6) AS duration_sector_3,
  CAST(round_even(w0.v, 0) AS BIGINT) AS i1_speed, CAST(round_even(w0.v * 2, 0) AS BIGINT) AS i2_speed, CAST(round_even(w0.v * 3, 0) AS BIGINT) AS st_speed, w0.i % 5 = 0 AS is_pit_out_lap, nx IS NULL AS is_last_lap_for_driver, true AS has_complete_window,
  CAST(sx.num AS BIGINT) AS stint_number, sx.compound, CAST(sx.tyre_age AS BIGINT) AS tyre_age, CAST(sx.stint_lap AS BIGINT) AS stint_lap, w0.i % 6 = 0 AS pit_in_lap, round(CASE WHEN w0.i % 6 = 0 THEN w0.v END, 6) AS pit_duration, round(CASE WHEN w0.i % 6 = 0 THEN w0.v + 1 END, 6) AS pit_lane_duration,
  p1.pos AS position_at_lap_start, p2.pos AS position_at_lap_end, coalesce(pc.c, 0) AS position_changes_in_lap,
  round(CASE WHEN iv.gap > -1e8 THEN iv.gap END, 6) AS gap_to_leader_s, round(iv.itv, 6) AS interval_s, CASE WHEN iv.c > 0 THEN iv.gap < -1e8 END AS is_lapped, iv.c AS interval_samples,
  {_WEATHER}, round(CASE WHEN age <= 7200 THEN age END, 6) AS weather_age_s,
  CAST(round_even(smin, 0) AS BIGINT) AS speed_min, round(smean, 6) AS speed_mean, CAST(round_even(smax, 0) AS BIGINT) AS speed_max, CAST(round_even(smin * 100, 0) AS BIGINT) AS rpm_min, round(smean * 100, 4) AS rpm_mean, CAST(round_even(smax * 100, 0) AS BIGINT) AS rpm_max,
  round(tmean, 6) AS throttle_mean, round(bshare, 6) AS brake_applied_share, round(dshare, 6) AS drs_active_share, gmax AS n_gear_max, tm.c AS car_data_samples, tm.bad AS car_data_invalid_samples,
  coalesce(r1.c, 0) AS rc_events_in_lap, coalesce(r2.c, 0) AS rc_driver_events_in_lap
FROM w0 LEFT JOIN sx USING (s, d, n) LEFT JOIN wx w USING (s, d, n) LEFT JOIN p1 USING (s, d, n) LEFT JOIN p2 USING (s, d, n) LEFT JOIN pc USING (s, d, n) LEFT JOIN iv USING (s, d, n) LEFT JOIN tm USING (s, d, n)
  LEFT JOIN r1 ON r1.s = w0.s AND r1.n = w0.n LEFT JOIN r2 ON r2.s = w0.s AND r2.d = w0.d AND r2.n = w0.n
"""


@query(_LAPS)
def season_lap_table(spark, sf_dir):
    """Nine kinds of records reduced to 55 columns a lap (M4: JN-01 to JN-08, AG-01 to AG-04, PRJ-03 to PRJ-07)."""
    return _rounded(lap_table.lap_table(season(spark, sf_dir), 7200)).withColumn("rpm_mean", F.round("rpm_mean", 4))


def _history_sql() -> str:
    """SQL for the names of the history features."""
    found = []
    for name in history.temporal_names():
        what, _, k = name.removeprefix("lap_time_").rpartition("_")
        found.append({
            "prev": "lag(lap_duration) OVER w", "delta": "lap_duration - lag(lap_duration) OVER w", "vs_roll_mean": "lap_duration - avg(lap_duration) OVER w5", "expanding": "avg(lap_duration) OVER (w ROWS UNBOUNDED PRECEDING)",
            "roll_mean": f"avg(lap_duration) OVER w{k}", "roll_std": f"stddev_samp(lap_duration) OVER w{k}", "roll_min": f"min(lap_duration) OVER w{k}",
        }[what])
    return ", ".join(f"round({x}, 6) AS {n}" for x, n in zip(found, history.temporal_names()))


_PLAIN = [c for c in dict.fromkeys([*features.KEYS, *features.FEATURES]) if c not in ("session_date", *history.temporal_names())]
_FEATURES = f"""
WITH lap AS ({_LAPS}), dated AS (SELECT *, min(lap_start_time) OVER (PARTITION BY session_key) AS session_date FROM lap)
SELECT {", ".join(_PLAIN)}, session_date, {_history_sql()}, round(CASE WHEN lead(lap_number) OVER w = lap_number + 1 THEN lead(lap_duration) OVER w END, 6) AS next_lap_time,
  coalesce(lead(lap_number) OVER w = lap_number + 1, false) AND lead(lap_duration) OVER w IS NOT NULL AS has_target
FROM dated WINDOW w AS (PARTITION BY session_key, driver_number ORDER BY lap_number), w3 AS (PARTITION BY session_key, driver_number ORDER BY lap_number ROWS 2 PRECEDING), w5 AS (PARTITION BY session_key, driver_number ORDER BY lap_number ROWS 4 PRECEDING)
"""


@query(_FEATURES)
def season_features(spark, sf_dir):
    """Keys, the 51 features, target and its flag of every lap (M5, PRJ-08, PRJ-12, PRJ-15, PRJ-17)."""
    return _rounded(features.feature_table(lap_table.lap_table(season(spark, sf_dir), 7200))).withColumn("rpm_mean", F.round("rpm_mean", 4))


@query("""
WITH l AS (SELECT user_id % 6 + 1 AS session_key, user_id, count(*) AS laps FROM events WHERE event_type = 'signup' GROUP BY ALL)
SELECT session_key, CAST(sum(laps) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS without_window, CAST(0 AS BIGINT) AS duplicate_rows, count(*) AS drivers, min(laps) AS fewest_laps, max(laps) AS most_laps FROM l GROUP BY session_key
""")
def season_checks(spark, sf_dir):
    """Soundness counters of each session's lap table (G4-1)."""
    found = lap_table.checks(lap_table.lap_table({"laps": season(spark, sf_dir)["laps"]}))
    return found.select("session_key", "rows", "without_window", "duplicate_rows", "drivers", "fewest_laps", "most_laps")


def _results(spark, results: list[guards.Result]) -> DataFrame:
    return spark.createDataFrame([(r.name, r.status, r.blocking, r.blocks) for r in results], "guard string, status string, blocking boolean, blocks boolean")


def stored_features(spark, sf_dir) -> DataFrame:
    """The whole feature table, written once: guards and models read it many times."""
    return features.selected(stored_history(spark, sf_dir))


def stored_history(spark, sf_dir) -> DataFrame:
    """All columns of the laps with their history, written once."""
    return keep(features.with_history(lap_table.lap_table(season(spark, sf_dir), 7200)))


def _guards_sql(rows: list[tuple[str, str, bool]]) -> str:
    """SQL for guards of (name, count of what is wrong, blocking)."""
    one = "SELECT '{}' AS guard, CASE WHEN n IS NULL THEN 'SKIPPED' WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, {} AS blocking, {} AND n IS DISTINCT FROM 0 AS blocks FROM (SELECT ({}) AS n)"
    return f"WITH f AS MATERIALIZED ({_FEATURES}) " + " UNION ALL ".join(one.format(name, str(b).lower(), str(b).lower(), wrong) for name, wrong, b in rows)


def _correlated(c: str) -> str:
    """SQL for 1 where a feature almost equals the target; a side without variance is NaN there, which is no correlation."""
    x = f"corr(CAST({c} AS DOUBLE), next_lap_time)"
    return f"CAST(coalesce(isfinite({x}) AND abs({x}) >= 0.99, false) AS INT)"


_CORRELATED = " + ".join(_correlated(c) for c in features.FEATURES if c not in features.CATEGORICAL)


@query(_guards_sql([
    ("grain_unique", "SELECT count(*) - count(DISTINCT (session_key, driver_number, lap_number)) FROM f", True),
    ("target_matches_independent_derivation", "SELECT count(*) FROM f LEFT JOIN f g ON g.session_key = f.session_key AND g.driver_number = f.driver_number AND g.lap_number = f.lap_number + 1 WHERE f.next_lap_time IS DISTINCT FROM g.lap_duration", True),
    ("last_lap_has_no_target", "SELECT count(*) FROM f WHERE next_lap_time IS NOT NULL AND lap_number = (SELECT max(lap_number) FROM f g WHERE g.session_key = f.session_key AND g.driver_number = f.driver_number)", True),
    ("target_does_not_cross_driver_or_session", "SELECT count(*) FROM f WHERE next_lap_time IS NOT NULL AND lap_number = (SELECT max(lap_number) FROM f g WHERE g.session_key = f.session_key AND g.driver_number = f.driver_number)", True),
    ("no_forbidden_columns_among_features", "SELECT count(*) FROM (DESCRIBE SELECT * FROM f) WHERE column_name IN ('lap_end_time', 'is_last_lap_for_driver', 'has_complete_window', 'pit_duration', 'pit_lane_duration')", True),
    ("rolling_features_use_only_the_past", "SELECT count(*) FROM (SELECT f.lap_time_roll_mean_3 AS a, avg(g.lap_duration) AS b FROM f JOIN f g ON g.session_key = f.session_key AND g.driver_number = f.driver_number AND g.lap_number BETWEEN f.lap_number - 2 AND f.lap_number GROUP BY f.session_key, f.driver_number, f.lap_number, 1) WHERE abs(a - b) > 1e-5", True),
    ("no_feature_almost_equals_the_target", f"SELECT {_CORRELATED} FROM f", False),
]))
def season_feature_guards(spark, sf_dir):
    """The guards of the feature table, each recomputed independently (G5-1 to G5-7)."""
    full = stored_history(spark, sf_dir)
    return _results(spark, features.check(features.selected(full), marked=full))


def _model_guards_sql() -> str:
    """SQL for the fourteen guards: (name, count of what is wrong); for statistics, whether other splits would change them."""
    names = "SELECT count(*) FROM (DESCRIBE SELECT * EXCLUDE (year, meeting_key, session_date, has_target, next_lap_time) FROM f) WHERE column_name {}"
    forbidden = ", ".join(f"'{c}'" for c in features.FORBIDDEN)
    overlap = "SELECT count(*) FROM (SELECT 1 FROM r GROUP BY {} HAVING count(DISTINCT split) > 1)"
    same = "SELECT CAST(a.m = b.m AND a.s = b.s AS INT) FROM (SELECT median(lap_duration) AS m, sum(lap_duration) AS s FROM r WHERE split = 'train') a, (SELECT median(lap_duration) AS m, sum(lap_duration) AS s FROM r WHERE split IN ('train', '{}')) b"
    wrong = [
        "SELECT 3 - count(DISTINCT split) FROM r", names.format("= 'next_lap_time'"), names.format(f"IN ({forbidden})"), names.format("IN ('key_session_key', 'key_driver_number', 'key_lap_number')"),
        overlap.format("session_key"), overlap.format("session_key, driver_number, lap_number"),
        "SELECT count(*) FROM (SELECT max(d) FILTER (split = 'train') AS a, min(d) FILTER (split = 'validation') AS b, max(d) FILTER (split = 'validation') AS c, min(d) FILTER (split = 'test') AS e FROM cal) WHERE NOT (a < b AND b < c OR b = c AND a < b) OR NOT c < e",
        "SELECT 0", same.format("validation"), same.format("test"), "SELECT 0", "SELECT 0",
        "SELECT count(*) FROM r LEFT JOIN f g ON g.session_key = r.session_key AND g.driver_number = r.driver_number AND g.lap_number = r.lap_number + 1 WHERE r.next_lap_time IS DISTINCT FROM g.lap_duration",
        "SELECT count(*) FROM r WHERE next_lap_time IS NULL OR NOT isfinite(next_lap_time)",
    ]
    cal = """cal AS (SELECT session_key, d, CASE WHEN p < a THEN 'train' WHEN p < a + b THEN 'validation' ELSE 'test' END AS split FROM (
      SELECT session_key, d, row_number() OVER (ORDER BY d, session_key) - 1 AS p, greatest(1, round_even(count(*) OVER () * 0.6, 0)) AS a, round_even(count(*) OVER () * 0.2, 0) AS b
      FROM (SELECT session_key, min(session_date) AS d FROM f WHERE has_target GROUP BY session_key))), r AS MATERIALIZED (SELECT f.*, split FROM f JOIN cal USING (session_key) WHERE has_target)"""
    one = "SELECT '{}' AS guard, CASE WHEN n = 0 THEN 'PASS' ELSE '{}' END AS status, true AS blocking, n <> 0 AS blocks FROM (SELECT ({}) AS n)"
    told = [one.format(name, "INCONCLUSIVE" if "statistics" in name else "FAIL", n) for name, n in zip(modelling.REQUIRED, wrong)]
    return f"WITH f AS MATERIALIZED ({_FEATURES}), {cal} " + " UNION ALL ".join(told)


@query(_model_guards_sql())
def season_model_guards(spark, sf_dir):
    """The guards of the modelling dataset (G6-1 to G6-14)."""
    return _results(spark, modelling.prepare(stored_features(spark, sf_dir)).results)


@query()
def season_model_metrics(spark, sf_dir):
    """Least squares and the mean baseline on every split (M6, M7)."""
    return modelling.train_and_judge(modelling.prepare(stored_features(spark, sf_dir), guard=False))
