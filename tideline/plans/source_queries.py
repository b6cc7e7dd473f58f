"""Registered queries of sources and sinks: raw documents and session tables written
from ``events`` to the shared folder and read back by the package's own readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.scalars import rounded
from tideline.operators import quality
from tideline.plans import features, lap_table
from tideline.plans.registry import query, table
from tideline.plans.season_queries import season
from tideline.sources import envelopes, sinks, tables
from tideline.sources.scratch import keep, shared_folder

#: Names of event types as kinds of documents; some users are a session, and a document
#: holds what of a kind and session falls into 100,000 events in a row.
KINDS = {"signup": "laps", "view": "car_data", "purchase": "position"}
DOCUMENTS = """ev AS (SELECT CASE event_type WHEN 'signup' THEN 'laps' WHEN 'view' THEN 'car_data' ELSE 'position' END AS endpoint, CAST(2020 + user_id % 4 AS INT) AS year, CAST(user_id % 40 // 10 AS BIGINT) AS meeting_key,
  CAST(user_id % 40 AS BIGINT) AS session_key, event_id, value, ts, user_id % 99 AS driver, user_id % 40 % 9 = 4 AS broken FROM events WHERE event_type IN ('signup', 'view', 'purchase'))"""


def new_folder(spark) -> str:
    return f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"


def raw_documents(spark, sf_dir) -> DataFrame:
    """The documents of all kinds, discovered where they were written: records are
    objects, every tenth of them a list; documents of some users lack their data."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin(*KINDS))
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), F.col("event_type"))
    fields = F.format_string('{"event_id": %d, "driver_number": %d, "lap_number": %d, "position": %d, "date": "%s"}', "event_id", F.col("user_id") % 99, F.col("event_id") % 50, F.col("event_id") % 20, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    record = F.when(F.col("event_id") % 10 == 0, F.lit("[1]")).otherwise(fields)
    session = F.col("user_id") % 40
    keys = [kind.alias("endpoint"), (F.lit(2020) + session % 4).alias("year"), F.floor(session / 10).alias("meeting_key"), session.alias("session_key")]
    folders = ["endpoint", "year", "meeting_key", "session_key"]
    grouped = e.select(*keys, "event_id", record.alias("record")).groupBy(*folders, F.floor(F.col("event_id") / 100_000).alias("part")).agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "record"))), lambda s: F.try_parse_json(s["record"])).alias("data"))
    doc = grouped.withColumn("data", F.when(F.col("session_key") % 9 != 4, F.col("data")))
    root = new_folder(spark)
    doc.repartition(*folders).select(*folders, F.lit("stored").alias("kind"), "data").write.option("maxRecordsPerFile", 1).partitionBy(*folders).json(root)
    return envelopes.discover(spark, root)


@query(f"""
WITH {DOCUMENTS}
SELECT endpoint, year, meeting_key, session_key, count(*) AS entries, count(*) FILTER (event_id % 10 <> 0) AS objects, CAST(sum(event_id) FILTER (event_id % 10 <> 0) AS BIGINT) AS ids
FROM ev WHERE NOT broken GROUP BY ALL
""")
def envelope_scan(spark, sf_dir):
    """Documents discovered, parsed and exploded, with keys from their paths (SRC-01 to SRC-05, AG-28)."""
    rows = envelopes.records(raw_documents(spark, sf_dir))
    keys = ["endpoint", "year", "meeting_key", "session_key"]
    ids = envelopes.objects(rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("objects"), F.sum(F.try_variant_get("rec", "$.event_id", "long")).alias("ids"))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("entries")).join(ids, keys, "left").select(*keys, "entries", F.coalesce("objects", F.lit(0)).alias("objects"), "ids")


@query(f"WITH {DOCUMENTS} SELECT endpoint, count(DISTINCT (session_key, event_id // 100000)) AS files FROM ev WHERE broken GROUP BY endpoint")
def damaged_documents(spark, sf_dir):
    """Documents that cannot be read, kept apart by kind (SRC-06)."""
    return envelopes.damaged(raw_documents(spark, sf_dir)).groupBy("endpoint").agg(F.count_distinct("file").alias("files"))


@query(f"WITH {DOCUMENTS} SELECT DISTINCT year, meeting_key, session_key FROM ev WHERE endpoint = 'laps' AND year = 2021")
def session_discovery(spark, sf_dir):
    """Sessions of a season that have a document of laps (SRC-07, FLT-07)."""
    return envelopes.sessions(raw_documents(spark, sf_dir).where(envelopes.Scope(year=2021).predicate()))


@query(f"""
WITH {DOCUMENTS}, u AS (SELECT DISTINCT endpoint, session_key FROM ev WHERE NOT broken), k(endpoint) AS (VALUES ('laps'), ('position'))
SELECT k.endpoint, CAST(c_custkey AS BIGINT) AS session_key FROM customer, k WHERE (k.endpoint, c_custkey) NOT IN (SELECT (endpoint, session_key) FROM u)
""")
def units_to_fetch(spark, sf_dir):
    """Wanted requests whose document is not stored or not readable (SRC-18, FLT-14)."""
    stored = envelopes.parsed(raw_documents(spark, sf_dir)).where("readable").select("endpoint", "session_key")
    wanted = table(spark, sf_dir, "customer").select(F.explode(F.array(F.lit("laps"), F.lit("position"))).alias("endpoint"), F.col("c_custkey").alias("session_key"))
    return envelopes.missing_units(wanted, stored, ["endpoint", "session_key"])


@query(f"""
WITH {DOCUMENTS}
SELECT session_key, CAST(event_id % 20 AS DOUBLE) AS position, date_trunc('second', ts) AS date FROM ev WHERE endpoint = 'position' AND NOT broken AND event_id % 10 <> 0
""")
def typed_records(spark, sf_dir):
    """Records of one kind as typed columns, their session from the path (SRC-08, PRJ-01, PRJ-02, PRJ-07)."""
    found = tables.typed(envelopes.records(raw_documents(spark, sf_dir)), "position")
    return found.select("session_key", "position", F.col("date").cast("timestamp_ntz").alias("date"))


@query(f"""
WITH {DOCUMENTS}, m AS (SELECT session_key, count(*) AS entries, 'manifest_' || strftime(max(ts), '%Y%m%d%H%M%S') AS name FROM ev WHERE session_key % 2 = 1 GROUP BY session_key, ts::DATE)
SELECT session_key, max(name) AS name, CAST(arg_max(entries, name) AS BIGINT) AS entries FROM m GROUP BY session_key
""")
def newest_manifests(spark, sf_dir):
    """The newest manifest of each session by name, where no full run is stored (SRC-19, WN-13)."""
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin(*KINDS)).withColumn("session_key", F.col("user_id") % 40).where("session_key % 2 = 1")
    named = e.groupBy("session_key", F.to_date("ts").alias("day")).agg(F.concat(F.lit("manifest_"), F.date_format(F.max("ts"), "yyyyMMddHHmmss")).alias("name"), F.count(F.lit(1)).alias("entries"))
    return envelopes.newest_manifests(named.select("name", "session_key", "entries")).select("session_key", "name", "entries")


@query("""
WITH l AS (SELECT user_id % 6 + 1 AS s, user_id AS d, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n, lead(value) OVER (PARTITION BY user_id ORDER BY ts) AS nx FROM events WHERE event_type = 'signup')
SELECT s AS session_key, d AS driver_number, n AS lap_number, round(nx, 6) AS next_lap_time FROM l WHERE nx IS NOT NULL AND s IN (2, 3, 5) AND 2020 + s IN (2022, 2025)
""")
def stored_training_rows(spark, sf_dir):
    """Feature rows written by session, scanned without folder columns, restricted to
    seasons, sessions and usable targets (SNK-02, SRC-09 to SRC-11, FLT-06, FLT-08)."""
    root = new_folder(spark)
    sinks.write_sessions(features.feature_table(lap_table.lap_table({"laps": season(spark, sf_dir)["laps"]})), root)
    found = tables.training_rows(tables.scan(spark, root), years=[2022, 2025], session_keys=[2, 3, 5])
    return found.select("session_key", "driver_number", "lap_number", rounded(F.col("next_lap_time")).alias("next_lap_time"))


@query("""
SELECT o_orderstatus AS table_name, count(*) AS rows, true AS unchanged FROM orders GROUP BY o_orderstatus
""")
def published_run(spark, sf_dir):
    """Tables published with their digests and a marker, read back and verified (SNK-03, SNK-09, SNK-10, SNK-13, ML-10)."""
    orders = keep(table(spark, sf_dir, "orders"))
    parts = {s: orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")}
    folder = sinks.publish(spark, new_folder(spark), "run-1", parts, {"kind": "orders by status"})
    changed = sinks.verify(spark, folder)
    counted = None
    for name in parts:
        one = tables.scan(spark, f"{folder}/{name}").groupBy(F.lit(name).alias("table_name")).agg(F.count(F.lit(1)).alias("rows")).withColumn("unchanged", F.lit(name not in changed))
        counted = one if counted is None else counted.unionByName(one)
    return counted


@query(f"""
WITH {DOCUMENTS}
SELECT session_key, endpoint, count(DISTINCT event_id // 100000) AS files, count(DISTINCT event_id // 100000) FILTER (broken) AS unreadable, count(*) FILTER (NOT broken) AS records,
  count(*) FILTER (NOT broken AND event_id % 10 <> 0) AS objects, count(DISTINCT driver) FILTER (NOT broken AND event_id % 10 <> 0) AS drivers
FROM ev GROUP BY ALL
""")
def dataset_index(spark, sf_dir):
    """Files, records and drivers stored of each session and kind (AG-12)."""
    documents = raw_documents(spark, sf_dir)
    return quality.dataset_index(envelopes.records(documents), envelopes.parsed(documents))
