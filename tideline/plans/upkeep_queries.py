"""Registered queries on upkeep: completeness, missing artifacts, reuse, and scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideline.functions.scalars import rounded
from tideline.operators import encode, regress
from tideline.plans import incremental, scoring
from tideline.plans.registry import query, table
from tideline.sources.scratch import shared_folder


@query("""
WITH s AS (SELECT strftime(o_orderdate, '%Y-%m') AS session_key, min(year(o_orderdate)) AS year, bool_or(o_totalprice > 400000) AS ok FROM orders GROUP BY 1),
w(year) AS (VALUES (1996), (1999), (2001), (2005))
SELECT CAST(w.year AS INT) AS year, count(session_key) AS sessions, count(*) FILTER (ok) AS verified, count(session_key) > 0 AND count(session_key) = count(*) FILTER (ok) AS complete FROM w LEFT JOIN s USING (year) GROUP BY w.year
""")
def season_completeness(spark, sf_dir):
    """Required years all of whose months are verified (AG-25, PV-04)."""
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("session_key"), F.year("o_orderdate").alias("year"), "o_totalprice")
    sessions = orders.groupBy("session_key").agg(F.min("year").alias("year"))
    return incremental.completeness(sessions, orders.where("o_totalprice > 400000"), [1996, 1999, 2001, 2005])


@query("""
SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' AND (o_custkey, o_orderstatus) NOT IN (SELECT (o_custkey, o_orderstatus) FROM orders WHERE o_orderpriority = '5-LOW')
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def missing_artifacts(spark, sf_dir):
    """Expected pairs that are neither stored nor excused (PV-07, JN-18)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    excused = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")).join(orders.select("o_custkey", "o_orderstatus").distinct(), "o_custkey")
    expected = orders.where("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderstatus").distinct()
    return incremental.missing_artifacts(expected, orders.where("o_orderpriority = '5-LOW'"), excused, ["o_custkey", "o_orderstatus"])


@query("""
SELECT user_id AS session_key, count(*) FILTER (event_id % 50 = 0) = 0 AS reusable, CASE WHEN count(*) FILTER (event_id % 50 = 0) > 0 THEN 'raw' END AS first_changed FROM events GROUP BY user_id
""")
def session_reuse(spark, sf_dir):
    """Sessions whose rows are what was recorded, against those where some changed (PV-01, PV-02)."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_key"), "event_id", "value")
    before = events.withColumn("value", F.when(F.col("event_id") % 50 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return incremental.reuse(incremental.session_digests(events, "raw"), incremental.session_digests(before, "raw"), ["raw"])


_SCORED = """
WITH t AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN round(a + b * o_custkey, 2) END AS prediction, CASE WHEN o_orderkey % 10 = 0 THEN 'o_custkey: not finite' ELSE '' END AS errors FROM orders, t
"""


def _fitted(spark, sf_dir):
    """Records asked for, and the contract, encoder and model of the finished orders."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_orderstatus", "o_totalprice")
    train = orders.where("o_orderstatus = 'F'")
    encoder = encode.fit(train, ["o_custkey"], [])
    model = regress.least_squares(encoder.apply(train, "o_totalprice"), encoder.names, "o_totalprice")
    asked = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, float("inf")).otherwise(F.col("o_custkey")).alias("o_custkey"))
    return asked, scoring.Contract.of(encoder, ["o_orderkey"]), encoder, model


def _told(found):
    return found.select("o_orderkey", rounded(F.col("prediction"), 2).alias("prediction"), F.array_join("errors", "; ").alias("errors"))


@query(_SCORED)
def batch_scoring(spark, sf_dir):
    """Records judged by a contract and scored by a fitted model as columns (SV-01 to SV-04)."""
    return _told(scoring.score(*_fitted(spark, sf_dir)))


@query(_SCORED)
def saved_scoring(spark, sf_dir):
    """The same with contract, encoder and model saved, loaded and checked against each other (SNK-06, SV-05, SV-06, ML-09)."""
    asked, *parts = _fitted(spark, sf_dir)
    folder = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    scoring.save_package(spark, folder, *parts)
    return _told(scoring.score(asked, *scoring.load_package(spark, folder)))
