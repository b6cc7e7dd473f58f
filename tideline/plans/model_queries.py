"""Registered queries of learned statistics and of least squares over many levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.operators import regress, statistics
from tideline.plans.registry import query, r, table

_UNIONS = [["R"], ["R", "A"], ["R", "N"]]
_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "late"]


def _statistics_sql() -> str:
    late = "CASE WHEN l_linenumber % 5 <> 0 THEN CAST(l_linenumber AS DOUBLE) END AS late"
    one = """SELECT '{u}' AS splits, '{c}' AS feature, count(*) AS rows, count(*) - count({c}) AS nulls, round(any_value(m), 6) AS middle, round(avg(coalesce({c}, m)), 6) AS mean, round(stddev_pop(coalesce({c}, m)), 6) AS deviation
  FROM l, (SELECT median({c}) AS m FROM l WHERE l_returnflag IN ({s})) WHERE l_returnflag IN ({s})"""
    return f"WITH l AS (SELECT *, {late} FROM lineitem) " + " UNION ALL ".join(one.format(u="+".join(u), c=c, s=str(u)[1:-1]) for u in _UNIONS for c in _COLUMNS)


@query(_statistics_sql())
def split_statistics(spark, sf_dir):
    """Nulls, exact medians, and means and deviations of what the median filled, of five columns in three
    unions of splits from one pass (AG-19, AG-20, ML-01 to ML-03, G6-8 to G6-10)."""
    rows = table(spark, sf_dir, "lineitem").withColumn("late", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_linenumber")))
    counts = statistics.value_counts(rows, _COLUMNS, [], "l_returnflag", ["R", "A", "N"])
    told = [("+".join(u), c, s.rows, s.nulls[c], s.fill[c], s.mean[c], s.deviation[c]) for u, s in zip(_UNIONS, statistics.summaries(counts, _UNIONS)) for c in _COLUMNS]
    found = spark.createDataFrame(told, "splits string, feature string, rows long, nulls long, middle double, mean double, deviation double")
    return found.select("splits", "feature", "rows", "nulls", *[r(c, c) for c in ("middle", "mean", "deviation")])


@query("""
WITH m AS (SELECT l_partkey, avg(l_quantity) AS q, avg(l_extendedprice) AS y FROM lineitem GROUP BY l_partkey),
b AS (SELECT sum((l_quantity - q) * (l_extendedprice - y)) / sum((l_quantity - q) * (l_quantity - q)) AS b FROM lineitem JOIN m USING (l_partkey))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(y + b * (l_quantity - q), 3) AS predicted FROM lineitem JOIN m USING (l_partkey), b
""")
def level_effects_predict(spark, sf_dir):
    """Least squares with a level for each part, from means and covariances by level alone (ML-04, ML-06)."""
    rows = table(spark, sf_dir, "lineitem").where("l_partkey is not null")
    model = regress.fit_level_effects(rows, ["l_quantity"], "l_partkey", "l_extendedprice")
    scored = regress.predicted_by_level(rows, "l_partkey", model, "guess")
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("guess", 3).alias("predicted"))
