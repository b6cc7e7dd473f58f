"""Registered queries over the given tables, each with the SQL it is checked against.

Doubles are rounded to six digits on both sides, as engines sum in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.functions import scalars as fn
from tideline.operators import align, encode, history, reduce, regress, splits

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    from tideline.plans import evidence_queries, model_queries, quality_queries, season_queries, source_queries, upkeep_queries  # noqa: F401  (they register theirs)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def registered_sql(*names: str) -> list[str]:
    """The SQL of queries registered so far."""
    return [_SQL[n] for n in names]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(x, name: str):
    return fn.rounded(x if not isinstance(x, str) else F.col(x)).alias(name)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with one row for each (order, line number)."""
    raw = table(spark, sf_dir, "lineitem")
    return raw.groupBy("l_orderkey", "l_linenumber").agg(F.round(F.sum("l_extendedprice"), 2).alias("price"), F.min("l_shipdate").alias("shipped"), F.sum("l_quantity").alias("quantity"))


LINES = "lines AS (SELECT l_orderkey, l_linenumber, round(sum(l_extendedprice), 2) AS price, min(l_shipdate) AS shipped, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)"


# --- windows and as-of joins -------------------------------------------------------------


@query("""
SELECT event_id, user_id, coalesce(nxt, ts + to_microseconds(CAST(round(value * 1e6) AS BIGINT))) AS window_end, nxt IS NULL AS is_last, true AS has_complete_window
FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events)
""")
def interval_windows(spark, sf_dir):
    """Windows between a user's events (WN-01)."""
    found = align.interval_windows(table(spark, sf_dir, "events"), ["user_id"], ["ts"], "ts", "value")
    return found.select("event_id", "user_id", "window_end", "is_last", "has_complete_window")


def _sessions(events: DataFrame) -> DataFrame:
    opened = events.where("event_type = 'signup'").select("user_id", "event_id", "ts", (F.col("value") * 60).alias("seconds"))
    return align.interval_windows(opened, ["user_id"], ["ts"], "ts", "seconds").withColumnsRenamed({"event_id": "opened_by", "ts": "start"})


_SESSIONS = """s AS (SELECT user_id, event_id AS opened_by, ts AS start, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), ts + to_microseconds(CAST(round(value * 60 * 1e6) AS BIGINT))) AS window_end
  FROM events WHERE event_type = 'signup')"""


@query(f"""
WITH {_SESSIONS},
e AS (SELECT e.*, s.opened_by FROM (SELECT * FROM events WHERE event_type IN ('view', 'click', 'error')) e ASOF JOIN s ON e.user_id = s.user_id AND e.ts >= s.start WHERE e.ts < s.window_end),
a AS (SELECT opened_by, count(*) AS samples, min(value) AS value_min, avg(value) AS value_mean, max(value) AS value_max,
  avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_share FROM e GROUP BY opened_by)
SELECT s.user_id, s.opened_by, s.start, s.window_end, samples, round(value_min, 6) AS value_min, round(value_mean, 6) AS value_mean, round(value_max, 6) AS value_max, round(error_share, 6) AS error_share
FROM s LEFT JOIN a USING (opened_by)
""")
def asof_containment_agg(spark, sf_dir):
    """Events inside a user's signup windows, reduced to the window and joined back (JN-01, FLT-02, FLT-03, AG-01, JN-05)."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    windows = _sessions(events)
    inside = align.assign_to_windows(events.where(F.col("event_type").isin("view", "click", "error")), windows, "ts", "start", "window_end", ["user_id"], ["opened_by"], complete=F.col("has_complete_window"))
    reduced = inside.groupBy("opened_by").agg(F.count(F.lit(1)).alias("samples"), r(F.min("value"), "value_min"), r(F.avg("value"), "value_mean"), r(F.max("value"), "value_max"), r(F.avg((F.col("event_type") == "error").cast("double")), "error_share"))
    return reduce.merge_on_grain(windows.select("user_id", "opened_by", "start", "window_end"), reduced, ["opened_by"])


@query("""
SELECT p.event_id, p.user_id, round(v.value, 6) AS last_view, v.event_id AS view_id
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def asof_value_boundary(spark, sf_dir):
    """The last view before each purchase of a user (JN-02)."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", "event_type")
    found = align.asof_last(events.where("event_type = 'purchase'"), events.where("event_type = 'view'"), "ts", "ts", ["user_id"], ["event_id"])
    return found.select("event_id", "user_id", r("match.value", "last_view"), F.col("match.event_id").alias("view_id"))


@query("""
SELECT event_id, CASE WHEN age <= 7200 THEN error_id END AS error_id, round(CASE WHEN age <= 7200 THEN age END, 6) AS age_s FROM (
  SELECT p.event_id, e.event_id AS error_id, (epoch_us(p.ts) - epoch_us(e.ts)) / 1e6 AS age
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e ON p.ts >= e.ts)
""")
def asof_tolerance(spark, sf_dir):
    """The last error of any user within two hours before each purchase, by hourly stretches (JN-03)."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    found = align.asof_within(events.where("event_type = 'purchase'"), events.where("event_type = 'error'"), "ts", "ts", 7200, tie=["event_id"], bucket="hour")
    return found.select("event_id", F.col("match.event_id").alias("error_id"), r("age_s", "age_s"))


@query(f"""
WITH {LINES}, ranges AS (SELECT l_orderkey, l_linenumber AS low, l_linenumber + 1 AS high, price AS start_price FROM lines WHERE l_linenumber % 3 = 1)
SELECT l.l_orderkey, l.l_linenumber, CASE WHEN l.l_linenumber <= r.high THEN r.low END AS low, CASE WHEN l.l_linenumber <= r.high THEN CAST(l.l_linenumber - r.low + 1 AS INT) END AS place,
  round(CASE WHEN l.l_linenumber <= r.high THEN r.start_price + (l.l_linenumber - r.low) END, 6) AS aged
FROM lines l ASOF LEFT JOIN ranges r ON l.l_orderkey = r.l_orderkey AND l.l_linenumber >= r.low
""")
def asof_integer_range(spark, sf_dir):
    """The range of line numbers that holds a line, confirmed against its end (JN-04, PRJ-10)."""
    all_lines = lines(spark, sf_dir)
    ranges = all_lines.where("l_linenumber % 3 = 1").select("l_orderkey", F.col("l_linenumber").alias("low"), (F.col("l_linenumber") + 1).alias("high"), F.col("price").alias("start_price"))
    found = align.range_confirmed(all_lines, ranges, "l_linenumber", "low", "high", ["l_orderkey"])
    into = F.col("l_linenumber") - F.col("range.low")
    return found.select("l_orderkey", "l_linenumber", F.col("range.low").alias("low"), (into + 1).alias("place"), r(F.col("range.start_price") + into, "aged"))


# --- reductions and lookups --------------------------------------------------------------


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS samples, round(avg(CASE WHEN l_quantity <= 45 THEN l_quantity END), 6) AS quantity_mean,
  round(max(CASE WHEN l_discount <= 0.08 THEN l_discount END), 6) AS discount_max, count(*) FILTER (l_quantity > 45 OR l_discount > 0.08) AS invalid
FROM lineitem GROUP BY ALL
""")
def masked_agg(spark, sf_dir):
    """Impossible values masked one by one, their rows kept and counted (FLT-05, AG-01)."""
    ok_q, ok_d = F.col("l_quantity") <= 45, F.col("l_discount") <= 0.08
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("samples"), r(F.avg(reduce.masked(F.col("l_quantity"), ok_q)), "quantity_mean"), r(F.max(reduce.masked(F.col("l_discount"), ok_d)), "discount_max"), F.count_if(~ok_q | ~ok_d).alias("invalid"))


@query("SELECT user_id, event_type, arg_max(event_id, ts) AS event_id, round(arg_max(value, ts), 6) AS value, count(*) AS n FROM events GROUP BY ALL")
def last_record_per_group(spark, sf_dir):
    """The last event of each user and type, all fields from one row (AG-02, SO-05, AG-03)."""
    found = reduce.last_record(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts"], ["event_id", "value"], "n")
    return found.withColumn("value", fn.rounded(F.col("value")))


@query("""
SELECT user_id, round(arg_min(value, ts) FILTER (event_type = 'error'), 6) AS first_error, round(arg_min(value, ts) FILTER (event_type = 'purchase'), 6) AS first_purchase FROM events GROUP BY user_id
""")
def first_nonnull_per_group(spark, sf_dir):
    """Each user's first value of two kinds that is not null (AG-04)."""
    kind = lambda k: F.when(F.col("event_type") == k, F.col("value"))
    events = table(spark, sf_dir, "events").withColumns({"first_error": kind("error"), "first_purchase": kind("purchase")})
    found = reduce.first_known(events, ["user_id"], ["ts"], ["first_error", "first_purchase"])
    return found.select("user_id", r("first_error", "first_error"), r("first_purchase", "first_purchase"))


@query("""
SELECT c_custkey, c_nationkey, s_name AS first_supplier FROM customer LEFT JOIN (SELECT s_nationkey, s_name FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1) ON s_nationkey = c_nationkey
""")
def lookup_first_wins(spark, sf_dir):
    """The first supplier of each customer's nation (JN-06, ST-04)."""
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "c_nationkey")
    found = reduce.lookup(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), suppliers, ["c_nationkey"], ["s_suppkey"], ["s_name"])
    return found.select("c_custkey", "c_nationkey", F.col("s_name").alias("first_supplier"))


@query("SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def count_lookup_default0(spark, sf_dir):
    """Orders of each customer, 0 for none (JN-07, AG-03)."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return reduce.count_onto(table(spark, sf_dir, "customer").select("c_custkey"), orders, ["c_custkey"], "orders")


@query("SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1")
def dup_surplus(spark, sf_dir):
    """Line numbers that repeat, and the rows beyond the first (AG-06, AG-11)."""
    return reduce.surplus(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderpriority, min(n) AS least, max(n) AS most, count(*) AS orders FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderpriority
""")
def two_level_minmax(spark, sf_dir):
    """Lines of each order, then their extremes by priority (AG-07)."""
    sizes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(table(spark, sf_dir, "orders"), "o_orderkey").groupBy("o_orderpriority").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("orders"))


@query("""
SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT date_trunc('month', l_shipdate)) AS months, sum(l_quantity) AS quantity, bool_and(l_discount <= 0.1) AS all_modest, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem
""")
def report_summary(spark, sf_dir):
    """Distinct counts, sums, conditional counts and a conjunction in one pass (AG-05, AG-15)."""
    return table(spark, sf_dir, "lineitem").agg(F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_suppkey").alias("suppliers"), F.count_distinct(F.date_trunc("month", "l_shipdate")).alias("months"), F.sum("l_quantity").alias("quantity"), F.bool_and(F.col("l_discount") <= 0.1).alias("all_modest"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))


# --- history -----------------------------------------------------------------------------


@query("SELECT event_id, round(lag(value) OVER w, 6) AS v_prev_1, round(value - lag(value) OVER w, 6) AS v_delta_1 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
def lag_delta(spark, sf_dir):
    """Each event's previous value and the difference (WN-02)."""
    return history.add_history(table(spark, sf_dir, "events"), ["user_id"], ["ts"], "value", "v").select("event_id", r("v_prev_1", "v_prev_1"), r("v_delta_1", "v_delta_1"))


@query("""
SELECT event_id, round(avg(value) OVER w3, 6) AS v_roll_mean_3, round(min(value) OVER w3, 6) AS v_roll_min_3, round(stddev_samp(value) OVER w3, 6) AS v_roll_std_3,
  round(avg(value) OVER w5, 6) AS v_roll_mean_5, round(min(value) OVER w5, 6) AS v_roll_min_5, round(stddev_samp(value) OVER w5, 6) AS v_roll_std_5, round(value - avg(value) OVER w5, 6) AS v_vs_roll_mean_5
FROM events WINDOW w3 AS (PARTITION BY user_id ORDER BY ts ROWS 2 PRECEDING), w5 AS (PARTITION BY user_id ORDER BY ts ROWS 4 PRECEDING)
""")
def rolling_3_5(spark, sf_dir):
    """Trailing means, minima and deviations over three and five rows (WN-03, WN-04, WN-05)."""
    names = [n for n in history.temporal_names("v") if "roll" in n]
    return history.add_history(table(spark, sf_dir, "events"), ["user_id"], ["ts"], "value", "v").select("event_id", *[r(n, n) for n in names])


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) + 1e-9, 6) AS v_expanding_mean FROM events")
def expanding_mean(spark, sf_dir):
    """The mean of a user's values so far, moved off the halves of rounding (WN-06)."""
    return history.add_history(table(spark, sf_dir, "events"), ["user_id"], ["ts"], "value", "v").select("event_id", r(F.col("v_expanding_mean") + 1e-9, "v_expanding_mean"))


@query(f"""
WITH {LINES} SELECT l_orderkey, l_linenumber, round(CASE WHEN lead(l_linenumber) OVER w = l_linenumber + 1 THEN lead(price) OVER w END, 6) AS next_price, coalesce(lead(l_linenumber) OVER w = l_linenumber + 1, false) AS has_target
FROM lines WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber)
""")
def next_target_contiguous(spark, sf_dir):
    """The next line's price where its number follows directly (WN-07)."""
    found = history.add_target(lines(spark, sf_dir), ["l_orderkey"], "l_linenumber", "price", "next_price")
    return found.select("l_orderkey", "l_linenumber", r("next_price", "next_price"), "has_target")


@query(f"""
WITH {LINES}, n AS (SELECT *, lead(l_linenumber) OVER w AS nx FROM lines WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT count(*) AS rows, count(*) FILTER (nx = l_linenumber + 1) AS with_target, count(*) FILTER (nx IS NULL OR nx <> l_linenumber + 1) AS without_target, count(*) FILTER (nx IS NULL) AS last_of_group,
  count(*) FILTER (nx <> l_linenumber + 1) AS gap_in_numbers, CAST(0 AS BIGINT) AS next_value_null, count(*) FILTER (price IS NULL) AS own_value_null FROM n
""")
def target_null_reasons(spark, sf_dir):
    """Why lines have no target (AG-24)."""
    found = history.add_target(lines(spark, sf_dir), ["l_orderkey"], "l_linenumber", "price", "next_price")
    return history.target_reasons(found, ["l_orderkey"], "l_linenumber", "price", "next_price")


@query(f"""
WITH {LINES}, t AS (SELECT *, CASE WHEN lead(l_linenumber) OVER w = l_linenumber + 1 THEN lead(price) OVER w END AS next_price FROM lines WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber))
SELECT t.l_orderkey, t.l_linenumber, round(n.price, 6) AS joined_price, (t.next_price IS NULL AND n.price IS NULL) OR coalesce(abs(t.next_price - n.price) <= 1e-9, false) AS agrees
FROM t LEFT JOIN lines n ON n.l_orderkey = t.l_orderkey AND n.l_linenumber = t.l_linenumber + 1
""")
def target_self_join(spark, sf_dir):
    """The target again by a self-join, compared null-safely within a tolerance (JN-09, FLT-10)."""
    found = history.add_target(lines(spark, sf_dir), ["l_orderkey"], "l_linenumber", "price", "next_price")
    following = lines(spark, sf_dir).select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("price").alias("joined_price"))
    return found.join(following, ["l_orderkey", "l_linenumber"], "left").select("l_orderkey", "l_linenumber", r("joined_price", "joined_price"), fn.close(F.col("next_price"), F.col("joined_price")).alias("agrees"))


@query("SELECT event_id, user_id, min(ts) OVER (PARTITION BY user_id) AS session_date FROM events")
def group_min_broadcast(spark, sf_dir):
    """Each user's first time on all of their events (WN-08)."""
    return history.session_start(table(spark, sf_dir, "events"), "user_id", "ts").select("event_id", "user_id", "session_date")


@query("SELECT user_id, count(*) FILTER (value < before) AS inversions FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) GROUP BY user_id")
def order_inversions(spark, sf_dir):
    """Values below their predecessor in file order (WN-09)."""
    return history.order_inversions(table(spark, sf_dir, "events"), ["user_id"], "event_id", "value")


@query("SELECT event_id, ts FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) WHERE (rn - 1) % 7 = 0")
def every_kth_row(spark, sf_dir):
    """Every seventh event of the whole order (WN-11)."""
    return history.every_kth(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 7, F.date_trunc("day", "ts"))


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN round(value, 6) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events
""")
def forward_fill(spark, sf_dir):
    """A sparse state carried forward: the value of the last purchase so far (WN-14)."""
    w = Window.partitionBy("user_id").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    state = F.when(F.col("event_type") == "purchase", fn.rounded(F.col("value")))
    return table(spark, sf_dir, "events").select("event_id", F.last(state, ignorenulls=True).over(w).alias("last_purchase"))


@query("SELECT user_id, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def newest_per_scope(spark, sf_dir):
    """The newest event of each user (WN-13, SO-06)."""
    return reduce.last_record(table(spark, sf_dir, "events"), ["user_id"], ["ts"], ["event_id", "ts"])


# --- chronological splits ----------------------------------------------------------------


def _orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("session"), F.col("o_orderdate").alias("at"), F.year("o_orderdate").alias("year"))


_CALENDAR = """c AS (SELECT session, min(y) AS year, min(o_orderdate) AS session_date, count(*) AS rows, row_number() OVER (ORDER BY min(o_orderdate), session) - 1 AS place, count(*) OVER () AS n
  FROM (SELECT *, strftime(o_orderdate, '%Y-%m') AS session, year(o_orderdate) AS y FROM orders) GROUP BY session)"""
_OUT = "SELECT session, CAST(year AS INT) AS year, session_date, rows, CAST(place AS INT) AS place, split FROM x"


@query(f"""
WITH {_CALENDAR}, x AS (SELECT *, CASE WHEN place < greatest(1, round_even(n * 0.6, 0)) THEN 'train' WHEN place < greatest(1, round_even(n * 0.6, 0)) + round_even(n * 0.2, 0) THEN 'validation' ELSE 'test' END AS split FROM c) {_OUT}
""")
def calendar_split_fraction(spark, sf_dir):
    """Months in time, cut at 60 and 80 per cent (AG-08, WN-12, SP-01)."""
    return splits.by_fraction(splits.calendar(_orders(spark, sf_dir), "session", "at", "year"))


@query(f"""
WITH {_CALENDAR}, x AS (SELECT *, CASE WHEN year <= 1998 THEN 'train' WHEN year <= 2000 THEN 'validation' ELSE 'test' END AS split FROM c) {_OUT}
""")
def calendar_split_years(spark, sf_dir):
    """Months by their year (SP-02)."""
    return splits.by_years(splits.calendar(_orders(spark, sf_dir), "session", "at", "year"), [1995, 1996, 1997, 1998], [1999, 2000], [2001])


@query(f"""
WITH {_CALENDAR}, y AS (SELECT *, year <= 1998 AS t, row_number() OVER (PARTITION BY year <= 1998 ORDER BY place) - 1 AS p, count(*) OVER (PARTITION BY year <= 1998) AS m FROM c),
x AS (SELECT *, CASE WHEN t THEN 'train' WHEN p < ceil(m * 0.5) THEN 'validation' ELSE 'test' END AS split FROM y) {_OUT}
""")
def calendar_split_train_then_split(spark, sf_dir):
    """Given years train, the rest is cut in half (SP-03)."""
    return splits.train_years_then_split(splits.calendar(_orders(spark, sf_dir), "session", "at", "year"), [1995, 1996, 1997, 1998])


_SPLIT = f"""{_CALENDAR}, x AS (SELECT *, CASE WHEN place < greatest(1, round_even(n * 0.6, 0)) THEN 'train' WHEN place < greatest(1, round_even(n * 0.6, 0)) + round_even(n * 0.2, 0) THEN 'validation' ELSE 'test' END AS split FROM c),
o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, split FROM orders JOIN x ON session = strftime(o_orderdate, '%Y-%m'))"""


@query(f"WITH {_SPLIT} SELECT o_orderkey, split FROM o")
def split_assignment(spark, sf_dir):
    """Every order with its month's split (JN-13)."""
    orders = _orders(spark, sf_dir)
    return splits.assign(orders, splits.by_fraction(splits.calendar(orders, "session", "at", "year")), "session").select("o_orderkey", "split")


@query(f"WITH {_SPLIT} SELECT split, count(*) AS sessions, CAST(sum(rows) AS BIGINT) AS rows, min(session_date) AS first, max(session_date) AS last, count(DISTINCT year) AS years FROM x GROUP BY split")
def split_description(spark, sf_dir):
    """Sessions, rows, dates and years of each split (AG-18)."""
    return splits.describe(calendar_split_fraction(spark, sf_dir))


@query(f"""
WITH {_SPLIT}, b AS (SELECT split, min(session_date) AS lo, max(session_date) AS hi, list_position(['train', 'validation', 'test'], split) AS k FROM x GROUP BY split)
SELECT a.split AS earlier, b.split AS later, a.hi AS last_earlier, b.lo AS first_later, a.hi < b.lo AS ordered FROM b a JOIN b ON b.k = a.k + 1
""")
def chronology_bounds(spark, sf_dir):
    """Whether each split ends before the next begins (AG-23)."""
    return splits.chronology(calendar_split_fraction(spark, sf_dir))


@query(f"WITH {_SPLIT} SELECT split, count(*) AS sessions FROM x GROUP BY split HAVING count(*) < 20")
def thin_splits(spark, sf_dir):
    """Splits with fewer than twenty sessions (SP-04)."""
    return splits.thin(calendar_split_fraction(spark, sf_dir), 20)


# --- joins for checks, set operations ------------------------------------------------------


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)")
def anti_join_refs(spark, sf_dir):
    """Parts never ordered in bulk (JN-11, JN-18)."""
    bulk = table(spark, sf_dir, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").join(bulk, "p_partkey", "left_anti").select("p_partkey", "p_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_join_refs(spark, sf_dir):
    """Customers with a finished order (JN-19, JN-20)."""
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").join(done, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("""
WITH u AS (SELECT DISTINCT user_id FROM events), k AS (SELECT DISTINCT event_type FROM events), p AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 60)
SELECT u.user_id, k.event_type, f.reason FROM u CROSS JOIN k LEFT JOIN (SELECT user_id, arg_min(event_type, ts) AS reason FROM events WHERE event_type = 'error' GROUP BY user_id) f ON f.user_id = u.user_id
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.user_id = u.user_id AND p.event_type = k.event_type)
""")
def coverage_matrix(spark, sf_dir):
    """Users and event types without a large value, with a first reason (JN-12, JN-14)."""
    events = table(spark, sf_dir, "events")
    absent = reduce.coverage(events.select("user_id").distinct(), events.select("event_type").distinct(), events.where("value > 60"))
    reasons = reduce.first_row(events.where("event_type = 'error'"), ["user_id"], ["ts"]).select("user_id", F.col("event_type").alias("reason"))
    return absent.join(reasons, "user_id", "left")


@query("""
SELECT c_nationkey AS nation, 'either' AS op FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL
SELECT c_nationkey, 'both' FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL
SELECT c_nationkey, 'customer_only' FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
""")
def union_except_intersect(spark, sf_dir):
    """Nations of customers and suppliers by set operation (ST-01, ST-02, ST-03, ST-06)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    named = lambda df, op: df.withColumn("op", F.lit(op))
    return named(c.unionByName(s).distinct(), "either").unionByName(named(c.intersect(s), "both")).unionByName(named(c.subtract(s), "customer_only"))


@query("""
WITH j AS (SELECT c_custkey, o_orderkey, o_totalprice, o_orderstatus FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 300000) ON o_custkey = c_custkey)
SELECT 'c_custkey' AS column, count(*) FILTER (c_custkey IS NULL) AS nulls, round(count(*) FILTER (c_custkey IS NULL) / count(*), 4) AS share FROM j UNION ALL
SELECT 'o_orderkey', count(*) FILTER (o_orderkey IS NULL), round(count(*) FILTER (o_orderkey IS NULL) / count(*), 4) FROM j UNION ALL
SELECT 'o_totalprice', count(*) FILTER (o_totalprice IS NULL), round(count(*) FILTER (o_totalprice IS NULL) / count(*), 4) FROM j UNION ALL
SELECT 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL), round(count(*) FILTER (o_orderstatus IS NULL) / count(*), 4) FROM j
""")
def null_profile(spark, sf_dir):
    """Null shares after a left join, all columns in one pass (AG-13, AG-09)."""
    large = table(spark, sf_dir, "orders").where("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    joined = table(spark, sf_dir, "customer").join(large, "c_custkey", "left")
    return reduce.null_shares(joined, ["c_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"])


@query("""
WITH c AS (SELECT c_custkey, arg_min(o_orderkey, o_orderdate) AS first_order, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT count(*) AS rows_out, count(first_order) AS matched, count(*) - count(first_order) AS unmatched FROM c
""")
def stage_counters(spark, sf_dir):
    """Rows out, matched and unmatched of a lookup (AG-16)."""
    first = reduce.first_row(table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], ["o_orderdate", "o_orderkey"])
    joined = reduce.merge_on_grain(table(spark, sf_dir, "customer").select("c_custkey"), first.select("c_custkey", "o_orderkey"), ["c_custkey"])
    return joined.agg(F.count(F.lit(1)).alias("rows_out"), F.count("o_orderkey").alias("matched"), (F.count(F.lit(1)) - F.count("o_orderkey")).alias("unmatched"))


# --- scalar functions and predicates --------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity <= 2 THEN 'below' WHEN l_quantity > 48 THEN 'above' WHEN l_quantity > 40 THEN 'implausible' WHEN l_quantity < 5 THEN 'undocumented' ELSE 'ok' END AS band FROM lineitem
""")
def range_bands(spark, sf_dir):
    """The first bound that a quantity breaks (FLT-12, DQ-04)."""
    label = fn.band(F.col("l_quantity"), low=2, high=48, plausible=(0, 40), documented=(5, 50), above_low=True)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", label.alias("band"))


@query("""
SELECT event_id, regexp_matches(gap, '^\\+\\d+ LAPS?$') AS lapped, regexp_matches(props, '^\\{"k": \\d+\\}$') AS plain FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN '+' || (event_id % 5) || ' LAPS' ELSE CAST(event_id AS VARCHAR) END AS gap FROM events)
""")
def text_pattern(spark, sf_dir):
    """Anchored patterns on text (FLT-11)."""
    gap = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("+"), (F.col("event_id") % 5).cast("string"), F.lit(" LAPS"))).otherwise(F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", gap.rlike(fn.LAPPED).alias("lapped"), F.col("props").rlike(r'^\{"k": \d+\}$').alias("plain"))


@query("""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE TRY_CAST(event_id % 100 AS DOUBLE) / 10 END AS number, CASE WHEN event_id % 4 <> 1 THEN ts END AS instant
FROM events
""")
def safe_cast(spark, sf_dir):
    """Text to numbers and instants, null where it is neither (PRJ-01, PRJ-02)."""
    bad = F.element_at(F.array(F.lit("1.5d"), F.lit("NaN"), F.lit("abc")), (F.col("event_id") / 4 % 3 + 1).cast("int"))
    number = F.when(F.col("event_id") % 4 == 0, bad).otherwise(F.format_string("%.1f", F.col("event_id") % 100 / 10))
    instant = F.when(F.col("event_id") % 4 == 1, "2023").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return table(spark, sf_dir, "events").select("event_id", fn.number(number).alias("number"), fn.instant(instant).cast("timestamp_ntz").alias("instant"))


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, props->>'$.missing' AS missing FROM events")
def json_fields(spark, sf_dir):
    """Fields of a JSON document, absent ones null (SRC-01, PRJ-03)."""
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.try_variant_get(v, "$.missing", "string").alias("missing"))


@query("SELECT c_custkey, lower(trim(c_mktsegment)) IN ('building', 'machinery') AS wanted, c_nationkey IN (1, 2, 3) AS near FROM customer")
def membership(spark, sf_dir):
    """Membership regardless of case, and in a set of codes (FLT-06, FLT-09)."""
    return table(spark, sf_dir, "customer").select("c_custkey", fn.member(F.col("c_mktsegment"), " Building", "MACHINERY").alias("wanted"), F.col("c_nationkey").isin(1, 2, 3).alias("near"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half FROM lineitem")
def half_even_round(spark, sf_dir):
    """Halves to the even neighbour (PRJ-05)."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", fn.whole(F.col("l_quantity") / 2).alias("half"))


@query("SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS pos, event_id FROM events QUALIFY pos <= 5")
def topk_examples(spark, sf_dir):
    """The first five events of each type (SO-03, SO-04, FLT-15)."""
    return reduce.examples(table(spark, sf_dir, "events"), ["event_type"], "event_id", "event_id").select("event_type", "pos", "event_id")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate NULLS LAST, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
""")
def stable_order(spark, sf_dir):
    """A multi-key order made total by further keys, nulls last (SO-01, SO-02)."""
    w = Window.partitionBy("l_orderkey").orderBy(F.col("l_shipdate").asc_nulls_last(), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").withColumn("rn", F.row_number().over(w)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rn")


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def content_fingerprint(spark, sf_dir):
    """SHA-256 of each document (AG-26)."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


# --- learned statistics, encoding, regression -------------------------------------------------


@query("SELECT c_mktsegment, round(median(c_acctbal), 6) AS middle, round(avg(c_acctbal), 6) AS mean, round(stddev_pop(c_acctbal), 6) AS deviation FROM customer GROUP BY c_mktsegment")
def median_std_pop(spark, sf_dir):
    """Exact medians and population deviations (AG-19, AG-20)."""
    x = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(r(F.median(x), "middle"), r(F.avg(x), "mean"), r(F.stddev_pop(x), "deviation"))


@query("""
SELECT 'l_quantity' AS feature, round(corr(l_quantity, l_extendedprice), 6) AS corr, abs(corr(l_quantity, l_extendedprice)) >= 0.5 AS suspicious FROM lineitem UNION ALL
SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6), abs(corr(l_discount, l_extendedprice)) >= 0.5 FROM lineitem
""")
def pearson(spark, sf_dir):
    """Correlation of features with a target in one pass (AG-17)."""
    found = regress.correlations(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", 0.5)
    return found.withColumn("corr", fn.rounded(F.col("corr")))


@query("SELECT CAST(list_sort(list_distinct(list(coalesce(o_orderpriority, '__MISSING__')))) AS VARCHAR[]) AS levels FROM orders")
def sorted_categories(spark, sf_dir):
    """Sorted distinct categories, a missing one included (AG-21)."""
    return table(spark, sf_dir, "orders").agg(F.sort_array(F.collect_set(encode.category("o_orderpriority"))).alias("levels"))


def _matrix(spark, sf_dir) -> tuple[DataFrame, encode.Encoder]:
    orders = _orders(spark, sf_dir)
    sessions = splits.by_fraction(splits.calendar(orders, "session", "at", "year"))
    rows = splits.assign(orders, sessions, "session").withColumn("price", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")))
    return rows, encode.fit(rows.where("split = 'train'"), ["price"], ["o_orderpriority"])


@query(f"""
WITH {_SPLIT}, p AS (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price FROM o), f AS (SELECT median(price) AS fill FROM p WHERE split = 'train'),
q AS (SELECT p.*, coalesce(price, fill) AS filled, CAST(price IS NULL AS DOUBLE) AS missing FROM p, f), s AS (SELECT avg(filled) AS m, stddev_pop(filled) AS d, avg(missing) AS mm, stddev_pop(missing) AS dm FROM q WHERE split = 'train')
SELECT o_orderkey, split, round((filled - m) / d, 6) AS price, round((missing - mm) / dm, 6) AS missingindicator_price, CAST(o_orderpriority = '1-URGENT' AS DOUBLE) AS urgent FROM q, s
""")
def encode_train_only(spark, sf_dir):
    """Imputation, indicator, scaling and one-hot, all learned from training rows (ML-01 to ML-04, PRJ-11, PRJ-16)."""
    rows, encoder = _matrix(spark, sf_dir)
    return encoder.apply(rows, "o_orderkey", "split").select("o_orderkey", "split", r("price", "price"), r("missingindicator_price", "missingindicator_price"), F.col("`o_orderpriority_1-URGENT`").alias("urgent"))


@query(f"""
WITH {_SPLIT}, m AS (SELECT avg(o_totalprice) AS p FROM o WHERE split = 'train'), t AS (SELECT o_totalprice AS y, p, o_totalprice - p AS e FROM o, m WHERE split = 'test')
SELECT count(*) AS rows, count(*) AS finite_rows, count(*) FILTER (y = 0) AS zero_targets, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e / y)) * 100, 6) AS mape, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2 FROM t
""")
def regression_metrics(spark, sf_dir):
    """Errors of the mean baseline on the test split (AG-22, ML-07)."""
    rows, _ = _matrix(spark, sf_dir)
    mean = rows.where("split = 'train'").agg(F.avg("o_totalprice").alias("p"))
    found = regress.metrics(rows.where("split = 'test'").crossJoin(F.broadcast(mean)), "o_totalprice", "p")
    return found.select("rows", "finite_rows", "zero_targets", *[r(c, c) for c in ("mae", "rmse", "mape", "r2")])


@query("""
WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 3) AS predicted FROM lineitem, c
""")
def ols_predict(spark, sf_dir):
    """Least squares from one pass of sums, applied as an expression (ML-06)."""
    rows = table(spark, sf_dir, "lineitem")
    a, b = regress.least_squares(rows, ["l_quantity"], "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(regress.prediction(a, b), 3).alias("predicted"))
