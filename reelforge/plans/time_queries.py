"""Events and spans along time: as-of joins, sessions, sliding windows, calendars, spans that hold or meet others."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelforge.operators import intervals, runs
from reelforge.plans.bindings import table
from reelforge.plans.registry import query

CLICKS = "clicks AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' GROUP BY user_id, ts)"


@query("asof_anchor", f"""
WITH {CLICKS} SELECT e.event_id, e.user_id, c.ts AS ts_asof, c.value AS value_asof
FROM (SELECT * FROM events WHERE event_type <> 'click') e ASOF LEFT JOIN clicks c ON e.user_id = c.user_id AND e.ts >= c.ts""")
def asof_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last anchor event of its user before it."""
    events = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "ts")
    others = events.where("event_type <> 'click'").select("event_id", "user_id", "ts")
    found = runs.asof_join(others, events.where("event_type = 'click'"), ["user_id"], "ts", ["value"])
    return found.select("event_id", "user_id", "ts_asof", "value_asof")


@query("asof_everyone", """
WITH clicks AS (SELECT ts, max(value) AS value, 1 AS one FROM events WHERE event_type = 'click' GROUP BY ts)
SELECT e.event_id, c.ts AS ts_asof, c.value AS value_asof
FROM (SELECT *, 1 AS one FROM events WHERE event_type <> 'click') e ASOF LEFT JOIN clicks c ON e.one = c.one AND e.ts > c.ts""")
def asof_everyone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the last anchor event of anybody strictly before it: all rows have one key."""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "value", "ts").withColumn("one", F.lit(1))
    others = events.where("event_type <> 'click'").select("event_id", "one", "ts")
    found = runs.asof_join(others, events.where("event_type = 'click'"), ["one"], "ts", ["value"], strict=True)
    return found.select("event_id", "ts_asof", "value_asof")


@query("user_sessions", """
WITH marked AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOURS THEN 1 ELSE 0 END AS opened FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, round(sum(value), 4) AS total
FROM numbered GROUP BY user_id, no""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "user_id", "value", "ts")
    found = runs.sessions(events, ["user_id"], "ts", "6 hours", {"total": F.col("value")})
    return found.withColumn("total", F.round("total", 4))


@query("sliding_windows", """
SELECT event_type, date_trunc('day', ts) - to_days(back::INTEGER) AS window_start, count(*) AS n_events, round(sum(value), 4) AS total
FROM events, range(7) AS steps(back) GROUP BY event_type, date_trunc('day', ts) - to_days(back::INTEGER)""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks that begin every day, per type of event."""
    events = table(spark, sf_dir, "events", "event_type", "value", "ts")
    found = runs.sliding_totals(events, ["event_type"], "ts", "7 days", "1 day", {"total": F.col("value")})
    return found.withColumn("total", F.round("total", 4))


@query("series_calendar", """
WITH daily AS (SELECT user_id AS batch_id, event_type AS series, CAST(ts AS DATE) AS date, round(sum(value), 4) AS value FROM events GROUP BY ALL),
days AS (SELECT batch_id, series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily GROUP BY batch_id, series)
SELECT d.batch_id, d.series, d.date, v.value, v.date < d.date AS is_filled
FROM days d ASOF LEFT JOIN daily v ON d.batch_id = v.batch_id AND d.series = v.series AND d.date >= v.date""")
def series_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interest series on a full calendar, days without a value filled by the last one before."""
    events = table(spark, sf_dir, "events", "user_id", "event_type", "value", "ts")
    daily = events.groupBy(F.col("user_id").alias("batch_id"), F.col("event_type").alias("series"), F.to_date("ts").alias("date")).agg(
        F.round(F.sum("value"), 4).alias("value"))
    return runs.on_full_calendar(daily, ["batch_id", "series"], "date", ["value"])


@query("titles_by_year", """
WITH titles AS (SELECT o_orderkey AS row_id, year(o_orderdate) AS start_year, year(o_orderdate) + o_orderkey % 4 AS end_year FROM orders),
years AS (SELECT DISTINCT start_year AS year FROM titles)
SELECT row_id, start_year, end_year, year FROM titles JOIN years ON year BETWEEN start_year AND end_year""")
def titles_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year in which a title runs, of the years in which some title starts."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    start = F.year("o_orderdate").cast("long")
    titles = orders.select(F.col("o_orderkey").alias("row_id"), start.alias("start_year"), (start + F.col("o_orderkey") % 4).alias("end_year"))
    years = titles.select(F.col("start_year").alias("year")).distinct()
    return intervals.points_in_spans(years, titles, "year", "start_year", "end_year").select("row_id", "start_year", "end_year", "year")


@query("orders_in_shipping_spans", """
WITH spans AS (SELECT l_suppkey, l_linenumber, CAST(min(l_shipdate) AS DATE) - DATE '1970-01-01' AS first_day, CAST(max(l_shipdate) AS DATE) - DATE '1970-01-01' AS last_day
  FROM lineitem WHERE l_quantity >= 49 GROUP BY l_suppkey, l_linenumber, year(l_shipdate)),
days AS (SELECT CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS day, count(*) AS n FROM orders GROUP BY ALL)
SELECT l_suppkey, l_linenumber, first_day, last_day, count(*) AS n_days, sum(n)::BIGINT AS n_orders
FROM spans JOIN days ON day BETWEEN first_day AND last_day GROUP BY ALL""")
def orders_in_shipping_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each supplier's yearly span of large shipments, per line number: the days with orders inside it, and the orders."""
    lines = table(spark, sf_dir, "lineitem", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity").where("l_quantity >= 49")
    day = F.unix_date(F.to_date("l_shipdate")).cast("long")
    spans = lines.groupBy("l_suppkey", "l_linenumber", F.year("l_shipdate").alias("_year")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).drop("_year")
    orders = table(spark, sf_dir, "orders", "o_orderdate")
    days = orders.groupBy(F.unix_date(F.to_date("o_orderdate")).cast("long").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    held = intervals.points_in_spans(days, spans, "day", "first_day", "last_day")
    return held.groupBy("l_suppkey", "l_linenumber", "first_day", "last_day").agg(F.count(F.lit(1)).alias("n_days"), F.sum("n").alias("n_orders"))


@query("overlapping_lines", """
WITH spans AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS first_day,
  CAST(l_shipdate AS DATE) - DATE '1970-01-01' + CAST(l_quantity AS BIGINT) AS last_day FROM lineitem)
SELECT a.l_orderkey, a.l_linenumber AS line, b.l_linenumber AS other FROM spans a JOIN spans b
ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.first_day <= b.last_day AND b.first_day <= a.last_day""")
def overlapping_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one order that are on their way at the same time; a line takes as many days as its quantity says."""
    day = F.unix_date(F.to_date("l_shipdate")).cast("long")
    spans = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity").select(
        "l_orderkey", "l_linenumber", day.alias("first_day"), (day + F.col("l_quantity").cast("long")).alias("last_day"))
    met = intervals.overlapping_spans(spans, spans, "first_day", "last_day", ["l_orderkey"])
    return met.where("l_linenumber < l_linenumber_right").select(
        "l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_linenumber_right").alias("other"))
