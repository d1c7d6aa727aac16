"""Paired queries for periods, calendars and report helpers (K29, K88-K97, X1, X5-X7, F-*).

Calendars and holidays are built over the date range of the orders (a one-row bounds
aggregate exploded on an executor), so their size follows the data's calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from growthframe.functions import formatting as FM
from growthframe.functions.semantics import round_half_up
from growthframe.operators import calendar as CA
from growthframe.operators import periods as PE
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

R2 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"
PERIODS = [("current", "2000-01-01", "2000-03-31"), ("custom", "1999-10-01", "1999-12-31"),
           ("previous_year", "1999-01-01", "1999-03-31")]

# Dates of Easter Sunday.
EASTER_SUNDAYS = (
    "1990-04-15", "1991-03-31", "1992-04-19", "1993-04-11", "1994-04-03", "1995-04-16", "1996-04-07", "1997-03-30",
    "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15", "2002-03-31", "2003-04-20", "2004-04-11", "2005-03-27",
    "2006-04-16", "2007-04-08", "2008-03-23", "2009-04-12", "2010-04-04", "2011-04-24", "2012-04-08", "2013-03-31",
    "2014-04-20", "2015-04-05", "2016-03-27", "2017-04-16", "2018-04-01", "2019-04-21", "2020-04-12", "2021-04-04",
    "2022-04-17", "2023-04-09", "2024-03-31", "2025-04-20", "2026-04-05", "2027-03-28", "2028-04-16", "2029-04-01",
    "2030-04-21",
)


@paired("k88_compare_periods", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d, 'current' AS period FROM o WHERE d BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'
UNION ALL SELECT o_orderkey, d, 'custom' FROM o WHERE d BETWEEN DATE '1999-10-01' AND DATE '1999-12-31'
UNION ALL SELECT o_orderkey, d, 'previous_year' FROM o WHERE d BETWEEN DATE '1999-01-01' AND DATE '1999-03-31'
""", covers=("K88", "U1", "M18"))
def k88(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return PE.compare_periods(o, "d", PERIODS)


@paired("k89_compare_measures", f"""
WITH o AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d, o_totalprice, o_orderkey FROM orders)
SELECT o_orderpriority,
  {R2.format(x="SUM(CASE WHEN d BETWEEN DATE '2000-01-01' AND DATE '2000-03-31' THEN o_totalprice END)")} AS revenue_current,
  COUNT(CASE WHEN d BETWEEN DATE '2000-01-01' AND DATE '2000-03-31' THEN o_orderkey END) AS orders_current,
  {R2.format(x="SUM(CASE WHEN d BETWEEN DATE '1999-10-01' AND DATE '1999-12-31' THEN o_totalprice END)")} AS revenue_custom,
  COUNT(CASE WHEN d BETWEEN DATE '1999-10-01' AND DATE '1999-12-31' THEN o_orderkey END) AS orders_custom,
  {R2.format(x="SUM(CASE WHEN d BETWEEN DATE '1999-01-01' AND DATE '1999-03-31' THEN o_totalprice END)")} AS revenue_previous_year,
  COUNT(CASE WHEN d BETWEEN DATE '1999-01-01' AND DATE '1999-03-31' THEN o_orderkey END) AS orders_previous_year
FROM o WHERE d BETWEEN DATE '2000-01-01' AND DATE '2000-03-31' OR d BETWEEN DATE '1999-10-01' AND DATE '1999-12-31'
   OR d BETWEEN DATE '1999-01-01' AND DATE '1999-03-31'
GROUP BY 1
""", covers=("K89", "A3", "P12"))
def k89(spark, sf):
    o = load(spark, sf, "orders")
    out = PE.compare_measures(o, ["o_orderpriority"], "o_orderdate", {
        "revenue": lambda c: round_half_up(F.sum(F.when(c, F.col("o_totalprice"))), 2),
        "orders": lambda c: F.count(F.when(c, F.col("o_orderkey")))}, PERIODS)
    return out


AS_OF = dt.date(2000, 6, 15)
PRESETS = [("M", "N-1"), ("M-1", "P-1"), ("YTD", "N-1"), ("L12M", "P-1")]


# The bounds written out: month to date and the same days a year before; the month before and as many days
# before it; the year to date and the year before; the last twelve full months and as many days before them.
_PRESET_SQL = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
b AS (SELECT * FROM (VALUES
  ('M vs N-1', 'current', DATE '2000-06-01', DATE '2000-06-15'), ('M vs N-1', 'comparison', DATE '1999-06-01', DATE '1999-06-15'),
  ('M-1 vs P-1', 'current', DATE '2000-05-01', DATE '2000-05-31'), ('M-1 vs P-1', 'comparison', DATE '2000-03-31', DATE '2000-04-30'),
  ('YTD vs N-1', 'current', DATE '2000-01-01', DATE '2000-06-15'), ('YTD vs N-1', 'comparison', DATE '1999-01-01', DATE '1999-06-15'),
  ('L12M vs P-1', 'current', DATE '1999-06-01', DATE '2000-05-31'), ('L12M vs P-1', 'comparison', DATE '1998-05-31', DATE '1999-05-31')
) b(preset, side, lo, hi))
SELECT o_orderkey, d, preset, side, date_diff('day', lo, d) + 1 AS day_index FROM o JOIN b ON d BETWEEN lo AND hi
"""


@paired("k90_preset_periods", _PRESET_SQL, covers=("K90", "X3", "S16", "F-d6"))
def k90(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    out = PE.preset_periods(o, "d", PRESETS, AS_OF)
    return out.select("o_orderkey", "d", "preset", "side", F.col("day_index").cast("long").alias("day_index"))


_BOUNDS_SQL = """
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b)"""


def _spine(spark, sf):
    o = load(spark, sf, "orders")
    return CA.spine_from_bounds(o.agg(F.to_date(F.min("o_orderdate")).alias("lo"),
                                      F.to_date(F.max("o_orderdate")).alias("hi")), "lo", "hi")


@paired("k91_densify", _BOUNDS_SQL + f"""
, k AS (SELECT DISTINCT o_orderpriority FROM orders),
per AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS d, SUM(o_totalprice) AS revenue, COUNT(*) AS orders FROM orders GROUP BY 1, 2)
SELECT k.o_orderpriority, s.d, {R2.format(x="COALESCE(per.revenue, 0.0)")} AS revenue, COALESCE(per.orders, 0) AS orders
FROM k CROSS JOIN spine s LEFT JOIN per ON per.o_orderpriority = k.o_orderpriority AND per.d = s.d
""", covers=("K91", "J13", "S18", "S19"))
def k91(spark, sf):
    o = load(spark, sf, "orders")
    per = o.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("d")).agg(
        F.sum("o_totalprice").alias("revenue"), F.count("*").alias("orders"))
    out = CA.densify(per, _spine(spark, sf), "d", ["o_orderpriority"], {"revenue": 0.0, "orders": 0})
    return out.select("o_orderpriority", "d", round_half_up("revenue", 2).alias("revenue"), "orders")


def _holiday_sql(years_cte: str) -> str:
    fixed = " UNION ALL ".join(
        f"SELECT make_date(CAST(year AS BIGINT), {m}, {d}) AS holiday_date, '{n.replace(chr(39), chr(39) * 2)}' AS holiday_name, "
        f"'fixed' AS holiday_type, year FROM {years_cte}" for m, d, n in CA.FIXED_HOLIDAYS)
    movable = " UNION ALL ".join(
        f"SELECT CAST(easter + INTERVAL {off} DAY AS DATE), '{n.replace(chr(39), chr(39) * 2)}', 'movable', year FROM easter"
        for off, n in CA.EASTER_OFFSETS)
    # Easter Sundays of the years that the driver tables hold, written out
    easter_rows = ", ".join(f"({d[:4]}, DATE '{d}')" for d in EASTER_SUNDAYS)
    return f"""
, easter AS (SELECT e.year, e.easter FROM (VALUES {easter_rows}) e(year, easter) JOIN {years_cte} y ON y.year = e.year),
hol AS ({fixed} UNION ALL {movable})"""


@paired("k93_public_holidays", _BOUNDS_SQL + ", yrs AS (SELECT DISTINCT year(d) AS year FROM spine)" + _holiday_sql("yrs") + """
SELECT CAST(year AS INTEGER) AS year, holiday_date, holiday_name, holiday_type FROM hol
""", covers=("K93", "F-d9", "F-m1"))
def k93(spark, sf):
    years = _spine(spark, sf).select(F.year("d").alias("year")).distinct()
    return CA.public_holidays(years)


@paired("k92_calendar", _BOUNDS_SQL + ", yrs AS (SELECT DISTINCT year(d) AS year FROM spine)" + _holiday_sql("yrs") + """
, hd AS (SELECT DISTINCT holiday_date FROM hol)
SELECT strftime(s.d, '%Y-%m-%d') AS id, s.d AS date_actual, year(s.d) AS year_number, CAST(date_trunc('year', s.d) AS DATE) AS year_trunc,
  CASE WHEN quarter(s.d) <= 3 THEN 'exercice ' || CAST(year(s.d) - 1 AS VARCHAR) || '-' || CAST(year(s.d) AS VARCHAR)
       ELSE 'exercice ' || CAST(year(s.d) AS VARCHAR) || '-' || CAST(year(s.d) + 1 AS VARCHAR) END AS fiscal_year,
  quarter(s.d) AS quarter_number, 'Q' || CAST(quarter(s.d) AS VARCHAR) AS quarter_name, CAST(date_trunc('quarter', s.d) AS DATE) AS quarter_trunc,
  month(s.d) AS month_number, monthname(s.d) AS month_name, CAST(date_trunc('month', s.d) AS DATE) AS month_trunc,
  weekofyear(s.d) AS week_number_in_year, CAST(year(s.d) AS VARCHAR) || ' W' || CAST(weekofyear(s.d) AS VARCHAR) AS week_name,
  CAST(date_trunc('week', s.d) AS DATE) AS week_trunc, day(s.d) AS day_number_in_month, isodow(s.d) AS day_number_in_week,
  dayname(s.d) AS day_name, dayname(s.d) NOT IN ('Saturday', 'Sunday') AS day_is_weekday,
  hd.holiday_date IS NOT NULL AS is_public_holiday,
  dayname(s.d) NOT IN ('Saturday', 'Sunday') AND hd.holiday_date IS NULL AS is_business_day
FROM spine s LEFT JOIN hd ON hd.holiday_date = s.d
""", covers=("K92", "F-d2", "F-d3", "F-d8", "M5", "M6"))
def k92(spark, sf):
    cal = CA.calendar(_spine(spark, sf))
    ints = ["year_number", "quarter_number", "month_number", "week_number_in_year", "day_number_in_month",
            "day_number_in_week"]
    return cal.select(*[F.col(c).cast("long").alias(c) if c in ints else F.col(c) for c in cal.columns])


@paired("k29_daily_goals", _BOUNDS_SQL + ", yrs AS (SELECT DISTINCT year(d) AS year FROM spine)" + _holiday_sql("yrs") + f"""
, hd AS (SELECT DISTINCT holiday_date FROM hol),
cal AS (SELECT s.d, CAST(date_trunc('month', s.d) AS DATE) AS month,
               dayname(s.d) NOT IN ('Saturday', 'Sunday') AND hd.holiday_date IS NULL AS is_business_day
        FROM spine s LEFT JOIN hd ON hd.holiday_date = s.d),
bd AS (SELECT month, CAST(count_if(is_business_day) AS BIGINT) AS business_days FROM cal GROUP BY 1),
goals AS (SELECT CAST(date_trunc('month', o_orderdate) + INTERVAL 12 MONTH AS DATE) AS month, SUM(o_totalprice) * 1.1 AS goal
          FROM orders GROUP BY 1)
SELECT g.month, c.d, c.is_business_day,
  {R2.format(x="CASE WHEN c.is_business_day THEN g.goal / NULLIF(bd.business_days, 0) ELSE 0.0 END")} AS daily_goal
FROM goals g JOIN cal c ON c.month = g.month JOIN bd ON bd.month = g.month
""", covers=("K29", "K92", "F-m2"))
def k29(spark, sf):
    cal = CA.calendar(_spine(spark, sf))
    o = load(spark, sf, "orders")
    goals = o.groupBy(F.add_months(F.to_date(F.date_trunc("month", "o_orderdate")), 12).alias("month")).agg(
        (F.sum("o_totalprice") * 1.1).alias("goal"))
    g = CA.daily_goals(goals, cal, "month", "goal")
    return g.select("month", "d", "is_business_day", round_half_up("daily_goal", 2).alias("daily_goal"))


@paired("k94_blank_repeats", """
WITH g AS (SELECT l_returnflag, l_linestatus, year(l_shipdate) AS ship_year, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag, l_linestatus, ship_year, qty,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY l_returnflag, l_linestatus, ship_year) = 1 THEN l_returnflag ELSE '' END AS l_returnflag_display,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_returnflag, l_linestatus, ship_year) = 1 THEN l_linestatus ELSE '' END AS l_linestatus_display,
  ROW_NUMBER() OVER (ORDER BY l_returnflag, l_linestatus, ship_year) AS _row
FROM g
""", covers=("K94", "W1", "O1"))
def k94(spark, sf):
    li = load(spark, sf, "lineitem")
    g = li.groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").cast("long").alias("ship_year")).agg(
        F.sum("l_quantity").alias("qty"))
    out = PE.blank_repeats(g, ["l_returnflag", "l_linestatus"], ["l_returnflag", "l_linestatus", "ship_year"])
    return out.withColumn("_row", F.col("_row").cast("long"))


@paired("k95_rollup_by_scale_week", """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-01-01' AND DATE '1999-06-30'),
p AS (SELECT greatest(CAST(date_trunc('week', d) AS DATE), DATE '1999-01-01') AS period_start,
             least(CAST(date_trunc('week', d) AS DATE) + 6, DATE '1999-06-30') AS period_end, o_custkey, COUNT(*) AS n FROM o GROUP BY 1, 2, 3)
SELECT period_start, period_end, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS entities, AVG(n) AS avg_rows_per_entity FROM p GROUP BY 1, 2
""", covers=("K95", "F-d3", "F-d7", "A15"))
def k95(spark, sf):
    o = load(spark, sf, "orders")
    return PE.rollup_by_scale(o, "o_orderdate", "o_custkey", "week", "1999-01-01", "1999-06-30")


@paired("k95_rollup_by_scale_month", """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-01-15' AND DATE '1999-12-31'),
p AS (SELECT greatest(CAST(date_trunc('month', d) AS DATE), DATE '1999-01-15') AS period_start,
             least(last_day(d), DATE '1999-12-31') AS period_end, o_custkey, COUNT(*) AS n FROM o GROUP BY 1, 2, 3)
SELECT period_start, period_end, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS entities, AVG(n) AS avg_rows_per_entity FROM p GROUP BY 1, 2
""", covers=("K95",))
def k95m(spark, sf):
    o = load(spark, sf, "orders")
    return PE.rollup_by_scale(o, "o_orderdate", "o_custkey", "month", "1999-01-15", "1999-12-31")


@paired("k95_rollup_by_scale_day", """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-01-15' AND DATE '1999-12-31'),
p AS (SELECT d, o_custkey, COUNT(*) AS n FROM o GROUP BY 1, 2)
SELECT d AS period_start, d AS period_end, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS entities, AVG(n) AS avg_rows_per_entity FROM p GROUP BY 1
""", covers=("K95",))
def k95d(spark, sf):
    return PE.rollup_by_scale(load(spark, sf, "orders"), "o_orderdate", "o_custkey", "day", "1999-01-15", "1999-12-31")


@paired("k95_rollup_by_scale_range", """
WITH p AS (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-01-15' AND DATE '1999-12-31' GROUP BY 1)
SELECT DATE '1999-01-15' AS period_start, DATE '1999-12-31' AS period_end, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS entities, AVG(n) AS avg_rows_per_entity FROM p
""", covers=("K95",))
def k95r(spark, sf):
    return PE.rollup_by_scale(load(spark, sf, "orders"), "o_orderdate", "o_custkey", "range", "1999-01-15", "1999-12-31")


@paired("k96_date_labels_and_text", """
SELECT o_orderkey,
  strftime(o_orderdate, '%Y-%m-%d') AS label_day, strftime(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER), '%Y-%m-%d') AS label_week,
  strftime(o_orderdate, '%Y-%m') AS label_month, CAST(year(o_orderdate) AS VARCHAR) || ' - T' || CAST(quarter(o_orderdate) AS VARCHAR) AS label_quarter,
  strftime(o_orderdate, '%Y') AS label_year, monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS weekday_name,
  strftime(o_orderdate, '%Y%m') AS year_month, strftime(CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE), '%Y%m') AS previous_year_month,
  CAST(floor(o_orderkey * 37 / 86400) AS BIGINT) || ' j ' || CAST(floor(((o_orderkey * 37) % 86400) / 3600) AS BIGINT) || ' h '
    || CAST(floor(((o_orderkey * 37) % 3600) / 60) AS BIGINT) || ' min ' AS duration_text,
  CAST(floor(o_totalprice / 1000 / 60) AS BIGINT) || ':' || CAST(floor(fmod(o_totalprice / 1000 + 0.5, 60)) AS BIGINT) AS time_hm
FROM orders
""", covers=("K96", "X1", "X5", "X7", "F-d2", "F-s2"))
def k96(spark, sf):
    o = load(spark, sf, "orders")
    d = F.col("o_orderdate")
    return o.select("o_orderkey", FM.date_label(d, "day").alias("label_day"), FM.date_label(d, "week").alias("label_week"),
                    FM.date_label(d, "month").alias("label_month"), FM.date_label(d, "quarter").alias("label_quarter"),
                    FM.date_label(d, "year").alias("label_year"), FM.month_name(d).alias("month_name"),
                    FM.weekday_name(d).alias("weekday_name"), FM.year_month(d).alias("year_month"),
                    FM.previous_year_month(d).alias("previous_year_month"),
                    FM.duration_text(F.col("o_orderkey") * 37).alias("duration_text"),
                    FM.time_hm(F.col("o_totalprice")).alias("time_hm"))


@paired("k96_pct_point_text", """
WITH m AS (SELECT o_orderpriority AS store, year(o_orderdate) AS y, AVG(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS rate
           FROM orders GROUP BY 1, 2),
j AS (SELECT a.store, a.y, a.rate, b.rate AS previous FROM m a JOIN m b ON a.store = b.store AND b.y = a.y - 1)
SELECT store, y, CASE WHEN rate >= previous THEN '+' ELSE '' END
  || CAST(CAST(ROUND(CAST((rate - previous) * 100 AS DECIMAL(38,6)), 1) AS DOUBLE) AS VARCHAR) || ' pts' AS variation
FROM j
""", covers=("K96", "X6"))
def k96b(spark, sf):
    o = load(spark, sf, "orders")
    m = o.groupBy(F.col("o_orderpriority").alias("store"), F.year("o_orderdate").cast("long").alias("y")).agg(
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("rate"))
    p = m.select("store", (F.col("y") + 1).alias("y"), F.col("rate").alias("previous"))
    j = m.join(p, ["store", "y"])
    return j.select("store", "y", FM.pct_point_text("rate", "previous").alias("variation"))


@paired("k97_wide_union_kpis", """
WITH x AS (SELECT l.l_orderkey, o.o_orderdate, l.l_shipdate, CASE WHEN l.l_returnflag = 'R' THEN l.l_shipdate END AS returned_at
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT 'ordered' AS measure, CAST(o_orderdate AS DATE) AS d, COUNT(DISTINCT CAST(l_orderkey AS VARCHAR)) AS value FROM x GROUP BY 1, 2
UNION ALL SELECT 'shipped', CAST(l_shipdate AS DATE), COUNT(DISTINCT CAST(l_orderkey AS VARCHAR)) FROM x GROUP BY 1, 2
UNION ALL SELECT 'returned', CAST(returned_at AS DATE), COUNT(DISTINCT CAST(l_orderkey AS VARCHAR)) FROM x WHERE returned_at IS NOT NULL GROUP BY 1, 2
""", covers=("K97", "A4", "U1"))
def k97(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    x = li.join(o, li.l_orderkey == o.o_orderkey).withColumn(
        "returned_at", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))
    return PE.wide_union_kpis(x, [("ordered", "o_orderdate", "l_orderkey"), ("shipped", "l_shipdate", "l_orderkey"),
                                  ("returned", "returned_at", "l_orderkey")])
