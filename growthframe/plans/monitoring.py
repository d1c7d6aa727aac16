"""Paired queries for monitoring: alerts, reconciliation, data tests, freshness (K109-K114, S14).

Stand-ins: site = ``user_id % 40`` (every 4th site is B2B), event = ``event_type``; daily
volumes are event counts per day.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up
from growthframe.operators import alerts as AL
from growthframe.operators import monitoring as MO
from growthframe.operators.calendar import densify, public_holidays, spine_from_bounds
from growthframe.plans.registry import paired
from growthframe.session import materialize, scratch_path
from growthframe.sources.tables import TABLES, load

R2 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _site():
    s = F.col("user_id") % 40
    return F.concat(F.when(s % 4 == 0, F.lit("B2B shop ")).otherwise(F.lit("shop ")), s.cast("string"))


def daily(spark, sf):
    return AL.daily_volumes(load(spark, sf, "events"), _site(), "event_type", "ts")


DAILY_SQL = """
WITH daily AS (SELECT CASE WHEN user_id % 40 % 4 = 0 THEN 'B2B shop ' ELSE 'shop ' END || CAST(user_id % 40 AS VARCHAR) AS website,
                      event_type AS event_name, CAST(ts AS DATE) AS date, COUNT(*) AS m_events FROM events GROUP BY 1, 2, 3),
hol AS (SELECT * FROM (VALUES (DATE '2024-01-01'), (DATE '2024-04-01'), (DATE '2024-05-01'), (DATE '2024-05-08'), (DATE '2024-05-09'),
                      (DATE '2024-05-20'), (DATE '2024-07-14'), (DATE '2024-08-15'), (DATE '2024-11-01'), (DATE '2024-11-11'),
                      (DATE '2024-12-25')) h(holiday_date))"""


def _zero_sql(as_of: str, name: str, hist: str | None) -> str:
    counts = ", ".join(f"SUM(CASE WHEN date = DATE '{as_of}' - INTERVAL {k} DAY THEN m_events ELSE 0 END) AS minus_{k}"
                       for k in range(1, 9))
    last = (f"(SELECT website, event_name, MAX(alert_date) AS last_alert_date, MIN(alert_date) AS first_alert_date "
            f"FROM {hist} GROUP BY 1, 2)" if hist else
            "(SELECT NULL::VARCHAR AS website, NULL::VARCHAR AS event_name, NULL::DATE AS last_alert_date, "
            "NULL::DATE AS first_alert_date WHERE false)")
    empty = " AND ".join(f"COALESCE(minus_{k}, 0) = 0" for k in range(1, 9))
    mon = f"CAST(DATE '{as_of}' - INTERVAL 1 DAY AS DATE)"
    return f""",
{name}_seen AS (SELECT DISTINCT website, event_name FROM daily WHERE date >= DATE '{as_of}' - INTERVAL 180 DAY AND date < DATE '{as_of}'),
{name}_cnt AS (SELECT website, event_name, {counts} FROM daily
               WHERE date >= DATE '{as_of}' - INTERVAL 8 DAY AND date < DATE '{as_of}' GROUP BY 1, 2),
{name}_x AS (SELECT s.website, s.event_name, {', '.join(f'COALESCE(c.minus_{k}, 0) AS minus_{k}' for k in range(1, 9))},
                    l.last_alert_date, l.first_alert_date, {mon} AS monitored_date
             FROM {name}_seen s LEFT JOIN {name}_cnt c USING (website, event_name) LEFT JOIN {last} l USING (website, event_name)),
{name} AS (
  SELECT 'zero_event' AS alert_type, website, event_name, monitored_date,
    (minus_1 = 0 AND minus_2 > 0 AND (last_alert_date IS NULL OR date_diff('day', last_alert_date, DATE '{as_of}') >= 1)) AS is_new_alert,
    last_alert_date AS previous_alert_date, COALESCE(first_alert_date, monitored_date) AS first_alert_date,
    'Event ' || event_name || ' was collected ' || CAST(minus_1 AS VARCHAR) || ' times on ' || CAST(monitored_date AS VARCHAR) AS rationale
  FROM {name}_x LEFT JOIN hol ON hol.holiday_date = monitored_date
  WHERE (website NOT LIKE '%B2B%' OR (dayofweek(monitored_date) NOT IN (0, 6) AND hol.holiday_date IS NULL))
    AND ((minus_1 = 0 AND minus_2 > 0 AND (last_alert_date IS NULL OR date_diff('day', last_alert_date, DATE '{as_of}') >= 1))
      OR ({empty} AND date_diff('day', last_alert_date, DATE '{as_of}') >= 7)))"""


@paired("k109_zero_event_alerts", DAILY_SQL + _zero_sql("2024-01-21", "prev", None)
        + ", prev_hist AS (SELECT website, event_name, monitored_date AS alert_date FROM prev)"
        + _zero_sql("2024-01-29", "cur", "prev_hist") + """
SELECT * FROM cur
""", covers=("K109", "T5", "S12", "M13"))
def k109(spark, sf):
    d = daily(spark, sf)
    years = load(spark, sf, "events").select(F.year("ts").alias("year")).distinct()
    hol = public_holidays(years)
    empty = spark.createDataFrame([], "website string, event_name string, alert_type string, alert_date date")
    prev = AL.zero_event_alerts(d, empty, hol, "2024-01-21")
    hist = prev.select("website", "event_name", "alert_type", F.col("monitored_date").alias("alert_date"))
    return AL.zero_event_alerts(d, hist, hol, "2024-01-29")


_REL_SQL = DAILY_SQL + """
, sh AS (SELECT d.website, d.event_name, d.m_events, o.off, CAST(d.date + to_days(o.off) AS DATE) AS target_date
         FROM daily d CROSS JOIN (VALUES (0), (7), (14), (21)) o(off)),
g AS (SELECT website, event_name, target_date AS date, CAST(SUM(CASE WHEN off = 0 THEN m_events END) AS BIGINT) AS event_count,
             SUM(CASE WHEN off > 0 THEN m_events END) AS s, COUNT(CASE WHEN off > 0 THEN 1 END) AS wk FROM sh GROUP BY 1, 2, 3),
r AS (SELECT website, event_name, date, event_count, CASE WHEN wk = 3 THEN s / 3 END AS l4w_mean FROM g WHERE event_count IS NOT NULL),
r2 AS (SELECT *, event_count / l4w_mean - 1 AS variation,
              COALESCE(event_count < 0.65 * l4w_mean AND l4w_mean >= 3, false) AS is_alert FROM r)"""


@paired("k110_relative_variation_alerts", _REL_SQL + """
, r3 AS (SELECT *, LAG(is_alert, 1) OVER w AS minus_1_alert, LAG(is_alert, 2) OVER w AS minus_2_alert, LAG(is_alert, 3) OVER w AS minus_3_alert,
                LAG(is_alert, 4) OVER w AS minus_4_alert, LAG(is_alert, 5) OVER w AS minus_5_alert, LAG(is_alert, 6) OVER w AS minus_6_alert,
                LAG(is_alert, 7) OVER w AS minus_7_alert
         FROM r2 WINDOW w AS (PARTITION BY website, event_name ORDER BY date))
SELECT website, event_name, date, event_count, CAST(ROUND(CAST(l4w_mean AS DECIMAL(38,6)), 4) AS DOUBLE) AS l4w_mean,
       CAST(ROUND(CAST(variation AS DECIMAL(38,6)), 4) AS DOUBLE) AS variation, is_alert,
       minus_1_alert, minus_2_alert, minus_3_alert, minus_4_alert, minus_5_alert, minus_6_alert, minus_7_alert
FROM r3 WHERE date >= DATE '2024-01-22'
""", covers=("K110", "M19", "W5", "J12"))
def k110(spark, sf):
    r = AL.relative_variation(daily(spark, sf), threshold=0.65, floor=3, weeks=3)
    return r.filter(F.col("date") >= F.lit("2024-01-22").cast("date")).select(
        "website", "event_name", "date", "event_count", round_half_up("l4w_mean", 4).alias("l4w_mean"),
        round_half_up("variation", 4).alias("variation"), "is_alert", *[f"minus_{k}_alert" for k in range(1, 8)])


# Two settings over the stand-in's volumes: four weeks with a floor, from which clicks are exempt; and a
# threshold that every day falls under, so that alerts last and repeat after the first run's alerts.
_SETTINGS = {"strict": (0.65, 2, 4), "lasting": (50.0, 0, 1)}


def _variation_sql(label: str, threshold: float, floor: int, weeks: int, as_of: str, history: str) -> str:
    # each day beside the same weekday of the weeks before; a day without volume has no row of its own
    return f""",
{label}_v AS (SELECT t.website, t.event_name, t.date, t.m_events / (SUM(p.m_events) / {weeks}.0) - 1 AS variation,
    COUNT(p.date) = {weeks} AND t.m_events < {threshold} * SUM(p.m_events) / {weeks}.0
      AND (SUM(p.m_events) / {weeks}.0 >= {floor} OR t.event_name = 'click') AS bad
  FROM daily t LEFT JOIN daily p ON p.website = t.website AND p.event_name = t.event_name
    AND date_diff('day', p.date, t.date) IN ({", ".join(str(7 * w) for w in range(1, weeks + 1))})
  GROUP BY t.website, t.event_name, t.date, t.m_events),
{label}_l AS (SELECT *, {", ".join(f"LAG(bad, {k}) OVER (PARTITION BY website, event_name ORDER BY date) AS b{k}" for k in range(1, 8))} FROM {label}_v),
{label} AS (SELECT l.*, h.last_date, h.first_date, COALESCE(NOT l.b1 AND (h.last_date IS NULL OR date_diff('day', h.last_date, DATE '{as_of}') >= 1), false) AS fresh,
    COALESCE(b1 AND b2 AND b3 AND b4 AND b5 AND b6 AND b7 AND date_diff('day', h.last_date, DATE '{as_of}') >= 7, false) AS again
  FROM {label}_l l LEFT JOIN (SELECT website, event_name, MAX(d) AS last_date, MIN(d) AS first_date FROM {history} GROUP BY ALL) h USING (website, event_name)
  WHERE l.date = DATE '{as_of}' - 1 AND l.bad AND (l.website NOT LIKE '%B2B%'
    OR (dayofweek(l.date) BETWEEN 1 AND 5 AND l.date NOT IN (SELECT holiday_date FROM hol))))"""


@paired("k110_variation_alerts", DAILY_SQL + """,
none AS (SELECT website, event_name, date AS d FROM daily WHERE false)""" + _variation_sql("strict", *_SETTINGS["strict"], "2024-01-30", "none") + """,
hist AS (SELECT website, event_name, MIN(date) + 13 AS d FROM daily GROUP BY ALL HAVING COUNT(*) % 2 = 0)""" + _variation_sql("lasting", *_SETTINGS["lasting"], "2024-01-30", "hist") + """
SELECT label, website, event_name, date AS monitored_date, CAST(ROUND(CAST(variation AS DECIMAL(38,6)), 4) AS DOUBLE) AS variation,
       fresh AS is_new_alert, last_date AS previous_alert_date, COALESCE(first_date, date) AS first_alert_date
FROM (SELECT 'strict' AS label, * FROM strict UNION ALL SELECT 'lasting', * FROM lasting) WHERE fresh OR again
""", covers=("K110", "K111", "T5", "M19"))
def k110_alerts(spark, sf):
    d = daily(spark, sf)
    hol = public_holidays(load(spark, sf, "events").select(F.year("ts").alias("year")).distinct())
    kind = F.lit("relative_variation").alias("alert_type")
    old = d.groupBy(*AL.PAIR).agg(F.date_add(F.min("date"), 13).alias("alert_date"), F.count("*").alias("n")).filter("n % 2 = 0").select(*AL.PAIR, kind, "alert_date")
    out = None
    for label, (threshold, floor, weeks) in _SETTINGS.items():
        flags = AL.relative_variation(d, threshold, floor, weeks, exempt="^click$")
        one = AL.variation_alerts(flags, old if label == "lasting" else old.limit(0), hol, "2024-01-30").withColumn("label", F.lit(label))
        out = one if out is None else out.union(one)
    return out.select("label", "website", "event_name", "monitored_date", round_half_up("variation", 4).alias("variation"),
                      "is_new_alert", "previous_alert_date", "first_alert_date")


@paired("k111_alert_records_of_both_types", DAILY_SQL + _zero_sql("2024-01-30", "cur", None) + """
, sh AS (SELECT d.website, d.event_name, d.m_events, o.off, CAST(d.date + to_days(o.off) AS DATE) AS target_date FROM daily d CROSS JOIN (VALUES (0), (7), (14)) o(off)),
g AS (SELECT website, event_name, target_date AS date, CAST(SUM(CASE WHEN off = 0 THEN m_events END) AS BIGINT) AS n, SUM(CASE WHEN off > 0 THEN m_events END) AS s, COUNT(CASE WHEN off > 0 THEN 1 END) AS wk
      FROM sh GROUP BY 1, 2, 3),
r AS (SELECT *, CASE WHEN wk = 2 THEN n / (s / 2) - 1 END AS variation, COALESCE(wk = 2 AND n < 0.8 * (s / 2) AND s / 2 >= 1, false) AS hit FROM g WHERE n IS NOT NULL),
p AS (SELECT *, LAG(hit) OVER (PARTITION BY website, event_name ORDER BY date) AS hit_before FROM r),
v AS (SELECT * FROM p LEFT JOIN hol ON hol.holiday_date = p.date WHERE p.date = DATE '2024-01-29' AND hit AND hit_before = false
      AND (website NOT LIKE '%B2B%' OR (dayofweek(p.date) NOT IN (0, 6) AND hol.holiday_date IS NULL)))
SELECT 'zero_event' AS alert_type, event_name, website, monitored_date AS start_date, monitored_date AS end_date, CAST(NULL AS DATE) AS compared_start_date, 1 AS empty_days,
       CAST(NULL AS DOUBLE) AS threshold_decrease, CAST(NULL AS DOUBLE) AS current_variation, is_new_alert, rationale FROM cur
UNION ALL SELECT 'relative_variation', event_name, website, date, date, CAST(date - 28 AS DATE), NULL, 0.2, CAST(ROUND(CAST(variation AS DECIMAL(38, 6)), 4) AS DOUBLE), true,
  event_name || ' on ' || website || ': ' || CAST(CAST(ROUND(CAST(variation * 100 AS DECIMAL(38, 6)), 1) AS DOUBLE) AS VARCHAR) || ' % against the usual weekday' FROM v
""", covers=("K111", "K109", "K110"))
def k111_both(spark, sf):
    d = daily(spark, sf)
    hol = public_holidays(load(spark, sf, "events").select(F.year("ts").alias("year")).distinct())
    empty = spark.createDataFrame([], "website string, event_name string, alert_type string, alert_date date")
    zero = AL.zero_event_alerts(d, empty, hol, "2024-01-30")
    rel = AL.variation_alerts(AL.relative_variation(d, threshold=0.8, floor=1, weeks=2), empty, hol, "2024-01-30")
    x = AL.alert_records(zero, rel, 0.8, "2024-01-30")
    return x.select("alert_type", "event_name", "website", "start_date", "end_date", "compared_start_date", F.col("zero_event.empty_days").alias("empty_days"),
                    F.round("relative_variation.threshold_decrease", 2).alias("threshold_decrease"), round_half_up("relative_variation.current_variation", 4).alias("current_variation"), "is_new_alert", "rationale")


@paired("k111_alert_record", _REL_SQL + """
, a AS (SELECT * FROM r2 WHERE is_alert)
SELECT 'relative_variation' AS alert_type, website, event_name, date, CAST(0.35 AS DOUBLE) AS threshold_decrease,
  CAST(ROUND(CAST(variation AS DECIMAL(38,6)), 4) AS DOUBLE) AS current_variation,
  MIN(date) OVER (PARTITION BY website, event_name ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_alert_date,
  LAG(date) OVER (PARTITION BY website, event_name ORDER BY date) AS previous_alert_date,
  'Volume ' || CAST(CAST(ROUND(CAST(variation * 100 AS DECIMAL(38,6)), 1) AS DOUBLE) AS VARCHAR) || '% vs 4-week mean, -35% allowed' AS rationale
FROM a
""", covers=("K111", "A8"))
def k111(spark, sf):
    r = AL.relative_variation(daily(spark, sf), threshold=0.65, floor=3, weeks=3)
    rec = AL.alert_record(r, 0.65)
    return rec.select("alert_type", "website", "event_name", "date",
                      F.round(F.col("relative_variation.threshold_decrease"), 2).alias("threshold_decrease"),
                      round_half_up(F.col("relative_variation.current_variation"), 4).alias("current_variation"),
                      "first_alert_date", "previous_alert_date", "rationale")


@paired("k112_reconcile", f"""
WITH src AS (SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, SUM(l_extendedprice) AS cost FROM lineitem GROUP BY 1),
res AS (SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, SUM(l_extendedprice) AS cost FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
SELECT COALESCE(res.campaign_id, src.campaign_id) AS campaign_id, {R2.format(x="res.cost")} AS result_cost, {R2.format(x="src.cost")} AS source_cost,
       {R2.format(x="COALESCE(res.cost, 0.0) - COALESCE(src.cost, 0.0)")} AS diff_cost
FROM res FULL JOIN src ON res.campaign_id = src.campaign_id
""", covers=("K112", "J3"))
def k112(spark, sf):
    li = load(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("campaign_id"),
                                            F.col("l_extendedprice").alias("cost"), "l_returnflag")
    r = MO.reconcile(li.filter(F.col("l_returnflag") != "R"), li, ["campaign_id"], ["cost"])
    return r.select("campaign_id", round_half_up("result_cost", 2).alias("result_cost"),
                    round_half_up("source_cost", 2).alias("source_cost"), round_half_up("diff_cost", 2).alias("diff_cost"))


@paired("k113_check", """
WITH o AS (SELECT
  COUNT(o_orderkey) - COUNT(DISTINCT o_orderkey) AS r0, CAST(count_if(o_custkey IS NULL) AS BIGINT) AS r1,
  CAST(count_if(o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) AS BIGINT) AS r2,
  CAST(count_if(o_orderpriority IN ('0-NONE')) AS BIGINT) AS r3 FROM orders),
l AS (SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS r0 FROM lineitem),
rel AS (SELECT COUNT(*) AS failures FROM (SELECT DISTINCT l_orderkey FROM lineitem) x
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
SELECT 'orders' AS table_name, 'unique' AS test, 'o_orderkey' AS "column", r0 AS failures, 'error' AS severity, CASE WHEN r0 = 0 THEN 'pass' ELSE 'fail' END AS status FROM o
UNION ALL SELECT 'orders', 'not_null', 'o_custkey', r1, 'error', CASE WHEN r1 = 0 THEN 'pass' ELSE 'fail' END FROM o
UNION ALL SELECT 'orders', 'accepted_values', 'o_orderstatus', r2, 'warn', CASE WHEN r2 = 0 THEN 'pass' ELSE 'warn' END FROM o
UNION ALL SELECT 'orders', 'not_accepted_values', 'o_orderpriority', r3, 'error', CASE WHEN r3 = 0 THEN 'pass' ELSE 'fail' END FROM o
UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber', r0, 'warn', CASE WHEN r0 = 0 THEN 'pass' ELSE 'warn' END FROM l
UNION ALL SELECT 'lineitem', 'relationships', 'l_orderkey', failures, 'error', CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END FROM rel
""", covers=("K113", "J10"))
def k113(spark, sf):
    o, li = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    a = MO.check(o, [{"test": "unique", "column": "o_orderkey"}, {"test": "not_null", "column": "o_custkey"},
                     {"test": "accepted_values", "column": "o_orderstatus", "values": ["F", "O"], "severity": "warn"},
                     {"test": "not_accepted_values", "column": "o_orderpriority", "values": ["0-NONE"]}], "orders")
    b = MO.check(li, [{"test": "unique", "column": ["l_orderkey", "l_linenumber"], "severity": "warn"}], "lineitem")
    c = MO.check_relationship(li, "l_orderkey", o, "o_orderkey", "lineitem")
    return a.unionByName(b).unionByName(c)


@paired("k114_freshness", """
WITH g AS (SELECT MAX(ts) AS max_ts FROM events)
SELECT max_ts, ROUND((epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(max_ts)) / 3600.0, 3) AS age_hours,
  CASE WHEN (epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(max_ts)) / 3600.0 > 48 THEN 'error'
       WHEN (epoch(TIMESTAMP '2024-02-01 12:00:00') - epoch(max_ts)) / 3600.0 > 24 THEN 'warn' ELSE 'pass' END AS status
FROM g
""", covers=("K114",))
def k114(spark, sf):
    return MO.freshness(load(spark, sf, "events"), "ts", "2024-02-01 12:00:00")


@paired("s14_table_last_modified", None, covers=("S14",))
def s14(spark, sf):
    """Newest file modification time per table, from the file metadata column. No SQL form over the tables (DuckDB exposes no mtime)."""
    parts = [load(spark, sf, t).select(F.lit(t).alias("table_name"),
                                       F.col("_metadata.file_modification_time").alias("mtime")) for t in TABLES]
    from functools import reduce
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.groupBy("table_name").agg(F.max("mtime").alias("last_modified_time")) \
        .orderBy(F.col("last_modified_time").desc(), "table_name")


# Findings of every pair and day: no events after a day with some (new), no events for eight days (lasting). The oracle counts each
# run of empty days: alerts on its first day and every seventh day after that.
_SPARSE_SQL = """
WITH e AS (SELECT 'site ' || CAST(user_id % 7 AS VARCHAR) AS website, event_type AS event_name, CAST(ts AS DATE) AS date FROM events WHERE event_id % 23 < 2 AND user_id % 7 + day(ts) % 11 < 9),
b AS (SELECT MIN(date) AS lo, MAX(date) + 20 AS hi FROM e),
grid AS (SELECT p.website, p.event_name, CAST(unnest(generate_series(b.lo, b.hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT DISTINCT website, event_name FROM e) p, b),
n AS (SELECT g.*, COUNT(e.date) AS n FROM grid g LEFT JOIN e ON e.website = g.website AND e.event_name = g.event_name AND e.date = g.d GROUP BY ALL)"""


def _findings(spark, sf):
    e = load(spark, sf, "events")
    u = F.col("user_id") % 7
    e = e.filter((F.col("event_id") % 23 < 2) & (u + F.dayofmonth("ts") % 11 < 9)).select(
        F.concat(F.lit("site "), u.cast("string")).alias("website"), F.col("event_type").alias("event_name"), F.to_date("ts").alias("d"))
    b = e.agg(F.min("d").alias("lo"), F.date_add(F.max("d"), 20).alias("hi"))
    daily_ = densify(e.groupBy("website", "event_name", "d").agg(F.count("*").alias("n")), spine_from_bounds(b, "lo", "hi"), "d", ["website", "event_name"], {"n": 0})
    w = Window.partitionBy("website", "event_name").orderBy("d")  # one row per pair and day
    before = F.lag("n").over(w)
    x = daily_.withColumn("is_new", F.coalesce((F.col("n") == 0) & (before > 0), F.lit(False)))
    week = w.rowsBetween(-7, 0)
    x = x.withColumn("is_lasting", (F.sum("n").over(week) == 0) & (F.count("*").over(week) == 8))
    return x.select("website", "event_name", F.col("d").cast("timestamp").alias("ts"), "is_new", "is_lasting")


@paired("t5_alert_suppression_stream", _SPARSE_SQL + """
, s AS (SELECT *, n = 0 AND LAG(n) OVER w > 0 AS starts FROM n WINDOW w AS (PARTITION BY website, event_name ORDER BY d)),
r AS (SELECT *, MAX(CASE WHEN n > 0 THEN d END) OVER w AS seen, MAX(CASE WHEN starts THEN d END) OVER w AS begun FROM s WINDOW w AS (PARTITION BY website, event_name ORDER BY d ROWS UNBOUNDED PRECEDING)),
a AS (SELECT website, event_name, d, starts AS is_new_alert FROM r WHERE n = 0 AND begun > seen AND (d - begun) % 7 = 0)
SELECT website, event_name, d, is_new_alert, LAG(d) OVER (PARTITION BY website, event_name ORDER BY d) AS previous_alert, MIN(d) OVER (PARTITION BY website, event_name) AS first_alert FROM a
""", covers=("T5", "K109"))
def t5_stream(spark, sf):
    from growthframe.streaming.alerts import suppress_alerts
    from growthframe.streaming.twins import to_parquet_foreach_batch
    name = f"t5-{uuid.uuid4().hex}"
    source, target = scratch_path(spark, f"{name}/in"), scratch_path(spark, f"{name}/out")
    found = materialize(_findings(spark, sf))
    middle = found.agg(F.timestamp_seconds(F.avg(F.unix_timestamp("ts"))).alias("m")).scalar()
    for part in (found.filter(F.col("ts") <= middle), found.filter(F.col("ts") > middle)):  # the query is stopped and started again in between
        part.write.mode("append").parquet(source)
        s = spark.readStream.schema(found.schema).parquet(source)
        to_parquet_foreach_batch(suppress_alerts(s), target, name, available_now=True).awaitTermination()
    day = lambda c: F.to_date(c)
    return spark.read.parquet(target).select("website", "event_name", day("ts").alias("d"), "is_new_alert", day("previous_alert").alias("previous_alert"), day("first_alert").alias("first_alert"))
