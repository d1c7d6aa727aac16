"""Paired queries for histories, intervals, as-of lookups and timings (J5, J7, K98-K105).

Stand-ins: a history = ``events`` per user ordered by (ts, event_id), tracked value
``value > 250``; items with a lifetime = orders open from order date for
``o_orderkey % 20`` days; opening hours inline (fixed values below).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up
from growthframe.operators import state as ST
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

END = "2024-01-31"


@paired("j5_range_join_open_end", f"""
WITH h AS (SELECT user_id, ts, event_id, CASE WHEN value > 250 THEN 'premium' ELSE 'basic' END AS plan
           FROM events WHERE event_type = 'purchase'),
iv AS (SELECT user_id, plan, ts AS valid_from,
              COALESCE(LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '{END}') AS valid_to FROM h)
SELECT e.event_id, e.user_id, iv.plan FROM events e LEFT JOIN iv
  ON iv.user_id = e.user_id AND iv.valid_from <= e.ts AND e.ts < iv.valid_to
WHERE e.event_type = 'view'
""", covers=("J5", "W7"))
def j5(spark, sf):
    e = load(spark, sf, "events")
    h = e.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", "event_id", F.when(F.col("value") > 250, "premium").otherwise("basic").alias("plan"))
    iv = ST.version_intervals(h, ["user_id"], "ts", "event_id", F.lit(END).cast("timestamp_ntz")) \
        .select("user_id", "plan", "valid_from", "valid_to")
    v = e.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    return ST.range_join(v, iv, ["user_id"], "ts").select("event_id", "user_id", "plan")


@paired("j7_asof_join", """
WITH v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, ts AS price_ts, value AS price FROM events WHERE event_type = 'purchase')
SELECT v.event_id, v.user_id, v.ts, p.price AS asof_price, p.price_ts AS asof_price_ts
FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.price_ts
""", covers=("J7", "W9", "K99"))
def j7(spark, sf):
    e = load(spark, sf, "events")
    v = e.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    p = e.filter(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("price_ts"),
                                                            F.col("value").alias("price"))
    return ST.asof_join(v, p, ["user_id"], "ts", "price_ts", ["price", "price_ts"])


@paired("k98_intervals_to_days", f"""
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS s,
                  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) END AS e,
                  o_orderpriority = '1-URGENT' AS urgent
           FROM orders),
d AS (SELECT o_custkey, urgent, unnest(generate_series(s, COALESCE(e, DATE '2001-08-01'), INTERVAL 1 DAY)) AS d FROM o
      WHERE COALESCE(e, DATE '2001-08-01') >= s),
f AS (SELECT o_custkey, CAST(d AS DATE) AS d, bool_or(true) AS is_open, bool_or(urgent) AS is_urgent FROM d GROUP BY 1, 2)
SELECT d, CAST(count_if(is_open) AS BIGINT) AS customers_open, CAST(count_if(is_urgent) AS BIGINT) AS customers_urgent FROM f GROUP BY 1
""", covers=("K98", "J5", "M25"))
def k98(spark, sf):
    o = load(spark, sf, "orders")
    o = o.withColumn("e", F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date"))
                     .otherwise(F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 20).cast("int"))))
    f = ST.intervals_to_days(o, ["o_custkey"], "o_orderdate", "e",
                             {"is_open": F.lit(True), "is_urgent": F.col("o_orderpriority") == "1-URGENT"},
                             F.lit("2001-08-01").cast("date"))
    # the per-customer-day flag table summarised per day
    return f.groupBy("d").agg(F.count_if("is_open").alias("customers_open"),
                              F.count_if("is_urgent").alias("customers_urgent"))


@paired("k99_state_asof_days", f"""
WITH h AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(value > 250, (ts, event_id)) AS premium FROM events GROUP BY 1, 2),
iv AS (SELECT *, COALESCE(LEAD(d) OVER (PARTITION BY user_id ORDER BY d) - INTERVAL 1 DAY, DATE '{END}') AS t FROM h)
SELECT user_id, premium, CAST(unnest(generate_series(d, CAST(t AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM iv
""", covers=("K99", "J7", "W9"))
def k99(spark, sf):
    e = load(spark, sf, "events").withColumn("premium", F.col("value") > 250)
    return ST.state_asof_days(e, ["user_id"], "ts", "event_id", "premium", END)


@paired("k100_status_changes", """
WITH h AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 'inactive' ELSE 'active' END AS status FROM events),
l AS (SELECT *, LAG(status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_status FROM h)
SELECT user_id, ts, event_id, status, previous_status FROM l WHERE previous_status IS DISTINCT FROM status
""", covers=("K100", "P10"))
def k100(spark, sf):
    e = load(spark, sf, "events").withColumn(
        "status", F.when(F.col("event_type") == "error", "inactive").otherwise("active"))
    return ST.status_changes(e, ["user_id"], ["ts", "event_id"], "status").select(
        "user_id", "ts", "event_id", "status", "previous_status")


@paired("k100_first_inactive", """
SELECT user_id, MIN(CASE WHEN event_type = 'error' THEN ts END) AS first_inactive_at FROM events GROUP BY 1
""", covers=("K100",))
def k100b(spark, sf):
    e = load(spark, sf, "events").withColumn(
        "status", F.when(F.col("event_type") == "error", "inactive").otherwise("active"))
    return ST.first_status_date(e, ["user_id"], "ts", "status", "inactive")


# Stand-in: four successive order keys are one item that is opened again and again; the owner is the priority.
@paired("k101_open_items_by_day", """
WITH o AS (SELECT o_orderpriority AS owner, o_orderkey // 4 AS item, CAST(o_orderdate AS DATE) AS s,
                  CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 0 THEN DATE '2001-08-01' ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) END AS e
           FROM orders),
d AS (SELECT owner, item, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM o WHERE e >= s)
SELECT owner, d, COUNT(DISTINCT item) AS open_items FROM d GROUP BY 1, 2
""", covers=("K101", "A4"))
def k101(spark, sf):
    o = load(spark, sf, "orders").withColumn("item", F.floor(F.col("o_orderkey") / 4))
    o = o.withColumn("c", F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 5 == 0), F.lit(None).cast("date"))
                     .otherwise(F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 20).cast("int"))))
    return ST.open_items_by_day(o, "item", "o_orderpriority", "o_orderdate", "c", "2001-08-01")


@paired("k102_daily_state_fact", """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS e, o_orderpriority
           FROM orders),
od AS (SELECT DISTINCT o_custkey, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM o),
ow AS (SELECT o_custkey, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d, o_orderpriority FROM o),
owner AS (SELECT o_custkey, d, MIN(o_orderpriority) AS owner FROM ow GROUP BY 1, 2),
act AS (SELECT l.l_suppkey % 150 AS o_custkey, CAST(l_shipdate AS DATE) AS d, COUNT(*) AS activity FROM lineitem l GROUP BY 1, 2),
won AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, SUM(o_totalprice) AS won_revenue FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT od.o_custkey, od.d, owner.owner, COALESCE(act.activity, 0) AS activity,
       CAST(ROUND(CAST(COALESCE(won.won_revenue, 0.0) AS DECIMAL(38,6)), 2) AS DOUBLE) AS won_revenue
FROM od LEFT JOIN owner USING (o_custkey, d) LEFT JOIN act USING (o_custkey, d) LEFT JOIN won USING (o_custkey, d)
""", covers=("K102", "J5", "J2"))
def k102(spark, sf):
    o = load(spark, sf, "orders")
    oo = o.select(
        "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("s"),
        F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 20).cast("int")).alias("e"))
    days = oo.select("o_custkey", "o_orderpriority", F.explode(F.sequence("s", "e")).alias("d"))
    open_days = days.select("o_custkey", "d").distinct()
    owners = days.groupBy("o_custkey", "d").agg(F.min("o_orderpriority").alias("owner"))
    li = load(spark, sf, "lineitem")
    act = li.groupBy((F.col("l_suppkey") % 150).alias("o_custkey"), F.to_date("l_shipdate").alias("d")).agg(
        F.count("*").alias("activity"))
    won = o.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).agg(
        F.sum("o_totalprice").alias("won_revenue"))
    f = ST.daily_state_fact(open_days, owners, act, won, "o_custkey")
    return f.select("o_custkey", "d", "owner", "activity", round_half_up("won_revenue", 2).alias("won_revenue"))


# Stand-ins: a stay is an order (open for o_orderkey % 23 days, every seventh without an end and then until the horizon, those with
# o_orderkey % 31 = 0 end before they start); its owner is the customer; every third order hands the customer to the executive
# named after its priority for o_orderkey % 400 days, every fifth of them without an end; the other orders carry flags.
_SPANS_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS owner, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS s FROM orders),
h AS (SELECT MAX(s) + 30 AS hz FROM o),
stay AS (SELECT k AS stay, owner, s, CASE WHEN k % 7 = 0 THEN (SELECT hz FROM h) WHEN k % 31 = 0 THEN s - 3 ELSE s + CAST(k % 23 AS INTEGER) END AS e
         FROM o WHERE k % 3 = 1 AND s > (SELECT hz FROM h) - 500),
att AS (SELECT owner, p AS executive, s, CASE WHEN k % 5 = 0 THEN (SELECT hz FROM h) ELSE s + CAST(k % 400 AS INTEGER) END AS e FROM o WHERE k % 3 = 0),
flg AS (SELECT owner, 'flag_' || substr(p, 1, 1) AS flag, s + 2 AS s, CASE WHEN k % 6 = 2 THEN (SELECT hz FROM h) ELSE s + CAST(k % 60 AS INTEGER) END AS e FROM o WHERE k % 3 <> 0),
days AS (SELECT stay, owner, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM stay WHERE s <= e)
"""
_FLAGS = ["flag_1", "flag_2", "flag_3"]


def _spans(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("start"))
    hz = F.date_add(F.lit(o.agg(F.max("start")).first()[0]), 30)  # a bound read from the data first, then a literal (S18)
    none = F.lit(None).cast("date")
    stays = o.filter((F.col("k") % 3 == 1) & (F.col("start") > F.date_sub(hz, 500))).select(
        F.col("k").alias("stay"), "owner", "start",
        F.when(F.col("k") % 7 == 0, none).when(F.col("k") % 31 == 0, F.date_sub("start", 3)).otherwise(F.date_add("start", (F.col("k") % 23).cast("int"))).alias("end"))
    att = o.filter("k % 3 = 0").select("owner", F.col("p").alias("executive"), "start", F.when(F.col("k") % 5 != 0, F.date_add("start", (F.col("k") % 400).cast("int"))).alias("end"))
    flg = o.filter("k % 3 != 0").select("owner", F.concat(F.lit("flag_"), F.substring("p", 1, 1)).alias("flag"), F.date_add("start", 2).alias("start"),
                                        F.when(F.col("k") % 6 != 2, F.date_add("start", (F.col("k") % 60).cast("int"))).alias("end"))
    return o, hz, stays, att, flg


@paired("k102_executive_and_flags", _SPANS_SQL + """
, f AS (SELECT days.stay, days.d, bool_or(flg.flag = 'flag_1') AS flag_1, bool_or(flg.flag = 'flag_2') AS flag_2, bool_or(flg.flag = 'flag_3') AS flag_3
        FROM days JOIN flg ON flg.owner = days.owner AND days.d BETWEEN flg.s AND flg.e GROUP BY 1, 2),
x AS (SELECT DISTINCT days.stay, days.owner, att.executive, days.d
      FROM days LEFT JOIN att ON att.owner = days.owner AND days.d BETWEEN att.s AND att.e),
seen AS (SELECT owner, s AS last_seen FROM o)
SELECT x.stay, x.owner, x.executive, x.d, COALESCE(f.flag_1, false) AS flag_1, COALESCE(f.flag_2, false) AS flag_2, COALESCE(f.flag_3, false) AS flag_3,
       seen.last_seen, COALESCE(date_diff('day', seen.last_seen, x.d) > 10, false) AS seen_long_ago
FROM x LEFT JOIN f ON f.stay = x.stay AND f.d = x.d ASOF LEFT JOIN (SELECT DISTINCT owner, last_seen FROM seen) seen ON seen.owner = x.owner AND x.d >= seen.last_seen
""", covers=("K102", "J5", "S18"))
def k102_flags(spark, sf):
    o, hz, stays, att, flg = _spans(spark, sf)
    seen = o.select("owner", F.col("start").alias("d"))
    return ST.daily_state_segments(stays, att, flg, seen, "stay", "owner", _FLAGS, hz).select("stay", "owner", "executive", "d", *_FLAGS, "last_seen", "seen_long_ago")


@paired("k102_overlaps", _SPANS_SQL + """
SELECT stay.stay, stay.owner, att.executive, greatest(stay.s, att.s) AS overlap_start, least(stay.e, att.e) AS overlap_end
FROM stay LEFT JOIN att ON att.owner = stay.owner AND stay.s <= stay.e AND att.s <= att.e AND stay.s <= att.e AND att.s <= stay.e
""".replace("greatest(stay.s, att.s)", "CASE WHEN att.s IS NOT NULL THEN greatest(stay.s, att.s) END").replace("least(stay.e, att.e)", "CASE WHEN att.s IS NOT NULL THEN least(stay.e, att.e) END"), covers=("K102", "J5"))
def k102_overlaps(spark, sf):
    _, hz, stays, att, _ = _spans(spark, sf)
    x = ST.overlap_join(stays, att.withColumnsRenamed({"start": "_as", "end": "_ae"}), ["owner"], ["start", "end"], ["_as", "_ae"], hz)
    return x.select("stay", "owner", "executive", "overlap_start", "overlap_end")


@paired("k103_price_per_unit", """
WITH x AS (SELECT DISTINCT n.n_name AS city, p.p_type, p.p_partkey, p.p_retailprice / p.p_size AS price_per_unit
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
           JOIN nation n ON n.n_nationkey = s.s_nationkey),
t AS (SELECT quantile_cont(price_per_unit, 0.99) AS cut FROM x)
SELECT city, p_type, CAST(ROUND(CAST(quantile_cont(price_per_unit, 0.5) AS DECIMAL(38,6)), 4) AS DOUBLE) AS median_value, COUNT(*) AS n
FROM x, t WHERE price_per_unit <= t.cut GROUP BY 1, 2
""", covers=("K103", "A17", "J19", "W16"))
def k103(spark, sf):
    li, p = load(spark, sf, "lineitem"), load(spark, sf, "part")
    s, n = load(spark, sf, "supplier"), load(spark, sf, "nation")
    x = (li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
         .join(n, s.s_nationkey == n.n_nationkey)
         .select(F.col("n_name").alias("city"), "p_type", "p_partkey",
                 (F.col("p_retailprice") / F.col("p_size")).alias("price_per_unit")).distinct())
    out = ST.price_per_unit(x, ["city", "p_type"], "price_per_unit")
    return out.withColumn("median_value", round_half_up("median_value", 4))


# Fixed values of the stand-in: opening hours (ISO weekday, opens, closes) in seconds since midnight.
OPENING_HOURS = [(1, 9 * 3600, 18 * 3600), (2, 9 * 3600, 18 * 3600), (3, 9 * 3600, 18 * 3600),
                 (4, 9 * 3600, 18 * 3600), (5, 9 * 3600, 18 * 3600), (6, 10 * 3600, 16 * 3600)]


@paired("k104_business_seconds", """
WITH o AS (SELECT o_orderkey, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS s FROM orders),
o2 AS (SELECT o_orderkey, s, s + to_seconds(o_orderkey % 200000) AS e FROM o),
h AS (SELECT * FROM (VALUES (1, 32400, 64800), (2, 32400, 64800), (3, 32400, 64800), (4, 32400, 64800), (5, 32400, 64800),
                            (6, 36000, 57600)) v(iso_weekday, open_seconds, close_seconds)),
d AS (SELECT o_orderkey, s, e, CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM o2),
j AS (SELECT d.*, h.open_seconds, h.close_seconds FROM d LEFT JOIN h ON h.iso_weekday = isodow(d.day))
SELECT o_orderkey, s AS start_ts, e AS end_ts,
  CAST(SUM(CASE WHEN open_seconds IS NULL THEN 0 ELSE greatest(0, least(epoch(e), epoch(CAST(day AS TIMESTAMP)) + close_seconds)
                              - greatest(epoch(s), epoch(CAST(day AS TIMESTAMP)) + open_seconds)) END) AS BIGINT) AS business_seconds
FROM j GROUP BY 1, 2, 3
""", covers=("K104", "F-d9", "F-d10", "M6"))
def k104(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderdate") + F.make_interval(secs=((F.col("o_orderkey") * 7919) % 86400)))
        .alias("start_ts"))
    o = o.withColumn("end_ts", F.col("start_ts") + F.make_interval(secs=(F.col("o_orderkey") % 200000)))
    hours = spark.createDataFrame(OPENING_HOURS, "iso_weekday int, open_seconds long, close_seconds long")
    return ST.business_seconds(o, "start_ts", "end_ts", hours)


@paired("k105_milestones", """
SELECT user_id,
  MIN(CASE WHEN event_type = 'signup' THEN ts END) AS first_signup, MAX(CASE WHEN event_type = 'signup' THEN ts END) AS last_signup,
  MIN(CASE WHEN event_type = 'click' THEN ts END) AS first_click, MAX(CASE WHEN event_type = 'click' THEN ts END) AS last_click,
  MIN(CASE WHEN event_type = 'purchase' THEN ts END) AS first_purchase, MAX(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase,
  ROUND((epoch(MIN(CASE WHEN event_type = 'click' THEN ts END)) - epoch(MIN(CASE WHEN event_type = 'signup' THEN ts END))) / 3600.0, 4) AS hours_signup_to_click,
  ROUND((epoch(MIN(CASE WHEN event_type = 'purchase' THEN ts END)) - epoch(MIN(CASE WHEN event_type = 'click' THEN ts END))) / 3600.0, 4) AS hours_click_to_purchase
FROM events GROUP BY 1
""", covers=("K105", "A3", "F-d5"))
def k105(spark, sf):
    m = ST.milestones(load(spark, sf, "events"), "user_id", "ts", "event_type", ["signup", "click", "purchase"])
    return m.withColumn("hours_signup_to_click", F.round("hours_signup_to_click", 4)) \
        .withColumn("hours_click_to_purchase", F.round("hours_click_to_purchase", 4))


# Fixed values of the stand-in: opening-hours versions (valid from, ISO weekday, opens, closes);
# Saturday opening appears with the second version.
HOURS_HISTORY = ([("1990-01-01 00:00:00", d, 9 * 3600, 18 * 3600) for d in range(1, 6)]
                 + [("1998-01-01 00:00:00", d, 8 * 3600, 19 * 3600) for d in range(1, 6)]
                 + [("1998-01-01 00:00:00", 6, 10 * 3600, 16 * 3600)])


def _hours_history_sql():
    rows = ", ".join(f"(TIMESTAMP '{v}', {d}, {o}, {c})" for v, d, o, c in HOURS_HISTORY)
    return f"h AS (SELECT * FROM (VALUES {rows}) v(valid_from, iso_weekday, open_seconds, close_seconds))"


@paired("k104_business_seconds_hours_asof", f"""
WITH o AS (SELECT o_orderkey, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS s FROM orders),
o2 AS (SELECT o_orderkey, s, s + to_seconds(o_orderkey % 200000) AS e FROM o),
{_hours_history_sql()},
d AS (SELECT o_orderkey, s, e, CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM o2),
j AS (SELECT d.*, h.open_seconds, h.close_seconds, h.valid_from FROM d LEFT JOIN h
      ON h.iso_weekday = isodow(d.day) AND h.valid_from <= d.s),
p AS (SELECT o_orderkey, s, e, day, arg_max(open_seconds, valid_from) AS op, arg_max(close_seconds, valid_from) AS cl
      FROM j GROUP BY 1, 2, 3, 4)
SELECT o_orderkey, s AS start_ts, e AS end_ts,
  CAST(SUM(CASE WHEN op IS NULL THEN 0 ELSE greatest(0, least(epoch(e), epoch(CAST(day AS TIMESTAMP)) + cl)
                              - greatest(epoch(s), epoch(CAST(day AS TIMESTAMP)) + op)) END) AS BIGINT) AS business_seconds
FROM p GROUP BY 1, 2, 3
""", covers=("K104", "J7"))
def k104h(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderdate") + F.make_interval(secs=((F.col("o_orderkey") * 7919) % 86400)))
        .alias("start_ts"))
    o = o.withColumn("end_ts", F.col("start_ts") + F.make_interval(secs=(F.col("o_orderkey") % 200000)))
    hours = spark.createDataFrame(HOURS_HISTORY, "valid_from string, iso_weekday int, open_seconds long, close_seconds long") \
        .withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))
    return ST.business_seconds(o, "start_ts", "end_ts", hours)


# Fixed values of the stand-in: hours by store (o_orderkey % 3) and version; store 1 has a midday break, store 2 opens later for the first time.
STORE_HOURS = ([("1990-01-01 00:00:00", 0, d, 32400, 64800) for d in range(1, 6)] + [("1995-06-14 12:00:00", 0, d, 28800, 68400) for d in range(1, 7)]
               + [("1999-01-01 00:00:00", 0, 7, 36000, 50400)]
               + [("1990-01-01 00:00:00", 1, d, a, b) for d in range(1, 7) for a, b in ((28800, 43200), (50400, 68400))]
               + [("1997-03-05 09:30:00", 2, d, 36000, 72000) for d in range(2, 7)])


@paired("k104_business_seconds_version_changes", f"""
WITH h AS (SELECT * FROM (VALUES {", ".join(f"(TIMESTAMP '{v}', {k}, {d}, {a}, {b})" for v, k, d, a, b in STORE_HOURS)}) v(valid_from, store, iso_weekday, a, b)),
v AS (SELECT store, valid_from, LEAD(valid_from, 1, TIMESTAMP '2100-01-01') OVER (PARTITION BY store ORDER BY valid_from) AS valid_to FROM (SELECT DISTINCT store, valid_from FROM h)),
o AS (SELECT o_orderkey, o_orderkey % 3 AS store, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS s FROM orders),
o2 AS (SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN s - INTERVAL 5 DAY ELSE s + to_seconds((o_orderkey * 104729) % 34560000) END AS e FROM o),
d AS (SELECT o_orderkey, store, s, e, CAST(unnest(generate_series(CAST(s AS DATE), CAST(e AS DATE), INTERVAL 1 DAY)) AS TIMESTAMP) AS day FROM o2 WHERE e >= s),
x AS (SELECT d.o_orderkey, greatest(0, epoch(least(d.e, v.valid_to, d.day + to_seconds(h.b))) - epoch(greatest(d.s, v.valid_from, d.day + to_seconds(h.a)))) AS sec
      FROM d JOIN h ON h.store = d.store AND h.iso_weekday = isodow(d.day) JOIN v ON v.store = h.store AND v.valid_from = h.valid_from
      WHERE v.valid_from <= d.e AND v.valid_to >= d.s),
t AS (SELECT o_orderkey, SUM(sec) AS sec FROM x GROUP BY 1)
SELECT o2.o_orderkey, o2.store, o2.s AS start_ts, o2.e AS end_ts, CAST(COALESCE(t.sec, 0) AS BIGINT) AS business_seconds FROM o2 LEFT JOIN t USING (o_orderkey)
""", covers=("K104", "J7", "W11"))
def k104v(spark, sf):
    k = F.col("o_orderkey")
    o = load(spark, sf, "orders").select("o_orderkey", (k % 3).alias("store"), (F.col("o_orderdate") + F.make_interval(secs=(k * 7919) % 86400)).alias("start_ts"))
    end = F.when(k % 97 == 0, F.lit(None).cast("timestamp_ntz")).when(k % 89 == 0, F.col("start_ts") - F.expr("INTERVAL 5 DAYS")) \
        .otherwise(F.col("start_ts") + F.make_interval(secs=(k * 104729) % 34560000))
    hours = spark.createDataFrame(STORE_HOURS, "valid_from string, store long, iso_weekday int, open_seconds long, close_seconds long")
    return ST.business_seconds(o.withColumn("end_ts", end), "start_ts", "end_ts", hours.withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz")), "store", "instant")
