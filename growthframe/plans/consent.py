"""Paired queries for consent histories.

Stand-ins: consent history = ``events`` per user ordered by (ts, event_id) with
``optin = value > 250`` (NULL on error events), valid unless the event is a click; a
purchase = purchase event, store = ``'store_' || k % 3``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.operators import consent as CO
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

HIST_SQL = """
WITH hist AS (SELECT user_id, ts, event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value > 250 END AS optin,
                     'store_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR) AS store FROM events),
lg AS (SELECT *, LAG(optin) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM hist),
sw AS (SELECT user_id, ts AS switch_ts, event_id FROM lg
       WHERE COALESCE(optin, false) AND NOT COALESCE(prev, false) AND event_type <> 'click'),
p AS (SELECT user_id, ts, event_id, store FROM hist WHERE event_type = 'purchase')"""


def hist(spark, sf):
    e = load(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select("user_id", "ts", "event_id", "event_type",
                    F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value") > 250).alias("optin"),
                    F.concat(F.lit("store_"), (k % 3).cast("string")).alias("store"))


def switches(spark, sf):
    h = hist(spark, sf)
    return CO.optin_switches(h, "user_id", ["ts", "event_id"], "optin", F.col("event_type") != "click").select(
        "user_id", F.col("ts").alias("switch_ts"), "event_id")


@paired("k64_optin_switches", HIST_SQL + """
SELECT user_id, switch_ts, event_id FROM sw
""", covers=("K64", "W5", "P11"))
def k64(spark, sf):
    return switches(spark, sf)


@paired("k65_optin_at_purchase", HIST_SQL + """
, f AS (SELECT user_id, MIN(switch_ts) AS first_switch_ts FROM sw GROUP BY 1)
SELECT p.user_id, p.ts, p.event_id, p.store, s.switch_ts AS next_switch_ts, f.first_switch_ts
FROM p ASOF LEFT JOIN sw s ON p.user_id = s.user_id AND p.ts <= s.switch_ts
LEFT JOIN f ON f.user_id = p.user_id
""", covers=("K65", "J7"))
def k65(spark, sf):
    h = hist(spark, sf)
    p = h.filter(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "store")
    out = CO.optin_at_purchase(p, switches(spark, sf).drop("event_id"), "user_id", "ts", "switch_ts", [])
    return out.select("user_id", "ts", "event_id", "store", "next_switch_ts", "first_switch_ts")


@paired("k66_optin_before_after", HIST_SQL + """
, fo AS (SELECT user_id, MIN(ts) AS ts FROM p GROUP BY 1),
b AS (SELECT fo.user_id, fo.ts, h.optin AS optin_before FROM fo ASOF LEFT JOIN hist h ON fo.user_id = h.user_id AND fo.ts > h.ts),
a AS (SELECT fo.user_id, fo.ts, h.optin AS optin_after FROM fo ASOF LEFT JOIN hist h ON fo.user_id = h.user_id AND fo.ts <= h.ts)
SELECT b.user_id, b.ts, b.optin_before, a.optin_after FROM b JOIN a USING (user_id, ts)
""", covers=("K66", "J7"))
def k66(spark, sf):
    h = hist(spark, sf)
    fo = h.filter(F.col("event_type") == "purchase").groupBy("user_id").agg(F.min("ts").alias("ts"))
    out = CO.optin_before_after(fo, h, "user_id", "ts", "ts", "optin")
    return out.select("user_id", "ts", "optin_before", "optin_after")


@paired("k67_optin_at_period_end", HIST_SQL + """
, s AS (SELECT user_id, arg_max(optin, ts) AS optin_at_end FROM hist WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1),
o AS (SELECT user_id, arg_max(store, (ts, store)) AS last_store, MAX(ts) AS last_order_ts FROM p
      WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1)
SELECT COALESCE(s.user_id, o.user_id) AS user_id, s.optin_at_end, o.last_store, o.last_order_ts,
       COALESCE(o.last_order_ts >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY, false) AS active
FROM s FULL JOIN o ON s.user_id = o.user_id
""", covers=("K67", "O3"))
def k67(spark, sf):
    h = hist(spark, sf)
    p = h.filter(F.col("event_type") == "purchase")
    out = CO.optin_at_period_end(h, p, "user_id", "ts", "optin", "ts", "store", "2024-01-20", 7)
    return out.select("user_id", "optin_at_end", "last_store", "last_order_ts", "active")


@paired("k68_store_optin_kpis", HIST_SQL + """
, st AS (SELECT p.*, COALESCE(h.optin, false) AS optin_at FROM p ASOF LEFT JOIN hist h ON p.user_id = h.user_id AND p.ts >= h.ts),
fs AS (SELECT user_id, MIN(switch_ts) AS first_switch_ts FROM sw GROUP BY 1),
x AS (SELECT st.*, CAST(st.ts AS DATE) AS d, fs.first_switch_ts FROM st LEFT JOIN fs USING (user_id)),
g AS (SELECT d, store, COUNT(DISTINCT user_id) AS buyers, COUNT(DISTINCT CASE WHEN optin_at THEN user_id END) AS buyers_opted_in,
             COUNT(DISTINCT CASE WHEN CAST(first_switch_ts AS DATE) = d THEN user_id END) AS new_optins FROM x GROUP BY 1, 2),
fi AS (SELECT store, user_id, MIN(d) AS d FROM x WHERE optin_at GROUP BY 1, 2),
pd AS (SELECT store, d, COUNT(*) AS n FROM fi GROUP BY 1, 2),
cum AS (SELECT store, d, SUM(n) OVER (PARTITION BY store ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM pd),
j AS (SELECT COALESCE(g.store, cum.store) AS store, COALESCE(g.d, cum.d) AS d, g.buyers, g.buyers_opted_in, g.new_optins, cum.c
      FROM g FULL JOIN cum ON g.store = cum.store AND g.d = cum.d)
SELECT store, d, COALESCE(buyers, 0) AS buyers, COALESCE(buyers_opted_in, 0) AS buyers_opted_in, COALESCE(new_optins, 0) AS new_optins,
  CAST(COALESCE(last_value(c IGNORE NULLS) OVER (PARTITION BY store ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS BIGINT)
    AS opted_in_buyers_cumulative
FROM j
""", covers=("K68", "W14", "W15", "A4"))
def k68(spark, sf):
    from growthframe.operators.state import asof_join
    h = hist(spark, sf)
    p = h.filter(F.col("event_type") == "purchase").select("user_id", "ts", "event_id", "store")
    st = asof_join(p, h.select("user_id", F.col("ts").alias("h_ts"), "optin"), ["user_id"], "ts", "h_ts", ["optin"],
                   prefix="state_")
    st = st.withColumn("optin_at", F.coalesce("state_optin", F.lit(False)))
    fs = switches(spark, sf).groupBy("user_id").agg(F.min("switch_ts").alias("first_switch_ts"))
    x = st.join(fs, "user_id", "left")
    out = CO.store_optin_kpis(x, "user_id", "store", "ts", "optin_at", "first_switch_ts")
    return out.select("store", "d", "buyers", "buyers_opted_in", "new_optins",
                      F.col("opted_in_buyers_cumulative").cast("long").alias("opted_in_buyers_cumulative"))


# Nulled keys and times: every eleventh k has no customer, every thirteenth no time, and first orders are not made unique.
@paired("k66_null_keys_and_ties", """
WITH hist AS (SELECT CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 11 = 0 THEN NULL ELSE user_id % 40 END AS user_id,
                     CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 13 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS ts,
                     event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value > 250 END AS optin FROM events),
p AS (SELECT event_id, user_id, ts FROM hist WHERE event_type = 'purchase'),
hh AS (SELECT user_id, ts, optin FROM hist WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type <> 'purchase'),
u AS (SELECT user_id, ts, arg_max(optin, COALESCE(optin::INT, -1)) AS hi, arg_min(optin, COALESCE(optin::INT, -1)) AS lo FROM hh GROUP BY 1, 2)
SELECT p.event_id, p.user_id, p.ts, b.hi AS optin_before, a.lo AS optin_after
FROM p ASOF LEFT JOIN u b ON p.user_id = b.user_id AND p.ts > b.ts ASOF LEFT JOIN u a ON p.user_id = a.user_id AND p.ts <= a.ts
""".replace("arg_max(optin, COALESCE(optin::INT, -1))", "CASE WHEN bool_or(optin) THEN true WHEN bool_or(NOT optin) THEN false END")
   .replace("arg_min(optin, COALESCE(optin::INT, -1))", "CASE WHEN bool_or(optin IS NULL) THEN NULL WHEN bool_or(NOT optin) THEN false ELSE true END"), covers=("K66", "J7", "M15"))
def k66_null(spark, sf):
    e = load(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    h = e.select("event_id", "event_type", F.when(k % 11 != 0, F.col("user_id") % 40).alias("user_id"), F.when(k % 13 != 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("ts"),
                 F.when(F.col("event_type") != "error", F.col("value") > 250).alias("optin"))
    p = h.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return CO.optin_before_after(p, h.filter("event_type != 'purchase'"), "user_id", "ts", "ts", "optin").select("event_id", "user_id", "ts", "optin_before", "optin_after")


# Stand-ins: contacts = events % 60 users; consents by value, by k and by a written birthday (two formats, a placeholder, junk).
_CONTACTS_SQL = """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
hist AS (SELECT user_id % 60 AS c, ts, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value > 250 END AS email,
                CASE WHEN k % 7 = 0 THEN NULL ELSE k % 3 = 0 END AS phone,
                CASE k % 6 WHEN 0 THEN '1980-02-30' WHEN 1 THEN '1980-02-28' WHEN 2 THEN '28/02/1980' WHEN 3 THEN '1900-01-01' WHEN 4 THEN '01/01/1900' END AS birthdate
         FROM e WHERE event_type <> 'purchase'),
h AS (SELECT c, ts, event_id, CAST(ts AS DATE) AS d, email, phone,
             COALESCE((try_strptime(birthdate, '%Y-%m-%d') IS NOT NULL AND left(birthdate, 4) <> '1900')
                   OR (try_strptime(birthdate, '%d/%m/%Y') IS NOT NULL AND right(birthdate, 4) <> '1900'), false) AS birthday FROM hist),
o AS (SELECT CASE WHEN k % 11 <> 0 THEN user_id % 60 END AS c, event_id AS o, 'store_' || CAST(k % 3 AS VARCHAR) AS store, CAST(ts AS DATE) AS d
      FROM e WHERE event_type = 'purchase')
"""


def _contacts(spark, sf):
    e = load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    m = F.col("k") % 6
    birth = F.when(m == 0, "1980-02-30").when(m == 1, "1980-02-28").when(m == 2, "28/02/1980").when(m == 3, "1900-01-01").when(m == 4, "01/01/1900")
    h = e.filter("event_type != 'purchase'").select((F.col("user_id") % 60).alias("c"), "ts", "event_id", F.when(F.col("event_type") != "error", F.col("value") > 250).alias("email"),
                                                    F.when(F.col("k") % 7 != 0, F.col("k") % 3 == 0).alias("phone"), birth.alias("birthdate"))
    h = h.withColumn("birthday", CO.valid_birthday("birthdate"))
    o = e.filter("event_type = 'purchase'").select(F.when(F.col("k") % 11 != 0, F.col("user_id") % 60).alias("c"), F.col("event_id").alias("o"),
                                                  F.concat(F.lit("store_"), (F.col("k") % 3).cast("string")).alias("store"), "ts")
    return o, h


def _recount(k):
    return f""",
  COUNT(DISTINCT CASE WHEN {k} <= d THEN c END) AS {k}, COUNT(DISTINCT CASE WHEN {k} BETWEEN DATE '2024-01-10' AND d THEN c END) AS new_{k},
  COUNT(DISTINCT CASE WHEN {k} = first THEN c END) AS {k}_at_first, COUNT(DISTINCT CASE WHEN {k} = first AND {k} >= DATE '2024-01-10' THEN c END) AS new_{k}_at_first,
  COUNT(DISTINCT CASE WHEN {k}_now THEN c END) AS {k}_now"""


@paired("k68_store_consent_report", _CONTACTS_SQL + """
, days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-10', DATE '2024-01-28', INTERVAL 1 DAY)) AS DATE) AS d),
first AS (SELECT store, c, MIN(d) AS first FROM o WHERE c IS NOT NULL GROUP BY 1, 2),
per AS (SELECT days.d, h.c, MIN(CASE WHEN email THEN h.d END) AS email, MIN(CASE WHEN phone THEN h.d END) AS phone, MIN(CASE WHEN birthday THEN h.d END) AS birthday,
               arg_max(email, (ts, event_id)) FILTER (email IS NOT NULL) AS email_now, arg_max(phone, (ts, event_id)) FILTER (phone IS NOT NULL) AS phone_now,
               arg_max(birthday, (ts, event_id)) AS birthday_now
        FROM days JOIN h ON h.d <= days.d GROUP BY 1, 2),
x AS (SELECT days.d, o.store, o.c, o.o, o.d AS od, f.first, per.* EXCLUDE (d, c)
      FROM days JOIN o ON o.d <= days.d LEFT JOIN first f ON f.store = o.store AND f.c = o.c LEFT JOIN per ON per.d = days.d AND per.c = o.c)
SELECT store, d, COUNT(DISTINCT CASE WHEN od = d THEN c END) AS buyers, COUNT(DISTINCT c) AS customers, COUNT(DISTINCT CASE WHEN od >= d - 4 THEN c END) AS active,
  COUNT(DISTINCT CASE WHEN c IS NOT NULL THEN o END) / COUNT(DISTINCT o) AS linked_rate,
  COUNT(DISTINCT CASE WHEN od = d AND first >= DATE '2024-01-10' AND email = first THEN c END) AS buyers_email_at_first""" + "".join(map(_recount, ("email", "phone", "birthday"))) + """
FROM x GROUP BY 1, 2
""", covers=("K68", "A4", "W15", "F-d1"))
def k68_report(spark, sf):
    o, h = _contacts(spark, sf)
    return CO.store_consent_report(o, h, "c", "o", "store", "ts", "ts", "event_id", "2024-01-10", "2024-01-28", 4)


@paired("k65_first_purchase_optins", _CONTACTS_SQL + """
, hh AS (SELECT *, LAG(COALESCE(email, false)) OVER w AS pe, LAG(COALESCE(phone, false)) OVER w AS pp FROM h WINDOW w AS (PARTITION BY c ORDER BY ts, event_id)),
f AS (SELECT c, MIN((d, store)) AS f FROM o GROUP BY 1),
x AS (SELECT f.c, f.f[1] AS fd, f.f[2] AS store, hh.event_id, COALESCE(email, false) AS e, COALESCE(pe, false) AS pe, COALESCE(phone, false) AS ph, COALESCE(pp, false) AS pp
      FROM f LEFT JOIN hh ON hh.c = f.c AND hh.d >= f.f[1] QUALIFY row_number() OVER (PARTITION BY f.c ORDER BY hh.ts, hh.event_id) = 1)
SELECT c, fd AS first_purchase_date, store, e AND NOT pe AS email_switched, NOT pe AS email_was_out, CASE WHEN e AND NOT pe THEN store END AS email_switch_store,
  CASE WHEN e AND NOT pe THEN fd END AS email_switch_date, ph AND NOT pp AS phone_switched, NOT pp AS phone_was_out, CASE WHEN ph AND NOT pp THEN store END AS phone_switch_store,
  CASE WHEN ph AND NOT pp THEN fd END AS phone_switch_date FROM x
""", covers=("K65", "J7", "O3"))
def k65_first(spark, sf):
    o, h = _contacts(spark, sf)
    return CO.first_purchase_optins(o, h, "c", "ts", "store", "ts", "event_id", ["email", "phone"])
