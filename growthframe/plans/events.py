"""Paired queries for web events and sessions.

Stand-ins (FIXTURES.md section 3): visitor = ``user_id``; ``props.k`` drives the utm fields
of click events and the page path; a visit is a K3 session.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.operators import events as EV
from growthframe.plans.registry import paired
from growthframe.session import materialize
from growthframe.sources.tables import load

# Fixed values of the stand-in: utm source / medium chosen by k % 5 on click events.
SOURCES = ["google", "facebook", "newsletter", "bing", "linkedin"]
MEDIUMS = ["cpc", "paid_social", "email", "cpc", "organic_social"]


def _sql_list(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def web_events(spark, sf):
    e = load(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    idx = (k % 5 + 1).cast("int")
    click = F.col("event_type") == "click"
    return e.select(
        "event_id", "user_id", "ts", "event_type", "value", k.alias("k"),
        F.when(click, F.element_at(F.array(*[F.lit(s) for s in SOURCES]), idx)).alias("utm_source"),
        F.when(click, F.element_at(F.array(*[F.lit(s) for s in MEDIUMS]), idx)).alias("utm_medium"),
        F.when(click, F.concat(F.lit("campaign_"), (k % 7).cast("string"))).alias("utm_campaign"),
        F.concat(F.lit("/p/"), (k % 20).cast("string")).alias("page_path"))


def sessions_events(spark, sf):
    return EV.sessionize(web_events(spark, sf), "user_id", "ts", "event_id", 30, ["utm_source", "utm_medium"])


def hits(spark, sf):
    # the sessionized events feed several branches (numbering, exits, next hits): written
    # once to the checkpoint folder, as a production job would keep a sessions table
    s = materialize(sessions_events(spark, sf))
    return EV.visit_hits(s, "session_id", "ts", "event_id", F.col("event_type") == "view",
                         F.col("event_type").isin("click", "purchase", "signup"))


WEB_SQL = f"""
WITH ev AS (
  SELECT event_id, user_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
), web AS (
  SELECT *,
    CASE WHEN event_type = 'click' THEN {_sql_list(SOURCES)}[k % 5 + 1] END AS utm_source,
    CASE WHEN event_type = 'click' THEN {_sql_list(MEDIUMS)}[k % 5 + 1] END AS utm_medium,
    CASE WHEN event_type = 'click' THEN 'campaign_' || CAST(k % 7 AS VARCHAR) END AS utm_campaign,
    '/p/' || CAST(k % 20 AS VARCHAR) AS page_path
  FROM ev
), fl AS (
  SELECT *, LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM web
), st AS (
  SELECT *, (prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) >= 1800000000
             OR utm_source IS NOT NULL OR utm_medium IS NOT NULL) AS is_session_start FROM fl
), sess AS (
  SELECT *,
    last_value(CASE WHEN is_session_start THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_id,
    SUM(CASE WHEN is_session_start THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_number
  FROM st
), hits AS (
  SELECT *,
    ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY ts, event_id) AS hit_number,
    ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY ts, event_id) = 1 AS is_entrance,
    ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY ts DESC, event_id DESC) = 1 AS is_exit,
    CASE WHEN event_type = 'view' THEN 'PAGE' ELSE 'EVENT' END AS hit_type,
    event_type IN ('click', 'purchase', 'signup') AS is_interaction
  FROM sess
)"""


@paired("k1_event_params", """
WITH ev AS (SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, k AS param_k, event_type AS param_type, '/p/' || CAST(k % 20 AS VARCHAR) AS param_page,
       CAST(NULL AS VARCHAR) AS param_gclid
FROM ev
""", covers=("K1", "F-a1", "M8", "F-j1"))
def k1(spark, sf):
    w = web_events(spark, sf)
    vt = "struct<string_value:string,int_value:bigint>"
    arr = F.array(
        F.struct(F.lit("k").alias("key"), F.struct(F.lit(None).cast("string").alias("string_value"),
                                                   F.col("k").alias("int_value")).alias("value")),
        F.struct(F.lit("type").alias("key"), F.struct(F.col("event_type").alias("string_value"),
                                                      F.lit(None).cast("bigint").alias("int_value")).alias("value")),
        F.struct(F.lit("page").alias("key"), F.struct(F.col("page_path").alias("string_value"),
                                                      F.lit(None).cast("bigint").alias("int_value")).alias("value")))
    nested = w.select("event_id", arr.cast(f"array<struct<key:string,value:{vt}>>").alias("event_params"))
    out = EV.event_params(nested, "event_params", {
        "param_k": ("k", "int_value"), "param_type": ("type", "string_value"),
        "param_page": ("page", "string_value"), "param_gclid": ("gclid", "string_value")})
    return out.drop("event_params")


@paired("k3_sessionize", WEB_SQL + """
SELECT session_id, user_id, ts AS session_start, CAST(ts AS DATE) AS session_date, utm_source, utm_medium,
       utm_campaign, page_path AS landing_page, CAST(session_number AS BIGINT) AS session_number
FROM sess WHERE is_session_start
""", covers=("K3", "W5", "W11", "F-d5", "T1"))
def k3(spark, sf):
    s = sessions_events(spark, sf)
    return s.filter("is_session_start").select(
        "session_id", "user_id", F.col("ts").alias("session_start"), F.to_date("ts").alias("session_date"),
        "utm_source", "utm_medium", "utm_campaign", F.col("page_path").alias("landing_page"), "session_number")


@paired("k2_session_rollup", WEB_SQL + """
SELECT session_id, MIN(ts) AS session_start, CAST(MIN(ts) AS DATE) AS session_date,
       arg_min(page_path, (ts, event_id)) AS landing_page, bool_or(event_type = 'signup') AS is_lead, COUNT(*) AS hits,
       arg_min(utm_source, CASE WHEN utm_source IS NOT NULL THEN (ts, event_id) END) AS first_utm_source,
       arg_min(utm_medium, CASE WHEN utm_medium IS NOT NULL THEN (ts, event_id) END) AS first_utm_medium,
       arg_min(utm_campaign, CASE WHEN utm_campaign IS NOT NULL THEN (ts, event_id) END) AS first_utm_campaign
FROM sess GROUP BY session_id
""", covers=("K2", "M26", "A1"))
def k2(spark, sf):
    s = sessions_events(spark, sf)
    return EV.session_rollup(s, "session_id", "ts", "page_path", ["utm_source", "utm_medium", "utm_campaign"],
                             F.col("event_type") == "signup", tie="event_id")


@paired("k10_page_journey", WEB_SQL + """
SELECT session_id, string_agg(page_path, ' > ' ORDER BY ts, event_id) AS journey,
       COUNT(DISTINCT page_path) AS distinct_pages, COUNT(*) AS pageviews
FROM sess GROUP BY session_id
""", covers=("K10", "A12"))
def k10(spark, sf):
    out = EV.page_journey(sessions_events(spark, sf), "session_id", "ts", "event_id", "page_path")
    return out.select("session_id", "journey", F.col("distinct_pages").cast("long").alias("distinct_pages"),
                      F.col("pageviews").cast("long").alias("pageviews"))


@paired("k11_session_bounds", WEB_SQL + """
SELECT user_id, session_id, ts AS session_start,
       LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, session_id) AS session_end
FROM sess WHERE is_session_start
""", covers=("K11", "W7"))
def k11(spark, sf):
    st = sessions_events(spark, sf).filter("is_session_start")
    return EV.session_bounds(st, "user_id", "ts", "session_id")


@paired("k12_previous_page", WEB_SQL + """
, prev AS (SELECT page_path, LAG(page_path) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS previous_page FROM sess)
SELECT page_path AS page, previous_page, COUNT(*) AS pageviews FROM prev
WHERE page_path != previous_page GROUP BY 1, 2
""", covers=("K12", "W20"))
def k12(spark, sf):
    return EV.previous_page(sessions_events(spark, sf), "session_id", "ts", "event_id", "page_path")


@paired("k13_time_on_page", WEB_SQL + """
, kept AS (
  SELECT *, MAX(ts) OVER (PARTITION BY session_id) AS last_t FROM hits WHERE hit_type = 'PAGE' OR is_interaction
), k2 AS (
  SELECT *, LEAD(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id) AS next_ts
  FROM kept WHERE hit_type = 'PAGE' OR ts = last_t
), g AS (
  SELECT page_path AS page, SUM((epoch_us(next_ts) - epoch_us(ts)) / 1e6) AS total_time_on_page,
         CAST(count_if(hit_type = 'PAGE') AS BIGINT) AS pageviews, CAST(count_if(hit_type = 'PAGE' AND NOT is_exit) AS BIGINT) AS non_exit_pageviews
  FROM k2 GROUP BY 1
)
SELECT page, CAST(ROUND(CAST(total_time_on_page AS DECIMAL(38,6)), 3) AS DOUBLE) AS total_time_on_page, pageviews,
       non_exit_pageviews,
       CAST(ROUND(CAST(total_time_on_page / NULLIF(non_exit_pageviews, 0) AS DECIMAL(38,6)), 3) AS DOUBLE) AS avg_time_on_page
FROM g
""", covers=("K13", "W7", "W13"))
def k13(spark, sf):
    s = materialize(sessions_events(spark, sf))  # read by the table of buckets and by the rows
    return EV.time_on_page(s, "session_id", "ts", "event_id", "page_path", F.col("event_type") == "view", F.col("event_type").isin("click", "purchase", "signup"))


@paired("k14_bounce_rate", WEB_SQL + """
, n AS (SELECT session_id, COUNT(*) AS visit_hits FROM hits GROUP BY 1)
SELECT page_path AS page, CAST(count_if(is_entrance) AS BIGINT) AS total_entrances,
       CAST(count_if(hit_type = 'PAGE' AND visit_hits = 1) AS BIGINT) AS total_no_of_bounces,
       CAST(ROUND(CAST(count_if(hit_type = 'PAGE' AND visit_hits = 1) / CAST(count_if(is_entrance) AS BIGINT) * 100 AS DECIMAL(38,6)), 2) AS DOUBLE) AS bounce_rate
FROM hits JOIN n USING (session_id) GROUP BY 1 HAVING CAST(count_if(is_entrance) AS BIGINT) > 0
""", covers=("K14", "A5", "A6"))
def k14(spark, sf):
    return EV.bounce_rate(hits(spark, sf), "session_id", "page_path")


@paired("k15_session_duration", WEB_SQL + """
, per AS (SELECT session_id, (MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / 1e6 AS time_on_site FROM hits GROUP BY 1)
SELECT ROUND(SUM(time_on_site) / COUNT(DISTINCT session_id), 0) AS avg_session_duration_sec,
       COUNT(DISTINCT session_id) AS sessions FROM per
""", covers=("K15", "A2"))
def k15(spark, sf):
    return EV.session_duration(hits(spark, sf), "session_id", "ts")


@paired("k16_unique_pageviews", WEB_SQL + """
SELECT page_path AS page, COUNT(*) AS pageviews, COUNT(DISTINCT session_id) AS unique_pageviews
FROM hits WHERE hit_type = 'PAGE' GROUP BY 1
""", covers=("K16",))
def k16(spark, sf):
    return EV.unique_pageviews(hits(spark, sf), "session_id", "page_path")


@paired("k16_users_by_channel", WEB_SQL + """
, ch AS (SELECT user_id, COALESCE(last_value(utm_medium IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), '(none)') AS channel FROM sess)
SELECT channel, COUNT(DISTINCT user_id) AS users FROM ch GROUP BY 1
""", covers=("K16",))
def k16b(spark, sf):
    s = sessions_events(spark, sf)
    ch = s.groupBy("session_id").agg(F.first("user_id").alias("user_id"),
                                      F.coalesce(F.max_by("utm_medium", F.when(F.col("utm_medium").isNotNull(),
                                                                               F.struct("ts", "event_id"))),
                                                 F.lit("(none)")).alias("channel"))
    return EV.users_by_channel(ch, "channel", "user_id")


@paired("k17_page_session_table", WEB_SQL + """
, n AS (SELECT session_id, COUNT(*) AS visit_hits FROM hits GROUP BY 1)
SELECT session_id, page_path, CAST(count_if(is_entrance) AS BIGINT) AS entrances, CAST(count_if(is_exit) AS BIGINT) AS exits,
       CAST(count_if(hit_type = 'PAGE') AS BIGINT) AS pageviews, CAST(count_if(hit_type = 'EVENT') AS BIGINT) AS events,
       CAST(count_if(is_entrance AND visit_hits = 1) AS BIGINT) AS bounces, MIN(ts) AS first_hit, MAX(ts) AS last_hit,
       (MAX(epoch_us(ts)) - MIN(epoch_us(ts))) / 1e6 AS seconds_on_page
FROM hits JOIN n USING (session_id) GROUP BY 1, 2
""", covers=("K17",))
def k17(spark, sf):
    return EV.page_session_table(hits(spark, sf), "session_id", "page_path", "ts")


FUNNEL_RULES = [("p1x", "/p/1", "/p/10"), ("p2x", "/p/2", None), ("p5", "/p/5", None)]


@paired("k18_product_funnel_counts", WEB_SQL + """
, m AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, * FROM sess)
SELECT month, 'p1x' AS product,
  COUNT(DISTINCT CASE WHEN contains(page_path, '/p/1') AND NOT contains(page_path, '/p/10') THEN session_id END) AS sessions,
  COUNT(DISTINCT CASE WHEN contains(page_path, '/p/1') AND NOT contains(page_path, '/p/10') AND event_type = 'purchase' THEN session_id END) AS completions
FROM m GROUP BY 1
UNION ALL
SELECT month, 'p2x', COUNT(DISTINCT CASE WHEN contains(page_path, '/p/2') THEN session_id END),
  COUNT(DISTINCT CASE WHEN contains(page_path, '/p/2') AND event_type = 'purchase' THEN session_id END) FROM m GROUP BY 1
UNION ALL
SELECT month, 'p5', COUNT(DISTINCT CASE WHEN contains(page_path, '/p/5') THEN session_id END),
  COUNT(DISTINCT CASE WHEN contains(page_path, '/p/5') AND event_type = 'purchase' THEN session_id END) FROM m GROUP BY 1
""", covers=("K18", "A4"))
def k18(spark, sf):
    s = sessions_events(spark, sf).withColumn("month", F.to_date(F.date_trunc("month", "ts")))
    return EV.product_funnel_counts(s, "month", "session_id", "page_path", F.col("event_type") == "purchase",
                                    FUNNEL_RULES)


# Fixed values of the stand-in: language prefix of a page path to a page category.
PAGE_CATEGORIES = [("/fr/", "french"), ("/en/", "english"), ("/de/", "german"), ("/es/", "spanish")]


@paired("k9_first_page", r"""
WITH ev AS (SELECT event_id, user_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
j AS (SELECT ev.*, p.url, NULLIF(regexp_extract(p.url, '^(?:https?://)?([^/?#:]+)', 1), '') AS host
      FROM ev JOIN pages p ON p.page_id = ev.k),
f AS (SELECT user_id, host, arg_min(url, (ts, event_id)) AS url, MIN(ts) AS first_ts FROM j GROUP BY 1, 2)
SELECT user_id, host, first_ts, NULLIF(regexp_extract(url, '^(?:https?://)?[^/?#]+(/[^?#]*)', 1), '') AS first_path,
  CASE WHEN starts_with(NULLIF(regexp_extract(url, '^(?:https?://)?[^/?#]+(/[^?#]*)', 1), ''), '/fr/') THEN 'french'
       WHEN starts_with(NULLIF(regexp_extract(url, '^(?:https?://)?[^/?#]+(/[^?#]*)', 1), ''), '/en/') THEN 'english'
       WHEN starts_with(NULLIF(regexp_extract(url, '^(?:https?://)?[^/?#]+(/[^?#]*)', 1), ''), '/de/') THEN 'german'
       WHEN starts_with(NULLIF(regexp_extract(url, '^(?:https?://)?[^/?#]+(/[^?#]*)', 1), ''), '/es/') THEN 'spanish'
       ELSE 'other' END AS page_category
FROM f
""", covers=("K9", "F-s7", "F-s3", "M2", "P8"))
def k9(spark, sf):
    e = load(spark, sf, "events").select("event_id", "user_id", "ts",
                                         F.get_json_object("props", "$.k").cast("long").alias("k"))
    p = load(spark, sf, "pages").select("page_id", "url")
    j = e.join(p, e.k == p.page_id).withColumn("host", EV.url_host("url"))
    f = EV.first_page(j, "user_id", "host", "ts", "event_id", "url")
    return f.withColumn("page_category", EV.page_category("first_path", PAGE_CATEGORIES))
