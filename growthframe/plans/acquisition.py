"""Paired queries for traffic sources, touchpoints and attribution.

Stand-ins: contact = user who signed up (bridge visitor -> contact); touches = click events
(utm), view events (referrer by k % 4) and signup events (form submissions); lead date =
first signup day, mql date = first purchase day, won = first purchase above 250, lost =
first error event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.operators import acquisition as AQ
from growthframe.plans.events import MEDIUMS, SOURCES, _sql_list, web_events
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

# Fixed values of the stand-in: referrer of view events by k % 4 (index 3 = none).
REFERRERS = ["https://www.google.com/search", "https://www.linkedin.com/feed", "https://chatgpt.com/"]

WEB_BASE_SQL = f"""
WITH ev AS (
  SELECT event_id, user_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
), web AS (
  SELECT *,
    CASE WHEN event_type = 'click' THEN {_sql_list(SOURCES)}[k % 5 + 1] END AS utm_source,
    CASE WHEN event_type = 'click' THEN {_sql_list(MEDIUMS)}[k % 5 + 1] END AS utm_medium,
    CASE WHEN event_type = 'click' THEN 'campaign_' || CAST(k % 7 AS VARCHAR) END AS utm_campaign,
    '/p/' || CAST(k % 20 AS VARCHAR) AS page_path,
    CASE WHEN event_type = 'view' AND k % 4 < 3 THEN {_sql_list(REFERRERS)}[k % 4 + 1] END AS referrer
  FROM ev
)"""

TOUCH_SQL = WEB_BASE_SQL + """
, x AS (
  SELECT user_id AS visitor, 'page_view_utm-' || CAST(event_id AS VARCHAR) AS touchpoint_id, ts AS touchpoint_timestamp,
         utm_source, utm_medium, utm_campaign, CAST(NULL AS VARCHAR) AS referrer, 'page_view_utm' AS web_event_type
  FROM web WHERE event_type = 'click'
  UNION ALL
  SELECT user_id, 'page_view-' || CAST(event_id AS VARCHAR), ts, NULL, NULL, NULL, referrer, 'page_view'
  FROM web WHERE event_type = 'view'
  UNION ALL
  SELECT user_id, 'form_submission-' || CAST(event_id AS VARCHAR), ts, NULL, NULL, NULL, NULL, 'form_submission'
  FROM web WHERE event_type = 'signup'
), bridge AS (SELECT DISTINCT user_id AS visitor, user_id AS contact_id FROM events WHERE event_type = 'signup'),
t AS (
  SELECT DISTINCT b.contact_id, x.touchpoint_id, x.touchpoint_timestamp, x.utm_source, x.utm_medium, x.utm_campaign,
         x.referrer, x.web_event_type
  FROM x JOIN bridge b USING (visitor)
), stages AS (
  SELECT user_id AS contact_id,
    CAST(MIN(CASE WHEN event_type = 'signup' THEN ts END) AS DATE) AS date_lead,
    CAST(MIN(CASE WHEN event_type = 'purchase' THEN ts END) AS DATE) AS date_mql,
    CAST(MIN(CASE WHEN event_type = 'purchase' AND value > 250 THEN ts END) AS DATE) AS date_won,
    CAST(MIN(CASE WHEN event_type = 'error' THEN ts END) AS DATE) AS date_lost
  FROM events GROUP BY 1
)"""


def touch_model(spark, sf):
    w = web_events(spark, sf)
    k4 = (F.col("k") % 4).cast("int")
    ref = F.when((F.col("event_type") == "view") & (k4 < 3),
                 F.element_at(F.array(*[F.lit(r) for r in REFERRERS]), k4 + 1))
    w = w.withColumn("referrer", ref)
    base = ["user_id", F.col("ts").alias("touchpoint_timestamp"), F.col("event_id").alias("touch_id")]
    clicks = w.filter(F.col("event_type") == "click").select(*base, "utm_source", "utm_medium", "utm_campaign")
    views = w.filter(F.col("event_type") == "view").select(*base, "referrer")
    forms = w.filter(F.col("event_type") == "signup").select(*base)
    bridge = w.filter(F.col("event_type") == "signup").select("user_id", F.col("user_id").alias("contact_id"))
    t = AQ.touchpoints([("page_view_utm", clicks), ("page_view", views), ("form_submission", forms)],
                       bridge, "user_id", "contact_id")
    return t.select("contact_id", "touchpoint_id", "touchpoint_timestamp", "utm_source", "utm_medium",
                    "utm_campaign", "referrer", "web_event_type")


def stage_dates(spark, sf):
    e = load(spark, sf, "events")
    t = F.col("event_type")
    return e.groupBy(F.col("user_id").alias("contact_id")).agg(
        F.to_date(F.min(F.when(t == "signup", F.col("ts")))).alias("date_lead"),
        F.to_date(F.min(F.when(t == "purchase", F.col("ts")))).alias("date_mql"),
        F.to_date(F.min(F.when((t == "purchase") & (F.col("value") > 250), F.col("ts")))).alias("date_won"),
        F.to_date(F.min(F.when(t == "error", F.col("ts")))).alias("date_lost"))


# ----------------------------------------------------------------------------- rules by example
# Expected labels, written out from the rules and apart from the operator's tables: every rule of both ladders is reached, with cases
# between rules: (source, medium, has a partner referral, source name, channel).
CHANNEL_CASES = [
    ("partner", None, 0, "Partenariat", "Partenariat"), ("partenariat", "x", 0, "Partenariat", "Partenariat"),
    ("sponsorship", None, 0, "Parrainage", "Parrainage"), ("parrainage", "cpc", 0, "Parrainage", "Parrainage"), ("whatever", "x", 1, "Parrainage", "Parrainage"),
    ("partner", "cpc", 1, "Partenariat", "Partenariat"), ("my_adwords_x", "cpc", 0, "Google Ads", "Paid Search"), ("adwords", None, 0, "Google Ads", "Paid Search"),
    ("google", "ads", 0, "Google Ads", "Paid Search"), ("google", "cpc", 0, "Google Ads", "Paid Search"), ("google", "ppc", 0, "Google Ads", "Paid Search"),
    ("google", "retargeting", 0, "Google Ads", "Paid Search"), ("google", "cpm", 0, "Google Ads", "Paid Search"), ("google", "paid", 0, "Google Ads", "Paid Search"),
    ("google", "organic", 0, "Google Organic", "SEO"), ("youtube", "paid_video", 0, "YouTube", "Paid Social"), ("youtube", "organic", 0, "YouTube", "Organic Social"),
    ("youtube", None, 0, "YouTube", "Organic Social"), ("youtube", "referral", 0, "YouTube", "Organic Social"),
    ("linkedin", "cpm", 0, "Linkedin Ads", "Paid Social"), ("linkedin", "paidsocial", 0, "Linkedin Ads", "Paid Social"), ("linkedin", "organic", 0, "Linkedin Organic", "Organic Social"),
    ("lnkd.linkedin.com", "organic", 0, "Linkedin Organic", "Organic Social"), ("tiktok", "retargeting", 0, "TikTok Ads", "Paid Social"), ("tiktok", "paid_x", 0, None, "Paid Social"),
    ("tiktok", "social", 0, "TikTok Organic", "Organic Social"), ("m.tiktok.com", "organic", 0, "TikTok Organic", "Organic Social"),
    ("paid_fb", "facebook_feed", 0, "Meta Ads", "Paid Social"), ("facebook_x", "ads_1", 0, "Meta Ads", "Paid Social"), ("facebook", "cpc", 0, "Meta Ads", "Paid Social"),
    ("meta", "paid_social", 0, "Meta Ads", "Paid Social"), ("instagram", "ppc", 0, "Meta Ads", "Paid Social"), ("facebook", "facebook_ads", 0, "Meta Ads", "Paid Social"),
    ("facebook", "social", 0, "Facebook Organic", "Organic Social"), ("instagram", "social", 0, "Instagram Organic", "Organic Social"), ("ig", "social", 0, "Instagram Organic", "Organic Social"),
    ("bing", "cpc", 0, "Bing Ads", "Paid Search"), ("bing", "paid", 0, "Bing Ads", "Paid Search"), ("bing", "", 0, "Bing Ads", None), ("bing", "organic", 0, "Bing Organic", "SEO"),
    ("affiliation", None, 0, "Affiliation", "Affiliation"), ("adyen.com", "referral", 0, "Payment Service Provider", "Payment Service Provider"),
    ("secure.ogone", "x", 0, "Payment Service Provider", "Payment Service Provider"), ("getalma.eu", None, 0, "Payment Service Provider", "Payment Service Provider"),
    ("klarna", "organic", 0, "Payment Service Provider", "Payment Service Provider"), ("onsite", "banner", 0, "Onsite banner", "Onsite banner"), ("gmb", "organic", 0, "GMB", "GMB"),
    ("hillspet.fr", "x", 0, "Criteo", "Criteo"), ("qwant.com", "referral", 0, "Qwant Search", "SEO"), ("www.bing.com", "referral", 0, "Bing Search", "SEO"),
    ("google.fr", "referral", 0, "Google Search", "SEO"), ("yahoo.com", "referral", 0, "Yahoo Search", "SEO"), ("yahoo", "organic", 0, "Yahoo Organic", "SEO"),
    ("duckduckgo", "referral", 0, "Duckduckgo Search", "SEO"), ("duckduckgo", "organic", 0, "Duckduckgo Organic", "SEO"), ("ecosia.org", "referral", 0, "Ecosia Search", "SEO"),
    ("ecosia.org", "organic", 0, "Ecosia Organic", "SEO"), ("baidu", "organic", 0, "Baidu Organic", "SEO"), ("brave", "referral", 0, "Brave Search", "SEO"),
    ("startpage", "organic", 0, "SEO", "SEO"), (None, "organic", 0, "SEO", "SEO"), ("facebook", "organic", 0, "SEO", "SEO"),
    ("twitch.tv", "social", 0, "Twitch Organic", "Organic Social"), ("twitter", "social", 0, "Twitter Organic", "Organic Social"), ("reddit.com", "social", 0, "Reddit Organic", "Organic Social"),
    ("tiktok.com", "referral", 0, "Tiktok Organic", "Organic Social"), ("meta.com", "referral", 0, "Facebook Organic", "Organic Social"), ("l.facebook.com", "referral", 0, "Facebook Organic", "Organic Social"),
    ("l.instagram.com", "referral", 0, "Instagram Organic", "Organic Social"), ("snapchat.com", "referral", 0, "Snapchat Organic", "Organic Social"),
    ("pinterest.fr", "referral", 0, "Pinterest Organic", "Organic Social"), ("twitter.com", "referral", 0, "Twitter Organic", "Organic Social"), ("linkedin.com", "referral", 0, "Linkedin Organic", "Organic Social"),
    ("chatgpt.com", "x", 0, "AI Referrals", "AI Referrals"), ("perplexity", None, 0, "AI Referrals", "AI Referrals"), ("some.blog", "referral", 0, "Referral Websites", "Referral Websites"),
    ("x", "my_referral_2", 0, "Referral Websites", "Referral Websites"), ("gmail.com", "referral", 0, "Referral Websites", "Referral Websites"), ("x", "webinar_may", 0, "Webinar", "Webinar"),
    ("direct", "none", 0, "Direct", "Direct"), ("(direct)", "(none)", 0, "Direct", "Direct"), ("direct", "(none)", 0, None, None), ("mailchimp", "x", 0, "Email", "Email"),
    ("newsletter", "email", 0, "Email", "Email"), ("hs_automation", None, 0, "Email", "Email"), ("unknown", "unknown", 0, None, None), (None, None, 0, None, None), (None, None, 1, "Parrainage", "Parrainage"),
    ("Google", "cpc", 0, None, None), ("google", "social", 0, None, None), ("ig", "ads", 0, None, None),
]
# The same for referrers: (referrer, utm source, utm medium, has a click id, source, medium).
REFERRER_CASES = [
    ("https://chatgpt.com/c/1", None, None, 0, "chatgpt.com", "referral"), ("https://www.perplexity.ai/", None, None, 0, "perplexity.ai", "referral"),
    ("https://gemini.google.com", None, None, 0, "gemini.google.com", "referral"), ("https://gemini.google.com/app", None, None, 0, "google", "organic"),
    ("https://claude.ai/x", None, None, 0, "claude.ai", "referral"), ("https://www.google.com/", None, None, 0, "google", "organic"), ("https://www.bing.com/search", None, None, 0, "bing", "organic"),
    ("https://www.msn.com/", None, None, 0, "msn", "organic"), ("https://fr.search.yahoo.com/", None, None, 0, "yahoo", "organic"), ("https://www.qwant.com/", None, None, 0, "qwant", "organic"),
    ("https://www.ecosia.com/", None, None, 0, "ecosia", "organic"), ("https://duckduckgo.com/", None, None, 0, "duckduckgo", "organic"), ("https://search.brave.com/", None, None, 0, "brave", "organic"),
    ("https://www.youtube.com/", None, None, 0, "youtube", "social"), ("https://www.linkedin.com/", None, None, 0, "linkedin", "social"), ("https://l.facebook.com/", None, None, 0, "facebook", "social"),
    ("https://www.instagram.com/", None, None, 0, "instagram", "social"), ("https://t.co/abc", None, None, 0, "twitter", "social"), ("https://www.pinterest.com/", None, None, 0, "twitter", "social"),
    ("https://example.org/", None, None, 0, None, None), (None, None, None, 0, None, None), ("https://www.google.com/", "news", "email", 0, "news", "email"), ("https://www.google.com/", "news", None, 0, "news", None),
    (None, "news", "email", 1, "google", "cpc"), (None, None, None, 1, "google", "cpc"), ("https://www.bing.com/", None, "email", 0, "bing", "organic"),
]


def _values(rows):
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in (k, *r)) + ")" for k, r in enumerate(rows))


def _case_rows(spark, sf, rows, schema):
    """The inputs of the cases (never the labels) dealt to the events in turn."""
    t = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "i long, " + schema)
    e = load(spark, sf, "events").select("event_id", (F.col("event_id") % len(rows)).alias("i"))
    return e.join(t, "i").drop("i")


@paired("k7_every_channel_rule", f"""
WITH c AS (SELECT * FROM (VALUES {_values(CHANNEL_CASES)}) v(i, source, medium, ref, session_source_name, session_channel))
SELECT event_id, source, medium, CAST(session_source_name AS VARCHAR) AS session_source_name, CAST(session_channel AS VARCHAR) AS session_channel FROM events JOIN c ON c.i = event_id % {len(CHANNEL_CASES)}
""", covers=("K7", "P4", "P6", "P9"))
def k7_every(spark, sf):
    x = _case_rows(spark, sf, [r[:3] for r in CHANNEL_CASES], "source string, medium string, ref int")
    x = x.withColumn("partner", F.when(F.col("ref") == 1, "p1"))
    return AQ.channel_grouping(x, "source", "medium", "partner").select("event_id", "source", "medium", "session_source_name", "session_channel")


@paired("k6_every_referrer_rule", f"""
WITH c AS (SELECT * FROM (VALUES {_values(REFERRER_CASES)}) v(i, referrer, us, um, click, source, medium))
SELECT event_id, referrer, source, medium FROM events JOIN c ON c.i = event_id % {len(REFERRER_CASES)}
""", covers=("K6", "P6"))
def k6_every(spark, sf):
    x = _case_rows(spark, sf, [r[:4] for r in REFERRER_CASES], "referrer string, us string, um string, click int")
    x = x.withColumn("gclid", F.when(F.col("click") == 1, "g"))
    return AQ.classify_referrer(x, "referrer", "us", "um", click_id="gclid").select("event_id", "referrer", "source", "medium")


# What the stand-in's own sources, media and referrers are expected to give.
@paired("k7_channel_grouping", WEB_BASE_SQL + """
SELECT event_id, utm_source, utm_medium, CASE utm_source WHEN 'google' THEN 'Google Ads' WHEN 'newsletter' THEN 'Email' WHEN 'bing' THEN 'Bing Ads' WHEN 'facebook' THEN 'Meta Ads' END AS session_source_name, CASE utm_source WHEN 'google' THEN 'Paid Search' WHEN 'newsletter' THEN 'Email' WHEN 'bing' THEN 'Paid Search' WHEN 'facebook' THEN 'Paid Social' END AS session_channel FROM web
""", covers=("K7", "P4", "P6", "P9"))
def k7(spark, sf):
    w = web_events(spark, sf)
    return AQ.channel_grouping(w, "utm_source", "utm_medium").select(
        "event_id", "utm_source", "utm_medium", "session_source_name", "session_channel")


@paired("k6_classify_referrer", TOUCH_SQL + """
SELECT contact_id, touchpoint_id,
  CASE WHEN utm_source IS NOT NULL THEN utm_source WHEN referrer = 'https://www.linkedin.com/feed' THEN 'linkedin' WHEN referrer = 'https://chatgpt.com/' THEN 'chatgpt.com' WHEN referrer = 'https://www.google.com/search' THEN 'google' END AS source, CASE WHEN utm_source IS NOT NULL THEN utm_medium WHEN referrer = 'https://www.linkedin.com/feed' THEN 'social' WHEN referrer = 'https://chatgpt.com/' THEN 'referral' WHEN referrer = 'https://www.google.com/search' THEN 'organic' END AS medium FROM t
""", covers=("K6", "P6"))
def k6(spark, sf):
    t = touch_model(spark, sf)
    return AQ.classify_referrer(t, "referrer", "utm_source", "utm_medium").select(
        "contact_id", "touchpoint_id", "source", "medium")


# Fixed values of the stand-in mapping table: (utm_source, utm_medium, source_name, channel, sort).
MAPPING_ROWS = [
    ("google", "cpc", "Google Ads", "Paid Search", 1),
    ("google", None, "Google", "Search", 2),
    ("%face%", "%paid%", "Meta Ads", "Paid Social", 1),
    ("facebook", None, "Facebook", "Social", 2),
    (None, "email", "Email", "Email", 3),
    ("bing", "cpc", "Bing Ads", "Paid Search", 1),
    (None, "%social%", "Social", "Organic Social", 3),
    (None, None, "Other", "Other", 4),
]


def _mapping_df(spark):
    return spark.createDataFrame(MAPPING_ROWS, "utm_source string, utm_medium string, source_name string, "
                                               "channel string, sort int").withColumnRenamed("utm_source", "p_source") \
        .withColumnRenamed("utm_medium", "p_medium")


def _mapping_sql():
    def v(x):
        return "NULL" if x is None else (str(x) if isinstance(x, int) else f"'{x}'")
    rows = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in MAPPING_ROWS)
    return f"mapping AS (SELECT * FROM (VALUES {rows}) m(p_source, p_medium, source_name, channel, sort))"


_K8_FACTS = """, facts AS (SELECT event_id, utm_source, utm_medium FROM web), """


@paired("k8_map_patterns_best", WEB_BASE_SQL + _K8_FACTS + _mapping_sql() + """
, matched AS (
  SELECT f.event_id, m.source_name, m.channel, m.sort FROM facts f LEFT JOIN mapping m
    ON (m.p_source IS NULL OR lower(f.utm_source) LIKE lower(m.p_source))
   AND (m.p_medium IS NULL OR lower(f.utm_medium) LIKE lower(m.p_medium))
), best AS (
  SELECT event_id, source_name, channel,
         ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY sort, source_name, channel) AS rn FROM matched
)
SELECT event_id, COALESCE(source_name, 'Unmapped') AS source_name, COALESCE(channel, 'Unmapped') AS channel
FROM best WHERE rn = 1
""", covers=("K8", "J8", "S3", "W1", "P6"))
def k8_best(spark, sf):
    facts = web_events(spark, sf).select("event_id", "utm_source", "utm_medium")
    out = AQ.map_patterns(facts, _mapping_df(spark), [("utm_source", "p_source"), ("utm_medium", "p_medium")],
                          ["source_name", "channel"], mode="best")
    return out.select("event_id", "source_name", "channel")


@paired("k8_map_patterns_all", WEB_BASE_SQL + _K8_FACTS + _mapping_sql() + """
SELECT f.event_id, COALESCE(m.source_name, 'Unmapped') AS source_name, COALESCE(m.channel, 'Unmapped') AS channel
FROM facts f LEFT JOIN mapping m
  ON (m.p_source IS NULL OR lower(f.utm_source) LIKE lower(m.p_source))
 AND (m.p_medium IS NULL OR lower(f.utm_medium) LIKE lower(m.p_medium))
""", covers=("K8", "M11", "J8"))
def k8_all(spark, sf):
    facts = web_events(spark, sf).select("event_id", "utm_source", "utm_medium")
    out = AQ.map_patterns(facts, _mapping_df(spark), [("utm_source", "p_source"), ("utm_medium", "p_medium")],
                          ["source_name", "channel"], mode="all")
    return out.select("event_id", "source_name", "channel")


# Fixed values of the stand-in: patterns for part names (infix words, pieces in order, single letters, an escape, wildcards alone, a repeated row).
PART_PATTERNS = [("%blue%", None, "blue", 1), ("%a%e%i%", "%BRASS", "vowels", 2), ("red%", "%", "red start", 3), ("%gr__n%", None, "green", 4), (None, "%polished%", "polished", 5),
                 ("%z%", None, "z", 6), ("%\\\\%%", None, "percent", 7), ("%", "LARGE%", "large", 8), ("%zzzz%", None, "never", 0), ("%blue%", None, "blue", 1), ("_%", "%_", "any", 9)]


@paired("k8_map_patterns_infix", "WITH m AS (SELECT * FROM (VALUES " + ", ".join(f"({'NULL' if a is None else repr(a)}, {'NULL' if b is None else repr(b)}, '{c}', {d})" for a, b, c, d in PART_PATTERNS).replace("\\\\\\\\", "\\\\") + """) v(pn, pt, label, sort))
SELECT p_partkey, COALESCE(m.label, 'none') AS label FROM part LEFT JOIN m
  ON (m.pn IS NULL OR lower(p_name) LIKE lower(m.pn) ESCAPE '\\') AND (m.pt IS NULL OR lower(p_type) LIKE lower(m.pt) ESCAPE '\\')
""", covers=("K8", "J8", "M11", "P6"))
def k8_infix(spark, sf):
    facts = load(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    m = spark.createDataFrame([(a and a.replace("\\\\", "\\"), b, c, d) for a, b, c, d in PART_PATTERNS], "pn string, pt string, label string, sort int")
    return AQ.map_patterns(facts, m, [("p_name", "pn"), ("p_type", "pt")], ["label"], mode="all", unmapped="none").select("p_partkey", "label")


@paired("k4_utm_cascade", WEB_BASE_SQL + """
, x AS (SELECT *, CASE WHEN value > 480 THEN 'gclid-' || CAST(event_id AS VARCHAR) END AS gclid,
          CASE WHEN event_type = 'view' AND k % 4 < 3 THEN 'referral' END AS ref_medium,
          CASE WHEN event_type = 'view' AND k % 4 < 3 THEN 'ref' || CAST(k % 4 AS VARCHAR) END AS ref_source FROM web)
SELECT event_id,
  CASE WHEN gclid IS NOT NULL THEN 'google' WHEN utm_source IS NOT NULL THEN utm_source WHEN ref_source IS NOT NULL THEN ref_source END AS resolved_source,
  CASE WHEN gclid IS NOT NULL THEN 'cpc' WHEN utm_source IS NOT NULL THEN utm_medium WHEN ref_source IS NOT NULL THEN ref_medium END AS resolved_medium,
  CASE WHEN gclid IS NOT NULL THEN NULL WHEN utm_source IS NOT NULL THEN utm_campaign WHEN ref_source IS NOT NULL THEN NULL END AS resolved_campaign,
  CASE WHEN gclid IS NOT NULL THEN 'click_id' WHEN utm_source IS NOT NULL THEN 'manual' WHEN ref_source IS NOT NULL THEN 'referrer' END AS utm_origin
FROM x
""", covers=("K4",))
def k4(spark, sf):
    w = web_events(spark, sf)
    k4_ = (F.col("k") % 4).cast("int")
    view_ref = (F.col("event_type") == "view") & (k4_ < 3)
    w = (w.withColumn("gclid", F.when(F.col("value") > 480, F.concat(F.lit("gclid-"), F.col("event_id").cast("string"))))
         .withColumn("ref_medium", F.when(view_ref, F.lit("referral")))
         .withColumn("ref_source", F.when(view_ref, F.concat(F.lit("ref"), k4_.cast("string"))))
         .withColumn("no_campaign", F.lit(None).cast("string")))
    out = AQ.utm_cascade(w, [("manual", ["utm_source", "utm_medium", "utm_campaign"]),
                             ("referrer", ["ref_source", "ref_medium", "no_campaign"])],
                         ["source", "medium", "campaign"], click_id="gclid",
                         click_values={"source": "google", "medium": "cpc"})
    return out.select("event_id", "resolved_source", "resolved_medium", "resolved_campaign", "utm_origin")


@paired("k5_decode_click_id", WEB_BASE_SQL + """
, g AS (SELECT *, CASE WHEN k % 5 > 0 THEN 'g' || CAST(k % 37 AS VARCHAR) END AS gclid FROM web),
clicks AS (SELECT g.gclid, g.ts, g.event_id, p.p_brand AS campaign, p.p_type AS ad_group
           FROM g JOIN part p ON p.p_partkey = g.k WHERE g.event_type = 'click'),
latest AS (SELECT gclid, campaign AS click_campaign, ad_group AS click_ad_group FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY gclid ORDER BY ts DESC, event_id DESC) AS rn FROM clicks) WHERE rn = 1)
SELECT g.event_id, g.gclid, l.click_campaign, l.click_ad_group,
       CASE WHEN g.gclid IS NULL THEN g.utm_campaign ELSE l.click_campaign END AS campaign
FROM g LEFT JOIN latest l USING (gclid) WHERE g.event_type = 'purchase'
""", covers=("K5", "W18", "O3", "J2"))
def k5(spark, sf):
    w = web_events(spark, sf).withColumn("gclid", F.when(F.col("k") % 5 > 0, F.concat(F.lit("g"), (F.col("k") % 37).cast("string"))))
    p = load(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("campaign"), F.col("p_type").alias("ad_group"))
    clicks = w.filter(F.col("event_type") == "click").join(p, w.k == p.p_partkey)
    s = w.filter(F.col("event_type") == "purchase")
    out = AQ.decode_click_id(s, clicks, "gclid", ["ts", "event_id"], ["campaign", "ad_group"])
    return out.select("event_id", "gclid", "click_campaign", "click_ad_group",
                      AQ.override_by_click("gclid", "click_campaign", "utm_campaign").alias("campaign"))


@paired("k19_touchpoints", TOUCH_SQL + """
SELECT * FROM t
""", covers=("K19", "U1", "U3", "P15"))
def k19(spark, sf):
    return touch_model(spark, sf)


# Fixed values of the stand-in: ignored (source, medium, campaign) triples.
IGNORED = [("google", "cpc", "campaign_3"), ("bing", "cpc", None)]


@paired("k20_ignore_touchpoints", TOUCH_SQL + """
, ign AS (SELECT * FROM (VALUES ('google', 'cpc', 'campaign_3'), ('bing', 'cpc', NULL)) i(s, m, c))
SELECT t.contact_id, t.touchpoint_id FROM t LEFT JOIN ign
  ON t.utm_source = ign.s AND t.utm_medium = ign.m AND t.utm_campaign = ign.c
WHERE ign.s IS NULL
""", covers=("K20", "J10"))
def k20(spark, sf):
    t = touch_model(spark, sf)
    ign = spark.createDataFrame(IGNORED, "utm_source string, utm_medium string, utm_campaign string")
    return AQ.ignore_touchpoints(t, ign).select("contact_id", "touchpoint_id")


@paired("k21_first_touch", TOUCH_SQL + """
, pick AS (
  SELECT contact_id,
    COALESCE(arg_min(touchpoint_id, CASE WHEN utm_source IS NOT NULL OR referrer IS NOT NULL
                                         THEN (touchpoint_timestamp, touchpoint_id) END),
             arg_min(touchpoint_id, (touchpoint_timestamp, touchpoint_id))) AS tid
  FROM t GROUP BY 1)
SELECT p.contact_id, t.touchpoint_id AS first_touchpoint_id, t.touchpoint_timestamp AS first_touchpoint_timestamp,
       t.utm_source AS first_utm_source, t.utm_medium AS first_utm_medium, t.utm_campaign AS first_utm_campaign
FROM pick p JOIN t ON t.contact_id = p.contact_id AND t.touchpoint_id = p.tid
""", covers=("K21", "M26"))
def k21(spark, sf):
    return AQ.first_touch(touch_model(spark, sf))


@paired("k22_first_form", TOUCH_SQL + """
, pick AS (SELECT contact_id, arg_min(touchpoint_id, (touchpoint_timestamp, touchpoint_id)) AS tid
           FROM t WHERE web_event_type = 'form_submission' GROUP BY 1)
SELECT p.contact_id, t.touchpoint_id AS first_form_touchpoint_id, t.touchpoint_timestamp AS first_form_timestamp,
       t.utm_source AS first_form_utm_source, t.utm_campaign AS first_form_utm_campaign
FROM pick p JOIN t ON t.contact_id = p.contact_id AND t.touchpoint_id = p.tid
""", covers=("K22", "M21"))
def k22(spark, sf):
    return AQ.first_form(touch_model(spark, sf))


@paired("k23_last_touch_before_lead", TOUCH_SQL + """
, c AS (SELECT t.*, s.date_lead FROM t JOIN stages s USING (contact_id)
        WHERE CAST(t.touchpoint_timestamp AS DATE) <= s.date_lead),
pick AS (SELECT contact_id, arg_max(touchpoint_id, (touchpoint_timestamp, touchpoint_id)) AS tid FROM c GROUP BY 1)
SELECT p.contact_id, c.touchpoint_id AS lead_last_touchpoint_id, c.touchpoint_timestamp AS lead_last_touchpoint_timestamp,
       c.utm_source AS lead_last_utm_source
FROM pick p JOIN c ON c.contact_id = p.contact_id AND c.touchpoint_id = p.tid
""", covers=("K23", "M20"))
def k23(spark, sf):
    return AQ.last_touch_before(touch_model(spark, sf), stage_dates(spark, sf), "date_lead")


@paired("k24_linear_touch_mql", TOUCH_SQL + """
, c AS (SELECT DISTINCT t.contact_id, t.touchpoint_id, t.touchpoint_timestamp, t.utm_source
        FROM t JOIN stages s USING (contact_id) WHERE CAST(t.touchpoint_timestamp AS DATE) <= s.date_mql),
n AS (SELECT contact_id, COUNT(DISTINCT touchpoint_id) AS n_touches FROM c GROUP BY 1)
SELECT c.*, n.n_touches, 1.0 / n.n_touches AS weight FROM c JOIN n USING (contact_id)
""", covers=("K24", "A10"))
def k24(spark, sf):
    return AQ.linear_touch(touch_model(spark, sf), stage_dates(spark, sf), "date_mql").select(
        "contact_id", "touchpoint_id", "touchpoint_timestamp", "utm_source", "n_touches", "weight")


@paired("k25_attribution_flags", TOUCH_SQL + """
, j AS (SELECT t.*, s.date_lead, s.date_mql FROM t LEFT JOIN stages s USING (contact_id)),
w AS (
  SELECT contact_id,
    arg_min(touchpoint_id, (touchpoint_timestamp, touchpoint_id)) AS f_first,
    arg_min(touchpoint_id, CASE WHEN web_event_type = 'form_submission' THEN (touchpoint_timestamp, touchpoint_id) END) AS f_form,
    arg_max(touchpoint_id, CASE WHEN CAST(touchpoint_timestamp AS DATE) <= date_lead THEN (touchpoint_timestamp, touchpoint_id) END) AS f_lead,
    arg_max(touchpoint_id, CASE WHEN CAST(touchpoint_timestamp AS DATE) <= date_mql THEN (touchpoint_timestamp, touchpoint_id) END) AS f_mql
  FROM j GROUP BY 1)
SELECT j.contact_id, j.touchpoint_id, j.touchpoint_timestamp, j.web_event_type,
  COALESCE(j.touchpoint_id = w.f_first, false) AS is_first_touch_attribution_model,
  COALESCE(j.touchpoint_id = w.f_form, false) AS is_first_form_attribution_model,
  COALESCE(j.touchpoint_id = w.f_lead, false) AS is_lead_last_touch_attribution_model,
  COALESCE(j.touchpoint_id = w.f_mql, false) AS is_mql_last_touch_attribution_model,
  COALESCE(CAST(j.touchpoint_timestamp AS DATE) <= j.date_lead, false) AS is_lead_linear_attribution_model,
  COALESCE(CAST(j.touchpoint_timestamp AS DATE) <= j.date_mql, false) AS is_mql_linear_attribution_model
FROM j JOIN w USING (contact_id)
""", covers=("K25", "W8", "W19"))
def k25(spark, sf):
    return AQ.attribution_flags(touch_model(spark, sf), stage_dates(spark, sf))


@paired("k26_touch_counts_before", TOUCH_SQL + """
, conv AS (SELECT contact_id, CASE WHEN date_lead IS NULL OR date_mql IS NULL THEN NULL
                                   ELSE least(date_lead, date_mql) END AS conversion_date FROM stages)
SELECT t.contact_id,
  COUNT(DISTINCT CASE WHEN CAST(t.touchpoint_timestamp AS DATE) <= c.conversion_date THEN t.touchpoint_id END) AS touches_before_conversion,
  COUNT(DISTINCT CASE WHEN CAST(t.touchpoint_timestamp AS DATE) <= c.conversion_date AND t.web_event_type = 'form_submission'
                 THEN t.touchpoint_id END) AS forms_before_conversion
FROM t JOIN conv c USING (contact_id) GROUP BY 1
""", covers=("K26", "M1"))
def k26(spark, sf):
    return AQ.touch_counts_before(touch_model(spark, sf), stage_dates(spark, sf))


@paired("k27_attributed_events", TOUCH_SQL + """
, pick AS (
  SELECT contact_id,
    COALESCE(arg_min(touchpoint_id, CASE WHEN utm_source IS NOT NULL OR referrer IS NOT NULL
                                         THEN (touchpoint_timestamp, touchpoint_id) END),
             arg_min(touchpoint_id, (touchpoint_timestamp, touchpoint_id))) AS tid FROM t GROUP BY 1),
ft AS (SELECT p.contact_id, t.utm_source AS first_utm_source, t.utm_medium AS first_utm_medium
       FROM pick p JOIN t ON t.contact_id = p.contact_id AND t.touchpoint_id = p.tid),
st AS (SELECT contact_id, 'lead' AS stage, date_lead AS stage_date, CAST(NULL AS DOUBLE) AS amount FROM stages WHERE date_lead IS NOT NULL
       UNION ALL SELECT contact_id, 'mql', date_mql, NULL FROM stages WHERE date_mql IS NOT NULL
       UNION ALL SELECT contact_id, 'won', date_won, NULL FROM stages WHERE date_won IS NOT NULL
       UNION ALL SELECT o_custkey, 'revenue', CAST(o_orderdate AS DATE), o_totalprice FROM orders
                 WHERE o_custkey IN (SELECT contact_id FROM ft))
SELECT st.*, ft.first_utm_source, ft.first_utm_medium FROM st LEFT JOIN ft USING (contact_id)
""", covers=("K27", "J11"))
def k27(spark, sf):
    ft = AQ.first_touch(touch_model(spark, sf)).select("contact_id", "first_utm_source", "first_utm_medium")
    o = load(spark, sf, "orders")
    rev = o.join(ft.select(F.col("contact_id").alias("o_custkey")), "o_custkey", "left_semi").select(
        F.col("o_custkey").alias("contact_id"), F.to_date("o_orderdate").alias("stage_date"),
        F.col("o_totalprice").alias("amount"))
    return AQ.attributed_events(ft, stage_dates(spark, sf), ["date_lead", "date_mql", "date_won"], revenue=rev) \
        .select("contact_id", "stage", "stage_date", "amount", "first_utm_source", "first_utm_medium")


@paired("k28_indicator_matrix", TOUCH_SQL + """
, flags AS (
  SELECT contact_id,
    COALESCE(arg_min(utm_source, CASE WHEN utm_source IS NOT NULL THEN (touchpoint_timestamp, touchpoint_id) END), '(none)') AS ch_first,
    COALESCE(arg_max(utm_source, CASE WHEN utm_source IS NOT NULL THEN (touchpoint_timestamp, touchpoint_id) END), '(none)') AS ch_last
  FROM t GROUP BY 1),
cev AS (SELECT s.contact_id, s.date_lead, s.date_mql, s.date_won, f.ch_first, f.ch_last FROM stages s JOIN flags f USING (contact_id)),
ind AS (SELECT contact_id, 'leads' AS indicator, date_lead AS indicator_date, CAST(1.0 AS DOUBLE) AS value, ch_first, ch_last FROM cev WHERE date_lead IS NOT NULL
        UNION ALL SELECT contact_id, 'mqls', date_mql, 1.0, ch_first, ch_last FROM cev WHERE date_mql IS NOT NULL
        UNION ALL SELECT contact_id, 'won', date_won, 1.0, ch_first, ch_last FROM cev WHERE date_won IS NOT NULL),
m AS (SELECT indicator, indicator_date, value, 'first_touch' AS model, ch_first AS channel FROM ind
      UNION ALL SELECT indicator, indicator_date, value, 'last_touch', ch_last FROM ind)
SELECT indicator, model, indicator_date, channel, SUM(value) AS attributed_value FROM m GROUP BY ALL
""", covers=("K28", "J12"))
def k28(spark, sf):
    t = touch_model(spark, sf)
    key = F.when(F.col("utm_source").isNotNull(), F.struct("touchpoint_timestamp", "touchpoint_id"))
    flags = t.groupBy("contact_id").agg(
        F.coalesce(F.min_by("utm_source", key), F.lit("(none)")).alias("ch_first"),
        F.coalesce(F.max_by("utm_source", key), F.lit("(none)")).alias("ch_last"))
    ev = stage_dates(spark, sf).join(flags, "contact_id")
    return AQ.indicator_matrix(ev, [("leads", "date_lead", None), ("mqls", "date_mql", None), ("won", "date_won", None)],
                               [("first_touch", "ch_first", None), ("last_touch", "ch_last", None)], [])


# Event types as CRM stages in two histories (rank 1..4).
STAGE_NAMES = ["lead", "qualified", "opportunity", "won"]


@paired("k30_funnel_dates", """
WITH h AS (
  SELECT user_id, CAST(ts AS DATE) AS d, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 END AS stage_rank
  FROM events WHERE event_type IN ('signup', 'view')
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), CASE event_type WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 END
  FROM events WHERE event_type IN ('click', 'purchase'))
SELECT user_id,
  MIN(CASE WHEN stage_rank >= 1 THEN d END) AS date_lead, MIN(CASE WHEN stage_rank >= 2 THEN d END) AS date_qualified,
  MIN(CASE WHEN stage_rank >= 3 THEN d END) AS date_opportunity, MIN(CASE WHEN stage_rank >= 4 THEN d END) AS date_won
FROM h GROUP BY 1
""", covers=("K30", "A3"))
def k30(spark, sf):
    e = load(spark, sf, "events")
    h1 = e.filter(F.col("event_type").isin("signup", "view")).select(
        "user_id", F.to_date("ts").alias("d"),
        F.when(F.col("event_type") == "signup", 1).otherwise(2).alias("stage_rank"))
    h2 = e.filter(F.col("event_type").isin("click", "purchase")).select(
        "user_id", F.to_date("ts").alias("d"),
        F.when(F.col("event_type") == "click", 3).otherwise(4).alias("stage_rank"))
    return AQ.funnel_dates([h1, h2], "user_id", "d", "stage_rank", STAGE_NAMES)


K31_PERIODS = [("current", "2024-01-16", "2024-01-30"), ("previous", "2024-01-01", "2024-01-15")]


@paired("k31_stage_conversion_counts", TOUCH_SQL + """
, p AS (SELECT * FROM (VALUES ('current', DATE '2024-01-16', DATE '2024-01-30'),
                              ('previous', DATE '2024-01-01', DATE '2024-01-15')) v(period, lo, hi))
SELECT p.period,
  COUNT(DISTINCT CASE WHEN s.date_lead BETWEEN p.lo AND p.hi THEN s.contact_id END) AS leads,
  COUNT(DISTINCT CASE WHEN s.date_lead BETWEEN p.lo AND p.hi AND s.date_mql <= p.hi THEN s.contact_id END) AS lead_to_mql,
  COUNT(DISTINCT CASE WHEN s.date_lead BETWEEN p.lo AND p.hi AND s.date_won <= p.hi THEN s.contact_id END) AS won,
  COUNT(DISTINCT CASE WHEN s.date_lead BETWEEN p.lo AND p.hi AND s.date_lost <= p.hi THEN s.contact_id END) AS lost,
  COUNT(DISTINCT CASE WHEN s.date_lead BETWEEN p.lo AND p.hi AND (s.date_won IS NULL OR s.date_won > p.hi)
                       AND (s.date_lost IS NULL OR s.date_lost > p.hi) THEN s.contact_id END) AS open
FROM stages s CROSS JOIN p GROUP BY p.period
""", covers=("K31", "A4", "K89"))
def k31(spark, sf):
    return AQ.stage_conversion_counts(stage_dates(spark, sf), K31_PERIODS)


@paired("k32_contact_classification", """
WITH s AS (
  SELECT user_id AS contact_id,
    CAST(MIN(CASE WHEN event_type = 'signup' THEN ts END) AS DATE) AS date_lead,
    CAST(MIN(CASE WHEN event_type = 'error' THEN ts END) AS DATE) AS date_lost,
    CAST(MIN(CASE WHEN event_type = 'purchase' AND value > 400 THEN ts END) AS DATE) AS date_won_invoicing,
    CAST(MIN(CASE WHEN event_type = 'click' AND value > 300 THEN ts END) AS DATE) AS quote_accepted_date,
    CAST(MIN(CASE WHEN event_type = 'purchase' THEN ts END) AS DATE) AS date_first_subscription,
    CASE WHEN arg_min(value, CASE WHEN event_type = 'signup' THEN (ts, event_id) END) > 250 THEN 'Signup creation'
         WHEN arg_min(value, CASE WHEN event_type = 'signup' THEN (ts, event_id) END) IS NOT NULL THEN 'Newsletter' END AS first_conversion_form
  FROM events GROUP BY 1)
SELECT contact_id,
  COALESCE(CASE WHEN first_conversion_form IN ('Signup creation', 'Signup accounting', 'contact', 'RDV Sales Calendly',
      'Other Calendly meetings', 'Intercom') THEN 'MQL First' ELSE 'Lead First' END, '-') AS contact_type,
  COALESCE(CASE
    WHEN date_lost < (CASE WHEN date_won_invoicing IS NULL OR quote_accepted_date IS NULL OR date_first_subscription IS NULL
                           THEN NULL ELSE least(date_won_invoicing, quote_accepted_date, date_first_subscription) END) THEN 'Congel'
    WHEN date_diff('day', date_lead, COALESCE(quote_accepted_date, date_first_subscription)) <= 7 THEN 'Sec'
    WHEN date_diff('day', date_lead, COALESCE(quote_accepted_date, date_first_subscription)) > 7 THEN 'Frigo'
    ELSE '-' END, '-') AS treatment_type
FROM s
""", covers=("K32", "M1", "F-d4"))
def k32(spark, sf):
    e = load(spark, sf, "events")
    t, v = F.col("event_type"), F.col("value")
    sig = F.when(t == "signup", F.struct("ts", "event_id"))
    fv = F.min_by(v, sig)
    s = e.groupBy(F.col("user_id").alias("contact_id")).agg(
        F.to_date(F.min(F.when(t == "signup", F.col("ts")))).alias("date_lead"),
        F.to_date(F.min(F.when(t == "error", F.col("ts")))).alias("date_lost"),
        F.to_date(F.min(F.when((t == "purchase") & (v > 400), F.col("ts")))).alias("date_won_invoicing"),
        F.to_date(F.min(F.when((t == "click") & (v > 300), F.col("ts")))).alias("quote_accepted_date"),
        F.to_date(F.min(F.when(t == "purchase", F.col("ts")))).alias("date_first_subscription"),
        F.when(fv > 250, "Signup creation").when(fv.isNotNull(), "Newsletter").alias("first_conversion_form"))
    return AQ.contact_classification(s).select("contact_id", "contact_type", "treatment_type")


@paired("k33_churn_date", """
WITH s AS (
  SELECT o.o_custkey AS customer_id, CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'annual' ELSE 'monthly' END AS billing_period,
         CAST(MAX(CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate END) AS DATE) AS suspension_date,
         CAST(MAX(o.o_orderdate) AS DATE) AS last_bill_date
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2)
SELECT *, CASE WHEN billing_period = 'annual' THEN suspension_date
               WHEN last_bill_date IS NULL OR suspension_date IS NULL THEN NULL
               ELSE greatest(last_bill_date, suspension_date) END AS churn_date
FROM s
""", covers=("K33", "M1", "F-m4"))
def k33(spark, sf):
    o = load(spark, sf, "orders")
    c = load(spark, sf, "customer")
    s = o.join(c, o.o_custkey == c.c_custkey).groupBy(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "annual").otherwise("monthly").alias("billing_period")).agg(
        F.to_date(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")))).alias("suspension_date"),
        F.to_date(F.max("o_orderdate")).alias("last_bill_date"))
    return AQ.churn_date(s)


@paired("k34_latest_identity", """
WITH forms AS (SELECT user_id, ts, event_id, 'user' || CAST(user_id % 50 AS VARCHAR) || '@example.org' AS email
               FROM events WHERE event_type = 'signup'),
last AS (SELECT email, arg_max(user_id, (ts, event_id)) AS latest_id FROM forms GROUP BY 1),
ev AS (SELECT event_id, user_id, 'user' || CAST(user_id % 50 AS VARCHAR) || '@example.org' AS email FROM events)
SELECT ev.event_id, ev.email, last.latest_id, COALESCE(last.latest_id, ev.user_id) AS resolved_id
FROM ev LEFT JOIN last USING (email)
""", covers=("K34", "O3"))
def k34(spark, sf):
    e = load(spark, sf, "events")
    email = F.concat(F.lit("user"), (F.col("user_id") % 50).cast("string"), F.lit("@example.org"))
    forms = e.filter(F.col("event_type") == "signup").withColumn("email", email)
    ev = e.select("event_id", "user_id", email.alias("email"))
    return AQ.latest_identity(forms, ev, "email", "user_id", ["ts", "event_id"], "user_id").select(
        "event_id", "email", "latest_id", "resolved_id")


@paired("k35_form_values", """
WITH f AS (
  SELECT event_id, CASE WHEN value > 100
      THEN '[{"name":"k","value":"' || json_extract_string(props, '$.k') || '"},{"name":"type","value":"' || event_type || '"}]'
      ELSE '[]' END AS form_json
  FROM events WHERE event_type = 'signup')
SELECT event_id, form_json,
  json_extract_string(form_json, '$[0].value') AS field_k, json_extract_string(form_json, '$[1].value') AS field_type,
  CAST(NULL AS VARCHAR) AS field_email
FROM f
""", covers=("K35", "F-j2", "F-j3"))
def k35(spark, sf):
    e = load(spark, sf, "events").filter(F.col("event_type") == "signup")
    js = F.when(F.col("value") > 100, F.concat(
        F.lit('[{"name":"k","value":"'), F.get_json_object("props", "$.k"), F.lit('"},{"name":"type","value":"'),
        F.col("event_type"), F.lit('"}]'))).otherwise(F.lit("[]"))
    f = e.select("event_id", js.alias("form_json"))
    return AQ.form_values(f, "form_json", ["k", "type", "email"])
