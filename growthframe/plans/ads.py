"""Paired queries for advertising consolidation.

Stand-ins: the campaign / ad group / ad hierarchy is ``l_suppkey`` / ``l_partkey`` /
``l_linenumber``; finer levels report only part of the cost (ad groups: return flags A and N;
ads: flag N), so the reconciliation has residues; platforms = lineitem split by return flag.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up
from growthframe.operators import ads as AD
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

R2 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"

_L_SQL = """
WITH l AS (SELECT CAST(l_shipdate AS DATE) AS date_report, CAST(l_suppkey AS VARCHAR) AS campaign_id,
                  CAST(l_partkey AS VARCHAR) AS ad_group_id, CAST(l_linenumber AS VARCHAR) AS ad_id, l_returnflag,
                  l_extendedprice AS cost, l_quantity AS clicks FROM lineitem)"""


def _l(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(F.to_date("l_shipdate").alias("date_report"), F.col("l_suppkey").cast("string").alias("campaign_id"),
                     F.col("l_partkey").cast("string").alias("ad_group_id"),
                     F.col("l_linenumber").cast("string").alias("ad_id"), "l_returnflag",
                     F.col("l_extendedprice").alias("cost"), F.col("l_quantity").alias("clicks"))


@paired("k36_hierarchy_reconcile", _L_SQL + f"""
, c AS (SELECT date_report, campaign_id, SUM(cost) AS cost, SUM(clicks) AS clicks FROM l GROUP BY 1, 2),
g AS (SELECT date_report, campaign_id, ad_group_id, SUM(cost) AS cost, SUM(clicks) AS clicks FROM l
      WHERE l_returnflag IN ('A', 'N') GROUP BY 1, 2, 3),
a AS (SELECT date_report, campaign_id, ad_group_id, ad_id, SUM(cost) AS cost, SUM(clicks) AS clicks FROM l
      WHERE l_returnflag = 'N' GROUP BY 1, 2, 3, 4),
u AS (SELECT date_report, campaign_id, NULL AS ad_group_id, NULL AS ad_id, cost, clicks FROM c
      UNION ALL SELECT date_report, campaign_id, ad_group_id, NULL, cost, clicks FROM g
      UNION ALL SELECT date_report, campaign_id, NULL, NULL, -cost, -clicks FROM g
      UNION ALL SELECT date_report, campaign_id, ad_group_id, ad_id, cost, clicks FROM a
      UNION ALL SELECT date_report, campaign_id, ad_group_id, NULL, -cost, -clicks FROM a)
SELECT date_report, campaign_id, ad_group_id, ad_id, {R2.format(x="SUM(cost)")} AS cost, {R2.format(x="SUM(clicks)")} AS clicks
FROM u GROUP BY 1, 2, 3, 4 HAVING abs(SUM(cost)) > 1e-9 OR abs(SUM(clicks)) > 1e-9
""", covers=("K36", "J12", "U1", "A7"))
def k36(spark, sf):
    l = _l(spark, sf)
    c = l.groupBy("date_report", "campaign_id").agg(F.sum("cost").alias("cost"), F.sum("clicks").alias("clicks"))
    g = l.filter(F.col("l_returnflag").isin("A", "N")).groupBy("date_report", "campaign_id", "ad_group_id").agg(
        F.sum("cost").alias("cost"), F.sum("clicks").alias("clicks"))
    a = l.filter(F.col("l_returnflag") == "N").groupBy("date_report", "campaign_id", "ad_group_id", "ad_id").agg(
        F.sum("cost").alias("cost"), F.sum("clicks").alias("clicks"))
    r = AD.hierarchy_reconcile([c, g, a], ["campaign_id", "ad_group_id", "ad_id"], ["cost", "clicks"])
    return r.select("date_report", "campaign_id", "ad_group_id", "ad_id", round_half_up("cost", 2).alias("cost"),
                    round_half_up("clicks", 2).alias("clicks"))


@paired("k37_latest_dim", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_orderdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""", covers=("K37", "O3", "W18"))
def k37(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return AD.latest_dim(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


_PLAT_SQL = _L_SQL + """
, u AS (SELECT 'platform_a' AS platform, date_report, campaign_id, CAST(CAST(cost * 1000000 AS BIGINT) AS DOUBLE) / 1000000.0 AS cost, clicks
        FROM l WHERE l_returnflag = 'A'
        UNION ALL SELECT 'platform_n', date_report, campaign_id, cost, clicks FROM l WHERE l_returnflag = 'N'
        UNION ALL SELECT 'platform_r', date_report, campaign_id, cost * 1.2, clicks FROM l WHERE l_returnflag = 'R'),
g AS (SELECT platform, date_report, campaign_id, SUM(cost) AS cost, SUM(clicks) AS clicks FROM u GROUP BY 1, 2, 3
      HAVING COALESCE(SUM(cost), 0) <> 0 OR COALESCE(SUM(clicks), 0) <> 0)"""


def _platforms(spark, sf):
    l = _l(spark, sf)
    a = l.filter(F.col("l_returnflag") == "A").select(
        "date_report", "campaign_id", ((F.col("cost") * 1000000).cast("long").cast("double") / 1000000.0).alias("cost"),
        "clicks")
    n = l.filter(F.col("l_returnflag") == "N").select("date_report", "campaign_id", "cost", "clicks")
    r = l.filter(F.col("l_returnflag") == "R").select("date_report", "campaign_id", (F.col("cost") * 1.2).alias("cost"),
                                                      "clicks")
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("campaign_id"),
                                           F.col("s_name").alias("campaign_name"))
    return AD.consolidate_platforms([("platform_a", a), ("platform_n", n), ("platform_r", r)],
                                    ["date_report", "campaign_id"], ["cost", "clicks"], s, "campaign_id")


@paired("k38_consolidate_platforms", _PLAT_SQL + f"""
SELECT g.platform, g.date_report, g.campaign_id, s.s_name AS campaign_name, {R2.format(x="g.cost")} AS cost, g.clicks
FROM g LEFT JOIN supplier s ON CAST(s.s_suppkey AS VARCHAR) = g.campaign_id
""", covers=("K38", "U1", "J20", "A7"))
def k38(spark, sf):
    p = _platforms(spark, sf)
    return p.select("platform", "date_report", "campaign_id", "campaign_name", round_half_up("cost", 2).alias("cost"),
                    "clicks")


@paired("k39_cross_source_table", f"""
WITH m AS (SELECT CAST(l_shipdate AS DATE) AS d, SUM(l_extendedprice) AS cost FROM lineitem GROUP BY 1),
a AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS events FROM events GROUP BY 1),
c AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM(o_totalprice) AS revenue FROM orders GROUP BY 1)
SELECT 'media' AS source, d, {R2.format(x="cost")} AS cost, CAST(NULL AS BIGINT) AS events, CAST(NULL AS DOUBLE) AS revenue FROM m
UNION ALL SELECT 'analytics', d, NULL, events, NULL FROM a
UNION ALL SELECT 'crm', d, NULL, NULL, {R2.format(x="revenue")} FROM c
""", covers=("K39", "P3", "U1"))
def k39(spark, sf):
    m = load(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(
        round_half_up(F.sum("l_extendedprice"), 2).alias("cost"))
    a = load(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("events"))
    c = load(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(
        round_half_up(F.sum("o_totalprice"), 2).alias("revenue"))
    return AD.cross_source_table([("media", m), ("analytics", a), ("crm", c)]).select(
        "source", "d", "cost", "events", "revenue")


_ACTIONS_SQL = """
WITH x AS (SELECT CAST(ts AS DATE) AS d,
  CASE WHEN event_type = 'purchase' THEN '[{"action_type":"purchase","value":"' || CAST(value AS VARCHAR) || '"},{"action_type":"lead","value":"1"}]'
       WHEN event_type = 'signup' THEN '[{"action_type":"lead","value":"1"}]' ELSE '[]' END AS actions FROM events)"""


@paired("k40_json_conversions", _ACTIONS_SQL + f"""
, g AS (SELECT d,
  SUM(COALESCE(CASE WHEN json_extract_string(actions, '$[0].action_type') IN ('purchase', 'offsite_conversion')
                    THEN TRY_CAST(json_extract_string(actions, '$[0].value') AS DOUBLE) END, 0)
    + COALESCE(CASE WHEN json_extract_string(actions, '$[1].action_type') IN ('purchase', 'offsite_conversion')
                    THEN TRY_CAST(json_extract_string(actions, '$[1].value') AS DOUBLE) END, 0)) AS conversions,
  SUM(COALESCE(CASE WHEN json_extract_string(actions, '$[0].action_type') = 'lead' THEN TRY_CAST(json_extract_string(actions, '$[0].value') AS DOUBLE) END, 0)
    + COALESCE(CASE WHEN json_extract_string(actions, '$[1].action_type') = 'lead' THEN TRY_CAST(json_extract_string(actions, '$[1].value') AS DOUBLE) END, 0)) AS leads
  FROM x GROUP BY 1)
SELECT d, 'conversions' AS measure, {R2.format(x="conversions")} AS value FROM g
UNION ALL SELECT d, 'leads', {R2.format(x="leads")} FROM g
""", covers=("K40", "F-j2", "F-j3", "A3"))
def k40(spark, sf):
    e = load(spark, sf, "events")
    actions = (F.when(F.col("event_type") == "purchase",
                      F.concat(F.lit('[{"action_type":"purchase","value":"'), F.col("value").cast("string"),
                               F.lit('"},{"action_type":"lead","value":"1"}]')))
               .when(F.col("event_type") == "signup", F.lit('[{"action_type":"lead","value":"1"}]'))
               .otherwise(F.lit("[]")))
    x = e.select(F.to_date("ts").alias("d"), actions.alias("actions"))
    out = AD.json_conversions(x, "actions", ["d"], {"conversions": ["purchase", "offsite_conversion"],
                                                    "leads": ["lead"]})
    return out.select("d", "measure", round_half_up("value", 2).alias("value"))


@paired("k41_stage_flatten", """
WITH x AS (SELECT event_id,
  '{"k":' || json_extract_string(props, '$.k') || ',"utm":"' || CASE WHEN event_type = 'click' THEN 'google' ELSE '' END
  || '","price":"' || CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) ELSE 'n/a' END || '"}' AS blob FROM events)
SELECT event_id, blob, TRY_CAST(json_extract_string(blob, '$.k') AS BIGINT) AS k,
       NULLIF(json_extract_string(blob, '$.utm'), '') AS utm, TRY_CAST(json_extract_string(blob, '$.price') AS DOUBLE) AS price
FROM x
""", covers=("K41", "F-j1", "F-j3", "F-j4", "F-c2"))
def k41(spark, sf):
    e = load(spark, sf, "events")
    blob = F.concat(F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"utm":"'),
                    F.when(F.col("event_type") == "click", "google").otherwise(""), F.lit('","price":"'),
                    F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).otherwise("n/a"), F.lit('"}'))
    x = e.select("event_id", blob.alias("blob"))
    return AD.stage_flatten(x, "blob", {"k": ("$.k", "bigint"), "utm": ("$.utm", "string"),
                                        "price": ("$.price", "double")})
