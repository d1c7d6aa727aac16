"""Paired queries for cohort revenue windows with spend, cost, signups and channel, and their projection.

Stand-ins: workspace = customer, signed up on its first order; every order is revenue (0 for every 13th), every fourth also a
cost of a quarter of its price; country = nation key, plans = priority of the first and last order; source and channel by customer;
spend = a hundredth of shipped prices by day, nation and supplier.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from growthframe.operators import cohort_revenue as CR
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

AS_OF = "1996-02-29"
KEYS = ["country", "first_plan", "last_plan", "source_name", "channel"]
# The advertised sources.
SOURCES = ["Meta Ads", "Organic Social", "Google Ads"]

_FACTS_SQL = f"""
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18, 2)) AS p, o_orderpriority AS plan FROM orders),
w AS (SELECT c, MIN(d) AS signup, arg_min(plan, (d, k)) AS first_plan, arg_max(plan, (d, k)) AS last_plan FROM o GROUP BY 1),
a AS (SELECT w.*, CAST(c_nationkey AS VARCHAR) AS country, CASE c % 4 WHEN 0 THEN 'Meta Ads' WHEN 1 THEN 'Organic Social' WHEN 2 THEN 'Google Ads' ELSE 'Other' END AS source_name,
             'channel ' || CAST(c % 3 AS VARCHAR) AS channel FROM w JOIN customer ON c_custkey = c),
f AS (SELECT a.*, o.d AS event, 'prestation' AS scope, CAST(CASE WHEN k % 13 = 0 THEN 0 ELSE p END AS DECIMAL(18, 4)) AS value FROM o JOIN a USING (c) WHERE source_name <> 'Other'
      UNION ALL SELECT a.*, o.d, 'cost', CAST(p * CAST(0.25 AS DECIMAL(3, 2)) AS DECIMAL(18, 4)) FROM o JOIN a USING (c) WHERE source_name <> 'Other' AND k % 4 = 1),
ads AS (SELECT CAST(l_shipdate AS DATE) AS d, CAST(l_suppkey % 25 AS VARCHAR) AS country, CASE l_suppkey % 4 WHEN 0 THEN 'Meta Ads' WHEN 1 THEN 'Organic Social' WHEN 2 THEN 'Google Ads' ELSE 'Other' END AS source_name,
               'channel ' || CAST(l_suppkey % 3 AS VARCHAR) AS channel, CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(18, 4)) AS amount FROM lineitem),
wins AS (SELECT unnest(range(1, 13))::INTEGER AS n),
u AS (
  SELECT d AS date, country, NULL AS first_plan, NULL AS last_plan, source_name, channel, n AS window_months, NULL::BIGINT AS cohort_size, NULL::BIGINT AS paid, NULL::DECIMAL(38, 4) AS gross,
         NULL::DECIMAL(38, 4) AS cost, SUM(amount) AS spend, NULL::BIGINT AS new_signups
  FROM ads, wins WHERE source_name <> 'Other' AND d BETWEEN DATE '{AS_OF}' - INTERVAL 1 MONTH AND DATE '{AS_OF}' GROUP BY ALL
  UNION ALL SELECT signup, country, first_plan, last_plan, source_name, channel, n, NULL, NULL, NULL, NULL, NULL, COUNT(DISTINCT c)
  FROM a, wins WHERE source_name <> 'Other' AND signup BETWEEN DATE '{AS_OF}' - INTERVAL 1 MONTH AND DATE '{AS_OF}' GROUP BY ALL
  UNION ALL SELECT signup, country, first_plan, last_plan, source_name, channel, n, COUNT(DISTINCT c), COUNT(CASE WHEN value <> 0 THEN 1 END), SUM(value), NULL, NULL, NULL
  FROM f, wins WHERE scope = 'prestation' AND event BETWEEN signup AND signup + to_months(n) GROUP BY ALL
  UNION ALL SELECT signup, country, first_plan, last_plan, source_name, channel, NULL, COUNT(DISTINCT c), COUNT(CASE WHEN value <> 0 THEN 1 END), SUM(value), NULL, NULL, NULL
  FROM f WHERE scope = 'prestation' AND event >= signup GROUP BY ALL
  UNION ALL SELECT signup, country, first_plan, last_plan, source_name, channel, n, NULL, NULL, NULL, SUM(value), NULL, NULL
  FROM f, wins WHERE scope = 'cost' AND event BETWEEN signup AND signup + to_months(n) GROUP BY ALL
  UNION ALL SELECT signup, country, first_plan, last_plan, source_name, channel, NULL, NULL, NULL, NULL, SUM(value), NULL, NULL
  FROM f WHERE scope = 'cost' AND event >= signup GROUP BY ALL),
rr AS (SELECT date, country, first_plan, last_plan, source_name, channel, window_months, NULLIF(SUM(spend), 0) AS spend, NULLIF(SUM(new_signups), 0) AS new_signups, NULLIF(SUM(cohort_size), 0) AS cohort_size,
              NULLIF(SUM(paid), 0) AS paid_transactions, NULLIF(SUM(gross), 0) AS gross_revenues, NULLIF(SUM(gross), 0) - NULLIF(SUM(cost), 0) AS net_revenues
       FROM u GROUP BY ALL HAVING COALESCE(NULLIF(SUM(spend), 0), NULLIF(SUM(new_signups), 0), NULLIF(SUM(cohort_size), 0), NULLIF(SUM(paid), 0), NULLIF(SUM(gross), 0), NULLIF(SUM(cost), 0)) IS NOT NULL)
"""


def _rows(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.to_date("o_orderdate").alias("d"),
                                         F.col("o_totalprice").cast("decimal(18,2)").alias("p"), F.col("o_orderpriority").alias("plan"))
    at = F.struct("d", "k")
    w = o.groupBy("c").agg(F.min("d").alias("signup"), F.min_by("plan", at).alias("first_plan"), F.max_by("plan", at).alias("last_plan"))

    def source(x):
        return F.when(x % 4 < 3, F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (x % 4 + 1).cast("int")))

    def channel(x):
        return F.concat(F.lit("channel "), (x % 3).cast("string"))

    cust = load(spark, sf, "customer").select(F.col("c_custkey").alias("c"), F.col("c_nationkey").cast("string").alias("country"))
    a = w.join(cust, "c").withColumn("source_name", source(F.col("c"))).withColumn("channel", channel(F.col("c"))).filter("source_name IS NOT NULL")
    scopes = F.explode(F.filter(F.array(
        F.struct(F.lit("prestation").alias("scope"), F.when(F.col("k") % 13 == 0, F.lit(0)).otherwise(F.col("p")).cast("decimal(18,4)").alias("value")),
        F.when(F.col("k") % 4 == 1, F.struct(F.lit("cost").alias("scope"), (F.col("p") * F.lit(Decimal("0.25"))).cast("decimal(18,4)").alias("value")))), lambda s: s.isNotNull()))
    f = o.select("c", "k", F.col("d").alias("event"), scopes.alias("s")).select("c", "event", "s.*").join(a, "c")
    li = load(spark, sf, "lineitem")
    ads = li.select(F.to_date("l_shipdate").alias("d"), (F.col("l_suppkey") % 25).cast("string").alias("country"), source(F.col("l_suppkey")).alias("source_name"),
                    channel(F.col("l_suppkey")).alias("channel"), (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(Decimal("0.01"))).cast("decimal(18,4)").alias("amount")).filter("source_name IS NOT NULL")
    m = CR.window_measures(f, KEYS, "c", "signup", "event", "scope", "value")
    return CR.revenue_and_spend(m, ads, a.withColumn("entity", F.col("c")), KEYS, "signup", AS_OF)


@paired("k85_windows_spend_cost_signups", _FACTS_SQL + """
SELECT country, first_plan, last_plan, source_name, channel, date, window_months, CAST(spend AS DOUBLE) AS spend, CAST(new_signups AS BIGINT) AS new_signups, CAST(cohort_size AS BIGINT) AS cohort_size,
       CAST(paid_transactions AS BIGINT) AS paid_transactions, CAST(gross_revenues AS DOUBLE) AS gross_revenues, CAST(net_revenues AS DOUBLE) AS net_revenues FROM rr
""", covers=("K85", "J17", "A7", "M3"))
def k85_full(spark, sf):
    x = _rows(spark, sf)
    return x.select(*KEYS, "date", "window_months", *[F.col(c).cast("double").alias(c) if c in ("spend", "gross_revenues", "net_revenues") else F.col(c).cast("long").alias(c)
                                                      for c in ("spend", "new_signups", "cohort_size", "paid_transactions", "gross_revenues", "net_revenues")])


@paired("k86_projection_by_channel", _FACTS_SQL + f"""
, pr AS (SELECT country, first_plan, last_plan, source_name, channel, window_months AS m, SUM(spend) AS spend, SUM(new_signups) AS new_signups, SUM(cohort_size) AS cohort_size, SUM(gross_revenues) AS g, SUM(net_revenues) AS n
         FROM rr WHERE window_months IS NOT NULL AND (date BETWEEN DATE '{AS_OF}' - to_months(2 * window_months) AND DATE '{AS_OF}' - to_months(window_months) OR spend IS NOT NULL OR new_signups IS NOT NULL)
         GROUP BY ALL),
x AS (SELECT *, CASE WHEN cohort_size = 0 THEN 0 ELSE CAST(g AS DOUBLE) / cohort_size END AS lg, CASE WHEN cohort_size = 0 THEN 0 ELSE CAST(n AS DOUBLE) / cohort_size END AS ln FROM pr)
SELECT source_name, channel, m AS window_months, CAST(DATE '{AS_OF}' + to_months(m) AS DATE) AS month, CAST(NULLIF(SUM(spend), 0) AS DOUBLE) AS spend, CAST(NULLIF(SUM(new_signups), 0) AS BIGINT) AS new_signups,
       CAST(ROUND(CAST(SUM(new_signups * lg) AS DECIMAL(38, 8)), 3) AS DOUBLE) AS gross_revenues, CAST(ROUND(CAST(SUM(new_signups * ln) AS DECIMAL(38, 8)), 3) AS DOUBLE) AS net_revenues,
       CAST(ROUND(CAST(AVG(lg) AS DECIMAL(38, 8)), 3) AS DOUBLE) AS gross_ltv, CAST(ROUND(CAST(AVG(ln) AS DECIMAL(38, 8)), 3) AS DOUBLE) AS net_ltv FROM x GROUP BY ALL
""", covers=("K86", "F-m3", "M17"))
def k86_full(spark, sf):
    x = CR.project_revenues(_rows(spark, sf), KEYS, ["source_name", "channel"], AS_OF)
    from growthframe.functions.semantics import round_half_up
    return x.select("source_name", "channel", "window_months", "month", F.col("spend").cast("double").alias("spend"), F.col("new_signups").cast("long").alias("new_signups"),
                    *[round_half_up(c, 3).alias(c) for c in ("gross_revenues", "net_revenues", "gross_ltv", "net_ltv")])
