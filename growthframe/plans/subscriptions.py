"""Paired queries for subscription revenue (K79-K87, K118-K120).

Stand-ins (FIXTURES.md section 3): invoice line = ``lineitem`` with period start
``l_shipdate`` and ``1 + l_linenumber % 12`` months; plan interval by ``l_linenumber % 3``;
monthly recurring revenue per customer = ``orders`` summed per customer and month.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up
from growthframe.operators import subscriptions as SU
from growthframe.operators.customers import monthly_cohort_orders
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

R2 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"
R4 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 4) AS DOUBLE)"
AS_OF = "2001-08-01"


@paired("k79_spread_periods", f"""
WITH l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m0, 1 + l_linenumber % 12 AS months, l_extendedprice AS amount
           FROM lineitem),
b AS (SELECT MIN(m0) AS lo, MAX(m0 + INTERVAL 12 MONTH) AS hi FROM l),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
j AS (SELECT cal.month, l.amount / l.months AS piece FROM l JOIN cal
      ON cal.month >= l.m0 AND cal.month <= CAST(l.m0 + to_months(l.months - 1) AS DATE))
SELECT month, {R2.format(x="SUM(piece)")} AS spread_amount, COUNT(*) AS pieces FROM j GROUP BY 1
""", covers=("K79", "J5", "M25", "S19"))
def k79(spark, sf):
    li = load(spark, sf, "lineitem").withColumn("months", 1 + F.col("l_linenumber") % 12)
    s = SU.spread_periods(li, "l_shipdate", "months", "l_extendedprice")
    return s.groupBy("month").agg(round_half_up(F.sum("monthly_amount"), 2).alias("spread_amount"),
                                  F.count("*").alias("pieces"))


_PLAN_SQL = """
WITH p AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_discount, l_extendedprice AS amount, l_quantity AS quantity,
                  CASE l_linenumber % 3 WHEN 0 THEN 'week' WHEN 1 THEN 'Month' ELSE 'year' END AS plan_interval,
                  l_linenumber % 2 AS interval_count FROM lineitem),
n AS (SELECT *, CASE WHEN lower(plan_interval) = 'week' THEN amount * COALESCE(quantity, 1) * 52.0 / 12.0
                     WHEN lower(plan_interval) = 'month' THEN amount * COALESCE(quantity, 1)
                     WHEN lower(plan_interval) = 'year' THEN amount * COALESCE(quantity, 1) / 12.0 END
                / NULLIF(interval_count, 0) AS mrr FROM p)"""


def _plans(spark, sf):
    li = load(spark, sf, "lineitem")
    p = li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount",
                  F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("quantity"),
                  F.when(F.col("l_linenumber") % 3 == 0, "week").when(F.col("l_linenumber") % 3 == 1, "Month")
                  .otherwise("year").alias("plan_interval"), (F.col("l_linenumber") % 2).alias("interval_count"))
    return p.withColumn("mrr", SU.normalise_mrr(p, "amount", "plan_interval", "interval_count", "quantity"))


@paired("k80_normalise_mrr", _PLAN_SQL + f"""
SELECT l_orderkey, l_linenumber, plan_interval, {R4.format(x="mrr")} AS mrr FROM n
""", covers=("K80", "F-m2", "F-s2"))
def k80(spark, sf):
    return _plans(spark, sf).select("l_orderkey", "l_linenumber", "plan_interval", round_half_up("mrr", 4).alias("mrr"))


@paired("k81_apply_discount", _PLAN_SQL + f"""
, d AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN l_discount * 100 END AS sub_pct,
               CASE WHEN l_returnflag = 'N' THEN CAST(50.0 AS DOUBLE) END AS sub_amt,
               CASE WHEN l_linestatus = 'F' THEN CAST(5.0 AS DOUBLE) END AS cust_pct, CAST(10.0 AS DOUBLE) AS cust_amt FROM n)
SELECT l_orderkey, l_linenumber, COALESCE(sub_pct, cust_pct) AS eff_percent_off, COALESCE(sub_amt, cust_amt) AS eff_amount_off,
  {R4.format(x='''CASE WHEN COALESCE(sub_pct, cust_pct) IS NOT NULL THEN mrr * (1 - COALESCE(sub_pct, cust_pct) / 100.0)
                    WHEN mrr IS NULL THEN NULL ELSE greatest(mrr - COALESCE(sub_amt, cust_amt, 0.0), 0.0) END''')} AS mrr_discounted
FROM d
""", covers=("K81", "M1", "F-m4"))
def k81(spark, sf):
    p = _plans(spark, sf)
    p = p.select("*", F.when(F.col("l_returnflag") == "A", F.col("l_discount") * 100).alias("sub_pct"),
                 F.when(F.col("l_returnflag") == "N", F.lit(50.0)).alias("sub_amt"),
                 F.when(F.col("l_linestatus") == "F", F.lit(5.0)).alias("cust_pct"), F.lit(10.0).alias("cust_amt"))
    d = SU.apply_discount(p, "mrr", "sub_pct", "sub_amt", "cust_pct", "cust_amt")
    return d.select("l_orderkey", "l_linenumber", "eff_percent_off", "eff_amount_off",
                    round_half_up("mrr_discounted", 4).alias("mrr_discounted"))


_MONTHLY_SQL = """
WITH cm AS (SELECT o_custkey AS customer_id, CASE WHEN o_orderkey % 3 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
                   CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS mrr FROM orders GROUP BY 1, 2, 3)"""
_KEYS = ["customer_id", "currency"]


def _monthly(spark, sf):
    o = load(spark, sf, "orders")
    return o.groupBy(F.col("o_custkey").alias("customer_id"), F.when(F.col("o_orderkey") % 3 == 0, "USD").otherwise("EUR").alias("currency"),
                     F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(F.sum("o_totalprice").alias("mrr"))


@paired("k82_fx_convert", f"""
WITH r AS (SELECT CAST(o_orderdate AS DATE) AS rate_date, 1 + (COUNT(*) % 10) / 100.0 AS rate FROM orders GROUP BY 1),
lr AS (SELECT CAST(date_trunc('month', rate_date) AS DATE) AS month, arg_max(rate, rate_date) AS month_rate FROM r GROUP BY 1),
m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CASE o_orderstatus WHEN 'F' THEN 'USD' WHEN 'P' THEN 'usd' ELSE 'EUR' END AS currency,
             SUM(o_totalprice) AS amount FROM orders GROUP BY 1, 2)
SELECT m.month, m.currency, {R2.format(x="m.amount")} AS amount, lr.month_rate,
  {R2.format(x="CASE WHEN m.currency IN ('USD', 'usd') THEN m.amount / lr.month_rate ELSE m.amount END")} AS amount_converted
FROM m LEFT JOIN lr USING (month)
""", covers=("K82", "O3", "W18"))
def k82(spark, sf):
    o = load(spark, sf, "orders")
    rates = o.groupBy(F.to_date("o_orderdate").alias("rate_date")).agg(
        (1 + (F.count("*") % 10) / 100.0).alias("rate"))
    m = o.groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"),
                  F.when(F.col("o_orderstatus") == "F", "USD").when(F.col("o_orderstatus") == "P", "usd").otherwise("EUR").alias("currency")).agg(
        F.sum("o_totalprice").alias("amount"))
    out = SU.fx_convert(m, rates, "month", "currency", "amount", "rate_date", "rate")
    return out.select("month", "currency", round_half_up("amount", 2).alias("amount"), "month_rate",
                      round_half_up("amount_converted", 2).alias("amount_converted"))


_DENSE_SQL = _MONTHLY_SQL + f"""
, f AS (SELECT customer_id, currency, MIN(month) AS m0 FROM cm GROUP BY 1, 2),
sp AS (SELECT customer_id, currency, CAST(unnest(generate_series(m0, DATE '{AS_OF}', INTERVAL 1 MONTH)) AS DATE) AS month FROM f),
dense AS (SELECT sp.customer_id, sp.currency, sp.month, COALESCE(cm.mrr, 0.0) AS mrr FROM sp LEFT JOIN cm USING (customer_id, currency, month))"""


@paired("k83_dense_months", _DENSE_SQL + f"""
SELECT customer_id, currency, month, {R2.format(x="mrr")} AS mrr FROM dense
""", covers=("K83", "K91", "K118"))
def k83(spark, sf):
    d = SU.dense_months(_monthly(spark, sf), _KEYS, "month", "mrr", AS_OF)
    return d.select(*_KEYS, "month", round_half_up("mrr", 2).alias("mrr"))


# from the definition: this month's row beside the row of the month before, and the first month with revenue
@paired("k84_mrr_movements", _DENSE_SQL + f"""
, pair AS (SELECT d.customer_id, d.currency, d.month, d.mrr AS cur, COALESCE(b.mrr, 0.0) AS bef,
                  EXISTS (SELECT 1 FROM cm e WHERE e.customer_id = d.customer_id AND e.currency = d.currency AND e.month < d.month AND e.mrr > 0) AS ever_before
           FROM dense d LEFT JOIN cm b ON b.customer_id = d.customer_id AND b.currency = d.currency AND b.month = CAST(d.month - INTERVAL 1 MONTH AS DATE))
SELECT customer_id, currency, month, {R2.format(x="cur")} AS mrr, {R2.format(x="bef")} AS prev_mrr, ever_before,
  CASE WHEN least(cur, bef) > 0 THEN CASE sign(cur - bef) WHEN 1 THEN 'expansion' WHEN 0 THEN 'retained' ELSE 'contraction' END
       WHEN bef > 0 THEN 'churned' WHEN ever_before THEN 'reactivation' ELSE 'new' END AS mrr_type,
  {R2.format(x="CASE WHEN cur = bef THEN cur ELSE cur - bef END")} AS mrr_delta
FROM pair WHERE cur + bef > 0
""", covers=("K84", "W5", "W12"))
def k84(spark, sf):
    d = SU.dense_months(_monthly(spark, sf), _KEYS, "month", "mrr", AS_OF)
    m = SU.mrr_movements(d, _KEYS, "month", "mrr")
    return m.select(*_KEYS, "month", round_half_up("mrr", 2).alias("mrr"), round_half_up("prev_mrr", 2).alias("prev_mrr"),
                    "ever_before", "mrr_type", round_half_up("mrr_delta", 2).alias("mrr_delta"))


_WIN_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders),
f AS (SELECT o_custkey, MIN(d) AS fd FROM o GROUP BY 1),
c AS (SELECT o.*, CAST(date_trunc('month', f.fd) AS DATE) AS cohort_month, date_diff('month', f.fd, o.d) + 1 AS month_rank
      FROM o JOIN f USING (o_custkey)),
size AS (SELECT cohort_month, COUNT(DISTINCT o_custkey) AS cohort_size FROM c GROUP BY 1),
win AS (SELECT c.cohort_month, w.window_months, SUM(c.o_totalprice) AS cumulative_revenue
        FROM c CROSS JOIN (SELECT unnest(range(1, 13)) AS window_months) w WHERE c.month_rank <= w.window_months GROUP BY 1, 2
        UNION ALL SELECT cohort_month, NULL, SUM(o_totalprice) FROM c GROUP BY 1),
wl AS (SELECT win.*, size.cohort_size, win.cumulative_revenue / NULLIF(size.cohort_size, 0) AS ltv FROM win JOIN size USING (cohort_month))"""


def _windows(spark, sf):
    o = load(spark, sf, "orders")
    c = monthly_cohort_orders(o, "o_custkey", "o_orderdate", "o_orderkey")
    return SU.revenue_windows(c, "cohort_month", "month_rank", "o_totalprice", "o_custkey")


@paired("k85_revenue_windows", _WIN_SQL + f"""
SELECT cohort_month, CAST(window_months AS INTEGER) AS window_months, {R2.format(x="cumulative_revenue")} AS cumulative_revenue,
       cohort_size, {R2.format(x="ltv")} AS ltv FROM wl
""", covers=("K85", "J17", "J13"))
def k85(spark, sf):
    w = _windows(spark, sf)
    return w.select("cohort_month", "window_months", round_half_up("cumulative_revenue", 2).alias("cumulative_revenue"),
                    "cohort_size", round_half_up("ltv", 2).alias("ltv"))


@paired("k86_project_revenue", _WIN_SQL + f"""
, el AS (SELECT * FROM wl WHERE date_diff('month', cohort_month, DATE '{AS_OF}') >= window_months
                           AND date_diff('month', cohort_month, DATE '{AS_OF}') <= 2 * window_months),
g AS (SELECT window_months, SUM(cumulative_revenue) AS rev, SUM(cohort_size) AS sz FROM el GROUP BY 1)
SELECT CAST(window_months AS INTEGER) AS future_month, {R2.format(x="CASE WHEN sz = 0 THEN 0.0 ELSE rev / sz END")} AS projected_ltv FROM g
""", covers=("K86", "F-m3", "M3", "M17"))
def k86(spark, sf):
    p = SU.project_revenue(_windows(spark, sf), "cohort_month", AS_OF)
    return p.select("future_month", round_half_up("projected_ltv", 2).alias("projected_ltv"))


# Fixed values of the stand-in: plan categories by part type list, service categories by name prefix.
PLAN_LISTS = [(["STANDARD", "PROMO"], "subscription", True), (["LARGE"], "one-off", False)]
SERVICE_PREFIXES = [("small", "small service", True), ("red", "red service", False)]


@paired("k87_plan_category", """
SELECT p_partkey,
  CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 'subscription' WHEN p_type IN ('LARGE') THEN 'one-off'
       WHEN starts_with(p_type, 'small') THEN 'small service' WHEN starts_with(p_type, 'red') THEN 'red service' ELSE 'other' END AS plan_category,
  CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN true WHEN p_type IN ('LARGE') THEN false
       WHEN starts_with(p_type, 'small') THEN true WHEN starts_with(p_type, 'red') THEN false ELSE false END AS plan_recurring,
  CASE WHEN p_name IN ('STANDARD', 'PROMO') THEN 'subscription' WHEN p_name IN ('LARGE') THEN 'one-off'
       WHEN starts_with(p_name, 'small') THEN 'small service' WHEN starts_with(p_name, 'red') THEN 'red service' ELSE 'other' END AS service_category,
  CASE WHEN p_name IN ('STANDARD', 'PROMO') THEN true WHEN p_name IN ('LARGE') THEN false
       WHEN starts_with(p_name, 'small') THEN true WHEN starts_with(p_name, 'red') THEN false ELSE false END AS service_recurring
FROM part
""", covers=("K87", "P8", "P9"))
def k87(spark, sf):
    p = load(spark, sf, "part")
    pc, pr = SU.classify("p_type", PLAN_LISTS, SERVICE_PREFIXES)
    sc, sr = SU.classify("p_name", PLAN_LISTS, SERVICE_PREFIXES)
    return p.select("p_partkey", pc.alias("plan_category"), pr.alias("plan_recurring"),
                    sc.alias("service_category"), sr.alias("service_recurring"))


@paired("k118_entity_periods", """
WITH cm AS (SELECT o_custkey AS customer_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS orders
            FROM orders GROUP BY 1, 2),
f AS (SELECT customer_id, MIN(month) AS m0 FROM cm GROUP BY 1),
sp AS (SELECT customer_id, CAST(unnest(generate_series(m0, DATE '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS month FROM f)
SELECT sp.customer_id, sp.month, COALESCE(cm.orders, 0) AS orders FROM sp LEFT JOIN cm USING (customer_id, month)
""", covers=("K118", "K83"))
def k118(spark, sf):
    o = load(spark, sf, "orders")
    cm = o.groupBy(F.col("o_custkey").alias("customer_id"),
                   F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")).agg(F.count("*").alias("orders"))
    d = SU.dense_months(cm.withColumn("orders", F.col("orders").cast("double")), "customer_id", "month", "orders", AS_OF)
    return d.withColumn("orders", F.col("orders").cast("long"))


@paired("k119_subscription_changes", """
WITH h AS (SELECT user_id, ts, event_id, CASE WHEN value > 250 THEN 'premium' ELSE 'basic' END AS plan FROM events),
l AS (SELECT *, LAG(plan) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_plan FROM h)
SELECT user_id, ts AS changed_at, event_id, previous_plan, plan FROM l WHERE previous_plan IS DISTINCT FROM plan
""", covers=("K119", "K100", "W5"))
def k119(spark, sf):
    from growthframe.operators.state import status_changes
    e = load(spark, sf, "events").withColumn("plan", F.when(F.col("value") > 250, "premium").otherwise("basic"))
    c = status_changes(e, ["user_id"], ["ts", "event_id"], "plan")
    return c.select("user_id", F.col("ts").alias("changed_at"), "event_id", F.col("previous_status").alias("previous_plan"),
                    "plan")


@paired("k120_smoothed_mrr", f"""
WITH m AS (SELECT o_orderpriority AS plan, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  SUM(o_totalprice) AS gross, SUM(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0 END) AS net
           FROM orders GROUP BY 1, 2)
SELECT plan, month, {R2.format(x="gross")} AS gross, {R2.format(x="net")} AS net,
  {R2.format(x="AVG(net) OVER (PARTITION BY plan ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)")} AS smoothed_net
FROM m
""", covers=("K120", "W11"))
def k120(spark, sf):
    o = load(spark, sf, "orders")
    m = o.groupBy(F.col("o_orderpriority").alias("plan"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("month")) \
        .agg(F.sum("o_totalprice").alias("gross"),
             F.sum(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).otherwise(0.0)).alias("net"))
    s = SU.smoothed_mrr(m, "plan", "month", "gross", "net")
    return s.select("plan", "month", round_half_up("gross", 2).alias("gross"), round_half_up("net", 2).alias("net"),
                    round_half_up("smoothed_net", 2).alias("smoothed_net"))
