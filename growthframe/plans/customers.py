"""Paired queries for customer value, status and retention.

Stand-ins: customer = ``o_custkey``, store = ``o_orderpriority``, order amount =
``o_totalprice``; marketing spend = ``l_extendedprice * l_discount`` by ship month; account
creation = signup event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.functions.semantics import ratio_capped, round_half_up, safe_divide
from growthframe.operators import customers as CU
from growthframe.operators.calendar import spine_from_bounds
from growthframe.operators.common import with_group_agg
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

R2 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"
R4 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 4) AS DOUBLE)"
R6 = "CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)"


def orders(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("store"), F.col("o_orderstatus").alias("status"))


O_SQL = """WITH o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS created_at,
  CAST(o_orderdate AS DATE) AS d, o_totalprice AS amount, o_orderpriority AS store, o_orderstatus AS status FROM orders)"""

K44_CTE = O_SQL + """, f AS (SELECT customer_id, MIN((d, order_id)) AS fo FROM o GROUP BY 1),
c AS (SELECT o.*, CAST(date_trunc('month', f.fo[1]) AS DATE) AS cohort_month,
             CAST(date_diff('month', f.fo[1], o.d) + 1 AS BIGINT) AS month_rank, o.order_id = f.fo[2] AS is_first_order
      FROM o JOIN f USING (customer_id))"""


@paired("k44_monthly_cohort_orders", K44_CTE + """
SELECT order_id, customer_id, cohort_month, month_rank, is_first_order FROM c
""", covers=("K44", "M4"))
def k44(spark, sf):
    c = CU.monthly_cohort_orders(orders(spark, sf), "customer_id", "created_at", "order_id")
    return c.select("order_id", "customer_id", "cohort_month", "month_rank", "is_first_order")


@paired("k45_cohort_at", K44_CTE + f"""
, s AS (SELECT *, COUNT(DISTINCT customer_id) OVER (PARTITION BY cohort_month) AS cohort_size FROM c),
g AS (SELECT cohort_month, SUM(CASE WHEN month_rank <= 4 THEN amount ELSE 0 END) AS v, MAX(cohort_size) AS cohort_size
      FROM s GROUP BY 1)
SELECT cohort_month, cohort_size,
  {R2.format(x="CASE WHEN date_diff('month', cohort_month, DATE '2001-08-01') >= 3 THEN v END")} AS value_t3,
  {R4.format(x="CASE WHEN date_diff('month', cohort_month, DATE '2001-08-01') >= 3 THEN v END / NULLIF(cohort_size, 0)")} AS per_customer_t3
FROM g
""", covers=("K45", "W14", "A6"))
def k45(spark, sf):
    c = CU.monthly_cohort_orders(orders(spark, sf), "customer_id", "created_at", "order_id")
    c = with_group_agg(c, ["cohort_month"], F.countDistinct("customer_id").alias("cohort_size"))
    return CU.cohort_at(c, "cohort_month", "month_rank", "amount", 3, "2001-08-01", "cohort_size")


def _grain_sql(grain: str) -> str:
    between = {"day": "date_diff('day', {0}, {1})", "week": "(CAST(date_trunc('week', {1}) AS DATE) - CAST(date_trunc('week', {0}) AS DATE)) // 7", "month": "date_diff('month', {0}, {1})"}[grain]
    return O_SQL + f"""
, f AS (SELECT customer_id, MIN(created_at) AS first_at FROM o GROUP BY 1),
c AS (SELECT o.*, CAST(date_trunc('{grain}', first_at) AS DATE) AS cohort, {between.format("first_at", "created_at")} AS t FROM o JOIN f USING (customer_id)),
age AS (SELECT cohort, COUNT(DISTINCT customer_id) AS cohort_size, {between.format("cohort", "DATE '2001-08-01'")} AS age FROM c GROUP BY 1)"""


def _by_grain(grain: str, t: int):
    """Cohort value up to period ``t``, per customer, churn and NRR at ``t``, by day, week or month."""
    sql = _grain_sql(grain) + f"""
SELECT age.cohort, age.cohort_size, {R2.format(x=f"CASE WHEN age >= {t} THEN SUM(CASE WHEN t <= {t} THEN amount ELSE 0 END) END")} AS value_t{t},
  {R4.format(x=f"CASE WHEN age >= {t} THEN SUM(CASE WHEN t <= {t} THEN amount ELSE 0 END) / age.cohort_size END")} AS per_customer_t{t},
  CASE WHEN age >= {t} THEN COUNT(DISTINCT CASE WHEN t = {t} THEN customer_id END) END AS active,
  {R4.format(x=f"CASE WHEN age >= {t} THEN 1 - COUNT(DISTINCT CASE WHEN t = {t} THEN customer_id END) / age.cohort_size END")} AS churn_rate,
  {R4.format(x=f"CASE WHEN age >= {t} THEN SUM(CASE WHEN t = {t} THEN amount ELSE 0 END) / NULLIF(SUM(CASE WHEN t = 0 THEN amount ELSE 0 END), 0) END")} AS nrr
FROM c JOIN age USING (cohort) GROUP BY age.cohort, age.cohort_size, age.age
"""

    @paired(f"k45_cohort_{grain}", sql, covers=("K45", "A6"))
    def query(spark, sf):
        c = CU.cohort_orders(orders(spark, sf), "customer_id", "created_at", grain)
        kept = CU.cohort_retention(c, "cohort", "period_rank", "customer_id", "amount", t, "2001-08-01", grain)
        c = with_group_agg(c, ["cohort"], F.countDistinct("customer_id").alias("cohort_size"))
        return CU.cohort_at(c, "cohort", "period_rank", "amount", t, "2001-08-01", "cohort_size", grain=grain).join(kept.drop("cohort_size"), "cohort")


for _grain, _t in (("day", 30), ("week", 8), ("month", 3)):
    _by_grain(_grain, _t)


@paired("k46_metric_layer", K44_CTE + f"""
, m AS (SELECT CAST(date_trunc('month', d) AS DATE) AS month, SUM(amount) AS revenue, COUNT(*) AS n_orders,
               CAST(count_if(is_first_order) AS BIGINT) AS new_customers, COUNT(DISTINCT customer_id) AS customers FROM c GROUP BY 1),
sp AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, SUM(l_extendedprice * l_discount) AS spend
       FROM lineitem GROUP BY 1)
SELECT m.month, {R2.format(x="m.revenue")} AS revenue, m.n_orders, m.new_customers, m.customers, {R2.format(x="sp.spend")} AS spend,
  {R4.format(x="sp.spend / NULLIF(m.new_customers, 0)")} AS cac,
  {R4.format(x="m.revenue / NULLIF(m.n_orders, 0)")} AS aov,
  {R4.format(x="m.revenue / NULLIF(sp.spend, 0)")} AS roas,
  {R4.format(x="least(m.new_customers / NULLIF(m.customers, 0), 1.0)")} AS new_customer_share
FROM m JOIN sp USING (month)
""", covers=("K46", "X4", "A6", "F-m2"))
def k46(spark, sf):
    c = CU.monthly_cohort_orders(orders(spark, sf), "customer_id", "created_at", "order_id") \
        .withColumn("month", F.to_date(F.date_trunc("month", "created_at")))
    li = load(spark, sf, "lineitem")
    sp = li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("spend"))
    base = CU.metric_layer(c, ["month"], {
        "revenue": F.sum("amount"), "n_orders": F.count("*"), "new_customers": F.count_if("is_first_order"),
        "customers": F.countDistinct("customer_id")}, {})
    j = base.join(sp, "month")
    return j.select("month", round_half_up("revenue", 2).alias("revenue"), "n_orders", "new_customers", "customers",
                    round_half_up("spend", 2).alias("spend"),
                    round_half_up(safe_divide("spend", "new_customers"), 4).alias("cac"),
                    round_half_up(safe_divide("revenue", "n_orders"), 4).alias("aov"),
                    round_half_up(safe_divide("revenue", "spend"), 4).alias("roas"),
                    round_half_up(ratio_capped("new_customers", "customers"), 4)
                    .alias("new_customer_share"))


@paired("k47_running_pace", O_SQL + f"""
, g AS (SELECT SUM(CASE WHEN d >= DATE '2000-06-01' AND d <= DATE '2000-06-15' THEN amount ELSE 0 END) AS mtd,
               SUM(CASE WHEN d >= DATE '2000-05-01' AND d < DATE '2000-06-01' AND day(d) <= 15 THEN amount ELSE 0 END) AS prev
        FROM o)
SELECT {R2.format(x="mtd")} AS month_to_date, {R2.format(x="prev")} AS previous_month_same_days,
  {R4.format(x="(mtd - prev) / NULLIF(prev, 0)")} AS growth, {R2.format(x="mtd / 15 * 30")} AS projection_month_end
FROM g
""", covers=("K47", "F-d6", "F-d7"))
def k47(spark, sf):
    return CU.running_pace(orders(spark, sf), "created_at", "amount", "2000-06-15")


_LTV_SQL = O_SQL + f"""
, c AS (SELECT customer_id, {R2.format(x="SUM(amount)")} AS customer_value, COUNT(DISTINCT order_id) AS orders FROM o GROUP BY 1),
c2 AS (SELECT *, {R6.format(x="customer_value / NULLIF(orders, 0)")} AS aov FROM c),
g AS (SELECT *, NTILE(4) OVER (ORDER BY customer_value DESC, customer_id) AS ltv_group FROM c2 WHERE customer_value > 0)"""


def _ltv(spark, sf, distributed=None):
    o = orders(spark, sf)
    c = o.groupBy("customer_id").agg(round_half_up(F.sum("amount"), 2).alias("customer_value"),
                                     F.countDistinct("order_id").alias("orders"))
    c = c.withColumn("aov", round_half_up(safe_divide("customer_value", "orders"), 6))
    from growthframe.operators.selection import exact_ntile
    return exact_ntile(c.filter(F.col("customer_value") > 0), 4, [-F.col("customer_value"), F.col("customer_id")],
                       name="ltv_group", distributed=distributed)


@paired("k48_ltv_groups", _LTV_SQL + """
SELECT customer_id, customer_value, orders, aov, CAST(ltv_group AS INTEGER) AS ltv_group FROM g
""", covers=("K48", "W4", "W2"))
def k48(spark, sf):
    return _ltv(spark, sf).select("customer_id", "customer_value", "orders", "aov", "ltv_group")


@paired("k48_ltv_groups_by_selection", _LTV_SQL + """
SELECT customer_id, customer_value, CAST(ltv_group AS INTEGER) AS ltv_group FROM g
""", covers=("K48", "W4"))
def k48_selection(spark, sf):
    return _ltv(spark, sf, distributed=True).select("customer_id", "customer_value", "ltv_group")


@paired("k49_ltv_subgroups_by_selection", _LTV_SQL + """
SELECT customer_id, CAST(NTILE(4) OVER (PARTITION BY ltv_group ORDER BY aov DESC, customer_id) AS INTEGER) AS aov_subgroup,
  CAST(NTILE(4) OVER (PARTITION BY ltv_group ORDER BY orders DESC, customer_id) AS INTEGER) AS orders_subgroup
FROM g
""", covers=("K49", "W4"))
def k49_selection(spark, sf):
    return CU.ltv_subgroups(_ltv(spark, sf), "customer_id", distributed=True).select("customer_id", "aov_subgroup", "orders_subgroup")


@paired("k49_ltv_subgroups", _LTV_SQL + """
SELECT customer_id, CAST(ltv_group AS INTEGER) AS ltv_group,
  CAST(NTILE(4) OVER (PARTITION BY ltv_group ORDER BY aov DESC, customer_id) AS INTEGER) AS aov_subgroup,
  CAST(NTILE(4) OVER (PARTITION BY ltv_group ORDER BY orders DESC, customer_id) AS INTEGER) AS orders_subgroup
FROM g
""", covers=("K49", "W4"))
def k49(spark, sf):
    return CU.ltv_subgroups(_ltv(spark, sf), "customer_id").select("customer_id", "ltv_group", "aov_subgroup",
                                                                    "orders_subgroup")


CUTS = [(0.0, "bronze"), (500000.0, "silver"), (1000000.0, "gold"), (2000000.0, "platinum")]


def _cut_sql(x):
    return (f"CASE WHEN {x} >= 2000000.0 THEN 'platinum' WHEN {x} >= 1000000.0 THEN 'gold' "
            f"WHEN {x} >= 500000.0 THEN 'silver' WHEN {x} >= 0.0 THEN 'bronze' END")


@paired("k50_group_transitions", O_SQL + f"""
, r AS (SELECT *, SUM(amount) OVER (PARTITION BY customer_id ORDER BY created_at, order_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rv FROM o),
p AS (SELECT *, LAG(rv) OVER (PARTITION BY customer_id ORDER BY created_at, order_id) AS pv FROM r),
g AS (SELECT *, {_cut_sql('rv')} AS value_group, {_cut_sql('pv')} AS previous_group FROM p)
SELECT order_id, customer_id, {R2.format(x="rv")} AS running_value, {R2.format(x="pv")} AS previous_value, value_group, previous_group,
  CASE WHEN pv < rv AND previous_group != value_group THEN previous_group || ' -> ' || value_group END AS transition
FROM g
""", covers=("K50", "W5", "W11"))
def k50(spark, sf):
    g = CU.group_transitions(orders(spark, sf), "customer_id", "created_at", "order_id", "amount", CUTS)
    return g.select("order_id", "customer_id", round_half_up("running_value", 2).alias("running_value"),
                    round_half_up("previous_value", 2).alias("previous_value"), "value_group", "previous_group",
                    "transition")


@paired("k54_customer_status", O_SQL + """
, p AS (SELECT *, LAG(d) OVER (PARTITION BY customer_id ORDER BY created_at, order_id) AS previous_order_date FROM o)
SELECT order_id, customer_id, previous_order_date,
  CASE WHEN previous_order_date IS NULL THEN 'new'
       WHEN previous_order_date < CAST(d - INTERVAL 12 MONTH AS DATE) THEN 'reactivated' ELSE 'returning' END AS customer_status
FROM p WHERE d BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
""", covers=("K54", "W5", "M18"))
def k54(spark, sf):
    s = CU.customer_status(orders(spark, sf), "customer_id", "created_at", "order_id", "1998-01-01", "1998-12-31")
    return s.select("order_id", "customer_id", "previous_order_date", "customer_status")


@paired("k55_new_vs_returning_by_day", O_SQL + """
, day AS (SELECT customer_id, d AS day, COUNT(*) AS orders FROM o GROUP BY 1, 2),
w AS (SELECT *, COALESCE(SUM(orders) OVER (PARTITION BY customer_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_orders,
             date_diff('day', LAG(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS days_since_previous FROM day)
SELECT customer_id, day, orders, CAST(prior_orders AS BIGINT) AS prior_orders, days_since_previous,
  CASE WHEN prior_orders = 0 THEN 'new' WHEN days_since_previous <= 365 THEN 'recent returning' ELSE 'old returning' END AS customer_type
FROM w
""", covers=("K55", "J6", "W12"))
def k55(spark, sf):
    x = CU.new_vs_returning_by_day(orders(spark, sf), "customer_id", "created_at")
    return x.select("customer_id", "day", "orders", F.col("prior_orders").cast("long").alias("prior_orders"),
                    F.col("days_since_previous").cast("long").alias("days_since_previous"), "customer_type")


@paired("k56_lapsed_customers", O_SQL + """
, days AS (SELECT DISTINCT customer_id AS c, d AS p FROM o),
b AS (SELECT MIN(p) AS lo, MAX(p) AS hi FROM days),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
last AS (SELECT s.d, dd.c, MAX(dd.p) AS last_p FROM spine s JOIN days dd ON dd.p <= s.d GROUP BY 1, 2)
SELECT s.d, CAST(COUNT(CASE WHEN l.last_p + INTERVAL 12 MONTH < s.d THEN 1 END) AS BIGINT) AS lapsed_customers
FROM spine s LEFT JOIN last l USING (d) GROUP BY s.d
""", covers=("K56", "J6", "K91", "S18"))
def k56(spark, sf):
    o = orders(spark, sf)
    b = o.agg(F.to_date(F.min("created_at")).alias("lo"), F.to_date(F.max("created_at")).alias("hi"))
    spine = spine_from_bounds(b, "lo", "hi")
    return CU.lapsed_customers(o, "customer_id", "created_at", spine, 12).select(
        "d", F.col("lapsed_customers").cast("long").alias("lapsed_customers"))


@paired("k57_retention_by_orders", O_SQL + """
, x AS (SELECT *, CASE WHEN d BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' THEN 'current'
                       WHEN d BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' THEN 'previous' END AS period FROM o),
per AS (SELECT period, customer_id, COUNT(DISTINCT order_id) AS n_orders FROM x WHERE period IS NOT NULL GROUP BY 1, 2),
dist AS (SELECT period, n_orders, COUNT(*) AS customers FROM per GROUP BY 1, 2)
SELECT COALESCE(c.n_orders, p.n_orders) AS n_orders, COALESCE(c.customers, 0) AS customers_current,
       COALESCE(p.customers, 0) AS customers_previous
FROM (SELECT * FROM dist WHERE period = 'current') c FULL JOIN (SELECT * FROM dist WHERE period = 'previous') p
  ON c.n_orders = p.n_orders
""", covers=("K57", "A15"))
def k57(spark, sf):
    return CU.retention_by_orders(orders(spark, sf), "customer_id", "created_at", "order_id",
                                  ("2000-01-01", "2000-12-31"), ("1999-01-01", "1999-12-31"))


@paired("k58_time_between_orders", O_SQL + """
, days AS (SELECT DISTINCT customer_id, d AS day FROM o)
SELECT customer_id, day, date_diff('day', LAG(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS days_since_previous
FROM days
""", covers=("K58", "F-d4"))
def k58(spark, sf):
    return CU.time_between_orders(orders(spark, sf), "customer_id", "created_at", "order_id").select(
        "customer_id", "day", F.col("days_since_previous").cast("long").alias("days_since_previous"))


@paired("k58_average_time_between_orders", O_SQL + """
, days AS (SELECT DISTINCT customer_id, d AS day FROM o),
g AS (SELECT date_diff('day', LAG(day) OVER (PARTITION BY customer_id ORDER BY day), day) AS gap FROM days)
SELECT CAST(ROUND(CAST(AVG(gap) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_days_between_orders, COUNT(gap) AS gaps FROM g
""", covers=("K58", "A1"))
def k58b(spark, sf):
    g = CU.time_between_orders(orders(spark, sf), "customer_id", "created_at", "order_id")
    return g.agg(round_half_up(F.avg("days_since_previous"), 2).alias("avg_days_between_orders"),
                 F.count("days_since_previous").alias("gaps"))


@paired("k59_new_accounts", """
WITH s AS (SELECT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup'),
b AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
per AS (SELECT d, COUNT(*) AS accounts FROM s GROUP BY 1)
SELECT spine.d, COALESCE(a.accounts, 0) AS accounts, COALESCE(p.accounts, 0) AS accounts_previous
FROM spine LEFT JOIN per a ON a.d = spine.d LEFT JOIN per p ON p.d = spine.d - INTERVAL 7 DAY
""", covers=("K59", "K91", "J2"))
def k59(spark, sf):
    e = load(spark, sf, "events")
    spine = spine_from_bounds(e.agg(F.to_date(F.min("ts")).alias("lo"), F.to_date(F.max("ts")).alias("hi")), "lo", "hi")
    return CU.new_accounts(e.filter(F.col("event_type") == "signup"), "ts", spine, 7)


@paired("k60_accounts_growth", f"""
WITH s AS (SELECT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'signup'),
g AS (SELECT CAST(count_if(d BETWEEN DATE '2024-01-16' AND DATE '2024-01-30') AS BIGINT) AS current,
             CAST(count_if(d BETWEEN DATE '2024-01-01' AND DATE '2024-01-15') AS BIGINT) AS previous FROM s)
SELECT current, previous, {R4.format(x="current * 15.0 / NULLIF(previous * 15.0, 0) - 1")} AS growth_rate FROM g
""", covers=("K60",))
def k60(spark, sf):
    e = load(spark, sf, "events").filter(F.col("event_type") == "signup")
    return CU.accounts_growth(e, "ts", ("2024-01-16", "2024-01-30"), ("2024-01-01", "2024-01-15"))


@paired("k61_win_rate", K44_CTE + """
, a AS (SELECT store, d, COUNT(*) AS creations FROM c WHERE status = 'O' GROUP BY 1, 2),
b AS (SELECT store, d, COUNT(*) AS first_orders FROM c WHERE is_first_order GROUP BY 1, 2)
SELECT COALESCE(a.store, b.store) AS store, COALESCE(a.d, b.d) AS d, COALESCE(a.creations, 0) AS creations,
       COALESCE(b.first_orders, 0) AS first_orders,
       CASE WHEN b.first_orders > 0 THEN CASE WHEN COALESCE(a.creations, 0) >= b.first_orders THEN 1.0::DOUBLE
       ELSE COALESCE(a.creations, 0) / b.first_orders END END AS win_rate
FROM a FULL JOIN b ON a.store = b.store AND a.d = b.d
""", covers=("K61", "F-m4"))
def k61(spark, sf):
    c = CU.monthly_cohort_orders(orders(spark, sf), "customer_id", "created_at", "order_id")
    return CU.win_rate(c.filter(F.col("status") == "O"), c.filter("is_first_order"), ["store"], "created_at") \
        .select("store", "d", "creations", "first_orders", "win_rate")


@paired("k62_store_new_customers", O_SQL + """
, f AS (SELECT customer_id, store, MIN(d) AS first_day FROM o GROUP BY 1, 2)
SELECT store, first_day AS d, COUNT(*) AS new_customers FROM f GROUP BY 1, 2
""", covers=("K62",))
def k62(spark, sf):
    per_store, _ = CU.store_new_customers(orders(spark, sf), "customer_id", "store", "created_at")
    return per_store


@paired("k62_omni_customers_cumulative", O_SQL + """
, f AS (SELECT customer_id, store, MIN(d) AS first_day FROM o GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY first_day, store) AS k FROM f),
s AS (SELECT first_day AS d, COUNT(*) AS n FROM r WHERE k = 2 GROUP BY 1)
SELECT d, CAST(SUM(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS omni_customers_cumulative FROM s
""", covers=("K62", "J6", "W11"))
def k62b(spark, sf):
    _, omni = CU.store_new_customers(orders(spark, sf), "customer_id", "store", "created_at")
    return omni


@paired("k63_customer_migration", O_SQL + """
, x AS (SELECT * FROM o WHERE d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' OR d BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'),
g AS (SELECT customer_id,
        list_sort(list_distinct(list(CASE WHEN d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' THEN store END))) AS s1,
        list_sort(list_distinct(list(CASE WHEN d BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN store END))) AS s2
      FROM x GROUP BY 1)
SELECT customer_id, array_to_string(s1, ',') AS stores_p1, array_to_string(s2, ',') AS stores_p2,
       len(s1) = 1 AS only_one_store_p1, len(s2) = 1 AS only_one_store_p2, s1 != s2 AS migrated
FROM g
""", covers=("K63", "A9", "F-a3"))
def k63(spark, sf):
    return CU.customer_migration(orders(spark, sf), "customer_id", "store", "created_at",
                                 ("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31"))


@paired("k57_retention_item_sets", """
WITH x AS (SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id, p.p_brand AS brand,
                  CASE WHEN CAST(o.o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' THEN 'current'
                       WHEN CAST(o.o_orderdate AS DATE) BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' THEN 'previous' END AS period
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
cs AS (SELECT period, customer_id, list_distinct(list(brand)) AS brand, COUNT(DISTINCT order_id) AS orders_count
       FROM x WHERE period IS NOT NULL GROUP BY 1, 2),
oc AS (SELECT period, orders_count, flatten(list(brand)) AS brand FROM cs GROUP BY 1, 2),
u AS (SELECT period, orders_count, unnest(brand) AS brand FROM oc)
SELECT period, orders_count AS n_orders, brand AS p_brand, COUNT(*) AS customers FROM u GROUP BY 1, 2, 3
""", covers=("K57", "A11", "A9"))
def k57b(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = load(spark, sf, "part").select("p_partkey", "p_brand")
    x = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return CU.retention_item_counts(x, "o_custkey", "o_orderdate", "o_orderkey", "p_brand",
                                    ("2000-01-01", "2000-12-31"), ("1999-01-01", "1999-12-31"))


# Fixed values of the stand-in: store clusters (urgent priorities form one cluster).
STORE_CLUSTERS = {"1-URGENT": "priority", "2-HIGH": "priority", "3-MEDIUM": "standard", "4-NOT SPECIFIED": "standard"}


@paired("k63_customer_migration_clusters", O_SQL + """
, x AS (SELECT customer_id, d, CASE store WHEN '1-URGENT' THEN 'priority' WHEN '2-HIGH' THEN 'priority'
                                          WHEN '3-MEDIUM' THEN 'standard' WHEN '4-NOT SPECIFIED' THEN 'standard' END AS store
        FROM o WHERE store <> '5-LOW'
          AND (d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' OR d BETWEEN DATE '1997-01-01' AND DATE '1997-12-31')),
g AS (SELECT customer_id,
        list_sort(list_distinct(list(CASE WHEN d BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' THEN store END))) AS s1,
        list_sort(list_distinct(list(CASE WHEN d BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN store END))) AS s2
      FROM x GROUP BY 1)
SELECT customer_id, array_to_string(s1, ',') AS stores_p1, array_to_string(s2, ',') AS stores_p2,
       len(s1) = 1 AS only_one_store_p1, len(s2) = 1 AS only_one_store_p2, s1 != s2 AS migrated
FROM g
""", covers=("K63",))
def k63c(spark, sf):
    return CU.customer_migration(orders(spark, sf), "customer_id", "store", "created_at",
                                 ("1996-01-01", "1996-12-31"), ("1997-01-01", "1997-12-31"),
                                 stores=list(STORE_CLUSTERS), clusters=STORE_CLUSTERS)


@paired("k46_rolling_30d_roas", f"""
WITH sp AS (SELECT CAST(l_shipdate AS DATE) AS d, SUM(l_extendedprice * l_discount) AS spend FROM lineitem GROUP BY 1),
rv AS (SELECT CAST(o_orderdate AS DATE) AS d, SUM(o_totalprice) AS revenue FROM orders GROUP BY 1),
daily AS (SELECT COALESCE(sp.d, rv.d) AS d, COALESCE(sp.spend, 0.0) AS spend, COALESCE(rv.revenue, 0.0) AS revenue
          FROM sp FULL JOIN rv ON sp.d = rv.d),
r AS (SELECT d, spend, revenue,
        SUM(spend) OVER (ORDER BY d RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS spend_30d,
        SUM(revenue) OVER (ORDER BY d RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS revenue_30d FROM daily)
SELECT d, {R2.format(x="spend_30d")} AS spend_30d, {R2.format(x="revenue_30d")} AS revenue_30d,
       {R4.format(x="revenue_30d / NULLIF(spend_30d, 0)")} AS roas_30d
FROM r
""", covers=("K46", "X4", "W11"))
def k46r(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders")
    sp = li.groupBy(F.to_date("l_shipdate").alias("d")).agg(F.sum(F.col("l_extendedprice") * F.col("l_discount"))
                                                            .alias("spend"))
    rv = o.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.sum("o_totalprice").alias("revenue"))
    daily = sp.join(rv, "d", "full").fillna(0.0, ["spend", "revenue"])
    # one row per calendar day: the rolling window runs over a table bounded by the calendar
    r = CU.rolling_window_metrics(daily, "d", ["spend", "revenue"], 30)
    return r.select("d", round_half_up("spend_30d", 2).alias("spend_30d"),
                    round_half_up("revenue_30d", 2).alias("revenue_30d"),
                    round_half_up(safe_divide("revenue_30d", "spend_30d"), 4).alias("roas_30d"))


@paired("k46_still_active_rate", f"""
WITH c AS (SELECT o_orderpriority AS store, o_custkey, MAX(CAST(o_orderdate AS DATE)) AS last_d FROM orders GROUP BY 1, 2)
SELECT store, COUNT(*) AS customers, CAST(count_if(last_d >= DATE '2001-08-01' - INTERVAL 12 MONTH) AS BIGINT) AS active_customers,
       {R4.format(x="least(count_if(last_d >= DATE '2001-08-01' - INTERVAL 12 MONTH) / COUNT(*) * 1.25, 1.0)")} AS still_active_rate_capped
FROM c GROUP BY 1
""", covers=("K46",))
def k46s(spark, sf):
    o = orders(spark, sf)
    c = o.groupBy("store", "customer_id").agg(F.to_date(F.max("created_at")).alias("last_d"))
    active = F.col("last_d") >= F.add_months(F.lit("2001-08-01").cast("date"), -12)
    base = {"customers": F.count("*"), "active_customers": F.count_if(active)}
    # stand-in target: 80 % of the customer base active; the ratio to the target is capped at 1
    derived = {"still_active_rate_capped": round_half_up(
        ratio_capped(F.col("active_customers") * 1.25, "customers"), 4)}
    return CU.metric_layer(c, ["store"], base, derived)


@paired("k59_new_accounts_by_store", """
WITH s AS (SELECT CAST(ts AS DATE) AS d, 'store ' || CAST(event_id % 3 AS VARCHAR) AS store, user_id FROM events WHERE event_type = 'signup' AND event_id % 4 > 0),
b AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) + 3 AS hi FROM events),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
per AS (SELECT d, store, COUNT(DISTINCT user_id) AS accounts FROM s GROUP BY 1, 2),
cur AS (SELECT spine.d, per.store, COALESCE(accounts, 0) AS accounts FROM spine LEFT JOIN per ON per.d = spine.d)
SELECT cur.d, cur.store, cur.accounts, p.accounts AS accounts_previous FROM cur LEFT JOIN per p ON p.d = cur.d - 7 AND p.store = cur.store
""", covers=("K59", "J3"))
def k59_store(spark, sf):
    e = load(spark, sf, "events")
    spine = spine_from_bounds(e.agg(F.to_date(F.min("ts")).alias("lo"), F.date_add(F.to_date(F.max("ts")), 3).alias("hi")), "lo", "hi")
    s = e.filter((F.col("event_type") == "signup") & (F.col("event_id") % 4 > 0)).withColumn("store", F.concat(F.lit("store "), (F.col("event_id") % 3).cast("string")))
    return CU.new_accounts_by_store(s, "ts", "store", "user_id", spine, 7)


# Stand-in goals: a tenth more than the same month of the year before; touches = order lines, paid ones have a discount of 5 % or more.
@paired("k46_payback_and_goals", K44_CTE + f"""
, m AS (SELECT CAST(date_trunc('month', d) AS DATE) AS month, SUM(amount) AS revenue, CAST(count_if(is_first_order) AS BIGINT) AS new_customers,
               SUM(CASE WHEN is_first_order THEN amount END) AS first_amount FROM c GROUP BY 1),
sp AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, SUM(l_extendedprice * l_discount) AS spend, COUNT(*) AS touches, COUNT(CASE WHEN l_discount >= 0.05 THEN 1 END) AS paid
       FROM lineitem GROUP BY 1),
j AS (SELECT m.*, sp.spend, sp.touches, sp.paid, g.revenue * 1.1 AS revenue_goal, g.new_customers * 1.1 AS new_customers_goal, gs.spend * 1.1 AS spend_goal
      FROM m JOIN sp USING (month) LEFT JOIN m g ON g.month = m.month - INTERVAL 1 YEAR LEFT JOIN sp gs ON gs.month = m.month - INTERVAL 1 YEAR),
x AS (SELECT *, spend / NULLIF(new_customers, 0) AS cac, first_amount / NULLIF(new_customers, 0) AS afp FROM j)
SELECT month, {R4.format(x="cac")} AS cac, {R4.format(x="cac / NULLIF(afp, 0)")} AS payback_purchases, {R4.format(x="100 * (paid / NULLIF(touches, 0)) / NULLIF(cac, 0)")} AS efficiency_score,
  {R4.format(x="revenue / NULLIF(revenue_goal, 0)")} AS revenue_goal_rate, {R4.format(x="new_customers / NULLIF(new_customers_goal, 0)")} AS new_customers_goal_rate,
  {R4.format(x="spend / NULLIF(spend_goal, 0)")} AS spend_goal_rate FROM x
""", covers=("K46", "X4", "F-m2"))
def k46_goals(spark, sf):
    c = CU.monthly_cohort_orders(orders(spark, sf), "customer_id", "created_at", "order_id").withColumn("month", F.to_date(F.date_trunc("month", "created_at")))
    base = CU.metric_layer(c, ["month"], {"revenue": F.sum("amount"), "new_customers": F.count_if("is_first_order"), "first_purchase_amount": F.sum(F.when(F.col("is_first_order"), F.col("amount")))}, {})
    li = load(spark, sf, "lineitem")
    sp = li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month")).agg(
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("spend"), F.count("*").alias("touches"), F.count_if(F.col("l_discount") >= 0.05).alias("paid_touches"))
    later = F.add_months("month", 12).alias("month")
    goals = base.select(later, F.lit("revenue").alias("measure"), (F.col("revenue") * 1.1).alias("goal")) \
        .union(base.select(later, F.lit("new_customers"), F.col("new_customers") * 1.1)).union(sp.select(later, F.lit("spend"), F.col("spend") * 1.1))
    x = CU.payback_and_goals(base.join(sp, "month"), goals)
    return x.select("month", *[round_half_up(n, 4).alias(n) for n in ("cac", "payback_purchases", "efficiency_score", "revenue_goal_rate", "new_customers_goal_rate", "spend_goal_rate")])
