"""Paired queries for cohorts, customers and lifetime value."""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.operators import cohorts as C
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

# Stand-ins (FIXTURES.md section 3): order = orders row, customer = o_custkey, channel from
# the order priority (1-URGENT / 2-HIGH = web, other = retail), refund = status 'P'.
WEB_PRIORITIES = ("1-URGENT", "2-HIGH")


def _orders_channel(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderpriority").isin(*WEB_PRIORITIES), "web").otherwise("retail").alias("channel"),
        (F.col("o_orderstatus") == "P").alias("is_refund"))


_COHORT_BASE_SQL = """
WITH base AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS d,
         o_totalprice AS amount,
         CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'web' ELSE 'retail' END AS channel,
         o_orderstatus = 'P' AS is_refund
  FROM orders
), firsts AS (
  SELECT *, MIN(d) OVER (PARTITION BY customer_id) AS first_d FROM base
), cohorted AS (
  SELECT *,
    CAST(date_trunc('month', first_d) AS DATE) AS first_purchase_month,
    CAST(date_trunc('year', first_d) AS DATE) AS first_purchase_calendar_year,
    CAST(date_trunc('year', CAST(first_d + INTERVAL 6 MONTH AS DATE)) AS DATE) AS first_purchase_fiscal_year,
    CAST(date_trunc('month', d) AS DATE) AS order_month,
    CAST(date_trunc('year', d) AS DATE) AS order_calendar_year,
    CAST(date_trunc('year', CAST(d + INTERVAL 6 MONTH AS DATE)) AS DATE) AS order_fiscal_year
  FROM firsts
), ranked AS (
  SELECT *,
    CAST(date_diff('month', first_purchase_month, order_month) + 1 AS BIGINT) AS order_month_rank,
    CAST(date_diff('year', first_purchase_calendar_year, order_calendar_year) + 1 AS BIGINT) AS order_calendar_year_rank,
    CAST(date_diff('year', first_purchase_fiscal_year, order_fiscal_year) + 1 AS BIGINT) AS order_fiscal_year_rank
  FROM cohorted
)"""

_KEYS = ("first_purchase_month, first_purchase_calendar_year, first_purchase_fiscal_year, order_month, "
         "order_calendar_year, order_fiscal_year, order_month_rank, order_calendar_year_rank, order_fiscal_year_rank")


@paired("k42_cohort_ranks", _COHORT_BASE_SQL + """
SELECT order_id, customer_id, first_purchase_month, first_purchase_calendar_year, first_purchase_fiscal_year,
       order_month, order_calendar_year, order_fiscal_year,
       order_month_rank, order_calendar_year_rank, order_fiscal_year_rank
FROM ranked""", covers=("K42", "F-d3", "F-d4", "F-d6", "M4", "W13"))
def k42_cohort_ranks(spark, sf_dir):
    o = _orders_channel(spark, sf_dir)
    r = C.cohort_ranks(o, "customer_id", "created_at", fiscal_shift_months=6)
    return r.select("order_id", "customer_id", *C.COHORT_KEYS)


_K43_SQL = _COHORT_BASE_SQL + f"""
, scoped AS (
  SELECT *, channel AS scope FROM ranked
  UNION ALL
  SELECT *, 'omni' AS scope FROM ranked
), cells AS (
  SELECT scope, {_KEYS},
    CAST(ROUND(CAST(SUM(CASE WHEN NOT is_refund THEN amount ELSE 0 END) - SUM(CASE WHEN is_refund THEN amount ELSE 0 END) AS DECIMAL(38,6)), 2) AS DOUBLE) AS revenue,
    COUNT(DISTINCT CASE WHEN NOT is_refund THEN order_id END) AS orders_volume,
    COUNT(DISTINCT CASE WHEN NOT is_refund THEN customer_id END) AS unique_clients_volume,
    CAST(ROUND(CAST(SUM(CASE WHEN NOT is_refund THEN amount ELSE 0 END)
          / NULLIF(COUNT(DISTINCT CASE WHEN NOT is_refund THEN order_id END), 0) AS DECIMAL(38,6)), 2) AS DOUBLE) AS aov
  FROM scoped GROUP BY ALL
), vols AS (
  SELECT *,
    CAST(SUM(unique_clients_volume) OVER (PARTITION BY scope, first_purchase_calendar_year, order_calendar_year) AS BIGINT) AS calendar_year_clients_volume,
    CAST(SUM(unique_clients_volume) OVER (PARTITION BY scope, first_purchase_month, order_month) AS BIGINT) AS month_clients_volume
  FROM cells
)
SELECT *,
  MAX(calendar_year_clients_volume) OVER (PARTITION BY scope, first_purchase_calendar_year) AS first_purchase_calendar_year_clients_volume,
  MAX(month_clients_volume) OVER (PARTITION BY scope, first_purchase_month) AS first_purchase_month_clients_volume
FROM vols"""


@paired("k43_cohort_metrics", _K43_SQL, covers=("K43", "A3", "A4", "A6", "W13", "U1"))
def k43_cohort_metrics(spark, sf_dir):
    o = _orders_channel(spark, sf_dir)
    r = C.cohort_ranks(o, "customer_id", "created_at", fiscal_shift_months=6)
    m = C.cohort_metrics(r, "channel", "amount", "order_id", "customer_id", is_refund="is_refund")
    return m.select("scope", *C.COHORT_KEYS, "revenue", "orders_volume", "unique_clients_volume", "aov",
                    F.col("calendar_year_clients_volume").cast("long").alias("calendar_year_clients_volume"),
                    F.col("month_clients_volume").cast("long").alias("month_clients_volume"),
                    F.col("first_purchase_calendar_year_clients_volume").cast("long")
                    .alias("first_purchase_calendar_year_clients_volume"),
                    F.col("first_purchase_month_clients_volume").cast("long")
                    .alias("first_purchase_month_clients_volume"))


# Customers and orders by scope (channel and both together) and period (month, quarter, year), of first buyers and of all.
_SCOPES = {"channel, month": ["channel", "month"], "month": ["month"], "channel, quarter": ["channel", "quarter"], "quarter": ["quarter"], "channel, year": ["channel", "year"],
           "year": ["year"], "channel": ["channel"], "all": []}


def _scope_sql(label, keys):
    cols = ", ".join(c if c in keys else f"NULL AS {c}" for c in ("channel", "month", "quarter", "year"))
    return (f"SELECT '{label}' AS scope, {cols}, COUNT(DISTINCT o_custkey) AS customers, COUNT(DISTINCT CASE WHEN d = first THEN o_custkey END) AS first_buyers, "
            f"COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS fulfilled FROM o" + (f" GROUP BY {', '.join(keys)}" if keys else ""))


@paired("k43_distinct_by_scopes", """
WITH o AS (SELECT o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'web' ELSE 'store ' || CAST(o_orderkey % 3 AS VARCHAR) END AS channel, CAST(o_orderdate AS DATE) AS d, o_orderstatus,
                  CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter, CAST(date_trunc('year', o_orderdate) AS DATE) AS year,
                  MIN(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS first FROM orders)
""" + " UNION ALL ".join(_scope_sql(k, v) for k, v in _SCOPES.items()), covers=("K43", "K16", "K31", "A2", "A4"))
def k43_scopes(spark, sf):
    from growthframe.operators.common import with_group_agg
    from growthframe.operators.distinct import distinct_by_scopes
    o = load(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("d"),
                                         F.when(F.col("o_orderkey") % 3 == 0, "web").otherwise(F.concat(F.lit("store "), (F.col("o_orderkey") % 3).cast("string"))).alias("channel"))
    for p in ("month", "quarter", "year"):
        o = o.withColumn(p, F.to_date(F.date_trunc(p, "d")))
    o = with_group_agg(o, ["o_custkey"], F.min("d").alias("first"))
    flags = {"customers": F.lit(True), "first_buyers": F.col("d") == F.col("first"), "fulfilled": F.col("o_orderstatus") == "F"}
    return distinct_by_scopes(o, _SCOPES, flags, "o_custkey").select("scope", "channel", "month", "quarter", "year", *flags)
