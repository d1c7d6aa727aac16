"""Orders, customers, cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import months_diff, round_half_up, safe_divide, years_diff
from growthframe.operators.common import with_group_agg


def cohort_ranks(orders: DataFrame, customer: str, date: str, fiscal_shift_months: int = 6) -> DataFrame:
    """Period rank of every order since the customer's first purchase.

    Adds first purchase month / calendar year / fiscal year (year starting
    ``fiscal_shift_months`` before January), the same periods of the order and the ranks
    ``boundary difference + 1``. The first purchase is a pre-aggregated ``min`` joined back
    (one shuffle on the customer; partial aggregation map-side, AQE splits a hot customer)."""
    d = F.to_date(F.col(date))
    base = orders.withColumn("_d", d)
    base = with_group_agg(base, [customer], F.min("_d").alias("_first_d"))
    fiscal = lambda c: F.to_date(F.date_trunc("year", F.add_months(c, fiscal_shift_months)))
    return (base
            .withColumn("first_purchase_month", F.to_date(F.date_trunc("month", "_first_d")))
            .withColumn("first_purchase_calendar_year", F.to_date(F.date_trunc("year", "_first_d")))
            .withColumn("first_purchase_fiscal_year", fiscal(F.col("_first_d")))
            .withColumn("order_month", F.to_date(F.date_trunc("month", "_d")))
            .withColumn("order_calendar_year", F.to_date(F.date_trunc("year", "_d")))
            .withColumn("order_fiscal_year", fiscal(F.col("_d")))
            .withColumn("order_month_rank", months_diff("order_month", "first_purchase_month") + 1)
            .withColumn("order_calendar_year_rank",
                        years_diff("order_calendar_year", "first_purchase_calendar_year") + 1)
            .withColumn("order_fiscal_year_rank",
                        years_diff("order_fiscal_year", "first_purchase_fiscal_year") + 1)
            .drop("_d", "_first_d"))


COHORT_KEYS = ["first_purchase_month", "first_purchase_calendar_year", "first_purchase_fiscal_year",
               "order_month", "order_calendar_year", "order_fiscal_year",
               "order_month_rank", "order_calendar_year_rank", "order_fiscal_year_rank"]


def cohort_metrics(cohorted: DataFrame, scope: str, amount: str, order_id: str, customer: str,
                   is_refund: str | None = None, all_scope: str = "omni") -> DataFrame:
    """Revenue, orders, customers and AOV per cohort cell and scope, plus cohort sizes.

    The reference scans the orders once per scope and unions the branches; here each row is
    exploded to ``[its scope, all_scope]`` and one aggregate computes every scope. Refund rows
    subtract revenue and never count as orders or customers. Cohort sizes are window
    aggregates over the aggregated cells, whose number is bounded by months^2 x scopes."""
    refund = F.col(is_refund) if is_refund else F.lit(False)
    rows = cohorted.withColumn("scope", F.explode(F.array(F.col(scope), F.lit(all_scope))))
    paid_amt = F.when(~refund, F.col(amount)).otherwise(0.0)
    ref_amt = F.when(refund, F.col(amount)).otherwise(0.0)
    cells = (rows.groupBy("scope", *COHORT_KEYS)
             .agg(round_half_up(F.sum(paid_amt) - F.sum(ref_amt), 2).alias("revenue"),
                  F.countDistinct(F.when(~refund, F.col(order_id))).alias("orders_volume"),
                  F.countDistinct(F.when(~refund, F.col(customer))).alias("unique_clients_volume"),
                  round_half_up(safe_divide(F.sum(paid_amt),
                                            F.countDistinct(F.when(~refund, F.col(order_id)))), 2).alias("aov")))
    w_cal = Window.partitionBy("scope", "first_purchase_calendar_year", "order_calendar_year")
    # (scope, first month, order month) identifies a cell (the other keys derive from the two
    # months), so the month volume is the cell's own count: no window needed
    cells = (cells
             .withColumn("calendar_year_clients_volume", F.sum("unique_clients_volume").over(w_cal))
             .withColumn("month_clients_volume", F.col("unique_clients_volume")))
    return (cells
            .withColumn("first_purchase_calendar_year_clients_volume",
                        F.max("calendar_year_clients_volume").over(
                            Window.partitionBy("scope", "first_purchase_calendar_year")))
            .withColumn("first_purchase_month_clients_volume",
                        F.max("month_clients_volume").over(Window.partitionBy("scope", "first_purchase_month"))))
