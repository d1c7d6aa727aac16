"""Customer value, status and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import months_diff, ratio_capped, round_half_up, safe_divide
from growthframe.operators.common import bucketed_lag, bucketed_running_sum, with_group_agg
from growthframe.operators.selection import exact_ntile


def monthly_cohort_orders(orders: DataFrame, customer: str, date: str, order_id: str) -> DataFrame:
    """Every order with its customer's first-order month and month rank (1 = first
    month), and whether it is the customer's first order."""
    d = F.to_date(F.col(date))
    first = orders.groupBy(customer).agg(F.min(F.struct(d.alias("d"), F.col(order_id).alias("o"))).alias("_f"))
    j = orders.join(first, customer)
    return j.select("*", F.to_date(F.date_trunc("month", F.col("_f.d"))).alias("cohort_month"),
                    (months_diff(F.to_date(F.col(date)), F.col("_f.d")) + 1).alias("month_rank"),
                    (F.col(order_id) == F.col("_f.o")).alias("is_first_order")).drop("_f")


def periods_between(start: Column, end: Column, grain: str) -> Column:
    """Whole calendar periods (days, Monday weeks, months) from one date to another."""
    if grain == "month":
        return months_diff(end, start)
    trunc = (lambda x: F.to_date(F.date_trunc("week", x))) if grain == "week" else F.to_date
    days = F.datediff(trunc(end), trunc(start))
    return F.floor(days / 7) if grain == "week" else days


def cohort_orders(orders: DataFrame, customer: str, date: str, grain: str) -> DataFrame:
    """Every order with its customer's cohort (period of the first order) and the rank of its own
    period in the cohort's life (1 = the first one), by day, week or month."""
    x = with_group_agg(orders, [customer], F.min(date).alias("_first"))
    first = F.to_date(F.date_trunc(grain, F.col("_first")))
    return x.withColumn("cohort", first).withColumn("period_rank", (periods_between(F.col("_first"), F.col(date), grain) + 1).cast("int")).drop("_first")


def cohort_retention(cohorted: DataFrame, cohort: str, rank: str, customer: str, measure: str, t: int, as_of, grain: str = "month") -> DataFrame:
    """Per cohort the share of its customers without an order in period ``t`` (churn) and the revenue
    of that period against the first one (NRR), where the cohort is ``t`` periods old at ``as_of``."""
    at = F.col(rank) == t + 1
    g = cohorted.groupBy(cohort).agg(
        F.countDistinct(customer).alias("cohort_size"), F.countDistinct(F.when(at, F.col(customer))).alias("active"),
        F.sum(F.when(at, F.col(measure)).otherwise(0.0)).alias("_t"), F.sum(F.when(F.col(rank) == 1, F.col(measure)).otherwise(0.0)).alias("_0"))
    old = periods_between(F.col(cohort), F.lit(as_of).cast("date"), grain) >= t
    return g.select(cohort, "cohort_size", F.when(old, F.col("active")).alias("active"),
                    F.when(old, round_half_up(1 - safe_divide("active", "cohort_size"), 4)).alias("churn_rate"),
                    F.when(old, round_half_up(safe_divide("_t", "_0"), 4)).alias("nrr"))


def cohort_at(cohorted: DataFrame, cohort: str, rank: str, measure: str, t: int, as_of, cohort_size: str,
              cumulative: bool = True, grain: str = "month") -> DataFrame:
    """Per cohort, the measure at period ``t`` (rank t+1) or up to it (cumulative),
    counted only when the cohort is at least ``t`` periods (``grain``) old at ``as_of``; and the
    ratio to the cohort size (CVR, LTV, ARPP, ROAS-style fields)."""
    old_enough = periods_between(F.col(cohort), F.lit(as_of).cast("date"), grain) >= t
    inside = (F.col(rank) <= t + 1) if cumulative else (F.col(rank) == t + 1)
    g = cohorted.groupBy(cohort).agg(F.sum(F.when(inside, F.col(measure)).otherwise(0.0)).alias("_v"),
                                     F.max(cohort_size).alias("cohort_size"))
    v = F.when(old_enough, F.col("_v"))
    return g.select(cohort, "cohort_size", round_half_up(v, 2).alias(f"value_t{t}"),
                    round_half_up(safe_divide(v, F.col("cohort_size")), 4).alias(f"per_customer_t{t}"))


def metric_layer(df: DataFrame, keys: Sequence[str], base: dict[str, Column],
                 derived: dict[str, Column]) -> DataFrame:
    """Named aggregate measures computed once, then dependent metrics (CAC, ROAS, LTV,
    payback, capped rates) as a second projection over the aggregate row."""
    g = df.groupBy(*keys).agg(*[c.alias(n) for n, c in base.items()])
    return g.select("*", *[c.alias(n) for n, c in derived.items()])


def running_pace(df: DataFrame, date: str, measure: str, as_of) -> DataFrame:
    """Month-to-date value at ``as_of``, same days of the previous month, growth and
    a month-end projection at the running daily pace. One scan, conditional sums."""
    a = F.lit(as_of).cast("date")
    d = F.to_date(F.col(date))
    mstart = F.to_date(F.date_trunc("month", a))
    pstart = F.add_months(mstart, -1)
    day_n = F.dayofmonth(a)
    mtd = F.sum(F.when((d >= mstart) & (d <= a), F.col(measure)).otherwise(0.0))
    prev = F.sum(F.when((d >= pstart) & (d < mstart) & (F.dayofmonth(d) <= day_n), F.col(measure)).otherwise(0.0))
    g = df.agg(mtd.alias("month_to_date"), prev.alias("previous_month_same_days"))
    return g.select(round_half_up("month_to_date", 2).alias("month_to_date"),
                    round_half_up("previous_month_same_days", 2).alias("previous_month_same_days"),
                    round_half_up(safe_divide(F.col("month_to_date") - F.col("previous_month_same_days"),
                                              F.col("previous_month_same_days")), 4).alias("growth"),
                    round_half_up(F.col("month_to_date") / day_n * F.dayofmonth(F.last_day(a)), 2)
                    .alias("projection_month_end"))


def ltv_groups(orders: DataFrame, customer: str, amount: str, order_id: str, n: int = 4, distributed: bool | None = None) -> DataFrame:
    """Per customer value, orders, AOV and value quartile (NTILE over customers with a
    positive value, highest value = group 1). The NTILE is exact (:func:`exact_ntile`): by selection, or by a plain
    window where the table's estimated size fits one task."""
    c = orders.groupBy(customer).agg(F.sum(amount).alias("customer_value"),
                                     F.countDistinct(order_id).alias("orders"))
    c = c.withColumn("aov", safe_divide("customer_value", "orders"))
    pos = c.filter(F.col("customer_value") > 0)
    return exact_ntile(pos, n, [(-F.col("customer_value")), F.col(customer)], name="ltv_group", distributed=distributed)


def ltv_subgroups(groups: DataFrame, customer: str, n: int = 4, distributed: bool | None = None) -> DataFrame:
    """Inside each value group, quartiles of AOV and of order count (one partitioned
    NTILE each instead of one union branch per group), both exact (:func:`exact_ntile`)."""
    a = exact_ntile(groups, n, [(-F.col("aov")), F.col(customer)], ["ltv_group"], name="aov_subgroup", distributed=distributed)
    return exact_ntile(a, n, [(-F.col("orders")), F.col(customer)], ["ltv_group"], name="orders_subgroup", distributed=distributed)


def group_transitions(orders: DataFrame, customer: str, date: str, order_id: str, amount: str,
                      cuts: Sequence[tuple[float, str]]) -> DataFrame:
    """Running customer value after each order, the value before it, the value group
    (``cuts`` = ascending (lower bound, label)) and a transition label when an order lifts the value
    over a bound (none on a first order, none downwards).

    Running sums are bucketed by month (skew-safe: a customer with a huge history is spread
    over its active months)."""
    x = bucketed_running_sum(orders, [customer], date, order_id, amount, "running_value")
    x = bucketed_lag(x, [customer], date, order_id, ["running_value"], prefix="_before_").withColumnRenamed("_before_running_value", "previous_value")

    def label(c: Column) -> Column:
        out = None
        for lo, lab in sorted(cuts, key=lambda z: -z[0]):
            out = F.when(c >= lo, lab) if out is None else out.when(c >= lo, lab)
        return out

    x = x.withColumn("value_group", label(F.col("running_value"))) \
        .withColumn("previous_group", label(F.col("previous_value")))
    crossed = F.lit(False)
    for lo, _ in cuts:
        crossed = crossed | ((F.col("previous_value") < lo) & (F.col("running_value") >= lo))
    return x.withColumn("transition", F.when(crossed, F.concat("previous_group", F.lit(" -> "), "value_group")))


def customer_status(orders: DataFrame, customer: str, date: str, order_id: str, start, end,
                    gap_months: int = 12) -> DataFrame:
    """Status of each order in [start, end]: 'new' (first order ever), 'reactivated'
    (previous order more than ``gap_months`` months before), else 'returning'."""
    d = F.to_date(F.col(date))
    x = bucketed_lag(orders.withColumn("_d", d), [customer], date, order_id, ["_d"], prefix="_prev")
    x = x.withColumnRenamed("_prev_d", "_prev").drop("_d")
    x = x.filter(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return x.withColumn("customer_status", F.when(F.col("_prev").isNull(), "new")
                        .when(F.col("_prev") < F.add_months(d, -gap_months), "reactivated")
                        .otherwise("returning")).withColumnRenamed("_prev", "previous_order_date")


def new_vs_returning_by_day(orders: DataFrame, customer: str, date: str, recent_days: int = 365) -> DataFrame:
    """Per day and customer: orders that day, orders before that day, days since the
    previous purchase day, and a type (new / recent returning / old returning).

    Built from the per (customer, day) aggregate with a running window over that small
    table, instead of the reference's join of every day with every earlier order."""
    day = orders.groupBy(customer, F.to_date(F.col(date)).alias("day")).agg(F.count("*").alias("orders"))
    w = Window.partitionBy(customer).orderBy("day")
    x = day.withColumn("prior_orders", F.coalesce(F.sum("orders").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                                  F.lit(0)))
    x = x.withColumn("days_since_previous", F.datediff("day", F.lag("day").over(w)))
    return x.withColumn("customer_type", F.when(F.col("prior_orders") == 0, "new")
                        .when(F.col("days_since_previous") <= recent_days, "recent returning")
                        .otherwise("old returning"))


def lapsed_customers(orders: DataFrame, customer: str, date: str, spine: DataFrame, months: int) -> DataFrame:
    """Per day of ``spine`` (column ``d``), the number of customers whose last order on
    or before that day is more than ``months`` months old.

    Sweep form: each purchase day p with next purchase day q opens a lapsed interval
    [p + months + 1 day, q] (open-ended without q); +1/-1 change points are aggregated per
    day and a running sum over the spine gives the count. Work is O(orders + days), not the
    reference's O(days x orders) inequality join."""
    days = orders.select(customer, F.to_date(F.col(date)).alias("p")).distinct()
    w = Window.partitionBy(customer).orderBy("p")
    iv = days.withColumn("q", F.lead("p").over(w)) \
        .withColumn("lapse_start", F.date_add(F.add_months("p", months), 1))
    iv = iv.filter(F.col("q").isNull() | (F.col("lapse_start") <= F.col("q")))
    plus = iv.select(F.col("lapse_start").alias("d"), F.lit(1).alias("delta"))
    minus = iv.filter(F.col("q").isNotNull()).select(F.col("q").alias("d"), F.lit(-1).alias("delta"))
    changes = plus.unionByName(minus).groupBy("d").agg(F.sum("delta").alias("delta"))
    # the spine is one row per day (bounded by the calendar): a global running window over it is small
    sp = spine.select("d").distinct().join(changes, "d", "full").withColumn("delta", F.coalesce("delta", F.lit(0)))
    sp = sp.withColumn("lapsed_customers", F.sum("delta").over(
        Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)))
    return spine.select("d").distinct().join(sp.select("d", "lapsed_customers"), "d")


def retention_by_orders(orders: DataFrame, customer: str, date: str, order_id: str, cur: tuple, prev: tuple) -> DataFrame:
    """Customers by number of orders in the current period and in the previous period of
    the same length (two-level aggregate, one scan, full join of the two distributions)."""
    d = F.to_date(F.col(date))
    lab = F.when(d.between(F.lit(cur[0]).cast("date"), F.lit(cur[1]).cast("date")), "current") \
        .when(d.between(F.lit(prev[0]).cast("date"), F.lit(prev[1]).cast("date")), "previous")
    x = orders.withColumn("period", lab).filter(F.col("period").isNotNull())
    per = x.groupBy("period", customer).agg(F.countDistinct(order_id).alias("n_orders"))
    dist = per.groupBy("period", "n_orders").agg(F.count("*").alias("customers"))
    c = dist.filter(F.col("period") == "current").select("n_orders", F.col("customers").alias("customers_current"))
    p = dist.filter(F.col("period") == "previous").select("n_orders", F.col("customers").alias("customers_previous"))
    return c.join(p, "n_orders", "full").fillna(0, ["customers_current", "customers_previous"])


def time_between_orders(orders: DataFrame, customer: str, date: str, order_id: str) -> DataFrame:
    """Per order the days since the customer's previous purchase day (same-day orders
    ignored: the gap is computed between distinct purchase days)."""
    days = orders.select(customer, F.to_date(F.col(date)).alias("day")).distinct()
    w = Window.partitionBy(customer).orderBy("day")
    return days.withColumn("days_since_previous", F.datediff("day", F.lag("day").over(w)))


def new_accounts_by_store(created: DataFrame, date: str, store: str, customer: str, spine: DataFrame, period_days: int) -> DataFrame:
    """K59 by store: distinct accounts per day and store next to those of the same store ``period_days`` earlier. A day of the spine
    without accounts is one row without a store; the earlier count is NULL where that store had none."""
    per = created.groupBy(F.to_date(F.col(date)).alias("d"), F.col(store).alias("store")).agg(F.countDistinct(customer).alias("accounts"))
    prev = per.select(F.date_add("d", period_days).alias("d"), "store", F.col("accounts").alias("accounts_previous"))
    cur = spine.join(per, "d", "left").fillna(0, ["accounts"])
    return cur.join(prev, ["d", "store"], "left")


def new_accounts(created: DataFrame, date: str, spine: DataFrame, period_days: int) -> DataFrame:
    """Accounts created per day next to the count ``period_days`` earlier (spine-dense)."""
    per = created.groupBy(F.to_date(F.col(date)).alias("d")).agg(F.count("*").alias("accounts"))
    cur = spine.join(per, "d", "left").fillna(0, ["accounts"])
    prev = per.select(F.date_add("d", period_days).alias("d"), F.col("accounts").alias("accounts_previous"))
    return cur.join(prev, "d", "left").fillna(0, ["accounts_previous"])


def accounts_growth(created: DataFrame, date: str, cur: tuple, prev: tuple) -> DataFrame:
    """Growth rate of creations between two windows normalised by their lengths
    (cross multiplication), NULL when the previous window is empty."""
    d = F.to_date(F.col(date))
    c0, c1 = F.lit(cur[0]).cast("date"), F.lit(cur[1]).cast("date")
    p0, p1 = F.lit(prev[0]).cast("date"), F.lit(prev[1]).cast("date")
    g = created.agg(F.count_if(d.between(c0, c1)).alias("current"), F.count_if(d.between(p0, p1)).alias("previous"))
    len_c = F.datediff(c1, c0) + 1
    len_p = F.datediff(p1, p0) + 1
    return g.select("current", "previous", round_half_up(
        safe_divide(F.col("current") * len_p, F.col("previous") * len_c) - 1, 4).alias("growth_rate"))


def win_rate(created: DataFrame, first_orders: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Account creations per first order, by day and key, capped at 1; NULL without first orders."""
    a = created.groupBy(*keys, F.to_date(F.col(date)).alias("d")).agg(F.count("*").alias("creations"))
    b = first_orders.groupBy(*keys, F.to_date(F.col(date)).alias("d")).agg(F.count("*").alias("first_orders"))
    j = a.join(b, [*keys, "d"], "full").fillna(0, ["creations", "first_orders"])
    return j.withColumn("win_rate", ratio_capped("creations", "first_orders"))


def store_new_customers(orders: DataFrame, customer: str, store: str, date: str) -> DataFrame:
    """New customers per day and store (first order of the customer in that store) and
    the cumulative number of omnichannel customers (bought in 2+ stores) by day.

    The omni count is a running sum of "second distinct store reached" events per day."""
    firsts = orders.groupBy(customer, store).agg(F.to_date(F.min(date)).alias("first_day"))
    per_store = firsts.groupBy(store, F.col("first_day").alias("d")).agg(F.count("*").alias("new_customers"))
    w = Window.partitionBy(customer).orderBy("first_day", store)
    second = firsts.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") == 2) \
        .groupBy(F.col("first_day").alias("d")).agg(F.count("*").alias("_new_omni"))
    omni = second.withColumn("omni_customers_cumulative", F.sum("_new_omni").over(
        Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0))).drop("_new_omni")
    return per_store, omni


def customer_migration(orders: DataFrame, customer: str, store: str, date: str, p1: tuple, p2: tuple,
                       stores: Sequence[str] | None = None, clusters: dict[str, str] | None = None) -> DataFrame:
    """Per customer the stores bought from in period 1 and period 2, only-one-store flags
    and whether the customer moved (sets differ). ``stores`` restricts the stores considered;
    ``clusters`` maps stores to store clusters, compared instead of single stores."""
    if stores is not None:
        orders = orders.filter(F.col(store).isin(list(stores)))
    if clusters:
        m = F.create_map(*[F.lit(x) for kv in clusters.items() for x in kv])
        orders = orders.withColumn(store, F.coalesce(m[F.col(store)], F.col(store)))
    d = F.to_date(F.col(date))
    in1 = d.between(F.lit(p1[0]).cast("date"), F.lit(p1[1]).cast("date"))
    in2 = d.between(F.lit(p2[0]).cast("date"), F.lit(p2[1]).cast("date"))
    g = orders.filter(in1 | in2).groupBy(customer).agg(
        F.array_sort(F.collect_set(F.when(in1, F.col(store)))).alias("stores_p1"),
        F.array_sort(F.collect_set(F.when(in2, F.col(store)))).alias("stores_p2"))
    return g.select(customer, F.array_join("stores_p1", ",").alias("stores_p1"),
                    F.array_join("stores_p2", ",").alias("stores_p2"),
                    (F.size("stores_p1") == 1).alias("only_one_store_p1"),
                    (F.size("stores_p2") == 1).alias("only_one_store_p2"),
                    (F.col("stores_p1") != F.col("stores_p2")).alias("migrated"))


def retention_item_counts(lines: DataFrame, customer: str, date: str, order_id: str, item: str,
                          cur: tuple, prev: tuple) -> DataFrame:
    """K57 item sets: for each period and number-of-orders bucket, how many customers bought
    each item. The reference concatenates every customer's distinct item list into one array
    per bucket (an unbounded array in one row); the same multiset is kept here as
    (bucket, item, customers) rows, a distributed aggregate."""
    d = F.to_date(F.col(date))
    lab = F.when(d.between(F.lit(cur[0]).cast("date"), F.lit(cur[1]).cast("date")), "current") \
        .when(d.between(F.lit(prev[0]).cast("date"), F.lit(prev[1]).cast("date")), "previous")
    x = lines.withColumn("period", lab).filter(F.col("period").isNotNull())
    per_customer = x.groupBy("period", customer).agg(F.countDistinct(order_id).alias("n_orders"))
    items = x.filter(F.col(item).isNotNull()).select("period", customer, item).distinct()
    j = items.join(per_customer, ["period", customer])
    return j.groupBy("period", "n_orders", item).agg(F.count("*").alias("customers"))


def rolling_window_metrics(daily: DataFrame, day: str, sums: Sequence[str], days: int = 30,
                           keys: Sequence[str] = ()) -> DataFrame:
    """K46 rolling measures: trailing ``days``-day sums of daily measures (RANGE frame on the
    day number, so missing days count as 0) per key. The input is a daily aggregate: one row
    per key and day, bounded by the calendar."""
    dn = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(dn).rangeBetween(-(days - 1), 0)
    out = daily
    for s in sums:
        out = out.withColumn(f"{s}_{days}d", F.sum(s).over(w))
    return out


def payback_and_goals(monthly: DataFrame, goals: DataFrame, month: str = "month") -> DataFrame:
    """Metrics that rest on other metrics. ``monthly`` has spend, new_customers, first_purchase_amount (sum over new
    customers), revenue, paid_touches and touches; ``goals`` (month, measure, goal).

    CAC = spend per new customer; payback = CAC over the average first purchase (first purchases that pay one customer back);
    efficiency = 100 x the share of paid touches over the CAC; each goal with what was reached and the rate. A
    measure without a denominator is NULL, and so is all that rests on it."""
    m = monthly.withColumn("cac", safe_divide("spend", "new_customers"))
    m = m.withColumn("average_first_purchase", safe_divide("first_purchase_amount", "new_customers"))
    m = m.withColumn("payback_purchases", safe_divide("cac", "average_first_purchase"))
    m = m.withColumn("paid_rate", safe_divide("paid_touches", "touches")).withColumn("efficiency_score", safe_divide(100 * F.col("paid_rate"), F.col("cac")))
    kinds = [r for r in ("revenue", "new_customers", "spend")]
    g = goals.groupBy(month).agg(*[F.max(F.when(F.col("measure") == k, F.col("goal"))).alias(f"{k}_goal") for k in kinds])
    x = m.join(g, month, "left")
    for k in kinds:
        x = x.withColumn(f"{k}_goal_rate", safe_divide(F.col(k), F.col(f"{k}_goal")))
    return x
