"""Consent (opt-in) histories against purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.operators.common import bucketed_lag
from growthframe.operators.state import asof_both, asof_join_forward


def optin_switches(history: DataFrame, key: str, order: Sequence[str], field: str, valid: Column | None = None) -> DataFrame:
    """Rows where a consent field goes from false / NULL to true (first row included when
    true), kept only when ``valid`` holds (e.g. a parsable date). ``order`` = (time,
    tie-breaker); the lag is bucketed by day (skew-safe)."""
    x = bucketed_lag(history, [key], order[0], order[1], [field], "day", prefix="_p_")
    x = x.withColumnRenamed(f"_p_{field}", "_prev")
    cond = F.coalesce(F.col(field), F.lit(False)) & ~F.coalesce(F.col("_prev"), F.lit(False))
    if valid is not None:
        cond = cond & valid
    return x.filter(cond).drop("_prev")


def optin_at_purchase(orders: DataFrame, switches: DataFrame, key: str, order_ts: str, switch_ts: str,
                      switch_values: Sequence[str]) -> DataFrame:
    """For each order, the next opt-in switch at or after it (forward as-of), plus the
    customer's first switch time."""
    nxt = asof_join_forward(orders, switches, [key], order_ts, switch_ts, [switch_ts, *switch_values])
    first = switches.groupBy(key).agg(F.min(switch_ts).alias("first_switch_ts"))
    return nxt.join(first, key, "left")


def first_purchase_optins(orders: DataFrame, history: DataFrame, key: str, order_ts: str, store: str, hist_ts: str, tie: str, fields: Sequence[str]) -> DataFrame:
    """K65 in the scope of first purchases: one row per customer, from the customer's first order (of equally early ones the
    smallest store) and the first history row at or after that day.

    Per consent field: ``{field}_switched`` (that row turns it from false / NULL to true), ``{field}_was_out`` (it was not given
    before that row), ``{field}_switch_store`` and ``{field}_switch_date`` (store and day of the first order, where it switched). Days are
    compared, as both sides are dated by the day. The history is numbered once for all fields."""
    flags = [F.coalesce(F.col(f), F.lit(False)).alias(f) for f in fields]
    h = history.select(key, hist_ts, tie, *flags)
    h = bucketed_lag(h, [key], hist_ts, tie, list(fields), "day", prefix="_p_")
    day = F.to_date(F.col(hist_ts)).cast("timestamp_ntz")
    row = h.select(key, day.alias("_h_day"), F.struct(hist_ts, tie, *[F.struct(F.col(f).alias("now"), F.coalesce(F.col(f"_p_{f}"), F.lit(False)).alias("was")).alias(f) for f in fields]).alias("_h"))
    # one candidate for each day: its first row
    row = row.groupBy(key, "_h_day").agg(F.min("_h").alias("_h"))
    first = orders.groupBy(key).agg(F.min(F.struct(F.to_date(F.col(order_ts)).alias("d"), F.col(store).alias("store"))).alias("_o"))
    first = first.select(key, F.col("_o.d").alias("first_purchase_date"), F.col("_o.store").alias("store"), F.col("_o.d").cast("timestamp_ntz").alias("_o_day"))
    x = asof_join_forward(first, row, [key], "_o_day", "_h_day", ["_h"], prefix="next", bucket="month")
    out = [key, "first_purchase_date", "store"]
    for f in fields:
        switched = F.coalesce(F.col(f"next_h.{f}.now") & ~F.col(f"next_h.{f}.was"), F.lit(False))
        out += [switched.alias(f"{f}_switched"), (~F.coalesce(F.col(f"next_h.{f}.was"), F.lit(False))).alias(f"{f}_was_out"),
                F.when(switched, F.col("store")).alias(f"{f}_switch_store"), F.when(switched, F.col("first_purchase_date")).alias(f"{f}_switch_date")]
    return x.select(*out)


def optin_before_after(first_orders: DataFrame, history: DataFrame, key: str, order_ts: str, hist_ts: str,
                       field: str) -> DataFrame:
    """Consent state just before the first purchase (last history row strictly before)
    and at or after it (first history row at or after), both from one pass. Every row of ``first_orders`` stays, once: NULL
    customers and times have no state, rows that agree in customer and time don't multiply."""
    h = history.select(key, F.col(hist_ts).alias("_h_ts"), F.col(field).alias("_h_val"))
    x = asof_both(first_orders, h, [key], order_ts, "_h_ts", ["_h_val"])
    return x.withColumnsRenamed({"before__h_val": f"{field}_before", "after__h_val": f"{field}_after"})


def optin_at_period_end(history: DataFrame, orders: DataFrame, key: str, hist_ts: str, field: str,
                        order_ts: str, store: str, end, active_days: int) -> DataFrame:
    """At period end: last consent state, last store bought from and whether the
    customer bought within ``active_days`` before the end. Two ``max_by`` aggregates."""
    e = F.lit(end).cast("timestamp_ntz")
    # last KNOWN state: rows where the field is NULL (not provided) are skipped
    s = history.filter(F.col(hist_ts) <= e).groupBy(key).agg(
        F.max_by(F.col(field), F.when(F.col(field).isNotNull(), F.col(hist_ts))).alias(f"{field}_at_end"))
    o = orders.filter(F.col(order_ts) <= e).groupBy(key).agg(
        F.max_by(F.col(store), F.struct(order_ts, store)).alias("last_store"), F.max(order_ts).alias("last_order_ts"))
    j = s.join(o, key, "full")
    return j.withColumn("active", F.coalesce(F.col("last_order_ts") >= e - F.expr(f"INTERVAL {active_days} DAYS"),
                                             F.lit(False)))


def store_optin_kpis(purchases: DataFrame, key: str, store: str, ts: str, optin_at_purchase_col: str,
                     first_switch: str) -> DataFrame:
    """Per day and store: distinct buyers, buyers opted in at purchase, buyers whose first
    opt-in happened that day, and the running number of distinct opted-in buyers per store
    (from first opted-in purchase dates, pre-aggregated, instead of COUNT(DISTINCT) OVER)."""
    d = F.to_date(F.col(ts))
    x = purchases.withColumn("d", d)
    g = x.groupBy("d", store).agg(
        F.countDistinct(key).alias("buyers"),
        F.countDistinct(F.when(F.col(optin_at_purchase_col), F.col(key))).alias("buyers_opted_in"),
        F.countDistinct(F.when(F.to_date(F.col(first_switch)) == F.col("d"), F.col(key))).alias("new_optins"))
    firsts = x.filter(F.col(optin_at_purchase_col)).groupBy(store, key).agg(F.min("d").alias("d"))
    per_day = firsts.groupBy(store, "d").agg(F.count("*").alias("_n"))
    cum = per_day.withColumn("opted_in_buyers_cumulative", F.sum("_n").over(
        Window.partitionBy(store).orderBy("d").rowsBetween(Window.unboundedPreceding, 0))).drop("_n")
    j = g.join(cum, [store, "d"], "full")
    w = Window.partitionBy(store).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    j = j.withColumn("opted_in_buyers_cumulative", F.last("opted_in_buyers_cumulative", ignorenulls=True).over(w))
    return j.fillna(0, ["buyers", "buyers_opted_in", "new_optins", "opted_in_buyers_cumulative"])


#: Consent fields of the contact history.
CONSENTS = ("email", "phone", "birthday")


def valid_birthday(col: str) -> Column:
    """A date as yyyy-MM-dd or dd/MM/yyyy that exists and whose year is not 1900, the placeholder."""
    iso = F.try_to_timestamp(F.when(F.col(col).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(col)), F.lit("yyyy-MM-dd"))
    local = F.try_to_timestamp(F.when(F.col(col).rlike(r"^\d{2}/\d{2}/\d{4}$"), F.col(col)), F.lit("dd/MM/yyyy"))
    return F.coalesce(F.year(F.coalesce(iso, local)) != 1900, F.lit(False))


def store_consent_report(orders: DataFrame, history: DataFrame, key: str, order: str, store: str, order_ts: str, hist_ts: str, tie: str,
                         start, end, active_days: int) -> DataFrame:
    """Per store and day from ``start`` to ``end``, 21 counts of distinct customers and the share of orders linked to one.

    ``history`` has a boolean per consent of ``CONSENTS`` (NULL: not provided). Counts never come from a join of days with orders
    or histories. Whatever counts a customer over many days is a signed change: +1 on the day the customer enters the count in a
    store, -1 on the day it leaves again (``active_days`` after an order without another one; a consent that is taken back);
    the changes of each store and day are added and summed up over the days. Changes are one row per customer, store and
    state, so a store or customer with a third of all orders is pre-aggregated like any other.

    ``{consent}``: first given up to that day; ``new_{consent}``: of these, given since ``start``; ``{consent}_at_first``: given on the very
    day of the first order in the store; ``new_{consent}_at_first``: both; ``{consent}_now``: still given on that day. Days run
    from a store's first order on."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    o = orders.select(F.col(store).alias("store"), F.col(key).alias("c"), F.col(order).alias("o"), F.to_date(F.col(order_ts)).alias("d")).filter(F.col("d") <= hi)
    firsts = o.filter("c IS NOT NULL").groupBy("store", "c").agg(F.min("d").alias("first"))
    hd = F.to_date(F.col(hist_ts))
    h = history.select(F.col(key).alias("c"), F.col(hist_ts).alias("t"), F.col(tie).alias("tie"), hd.alias("d"), *CONSENTS).filter(F.col("c").isNotNull() & (F.col("d") <= hi))
    given = h.groupBy("c").agg(*[F.min(F.when(F.col(k), F.col("d"))).alias(k) for k in CONSENTS])
    people = firsts.join(given, "c", "left")
    one = F.lit(1)

    def change(day, cond, **counts):
        return F.when(cond, F.struct(day.alias("d"), *[F.lit(counts.get(n, 0)).alias(n) for n in names]))

    names = ["customers", "active", "linked", "orders", *[f"{p}{k}{q}" for k in CONSENTS for p, q in (("", ""), ("new_", ""), ("", "_at_first"), ("new_", "_at_first"), ("", "_now"))]]
    entries = [change(F.col("first"), F.lit(True), customers=1)]
    for k in CONSENTS:
        day, same, new = F.greatest(F.col("first"), F.col(k)), F.col(k) == F.col("first"), F.col(k) >= lo
        entries += [change(day, F.col(k).isNotNull(), **{k: 1}), change(day, new, **{f"new_{k}": 1}),
                    change(day, same, **{f"{k}_at_first": 1}), change(day, same & new, **{f"new_{k}_at_first": 1})]
    parts = [people.select("store", F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("x"))]
    # active: intervals of active_days + 1 days from each order day, merged where they touch
    days = o.filter("c IS NOT NULL").select("store", "c", "d").distinct()
    w = Window.partitionBy("store", "c").orderBy("d")  # a customer's order days in one store: bounded by the calendar
    edge = days.withColumn("_prev", F.lag("d").over(w)).withColumn("_next", F.lead("d").over(w))
    gone = F.date_add("d", active_days + 1)
    moves = F.array(change(F.col("d"), F.col("_prev").isNull() | (F.date_add("_prev", active_days + 1) < F.col("d")), active=1),
                    change(gone, F.col("_next").isNull() | (gone < F.col("_next")), active=-1))
    parts.append(edge.select("store", F.explode(F.filter(moves, lambda x: x.isNotNull())).alias("x")))
    # consent held at the end of a day: changes of the last known state, from the first order in the store on
    known = h.groupBy("c", "d").agg(*[F.max_by(k, F.when(F.col(k).isNotNull(), F.struct("t", "tie"))).alias(k) for k in CONSENTS])
    wc = Window.partitionBy("c").orderBy("d")
    for k in CONSENTS:
        x = known.filter(F.col(k).isNotNull()).select("c", "d", F.col(k).alias("on"))
        x = x.withColumn("was", F.coalesce(F.lag("on").over(wc), F.lit(False))).filter("on != was")
        x = x.withColumn("until", F.lead("d").over(wc)).filter("on")
        x = x.join(firsts, "c").withColumn("d", F.greatest("d", "first")).filter("until IS NULL OR until > d")
        moves = F.array(change(F.col("d"), F.lit(True), **{f"{k}_now": 1}), change(F.col("until"), F.col("until").isNotNull(), **{f"{k}_now": -1}))
        parts.append(x.select("store", F.explode(F.filter(moves, lambda y: y.isNotNull())).alias("x")))
    # orders: each in the store and on the day it is first seen
    seen = o.groupBy("store", "o").agg(F.min("d").alias("d"), F.min(F.when(F.col("c").isNotNull(), F.col("d"))).alias("linked_on"))
    moves = F.array(change(F.col("d"), F.col("o").isNotNull(), orders=1), change(F.col("linked_on"), F.col("o").isNotNull() & F.col("linked_on").isNotNull(), linked=1))
    parts.append(seen.select("store", F.explode(F.filter(moves, lambda x: x.isNotNull())).alias("x")))
    changes = parts[0]
    for p in parts[1:]:
        changes = changes.union(p)
    per_day = changes.select("store", "x.*").groupBy("store", "d").agg(*[F.sum(n).alias(n) for n in names])
    # what counts on a single day: customers who order on it
    buyers = days.filter(F.col("d") >= lo).join(people, ["store", "c"]).groupBy("store", "d").agg(
        F.count("*").alias("buyers"), F.count_if((F.col("first") >= lo) & (F.col("email") == F.col("first"))).alias("buyers_email_at_first"))
    bounds = o.groupBy("store").agg(F.min("d").alias("_d0"))
    spine = bounds.select("store", F.explode(F.sequence(F.greatest("_d0", lo), hi)).alias("d"))
    run = Window.partitionBy("store").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)  # one row per store and day
    g = per_day.join(spine.withColumn("_in", one), ["store", "d"], "full")
    g = g.select("store", "d", "_in", *[F.coalesce(F.sum(n).over(run), F.lit(0)).cast("long").alias(n) for n in names]).filter("_in IS NOT NULL")
    out = g.join(buyers, ["store", "d"], "left").withColumn("linked_rate", F.try_divide(F.col("linked"), F.col("orders")))
    return out.drop("_in", "linked", "orders").fillna(0, ["buyers", "buyers_email_at_first"])
