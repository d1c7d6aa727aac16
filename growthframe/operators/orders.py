"""Order lines, products and order facts (K51-K53, K69-K78, K106-K108)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up, safe_divide
from growthframe.operators.common import with_group_agg


def modes(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A18 / K108: the most frequent value(s) per key; ties all kept.

    Counts are a partial aggregate; the max per key is a second small aggregate joined back,
    so no window has to hold a whole key in one task."""
    c = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return with_group_agg(c, keys, F.max("n").alias("_mx")).filter(F.col("n") == F.col("_mx")).drop("_mx")


def main_reason(df: DataFrame, keys: Sequence[str], reason: str) -> DataFrame:
    """K108: one row per key with the most frequent reason, NULL when several tie."""
    m = modes(df, keys, reason)
    return m.groupBy(*keys).agg(F.when(F.count("*") == 1, F.first(reason)).alias("main_reason"),
                                F.max("n").alias("reason_count"))


def dominant_category(lines: DataFrame, order: str, category: str, qty: str) -> DataFrame:
    """category(ies) holding the largest quantity in each order, with a persona label:
    the single dominant category, or 'mixed' when several tie.

    Two aggregates and no join back: the per-order list of (quantity, category) pairs is
    bounded by the number of categories, and the maximum and ties are picked inside it."""
    per = lines.groupBy(order, category).agg(F.sum(qty).alias("cat_qty"))
    g = per.groupBy(order).agg(F.max("cat_qty").alias("dominant_qty"),
                               F.collect_list(F.struct(F.col("cat_qty").alias("q"), F.col(category).alias("c")))
                               .alias("_cats"))
    top = F.array_sort(F.transform(F.filter("_cats", lambda s: s["q"] == F.col("dominant_qty")), lambda s: s["c"]))
    return g.select(order, top.alias("dominant_categories"), "dominant_qty").select(
        order, "dominant_categories", "dominant_qty",
        F.when(F.size("dominant_categories") == 1, F.col("dominant_categories")[0]).otherwise(F.lit("mixed"))
        .alias("persona"))


def product_period_compare(lines: DataFrame, product: str, date: str, price: str, qty: str,
                           cur: tuple, prev: tuple) -> DataFrame:
    """Quantity and average price per product in two periods, % change.

    One scan with conditional aggregates instead of one scan per period."""
    d = F.to_date(F.col(date))
    in_cur = d.between(F.lit(cur[0]).cast("date"), F.lit(cur[1]).cast("date"))
    in_prev = d.between(F.lit(prev[0]).cast("date"), F.lit(prev[1]).cast("date"))
    g = lines.filter(in_cur | in_prev).groupBy(product).agg(
        F.sum(F.when(in_cur, F.col(qty)).otherwise(0.0)).alias("qty_current"),
        F.sum(F.when(in_prev, F.col(qty)).otherwise(0.0)).alias("qty_previous"),
        F.sum(F.when(in_cur, F.col(price)).otherwise(0.0)).alias("_rev_cur"),
        F.sum(F.when(in_prev, F.col(price)).otherwise(0.0)).alias("_rev_prev"))
    return g.select(
        product, "qty_current", "qty_previous",
        round_half_up(safe_divide("_rev_cur", "qty_current"), 2).alias("unit_price_current"),
        round_half_up(safe_divide("_rev_prev", "qty_previous"), 2).alias("unit_price_previous"),
        round_half_up(safe_divide(F.col("qty_current") - F.col("qty_previous"), F.col("qty_previous")) * 100, 2)
        .alias("qty_change_pct"))


def multi_value_breakdown(df: DataFrame, list_col: str, sep: str, measures: Sequence[Column],
                          keep: Sequence[str] | None = None, name: str = "value") -> DataFrame:
    """A delimited multi-value column exploded, measures per value, optional filter list."""
    x = df.withColumn(name, F.explode(F.split(F.col(list_col), sep))).withColumn(name, F.trim(F.col(name)))
    if keep is not None:
        x = x.filter(F.col(name).isin(list(keep)))
    return x.groupBy(name).agg(*measures)


def allocate_discount(lines: DataFrame, order: str, line_amount: str, order_total: str) -> DataFrame:
    """K106: pro-rata share of the order-level difference (order total minus line sum) per line.

    The line sum per order is a partial aggregate joined back (no partition-only window)."""
    j = with_group_agg(lines, [order], F.sum(line_amount).alias("_lines_total"))
    share = safe_divide(F.col(line_amount), F.col("_lines_total"))
    return j.withColumn("allocated_adjustment", (F.col(order_total) - F.col("_lines_total")) * share) \
        .withColumn("line_share", share).drop("_lines_total")


def rotation_by_day(lines: DataFrame, products: DataFrame, product: str, dims: Sequence[str], date: str, qty: str, margin: Column, pack: str, active: Column, as_of, months: int) -> DataFrame:
    """K73 per day: units sold, average margin and average pack size of the products that are active now, over the last ``months`` full
    months. ``dims`` are product columns to keep; inactive and unknown products are left out."""
    end = F.to_date(F.date_trunc("month", F.lit(as_of).cast("date")))
    d = F.to_date(F.col(date))
    x = lines.filter((d >= F.add_months(end, -months)) & (d < end)).join(products.filter(active), product)
    return x.groupBy(d.alias("d"), product, *dims).agg(F.sum(qty).cast("long").alias("units"), F.avg(margin).alias("margin"), F.round(F.avg(pack)).cast("long").alias("pack_size"))


def rotation(lines: DataFrame, product: str, date: str, qty: str, margin: Column, as_of, months: int) -> DataFrame:
    """Units, margin and number of active months over the last ``months`` full months."""
    end = F.to_date(F.date_trunc("month", F.lit(as_of).cast("date")))
    start = F.add_months(end, -months)
    d = F.to_date(F.col(date))
    x = lines.filter((d >= start) & (d < end))
    return x.groupBy(product).agg(F.sum(qty).alias("units"), F.sum(margin).alias("margin"),
                                  F.countDistinct(F.date_trunc("month", d)).alias("active_months"))


def monthly_kpis(df: DataFrame, keys: Sequence[str], date: str, measures: Sequence[Column]) -> DataFrame:
    """Monthly aggregates with the previous month's values and an aligned month rank.

    The window runs over the monthly aggregate (one row per key and month)."""
    m = df.groupBy(*keys, F.to_date(F.date_trunc("month", F.col(date))).alias("month")).agg(*measures)
    names = [c for c in m.columns if c not in (*keys, "month")]
    w = Window.partitionBy(*keys).orderBy("month")
    out = m.withColumn("month_rank", F.dense_rank().over(w))
    for n in names:
        out = out.withColumn(f"previous_{n}", F.lag(n).over(w))
    return out


def order_and_product_scopes(lines: DataFrame, order: str, product: str, measures: dict) -> DataFrame:
    """K107: the same measures at order grain and at product grain, stacked with a scope column.

    One scan: each line is emitted for both grains via explode, then one aggregate."""
    x = lines.withColumn("_scope", F.explode(F.array(F.lit("order"), F.lit("product"))))
    key = F.when(F.col("_scope") == "order", F.col(order).cast("string")).otherwise(F.col(product).cast("string"))
    return x.groupBy(F.col("_scope").alias("scope"), key.alias("scope_key")).agg(
        *[agg.alias(n) for n, agg in measures.items()])
