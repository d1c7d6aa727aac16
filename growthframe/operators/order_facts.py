"""Order facts, products and omnichannel customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.formatting import age_bucket
from growthframe.functions.semantics import iso_weekday, regex_group, round_half_up, safe_divide
from growthframe.operators.common import bucketed_row_number, explode_scopes


def enriched_orders(orders: DataFrame, customers: DataFrame, customer: str, date: str, order_id: str,
                    as_of, dob: str | None = None, discount: str | None = None, paid: str | None = None) -> DataFrame:
    """Order fact with ISO weekday and name, day period, customer seniority in days at the
    order, age range, order rank of the customer and first-order flag; with ``discount`` and ``paid`` the promotion rate (share
    of the discount in the full price, percent, one decimal) and whether there was a discount.

    The order rank is a month-bucketed row number (skew-safe); seniority uses the customer's
    first order as a pre-aggregated minimum joined back."""
    d = F.col(date)
    first = orders.groupBy(customer).agg(F.min(date).alias("_first"))
    x = orders.join(first, customer).join(customers, customer, "left")
    hour = F.hour(d)
    period = (F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "afternoon")
              .otherwise("evening"))
    x = bucketed_row_number(x, [customer], date, order_id, "order_rank")
    out = x.select("*", iso_weekday(d).alias("weekday_number"), F.date_format(d, "EEEE").alias("weekday_name"),
                   period.alias("day_period"),
                   F.datediff(F.to_date(d), F.to_date("_first")).alias("seniority_days"))
    out = out.withColumn("is_first_order", F.col("order_rank") == 1)
    if discount and paid:
        off, full = F.col(discount), F.col(discount) + F.col(paid)
        out = out.withColumn("promotion_rate", round_half_up(100 * safe_divide(off, full), 1)).withColumn("with_discount", off > 0)
    if dob:
        from growthframe.functions.semantics import age_years
        out = out.withColumn("age_range", age_bucket(age_years(dob, F.lit(as_of))))
    return out.drop("_first")


def eav_labels(products: DataFrame, attributes: DataFrame, json_col: str, codes: dict[str, bool]) -> DataFrame:
    """A JSON list of (attribute_code, value) per product to attribute ids and labels.

    ``codes`` = attribute code -> multi-valued (comma separated ids). The JSON is parsed once
    to a map; ids are exploded and resolved with ONE equi-join on (code, id) against the
    option table, then regrouped per product; single-valued codes keep one label."""
    arr = F.from_json(F.col(json_col), "array<struct<attribute_code:string,value:string>>")
    base = products.withColumn("_m", arr)

    def first(code: str) -> Column:  # of a repeated code the first value counts
        return F.get(F.filter("_m", lambda e: e["attribute_code"] == code), F.lit(0))["value"]

    ids = base.select(
        "product_id",
        F.explode(F.array(*[F.struct(F.lit(c).alias("attribute_code"), first(c).alias("raw"))
                            for c in codes])).alias("a")).select("product_id", "a.*")
    ids = ids.withColumn("option_id", F.explode(F.split(F.col("raw"), ","))).withColumn("option_id",
                                                                                          F.trim("option_id"))
    lab = ids.join(attributes, ["attribute_code", "option_id"], "left")
    g = lab.groupBy("product_id").pivot("attribute_code", list(codes)).agg(
        F.array_join(F.array_sort(F.collect_list("label")), ", "))
    return products.drop(json_col).join(g, "product_id", "left")


def order_line_facts(lines: DataFrame, parts: DataFrame, customers_channel: DataFrame, qty: str = "ordered") -> DataFrame:
    """Per order line: net quantity (returned lines count 0), revenue after discount,
    cost, guarded margin rate, carrier parsed from the product name (NULL when no match),
    brand-active flag and B2B / B2C channel. ``qty`` picks ordered or invoiced quantity (M28)."""
    x = lines.join(parts, "part_id", "left").join(customers_channel, "customer_id", "left")
    q = F.col("quantity") if qty == "ordered" else F.when(F.col("returnflag") == "R", 0.0).otherwise(F.col("quantity"))
    net = F.when(F.col("returnflag") == "R", 0.0).otherwise(F.col("quantity"))
    revenue = F.col("extendedprice") * (1 - F.col("discount"))
    cost = F.col("retailprice") * q * 0.6
    return x.select("order_id", "line_number", "part_id", "customer_id", net.alias("net_quantity"),
                    F.round(revenue, 4).alias("revenue"), F.round(cost, 4).alias("cost"),
                    F.round(safe_divide(revenue - cost, revenue), 6).alias("margin_rate"),
                    regex_group("part_name", r"^(\w+) ", 1).alias("carrier"),
                    (F.col("brand_number") % 2 == 0).alias("brand_active"),
                    F.when(F.col("segment") == "AUTOMOBILE", "B2B").otherwise("B2C").alias("channel"))


def option_flags(lines: DataFrame, order: str, line: str, options: str) -> DataFrame:
    """Nested option rows (array of struct(code, values array)) to per-line booleans and
    per-order ``bool_or``. Double explode inside one projection via ``exists``."""
    def has(code: str) -> Column:
        return F.exists(F.col(options), lambda o: (o["code"] == code) & F.exists(o["values"], lambda v: v == "yes"))
    per_line = lines.select(order, line, has("gift").alias("is_gift"), has("engraving").alias("has_engraving"))
    per_order = per_line.groupBy(order).agg(F.bool_or("is_gift").alias("order_has_gift"),
                                            F.bool_or("has_engraving").alias("order_has_engraving"))
    return per_line.join(per_order, order)


def new_product_sales(lines: DataFrame, product: str, date: str, qty: str, new_days: int = 90) -> DataFrame:
    """Sales scopes stacked with a scope column: 'new' (inside the product's "new"
    interval [first sale, first sale + new_days)), 'all'; and 'created' = products first
    sold that day. Lines are first added up per product and day: such a row counts its product once in a day, so nothing is
    counted as distinct after that, and the creation date is a minimum over a product's days."""
    days = lines.groupBy(product, F.to_date(F.col(date)).alias("d")).agg(F.sum(qty).alias("_qty"))
    x = days.withColumn("_created", F.min("d").over(Window.partitionBy(product)))  # one row per product and day
    known = F.col(product).isNotNull()
    is_new = known & (F.col("d") >= F.col("_created")) & (F.col("d") < F.date_add("_created", new_days))
    scopes = [("new", is_new), ("all", known), ("created", F.col("d").eqNullSafe(F.col("_created")))]
    return explode_scopes(x, scopes).groupBy("scope", "d").agg(
        F.sum(F.when(F.col("scope") != "created", F.col("_qty"))).cast("double").alias("quantity"), F.count("*").alias("products"))


def first_vs_period_buyer(orders: DataFrame, customer: str, store: str, date: str, start, end) -> DataFrame:
    """Per store, customers buying in [start, end] split into 'new' (first purchase in
    the store inside the period) and 'former' (bought there before the period)."""
    d = F.to_date(F.col(date))
    first = orders.groupBy(customer, store).agg(F.min(d).alias("first_in_store"))
    inp = orders.filter(d.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select(customer, store) \
        .distinct().join(first, [customer, store])
    lab = F.when(F.col("first_in_store") < F.lit(start).cast("date"), "former").otherwise("new")
    return inp.groupBy(store, lab.alias("buyer_type")).agg(F.count("*").alias("customers"))


def customer_day_revenue(orders: DataFrame, lines: DataFrame, customers: DataFrame, order: str, customer: str,
                         date: str, amount: str, qty: str, demo: Sequence[str]) -> DataFrame:
    """Per day and customer: orders, revenue, units, with demographics. Units are
    pre-aggregated per order before the join (pre-aggregate before join)."""
    units = lines.groupBy(order).agg(F.sum(qty).alias("units"))
    x = orders.join(units, order, "left")
    g = x.groupBy(F.to_date(F.col(date)).alias("day"), customer).agg(
        F.countDistinct(order).alias("orders"), F.sum(amount).alias("revenue"), F.sum("units").alias("units"))
    return g.join(customers.select(customer, *demo), customer, "left")


# Comment patterns that carry a refunded amount, tried in this order.
REFUND_PATTERNS = [
    r"Nous avons remboursé ([0-9]+(?:\.[0-9]+)?) €",
    r"We refunded €([0-9]+(?:\.[0-9]+)?)",
    r"([0-9]+(?:\.[0-9]+)?) € \(dans la devise de base du magasin\)",
    r"€([0-9]+(?:\.[0-9]+)?) \(in store's base currency\)",
    r"Gift card was created for refund for amount ([0-9]+(?:\.[0-9]+)?) with code",
]


def refund_amount(comment: str | Column, patterns=REFUND_PATTERNS) -> Column:
    """Refunded amount found in an order comment: the first pattern that matches wins, 0 when
    none does (regex misses are NULL, M2)."""
    return F.coalesce(*[regex_group(comment, p, 1).cast("double") for p in patterns], F.lit(0.0))


def omnichannel_daily(web: DataFrame, retail: DataFrame, customer: str, date: str, amount: str, store: str,
                      comment: str) -> DataFrame:
    """Two order systems unified per day and customer: web and retail revenue, refunds
    parsed from order comments (:data:`REFUND_PATTERNS`), distinct stores over the customer's
    whole history (pre-aggregated distinct count joined back, not COUNT(DISTINCT) OVER)."""
    w = web.select(customer, F.to_date(F.col(date)).alias("day"), F.col(amount).alias("web_revenue"),
                   F.lit(0.0).alias("retail_revenue"), F.lit(0.0).alias("refunds"), F.col(store).alias("store"))
    refund = refund_amount(comment)
    r = retail.select(customer, F.to_date(F.col(date)).alias("day"), F.lit(0.0).alias("web_revenue"),
                      F.col(amount).alias("retail_revenue"), refund.alias("refunds"), F.col(store).alias("store"))
    u = w.unionByName(r)
    stores = u.groupBy(customer).agg(F.countDistinct("store").alias("distinct_stores"))
    g = u.groupBy("day", customer).agg(F.sum("web_revenue").alias("web_revenue"),
                                       F.sum("retail_revenue").alias("retail_revenue"),
                                       F.sum("refunds").alias("refunds"))
    return g.join(stores, customer)


def store_clusters(orders: DataFrame, stores: DataFrame, customer: str, store: str, clusters: Sequence[str]) -> DataFrame:
    """Per customer and store the clusters of the store, how many stores each cluster has, and in how many stores of it the
    customer has bought. Distinct pairs are formed once; the counts come from them, not from windows over the orders."""
    pairs = orders.select(customer, store).distinct().join(stores, store, "left")
    out = pairs
    for c in clusters:
        # NULL clusters are a group, as in a window partition
        size = pairs.select(F.struct(c).alias("_c"), store).distinct().groupBy("_c").agg(F.count(store).alias(f"{c}_stores"))
        own = pairs.groupBy(F.struct(customer, c).alias("_o")).agg(F.count(store).alias(f"customer_{c}_stores"))
        out = out.withColumn("_c", F.struct(c)).withColumn("_o", F.struct(customer, c)).join(size, "_c").join(own, "_o").drop("_c", "_o")
    return out


def gift_card_adjusted(orders: DataFrame, items: DataFrame, order: str, amount: str, name: str, qty: str, price: str, comment: str, card: str = "Carte cadeau") -> DataFrame:
    """Revenue without gift cards and refunds: of each order the amount, the gift cards bought in it (of several card lines the
    dearest), the refund named in its comment, and what is left, 0 at least."""
    cards = items.groupBy(order).agg(F.max(F.when(F.col(name) == card, F.coalesce(qty, F.lit(0)) * F.coalesce(price, F.lit(0.0))).otherwise(0.0)).alias("gift_cards"))
    x = orders.join(cards, order, "left").fillna(0.0, ["gift_cards"]).withColumn("refund", refund_amount(comment))
    return x.withColumn("net_revenue", F.greatest(F.lit(0.0), F.col(amount) - F.col("gift_cards") - F.col("refund")))
