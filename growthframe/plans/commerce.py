"""Paired queries for order lines, products and order facts (K51-K53, K69-K78, K106-K108).

Stand-ins: order line = ``lineitem`` (no unique key: outputs are compared as multisets),
category = ``p_type``, product = ``l_partkey``, store = ``o_orderpriority``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from growthframe.functions.formatting import AGE_BANDS, AGE_TOP_BAND
from growthframe.functions.semantics import round_half_up
from growthframe.operators import order_facts as OF
from growthframe.operators import orders as OR
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

R2 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"
R4 = "CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 4) AS DOUBLE)"
R6 = "CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)"


def _lines(spark, sf):
    li = load(spark, sf, "lineitem")
    p = load(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey)


@paired("k51_dominant_category", """
WITH per AS (SELECT l_orderkey, p_type, SUM(l_quantity) AS cat_qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
m AS (SELECT *, MAX(cat_qty) OVER (PARTITION BY l_orderkey) AS mx FROM per)
SELECT l_orderkey, array_to_string(list_sort(list(p_type)), ',') AS dominant_categories, MAX(cat_qty) AS dominant_qty,
       CASE WHEN COUNT(*) = 1 THEN MIN(p_type) ELSE 'mixed' END AS persona
FROM m WHERE cat_qty = mx GROUP BY 1
""", covers=("K51", "A18", "A14"))
def k51(spark, sf):
    d = OR.dominant_category(_lines(spark, sf), "l_orderkey", "p_type", "l_quantity")
    return d.select("l_orderkey", F.array_join("dominant_categories", ",").alias("dominant_categories"),
                    "dominant_qty", "persona")


@paired("k53_product_period_compare", f"""
WITH x AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, l_extendedprice, l_quantity FROM lineitem
           WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
              OR CAST(l_shipdate AS DATE) BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'),
g AS (SELECT l_partkey,
  SUM(CASE WHEN d >= DATE '2000-01-01' THEN l_quantity ELSE 0 END) AS qty_current,
  SUM(CASE WHEN d < DATE '2000-01-01' THEN l_quantity ELSE 0 END) AS qty_previous,
  SUM(CASE WHEN d >= DATE '2000-01-01' THEN l_extendedprice ELSE 0 END) AS rc,
  SUM(CASE WHEN d < DATE '2000-01-01' THEN l_extendedprice ELSE 0 END) AS rp FROM x GROUP BY 1)
SELECT l_partkey, qty_current, qty_previous, {R2.format(x="rc / NULLIF(qty_current, 0)")} AS unit_price_current,
  {R2.format(x="rp / NULLIF(qty_previous, 0)")} AS unit_price_previous,
  {R2.format(x="(qty_current - qty_previous) / NULLIF(qty_previous, 0) * 100")} AS qty_change_pct
FROM g
""", covers=("K53", "A19", "A3"))
def k53(spark, sf):
    li = load(spark, sf, "lineitem")
    return OR.product_period_compare(li, "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity",
                                     ("2000-01-01", "2000-12-31"), ("1999-01-01", "1999-12-31"))


@paired("k69_multi_value_breakdown", """
WITH x AS (SELECT l_orderkey, l_quantity, trim(unnest(string_split(p_name, ' '))) AS value
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT value, COUNT(*) AS lines, SUM(l_quantity) AS quantity, COUNT(DISTINCT l_orderkey) AS orders FROM x GROUP BY 1
""", covers=("K69", "F-s5", "J14"))
def k69(spark, sf):
    return OR.multi_value_breakdown(_lines(spark, sf), "p_name", " ", [
        F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.countDistinct("l_orderkey").alias("orders")])


_EAV_SQL = """
WITH prod AS (
  SELECT p_partkey AS product_id, p_name,
    '[{"attribute_code":"brand","value":"' || regexp_extract(p_brand, '#(\\d+)', 1) || '"},{"attribute_code":"size","value":"'
      || CAST(p_size AS VARCHAR) || ',' || CAST(p_size % 10 AS VARCHAR) || '"}]' AS custom_attributes
  FROM part),
opts AS (
  SELECT DISTINCT 'brand' AS attribute_code, regexp_extract(p_brand, '#(\\d+)', 1) AS option_id, p_brand AS label FROM part
  UNION ALL
  SELECT DISTINCT 'size', CAST(p_size AS VARCHAR), 'size ' || CAST(p_size AS VARCHAR) FROM part),
ids AS (
  SELECT product_id, 'brand' AS attribute_code, json_extract_string(custom_attributes, '$[0].value') AS raw FROM prod
  UNION ALL SELECT product_id, 'size', json_extract_string(custom_attributes, '$[1].value') FROM prod),
ex AS (SELECT product_id, attribute_code, trim(unnest(string_split(raw, ','))) AS option_id FROM ids),
lab AS (SELECT ex.product_id, ex.attribute_code, o.label FROM ex LEFT JOIN opts o USING (attribute_code, option_id))
SELECT p.product_id, p.p_name,
  (SELECT array_to_string(list_sort(list(label)), ', ') FROM lab l WHERE l.product_id = p.product_id AND l.attribute_code = 'brand' AND label IS NOT NULL) AS brand,
  (SELECT array_to_string(list_sort(list(label)), ', ') FROM lab l WHERE l.product_id = p.product_id AND l.attribute_code = 'size' AND label IS NOT NULL) AS size
FROM prod p
"""


@paired("k70_eav_labels", _EAV_SQL, covers=("K70", "F-j2", "J14", "A12"))
def k70(spark, sf):
    p = load(spark, sf, "part")
    brand_no = F.regexp_extract("p_brand", r"#(\d+)", 1)
    prod = p.select(F.col("p_partkey").alias("product_id"), "p_name", F.concat(
        F.lit('[{"attribute_code":"brand","value":"'), brand_no, F.lit('"},{"attribute_code":"size","value":"'),
        F.col("p_size").cast("string"), F.lit(","), (F.col("p_size") % 10).cast("string"), F.lit('"}]'))
        .alias("custom_attributes"))
    opts = p.select(F.lit("brand").alias("attribute_code"), brand_no.alias("option_id"),
                    F.col("p_brand").alias("label")).distinct().unionByName(
        p.select(F.lit("size").alias("attribute_code"), F.col("p_size").cast("string").alias("option_id"),
                 F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("label")).distinct())
    out = OF.eav_labels(prod, opts, "custom_attributes", {"brand": False, "size": True})
    return out.select("product_id", "p_name", F.when(F.col("brand") != "", F.col("brand")).alias("brand"),
                      F.when(F.col("size") != "", F.col("size")).alias("size"))


@paired("k71_order_line_facts", r"""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS part_id, o.o_custkey AS customer_id,
  CASE WHEN l.l_returnflag = 'R' THEN 0.0 ELSE l.l_quantity END AS net_quantity,
  ROUND(l.l_extendedprice * (1 - l.l_discount), 4) AS revenue,
  ROUND(p.p_retailprice * l.l_quantity * 0.6, 4) AS cost,
  ROUND((l.l_extendedprice * (1 - l.l_discount) - p.p_retailprice * l.l_quantity * 0.6)
        / NULLIF(l.l_extendedprice * (1 - l.l_discount), 0), 6) AS margin_rate,
  NULLIF(regexp_extract(p.p_name, '^(\w+) ', 1), '') AS carrier,
  CAST(regexp_extract(p.p_brand, '#(\d+)', 1) AS INTEGER) % 2 = 0 AS brand_active,
  CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'B2B' ELSE 'B2C' END AS channel
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""", covers=("K71", "M28", "F-s3", "M2", "J20"))
def k71(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("part_id"), "customer_id", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"), F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("returnflag"))
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("part_name"),
                                       F.col("p_retailprice").alias("retailprice"),
                                       F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int").alias("brand_number"))
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return OF.order_line_facts(lines, p, c)


@paired("k72_option_flags", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_tax > 0.04 AS is_gift, l_discount >= 0.08 AS has_engraving FROM lineitem),
o AS (SELECT l_orderkey, bool_or(is_gift) AS order_has_gift, bool_or(has_engraving) AS order_has_engraving FROM l GROUP BY 1)
SELECT l.*, o.order_has_gift, o.order_has_engraving FROM l JOIN o USING (l_orderkey)
""", covers=("K72", "A14", "F-a2"))
def k72(spark, sf):
    li = load(spark, sf, "lineitem")
    opts = F.array(
        F.struct(F.lit("gift").alias("code"),
                 F.array(F.when(F.col("l_tax") > 0.04, "yes").otherwise("no")).alias("values")),
        F.struct(F.lit("engraving").alias("code"),
                 F.array(F.when(F.col("l_discount") >= 0.08, "yes").otherwise("no"), F.lit("no")).alias("values")))
    x = li.select("l_orderkey", "l_linenumber", opts.alias("options"))
    return OF.option_flags(x, "l_orderkey", "l_linenumber", "options")


@paired("k73_rotation", f"""
WITH x AS (SELECT l.*, p.p_retailprice FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
           WHERE CAST(l_shipdate AS DATE) >= DATE '2000-12-01' AND CAST(l_shipdate AS DATE) < DATE '2001-06-01')
SELECT l_partkey, SUM(l_quantity) AS units,
  {R2.format(x="SUM(l_extendedprice * (1 - l_discount) - p_retailprice * l_quantity * 0.6)")} AS margin,
  COUNT(DISTINCT date_trunc('month', l_shipdate)) AS active_months
FROM x GROUP BY 1
""", covers=("K73",))
def k73(spark, sf):
    x = _lines(spark, sf)
    margin = F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("p_retailprice") * F.col("l_quantity") * 0.6
    r = OR.rotation(x, "l_partkey", "l_shipdate", "l_quantity", margin, "2001-06-15", 6)
    return r.withColumn("margin", round_half_up("margin", 2))


@paired("k75_monthly_kpis", f"""
WITH m AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  {R2.format(x="SUM(o_totalprice)")} AS revenue, COUNT(*) AS orders FROM orders GROUP BY 1, 2)
SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY month) AS INTEGER) AS month_rank,
  LAG(revenue) OVER (PARTITION BY o_orderpriority ORDER BY month) AS previous_revenue,
  LAG(orders) OVER (PARTITION BY o_orderpriority ORDER BY month) AS previous_orders
FROM m
""", covers=("K75", "W3", "W5", "W6", "M16"))
def k75(spark, sf):
    o = load(spark, sf, "orders")
    return OR.monthly_kpis(o, ["o_orderpriority"], "o_orderdate",
                           [round_half_up(F.sum("o_totalprice"), 2).alias("revenue"), F.count("*").alias("orders")])


@paired("k76_omnichannel_daily", f"""
WITH u AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS web_revenue, 0.0 AS retail_revenue, 0.0 AS refunds,
         o_orderpriority AS store FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT o_custkey, CAST(o_orderdate AS DATE), 0.0, o_totalprice,
         CASE WHEN o_orderstatus = 'P' THEN CAST(ROUND(CAST(o_totalprice * 0.1 AS DECIMAL(38,6)), 2) AS DOUBLE) ELSE 0.0 END, o_orderpriority
  FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')),
s AS (SELECT o_custkey, COUNT(DISTINCT store) AS distinct_stores FROM u GROUP BY 1)
SELECT day, o_custkey, {R2.format(x="SUM(web_revenue)")} AS web_revenue, {R2.format(x="SUM(retail_revenue)")} AS retail_revenue,
       {R2.format(x="SUM(refunds)")} AS refunds, MAX(s.distinct_stores) AS distinct_stores
FROM u JOIN s USING (o_custkey) GROUP BY 1, 2
""", covers=("K76", "W14", "F-s3", "U1"))
def k76(spark, sf):
    o = load(spark, sf, "orders")
    web = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    amt = F.format_string("%.2f", round_half_up(F.col("o_totalprice") * 0.1, 2))
    # stand-in comments in two of the recognised wordings (by order key parity)
    text = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("We refunded €"), amt)) \
        .otherwise(F.concat(F.lit("Gift card was created for refund for amount "), amt, F.lit(" with code GC")))
    retail = o.filter(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).withColumn(
        "comment", F.when(F.col("o_orderstatus") == "P", text).otherwise(F.lit("ok")))
    web = web.withColumn("comment", F.lit(None).cast("string"))
    out = OF.omnichannel_daily(web, retail, "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "comment")
    return out.select("day", "o_custkey", round_half_up("web_revenue", 2).alias("web_revenue"),
                      round_half_up("retail_revenue", 2).alias("retail_revenue"),
                      round_half_up("refunds", 2).alias("refunds"), "distinct_stores")


@paired("k77_first_vs_period_buyer", """
WITH f AS (SELECT o_custkey, o_orderpriority, MIN(CAST(o_orderdate AS DATE)) AS first_in_store FROM orders GROUP BY 1, 2),
p AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders
      WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31')
SELECT o_orderpriority, CASE WHEN f.first_in_store < DATE '1998-01-01' THEN 'former' ELSE 'new' END AS buyer_type,
       COUNT(*) AS customers
FROM p JOIN f USING (o_custkey, o_orderpriority) GROUP BY 1, 2
""", covers=("K77", "W15"))
def k77(spark, sf):
    o = load(spark, sf, "orders")
    return OF.first_vs_period_buyer(o, "o_custkey", "o_orderpriority", "o_orderdate", "1998-01-01", "1998-12-31")


@paired("k78_customer_day_revenue", f"""
WITH u AS (SELECT l_orderkey, SUM(l_quantity) AS units FROM lineitem GROUP BY 1),
g AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey, COUNT(DISTINCT o_orderkey) AS orders,
             {R2.format(x="SUM(o_totalprice)")} AS revenue, SUM(units) AS units
      FROM orders LEFT JOIN u ON u.l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT g.*, c.c_nationkey, c.c_mktsegment FROM g LEFT JOIN customer c ON c.c_custkey = g.o_custkey
""", covers=("K78", "A15", "J20"))
def k78(spark, sf):
    o = load(spark, sf, "orders")
    li = load(spark, sf, "lineitem")
    c = load(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    li = li.withColumnRenamed("l_orderkey", "o_orderkey")
    out = OF.customer_day_revenue(o, li, c, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "l_quantity",
                                  ["c_nationkey", "c_mktsegment"])
    return out.withColumn("revenue", round_half_up("revenue", 2))


@paired("k106_allocate_discount", f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS line_amount FROM lineitem),
s AS (SELECT l_orderkey, SUM(line_amount) AS lt FROM l GROUP BY 1)
SELECT l.l_orderkey, l.l_linenumber, {R2.format(x="l.line_amount")} AS line_amount,
  {R2.format(x="(o.o_totalprice - s.lt) * (l.line_amount / NULLIF(s.lt, 0))")} AS allocated_adjustment,
  {R6.format(x="l.line_amount / NULLIF(s.lt, 0)")} AS line_share
FROM l JOIN s USING (l_orderkey) JOIN orders o ON o.o_orderkey = l.l_orderkey
""", covers=("K106", "W13", "A6"))
def k106(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_amount"))
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    a = OR.allocate_discount(li.join(o, "l_orderkey"), "l_orderkey", "line_amount", "o_totalprice")
    return a.select("l_orderkey", "l_linenumber", round_half_up("line_amount", 2).alias("line_amount"),
                    round_half_up("allocated_adjustment", 2).alias("allocated_adjustment"),
                    round_half_up("line_share", 6).alias("line_share"))


@paired("k107_order_and_product_scopes", f"""
SELECT 'order' AS scope, CAST(l_orderkey AS VARCHAR) AS scope_key, {R2.format(x="SUM(l_extendedprice * (1 - l_discount) / (1 + l_tax))")} AS revenue_excl_tax,
       COUNT(*) AS lines, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2
UNION ALL
SELECT 'product', CAST(l_partkey AS VARCHAR), {R2.format(x="SUM(l_extendedprice * (1 - l_discount) / (1 + l_tax))")},
       COUNT(*), SUM(l_quantity) FROM lineitem GROUP BY 1, 2
""", covers=("K107", "U1"))
def k107(spark, sf):
    li = load(spark, sf, "lineitem")
    out = OR.order_and_product_scopes(li, "l_orderkey", "l_partkey", {
        "revenue_excl_tax": F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) / (1 + F.col("l_tax"))),
        "lines": F.count("*"), "quantity": F.sum("l_quantity")})
    return out.withColumn("revenue_excl_tax", round_half_up("revenue_excl_tax", 2))


@paired("k108_main_reason", """
WITH c AS (SELECT l_orderkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
m AS (SELECT *, MAX(n) OVER (PARTITION BY l_orderkey) AS mx FROM c),
t AS (SELECT * FROM m WHERE n = mx)
SELECT l_orderkey, CASE WHEN COUNT(*) = 1 THEN MIN(l_returnflag) END AS main_reason, MAX(n) AS reason_count
FROM t GROUP BY 1
""", covers=("K108", "A18"))
def k108(spark, sf):
    return OR.main_reason(load(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag")


@paired("k52_enriched_orders", """
WITH f AS (SELECT o_custkey, MIN(o_orderdate) AS first_ts FROM orders GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, (dayofweek(o.o_orderdate) + 6) % 7 + 1 AS weekday_number,
  dayname(o.o_orderdate) AS weekday_name,
  CASE WHEN hour(o.o_orderdate) < 6 THEN 'night' WHEN hour(o.o_orderdate) < 12 THEN 'morning'
       WHEN hour(o.o_orderdate) < 18 THEN 'afternoon' ELSE 'evening' END AS day_period,
  date_diff('day', CAST(f.first_ts AS DATE), CAST(o.o_orderdate AS DATE)) AS seniority_days,
  ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) AS order_rank,
  ROW_NUMBER() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey) = 1 AS is_first_order
FROM orders o JOIN f USING (o_custkey) LEFT JOIN customer c ON c.c_custkey = o.o_custkey
""", covers=("K52", "F-d8", "M6", "W1", "F-d2"))
def k52(spark, sf):
    o = load(spark, sf, "orders")
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    e = OF.enriched_orders(o, c, "o_custkey", "o_orderdate", "o_orderkey", "2001-08-01")
    return e.select("o_orderkey", "o_custkey", "c_mktsegment", F.col("weekday_number").cast("long").alias("weekday_number"),
                    "weekday_name", "day_period", F.col("seniority_days").cast("long").alias("seniority_days"),
                    F.col("order_rank").cast("long").alias("order_rank"), "is_first_order")


@paired("k52_promotion_and_age", f"""
WITH l AS (SELECT l_orderkey, SUM(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4))) AS off, SUM(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS paid FROM lineitem GROUP BY 1),
c AS (SELECT c_custkey, CASE WHEN c_custkey % 17 > 0 THEN DATE '1930-01-15' + CAST((c_custkey * 3701) % 27000 AS INTEGER) END AS dob FROM customer),
a AS (SELECT c_custkey, CAST(date_diff('year', dob, DATE '2001-08-01') AS INTEGER) - CASE WHEN strftime(dob, '%m-%d') > '08-01' THEN 1 ELSE 0 END AS age FROM c)
SELECT o.o_orderkey, CAST(ROUND(CAST(100 * CAST(off AS DOUBLE) / NULLIF(CAST(off + paid AS DOUBLE), 0) AS DECIMAL(38, 6)), 1) AS DOUBLE) AS promotion_rate, off > 0 AS with_discount,
  CASE WHEN age IS NULL THEN NULL {" ".join(f"WHEN age < {hi} THEN '{label}'" for hi, label in AGE_BANDS)} ELSE '{AGE_TOP_BAND}' END AS age_range
FROM orders o JOIN l ON l.l_orderkey = o.o_orderkey LEFT JOIN a ON a.c_custkey = o.o_custkey
""", covers=("K52", "F-d11", "X2"))
def k52_promotion(spark, sf):
    price, off = F.col("l_extendedprice"), F.col("l_discount")
    li = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum((price * off).cast("decimal(18,4)")).cast("double").alias("off"), F.sum((price * (1 - off)).cast("decimal(18,4)")).cast("double").alias("paid"))
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate").join(li, "o_orderkey")
    k = F.col("c_custkey")
    c = load(spark, sf, "customer").select(k.alias("o_custkey"), F.when(k % 17 > 0, F.date_add(F.lit("1930-01-15").cast("date"), ((k * 3701) % 27000).cast("int"))).alias("dob"))
    e = OF.enriched_orders(o, c, "o_custkey", "o_orderdate", "o_orderkey", dt.date(2001, 8, 1), dob="dob", discount="off", paid="paid")
    return e.select("o_orderkey", "promotion_rate", "with_discount", "age_range")


@paired("k71_order_line_facts_invoiced", r"""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number,
  CASE WHEN l.l_returnflag = 'R' THEN 0.0 ELSE l.l_quantity END AS net_quantity,
  ROUND(p.p_retailprice * CASE WHEN l.l_returnflag = 'R' THEN 0 ELSE l.l_quantity END * 0.6, 4) AS cost,
  ROUND((l.l_extendedprice * (1 - l.l_discount) - p.p_retailprice * CASE WHEN l.l_returnflag = 'R' THEN 0 ELSE l.l_quantity END * 0.6)
        / NULLIF(l.l_extendedprice * (1 - l.l_discount), 0), 6) AS margin_rate
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
""", covers=("K71", "M28"))
def k71_invoiced(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    lines = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"), F.col("l_partkey").alias("part_id"), "customer_id", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extendedprice"), F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("returnflag"))
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("part_name"), F.col("p_retailprice").alias("retailprice"),
                                       F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int").alias("brand_number"))
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))
    return OF.order_line_facts(lines, p, c, qty="invoiced").select("order_id", "line_number", "net_quantity", "cost", "margin_rate")


@paired("k73_rotation_active_packs", f"""
SELECT CAST(l_shipdate AS DATE) AS d, l_partkey, p_brand, CAST(SUM(l_quantity) AS BIGINT) AS units, {R2.format(x="AVG(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4)))")} AS margin,
       CAST(ROUND(AVG(p_size)) AS BIGINT) AS pack_size
FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE p_partkey % 4 <> 0 AND CAST(l_shipdate AS DATE) >= DATE '2000-12-01' AND CAST(l_shipdate AS DATE) < DATE '2001-06-01' GROUP BY ALL
""", covers=("K73", "J1"))
def k73_packs(spark, sf):
    li = load(spark, sf, "lineitem")
    p = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    margin = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    x = OR.rotation_by_day(li, p, "l_partkey", ["p_brand"], "l_shipdate", "l_quantity", margin, "p_size", F.col("l_partkey") % 4 != 0, "2001-06-15", 6)
    return x.withColumn("margin", round_half_up(F.col("margin").cast("double"), 2))


# Stand-ins: store = order key modulo 12; two kinds of clusters, the first missing for some stores.
@paired("k76_store_clusters", """
WITH o AS (SELECT o_custkey, o_orderkey % 12 AS store FROM orders),
p AS (SELECT DISTINCT o_custkey, store, CASE WHEN store % 5 > 0 THEN 'geo ' || CAST(store % 5 AS VARCHAR) END AS geo, 'rank ' || CAST(store % 3 AS VARCHAR) AS ca FROM o),
g AS (SELECT geo, COUNT(DISTINCT store) AS n FROM p GROUP BY 1), c AS (SELECT ca, COUNT(DISTINCT store) AS n FROM p GROUP BY 1)
SELECT p.*, g.n AS geo_stores, COUNT(*) OVER (PARTITION BY o_custkey, p.geo) AS customer_geo_stores, c.n AS ca_stores, COUNT(*) OVER (PARTITION BY o_custkey, p.ca) AS customer_ca_stores
FROM p JOIN g ON g.geo IS NOT DISTINCT FROM p.geo JOIN c ON c.ca = p.ca
""", covers=("K76", "W14"))
def k76_clusters(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", (F.col("o_orderkey") % 12).alias("store"))
    s = F.col("store")
    stores = o.select("store").distinct().select("store", F.when(s % 5 > 0, F.concat(F.lit("geo "), (s % 5).cast("string"))).alias("geo"), F.concat(F.lit("rank "), (s % 3).cast("string")).alias("ca"))
    return OF.store_clusters(o, stores, "o_custkey", "store", ["geo", "ca"]).select("o_custkey", "store", "geo", "ca", "geo_stores", "customer_geo_stores", "ca_stores", "customer_ca_stores")


@paired("k76_gift_card_adjusted", f"""
WITH i AS (SELECT l_orderkey, MAX(CASE WHEN l_linenumber % 4 = 1 THEN (CASE WHEN l_linenumber = 5 THEN 0 ELSE l_quantity END) * l_tax ELSE 0 END) AS cards FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey % 900 AS DOUBLE) + 0.5 ELSE 0 END AS refund FROM orders)
SELECT o.o_orderkey, {R2.format(x="COALESCE(cards, 0)")} AS gift_cards, refund, {R2.format(x="greatest(0, o_totalprice - COALESCE(cards, 0) - refund)")} AS net_revenue FROM o LEFT JOIN i ON i.l_orderkey = o.o_orderkey
""", covers=("K76", "F-s3", "M2"))
def k76_gift_cards(spark, sf):
    k = F.col("o_orderkey")
    amount = (k % 900).cast("string")
    text = F.when(k % 5 == 0, F.when(k % 2 == 0, F.concat(F.lit("We refunded €"), amount, F.lit(".5"))).otherwise(F.concat(F.lit("Gift card was created for refund for amount "), amount, F.lit(".5 with code X"))))
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", text.alias("comment"))
    li = load(spark, sf, "lineitem")
    items = li.select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_linenumber") % 4 == 1, "Carte cadeau").otherwise("other").alias("name"),
                      F.when(F.col("l_linenumber") != 5, F.col("l_quantity")).alias("qty"), F.col("l_tax").alias("price"))
    x = OF.gift_card_adjusted(o, items, "o_orderkey", "o_totalprice", "name", "qty", "price", "comment")
    return x.select("o_orderkey", round_half_up("gift_cards", 2).alias("gift_cards"), "refund", round_half_up("net_revenue", 2).alias("net_revenue"))
