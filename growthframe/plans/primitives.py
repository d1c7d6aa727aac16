"""Paired queries for the relational primitives.

One query per inventory row (some rows share a query, listed in ``covers``). The Spark side
uses the DataFrame API the way a Spark user writes it; the oracle is DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from growthframe.functions import semantics as S
from growthframe.operators.common import (bucketed_last_non_null, bucketed_lead, bucketed_row_number, bucketed_running_extreme,
                                          bucketed_running_sum, latest_per_key, with_group_agg, piecewise_row_number)
from growthframe.operators.ordered import ordered_array
from growthframe.plans.registry import paired
from growthframe.sources.tables import load


def T(spark, sf_dir, name):
    return load(spark, sf_dir, name)


# ------------------------------------------------------------------ 2.2 projections / filters

@paired("p1_projection_struct_path", """
SELECT o_orderkey AS order_id, info.status AS status, info.prio.name AS priority_name
FROM (SELECT o_orderkey, {'status': o_orderstatus, 'prio': {'name': o_orderpriority}} AS info FROM orders)
""", covers=("P1", "F-a2"))
def p1(spark, sf):
    o = T(spark, sf, "orders").select(
        "o_orderkey", F.struct(F.col("o_orderstatus").alias("status"),
                               F.struct(F.col("o_orderpriority").alias("name")).alias("prio")).alias("info"))
    return o.select(F.col("o_orderkey").alias("order_id"), F.col("info.status").alias("status"),
                    F.col("info.prio.name").alias("priority_name"))


@paired("p2_select_except", """
SELECT * EXCLUDE (o_totalprice, o_orderdate) FROM orders
""", covers=("P2",))
def p2(spark, sf):
    return T(spark, sf, "orders").drop("o_totalprice", "o_orderdate")


@paired("p3_typed_nulls_union", """
SELECT 'order' AS kind, o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS DOUBLE) AS quantity,
       CAST(o_orderdate AS DATE) AS d FROM orders
UNION ALL
SELECT 'line' AS kind, l_orderkey AS id, CAST(NULL AS DOUBLE) AS amount, l_quantity AS quantity,
       CAST(NULL AS DATE) AS d FROM lineitem
""", covers=("P3", "U1", "M9"))
def p3(spark, sf):
    o = T(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"),
                                     F.col("o_totalprice").alias("amount"),
                                     F.to_date("o_orderdate").alias("d"))
    li = T(spark, sf, "lineitem").select(F.lit("line").alias("kind"), F.col("l_orderkey").alias("id"),
                                        F.col("l_quantity").alias("quantity"))
    return o.unionByName(li, allowMissingColumns=True)


@paired("p4_case_ladder", """
SELECT event_id,
  CASE WHEN event_type = 'purchase' AND value >= 250 THEN 'big purchase'
       WHEN event_type = 'purchase' THEN 'purchase'
       WHEN event_type IN ('signup', 'click') THEN 'engagement'
       WHEN value < 10 THEN 'low value'
       ELSE 'other' END AS bucket
FROM events
""", covers=("P4", "P9"))
def p4(spark, sf):
    e = T(spark, sf, "events")
    b = (F.when((F.col("event_type") == "purchase") & (F.col("value") >= 250), "big purchase")
         .when(F.col("event_type") == "purchase", "purchase")
         .when(F.col("event_type").isin("signup", "click"), "engagement")
         .when(F.col("value") < 10, "low value").otherwise("other"))
    return e.select("event_id", b.alias("bucket"))


@paired("p5_simple_case", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' ELSE 'partial' END AS status_label
FROM orders
""", covers=("P5",))
def p5(spark, sf):
    o = T(spark, sf, "orders")
    m = F.create_map(F.lit("F"), F.lit("fulfilled"), F.lit("O"), F.lit("open"))
    return o.select("o_orderkey", F.coalesce(m[F.col("o_orderstatus")], F.lit("partial")).alias("status_label"))


@paired("p6_like_patterns", """
SELECT p_partkey, p_name,
  p_name LIKE '%ring%' AS has_ring,
  p_name NOT LIKE 'small%' AS not_small,
  p_name LIKE ('%' || lower(p_type) || '%') AS name_mentions_type
FROM part
""", covers=("P6",))
def p6(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", "p_name", F.col("p_name").like("%ring%").alias("has_ring"),
                    (~F.col("p_name").like("small%")).alias("not_small"),
                    F.expr("p_name LIKE concat('%', lower(p_type), '%')").alias("name_mentions_type"))


@paired("p7_regex_word_boundary", r"""
SELECT p_partkey, regexp_matches(p_name, '\b(red|blue)\b') AS coloured,
       regexp_matches(p_name, '^(small|large)\s') AS sized
FROM part
""", covers=("P7", "F-s4"))
def p7(spark, sf):
    p = T(spark, sf, "part")
    return p.select("p_partkey", F.col("p_name").rlike(r"\b(red|blue)\b").alias("coloured"),
                    F.col("p_name").rlike(r"^(small|large)\s").alias("sized"))


@paired("p8_prefix_test", """
SELECT page_id, starts_with(url, 'https://') AS secure, starts_with(url, 'http://m.') OR starts_with(url, 'https://m.') AS mobile
FROM pages
""", covers=("P8", "F-s6"))
def p8(spark, sf):
    g = T(spark, sf, "pages")
    return g.select("page_id", F.col("url").startswith("https://").alias("secure"),
                    (F.col("url").startswith("http://m.") | F.col("url").startswith("https://m.")).alias("mobile"))


@paired("p9_in_between", """
SELECT o_orderkey FROM orders
WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
""", covers=("P9", "S17"))
def p9(spark, sf):
    o = T(spark, sf, "orders")
    return o.filter(~F.col("o_orderpriority").isin(["5-LOW", "4-NOT SPECIFIED"])
                    & F.to_date("o_orderdate").between(F.lit("1996-01-01").cast("date"),
                                                       F.lit("1996-12-31").cast("date"))).select("o_orderkey")


@paired("p10_null_safe_compare", """
WITH x AS (
  SELECT event_id, CASE WHEN value > 100 THEN value > 300 END AS flag,
         CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN '' ELSE event_type END AS a,
         CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS b
  FROM events)
SELECT event_id, (coalesce(flag, false) IS DISTINCT FROM true) AS not_true,
       (coalesce(a, '') != coalesce(b, '')) AS blank_differs,
       (a IS NOT DISTINCT FROM b) AS null_safe_equal
FROM x
""", covers=("P10", "M12", "F-c1"))
def p10(spark, sf):
    e = T(spark, sf, "events")
    x = e.select("event_id",
                 F.when(F.col("value") > 100, F.col("value") > 300).alias("flag"),
                 F.when(F.col("event_type") == "view", F.lit(None)).when(F.col("event_type") == "click", "")
                 .otherwise(F.col("event_type")).alias("a"),
                 F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type")).alias("b"))
    return x.select("event_id", S.is_not_true("flag").alias("not_true"),
                    S.differs_blank_equal("a", "b").alias("blank_differs"),
                    F.col("a").eqNullSafe(F.col("b")).alias("null_safe_equal"))


@paired("p11_boolean_predicate", """
WITH x AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value > 250 END AS big FROM events)
SELECT event_id FROM x WHERE big = false
""", covers=("P11", "M13"))
def p11(spark, sf):
    x = T(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value") > 250).alias("big"))
    return x.filter(F.col("big") == F.lit(False)).select("event_id")


@paired("p12_disjunctive_ranges", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders
WHERE (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-01-31' AND o_orderpriority = '1-URGENT')
   OR (CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-01-31' AND o_orderpriority = '1-URGENT')
   OR (CAST(o_orderdate AS DATE) BETWEEN DATE '1998-06-01' AND DATE '1998-06-30')
""", covers=("P12", "M17"))
def p12(spark, sf):
    from functools import reduce
    o = T(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    blocks = [(F.col("d").between(F.lit("1996-01-01").cast("date"), F.lit("1996-01-31").cast("date"))
               & (F.col("o_orderpriority") == "1-URGENT")),
              (F.col("d").between(F.lit("1997-01-01").cast("date"), F.lit("1997-01-31").cast("date"))
               & (F.col("o_orderpriority") == "1-URGENT")),
              F.col("d").between(F.lit("1998-06-01").cast("date"), F.lit("1998-06-30").cast("date"))]
    return o.filter(reduce(lambda a, b: a | b, blocks)).select("o_orderkey", "d")


@paired("p13_if_iff", """
SELECT l_orderkey, l_linenumber, l_returnflag, IF(l_returnflag = 'R', -l_quantity, l_quantity) AS signed_qty
FROM lineitem
""", covers=("P13",))
def p13(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     F.expr("if(l_returnflag = 'R', -l_quantity, l_quantity)").alias("signed_qty"))


@paired("p14_group_alias_having", """
SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS yr, o_orderpriority, COUNT(*) AS n
FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 200
""", covers=("P14", "A8", "O4"))
def p14(spark, sf):
    o = T(spark, sf, "orders")
    g = o.groupBy(F.to_date(F.date_trunc("year", "o_orderdate")).alias("yr"), "o_orderpriority").agg(
        F.count("*").alias("n"))
    return g.filter(F.col("n") > 200)


@paired("p15_select_distinct", """
SELECT DISTINCT o_custkey, o_orderpriority FROM orders
""", covers=("P15",))
def p15(spark, sf):
    return T(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()


# ------------------------------------------------------------------ 2.3 joins

@paired("j1_inner_multi_key", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, b.returned
FROM lineitem l JOIN (SELECT l_partkey, l_suppkey, COUNT(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) b
  ON l.l_partkey = b.l_partkey AND l.l_suppkey = b.l_suppkey
""", covers=("J1",))
def j1(spark, sf):
    li = T(spark, sf, "lineitem")
    back = li.filter(F.col("l_returnflag") == "R").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("returned"))
    return li.join(back, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "returned")


@paired("j2_left_expression_keys", """
SELECT o.o_orderkey, c.c_name
FROM orders o LEFT JOIN customer c ON CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey + 1 AS VARCHAR)
""", covers=("J2",))
def j2(spark, sf):
    o = T(spark, sf, "orders")
    c = T(spark, sf, "customer")
    return o.join(c, o.o_custkey.cast("string") == (c.c_custkey + 1).cast("string"), "left").select(
        "o_orderkey", "c_name")


@paired("j3_multi_column_using", """
WITH a AS (SELECT l_orderkey, l_suppkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
     b AS (SELECT l_orderkey, l_suppkey, COUNT(*) AS lines FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2)
SELECT l_orderkey, l_suppkey, qty, lines FROM a LEFT JOIN b USING (l_orderkey, l_suppkey)
""", covers=("J3",))
def j3(spark, sf):
    li = T(spark, sf, "lineitem")
    a = li.groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    b = li.filter(F.col("l_returnflag") == "N").groupBy("l_orderkey", "l_suppkey").agg(F.count("*").alias("lines"))
    return a.join(b, ["l_orderkey", "l_suppkey"], "left")


@paired("j4_self_join_validity", """
WITH h AS (SELECT user_id, event_id, ts,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT a.user_id, a.event_id, a.ts AS valid_from, b.ts AS valid_to
FROM h a LEFT JOIN h b ON a.user_id = b.user_id AND b.rn = a.rn + 1
""", covers=("J4",))
def j4(spark, sf):
    e = bucketed_lead(T(spark, sf, "events"), ["user_id"], "ts", "event_id", ["ts"], "day")
    return e.select("user_id", "event_id", F.col("ts").alias("valid_from"), F.col("next_ts").alias("valid_to"))


@paired("j10_anti_join", """
SELECT c.c_custkey FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') o
ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL
""", covers=("J10",))
def j10(spark, sf):
    c = T(spark, sf, "customer")
    o = T(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@paired("j11_semi_join", """
SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""", covers=("J11",))
def j11(spark, sf):
    o = T(spark, sf, "orders")
    li = T(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left_semi").select("o_orderkey")


@paired("j12_cross_literal_array", """
SELECT o_orderkey, m.sign, o_totalprice * m.sign AS signed_amount
FROM orders CROSS JOIN (VALUES (1), (-1)) AS m(sign)
""", covers=("J12", "J17"))
def j12(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(-1))).alias("sign"), "o_totalprice") \
        .select("o_orderkey", "sign", (F.col("o_totalprice") * F.col("sign")).alias("signed_amount"))


@paired("j13_spine_cross_filter", """
WITH b AS (SELECT CAST(MIN(ts) AS DATE) AS lo, CAST(MAX(ts) AS DATE) AS hi FROM events),
     spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
     users AS (SELECT user_id, CAST(MIN(ts) AS DATE) AS first_d FROM events GROUP BY 1)
SELECT s.d, u.user_id FROM spine s CROSS JOIN users u WHERE s.d >= u.first_d
""", covers=("J13", "S19", "K91"))
def j13(spark, sf):
    e = T(spark, sf, "events")
    last_day = e.agg(F.to_date(F.max("ts"))).scalar()  # scalar subquery, not a join
    users = e.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("first_d"))
    # "spine x users WHERE d >= first_d" generated per user: each user emits exactly its own
    # days, so no cross join or nested loop is planned and the work equals the output size
    return users.select(F.explode(F.sequence("first_d", last_day)).alias("d"), "user_id")


@paired("j14_unnest_drops_empty", """
WITH x AS (SELECT event_id, CASE WHEN event_type = 'view' THEN [] ELSE [event_type, CAST(user_id AS VARCHAR)] END AS arr FROM events)
SELECT event_id, item FROM x, UNNEST(arr) AS t(item)
""", covers=("J14", "M9"))
def j14(spark, sf):
    x = T(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "view", F.array().cast("array<string>"))
                                      .otherwise(F.array("event_type", F.col("user_id").cast("string"))).alias("arr"))
    return x.select("event_id", F.explode("arr").alias("item"))


@paired("j15_unnest_keep_parent", """
WITH x AS (SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE [event_type] END AS arr FROM events)
SELECT event_id, item FROM x, UNNEST(CASE WHEN arr IS NULL THEN [''] ELSE arr END) AS t(item)
""", covers=("J15", "M9"))
def j15(spark, sf):
    x = T(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "view", F.array("event_type"))
                                      .alias("arr"))
    return x.select("event_id", F.explode_outer("arr").alias("item")).select(
        "event_id", F.coalesce("item", F.lit("")).alias("item"))


@paired("j16_left_unnest_condition", """
WITH x AS (SELECT o_orderkey, [o_orderstatus, o_orderpriority] AS arr FROM orders)
SELECT o_orderkey, t.item FROM x LEFT JOIN (SELECT o_orderkey AS k, unnest(arr) AS item FROM x) t
  ON t.k = x.o_orderkey AND t.item LIKE '%-%' AND t.item LIKE '1%'
""", covers=("J16",))
def j16(spark, sf):
    x = T(spark, sf, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("arr"))
    return x.select("o_orderkey", F.explode_outer(
        F.filter("arr", lambda e: e.like("%-%") & e.like("1%"))).alias("item"))


@paired("j18_join_on_rank", """
WITH a AS (SELECT o_orderpriority, SUM(o_totalprice) AS amt, ROW_NUMBER() OVER (ORDER BY SUM(o_totalprice) DESC, o_orderpriority) AS rk
           FROM orders GROUP BY 1),
     b AS (SELECT event_type, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, event_type) AS rk FROM events GROUP BY 1)
SELECT a.rk, a.o_orderpriority, b.event_type FROM a JOIN b ON a.rk = b.rk
""", covers=("J18", "W2"))
def j18(spark, sf):
    a = T(spark, sf, "orders").groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("amt"))
    a = a.withColumn("rk", F.row_number().over(Window.orderBy(F.col("amt").desc(), "o_orderpriority")))
    b = T(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    b = b.withColumn("rk", F.row_number().over(Window.orderBy(F.col("n").desc(), "event_type")))
    # both sides are aggregates over a handful of groups: global windows on bounded inputs
    return a.join(b, "rk").select("rk", "o_orderpriority", "event_type").withColumn("rk", F.col("rk").cast("long"))


@paired("j19_scalar_threshold_join", """
WITH t AS (SELECT quantile_cont(o_totalprice, 0.99) AS p99 FROM orders)
SELECT o_orderkey, o_totalprice FROM orders CROSS JOIN t WHERE o_totalprice > t.p99
""", covers=("J19", "A17"))
def j19(spark, sf):
    o = T(spark, sf, "orders")
    from growthframe.operators.selection import exact_percentile
    # exact global p99 by selection (no single-task percentile buffer), used as a scalar subquery
    p99 = exact_percentile(o, "o_totalprice", [0.99]).scalar()
    return o.filter(F.col("o_totalprice") > p99).select("o_orderkey", "o_totalprice")


@paired("j20_star_dimension_joins", """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand, s.s_name, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""", covers=("J20",))
def j20(spark, sf):
    li = T(spark, sf, "lineitem")
    p, s = T(spark, sf, "part"), T(spark, sf, "supplier")
    n, r = T(spark, sf, "nation"), T(spark, sf, "region")
    # dimension sides are left to the planner: AQE broadcasts them when their measured size is
    # under spark.sql.autoBroadcastJoinThreshold and falls back to a shuffle join otherwise.
    return (li.join(p, li.l_partkey == p.p_partkey, "left").join(s, li.l_suppkey == s.s_suppkey, "left")
            .join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
            .select("l_orderkey", "l_linenumber", "p_brand", "s_name", "n_name", "r_name"))


# ------------------------------------------------------------------ 2.4 aggregations

@paired("a1_basic_aggregates", """
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS sum_qty, COUNT(*) AS n,
       CAST(CAST(AVG(l_discount) AS DECIMAL(38,6)) AS DOUBLE) AS avg_disc,
       MIN(l_extendedprice) AS min_price, MAX(l_extendedprice) AS max_price,
       CAST(ROUND(CAST(SUM(l_extendedprice) AS DECIMAL(38,6)), 2) AS DOUBLE) AS sum_price
FROM lineitem GROUP BY 1, 2
""", covers=("A1",))
def a1(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.count("*").alias("n"),
        S.round_half_up(F.avg("l_discount"), 6).alias("avg_disc"), F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"), S.round_half_up(F.sum("l_extendedprice"), 2).alias("sum_price"))


@paired("a2_count_distinct_concat", """
SELECT event_type, COUNT(DISTINCT user_id) AS users,
       COUNT(DISTINCT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS user_days
FROM events GROUP BY 1
""", covers=("A2",))
def a2(spark, sf):
    e = T(spark, sf, "events")
    return e.groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct(F.concat(F.col("user_id").cast("string"), F.lit("-"),
                                 F.to_date("ts").cast("string"))).alias("user_days"))


@paired("a3_conditional_aggregates", """
SELECT user_id,
  CAST(ROUND(CAST(SUM(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS DECIMAL(38,6)), 2) AS DOUBLE) AS purchase_value,
  COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS views,
  MIN(CASE WHEN event_type = 'signup' THEN ts END) AS first_signup,
  MAX(CASE WHEN event_type = 'click' THEN ts END) AS last_click,
  COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS purchase_days,
  CAST(count_if(event_type = 'error') AS BIGINT) AS errors
FROM events GROUP BY 1
""", covers=("A3", "A4", "A5"))
def a3(spark, sf):
    e = T(spark, sf, "events")
    t = F.col("event_type")
    return e.groupBy("user_id").agg(
        S.round_half_up(F.sum(F.when(t == "purchase", F.col("value")).otherwise(0)), 2).alias("purchase_value"),
        F.count(F.when(t == "view", 1)).alias("views"),
        F.min(F.when(t == "signup", F.col("ts"))).alias("first_signup"),
        F.max(F.when(t == "click", F.col("ts"))).alias("last_click"),
        F.countDistinct(F.when(t == "purchase", F.to_date("ts"))).alias("purchase_days"),
        F.count_if(t == "error").alias("errors"))


@paired("a6_guarded_ratio_having", """
SELECT o_custkey,
  CAST(ROUND(CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END)
     / NULLIF(SUM(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 0) AS DECIMAL(38,6)), 4) AS DOUBLE) AS f_to_o,
  CAST(NULLIF(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END), 0) AS BIGINT) AS partial_orders
FROM orders GROUP BY 1
HAVING SUM(CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice ELSE 0 END) > 0
""", covers=("A6", "A7", "F-m2", "M3"))
def a6(spark, sf):
    o = T(spark, sf, "orders")
    st = F.col("o_orderstatus")
    g = o.groupBy("o_custkey").agg(
        S.round_half_up(S.safe_divide(F.sum(F.when(st == "F", F.col("o_totalprice")).otherwise(0)),
                                      F.sum(F.when(st == "O", F.col("o_totalprice")).otherwise(0))), 4).alias("f_to_o"),
        F.nullif(F.sum(F.when(st == "P", 1).otherwise(0)), F.lit(0)).alias("partial_orders"),
        F.sum(F.when(st.isin("F", "O"), F.col("o_totalprice")).otherwise(0)).alias("_fo"))
    return g.filter(F.col("_fo") > 0).drop("_fo").withColumn("partial_orders", F.col("partial_orders").cast("long"))


@paired("a9_array_agg_distinct", """
SELECT o_custkey, list_sort(list_distinct(list(o_orderpriority))) AS priorities,
       list_sort(list(o_orderstatus || ':' || CAST(o_orderkey AS VARCHAR))) AS tagged
FROM orders GROUP BY 1
""", covers=("A9", "A10", "M14"))
def a9(spark, sf):
    o = T(spark, sf, "orders")
    tag = F.concat("o_orderstatus", F.lit(":"), F.col("o_orderkey").cast("string"))
    # pieces by first letters: a customer with a third of all orders is sorted piece by piece
    tagged = ordered_array(o, ["o_custkey"], F.substring(tag, 1, 3), tag, tag, "tagged")
    p = F.col("o_orderpriority")
    return tagged.join(ordered_array(o, ["o_custkey"], p, p, p, "priorities", distinct=True), "o_custkey").select("o_custkey", "priorities", "tagged")


@paired("a11_array_concat_agg", """
WITH x AS (SELECT o_custkey, o_orderkey, [o_orderstatus, o_orderpriority] AS arr FROM orders)
SELECT o_custkey, list_sort(flatten(list(arr))) AS all_tags FROM x GROUP BY 1
""", covers=("A11",))
def a11(spark, sf):
    x = T(spark, sf, "orders").select("o_custkey", F.explode(F.array("o_orderstatus", "o_orderpriority")).alias("tag"))
    tag = F.col("tag")
    return ordered_array(x, ["o_custkey"], tag, tag, tag, "all_tags").select("o_custkey", "all_tags")


@paired("a12_string_agg_distinct", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types
FROM events GROUP BY 1
""", covers=("A12", "F-a3", "F-a5"))
def a12(spark, sf):
    e = T(spark, sf, "events")
    return e.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"))


@paired("a13_any_value_min", """
SELECT c_nationkey, MIN(c_mktsegment) AS some_segment, COUNT(*) AS n FROM customer GROUP BY 1
""", covers=("A13",))
def a13(spark, sf):
    # ANY_VALUE is non-deterministic; the stable form is min()
    return T(spark, sf, "customer").groupBy("c_nationkey").agg(F.min("c_mktsegment").alias("some_segment"),
                                                                F.count("*").alias("n"))


@paired("a14_flag_per_group", """
SELECT l_orderkey, bool_or(l_returnflag = 'R') AS any_returned,
       MAX(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) = 1 AS any_big_discount
FROM lineitem GROUP BY 1
""", covers=("A14",))
def a14(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
                                        F.bool_or(F.col("l_discount") >= 0.09).alias("any_big_discount"))


@paired("a15_two_level_aggregate", """
WITH per_customer AS (SELECT o_custkey, COUNT(*) AS n_orders, SUM(o_totalprice) AS spent FROM orders GROUP BY 1)
SELECT n_orders, COUNT(*) AS customers, CAST(ROUND(CAST(AVG(spent) AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_spent
FROM per_customer GROUP BY 1
""", covers=("A15",))
def a15(spark, sf):
    o = T(spark, sf, "orders")
    pc = o.groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent"))
    return pc.groupBy("n_orders").agg(F.count("*").alias("customers"),
                                      S.round_half_up(F.avg("spent"), 2).alias("avg_spent"))


@paired("a16_aggregate_then_window", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, o_orderpriority, COUNT(*) AS n,
       CAST(SUM(COUNT(*)) OVER (PARTITION BY CAST(date_trunc('month', o_orderdate) AS DATE)) AS BIGINT) AS month_total,
       RANK() OVER (PARTITION BY CAST(date_trunc('month', o_orderdate) AS DATE) ORDER BY COUNT(*) DESC) AS rk
FROM orders GROUP BY 1, 2
""", covers=("A16", "W17"))
def a16(spark, sf):
    o = T(spark, sf, "orders")
    g = o.groupBy(F.to_date(F.date_trunc("month", "o_orderdate")).alias("m"), "o_orderpriority").agg(
        F.count("*").alias("n"))
    w = Window.partitionBy("m")
    return g.withColumn("month_total", F.sum("n").over(w)).withColumn(
        "rk", F.rank().over(w.orderBy(F.col("n").desc())).cast("long"))


@paired("a17_exact_median", """
SELECT o_orderpriority, CAST(ROUND(CAST(quantile_cont(o_totalprice, 0.5) AS DECIMAL(38,6)), 4) AS DOUBLE) AS median_price,
       CAST(ROUND(CAST(quantile_cont(o_totalprice, 0.9) AS DECIMAL(38,6)), 4) AS DOUBLE) AS p90_price
FROM orders GROUP BY 1
""", covers=("A17",))
def a17(spark, sf):
    o = T(spark, sf, "orders")
    from growthframe.operators.selection import exact_percentile
    q = exact_percentile(o, "o_totalprice", [0.5, 0.9], ["o_orderpriority"])
    return q.select("o_orderpriority", S.round_half_up("p50", 4).alias("median_price"), S.round_half_up("p90", 4).alias("p90_price"))


@paired("a18_mode_with_ties", """
WITH c AS (SELECT l_orderkey, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
     m AS (SELECT *, MAX(n) OVER (PARTITION BY l_orderkey) AS mx FROM c)
SELECT l_orderkey, l_returnflag AS main_flag, n FROM m WHERE n = mx
""", covers=("A18", "K108"))
def a18(spark, sf):
    from growthframe.operators.orders import modes
    li = T(spark, sf, "lineitem")
    return modes(li, ["l_orderkey"], "l_returnflag").select(
        "l_orderkey", F.col("l_returnflag").alias("main_flag"), "n")


# ------------------------------------------------------------------ 2.5 windows

@paired("w1_row_number_partitioned", """
SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_rank
FROM orders
""", covers=("W1", "M15"))
def w1(spark, sf):
    o = bucketed_row_number(T(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey", "order_rank")
    return o.select("o_orderkey", F.col("order_rank").cast("long").alias("order_rank"))


@paired("w3_dense_rank_previous", """
WITH m AS (SELECT DISTINCT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
     r AS (SELECT *, DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY m) AS rk FROM m)
SELECT a.o_orderpriority, a.m, a.rk, b.m AS previous_m FROM r a LEFT JOIN r b
  ON a.o_orderpriority = b.o_orderpriority AND b.rk = a.rk - 1
""", covers=("W3",))
def w3(spark, sf):
    m = T(spark, sf, "orders").select("o_orderpriority", F.to_date(F.date_trunc("month", "o_orderdate")).alias("m")) \
        .distinct()
    r = m.withColumn("rk", F.dense_rank().over(Window.partitionBy("o_orderpriority").orderBy("m")).cast("long"))
    b = r.select("o_orderpriority", F.col("m").alias("previous_m"), (F.col("rk") + 1).alias("rk"))
    return r.join(b, ["o_orderpriority", "rk"], "left").select("o_orderpriority", "m", "rk", "previous_m")


@paired("w5_lag_offsets", """
WITH d AS (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events GROUP BY 1)
SELECT d, n, LAG(n, 1) OVER (ORDER BY d) AS n_1, LAG(n, 7) OVER (ORDER BY d) AS n_7 FROM d
""", covers=("W5", "W6"))
def w5(spark, sf):
    d = T(spark, sf, "events").groupBy(F.to_date("ts").alias("d")).agg(F.count("*").alias("n"))
    # a global order over daily aggregates: one row per day, bounded by the calendar
    w = Window.orderBy("d")
    return d.select("d", "n", F.lag("n", 1).over(w).alias("n_1"), F.lag("n", 7).over(w).alias("n_7"))


@paired("w7_lead_wraparound", """
SELECT event_id, user_id,
  COALESCE(LEAD(event_type) OVER (PARTITION BY user_id ORDER BY ts),
           FIRST_VALUE(event_type) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_type
FROM events
""", covers=("W7", "W8"))
def w7(spark, sf):
    e = bucketed_lead(T(spark, sf, "events"), ["user_id"], "ts", "event_id", ["event_type"], "day")
    e = with_group_agg(e, ["user_id"], F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"))
    return e.select("event_id", "user_id", F.coalesce("next_event_type", "first_type").alias("next_type"))


@paired("w9_last_value_ignore_nulls", """
WITH x AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'purchase' THEN value END AS pv FROM events)
SELECT event_id,
  LAST_VALUE(pv IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase_value,
  FIRST_VALUE(pv IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_purchase_value
FROM x
""", covers=("W9", "W8"))
def w9(spark, sf):
    x = T(spark, sf, "events").select("user_id", "ts", "event_id",
                                      F.when(F.col("event_type") == "purchase", F.col("value")).alias("pv"))
    x = bucketed_last_non_null(x, ["user_id"], "ts", "event_id", F.col("pv"), "before", "day")
    first = F.min_by("pv", F.when(F.col("pv").isNotNull(), F.struct("ts", "event_id")))
    x = with_group_agg(x, ["user_id"], first.alias("first_purchase_value"))
    return x.select("event_id", F.coalesce("pv", "before").alias("last_purchase_value"), "first_purchase_value")


@paired("w10_last_value_default_frame", """
WITH d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey FROM orders)
SELECT o_orderkey, MAX(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY d) AS last_key_on_or_before_day
FROM d
""", covers=("W10",))
def w10(spark, sf):
    d = T(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"), "o_orderkey")
    # default frame = RANGE UNBOUNDED PRECEDING .. CURRENT ROW: ties on the day are peers, so the
    # window runs over one row per customer and day; the largest key is the same on both engines
    day = d.groupBy("o_custkey", "d").agg(F.max("o_orderkey").alias("k"))
    w = Window.partitionBy("o_custkey").orderBy("d")
    return d.join(day.withColumn("last_key_on_or_before_day", F.max("k").over(w)), ["o_custkey", "d"]).select(
        "o_orderkey", "last_key_on_or_before_day")


@paired("w11_running_sum_rows", """
SELECT o_orderkey,
  CAST(ROUND(CAST(SUM(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,6)), 2) AS DOUBLE) AS running_spent,
  MAX(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before,
  MIN(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS running_min
FROM orders
""", covers=("W11", "W12", "W15"))
def w11(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    key = (["o_custkey"], "o_orderdate", "o_orderkey", "o_totalprice")
    o = bucketed_running_sum(o, *key, "running")
    o = bucketed_running_extreme(o, *key, "max_before", True, exclusive=True)
    o = bucketed_running_extreme(o, *key, "running_min", False)
    return o.select("o_orderkey", S.round_half_up("running", 2).alias("running_spent"), "max_before", "running_min")


@paired("w14_count_distinct_over", """
SELECT event_id, user_id,
  (SELECT COUNT(DISTINCT e2.event_type) FROM events e2 WHERE e2.user_id = e.user_id) AS user_types
FROM events e
""", covers=("W14",))
def w14(spark, sf):
    e = T(spark, sf, "events").select("event_id", "user_id", "event_type")
    # COUNT(DISTINCT) OVER is not supported by Spark: pre-aggregate the distinct count and join back
    return with_group_agg(e, ["user_id"], F.countDistinct("event_type").alias("user_types")).select(
        "event_id", "user_id", "user_types")


@paired("w16_percentile_over", """
SELECT p_partkey, p_type, CAST(ROUND(CAST(quantile_cont(p_retailprice, 0.5) OVER (PARTITION BY p_type) AS DECIMAL(38,6)), 4) AS DOUBLE) AS type_median
FROM part
""", covers=("W16",))
def w16(spark, sf):
    p = T(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    from growthframe.operators.selection import exact_percentile
    med = exact_percentile(p, "p_retailprice", [0.5], ["p_type"]).select("p_type", S.round_half_up("p50", 4).alias("type_median"))
    return p.join(med, "p_type", "left").select(
        "p_partkey", "p_type", "type_median")


@paired("w18_qualify_latest", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
""", covers=("W18", "O3", "K37"))
def w18(spark, sf):
    o = T(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@paired("w19_window_case_order", """
SELECT event_id, ROW_NUMBER() OVER (PARTITION BY user_id
   ORDER BY CASE WHEN event_type = 'signup' THEN 0 WHEN event_type = 'purchase' THEN 1 ELSE 2 END, ts DESC) AS priority_rank
FROM events
""", covers=("W19",))
def w19(spark, sf):
    e = T(spark, sf, "events")
    key = F.when(F.col("event_type") == "signup", 0).when(F.col("event_type") == "purchase", 1).otherwise(2)
    day = F.struct(key.alias("class"), (-F.unix_date(F.to_date("ts"))).alias("day"))  # newest day first
    x = piecewise_row_number(e.select("event_id", "user_id", "event_type", "ts"), ["user_id"], day, [key, F.col("ts").desc()], "priority_rank")
    return x.select("event_id", F.col("priority_rank").cast("long").alias("priority_rank"))


@paired("w20_lag_inside_array", """
WITH x AS (SELECT user_id, CAST(ts AS DATE) AS day, list(event_type ORDER BY ts) AS path FROM events GROUP BY 1, 2),
     u AS (SELECT user_id, day, generate_subscripts(path, 1) AS pos, unnest(path) AS page FROM x)
SELECT user_id, day, CAST(pos - 1 AS BIGINT) AS pos, page,
       LAG(page) OVER (PARTITION BY user_id, day ORDER BY pos) AS previous_page FROM u
""", covers=("W20", "F-a6"))
def w20(spark, sf):
    e = T(spark, sf, "events")
    # a nested array per visit-like unit (user and day): its size is bounded by a day of
    # activity, never a user's whole history
    x = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_type"))), lambda s: s["event_type"]).alias("path"))
    return x.select("user_id", "day", F.posexplode("path").alias("pos", "page"), "path").select(
        "user_id", "day", F.col("pos").cast("long").alias("pos"), "page",
        F.when(F.col("pos") > 0, F.element_at("path", F.col("pos"))).alias("previous_page"))


# ------------------------------------------------------------------ 2.6 sorts, limits

@paired("o2_top_k_after_sort", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""", covers=("O1", "O2"))
def o2(spark, sf):
    # the limit is the feature (a top-k report): Spark plans TakeOrderedAndProject,
    # a per-partition top-k then a k-row merge, never a full sort
    return T(spark, sf, "orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20).select(
        "o_orderkey", "o_totalprice")


# ------------------------------------------------------------------ 2.7 set operations

@paired("u2_multiset_difference", """
WITH cur AS (SELECT l_orderkey, l_returnflag FROM lineitem),
     old AS (SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linenumber <> 1),
     signed AS (SELECT *, 1 AS s FROM cur UNION ALL SELECT *, -1 AS s FROM old)
SELECT l_orderkey, l_returnflag, CAST(SUM(s) AS BIGINT) AS delta FROM signed GROUP BY 1, 2 HAVING SUM(s) <> 0
""", covers=("U2", "S13"))
def u2(spark, sf):
    from growthframe.operators.monitoring import snapshot_diff
    li = T(spark, sf, "lineitem")
    cur = li.select("l_orderkey", "l_returnflag")
    old = li.filter(F.col("l_linenumber") != 1).select("l_orderkey", "l_returnflag")
    return snapshot_diff(cur, old, ["l_orderkey", "l_returnflag"])


@paired("u3_distinct_pairs_union", """
SELECT DISTINCT user_id, event_type AS source FROM events WHERE event_type IN ('click', 'view')
UNION SELECT DISTINCT o_custkey AS user_id, 'order' AS source FROM orders
""", covers=("U3",))
def u3(spark, sf):
    a = T(spark, sf, "events").filter(F.col("event_type").isin("click", "view")).select(
        "user_id", F.col("event_type").alias("source"))
    b = T(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"), F.lit("order").alias("source"))
    return a.unionByName(b).distinct()


# After a LEFT JOIN from a spine, a WHERE on the right side drops the days without a match: the join is an inner one.
@paired("m10_spine_filter_is_inner", """
WITH b AS (SELECT MIN(CAST(ts AS DATE)) - 3 AS lo, MAX(CAST(ts AS DATE)) + 3 AS hi FROM events),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
e AS (SELECT CAST(ts AS DATE) AS d, event_id, event_type FROM events WHERE event_type = 'error' AND event_id % 40 = 0),
filtered AS (SELECT spine.d, COUNT(*) AS n FROM spine LEFT JOIN e ON e.d = spine.d WHERE e.event_type IS NOT NULL GROUP BY 1),
kept AS (SELECT spine.d, COUNT(e.event_id) AS n FROM spine LEFT JOIN e ON e.d = spine.d GROUP BY 1)
SELECT 'filter after the join' AS form, d, n FROM filtered UNION ALL SELECT 'condition in the join', d, n FROM kept
""", covers=("M10", "J13"))
def m10(spark, sf):
    from growthframe.operators.calendar import spine_from_bounds
    ev = T(spark, sf, "events").select(F.to_date("ts").alias("d"), "event_id", "event_type")
    b = ev.agg(F.date_sub(F.min("d"), 3).alias("lo"), F.date_add(F.max("d"), 3).alias("hi"))
    spine = spine_from_bounds(b, "lo", "hi")
    e = ev.filter((F.col("event_type") == "error") & (F.col("event_id") % 40 == 0))
    j = spine.join(e, "d", "left")
    filtered = j.filter(F.col("event_type").isNotNull()).groupBy("d").agg(F.count("*").alias("n"))
    kept = j.groupBy("d").agg(F.count("event_id").alias("n"))
    return filtered.select(F.lit("filter after the join").alias("form"), "d", "n").union(kept.select(F.lit("condition in the join"), "d", "n"))
