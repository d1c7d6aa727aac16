"""Paired queries for service models documented without SQL (K115-K117), new-product sales
(K74), OR-identity joins (J9) and ordered struct aggregation (A10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up
from growthframe.operators import order_facts as OF
from growthframe.operators import service as SV
from growthframe.plans.registry import paired
from growthframe.sources.tables import load


@paired("k115_reply_pairs", """
WITH x AS (SELECT *, COALESCE(LAG(role) OVER (PARTITION BY conv_id ORDER BY turn) <> role, true) AS new_run,
                  last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_customer FROM conversations)
SELECT conv_id, turn AS reply_turn, last_customer AS customer_turn, turn - last_customer AS turn_distance
FROM x WHERE role = 'assistant' AND new_run AND last_customer IS NOT NULL
""", covers=("K115",))
def k115(spark, sf):
    c = load(spark, sf, "conversations")
    return SV.reply_pairs(c, "conv_id", "turn", "role", "assistant", "user")


@paired("k116_first_assignments", """
WITH x AS (SELECT *, SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM events),
g AS (SELECT user_id, CAST(seg AS BIGINT) AS segment, MIN(CASE WHEN event_type = 'signup' THEN ts END) AS segment_start,
             MIN(CASE WHEN event_type = 'click' THEN ts END) AS first_assignment FROM x WHERE seg > 0 GROUP BY 1, 2)
SELECT *, (epoch_us(first_assignment) - epoch_us(segment_start)) / 6e7 AS minutes_to_assignment FROM g
""", covers=("K116", "W11"))
def k116(spark, sf):
    e = load(spark, sf, "events")
    out = SV.first_assignments(e, "user_id", "ts", "event_id", F.col("event_type") == "signup",
                               F.col("event_type") == "click")
    return out.withColumn("segment", F.col("segment").cast("long"))


@paired("k117_on_time_rate", """
WITH t AS (SELECT l.l_suppkey, CAST(o.o_orderdate AS DATE) + 90 AS due, CAST(l.l_shipdate AS DATE) AS done
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
SELECT l_suppkey, CAST(count_if(done IS NOT NULL) AS BIGINT) AS completed_tasks, CAST(count_if(done <= due) AS BIGINT) AS on_time_tasks,
       CAST(count_if(done <= due) AS BIGINT) / NULLIF(CAST(count_if(done IS NOT NULL) AS BIGINT), 0) AS on_time_rate
FROM t GROUP BY 1
""", covers=("K117",))
def k117(spark, sf):
    li = load(spark, sf, "lineitem")
    o = load(spark, sf, "orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), 90).alias("due"))
    t = li.join(o, li.l_orderkey == o.o_orderkey).select("l_suppkey", "due", F.to_date("l_shipdate").alias("done"))
    return SV.on_time_rate(t, "l_suppkey", "due", "done")


@paired("k74_new_product_sales", """
WITH l AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d, l_quantity FROM lineitem),
c AS (SELECT l_partkey, MIN(d) AS created_date FROM l GROUP BY 1),
x AS (SELECT l.*, c.created_date FROM l JOIN c USING (l_partkey))
SELECT 'new' AS scope, d, SUM(l_quantity) AS quantity, COUNT(DISTINCT l_partkey) AS products FROM x
WHERE d >= created_date AND d < created_date + 90 GROUP BY 1, 2
UNION ALL SELECT 'all', d, SUM(l_quantity), COUNT(DISTINCT l_partkey) FROM x GROUP BY 1, 2
UNION ALL SELECT 'created', created_date, NULL, COUNT(*) FROM c GROUP BY 1, 2
""", covers=("K74", "J5", "U1"))
def k74(spark, sf):
    return OF.new_product_sales(load(spark, sf, "lineitem"), "l_partkey", "l_shipdate", "l_quantity")


@paired("j9_join_on_or_identities", """
SELECT DISTINCT e.event_id, c.c_custkey FROM events e JOIN customer c
  ON e.user_id = c.c_custkey OR e.user_id = c.c_nationkey OR e.user_id * 10 = c.c_custkey
WHERE e.event_type = 'purchase'
""", covers=("J9",))
def j9(spark, sf):
    from functools import reduce
    e = load(spark, sf, "events").filter(F.col("event_type") == "purchase").select("event_id", "user_id")
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # an OR of equalities cannot be an equi-join (Spark would plan a nested loop): one
    # equi-join per identity, unioned and de-duplicated
    parts = [e.join(c, e.user_id == c.c_custkey), e.join(c, e.user_id == c.c_nationkey),
             e.join(c, (e.user_id * 10) == c.c_custkey)]
    return reduce(lambda a, b: a.unionByName(b), [p.select("event_id", "c_custkey") for p in parts]).distinct()


@paired("a10_array_agg_struct_ordered", """
SELECT o_custkey, array_to_string(list(strftime(o_orderdate, '%Y-%m-%d') || '#' || CAST(o_orderkey AS VARCHAR)
         ORDER BY o_orderdate, o_orderkey), '|') AS order_history,
       CAST(ROUND(CAST(SUM(o_totalprice) AS DECIMAL(38,6)), 2) AS DOUBLE) AS total
FROM orders GROUP BY 1
""", covers=("A10", "F-a2", "F-a5"))
def a10(spark, sf):
    o = load(spark, sf, "orders")
    g = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey"))).alias("h"),
                                   round_half_up(F.sum("o_totalprice"), 2).alias("total"))
    txt = F.transform("h", lambda s: F.concat(F.date_format(s["o_orderdate"], "yyyy-MM-dd"), F.lit("#"),
                                              s["o_orderkey"].cast("string")))
    return g.select("o_custkey", F.array_join(txt, "|").alias("order_history"), "total")
