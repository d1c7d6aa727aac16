"""Invariants of the composite operators and rewrite-vs-literal checks."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from growthframe.operators import ads as AD
from growthframe.operators import customers as CU
from growthframe.operators.calendar import spine_from_bounds
from growthframe.operators.ranking import exact_row_number
from growthframe.operators.selection import exact_ntile
from growthframe.plans import acquisition as PA
from growthframe.plans import subscriptions as PS
from growthframe.sources import sinks as SK
from growthframe.sources.tables import load
from growthframe.session import scratch_path
from tests.conftest import SF_SMALL


def test_k36_totals_equal_coarsest_level(spark):
    li = load(spark, SF_SMALL, "lineitem").select(
        F.to_date("l_shipdate").alias("date_report"), F.col("l_suppkey").cast("string").alias("campaign_id"),
        F.col("l_partkey").cast("string").alias("ad_group_id"), "l_returnflag", F.col("l_extendedprice").alias("cost"))
    c = li.groupBy("date_report", "campaign_id").agg(F.sum("cost").alias("cost"))
    g = li.filter(F.col("l_returnflag") != "R").groupBy("date_report", "campaign_id", "ad_group_id").agg(
        F.sum("cost").alias("cost"))
    r = AD.hierarchy_reconcile([c, g], ["campaign_id", "ad_group_id"], ["cost"])
    a = r.agg(F.sum("cost")).first()[0]
    b = c.agg(F.sum("cost")).first()[0]
    assert abs(a - b) < 1e-6 * max(1.0, abs(b))


def test_k24_linear_weights_sum_to_one(spark):
    w = PA.k24(spark, SF_SMALL)
    sums = w.groupBy("contact_id").agg(F.sum("weight").alias("s")).collect()
    assert sums and all(abs(r["s"] - 1.0) < 1e-9 for r in sums)


def test_k84_deltas_reconcile_mrr(spark):
    m = PS.k84(spark, SF_SMALL)
    # sum of deltas of non-retained movements = mrr - prev_mrr for each row
    bad = m.filter(F.col("mrr_type") != "retained").filter(
        F.abs(F.col("mrr_delta") - (F.col("mrr") - F.col("prev_mrr"))) > 0.011).count()
    assert bad == 0


def test_k79_pieces_sum_to_line(spark):
    from growthframe.operators.subscriptions import spread_periods
    li = load(spark, SF_SMALL, "lineitem").withColumn("months", 1 + F.col("l_linenumber") % 12) \
        .withColumn("line_id", F.monotonically_increasing_id())
    s = spread_periods(li, "l_shipdate", "months", "l_extendedprice")
    back = s.groupBy("line_id").agg(F.sum("monthly_amount").alias("s"), F.first("l_extendedprice").alias("a"))
    assert back.filter(F.abs(F.col("s") - F.col("a")) > 1e-6).count() == 0


def test_k29_goals_sum_to_month(spark):
    from growthframe.plans.periods import k29
    g = k29(spark, SF_SMALL)
    per = g.groupBy("month").agg(F.sum("daily_goal").alias("s"))
    o = load(spark, SF_SMALL, "orders").groupBy(
        F.add_months(F.to_date(F.date_trunc("month", "o_orderdate")), 12).alias("month")).agg(
        (F.sum("o_totalprice") * 1.1).alias("goal"))
    j = per.join(o, "month")
    assert j.filter(F.abs(F.col("s") - F.col("goal")) > 0.5).count() == 0


def test_s12_historize_twice_appends_nothing(spark):
    c = load(spark, SF_SMALL, "customer").select("c_custkey", "c_mktsegment")
    path = scratch_path(spark, f"test/hist-{random.random()}")
    assert SK.historize(spark, path, c, ["c_custkey"], ["c_mktsegment"], "_ts", "2024-01-01") == c.count()
    assert SK.historize(spark, path, c, ["c_custkey"], ["c_mktsegment"], "_ts", "2024-01-02") == 0


def test_s8_overwrite_lookback_is_idempotent(spark):
    e = load(spark, SF_SMALL, "events")
    daily = e.groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("n"))
    path = scratch_path(spark, f"test/lookback-{random.random()}")
    SK.write_table(daily, path, ["d"])
    SK.overwrite_lookback(daily, path, "d", 3, "2024-01-30")
    once = sorted(map(tuple, spark.read.parquet(path).select("d", "event_type", "n").collect()))
    SK.overwrite_lookback(daily, path, "d", 3, "2024-01-30")
    twice = sorted(map(tuple, spark.read.parquet(path).select("d", "event_type", "n").collect()))
    assert once == twice == sorted(map(tuple, daily.select("d", "event_type", "n").collect()))


def test_k56_sweep_equals_inequality_join(spark):
    o = load(spark, SF_SMALL, "orders").select(F.col("o_custkey").alias("c"), F.to_date("o_orderdate").alias("p"))
    b = o.agg(F.min("p").alias("lo"), F.max("p").alias("hi"))
    spine = spine_from_bounds(b, "lo", "hi")
    sweep = CU.lapsed_customers(o, "c", "p", spine, 12)
    days = o.distinct()
    literal = (spine.join(days, days.p <= spine.d).groupBy("d", "c").agg(F.max("p").alias("last_p"))
               .groupBy("d").agg(F.count_if(F.add_months("last_p", 12) < F.col("d")).alias("n")))
    j = sweep.join(literal, "d", "left").fillna(0, ["n"])
    assert j.filter(F.col("lapsed_customers") != F.col("n")).count() == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60),
       st.integers(1, 5))
def test_exact_ntile_equals_window_ntile(spark, rows, n):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g int, v int")
    ours = exact_ntile(df, n, ["v", "id"], ["g"], name="b", distributed=True)
    ref = df.withColumn("b", F.ntile(n).over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(map(tuple, ours.select("id", "b").collect())) == sorted(map(tuple, ref.select("id", "b").collect()))


def test_exact_row_number_global(spark):
    df = spark.range(0, 500).withColumn("v", (F.col("id") * 7919) % 101)
    ours = exact_row_number(df, ["v", "id"], name="rn", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    assert ours.join(ref, ["id", "rn"]).count() == 500


def test_preset_bounds_month_end_clamp():
    from growthframe.operators.periods import preset_bounds
    cur, cmp_ = preset_bounds(dt.date(2024, 2, 29), "M", "N-1")
    assert cur == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert cmp_ == (dt.date(2023, 2, 1), dt.date(2023, 2, 28))
    cur, cmp_ = preset_bounds(dt.date(2024, 3, 15), "M-1", "P-1")
    assert cur == (dt.date(2024, 2, 1), dt.date(2024, 2, 29)) and cmp_ == (dt.date(2024, 1, 3), dt.date(2024, 1, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20)), min_size=1, max_size=50),
       st.sampled_from([0.0, 0.25, 0.5, 0.9, 0.99, 1.0]))
def test_exact_percentile_equals_percentile(spark, rows, q):
    from growthframe.operators.selection import exact_percentile
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, v double")
    name = f"p{int(round(q * 100))}"
    ours = {r["g"]: r[name] for r in exact_percentile(df, "v", [q], ["g"]).collect()}
    ref = {r["g"]: r["x"] for r in df.groupBy("g").agg(F.percentile("v", q).alias("x")).collect()}
    assert ours.keys() == ref.keys() and all(abs(ours[k] - ref[k]) < 1e-9 for k in ref)


def test_map_patterns_by_kind_equals_like_join(spark):
    """Whole values, beginnings, infix patterns and wildcards, with NULLs and ties, against one LIKE join."""
    from growthframe.operators.acquisition import map_patterns
    values = ["google", "Google Ads", "goo", "bing%", "a_b", None, "", "fb.com", "x"]
    facts = spark.createDataFrame([(10 * i + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)], "id int, s string, m string")
    patterns = ["google", "GOO%", "%goo%", "a_b", "a\\\\_b", None, "", "%", "b%g%", "fb.com"]
    mapping = spark.createDataFrame([(a, b, f"{i}-{j}", (i * j) % 4) for i, a in enumerate(patterns) for j, b in enumerate(patterns)],
                                    "ps string, pm string, out string, sort int")
    cond = F.expr("(ps IS NULL OR lower(s) LIKE lower(ps)) AND (pm IS NULL OR lower(m) LIKE lower(pm))")
    plain = facts.join(mapping, cond, "left")
    got = map_patterns(facts, mapping, [("s", "ps"), ("m", "pm")], ["out"], mode="all").select("id", "out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.select("id", F.coalesce("out", F.lit("Unmapped"))).collect()))
    best = plain.groupBy("id").agg(F.min_by("out", F.struct("sort", "out")).alias("out"))
    got = map_patterns(facts, mapping, [("s", "ps"), ("m", "pm")], ["out"]).select("id", "out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, best.select("id", F.coalesce("out", F.lit("Unmapped"))).collect()))
