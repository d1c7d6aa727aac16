"""Rows with NULL keys and times: bucketed helpers equal the plain window and lose no row."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from growthframe.operators import common as C
from growthframe.operators import customers as CU
from growthframe.operators import events as EV
from growthframe.operators import orders as OR
from growthframe.operators import ranking as RK
from growthframe.operators import state as ST
from growthframe.operators import subscriptions as SU
from growthframe.sources.tables import load
from tests.conftest import SF_SMALL

ORDER = ("ts", "event_id")


@pytest.fixture(scope="module")
def holes(spark):
    e = load(spark, SF_SMALL, "events")
    return e.selectExpr("event_id", "value", "if(event_id % 11 = 0, NULL, user_id) AS user_id", "if(event_id % 13 = 0, NULL, ts) AS ts",
                        "if(event_id % 7 = 0, NULL, event_type) AS event_type")


def same(a, b, *cols):
    x, y = (sorted(map(repr, d.select(*cols).collect())) for d in (a, b))
    assert x == y and len(x) > 0


def test_windows(holes):
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    k = (["user_id"], *ORDER)
    same(C.bucketed_row_number(holes, *k, "n"), holes.withColumn("n", F.row_number().over(w)), "event_id", "n")
    same(C.bucketed_lag(holes, *k, ["value"]), holes.withColumn("prev_value", F.lag("value").over(w)), "event_id", "prev_value")
    same(C.bucketed_lead(holes, *k, ["value"]), holes.withColumn("next_value", F.lead("value").over(w)), "event_id", "next_value")
    same(C.bucketed_last_non_null(holes, *k, F.col("event_type"), "v"), holes.withColumn("v", F.last("event_type", True).over(before)), "event_id", "v")
    total = F.round("s", 4)
    same(C.bucketed_running_sum(holes, *k, "value", "s"), holes.withColumn("s", F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0))), "event_id", total)
    same(C.bucketed_running_sum(holes, *k, "value", "s", exclusive=True), holes.withColumn("s", F.sum("value").over(before)), "event_id", total)


def test_sessions(holes):
    cols = ("event_id", "session_id", "session_number", "is_session_start")
    same(EV.sessionize(holes, "user_id", *ORDER), EV.sessionize(holes, "user_id", *ORDER, bucket=None), *cols)


@pytest.mark.parametrize("join,prefix", [(ST.asof_join, "asof_"), (ST.asof_join_forward, "next_")])
def test_asof_keeps_every_left_row(holes, join, prefix):
    right = holes.where("event_id % 3 = 0").select("user_id", F.date_trunc("day", "ts").alias("ts"), "value")  # ties
    left = holes.where("event_id % 3 != 0")
    out = join(left, right, ["user_id"], "ts", "ts", ["value"])
    same(out, join(left, right, ["user_id"], "ts", "ts", ["value"], bucket=None), "event_id", prefix + "value")
    assert out.count() == left.count()
    assert out.where(f"(user_id IS NULL OR ts IS NULL) AND {prefix}value IS NOT NULL").isEmpty()


def test_groups_of_null(holes):
    w = Window.partitionBy("event_type")
    same(RK.exact_row_number(holes, ORDER, ["event_type"], "n"), holes.withColumn("n", F.row_number().over(w.orderBy(*ORDER))), "event_id", "n")
    same(C.with_group_agg(holes, ["event_type"], F.count("*").alias("c")), holes.withColumn("c", F.count("*").over(w)), "event_id", "c")
    assert OR.modes(holes, ["user_id"], "event_type").where("user_id IS NULL").count() >= 1
    lines = holes.selectExpr("event_id", "user_id AS o", "value AS v", "1000.0D AS t")
    assert OR.allocate_discount(lines, "o", "v", "t").count() == lines.count()


def test_business_seconds_keeps_open_rows(spark):
    hours = spark.createDataFrame([(d, 9 * 3600, 18 * 3600) for d in range(1, 8)], "iso_weekday int, open_seconds int, close_seconds int")
    rows = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-01 10:00:00' AS s, timestamp_ntz'2024-01-01 11:00:00' AS e UNION ALL SELECT 2, timestamp_ntz'2024-01-01 10:00:00', NULL")
    assert {r["id"]: r["business_seconds"] for r in ST.business_seconds(rows, "s", "e", hours).collect()} == {1: 3600, 2: 0}


def test_caps_floors_and_cases(spark):
    a = spark.sql("SELECT 'x' AS k, date'2024-01-01' AS d")
    created, first = a.union(a), a
    assert CU.win_rate(created, first, ["k"], "d").first()["win_rate"] == 1.0
    assert CU.win_rate(created, first.limit(0), ["k"], "d").first()["win_rate"] is None
    plans = spark.sql("SELECT CAST(NULL AS double) AS m, CAST(NULL AS double) AS p, 5.0D AS a UNION ALL SELECT 3.0D, NULL, 5.0D UNION ALL SELECT 10.0D, 150.0D, NULL")
    got = [r["mrr_discounted"] for r in SU.apply_discount(plans, "m", "p", "a", "p", "a").orderBy("m").collect()]
    assert got == [None, 0.0, -5.0]


def test_running_extremes(holes):
    w = Window.partitionBy("user_id").orderBy(*ORDER)
    k = (["user_id"], *ORDER, "value")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    same(C.bucketed_running_extreme(holes, *k, "x", True, exclusive=True), holes.withColumn("x", F.max("value").over(before)), "event_id", "x")
    same(C.bucketed_running_extreme(holes, *k, "x", False), holes.withColumn("x", F.min("value").over(w.rowsBetween(Window.unboundedPreceding, 0))), "event_id", "x")
