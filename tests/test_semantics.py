"""Inline micro-fixtures for the dialect rules of SURVEY 2.12."""

import datetime as dt

from pyspark.sql import functions as F

from growthframe.functions import formatting as FM
from growthframe.functions import semantics as S


def one(spark, expr, schema="x int", rows=((1,),)):
    return spark.createDataFrame(list(rows), schema).select(expr.alias("r")).collect()[0]["r"]


def test_m1_strict_least_greatest(spark):
    df = spark.createDataFrame([(1, None), (3, 2)], "a int, b int")
    out = df.select(S.least_strict("a", "b").alias("l"), S.greatest_strict("a", "b").alias("g"),
                    F.least("a", "b").alias("spark_least")).collect()
    assert out[0]["l"] is None and out[0]["g"] is None and out[0]["spark_least"] == 1
    assert out[1]["l"] == 2 and out[1]["g"] == 3


def test_m2_regex_miss_is_null(spark):
    df = spark.createDataFrame([("a?gclid=xyz",), ("no-click",), ("a?gclid=",)], "u string")
    out = [r[0] for r in df.select(S.regex_group("u", r"[?&]gclid=([^&]*)", 1)).collect()]
    assert out == ["xyz", None, ""]


def test_m3_division_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    out = df.select(S.safe_divide("a", "b").alias("s"), S.div0("a", "b").alias("z")).collect()
    assert out[0]["s"] is None and out[0]["z"] == 0.0 and out[1]["s"] == 0.25


def test_m4_month_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31), dt.date(2024, 2, 1))], "a date, b date")
    r = df.select(S.months_diff("b", "a").alias("m"), S.years_diff("b", "a").alias("y")).first()
    assert r["m"] == 1 and r["y"] == 0


def test_m5_week_starts(spark):
    # 2024-01-03 is a Wednesday
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 7),)], "d date")
    out = df.select(S.week_start("d", "sunday").alias("s"), S.week_start("d", "monday").alias("m")).collect()
    assert out[0]["s"] == dt.date(2023, 12, 31) and out[0]["m"] == dt.date(2024, 1, 1)
    assert out[1]["s"] == dt.date(2024, 1, 7) and out[1]["m"] == dt.date(2024, 1, 1)


def test_m5_sunday_week_difference(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6), dt.date(2024, 1, 7))], "a date, b date")
    assert df.select(S.weeks_diff("b", "a")).first()[0] == 1


def test_m6_iso_weekday(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    assert [r[0] for r in df.select(S.iso_weekday("d")).collect()] == [7, 1]


def test_m7_age_corrected_and_uncorrected(spark):
    df = spark.createDataFrame([(dt.date(2000, 6, 15),)], "dob date")
    r = df.select(S.age_years("dob", F.lit("2024-06-14").cast("date")).alias("a"),
                  S.age_years("dob", F.lit("2024-06-14").cast("date"), exact=False).alias("b")).first()
    assert r["a"] == 23 and r["b"] == 24


def test_m8_first_param_match(spark):
    df = spark.createDataFrame(
        [([("page", ("a", None)), ("page", ("b", None)), ("k", (None, 3))],)],
        "p array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>")
    r = df.select(S.param_value("p", "page").alias("page"), S.param_value("p", "k", "int_value").alias("k"),
                  S.param_value("p", "missing").alias("m")).first()
    assert r["page"] == "a" and r["k"] == 3 and r["m"] is None


def test_m9_explode_drops_or_keeps_empty(spark):
    df = spark.createDataFrame([(1, []), (2, ["x"])], "id int, a array<string>")
    assert df.select("id", F.explode("a")).count() == 1
    assert df.select("id", F.explode_outer("a")).count() == 2


def test_m12_blank_equals_null(spark):
    df = spark.createDataFrame([(None, ""), ("a", "b"), ("a", "a")], "a string, b string")
    assert [r[0] for r in df.select(S.differs_blank_equal("a", "b")).collect()] == [False, True, False]


def test_m13_false_comparison_drops_nulls(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert df.filter(F.col("b") == F.lit(False)).count() == 1
    assert df.filter(S.is_not_true("b")).count() == 2


def test_m14_collect_drops_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, None), (1, "a")], "k int, v string")
    assert df.groupBy("k").agg(F.array_sort(F.collect_list("v"))).first()[1] == ["a", "b"]


def test_m18_same_day_last_year_clamps(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert df.select(F.add_months("d", -12)).first()[0] == dt.date(2023, 2, 28)


def test_m22_m24_rounding_half_up_on_decimal(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,)], "x double")
    assert [r[0] for r in df.select(S.round_half_up("x", 2)).collect()] == [1.01, 2.68, -1.01]


def test_m25_sequence_guard(spark):
    from growthframe.operators.subscriptions import spread_periods
    df = spark.createDataFrame([(dt.date(2024, 1, 15), 0, 10.0), (dt.date(2024, 1, 15), 3, 30.0)],
                               "s date, months int, amount double")
    out = spread_periods(df, "s", "months", "amount").collect()
    assert len(out) == 3 and all(r["monthly_amount"] == 10.0 for r in out)


def test_m26_first_non_null(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "x"), (1, 3, "y")], "k int, t int, v string")
    r = df.groupBy("k").agg(S.first_non_null("v", "t").alias("f"), F.min_by("v", "t").alias("plain")).first()
    assert r["f"] == "x" and r["plain"] is None


def test_x1_time_hm(spark):
    # 59.6 s: whole minutes 0, seconds (59.6 + 0.5) mod 60 = 0.1 -> "0:0" (the helper's own
    # rounding quirk: the rounded-up minute is not carried)
    df = spark.createDataFrame([(125_400.0,), (59_600.0,)], "ms double")
    assert [r[0] for r in df.select(FM.time_hm("ms")).collect()] == ["2:5", "0:0"]


def test_x2_age_bucket(spark):
    df = spark.createDataFrame([(19,), (20,), (49,), (50,), (None,)], "a int")
    assert [r[0] for r in df.select(FM.age_bucket("a")).collect()] == ["-20", "20-34", "35-49", "50+", None]


def test_x3_date_window():
    assert FM.date_window(dt.date(2024, 3, 10)) == ("2024-03-09", "2024-03-10")
    assert FM.date_window(dt.date(2024, 3, 10), start="2024-01-01", rel_end=2) == ("2024-01-01", "2024-03-08")


def test_x5_x6_x7(spark):
    df = spark.createDataFrame([(90061, 0.25, 0.2, dt.date(2024, 5, 8))], "s long, r double, p double, d date")
    r = df.select(FM.duration_text("s").alias("t"), FM.pct_point_text("r", "p").alias("pp"),
                  FM.date_label("d", "quarter").alias("q"), FM.date_label("d", "week").alias("w")).first()
    assert r["t"] == "1 j 1 h 1 min " and r["pp"] == "+5.0 pts" and r["q"] == "2024 - T2" and r["w"] == "2024-05-05"


def test_parse_date_any_formats(spark):
    df = spark.createDataFrame([("20240131",), ("2024-01-31",), ("31/01/2024",), ("2024-02-30",)], "s string")
    out = [r[0] for r in df.select(S.parse_date_any("s")).collect()]
    assert out[:3] == [dt.date(2024, 1, 31)] * 3 and out[3] is None


def test_epoch_arithmetic_is_session_zone_free(spark):
    # 1995-04-02 02:46 does not exist in New York; civil arithmetic must not care
    df = spark.createDataFrame([(dt.datetime(1995, 4, 2, 0, 0), dt.datetime(1995, 4, 2, 2, 46, 44))], "a timestamp_ntz, b timestamp_ntz")
    prev = spark.conf.get("spark.sql.session.timeZone")
    out = []
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = df.select(((S.epoch_micros("b") - S.epoch_micros("a")) / 60_000_000).alias("m"),
                          S.civil_from_instant(S.instant_from_civil("b")).alias("back")).first()
            out.append((r["m"], r["back"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert out[0] == out[1] and out[0][1] == dt.datetime(1995, 4, 2, 2, 46, 44)


def test_k76_refund_patterns(spark):
    from growthframe.operators.order_facts import refund_amount
    rows = [("Nous avons remboursé 12.5 €",), ("We refunded €7",), ("3.25 € (dans la devise de base du magasin)",),
            ("€4.75 (in store's base currency)",), ("Gift card was created for refund for amount 30 with code X",),
            ("no refund here",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    assert [r[0] for r in df.select(refund_amount("c")).collect()] == [12.5, 7.0, 3.25, 4.75, 30.0, 0.0, 0.0]
