"""Paired queries for scalar functions and small helpers (F-s*, F-d*, F-m*, F-c*, F-a*, F-j*, X2).

Each query applies the helpers to whole tables; DuckDB spells the same rule with its own
functions (|| for NULL-propagating concatenation, isodow, strptime, ...).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.functions import formatting as FM
from growthframe.functions import semantics as S
from growthframe.plans.registry import paired
from growthframe.sources.tables import load


@paired("f_string_functions", r"""
SELECT p_partkey, lower(p_name) AS lower_name,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS initcap_name,
  replace(p_brand, 'Brand#', 'B') AS short_brand, lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_padded,
  left(p_type, 3) AS type_prefix, right(p_brand, 2) AS brand_suffix, length(p_name) AS name_length,
  p_name || CASE WHEN p_size > 25 THEN NULL ELSE '-small' END AS concat_null_rule,
  split_part(p_name, ' ', 1) AS first_word, string_split(p_name, ' ')[2] AS second_word,
  NULLIF(regexp_extract(p_name, '(ring|widget)$', 1), '') AS suffix_match
FROM part
""", covers=("F-s1", "F-s2", "F-s3", "F-s5", "M2"))
def f_strings(spark, sf):
    p = load(spark, sf, "part")
    return p.select(
        "p_partkey", F.lower("p_name").alias("lower_name"), F.initcap("p_name").alias("initcap_name"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("short_brand"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_padded"),
        F.left("p_type", F.lit(3)).alias("type_prefix"), F.right("p_brand", F.lit(2)).alias("brand_suffix"),
        F.length("p_name").cast("long").alias("name_length"),
        F.concat("p_name", F.when(F.col("p_size") > 25, F.lit(None)).otherwise(F.lit("-small"))).alias("concat_null_rule"),
        F.get(F.split("p_name", " "), 0).alias("first_word"), F.get(F.split("p_name", " "), 1).alias("second_word"),
        S.regex_group("p_name", "(ring|widget)$", 1).alias("suffix_match"))


@paired("f_date_functions", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey,
  CAST(strptime(strftime(d, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed_compact,
  CAST(try_strptime(strftime(d, '%Y%m') || '31', '%Y%m%d') AS DATE) AS safe_parsed_31st,
  CAST(strptime(strftime(d, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed_slash,
  year(d) AS y, quarter(d) AS q, month(d) AS m, weekofyear(d) AS iso_week, day(d) AS dom, dayofweek(d) + 1 AS dow_sunday_1,
  isodow(d) AS iso_dow, hour(o_orderdate + to_seconds(o_orderkey % 86400)) AS hh, minute(o_orderdate + to_seconds(o_orderkey % 86400)) AS mi,
  make_date(year(d), month(d), 1) AS month_start, make_timestamp(year(d), month(d), day(d), 12, 30, 0.0) AS noon_thirty,
  to_timestamp(epoch(o_orderdate) + o_orderkey)::TIMESTAMP AS from_epoch,
  timezone('Europe/Paris', timezone('UTC', o_orderdate)) AS paris_time,
  CAST(d + INTERVAL 1 MONTH AS DATE) AS plus_month, CAST(d - INTERVAL 7 DAY AS DATE) AS minus_week,
  last_day(d) AS month_end, CAST(date_trunc('week', d) AS DATE) + 6 AS iso_week_end,
  date_diff('day', d, DATE '2001-08-01') AS days_to_end,
  (year(DATE '2001-08-01') - year(d)) * 12 + month(DATE '2001-08-01') - month(d) AS months_to_end,
  year(DATE '2001-08-01') - year(d) AS years_to_end,
  CAST(date_diff('day', CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE), DATE '2001-07-29') / 7 AS BIGINT) AS sunday_weeks_to_end,
  date_diff('minute', o_orderdate, o_orderdate + to_seconds(o_orderkey * 61)) AS minutes_span
FROM o
""", covers=("F-d1", "F-d2", "F-d4", "F-d5", "F-d6", "F-d7", "F-d8", "F-d9", "F-d10", "M4", "M5", "M6"))
def f_dates(spark, sf):
    o = load(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    t2 = F.col("o_orderdate") + F.make_interval(secs=F.col("o_orderkey") % 86400)
    end = F.lit("2001-08-01").cast("date")
    out = o.select(
        "o_orderkey",
        F.to_date(F.date_format(d, "yyyyMMdd"), "yyyyMMdd").alias("parsed_compact"),
        S.parse_date_any(F.concat(F.date_format(d, "yyyyMM"), F.lit("31")), "yyyyMMdd").alias("safe_parsed_31st"),
        F.to_date(F.date_format(d, "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed_slash"),
        F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.weekofyear(d).alias("iso_week"),
        F.dayofmonth(d).alias("dom"), F.dayofweek(d).alias("dow_sunday_1"), S.iso_weekday(d).alias("iso_dow"),
        F.hour(t2).alias("hh"), F.minute(t2).alias("mi"),
        F.make_date(F.year(d), F.month(d), F.lit(1)).alias("month_start"),
        F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.lit(12), F.lit(30), F.lit(0)).alias("noon_thirty"),
        S.civil_from_instant(F.timestamp_seconds(S.epoch_seconds("o_orderdate").cast("long") + F.col("o_orderkey")))
        .alias("from_epoch"),
        # civil UTC time to civil Paris time, independent of the session time zone
        F.convert_timezone(F.lit("UTC"), F.lit("Europe/Paris"), F.col("o_orderdate")).alias("paris_time"),
        F.add_months(d, 1).alias("plus_month"), F.date_sub(d, 7).alias("minus_week"),
        S.last_day_of(d, "month").alias("month_end"), S.last_day_of(d, "isoweek").alias("iso_week_end"),
        F.datediff(end, d).alias("days_to_end"), S.months_diff(end, d).alias("months_to_end"),
        S.years_diff(end, d).alias("years_to_end"), S.weeks_diff(end, d, "sunday").alias("sunday_weeks_to_end"),
        F.floor((S.epoch_micros(F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") * 61))
                 - S.epoch_micros("o_orderdate")) / 60_000_000).alias("minutes_span"))
    ints = ["y", "q", "m", "iso_week", "dom", "dow_sunday_1", "iso_dow", "hh", "mi",
            "days_to_end", "years_to_end", "minutes_span"]
    for c in ints:
        out = out.withColumn(c, F.col(c).cast("long"))
    return out


@paired("f_age_and_buckets", """
WITH c AS (SELECT c_custkey, CAST(DATE '2001-08-01' - to_years(CAST(18 + c_custkey % 60 AS INTEGER)) + to_days(CAST(c_custkey % 365 AS INTEGER)) AS DATE) AS dob FROM customer),
a AS (SELECT *, year(DATE '2001-08-01') - year(dob) - CASE WHEN strftime(DATE '2001-08-01', '%m-%d') < strftime(dob, '%m-%d') THEN 1 ELSE 0 END AS age,
             year(DATE '2001-08-01') - year(dob) AS age_uncorrected FROM c)
SELECT c_custkey, dob, age, age_uncorrected,
  CASE WHEN age IS NULL THEN NULL WHEN age < 20 THEN '-20' WHEN age < 35 THEN '20-34' WHEN age < 50 THEN '35-49' ELSE '50+' END AS age_range
FROM a
""", covers=("F-d11", "X2", "M7"))
def f_age(spark, sf):
    c = load(spark, sf, "customer")
    end = F.lit("2001-08-01").cast("date")
    dob = F.date_add(F.add_months(end, -12 * (18 + F.col("c_custkey") % 60).cast("int")), (F.col("c_custkey") % 365)
                     .cast("int"))
    x = c.select("c_custkey", dob.alias("dob"))
    return x.select("c_custkey", "dob", S.age_years("dob", end).cast("long").alias("age"),
                    S.age_years("dob", end, exact=False).cast("long").alias("age_uncorrected"),
                    FM.age_bucket(S.age_years("dob", end)).alias("age_range"))


@paired("f_math_cast_arrays_json", """
SELECT l_orderkey, l_linenumber,
  CAST(ROUND(CAST(l_extendedprice / 7 AS DECIMAL(38,6)), 2) AS DOUBLE) AS rounded, floor(l_extendedprice / 1000) AS thousands,
  l_linenumber % 3 AS mod3, abs(l_tax - 0.04) AS abs_tax_gap,
  l_extendedprice / NULLIF(l_quantity - 25, 0) AS safe_div,
  CASE WHEN l_quantity - 25 = 0 THEN 0.0 ELSE l_extendedprice / (l_quantity - 25) END AS div0,
  CASE WHEN l_tax IS NULL OR CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END IS NULL THEN NULL
       ELSE greatest(l_tax, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END) END AS greatest_strict,
  TRY_CAST(l_returnflag AS INTEGER) AS try_cast_flag, CAST(l_quantity AS BIGINT) AS qty_int,
  len([l_returnflag, l_linestatus]) AS arr_size, [l_returnflag, l_linestatus][3] AS safe_offset_miss,
  json_extract_string('{"a": {"b": ' || CAST(l_linenumber AS VARCHAR) || '}}', '$.a.b') AS json_path_value
FROM lineitem
""", covers=("F-m1", "F-m2", "F-m3", "F-m4", "F-c2", "F-a4", "F-j5", "M1", "M3"))
def f_math(spark, sf):
    li = load(spark, sf, "lineitem")
    disc = F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_discount"))
    arr = F.array("l_returnflag", "l_linestatus")
    js = F.concat(F.lit('{"a": {"b": '), F.col("l_linenumber").cast("string"), F.lit("}}"))
    return li.select(
        "l_orderkey", "l_linenumber", S.round_half_up(F.col("l_extendedprice") / 7, 2).alias("rounded"),
        F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("thousands"),
        (F.col("l_linenumber") % 3).alias("mod3"), F.abs(F.col("l_tax") - 0.04).alias("abs_tax_gap"),
        S.safe_divide("l_extendedprice", F.col("l_quantity") - 25).alias("safe_div"),
        S.div0("l_extendedprice", F.col("l_quantity") - 25).alias("div0"),
        S.greatest_strict("l_tax", disc).alias("greatest_strict"),
        F.col("l_returnflag").try_cast("int").alias("try_cast_flag"), F.col("l_quantity").cast("long").alias("qty_int"),
        F.size(arr).cast("long").alias("arr_size"), F.get(arr, 2).alias("safe_offset_miss"),
        F.variant_get(F.parse_json(js), "$.a.b", "string").alias("json_path_value"))
