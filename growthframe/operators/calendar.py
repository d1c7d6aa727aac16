"""Date spines, densification, business calendar, public holidays, daily goals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthframe.functions.semantics import iso_weekday, week_start

_STEP = {"day": "1 day", "week": "7 days", "month": "1 month", "year": "1 year"}


def date_spine(spark: SparkSession, start, end, grain: str = "day", name: str = "d") -> DataFrame:
    """One row per period between two literal dates (inclusive), on executors."""
    one = spark.range(1)
    seq = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"),
                     F.expr(f"INTERVAL {_STEP[grain]}"))
    return one.select(F.explode(seq).alias(name))


def spine_from_bounds(bounds: DataFrame, lo: str, hi: str, grain: str = "day", name: str = "d") -> DataFrame:
    """K91 / S18 without a driver round trip: ``bounds`` is a one-row aggregate of the data
    (e.g. ``agg(min(date), max(date))``) and the spine is exploded from it on an executor.
    The spine size depends on the date range, not on the row count."""
    seq = F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"), F.expr(f"INTERVAL {_STEP[grain]}"))
    return bounds.filter(F.col(hi) >= F.col(lo)).select(F.explode(seq).alias(name))


def densify(df: DataFrame, spine: DataFrame, date_col: str, keys: Sequence[str],
            fill: dict | None = None, grain: str = "day") -> DataFrame:
    """Every (key, period) pair over the spine's range, measures filled.

    Each distinct key generates its own period sequence between the spine's bounds (two
    scalar subqueries), so no cross join is planned; the join back to the facts is an
    equi-join on (keys, date)."""
    sc = spine.columns[0]
    lo = spine.agg(F.min(sc)).scalar()
    hi = spine.agg(F.max(sc)).scalar()
    keyset = df.select(*keys).distinct()
    grid = keyset.select(*keys, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {_STEP[grain]}"))).alias(date_col))
    out = grid.join(df, [*keys, date_col], "left")
    if fill:
        out = out.fillna(fill)
    return out


# French public holidays (month, day, name) and Easter offsets (days, name).
FIXED_HOLIDAYS = [
    (1, 1, "Jour de l An"),
    (5, 1, "Fête du Travail"),
    (5, 8, "Victoire 1945"),
    (7, 14, "Fête Nationale"),
    (8, 15, "Assomption"),
    (11, 1, "Toussaint"),
    (11, 11, "Armistice 1918"),
    (12, 25, "Noël"),
]
EASTER_OFFSETS = [
    (1, "Lundi de Pâques"),
    (39, "Ascension"),
    (50, "Lundi de Pentecôte"),
]


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian / Meeus-Jones-Butcher computus),
    as integer column arithmetic."""
    y = year.cast("int")
    a = y % 19
    b = F.floor(y / 100).cast("int")
    c = y % 100
    d = F.floor(b / 4).cast("int")
    e = b % 4
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4).cast("int")
    k = c % 4
    ll = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * ll) / 451).cast("int")
    month = F.floor((h + ll - 7 * m + 114) / 31).cast("int")
    day = (h + ll - 7 * m + 114) % 31 + 1
    return F.make_date(y, month, day)


def public_holidays(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Fixed and Easter-based holidays for every year in ``years``."""
    fixed = F.array(*[F.struct(F.make_date(F.col(year_col).cast("int"), F.lit(mo), F.lit(da)).alias("holiday_date"),
                               F.lit(nm).alias("holiday_name"), F.lit("fixed").alias("holiday_type"))
                      for mo, da, nm in FIXED_HOLIDAYS])
    easter = easter_sunday(F.col(year_col))
    movable = F.array(*[F.struct(F.date_add(easter, off).alias("holiday_date"), F.lit(nm).alias("holiday_name"),
                                 F.lit("movable").alias("holiday_type")) for off, nm in EASTER_OFFSETS])
    return years.select(F.col(year_col).cast("int").alias("year"),
                        F.explode(F.concat(fixed, movable)).alias("h")).select("year", "h.*")


def calendar(spine: DataFrame, date_col: str = "d") -> DataFrame:
    """Calendar attributes over a day spine, with holiday and business-day flags.

    Fiscal year runs October to September. Holidays are computed for the years of the spine
    (a handful of rows) and broadcast."""
    d = F.col(date_col)
    years = spine.select(F.year(d).alias("year")).distinct()
    hol = public_holidays(years).select("holiday_date").distinct()
    q = F.quarter(d)
    y = F.year(d)
    fiscal = F.when(q <= 3, F.concat(F.lit("exercice "), (y - 1).cast("string"), F.lit("-"), y.cast("string"))) \
        .otherwise(F.concat(F.lit("exercice "), y.cast("string"), F.lit("-"), (y + 1).cast("string")))
    day_name = F.date_format(d, "EEEE")
    weekend = day_name.isin("Saturday", "Sunday")
    # holidays: 11 rows per year of the spine, a bounded table
    out = spine.join(F.broadcast(hol), d == F.col("holiday_date"), "left")
    return out.select(
        F.date_format(d, "yyyy-MM-dd").alias("id"), d.alias("date_actual"),
        y.alias("year_number"), F.to_date(F.date_trunc("year", d)).alias("year_trunc"),
        fiscal.alias("fiscal_year"),
        q.alias("quarter_number"), F.concat(F.lit("Q"), q.cast("string")).alias("quarter_name"),
        F.to_date(F.date_trunc("quarter", d)).alias("quarter_trunc"),
        F.month(d).alias("month_number"), F.date_format(d, "MMMM").alias("month_name"),
        F.to_date(F.date_trunc("month", d)).alias("month_trunc"),
        F.weekofyear(d).alias("week_number_in_year"),
        F.concat(y.cast("string"), F.lit(" W"), F.weekofyear(d).cast("string")).alias("week_name"),
        week_start(d, "monday").alias("week_trunc"),
        F.dayofmonth(d).alias("day_number_in_month"), iso_weekday(d).alias("day_number_in_week"),
        day_name.alias("day_name"), (~weekend).alias("day_is_weekday"),
        F.col("holiday_date").isNotNull().alias("is_public_holiday"),
        ((~weekend) & F.col("holiday_date").isNull()).alias("is_business_day"))


def daily_goals(monthly: DataFrame, cal: DataFrame, month_col: str, goal_col: str,
                keys: Sequence[str] = ()) -> DataFrame:
    """A monthly target spread evenly over the business days of the month, 0 on other days.

    ``cal`` is the output of :func:`calendar`; the join is an equi-join on the month."""
    days = cal.select(F.col("date_actual").alias("d"), F.col("month_trunc").alias(month_col), "is_business_day")
    bd = days.groupBy(month_col).agg(F.count_if("is_business_day").alias("business_days"))
    j = monthly.join(days, month_col).join(bd, month_col)
    per_day = F.when(F.col("is_business_day"), F.try_divide(F.col(goal_col), F.col("business_days"))).otherwise(0.0)
    return j.select(*keys, month_col, "d", "is_business_day", per_day.alias("daily_goal"))
