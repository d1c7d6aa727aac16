"""Dashboard-style formatting helpers as column expressions.

None of these is a UDF: each is a composition of built-in functions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from growthframe.functions.semantics import week_start


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def time_hm(ms) -> Column:
    """Milliseconds to "m:s" text the way the reference's helper does it: whole minutes,
    then seconds rounded half up modulo 60, no zero padding (it is minutes:seconds)."""
    s = _c(ms) / 1000.0
    minutes = F.floor(s / 60).cast("long")
    seconds = F.floor(F.pmod(s + 0.5, F.lit(60.0))).cast("long")
    return F.concat(minutes.cast("string"), F.lit(":"), seconds.cast("string"))


# Age bands (upper bound exclusive, label).
AGE_BANDS = [(20, "-20"), (35, "20-34"), (50, "35-49")]
AGE_TOP_BAND = "50+"


def age_bucket(age) -> Column:
    """Age in years to a band; NULL age stays NULL."""
    a = _c(age)
    out = None
    for hi, label in AGE_BANDS:
        out = F.when(a < hi, label) if out is None else out.when(a < hi, label)
    return F.when(a.isNull(), F.lit(None)).otherwise(out.otherwise(AGE_TOP_BAND))


def date_window(as_of: dt.date, start: str | None = None, end: str | None = None,
                rel_start: int = 1, rel_end: int = 0) -> tuple[str, str]:
    """Start / end dates from explicit values, else relative to ``as_of`` (driver-side
    parameters, not data)."""
    s = start or (as_of - dt.timedelta(days=rel_start)).isoformat()
    e = end or (as_of - dt.timedelta(days=rel_end)).isoformat()
    return s, e


def duration_text(seconds) -> Column:
    """X5: "<d> j <h> h <m> min " from a number of seconds."""
    s = _c(seconds)
    return F.concat(F.floor(s / 86400).cast("string"), F.lit(" j "),
                    F.floor(F.pmod(s, F.lit(86400)) / 3600).cast("string"), F.lit(" h "),
                    F.floor(F.pmod(s, F.lit(3600)) / 60).cast("string"), F.lit(" min "))


def pct_point_text(rate, previous) -> Column:
    """Signed percentage-point difference, one decimal, e.g. "+2.5 pts"."""
    r, p = _c(rate), _c(previous)
    sign = F.when(r >= p, "+").otherwise("")
    return F.concat(sign, F.round((r - p) * 100, 1).cast("string"), F.lit(" pts"))


def date_label(d, grain: str) -> Column:
    """Date label by chosen granularity (day, week starting Sunday, month, quarter, year)."""
    dc = F.to_date(_c(d))
    g = grain.lower()
    if g == "day":
        return F.date_format(dc, "yyyy-MM-dd")
    if g == "week":
        return F.date_format(week_start(dc, "sunday"), "yyyy-MM-dd")
    if g == "month":
        return F.date_format(dc, "yyyy-MM")
    if g == "quarter":
        return F.concat(F.year(dc).cast("string"), F.lit(" - T"), F.quarter(dc).cast("string"))
    if g == "year":
        return F.date_format(dc, "yyyy")
    raise ValueError(grain)


def month_name(d) -> Column:
    """Full English month name (FORMAT_DATE %B)."""
    return F.date_format(F.to_date(_c(d)), "MMMM")


def weekday_name(d) -> Column:
    """Full English weekday name (FORMAT_DATE %A)."""
    return F.date_format(F.to_date(_c(d)), "EEEE")


def year_month(d) -> Column:
    """Yyyymm text of a date."""
    dc = F.to_date(_c(d))
    return F.concat(F.year(dc).cast("string"), F.lpad(F.month(dc).cast("string"), 2, "0"))


def previous_year_month(d) -> Column:
    """Yyyymm of the month before ``d``."""
    return year_month(F.add_months(F.to_date(F.date_trunc("month", F.to_date(_c(d)))), -1))


def month_start_from_yyyymmdd(s) -> Column:
    """First day of the month of a yyyyMMdd text date."""
    dc = F.to_date(_c(s), "yyyyMMdd")
    return F.make_date(F.year(dc), F.month(dc), F.lit(1))
