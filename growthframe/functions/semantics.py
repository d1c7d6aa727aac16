"""Column helpers that pin down dialect semantics.

All helpers return ``Column`` expressions built from built-in functions, so they stay
inside whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- NULL rules

def least_strict(*cols: ColumnOrName) -> Column:
    """LEAST that returns NULL when any argument is NULL (warehouse rule, M1)."""
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def greatest_strict(*cols: ColumnOrName) -> Column:
    """GREATEST that returns NULL when any argument is NULL (warehouse rule, M1)."""
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def differs_blank_equal(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``IFNULL(a,'') != IFNULL(b,'')``: NULL and '' count as equal."""
    return F.coalesce(_c(a).cast("string"), F.lit("")) != F.coalesce(_c(b).cast("string"), F.lit(""))


def is_not_true(b: ColumnOrName) -> Column:
    """``COALESCE(b, FALSE) IS DISTINCT FROM TRUE`` (P10)."""
    return ~F.coalesce(_c(b), F.lit(False))


# ---------------------------------------------------------------- arithmetic (M3)

def safe_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """SAFE_DIVIDE: NULL on a zero or NULL divisor."""
    return F.try_divide(_c(a), _c(b))


def div0(a: ColumnOrName, b: ColumnOrName) -> Column:
    """DIV0: 0 on a zero divisor."""
    return F.when(_c(b) == 0, F.lit(0.0)).otherwise(F.try_divide(_c(a), _c(b)))


def round_half_up(x: ColumnOrName, digits: int = 2) -> Column:
    """Round half up on the decimal value, as the warehouse does for money.

    Doubles are first fixed to 6 decimals so that a sum that lands on ...4999999 in one
    summation order and ...5000001 in another rounds the same way; the result is a double."""
    return F.round(_c(x).cast("decimal(38,6)"), digits).cast("double")


# ---------------------------------------------------------------- regex (M2, F-s3)

def regex_group(s: ColumnOrName, pattern: str, idx: int = 1) -> Column:
    """REGEXP_EXTRACT returning NULL on a miss (Spark returns '')."""
    sc = _c(s)
    return F.when(sc.rlike(pattern), F.regexp_extract(sc, pattern, idx))


# ---------------------------------------------------------------- dates (M4-M7, F-d*)

def to_day(x: ColumnOrName) -> Column:
    return F.to_date(_c(x))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since the epoch of a civil (TIMESTAMP_NTZ) time read as UTC, independent of
    the session time zone (``timestampdiff`` on civil times goes through the session zone and
    shifts times that fall in a daylight-saving gap). The civil fields are rebuilt as an
    instant with an explicit UTC zone."""
    c = _c(ts).cast("timestamp_ntz")
    inst = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))
    return F.unix_micros(inst)


def epoch_seconds(ts: ColumnOrName) -> Column:
    return epoch_micros(ts) / 1_000_000


def instant_from_civil(ts: ColumnOrName) -> Column:
    """TIMESTAMP (instant) for a civil UTC time, whatever the session time zone."""
    return F.timestamp_micros(epoch_micros(ts))


def civil_from_instant(ts: ColumnOrName) -> Column:
    """Civil UTC time (TIMESTAMP_NTZ) of an instant, whatever the session time zone (F-d10):
    the epoch plus a day-time interval (civil arithmetic, no zone involved)."""
    us = F.unix_micros(_c(ts))
    days = F.floor(us / 86_400_000_000)
    secs = ((us - days * 86_400_000_000) / 1_000_000).cast("decimal(18,6)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(days=days.cast("int"), secs=secs)


def months_diff(end: ColumnOrName, start: ColumnOrName) -> Column:
    """DATE_DIFF(end, start, MONTH): month boundaries crossed (M4)."""
    e, s = _c(end), _c(start)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("long")


def years_diff(end: ColumnOrName, start: ColumnOrName) -> Column:
    """DATE_DIFF(end, start, YEAR): year boundaries crossed."""
    return (F.year(_c(end)) - F.year(_c(start))).cast("long")


def quarters_diff(end: ColumnOrName, start: ColumnOrName) -> Column:
    e, s = _c(end), _c(start)
    return ((F.year(e) - F.year(s)) * 4 + F.quarter(e) - F.quarter(s)).cast("long")


def week_start(d: ColumnOrName, first_day: str = "sunday") -> Column:
    """DATE_TRUNC(d, WEEK) (Sunday) or DATE_TRUNC(d, ISOWEEK) (Monday) (M5)."""
    dc = F.to_date(_c(d))
    if first_day.lower() == "sunday":
        return F.date_sub(dc, F.dayofweek(dc) - 1)
    if first_day.lower() == "monday":
        return F.date_sub(dc, (F.dayofweek(dc) + 5) % 7)
    raise ValueError(f"unsupported first day {first_day!r}")


def weeks_diff(end: ColumnOrName, start: ColumnOrName, first_day: str = "sunday") -> Column:
    """DATE_DIFF(end, start, WEEK): week boundaries crossed."""
    return (F.datediff(week_start(end, first_day), week_start(start, first_day)) / 7).cast("long")


def iso_weekday(d: ColumnOrName) -> Column:
    """1 = Monday .. 7 = Sunday from Spark's 1 = Sunday numbering (M6)."""
    return ((F.dayofweek(_c(d)) + 5) % 7 + 1).cast("int")


def trunc_date(d: ColumnOrName, grain: str) -> Column:
    """DATE_TRUNC with warehouse grains: day, week (Sunday), isoweek, month, quarter, year."""
    g = grain.lower()
    dc = F.to_date(_c(d))
    if g == "day":
        return dc
    if g == "week":
        return week_start(dc, "sunday")
    if g == "isoweek":
        return week_start(dc, "monday")
    if g in ("month", "quarter", "year"):
        return F.to_date(F.date_trunc(g, dc))
    raise ValueError(f"unsupported grain {grain!r}")


def last_day_of(d: ColumnOrName, grain: str = "month") -> Column:
    """LAST_DAY(d, MONTH | ISOWEEK | YEAR) (F-d7)."""
    g = grain.lower()
    if g == "month":
        return F.last_day(_c(d))
    if g == "isoweek":
        return F.date_add(week_start(d, "monday"), 6)
    if g == "week":
        return F.date_add(week_start(d, "sunday"), 6)
    if g == "year":
        return F.make_date(F.year(_c(d)), F.lit(12), F.lit(31))
    raise ValueError(grain)


def age_years(dob: ColumnOrName, as_of: ColumnOrName, exact: bool = True) -> Column:
    """Age in completed years (F-d11). ``exact=False`` is the plain year difference (M7)."""
    b, a = F.to_date(_c(dob)), F.to_date(_c(as_of))
    diff = F.year(a) - F.year(b)
    if not exact:
        return diff
    return diff - F.when(F.date_format(a, "MM-dd") < F.date_format(b, "MM-dd"), 1).otherwise(0)


def parse_date_any(s: ColumnOrName, *formats: str) -> Column:
    """SAFE.PARSE_DATE over several formats, first that parses wins (F-d1)."""
    sc = _c(s)
    fmts = formats or ("yyyyMMdd", "yyyy-MM-dd", "dd/MM/yyyy")
    return F.coalesce(*[F.try_to_date(sc, f) for f in fmts])


# ---------------------------------------------------------------- nested / ordered picks

def first_non_null(x: ColumnOrName, order: ColumnOrName) -> Column:
    """FIRST_VALUE(x IGNORE NULLS) ORDER BY order, as an aggregate."""
    xc = _c(x)
    return F.min_by(xc, F.when(xc.isNotNull(), _c(order)))


def last_non_null(x: ColumnOrName, order: ColumnOrName) -> Column:
    xc = _c(x)
    return F.max_by(xc, F.when(xc.isNotNull(), _c(order)))


def param_value(arr: ColumnOrName, key: str, field: str = "string_value") -> Column:
    """Scalar subquery over UNNEST(event_params) WHERE key = k (F-a1, M8): first match."""
    return F.get(F.filter(_c(arr), lambda e: e["key"] == F.lit(key)), 0)["value"][field]


def json_str(js: ColumnOrName, path: str) -> Column:
    """JSON_EXTRACT_SCALAR / JSON_VALUE (F-j1)."""
    return F.get_json_object(_c(js), path)


def json_typed(js: ColumnOrName, path: str, dtype: str) -> Column:
    """LAX_INT64 / LAX_FLOAT64 (F-j3): NULL when the value does not convert."""
    return F.get_json_object(_c(js), path).try_cast(dtype)


def blank_to_null(x: ColumnOrName) -> Column:
    """Empty string to NULL (staging convention, K41)."""
    xc = _c(x)
    return F.when(xc != "", xc)


def ratio_capped(a: ColumnOrName, b: ColumnOrName, cap: float = 1.0) -> Column:
    """Guarded ratio capped at ``cap`` (win rate, still-active rate); NULL when it can't be formed."""
    r = F.try_divide(_c(a), _c(b))
    return F.when(r > cap, F.lit(cap)).otherwise(r)
