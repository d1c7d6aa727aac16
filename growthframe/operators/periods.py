"""Period comparisons, presets, report layouts and wide KPI unions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import trunc_date


def _between(d: Column, lo, hi) -> Column:
    return d.between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date"))


def compare_periods(df: DataFrame, date: str, periods: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Each row repeated once per period (label, start, end) that contains its date.

    One scan with ``explode(filter(array(when ...)))`` instead of one scan per period glued
    with UNION ALL."""
    d = F.to_date(F.col(date))
    arr = F.array(*[F.when(_between(d, lo, hi), F.lit(lab)) for lab, lo, hi in periods])
    return df.withColumn("period", F.explode(F.filter(arr, lambda x: x.isNotNull())))


def compare_measures(df: DataFrame, keys: Sequence[str], date: str, measures: dict[str, Column],
                     periods: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Every measure once per period as its own column (``<measure>_<period>``), from
    one scan with conditional aggregates."""
    d = F.to_date(F.col(date))
    any_p = None
    aggs = []
    for lab, lo, hi in periods:
        inside = _between(d, lo, hi)
        any_p = inside if any_p is None else (any_p | inside)
        for name, expr in measures.items():
            aggs.append(expr(inside).alias(f"{name}_{lab}") if callable(expr) else
                        F.sum(F.when(inside, expr)).alias(f"{name}_{lab}"))
    return df.filter(any_p).groupBy(*keys).agg(*aggs)


def preset_bounds(as_of: dt.date, preset: str, comparison: str) -> tuple[tuple[dt.date, dt.date], tuple[dt.date, dt.date]]:
    """(current, comparison) date ranges for a preset: M (month to date), M-1 (previous
    full month), YTD, L12M (last 12 full months); comparison P-1 (previous period of the
    same length) or N-1 (same range one year earlier, clamped at month ends). Driver-side
    arithmetic on the parameters only."""
    def add_months(d: dt.date, n: int) -> dt.date:
        y, m = divmod(d.month - 1 + n, 12)
        y += d.year
        m += 1
        import calendar
        return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))

    first = as_of.replace(day=1)
    if preset == "M":
        cur = (first, as_of)
    elif preset == "M-1":
        s = add_months(first, -1)
        cur = (s, first - dt.timedelta(days=1))
    elif preset == "YTD":
        cur = (as_of.replace(month=1, day=1), as_of)
    elif preset == "L12M":
        cur = (add_months(first, -12), first - dt.timedelta(days=1))
    else:
        raise ValueError(preset)
    if comparison == "N-1":
        cmp_ = (add_months(cur[0], -12), add_months(cur[1], -12))
    elif comparison == "P-1":
        length = (cur[1] - cur[0]).days + 1
        cmp_ = (cur[0] - dt.timedelta(days=length), cur[0] - dt.timedelta(days=1))
    else:
        raise ValueError(comparison)
    return cur, cmp_


def preset_periods(df: DataFrame, date: str, presets: Sequence[tuple[str, str]], as_of: dt.date) -> DataFrame:
    """Rows inside each (preset, comparison) range labelled current / comparison with
    the day index inside their range (1 = first day)."""
    d = F.to_date(F.col(date))
    items = []
    for preset, comp in presets:
        (c0, c1), (p0, p1) = preset_bounds(as_of, preset, comp)
        for side, lo, hi in (("current", c0, c1), ("comparison", p0, p1)):
            items.append(F.when(_between(d, lo, hi), F.struct(
                F.lit(f"{preset} vs {comp}").alias("preset"), F.lit(side).alias("side"),
                (F.datediff(d, F.lit(str(lo)).cast("date")) + 1).alias("day_index"))))
    return df.withColumn("_p", F.explode(F.filter(F.array(*items), lambda x: x.isNotNull()))) \
        .select("*", "_p.*").drop("_p")


def blank_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Report layout where each group key is shown on the first row of its group only
    (hierarchically: key i is blank unless the row starts a new (key 1..i) group).

    Meant for a final report (an aggregate): the row order is global, so it runs on the
    already-small result."""
    w = Window.orderBy(*order)
    out = df
    for i, k in enumerate(keys):
        wp = Window.partitionBy(*keys[: i + 1]).orderBy(*order)
        out = out.withColumn(f"_first_{i}", F.row_number().over(wp) == 1)
    for i, k in enumerate(keys):
        out = out.withColumn(f"{k}_display", F.when(F.col(f"_first_{i}"), F.col(k).cast("string")).otherwise(F.lit("")))
    return out.drop(*[f"_first_{i}" for i in range(len(keys))]).withColumn("_row", F.row_number().over(w))


def rollup_by_scale(df: DataFrame, date: str, entity: str, scale: str, start, end) -> DataFrame:
    """KPIs by day / week (ISO) / month / whole range between start and end: period
    bounds clipped to the range, rows, distinct entities and the average rows per entity
    (a per-(period, entity) aggregate, then a second aggregate)."""
    d = F.to_date(F.col(date))
    lo, hi = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    x = df.filter(d.between(lo, hi))
    if scale == "range":
        p_start, p_end = lo, hi
    else:
        grain = {"day": "day", "week": "isoweek", "month": "month"}[scale]
        p_start = F.greatest(trunc_date(d, grain), lo)
        raw_end = {"day": d, "week": F.date_add(trunc_date(d, "isoweek"), 6), "month": F.last_day(d)}[scale]
        p_end = F.least(raw_end, hi)
    per = x.groupBy(p_start.alias("period_start"), p_end.alias("period_end"), entity).agg(F.count("*").alias("_n"))
    return per.groupBy("period_start", "period_end").agg(
        F.sum("_n").alias("rows"), F.count("*").alias("entities"), F.avg("_n").alias("avg_rows_per_entity"))


def wide_union_kpis(df: DataFrame, specs: Sequence[tuple[str, str, str]], grain: str = "day") -> DataFrame:
    """Many measures, each dated by its own date column and counting distinct ids:
    (measure, date column, id column). Each row emits one (measure, date, id) struct per spec
    with a non-NULL date (one explode), then ONE aggregate: one scan instead of one per measure.
    Ids keep their native type when all specs share it (cheaper hashing than strings)."""
    types = {df.schema[idc].dataType.simpleString() for _, _, idc in specs}
    id_col = (lambda c: F.col(c)) if len(types) == 1 else (lambda c: F.col(c).cast("string"))
    arr = F.array(*[F.struct(F.lit(m).alias("measure"), trunc_date(F.col(dc), grain).alias("d"),
                             id_col(idc).alias("id")) for m, dc, idc in specs])
    x = df.select(F.explode(F.filter(arr, lambda s: s["d"].isNotNull())).alias("s")).select("s.*")
    return x.groupBy("measure", "d").agg(F.countDistinct("id").alias("value"))
