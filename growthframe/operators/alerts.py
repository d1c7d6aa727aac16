"""Event-volume alerting (K109-K111, T5).

The input is a daily volume table (site, event, date, count): a per-day aggregate of the raw
events, so every alert computation runs over (pairs x days), never over raw events. The
alert history is read back (self-read) and passed in; suppression is computed from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import round_half_up

PAIR = ["website", "event_name"]


def daily_volumes(events: DataFrame, site: Column, event: str, ts: str) -> DataFrame:
    """T4 (batch form): tumbling one-day counts per site and event."""
    return events.groupBy(site.alias("website"), F.col(event).alias("event_name"),
                          F.to_date(F.col(ts)).alias("date")).agg(F.count("*").alias("m_events"))


def zero_event_alerts(daily: DataFrame, history: DataFrame, holidays: DataFrame, as_of, lookback_days: int = 180,
                      b2b_pattern: str = "%B2B%") -> DataFrame:
    """K109: pairs seen in the lookback window with no event on the monitored day (as_of - 1).

    'new' alert: the day before had events, and no alert of this kind in the last day.
    'repeated' alert: 8 empty days in a row and the last alert at least 7 days ago. B2B sites are
    not alerted on weekends or public holidays. Per-day counts minus_1..minus_8 come from
    ONE conditional aggregate over the last 8 days."""
    a = F.lit(as_of).cast("date")
    mon = F.date_sub(a, 1)
    seen = daily.filter((F.col("date") >= F.date_sub(a, lookback_days)) & (F.col("date") < a)).select(*PAIR).distinct()
    recent = daily.filter((F.col("date") >= F.date_sub(a, 8)) & (F.col("date") < a))
    counts = recent.groupBy(*PAIR).agg(*[
        F.sum(F.when(F.col("date") == F.date_sub(a, k), F.col("m_events")).otherwise(0)).alias(f"minus_{k}")
        for k in range(1, 9)])
    x = seen.join(counts, PAIR, "left").fillna(0, [f"minus_{k}" for k in range(1, 9)])
    last = history.filter(F.col("alert_type") == "zero_event").groupBy(*PAIR).agg(
        F.max("alert_date").alias("last_alert_date"), F.min("alert_date").alias("first_alert_date"))
    x = x.join(last, PAIR, "left")
    x = x.withColumn("monitored_date", mon)
    since = F.datediff(a, F.col("last_alert_date"))
    new = (F.col("minus_1") == 0) & (F.col("minus_2") > 0) & (F.col("last_alert_date").isNull() | (since >= 1))
    all_empty = F.lit(True)
    for k in range(1, 9):
        all_empty = all_empty & (F.col(f"minus_{k}") == 0)
    repeated = F.coalesce(all_empty & (since >= 7), F.lit(False))  # only what was alerted before repeats
    out = x.filter(_alerting_day(mon, holidays, b2b_pattern) & (new | repeated))
    return out.select(F.lit("zero_event").alias("alert_type"), *PAIR, "monitored_date",
                      new.alias("is_new_alert"), F.col("last_alert_date").alias("previous_alert_date"),
                      F.coalesce("first_alert_date", "monitored_date").alias("first_alert_date"),
                      F.concat(F.lit("Event "), F.col("event_name"), F.lit(" was collected "),
                               F.col("minus_1").cast("string"), F.lit(" times on "),
                               F.col("monitored_date").cast("string")).alias("rationale"))


def _alerting_day(monitored: Column, holidays: DataFrame, b2b_pattern: str) -> Column:
    """B2B sites are not alerted on weekends and public holidays; the monitored day is one date for
    the whole run, so whether it is a holiday is a scalar subquery over the holiday table."""
    is_holiday = holidays.agg(F.count_if(F.col("holiday_date") == monitored)).scalar() > 0
    return ~F.col("website").like(b2b_pattern) | (~F.dayofweek(monitored).isin(1, 7) & ~is_holiday)


def variation_alerts(flags: DataFrame, history: DataFrame, holidays: DataFrame, as_of, persistence: int = 7,
                     b2b_pattern: str = "%B2B%") -> DataFrame:
    """K110 / K111: the relative-variation alerts of the monitored day (``as_of`` - 1), from
    :func:`relative_variation`.

    'new': alerting, not alerting the day before, and no alert of this kind in the last day. 'repeated':
    alerting through all ``persistence`` days before as well, and the last alert at least 7 days ago. A pair
    that was never alerted can't repeat."""
    a = F.lit(as_of).cast("date")
    mon = F.date_sub(a, 1)
    last = history.filter(F.col("alert_type") == "relative_variation").groupBy(*PAIR).agg(
        F.max("alert_date").alias("previous_alert_date"), F.min("alert_date").alias("_first"))
    x = flags.filter((F.col("date") == mon) & F.col("is_alert")).join(last, PAIR, "left")
    since = F.datediff(a, F.col("previous_alert_date"))
    new = (F.col("minus_1_alert") == F.lit(False)) & (since.isNull() | (since >= 1))
    lasting = since >= 7
    for k in range(1, persistence + 1):
        lasting = lasting & F.col(f"minus_{k}_alert")
    x = x.withColumn("is_new_alert", F.coalesce(new, F.lit(False)))
    x = x.filter((F.col("is_new_alert") | F.coalesce(lasting, F.lit(False))) & _alerting_day(mon, holidays, b2b_pattern))
    return x.select(F.lit("relative_variation").alias("alert_type"), *PAIR, F.col("date").alias("monitored_date"), "variation",
                    "is_new_alert", "previous_alert_date", F.coalesce("_first", "date").alias("first_alert_date"))


def relative_variation(daily: DataFrame, threshold: float = 0.65, floor: float = 3000, weeks: int = 4,
                       persistence: int = 7, exempt: str | None = None) -> DataFrame:
    """K110: each (pair, day) against the mean of the same weekday over the previous
    ``weeks`` weeks. The weekly self-shift is ONE explode of offsets (0, 7, 14, ...) and one
    aggregate, not ``weeks`` self-joins. The mean is NULL unless all weeks are present (M19).
    An alert needs count < threshold x mean and mean >= floor (events whose name matches the regular
    expression ``exempt`` need no floor); ``lag`` 1..persistence tells for each of the previous days whether it
    was alerting."""
    offs = F.explode(F.array(*[F.lit(7 * w) for w in range(weeks + 1)]))
    x = daily.select(*PAIR, "date", "m_events", offs.alias("_off"))
    x = x.withColumn("target_date", F.date_add("date", F.col("_off")))
    g = x.groupBy(*PAIR, "target_date").agg(
        F.sum(F.when(F.col("_off") == 0, F.col("m_events"))).alias("event_count"),
        F.sum(F.when(F.col("_off") > 0, F.col("m_events"))).alias("_sum"),
        F.count(F.when(F.col("_off") > 0, 1)).alias("_weeks"))
    g = g.filter(F.col("event_count").isNotNull())
    mean = F.when(F.col("_weeks") == weeks, F.col("_sum") / weeks)
    g = g.select(*PAIR, F.col("target_date").alias("date"), "event_count", mean.alias("l4w_mean"))
    g = g.withColumn("variation", F.try_divide(F.col("event_count"), F.col("l4w_mean")) - 1)
    enough = F.col("l4w_mean") >= floor
    if exempt:
        enough = enough | F.col("event_name").rlike(exempt)
    g = g.withColumn("is_alert", F.coalesce((F.col("event_count") < threshold * F.col("l4w_mean"))
                                            & enough, F.lit(False)))
    w = Window.partitionBy(*PAIR).orderBy("date")
    for k in range(1, persistence + 1):
        g = g.withColumn(f"minus_{k}_alert", F.lag("is_alert", k).over(w))
    return g


def alert_record(alerts: DataFrame, threshold: float) -> DataFrame:
    """K111: alert rows with their rationale text, the first and the previous alert date of
    the same pair (a window over the alert rows, which are few)."""
    w = Window.partitionBy(*PAIR).orderBy("date")
    a = alerts.filter("is_alert")
    return a.select(F.lit("relative_variation").alias("alert_type"), *PAIR, "date",
                    F.struct(F.lit(1 - threshold).alias("threshold_decrease"),
                             F.col("variation").alias("current_variation")).alias("relative_variation"),
                    F.min("date").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("first_alert_date"),
                    F.lag("date").over(w).alias("previous_alert_date"),
                    F.concat(F.lit("Volume "), round_half_up(F.col("variation") * 100, 1).cast("string"),
                             F.lit("% vs 4-week mean, -"), F.lit(str(int(round((1 - threshold) * 100)))),
                             F.lit("% allowed")).alias("rationale"))


def alert_records(zero: DataFrame, variation: DataFrame, threshold: float, as_of) -> DataFrame:
    """K111 in full: the alerts of a run of both types (:func:`zero_event_alerts`, :func:`variation_alerts`) as records of one shape, to be
    appended to the history that the next run reads.

    ``zero_event``, ``relative_variation`` and ``absolute_threshold`` are nested; the part of the other types is NULL in its
    fields. A relative variation compares the monitored day with the four same weekdays before."""
    mon = F.col("monitored_date")
    none = F.lit(None).cast("double")
    shape = lambda kind, **c: F.struct(*[v.alias(k) for k, v in c.items()]).alias(kind)
    absolute = shape("absolute_threshold", threshold_min=none, threshold_max=none, current_value=none)
    same = ["alert_type", "event_name", "website", mon.alias("start_date"), mon.alias("end_date")]
    tail = [F.lit(as_of).cast("date").alias("alert_date"), "is_new_alert", "previous_alert_date", "first_alert_date"]
    z = zero.select(*same, F.lit(None).cast("date").alias("compared_start_date"), F.lit(None).cast("date").alias("compared_end_date"),
                    shape("zero_event", empty_days=F.when(F.col("is_new_alert"), 1).otherwise(8), monitored=mon),
                    shape("relative_variation", threshold_decrease=none, threshold_increase=none, current_variation=none), absolute, *tail, "rationale")
    text = F.concat(F.col("event_name"), F.lit(" on "), F.col("website"), F.lit(": "), round_half_up(F.col("variation") * 100, 1).cast("string"), F.lit(" % against the usual weekday"))
    v = variation.select(*same, F.date_sub(mon, 28).alias("compared_start_date"), F.date_sub(mon, 7).alias("compared_end_date"),
                         shape("zero_event", empty_days=F.lit(None).cast("int"), monitored=F.lit(None).cast("date")),
                         shape("relative_variation", threshold_decrease=F.lit(1 - threshold), threshold_increase=none, current_variation=F.col("variation")), absolute, *tail, text.alias("rationale"))
    return z.unionByName(v)
