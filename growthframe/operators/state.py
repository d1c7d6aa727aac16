"""Histories, validity intervals, as-of lookups and operational timings
(J5, J7, K98-K105).

Interval logic is expressed as ``explode(sequence(start, end))`` per entity (work
proportional to the interval lengths) or as a union + running ``last(ignorenulls)`` window
(as-of join), never as a spine x history inequality join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import epoch_micros
from growthframe.operators.common import bucketed_lag, bucketed_lead
from growthframe.session import materialize


def status_changes(history: DataFrame, keys: Sequence[str], order: Sequence[str], status: str,
                   bucket: str | None = "day") -> DataFrame:
    """K100 / K119: keep the rows whose status differs (NULL-safe) from the previous row of the
    same key; adds ``previous_status``. ``order`` = (time, tie-breaker); with ``bucket`` the
    lag is computed per (key, time bucket) and carried across buckets (skew-safe)."""
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        x = history.withColumn("previous_status", F.lag(status).over(w))
    else:
        x = bucketed_lag(history, keys, order[0], order[1], [status], bucket, prefix="_prev_")
        x = x.withColumnRenamed(f"_prev_{status}", "previous_status")
    return x.filter(~F.col("previous_status").eqNullSafe(F.col(status)))


def first_status_date(history: DataFrame, keys: Sequence[str], ts: str, status: str, value: str) -> DataFrame:
    """K100: first time each key reached ``value`` (e.g. first inactive date)."""
    return history.groupBy(*keys).agg(F.min(F.when(F.col(status) == value, F.col(ts))).alias(f"first_{value}_at"))


def version_intervals(history: DataFrame, keys: Sequence[str], ts: str, tie: str, end_default: Column,
                      bucket: str = "month") -> DataFrame:
    """Validity interval of each version: [its time, next version's time) or up to
    ``end_default`` (e.g. tomorrow) for the open last version (J5 "open end"). The next
    version comes from a bucketed lead (skew-safe)."""
    x = bucketed_lead(history, keys, ts, tie, [ts], bucket, "_nv_")
    return x.withColumn("valid_from", F.col(ts)).withColumn(
        "valid_to", F.coalesce(F.col(f"_nv_{ts}"), end_default)).drop(f"_nv_{ts}")


def range_join(facts: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Fact rows joined to the interval (same keys) that contains their time:
    ``valid_from <= ts < valid_to``. The equality keys make it a sort-merge / hash join with a
    residual range filter, never a nested loop."""
    iv = intervals
    for k in keys:
        iv = iv.withColumnRenamed(k, f"_iv_{k}")
    cond = [facts[k] == iv[f"_iv_{k}"] for k in keys] + [
        iv["valid_from"] <= facts[ts], facts[ts] < iv["valid_to"]]
    return facts.join(iv, cond, "left").drop(*[f"_iv_{k}" for k in keys])


def _asof_union(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                values: Sequence[str], left_side: int, right_side: int) -> tuple[DataFrame, list[str]]:
    lcols = left.columns
    rtype = right.select(F.struct(*values).alias("s")).schema["s"].dataType
    l_ = left.select(*lcols, F.col(left_ts).alias("_t"), F.lit(left_side).alias("_side"),
                     F.lit(None).cast(rtype).alias("_r"))
    # a NULL key or time matches nothing, as in a join
    known = F.lit(True)
    for c in (*keys, right_ts):
        known = known & F.col(c).isNotNull()
    r_ = right.filter(known).select(*keys, F.col(right_ts).alias("_t"), F.lit(right_side).alias("_side"),
                      F.struct(*values).alias("_r"))
    for c in lcols:
        if c not in keys:
            r_ = r_.withColumn(c, F.lit(None).cast(left.schema[c].dataType))
    return l_.unionByName(r_), lcols


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              values: Sequence[str], prefix: str = "asof_", bucket: str | None = "day") -> DataFrame:
    """For each left row, the right row with the latest ``right_ts <= left_ts``
    (same keys; of equal times the greatest values). Both sides are unioned with a side marker and a running
    ``last(struct, ignorenulls)`` is taken ordered by (time, side), right before left on
    equal times ("at or before"). No inequality join.

    Skew: with ``bucket`` the running window is partitioned by (keys, time bucket), so a key
    with a huge history is spread over its buckets; the value carried in from earlier
    buckets is the last right row of each (key, bucket) - a ``max_by`` aggregate - carried
    forward by a window over the (small) per-bucket table and joined back on (key, bucket)."""
    u, lcols = _asof_union(left, right, keys, left_ts, right_ts, values, 1, 0)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
        u = u.withColumn("_last", F.last("_r", ignorenulls=True).over(w))
    else:
        u = u.withColumn("_g", F.struct(F.struct(*keys).alias("k"), F.date_trunc(bucket, F.col("_t")).alias("b")))
        w = Window.partitionBy("_g").orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
        per = u.groupBy("_g").agg(F.max_by(F.col("_r"), F.when(F.col("_side") == 0, F.struct("_t", "_r"))).alias("_bl"))
        per = per.withColumn("_carry", F.last("_bl", ignorenulls=True).over(
            Window.partitionBy("_g.k").orderBy("_g.b").rowsBetween(Window.unboundedPreceding, -1))).drop("_bl")
        u = u.join(per, "_g").withColumn("_last", F.coalesce(F.last("_r", ignorenulls=True).over(w), F.col("_carry")))
    out = u.filter(F.col("_side") == 1)
    return out.select(*lcols, *[F.col("_last")[v].alias(prefix + v) for v in values])


def _falling() -> list[Column]:
    """The exact reverse of the order (time, side, right row): NULLs last."""
    return [F.desc_nulls_last(c) for c in ("_t", "_side", "_r")]


def asof_join_forward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                      values: Sequence[str], prefix: str = "next_", bucket: str | None = "day") -> DataFrame:
    """For each left row, the first right row with ``right_ts >= left_ts`` (same keys):
    the mirror of :func:`asof_join`: the same running window over the rows in falling order. (A frame of all following
    rows would be read again for each row.)"""
    u, lcols = _asof_union(left, right, keys, left_ts, right_ts, values, 0, 1)
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*_falling()).rowsBetween(Window.unboundedPreceding, 0)
        u = u.withColumn("_next", F.last("_r", ignorenulls=True).over(w))
    else:
        u = u.withColumn("_g", F.struct(F.struct(*keys).alias("k"), F.date_trunc(bucket, F.col("_t")).alias("b")))
        w = Window.partitionBy("_g").orderBy(*_falling()).rowsBetween(Window.unboundedPreceding, 0)
        per = u.groupBy("_g").agg(F.min_by(F.col("_r"), F.when(F.col("_side") == 1, F.struct("_t", "_r"))).alias("_bf"))
        per = per.withColumn("_carry", F.last("_bf", ignorenulls=True).over(
            Window.partitionBy("_g.k").orderBy(F.desc("_g.b")).rowsBetween(Window.unboundedPreceding, -1))).drop("_bf")
        u = u.join(per, "_g").withColumn("_next", F.coalesce(F.last("_r", ignorenulls=True).over(w), F.col("_carry")))
    dated = F.col("_t").isNotNull()  # NULL times sort first, before every right row
    return u.filter(F.col("_side") == 0).select(*lcols, *[F.when(dated, F.col("_next")[v]).alias(prefix + v) for v in values])


def asof_both(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, values: Sequence[str],
              before: str = "before_", after: str = "after_", bucket: str = "day") -> DataFrame:
    """For each left row the last right row strictly before its time and the first at or after it (same keys), in one pass.

    One union, written once, ordered by (time, left before right): what stands before a left row is strictly earlier, what
    follows is not, and is met first in falling order: both are running windows. They are partitioned by (keys, time bucket); the
    last and the first right row of each bucket are carried over the other buckets. Every left row stays, once: those with a NULL key or time, and those without a match, have NULL."""
    u, lcols = _asof_union(left, right, keys, left_ts, right_ts, values, 0, 1)
    u = materialize(u.withColumn("_g", F.struct(F.struct(*keys).alias("k"), F.date_trunc(bucket, F.col("_t")).alias("b"))))
    at = F.when(F.col("_side") == 1, F.struct("_t", "_r"))
    per = u.groupBy("_g").agg(F.max_by("_r", at).alias("_bl"), F.min_by("_r", at).alias("_bf"))
    over, earlier = Window.partitionBy("_g.k"), (Window.unboundedPreceding, -1)
    per = per.select("_g", F.last("_bl", ignorenulls=True).over(over.orderBy("_g.b").rowsBetween(*earlier)).alias("_carry_l"),
                     F.last("_bf", ignorenulls=True).over(over.orderBy(F.desc("_g.b")).rowsBetween(*earlier)).alias("_carry_f"))
    w, so_far = Window.partitionBy("_g"), (Window.unboundedPreceding, 0)
    x = u.join(per, "_g")
    x = x.withColumn("_last", F.coalesce(F.last("_r", ignorenulls=True).over(w.orderBy("_t", "_side", "_r").rowsBetween(*so_far)), F.col("_carry_l")))
    x = x.withColumn("_next", F.coalesce(F.last("_r", ignorenulls=True).over(w.orderBy(*_falling()).rowsBetween(*so_far)), F.col("_carry_f")))
    dated = F.col("_t").isNotNull()  # NULL times sort first, before every right row
    return x.filter(F.col("_side") == 0).select(*lcols, *[F.col("_last")[v].alias(before + v) for v in values],
                                                *[F.when(dated, F.col("_next")[v]).alias(after + v) for v in values])


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: Sequence[str], right_span: Sequence[str],
                 horizon, how: str = "left", days: int = 32) -> DataFrame:
    """Interval-overlap join: both sides are day intervals [start, end], ends may be open (NULL: until ``horizon``).

    Each interval is dealt to the blocks of ``days`` days that it touches (not to its days); rows meet by
    equality of keys and block, and a pair counts in the block where its overlap begins, so exactly once. Adds
    ``overlap_start`` and ``overlap_end``; with ``how="left"`` a left row without any overlap stays with NULLs. Intervals that end
    before they start overlap nothing; NULL keys match nothing."""
    end = F.lit(horizon).cast("date")

    def dealt(df, span, a, b):
        s, e = F.to_date(F.col(span[0])), F.coalesce(F.to_date(F.col(span[1])), end)
        x = df.withColumn(a, s).withColumn(b, e).filter(F.col(a) <= F.col(b))
        block = [F.floor(F.unix_date(c) / days) for c in (a, b)]
        return x.withColumn("_block", F.explode(F.sequence(*block)))

    row = left.withColumn("_row", F.monotonically_increasing_id()) if how == "left" else left
    row = materialize(row) if how == "left" else row
    r = dealt(right.withColumnsRenamed({k: f"_r_{k}" for k in keys}), right_span, "_rs", "_re")
    x = dealt(row, left_span, "_ls", "_le").withColumnRenamed("_block", "_lblock")
    same = [x[k] == r[f"_r_{k}"] for k in keys] + [F.col("_lblock") == F.col("_block"), F.col("_ls") <= F.col("_re"), F.col("_rs") <= F.col("_le"),
                                                    F.floor(F.unix_date(F.greatest("_ls", "_rs")) / days) == F.col("_block")]
    found = x.join(r, same).withColumn("overlap_start", F.greatest("_ls", "_rs")).withColumn("overlap_end", F.least("_le", "_re"))
    extra = [c for c in right.columns if c not in keys]
    found = found.select(*row.columns, *extra, "overlap_start", "overlap_end")
    if how == "left":
        none = row.join(found.select("_row"), "_row", "left_anti")
        found = found.unionByName(none, allowMissingColumns=True)
    return found.drop("_row")


def elementary_segments(intervals: DataFrame, keys: Sequence[str], start: str, end: str, flags: dict[str, Column], horizon) -> DataFrame:
    """Overlapping day intervals cut at all their boundary points: per key the successive segments [``segment_start``,
    ``segment_end``] in which the same flags hold, each with its flags (true while any interval of that flag runs).

    A sweep over the boundary points: +1 where an interval begins, -1 on the day after it ends, running sums. The work is that
    of the boundary points, whatever the length of the intervals; open ends (NULL) run until ``horizon``. Segments
    without any interval are left out."""
    e = F.coalesce(F.to_date(F.col(end)), F.lit(horizon).cast("date"))
    x = intervals.select(*keys, F.to_date(F.col(start)).alias("_s"), e.alias("_e"), *[c.cast("int").alias(n) for n, c in flags.items()]).filter("_s <= _e")
    step = F.explode(F.array(F.struct(F.col("_s").alias("d"), F.lit(1).alias("sign")), F.struct(F.date_add("_e", 1).alias("d"), F.lit(-1).alias("sign"))))
    points = x.select(*keys, *flags, step.alias("p")).groupBy(*keys, F.col("p.d").alias("segment_start")).agg(
        *[F.sum(F.coalesce(F.col(n), F.lit(0)) * F.col("p.sign")).alias(n) for n in flags], F.sum("p.sign").alias("_any"))
    w = Window.partitionBy(*keys).orderBy("segment_start")  # one row per key and boundary day
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    segments = points.select(*keys, "segment_start", F.date_sub(F.lead("segment_start").over(w), 1).alias("segment_end"),
                             *[(F.sum(n).over(run) > 0).alias(n) for n in flags], F.sum("_any").over(run).alias("_any"))
    return segments.filter("_any > 0").drop("_any")


def intervals_to_days(df: DataFrame, keys: Sequence[str], start: str, end: str, flags: dict[str, Column],
                      open_end: Column) -> DataFrame:
    """Per key and day, whether each flag's interval covers the day.

    An interval is [start, end] (``open_end`` when NULL); one with end < start yields nothing. Intervals of a key are cut
    into `elementary_segments`, and only these are spread to days, so a day of a key comes up once however many intervals
    cover it. A flag that is NULL in all intervals of the day is NULL."""
    e = F.coalesce(F.to_date(F.col(end)), open_end)
    known = {f"_known_{n}": c.isNotNull() for n, c in flags.items()}
    seg = elementary_segments(df.withColumn("_until", e), keys, start, "_until", flags | known, None)
    return seg.select(*keys, F.explode(F.sequence("segment_start", "segment_end")).alias("d"), *[F.when(F.col(f"_known_{n}"), F.col(n)).alias(n) for n in flags])


def state_asof_days(history: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, end) -> DataFrame:
    """Last known value per key and day from the first version to ``end``.

    Each version covers the days until the day before the next version's day (several
    versions on one day: the last one wins), exploded per version: no key x day grid join."""
    d = F.to_date(F.col(ts))
    per_day = history.groupBy(*keys, d.alias("d")).agg(F.max_by(value, F.struct(ts, tie)).alias(value))
    w = Window.partitionBy(*keys).orderBy("d")
    iv = per_day.withColumn("_to", F.coalesce(F.date_sub(F.lead("d").over(w), 1), F.lit(end).cast("date")))
    iv = iv.filter(F.col("_to") >= F.col("d"))
    return iv.select(*keys, value, F.explode(F.sequence("d", "_to")).alias("day"))


def open_items_by_day(items: DataFrame, item: str, owner: str, due: str, completed: str, end) -> DataFrame:
    """K101: per owner and day, the number of distinct items that are due: from the due day up
    to and including the day of completion (until ``end`` when never completed). An item that is
    reopened has several intervals; overlapping ones count once, gaps between them don't count.

    A sweep: intervals of one (owner, item) that touch are merged, then +1 on the first day and
    -1 on the day after the last; the running sum is taken over an owner's change days and spread
    to the days in between. Work is O(items + days), not items x open days."""
    e = F.coalesce(F.to_date(F.col(completed)), F.lit(end).cast("date"))
    iv = items.select(F.col(owner).alias("owner"), F.col(item).alias("_i"), F.to_date(F.col(due)).alias("_s"), e.alias("_e")).filter("_e >= _s")
    w = Window.partitionBy("owner", "_i").orderBy("_s", "_e")
    reach = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    iv = iv.withColumn("_n", F.coalesce((F.col("_s") > F.date_add(reach, 1)).cast("int"), F.lit(0)))
    iv = iv.withColumn("_n", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    iv = iv.groupBy("owner", "_i", "_n").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
    step = F.explode(F.array(F.struct(F.col("_s").alias("d"), F.lit(1).alias("c")), F.struct(F.date_add("_e", 1).alias("d"), F.lit(-1).alias("c"))))
    changes = iv.select("owner", step.alias("x")).groupBy("owner", F.col("x.d").alias("d")).agg(F.sum("x.c").alias("c"))
    by_day = Window.partitionBy("owner").orderBy("d")  # an owner has one row per change day
    x = changes.withColumn("open_items", F.sum("c").over(by_day.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_to", F.date_sub(F.lead("d").over(by_day), 1))
    return x.filter("open_items > 0").select("owner", F.explode(F.sequence("d", "_to")).alias("d"), F.col("open_items").cast("long").alias("open_items"))


def daily_state_fact(open_days: DataFrame, owners: DataFrame, activity: DataFrame, won: DataFrame,
                     key: str) -> DataFrame:
    """K102: entity x day fact: open flag days from intervals, owner in charge on the day
    (interval rows exploded to days), activity count and won revenue on the day only; all
    joined with equi-joins on (key, day)."""
    x = open_days.join(owners, [key, "d"], "left").join(activity, [key, "d"], "left").join(won, [key, "d"], "left")
    return x.fillna(0, ["activity"]).fillna(0.0, ["won_revenue"])


def daily_state_segments(stays: DataFrame, attribution: DataFrame, flags: DataFrame, activity: DataFrame, key: str, owner: str,
                         flag_names: Sequence[str], horizon, stale_days: int = 10) -> DataFrame:
    """K102: the daily fact of entities that are online, with the executive in charge and the owner's flags.

    ``stays`` (key, owner, start, end), ``attribution`` (owner, executive, start, end), ``flags`` (owner, flag, start, end): day
    intervals, which may overlap and may be open. ``activity`` (owner, d): days on which the owner was seen. A stay meets the
    executives by `overlap_join` (several at a time: one row each; none: NULL), the result meets the elementary segments
    of the owner's flags; only these final segments are spread to days. ``last_seen`` is the owner's last active
    day up to that day, ``seen_long_ago`` says that it is over ``stale_days`` days back."""
    spans = overlap_join(stays, attribution.withColumnsRenamed({"start": "_as", "end": "_ae"}), [owner], ["start", "end"], ["_as", "_ae"], horizon, how="inner")
    end = F.lit(horizon).cast("date")
    # days of a stay that no executive covers: the gaps between its attributed days, as segments
    covered = materialize(spans.select(key, owner, "executive", "overlap_start", "overlap_end"))
    gap = _uncovered(stays, covered, key, owner, end)
    parts = covered.select(key, owner, "executive", F.col("overlap_start").alias("s"), F.col("overlap_end").alias("e"))
    parts = materialize(parts.union(gap.select(key, owner, F.lit(None).cast(parts.schema["executive"].dataType), "s", "e")))
    seg = elementary_segments(flags, [owner], "start", "end", {n: F.col("flag") == n for n in flag_names}, horizon)
    flagged = overlap_join(parts, seg, [owner], ["s", "e"], ["segment_start", "segment_end"], horizon, how="inner")
    days = flagged.select(key, owner, "executive", *flag_names, F.explode(F.sequence("overlap_start", "overlap_end")).alias("d"))
    plain = parts.select(key, owner, "executive", F.explode(F.sequence("s", "e")).alias("d"))
    out = plain.unionByName(days, allowMissingColumns=True).groupBy(key, owner, "executive", "d").agg(
        *[F.coalesce(F.bool_or(n), F.lit(False)).alias(n) for n in flag_names])
    # the owner's last active day: a step function from one active day to the next, met as an interval
    seen = activity.select(owner, F.col("d").alias("last_seen")).distinct()
    seen = seen.withColumn("until", F.date_sub(F.lead("last_seen").over(Window.partitionBy(owner).orderBy("last_seen")), 1))
    one = out.select(owner, "d").distinct()
    last = overlap_join(one, seen, [owner], ["d", "d"], ["last_seen", "until"], horizon, how="inner").select(owner, "d", "last_seen")
    out = out.join(last, [owner, "d"], "left")
    return out.withColumn("seen_long_ago", F.coalesce(F.datediff("d", "last_seen") > stale_days, F.lit(False)))


def _uncovered(stays: DataFrame, covered: DataFrame, key: str, owner: str, end: Column) -> DataFrame:
    """The runs of days of each stay that none of its overlaps covers."""
    own = stays.select(key, owner, F.to_date("start").alias("a"), F.coalesce(F.to_date("end"), end).alias("b")).filter("a <= b")
    mark = covered.select(key, owner, F.explode(F.array(F.struct(F.col("overlap_start").alias("d"), F.lit(1).alias("c")),
                                                        F.struct(F.date_add("overlap_end", 1).alias("d"), F.lit(-1).alias("c")))).alias("p")).select(key, owner, "p.*")
    stay = own.select(key, owner, F.explode(F.array(F.struct(F.col("a").alias("d"), F.lit(1).alias("o")), F.struct(F.date_add("b", 1).alias("d"), F.lit(-1).alias("o")))).alias("p")).select(key, owner, "p.*")
    points = stay.unionByName(mark, allowMissingColumns=True).groupBy(key, owner, "d").agg(
        F.sum(F.coalesce("o", F.lit(0))).alias("o"), F.sum(F.coalesce("c", F.lit(0))).alias("c"))
    w = Window.partitionBy(key, owner).orderBy("d")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    x = points.select(key, owner, F.col("d").alias("s"), F.date_sub(F.lead("d").over(w), 1).alias("e"), F.sum("o").over(run).alias("o"), F.sum("c").over(run).alias("c"))
    return x.filter("o > 0 AND c = 0").select(key, owner, "s", "e")


def price_per_unit(df: DataFrame, group: Sequence[str], value: str, cut_quantile: float = 0.99) -> DataFrame:
    """K103: per group the median of ``value`` after removing values above the overall
    ``cut_quantile`` (exact percentile; the threshold is a one-row aggregate cross-joined
    as a broadcast scalar)."""
    from growthframe.operators.selection import exact_percentile
    df = materialize(df.select(*group, value))  # read once for each histogram
    cut = exact_percentile(df, value, [cut_quantile]).scalar()  # scalar subquery, not a join
    x = df.filter(F.col(value) <= cut)
    med = exact_percentile(x, value, [0.5], group).withColumnRenamed("p50", "median_value")
    return med.join(x.groupBy(*group).agg(F.count("*").alias("n")), list(group))


def opening_schedule(hours: DataFrame, store: str | None = None) -> DataFrame:
    """K104: the weekly opening times as a cumulative function, one row per store (or one row).

    ``hours`` = (iso_weekday, open_seconds, close_seconds) since midnight, several windows a day allowed, optionally
    per ``store`` and with a ``valid_from`` when hours change. A version holds its windows, the opening seconds of a
    week, and ``before``: all opening seconds of the versions before it, from the first version on. So the opening
    seconds up to any time are one lookup, however long ago the first version began. The array of a store has one entry
    for each change of its hours."""
    h = hours if "valid_from" in hours.columns else hours.withColumn("valid_from", F.lit(None).cast("timestamp_ntz"))
    keys = [store] if store else []
    window = F.struct("iso_weekday", "open_seconds", F.greatest("open_seconds", "close_seconds").alias("close_seconds"))
    v = h.groupBy(*keys, "valid_from").agg(F.collect_list(window).alias("windows"), F.sum(F.greatest(F.lit(0), F.col("close_seconds") - F.col("open_seconds"))).alias("week"))
    order = Window.partitionBy(*keys).orderBy("valid_from")
    v = v.withColumn("_next", F.lead("valid_from").over(order))
    v = v.withColumn("at_start", F.when(F.col("valid_from").isNull(), 0).otherwise(_opened("valid_from", "windows", "week")))
    own = F.when(F.col("valid_from").isNotNull(), F.coalesce(_opened("_next", "windows", "week") - F.col("at_start"), F.lit(0))).otherwise(0)
    before = F.coalesce(F.sum("_own").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    v = v.withColumn("_own", own).withColumn("before", before.cast("long"))
    entry = F.struct("valid_from", "windows", F.col("week").cast("long").alias("week"), "at_start", "before")
    return v.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("versions"))


def _opened(t: str, windows: str, week: str) -> Column:
    """Opening seconds of a weekly schedule from a fixed Monday until ``t``: whole weeks, days before in this week, part of the day."""
    return F.expr(f"""floor(datediff(cast({t} AS date), DATE '1970-01-05') / 7) * {week} + aggregate({windows}, 0D, (_acc, _win) -> _acc +
        CASE WHEN _win.iso_weekday < (dayofweek({t}) + 5) % 7 + 1 THEN _win.close_seconds - _win.open_seconds
             WHEN _win.iso_weekday = (dayofweek({t}) + 5) % 7 + 1
             THEN greatest(0, least(hour({t}) * 3600 + minute({t}) * 60 + cast(extract(SECOND FROM {t}) AS double), _win.close_seconds) - _win.open_seconds) ELSE 0 END)""")


def business_seconds(df: DataFrame, start: str, end: str, hours: DataFrame, store: str | None = None, version: str = "start") -> DataFrame:
    """K104: seconds between ``start`` and ``end`` that fall inside opening hours (`opening_schedule`).

    The cumulative opening time at ``end`` less that at ``start``: no day is expanded and nothing is aggregated per row, so the
    cost does not grow with the interval. ``version="start"``: the hours in force at ``start`` (as of the order time)
    apply throughout; ``version="instant"``: at every moment those in force then, across changes inside the interval. An
    undated version always was in force; without one a row has 0, as have rows with a NULL start or end, or an end before the start."""
    sched = opening_schedule(hours, store)
    if store:
        x = df.join(sched, store, "left")
    else:  # a single row, as a scalar subquery
        x = df.withColumn("versions", sched.select("versions").scalar())
    latest = "element_at(filter(versions, _ver -> _ver.valid_from IS NULL OR _ver.valid_from <= {t}), -1)"
    if version == "start":
        x = x.withColumn("_v", F.expr(f"try_{latest.format(t=start)}"))
        total = _opened(end, "_v.windows", "_v.week") - _opened(start, "_v.windows", "_v.week")
        x = x.withColumn("business_seconds", F.when(F.col(end) >= F.col(start), total))
    elif version == "instant":
        for t, name in ((start, "_s"), (end, "_e")):
            x = x.withColumn(name, F.expr(f"try_{latest.format(t=t)}"))
        at = {n: F.coalesce(F.col(f"{n}.before") + _opened(t, f"{n}.windows", f"{n}.week") - F.col(f"{n}.at_start"), F.lit(0)) for t, n in ((start, "_s"), (end, "_e"))}
        x = x.withColumn("business_seconds", F.when(F.col(end) >= F.col(start), at["_e"] - at["_s"]))
    else:
        raise ValueError(version)
    return x.select(*df.columns, F.coalesce(F.col("business_seconds").cast("long"), F.lit(0)).cast("long").alias("business_seconds"))


def milestones(history: DataFrame, key: str, ts: str, state: str, states: Sequence[str]) -> DataFrame:
    """K105: first and last time of each state per key, and hours between consecutive
    first-times. One conditional aggregate."""
    aggs = []
    for s in states:
        aggs.append(F.min(F.when(F.col(state) == s, F.col(ts))).alias(f"first_{s}"))
        aggs.append(F.max(F.when(F.col(state) == s, F.col(ts))).alias(f"last_{s}"))
    g = history.groupBy(key).agg(*aggs)
    for a, b in zip(states, states[1:]):
        g = g.withColumn(f"hours_{a}_to_{b}", (epoch_micros(f"first_{b}") - epoch_micros(f"first_{a}")) / 3.6e9)
    return g
