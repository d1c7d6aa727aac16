"""Web events and sessions.

Ordered per-visitor and per-visit logic (gaps, hit numbers, previous page, next hit) runs on
windows partitioned by (visitor or visit, time bucket) with the boundary values carried by
small per-bucket aggregates (``common.bucketed_*``), so a bot visitor or visit is spread over
its active hours or days instead of being one sorted task. Per-session measures are
aggregates (partial, map-side) rather than windows wherever the rule allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import epoch_micros, first_non_null, param_value, regex_group, round_half_up
from growthframe.operators.common import bucketed_lag, bucketed_lead, bucketed_row_number, with_group_agg
from growthframe.operators.ordered import ordered_text


def event_params(df: DataFrame, arr: str, keys: dict[str, tuple[str, str]]) -> DataFrame:
    """K1: pivot named entries of an ``array<struct<key, value struct<...>>>`` into columns.

    ``keys`` maps output column -> (param key, value field). One projection with
    higher-order functions; no explode, no shuffle."""
    return df.select("*", *[param_value(arr, k, f).alias(out) for out, (k, f) in keys.items()])


def _micros(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return epoch_micros(c)


def sessionize(df: DataFrame, user: str, ts: str, event_id: str, gap_minutes: int = 30,
               source_cols: Sequence[str] = (), bucket: str | None = "day") -> DataFrame:
    """K3: a session starts at a visitor's first event, after ``gap_minutes`` idle (whole
    minutes, i.e. a gap of at least gap*60 s), or on any event carrying a traffic-source
    marker (non-NULL ``source_cols``). Adds ``is_session_start``, ``session_id`` (id of the
    starting event) and ``session_number`` (1, 2, ... per visitor).

    Skew: with ``bucket`` ("day" or "hour") the ordered windows are partitioned by
    (visitor, time bucket), so a visitor holding a large share of all events (a bot) is
    spread over as many tasks as it has active buckets. What crosses a bucket boundary - the
    previous event time, the running session count and the open session id - is carried by
    small per-(visitor, bucket) aggregates and windows over buckets, joined back on
    (visitor, bucket). ``bucket=None`` uses one window per visitor."""
    marker = F.lit(False)
    for c in source_cols:
        marker = marker | F.col(c).isNotNull()
    gap = gap_minutes * 60 * 1_000_000

    if bucket is None:
        w = Window.partitionBy(user).orderBy(ts, event_id)
        prev = F.lag(ts).over(w)
        start = prev.isNull() | ((_micros(ts) - _micros(prev)) >= gap) | marker
        x = df.withColumn("is_session_start", start)
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        return (x.withColumn("session_id", F.last(F.when(F.col("is_session_start"), F.col(event_id)),
                                                  ignorenulls=True).over(run))
                .withColumn("session_number", F.sum(F.col("is_session_start").cast("long")).over(run)))

    b = F.date_trunc(bucket, F.col(ts))
    # one struct of user and bucket: NULL users and NULL times keep their rows
    x = df.withColumn("_g", F.struct(F.col(user).alias("u"), b.alias("b")))
    wb = Window.partitionBy("_g").orderBy(ts, event_id)
    at = F.struct(ts, event_id)
    # inside a bucket all but its first event know whether they start a session
    x = x.withColumn("_first", F.row_number().over(wb) == 1).withColumn("_marked", F.coalesce(marker, F.lit(False)))
    lag = F.lag(ts).over(wb)
    x = x.withColumn("_start", ~F.col("_first") & F.coalesce(lag.isNull() | ((_micros(ts) - _micros(lag)) >= gap) | F.col("_marked"), F.lit(False)))
    # one table of buckets: what the first event needs, and what the buckets after it need
    per = x.groupBy("_g").agg(
        F.max(ts).alias("_last_t"), F.min_by(F.struct(F.col(ts).alias("t"), F.col(event_id).alias("e"), F.col("_marked").alias("m")), F.when(F.col("_first"), at)).alias("_f"),
        F.count_if("_start").alias("_starts"), F.max_by(F.col(event_id), F.when(F.col("_start"), at)).alias("_last_start"))
    across = Window.partitionBy("_g.u").orderBy("_g.b")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.lag("_last_t").over(across)
    per = per.withColumn("_opens", F.coalesce(earlier.isNull() | ((_micros("_f.t") - _micros(earlier)) >= gap) | F.col("_f.m"), F.lit(False)))
    per = per.withColumn("_starts", F.col("_starts") + F.col("_opens").cast("long")) \
        .withColumn("_last_start", F.coalesce(F.col("_last_start"), F.when(F.col("_opens"), F.col("_f.e"))))
    per = per.select("_g", "_opens", F.coalesce(F.sum("_starts").over(before), F.lit(0)).alias("_starts_before"), F.last("_last_start", ignorenulls=True).over(before).alias("_open_id"))
    x = x.join(per, "_g")
    x = x.withColumn("is_session_start", F.when(F.col("_first"), F.col("_opens")).otherwise(F.col("_start")))
    run = wb.rowsBetween(Window.unboundedPreceding, 0)
    in_bucket_id = F.last(F.when(F.col("is_session_start"), F.col(event_id)), ignorenulls=True).over(run)
    return (x.withColumn("session_id", F.coalesce(in_bucket_id, F.col("_open_id")))
            .withColumn("session_number",
                        F.col("_starts_before") + F.sum(F.col("is_session_start").cast("long")).over(run))
            .drop("_g", "_first", "_marked", "_start", "_opens", "_starts_before", "_open_id"))


def session_rollup(df: DataFrame, session: str, ts: str, page: str, utm_cols: Sequence[str],
                   lead_flag: Column, tie: str | None = None) -> DataFrame:
    """K2: one row per session: start, date, landing page, first non-NULL value of each utm
    field, any-lead flag; of hits at the same time the smallest ``tie`` (an event id) comes first (M15). One aggregate (min_by with NULLs skipped) instead of one window per
    field; partial aggregation keeps the shuffle at one row per session and partition."""
    at = F.struct(ts, tie) if tie else F.col(ts)
    aggs = [F.min(ts).alias("session_start"), F.to_date(F.min(ts)).alias("session_date"),
            F.min_by(F.col(page), at).alias("landing_page"),
            F.bool_or(lead_flag).alias("is_lead"), F.count("*").alias("hits")]
    aggs += [first_non_null(c, at).alias(f"first_{c}") for c in utm_cols]
    return df.groupBy(session).agg(*aggs)


def visit_hits(df: DataFrame, visit: str, ts: str, event_id: str, is_page: Column,
               is_interaction: Column, bucket: str = "hour") -> DataFrame:
    """UA-style hit attributes inside each visit: hit number, entrance / exit flags, type.

    Hit numbers and the exit flag come from one hour-bucketed row numbering (the last row of
    the visit's last active hour is the exit), so a bot visit with millions of hits is spread
    over its hours instead of being one sorted task."""
    x = bucketed_row_number(df, [visit], ts, event_id, "hit_number", bucket, last_name="is_exit")
    return (x.withColumn("is_entrance", F.col("hit_number") == 1)
            .withColumn("hit_type", F.when(is_page, "PAGE").otherwise("EVENT"))
            .withColumn("is_interaction", is_interaction))


def page_journey(df: DataFrame, visit: str, ts: str, event_id: str, page: str, sep: str = " > ", bucket: str = "hour") -> DataFrame:
    """Ordered page path string and distinct pages per visit.

    Put together from pieces of one hour each (`ordered_text`), so a visit with a third of all hits is sorted in as many tasks as it
    has hours; only the final path holds a visit whole (``journey_chars`` characters)."""
    x = ordered_text(df, [visit], F.date_trunc(bucket, F.col(ts)), F.struct(ts, event_id), F.col(page), sep, "journey")
    return x.select(visit, "journey", F.col("distinct_journey").alias("distinct_pages"), F.col("n_journey").cast("int").alias("pageviews"),
                    F.col("chars_journey").alias("journey_chars"))


def session_bounds(sessions: DataFrame, user: str, start: str, session: str) -> DataFrame:
    """Each session's start and end, end = next session's start (NULL for the last);
    month-bucketed lead (skew-safe)."""
    x = bucketed_lead(sessions.select(user, session, start), [user], start, session, [start], "month", "_n_")
    return x.select(user, session, F.col(start).alias("session_start"), F.col(f"_n_{start}").alias("session_end"))


def previous_page(df: DataFrame, visit: str, ts: str, event_id: str, page: str) -> DataFrame:
    """(page, previous page) transition counts inside visits, self-transitions dropped."""
    x = bucketed_lag(df, [visit], ts, event_id, [page], "hour", "_p_").withColumnRenamed(f"_p_{page}", "previous_page")
    return (x.filter(F.col(page) != F.col("previous_page"))
            .groupBy(F.col(page).alias("page"), "previous_page").agg(F.count("*").alias("pageviews")))


def time_on_page(df: DataFrame, visit: str, ts: str, event_id: str, page: str, is_page: Column, is_interaction: Column, bucket: str = "hour") -> DataFrame:
    """Average time on page = sum(next hit - hit) / non-exit pageviews.

    Only PAGE hits and the visit's last interaction are kept (the last interaction closes
    the last page); the next kept hit ends a page's time. Seconds, NULL when no non-exit view.

    One pass over (visit, bucket): a table of buckets says what a bucket must know of the others (the visit's last row and last kept
    row, the first page of a later bucket), and one window inside the bucket finds the next page. After that comes the last
    interaction or nothing, as no page is later than it."""
    x = df.select(visit, ts, event_id, page, is_page.alias("_page"), (is_page | is_interaction).alias("_kept"))
    x = x.withColumn("_g", F.struct(F.struct(visit).alias("k"), F.date_trunc(bucket, F.col(ts)).alias("b")))
    at = F.struct(F.col(ts).alias("t"), F.col(event_id).alias("e"))
    per = x.groupBy("_g").agg(F.max(at).alias("_row"), F.max(F.when(F.col("_kept"), at)).alias("_keep"), F.min(F.when(F.col("_page"), F.col(ts))).alias("_page_t"))
    whole = Window.partitionBy("_g.k")
    later = whole.orderBy(F.desc("_g.b")).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_g", F.max("_row").over(whole).alias("_exit"), F.max("_keep").over(whole).alias("_close"), F.last("_page_t", ignorenulls=True).over(later).alias("_later"))
    x = x.join(per, "_g").filter(F.col("_kept"))
    inside = Window.partitionBy("_g").orderBy(F.desc(ts), F.desc(event_id)).rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_next", F.coalesce(F.last(F.when(F.col("_page"), F.col(ts)), ignorenulls=True).over(inside), F.col("_later"), F.col("_close.t")))
    x = x.filter(F.col("_page") | (F.col(ts) == F.col("_close.t")))
    x = x.withColumn("_dt", F.when(at < F.col("_close"), (_micros("_next") - _micros(ts)) / 1e6))
    g = x.groupBy(F.col(page).alias("page")).agg(
        F.sum("_dt").alias("total_time_on_page"), F.count_if("_page").alias("pageviews"),
        F.count_if(F.col("_page") & (at != F.col("_exit"))).alias("non_exit_pageviews"))
    return g.withColumn("avg_time_on_page", round_half_up(F.try_divide("total_time_on_page", "non_exit_pageviews"), 3)) \
        .withColumn("total_time_on_page", round_half_up("total_time_on_page", 3))


def bounce_rate(hits: DataFrame, visit: str, page: str) -> DataFrame:
    """Entrances and bounces per page (a bounce = single-hit visit), percent, 2 decimals.

    One aggregate over hits with the visit's hit count joined as a partial aggregate."""
    n = hits.groupBy(visit).agg(F.count("*").alias("_visit_hits"))
    x = hits.join(n, visit)
    g = x.groupBy(F.col(page).alias("page")).agg(
        F.count_if(F.col("is_entrance")).alias("total_entrances"),
        F.count_if((F.col("hit_type") == "PAGE") & (F.col("_visit_hits") == 1)).alias("total_no_of_bounces"))
    g = g.filter((F.col("total_entrances") > 0))
    return g.withColumn("bounce_rate", round_half_up(F.try_divide("total_no_of_bounces", "total_entrances") * 100, 2))


def session_duration(hits: DataFrame, visit: str, ts: str) -> DataFrame:
    """Average session duration = total time on site / distinct sessions (seconds)."""
    per = hits.groupBy(visit).agg(((F.max(_micros(ts)) - F.min(_micros(ts))) / 1e6).alias("time_on_site"))
    return per.agg(F.round(F.sum("time_on_site") / F.countDistinct(visit), 0).alias("avg_session_duration_sec"),
                   F.countDistinct(visit).alias("sessions"))


def unique_pageviews(hits: DataFrame, visit: str, page: str) -> DataFrame:
    """Pageviews and unique pageviews (distinct visits viewing the page)."""
    p = hits.filter(F.col("hit_type") == "PAGE")
    return p.groupBy(F.col(page).alias("page")).agg(F.count("*").alias("pageviews"),
                                                     F.countDistinct(visit).alias("unique_pageviews"))


def users_by_channel(df: DataFrame, channel: str, user: str) -> DataFrame:
    """Distinct users per channel."""
    return df.groupBy(channel).agg(F.countDistinct(user).alias("users"))


def page_session_table(hits: DataFrame, visit: str, page: str, ts: str) -> DataFrame:
    """Wide fact per (visit, page): entrances, exits, pageviews, events, bounces,
    first / last hit time, seconds on page."""
    n = hits.groupBy(visit).agg(F.count("*").alias("_visit_hits"))
    x = hits.join(n, visit)
    return x.groupBy(visit, page).agg(
        F.count_if(F.col("is_entrance")).alias("entrances"), F.count_if(F.col("is_exit")).alias("exits"),
        F.count_if(F.col("hit_type") == "PAGE").alias("pageviews"),
        F.count_if(F.col("hit_type") == "EVENT").alias("events"),
        F.count_if(F.col("is_entrance") & (F.col("_visit_hits") == 1)).alias("bounces"),
        F.min(ts).alias("first_hit"), F.max(ts).alias("last_hit"),
        ((F.max(_micros(ts)) - F.min(_micros(ts))) / 1e6).alias("seconds_on_page"))


def product_funnel_counts(df: DataFrame, month_col: str, visit: str, text: str, completed: Column,
                          rules: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Per month and product rule, sessions viewing it and sessions completing.

    ``rules`` = (product, contains, not_contains). The rule list is exploded onto rows as
    conditional distinct counts in one aggregate: every row is scanned once."""
    aggs = []
    for name, inc, exc in rules:
        cond = F.col(text).contains(inc)
        if exc:
            cond = cond & ~F.col(text).contains(exc)
        aggs.append(F.countDistinct(F.when(cond, F.col(visit))).alias(f"{name}_sessions"))
        aggs.append(F.countDistinct(F.when(cond & completed, F.col(visit))).alias(f"{name}_completions"))
    wide = df.groupBy(month_col).agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("product"), F.col(f"{n}_sessions").alias("sessions"),
                                           F.col(f"{n}_completions").alias("completions")) for n, _, _ in rules]))
    return wide.select(month_col, stacked.alias("r")).select(month_col, "r.*")


def url_path(url: str | Column) -> Column:
    """Path of a URL without scheme, host, query or fragment (F-s7)."""
    return regex_group(url, r"^(?:https?://)?[^/?#]+(/[^?#]*)", 1)


def url_host(url: str | Column) -> Column:
    return regex_group(url, r"^(?:https?://)?([^/?#:]+)", 1)


def url_param(url: str | Column, name: str) -> Column:
    return regex_group(url, rf"[?&]{name}=([^&#]*)", 1)


def page_category(path: str | Column, rules: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """K9: first matching path prefix wins."""
    p = F.col(path) if isinstance(path, str) else path
    out = None
    for prefix, label in rules:
        out = (F.when(p.startswith(prefix), label) if out is None else out.when(p.startswith(prefix), label))
    return out.otherwise(default) if out is not None else F.lit(default)


def first_page(df: DataFrame, visitor: str, host: str, ts: str, event_id: str, url: str) -> DataFrame:
    """K9: first page viewed by each visitor on each host, path without query string."""
    g = df.groupBy(visitor, host).agg(F.min_by(F.struct(ts, event_id, url), F.struct(ts, event_id)).alias("f"))
    return g.select(visitor, host, F.col("f")[ts].alias("first_ts"), url_path(F.col("f")[url]).alias("first_path"))
