"""Shared building blocks used by several operator families."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_group_agg(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """``agg(...) OVER (PARTITION BY keys)`` without a window.

    A partition-only window sends every row of a key to one task and sorts it; a hot key
    (a third of the rows) then becomes one huge task. Aggregating first is partial
    (map-side combine) and the result has one row per key, so the join back is a normal
    shuffle join that AQE's skew handling can split on the big side."""
    x = df.withColumn("_g", F.struct(*keys))
    return x.join(x.groupBy("_g").agg(*aggs), "_g", "left").drop("_g")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   ascending: bool = False) -> DataFrame:
    """Top-1 row per key ("latest version", O3, W18 QUALIFY ROW_NUMBER() = 1).

    Written as ``max_by(struct(all columns), struct(order))``: an aggregate that combines
    map-side, so only one candidate row per key and partition is shuffled, and a hot key
    costs no more than any other. Ties on ``order`` are broken by the full row (deterministic)."""
    cols = df.columns
    ordkey = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order],
                      F.struct(*[F.col(c) for c in cols]))
    pick = F.max_by if not ascending else F.min_by
    out = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c).alias(c) for c in cols]), ordkey).alias("_row"))
    return out.select("_row.*")


def explode_scopes(df: DataFrame, scopes: Sequence[tuple[str, Column]], name: str = "scope") -> DataFrame:
    """One scan, several scopes: each row is repeated once per scope whose condition holds.

    Replaces ``SELECT ... WHERE c1 UNION ALL SELECT ... WHERE c2 ...`` (n scans) by a single
    scan and ``explode(filter(array(...)))``."""
    arr = F.array(*[F.when(cond, F.lit(label)) for label, cond in scopes])
    return df.withColumn(name, F.explode(F.filter(arr, lambda x: x.isNotNull())))


# ------------------------------------------------------------------ time-bucketed ordered windows
#
# ``f() OVER (PARTITION BY keys ORDER BY ts, tie)`` sorts every row of a key in one task, which
# a key holding a large share of the rows turns into a straggler (AQE cannot split a window
# partition). The helpers below partition the window by (keys, time bucket) instead and carry
# what crosses a bucket boundary with a small per-(keys, bucket) aggregate and a window over
# buckets (one row per key and active bucket), joined back on (keys, bucket).
#
# Keys and bucket are one struct column, which is never NULL itself: rows with a NULL key stay
# together, as in a window partition, and rows with a NULL time form the key's first bucket, as
# SQL sorts them. The join back and the window share one partitioning on that column.

def _bucketed(df: DataFrame, keys: Sequence[str], ts: str, bucket: str | int):
    """Bucket = a time unit for date_trunc ("hour", "day", "month") or, for an integer order
    column (turn, sequence number), a bucket width."""
    b = F.floor(F.col(ts) / bucket) if isinstance(bucket, int) else F.date_trunc(bucket, F.col(ts))
    x = df.withColumn("_g", F.struct(F.struct(*keys).alias("k"), b.alias("b")))
    return x, Window.partitionBy("_g.k").orderBy("_g.b")


def bucketed_last_non_null(df: DataFrame, keys: Sequence[str], ts: str, tie: str, col: Column, name: str,
                           bucket: str | int = "month") -> DataFrame:
    """``LAST_VALUE(col IGNORE NULLS) OVER (PARTITION BY keys ORDER BY ts, tie ROWS BETWEEN
    UNBOUNDED PRECEDING AND 1 PRECEDING)``, skew-safe: inside the bucket a running window,
    from earlier buckets the last non-NULL value of each bucket carried forward."""
    x, over_b = _bucketed(df.withColumn("_v", col), keys, ts, bucket)
    wb = Window.partitionBy("_g").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, -1)
    per = x.groupBy("_g").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(ts, tie))).alias("_bl"))
    per = per.withColumn("_carry", F.last("_bl", ignorenulls=True).over(
        over_b.rowsBetween(Window.unboundedPreceding, -1))).drop("_bl")
    x = x.join(per, "_g")
    return x.withColumn(name, F.coalesce(F.last("_v", ignorenulls=True).over(wb), F.col("_carry"))) \
        .drop("_g", "_v", "_carry")


def bucketed_lag(df: DataFrame, keys: Sequence[str], ts: str, tie: str, cols: Sequence[str],
                 bucket: str = "month", prefix: str = "prev_") -> DataFrame:
    """``LAG(c) OVER (PARTITION BY keys ORDER BY ts, tie)`` for each column, skew-safe."""
    x, over_b = _bucketed(df, keys, ts, bucket)
    wb = Window.partitionBy("_g").orderBy(ts, tie)
    last = x.groupBy("_g").agg(F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(ts, tie)).alias("_bl"))
    last = last.withColumn("_pl", F.lag("_bl").over(over_b)).drop("_bl")
    x = x.join(last, "_g").withColumn("_first", F.row_number().over(wb) == 1)
    for c in cols:
        x = x.withColumn(prefix + c, F.when(F.col("_first"), F.col("_pl")[c]).otherwise(F.lag(c).over(wb)))
    return x.drop("_g", "_pl", "_first")


def bucketed_lead(df: DataFrame, keys: Sequence[str], ts: str, tie: str, cols: Sequence[str],
                  bucket: str = "month", prefix: str = "next_") -> DataFrame:
    """``LEAD(c) OVER (PARTITION BY keys ORDER BY ts, tie)`` for each column, skew-safe: the last
    row of a bucket takes the first row of the key's next active bucket."""
    x, over_b = _bucketed(df, keys, ts, bucket)
    wb = Window.partitionBy("_g").orderBy(ts, tie)
    first = x.groupBy("_g").agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(ts, tie)).alias("_bf"))
    first = first.withColumn("_nf", F.lead("_bf").over(over_b)).drop("_bf")
    x = x.join(first, "_g").withColumn("_last", F.lead(F.lit(1)).over(wb).isNull())
    for c in cols:
        x = x.withColumn(prefix + c, F.when(F.col("_last"), F.col("_nf")[c]).otherwise(F.lead(c).over(wb)))
    return x.drop("_g", "_nf", "_last")


def bucketed_running_sum(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, name: str,
                         bucket: str = "month", exclusive: bool = False) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY keys ORDER BY ts, tie ROWS UNBOUNDED PRECEDING TO
    CURRENT ROW)`` (or to 1 PRECEDING when ``exclusive``), skew-safe. NULL when no row is summed,
    as in SQL."""
    x, over_b = _bucketed(df, keys, ts, bucket)
    wb = Window.partitionBy("_g").orderBy(ts, tie)
    tot = x.groupBy("_g").agg(F.sum(value).alias("_bt"), F.count(value).alias("_bn"))
    tot = (tot.withColumn("_before", F.sum("_bt").over(over_b.rowsBetween(Window.unboundedPreceding, -1)))
           .withColumn("_before_n", F.sum("_bn").over(over_b.rowsBetween(Window.unboundedPreceding, -1)))
           .drop("_bt", "_bn"))
    x = x.join(tot, "_g")
    frame = wb.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    inside = F.sum(value).over(frame)
    n_inside = F.count(value).over(frame)
    total_n = F.coalesce(F.col("_before_n"), F.lit(0)) + n_inside
    s = F.coalesce(F.col("_before"), F.lit(0)) + F.coalesce(inside, F.lit(0))
    return x.withColumn(name, F.when(total_n > 0, s)).drop("_g", "_before", "_before_n")


def bucketed_row_number(df: DataFrame, keys: Sequence[str], ts: str, tie: str, name: str,
                        bucket: str = "month", last_name: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ts, tie)``, skew-safe. With ``last_name``
    also a flag for the key's last row (last row of its last active bucket), from the same
    per-bucket table: no extra aggregate."""
    x, over_b = _bucketed(df, keys, ts, bucket)
    wb = Window.partitionBy("_g").orderBy(ts, tie)
    cnt = x.groupBy("_g").agg(F.count("*").alias("_bn"))
    cnt = (cnt.withColumn("_before", F.coalesce(F.sum("_bn").over(
        over_b.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("_last_bucket", F.lead(F.lit(1)).over(over_b).isNull()).drop("_bn"))
    x = x.join(cnt, "_g").withColumn(name, F.col("_before") + F.row_number().over(wb))
    if last_name:
        x = x.withColumn(last_name, F.col("_last_bucket") & F.lead(F.lit(1)).over(wb).isNull())
    return x.drop("_g", "_before", "_last_bucket")


def bucketed_running_extreme(df: DataFrame, keys: Sequence[str], ts: str, tie: str, value: str, name: str, greatest: bool,
                             bucket: str = "month", exclusive: bool = False) -> DataFrame:
    """``MAX(value)`` (``greatest``) or ``MIN(value)`` over the rows up to the current one (or the one
    before it, when ``exclusive``) of a key, skew-safe; NULL values are passed over."""
    x, over_b = _bucketed(df, keys, ts, bucket)
    wb = Window.partitionBy("_g").orderBy(ts, tie)
    one, two = (F.max, F.greatest) if greatest else (F.min, F.least)
    per = x.groupBy("_g").agg(one(value).alias("_bx"))
    per = per.withColumn("_before", one("_bx").over(over_b.rowsBetween(Window.unboundedPreceding, -1))).drop("_bx")
    inside = one(value).over(wb.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0))
    return x.join(per, "_g").withColumn(name, two(F.col("_before"), inside)).drop("_g", "_before")


def piecewise_row_number(df: DataFrame, keys: Sequence[str], piece: Column, order: Sequence[Column], name: str) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` for any order, by pieces of a key: ``piece`` must not fall along the
    order (its first term, a day of it). A piece is numbered by itself, behind the rows of the pieces before it, so that a hot key
    is spread over as many tasks as it has pieces."""
    x = df.withColumn("_g", F.struct(F.struct(*keys).alias("k"), piece.alias("p")))
    n = x.groupBy("_g").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g.k").orderBy("_g.p").rowsBetween(Window.unboundedPreceding, -1))
    n = n.select("_g", F.coalesce(before, F.lit(0)).alias("_before"))
    w = Window.partitionBy("_g").orderBy(*order)
    return x.join(n, "_g").withColumn(name, F.col("_before") + F.row_number().over(w)).drop("_g", "_before")
