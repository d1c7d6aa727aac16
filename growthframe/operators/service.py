"""Customer-service conversations and task delivery (K115-K117; documented-only models)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthframe.functions.semantics import epoch_micros, epoch_seconds
from growthframe.operators.common import bucketed_lag, bucketed_last_non_null, bucketed_running_sum


def reply_pairs(messages: DataFrame, conv: str, order: str, role: str, team_role: str, customer_role: str,
                ts: str | None = None, bucket: int = 1000) -> DataFrame:
    """K115: one row per run of consecutive team replies: the run's first reply paired with the
    latest customer message before it; distance in turns, and response seconds when a
    timestamp column exists.

    The previous role and the last customer turn come from turn-bucketed windows (blocks of
    ``bucket`` turns) with the values carried across blocks, so one endless conversation is
    not one sorted task."""
    x = bucketed_lag(messages, [conv], order, order, [role], bucket, prefix="_p_")
    x = x.withColumn("_new_run", F.coalesce(F.col(f"_p_{role}") != F.col(role), F.lit(True))).drop(f"_p_{role}")
    is_cust = F.col(role) == customer_role
    x = bucketed_last_non_null(x, [conv], order, order, F.when(is_cust, F.col(order)), "_last_customer", bucket)
    cols = [conv, F.col(order).alias("reply_turn"), F.col("_last_customer").alias("customer_turn"),
            (F.col(order) - F.col("_last_customer")).alias("turn_distance")]
    if ts:
        x = bucketed_last_non_null(x, [conv], order, order, F.when(is_cust, F.col(ts)), "_last_customer_ts", bucket)
        cols.append((epoch_seconds(ts) - epoch_seconds("_last_customer_ts")).alias("response_seconds"))
    firsts = x.filter((F.col(role) == team_role) & F.col("_new_run") & F.col("_last_customer").isNotNull())
    return firsts.select(*cols)


def first_assignments(events: DataFrame, key: str, ts: str, tie: str, is_start, is_assignment) -> DataFrame:
    """K116: the first assignment after each conversation start or reopening: segments are
    numbered by a running count of start events; the first assignment per segment is a
    aggregate. The running count is month-bucketed (skew-safe)."""
    x = bucketed_running_sum(events.withColumn("_is_start", is_start.cast("long")), [key], ts, tie, "_is_start",
                             "_segment").drop("_is_start")
    x = x.filter(F.col("_segment") > 0)
    g = x.groupBy(key, "_segment").agg(
        F.min(F.when(is_start, F.col(ts))).alias("segment_start"),
        F.min(F.when(is_assignment, F.col(ts))).alias("first_assignment"))
    return g.select(key, F.col("_segment").alias("segment"), "segment_start", "first_assignment",
                    ((epoch_micros("first_assignment") - epoch_micros("segment_start")) / 6e7)
                    .alias("minutes_to_assignment"))


def on_time_rate(tasks: DataFrame, owner: str, due: str, completed: str) -> DataFrame:
    """K117: per owner, tasks completed on or before their due date over completed tasks."""
    on_time = F.col(completed) <= F.col(due)
    return tasks.groupBy(owner).agg(F.count_if(F.col(completed).isNotNull()).alias("completed_tasks"),
                                    F.count_if(on_time).alias("on_time_tasks")) \
        .withColumn("on_time_rate", F.try_divide(F.col("on_time_tasks"), F.col("completed_tasks")))
