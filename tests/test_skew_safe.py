"""Time-bucketed (skew-safe) forms of ordered per-key logic equal the single-window forms."""

import pytest
from pyspark.sql import functions as F

from growthframe.operators.events import sessionize
from growthframe.operators.state import asof_join, asof_join_forward
from growthframe.sources.tables import load
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()))


@pytest.mark.parametrize("bucket", ["day", "hour"])
@pytest.mark.parametrize("gap", [30, 12 * 60, 3 * 24 * 60])
def test_sessionize_bucketed_equals_plain(spark, bucket, gap):
    e = load(spark, SF_SMALL, "events").withColumn(
        "src", F.when((F.col("event_type") == "click") & (F.col("value") > 400), F.lit("ad")))
    cols = ["event_id", "is_session_start", "session_id", "session_number"]
    plain = sessionize(e, "user_id", "ts", "event_id", gap, ["src"], bucket=None)
    bucketed = sessionize(e, "user_id", "ts", "event_id", gap, ["src"], bucket=bucket)
    assert _rows(bucketed, cols) == _rows(plain, cols)


def test_sessionize_one_hot_visitor(spark):
    # every event re-keyed to one visitor: the bucketed plan spreads it over its days
    e = load(spark, SF_SMALL, "events").withColumn("user_id", F.lit(7))
    cols = ["event_id", "is_session_start", "session_id", "session_number"]
    assert _rows(sessionize(e, "user_id", "ts", "event_id", 60, bucket="day"), cols) == \
        _rows(sessionize(e, "user_id", "ts", "event_id", 60, bucket=None), cols)


@pytest.mark.parametrize("bucket", ["day", "hour"])
def test_asof_bucketed_equals_plain(spark, bucket):
    e = load(spark, SF_SMALL, "events")
    left = e.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    right = e.filter(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("rt"), "value")
    cols = ["event_id", "asof_value", "asof_rt"]
    a = asof_join(left, right, ["user_id"], "ts", "rt", ["value", "rt"], bucket=bucket)
    b = asof_join(left, right, ["user_id"], "ts", "rt", ["value", "rt"], bucket=None)
    assert _rows(a, cols) == _rows(b, cols)
    cols = ["event_id", "next_value", "next_rt"]
    a = asof_join_forward(left, right, ["user_id"], "ts", "rt", ["value", "rt"], bucket=bucket)
    b = asof_join_forward(left, right, ["user_id"], "ts", "rt", ["value", "rt"], bucket=None)
    assert _rows(a, cols) == _rows(b, cols)


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_bucketed_window_helpers_equal_plain_windows(spark, bucket):
    from pyspark.sql import Window

    from growthframe.operators.common import bucketed_lag, bucketed_row_number, bucketed_running_sum

    o = load(spark, SF_SMALL, "orders").withColumn("o_custkey", F.col("o_custkey") % 3)  # three hot keys
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    ref = (o.withColumn("rs", F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("rx", F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, -1)))
           .withColumn("lg", F.lag("o_orderstatus").over(w)).withColumn("rn", F.row_number().over(w)))
    x = bucketed_running_sum(o, ["o_custkey"], "o_orderdate", "o_orderkey", "o_totalprice", "rs", bucket)
    x = bucketed_running_sum(x, ["o_custkey"], "o_orderdate", "o_orderkey", "o_totalprice", "rx", bucket, exclusive=True)
    x = bucketed_lag(x, ["o_custkey"], "o_orderdate", "o_orderkey", ["o_orderstatus"], bucket, prefix="lg_")
    x = bucketed_row_number(x, ["o_custkey"], "o_orderdate", "o_orderkey", "rn", bucket)
    a = x.select("o_orderkey", F.round("rs", 2), F.round("rx", 2), F.col("lg_o_orderstatus"), "rn")
    b = ref.select("o_orderkey", F.round("rs", 2), F.round("rx", 2), "lg", "rn")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("bucket", ["hour", "day"])
def test_bucketed_lead_equals_plain_lead(spark, bucket):
    from pyspark.sql import Window

    from growthframe.operators.common import bucketed_lead

    e = load(spark, SF_SMALL, "events").withColumn("user_id", F.col("user_id") % 2)  # two hot visitors
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = e.select("event_id", F.lead("ts").over(w).alias("n_ts"), F.lead("event_type").over(w).alias("n_type"))
    got = bucketed_lead(e, ["user_id"], "ts", "event_id", ["ts", "event_type"], bucket, "n_") \
        .select("event_id", F.col("n_ts"), F.col("n_event_type").alias("n_type"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))


def test_bucketed_row_number_last_flag(spark):
    from pyspark.sql import Window

    from growthframe.operators.common import bucketed_row_number

    e = load(spark, SF_SMALL, "events").withColumn("user_id", F.col("user_id") % 3)
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    ref = e.select("event_id", (F.row_number().over(w) == 1).alias("is_last"))
    got = bucketed_row_number(e, ["user_id"], "ts", "event_id", "rn", "hour", last_name="is_last")
    assert sorted(map(tuple, got.select("event_id", "is_last").collect())) == sorted(map(tuple, ref.collect()))


def test_reply_pairs_small_turn_buckets_equal_one_bucket(spark):
    from growthframe.operators.service import reply_pairs
    c = load(spark, SF_SMALL, "conversations")
    cols = ["conv_id", "reply_turn", "customer_turn", "turn_distance"]
    a = reply_pairs(c, "conv_id", "turn", "role", "assistant", "user", bucket=2)
    b = reply_pairs(c, "conv_id", "turn", "role", "assistant", "user", bucket=1_000_000)
    assert _rows(a, cols) == _rows(b, cols)


def test_forward_lookups_run_once_over_the_rows(spark):
    import datetime as dt
    import random

    from growthframe.operators.events import time_on_page
    from growthframe.operators.state import asof_both

    rng, start = random.Random(4), dt.datetime(2024, 1, 1)

    def rows(n):
        return [(k, rng.choice((None, 1, 1, 1, 2)), None if rng.random() < 0.1 else start + dt.timedelta(hours=rng.randrange(60)), rng.choice((None, 1, 2, 3))) for k in range(n)]

    left, right = rows(120), rows(80)
    lf = spark.createDataFrame(left, "id int, k int, t timestamp_ntz, x int").drop("x")
    rf = spark.createDataFrame(right, "id int, k int, rt timestamp_ntz, v int").drop("id")
    low = lambda v: -1 if v is None else v
    expect = []
    for i, k, t, _ in left:
        of = [(u, v) for _, j, u, v in right if None not in (j, u, t) and j == k]
        before = max(((u, low(v), v) for u, v in of if u < t), default=(None,))[-1]
        after = min(((u, low(v), v) for u, v in of if u >= t), default=(None,))[-1]
        expect.append((i, before, after))
    both = asof_both(lf, rf, ["k"], "t", "rt", ["v"])
    assert sorted(map(tuple, both.select("id", "before_v", "after_v").collect())) == sorted(expect)
    frames = [both]
    for bucket in ("day", "hour", None):
        one = asof_join_forward(lf, rf, ["k"], "t", "rt", ["v"], bucket=bucket)
        assert sorted(map(tuple, one.select("id", "next_v").collect())) == sorted((i, a) for i, _, a in expect)
        frames.append(one)
    frames.append(time_on_page(lf, "k", "t", "id", "id", F.col("id") % 2 == 0, F.col("id") % 3 == 0))
    # a frame up to the last row of a window is read again for every row of it
    for df in frames:
        assert "unboundedfollowing" not in df._jdf.queryExecution().optimizedPlan().toString().lower().replace("unboundedpreceding$(), unboundedfollowing", "")
