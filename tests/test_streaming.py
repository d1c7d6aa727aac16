"""Streaming twins: the foreachBatch sink and the memory-sink drain agree with batch forms."""

import uuid

from pyspark.sql import functions as F

from growthframe.session import scratch_path
from growthframe.sources.tables import load
from growthframe.streaming import twins as TW
from tests.conftest import SF_SMALL


def test_foreach_batch_sink_dedupes_and_is_complete(spark):
    s = TW.events_stream(spark, SF_SMALL)
    twice = s.unionByName(s)
    path = scratch_path(spark, f"test/stream-sink-{uuid.uuid4().hex}")
    q = TW.to_parquet_foreach_batch(twice.select("event_id", "user_id"), path, f"sink-{uuid.uuid4().hex}",
                                    keys=["event_id"])
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(path)
    batch = load(spark, SF_SMALL, "events")
    assert out.select("event_id").distinct().count() == batch.count()
    # within each micro-batch every event is written once
    assert out.groupBy("batch_id", "event_id").count().filter(F.col("count") > 1).count() == 0


def test_daily_stream_counts_equal_batch_for_closed_days(spark):
    stream = TW.run_available_now(TW.daily_counts(TW.events_stream(spark, SF_SMALL)), "test_daily")
    e = load(spark, SF_SMALL, "events")
    batch = e.groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count("*").alias("events"))
    closed = batch.join(stream.select("date").distinct(), "date")
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, closed.select("date", "event_type", "events").collect()))
