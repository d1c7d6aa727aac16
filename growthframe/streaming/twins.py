"""Structured Streaming twins of the batch operators.

Sources are Parquet directories read incrementally (``readStream``); late data is bounded by
a watermark equal to the reference's lookback (3 days for events). Checkpoints live under
the shared ``spark.checkpoint.dir`` so a restarted query resumes exactly once. Sinks are
``foreachBatch`` writers (Parquet, idempotent per batch id).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthframe.functions.semantics import civil_from_instant, instant_from_civil
from growthframe.session import checkpoint_dir, scratch_path
from growthframe.sources.sinks import path_exists

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def events_stream(spark: SparkSession, source_dir: str, max_files: int | None = None) -> DataFrame:
    """Incremental read of ``events.parquet`` files in a directory (a file source must be a
    directory; the glob filter picks the table)."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", "events*.parquet")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    # watermarks need an instant type: the civil time is read as a UTC instant, whatever the
    # session time zone (no daylight-saving gaps inside session gaps)
    return r.parquet(source_dir).withColumn("ts", instant_from_civil("ts"))


def session_counts(stream: DataFrame, gap: str = "30 minutes", watermark: str = "3 days") -> DataFrame:
    """Session windows per user (``session_window``), closed by the watermark."""
    return (stream.withWatermark("ts", watermark)
            .groupBy(F.session_window("ts", gap).alias("session"), "user_id")
            .agg(F.count("*").alias("events"))
            .select("user_id", civil_from_instant(F.col("session.start")).alias("session_start"),
                    civil_from_instant(F.col("session.end")).alias("session_end"), "events"))


def daily_counts(stream: DataFrame, watermark: str = "3 days") -> DataFrame:
    """T4: tumbling one-day counts per event type, emitted once the day is closed."""
    return (stream.withWatermark("ts", watermark)
            .groupBy(F.window("ts", "1 day").alias("w"), "event_type")
            .agg(F.count("*").alias("events"))
            .select(F.to_date(civil_from_instant(F.col("w.start"))).alias("date"), "event_type", "events"))


def dedupe_stream(stream: DataFrame, key: str = "event_id", watermark: str = "3 days") -> DataFrame:
    """Repeated deliveries of the same event inside the watermark delay are dropped
    (state kept only for the delay, unlike a plain ``dropDuplicates``)."""
    return stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])


def run_available_now(df: DataFrame, name: str) -> DataFrame:
    """Drain everything available into the Parquet sink and read it back as a batch DataFrame.

    In append mode a window comes out once the watermark has passed it: what lies within the
    watermark's delay of the newest event stays in the state for the next run."""
    spark = df.sparkSession
    path = scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex}")
    to_parquet_foreach_batch(df, path, f"{name}-{uuid.uuid4().hex}", available_now=True).awaitTermination()
    if not path_exists(spark, path):
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(path).drop("batch_id")


def to_parquet_foreach_batch(df: DataFrame, path: str, name: str, keys: list[str] | None = None, available_now: bool = False):
    """Production sink: ``foreachBatch`` writes each micro-batch to Parquet; with ``keys`` the
    batch is first de-duplicated on them. Idempotent on replay because the batch id names the
    written partition. The checkpoint lies under the shared folder by ``name`` alone, so a restarted job goes on."""
    spark = df.sparkSession
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/stream-ckpt/{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.dropDuplicates(keys) if keys else batch
        b.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
    return (w.trigger(availableNow=True) if available_now else w).start()
