"""Named-table scans, date-sharded scans, mapping seeds and generated relations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Declared source ``name`` read from ``{sf_dir}/{name}.parquet``.

    Column pruning and filter pushdown reach the Parquet scan because the plan is
    declarative; callers should select only what they use."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Every table as a temporary view (``CREATE OR REPLACE VIEW``)."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


def scan_shards(df: DataFrame, partition_col: str, lo, hi) -> DataFrame:
    """The ``events_*`` + ``_TABLE_SUFFIX BETWEEN lo AND hi`` pattern.

    On a day-partitioned layout (``write.partitionBy(partition_col)``) the predicate is a
    partition filter and prunes whole directories; on flat files it is a pushed filter."""
    return df.filter(F.col(partition_col).between(F.lit(lo), F.lit(hi)))


MAPPING_SCHEMA = T.StructType([
    T.StructField("utm_source", T.StringType()),
    T.StructField("utm_medium", T.StringType()),
    T.StructField("via", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("sort", T.IntegerType()),
])


def read_mapping_seed(spark: SparkSession, path: str, schema: T.StructType = MAPPING_SCHEMA) -> DataFrame:
    """S3: tab separated seed with a header, explicit schema (never inferred)."""
    return (spark.read.option("sep", "\t").option("header", True)
            .option("nullValue", "").schema(schema).csv(path))


def generate_range(spark: SparkSession, start: int, stop: int, name: str = "n") -> DataFrame:
    """GENERATE_ARRAY / SEQ4 as a distributed range."""
    return spark.range(start, stop).withColumnRenamed("id", name)


def date_bounds(df: DataFrame, col: str) -> tuple:
    """min/max of a column read first, then used as literals (one tiny aggregate row)."""
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return row["lo"], row["hi"]


def as_date_lit(d) -> Column:
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d).cast("date")
