"""Sinks and incremental loads.

Tables are Parquet directories, optionally partitioned by a date column. A job never
overwrites the path it is reading: rows that must survive a rewrite are first written to a
staging folder under the shared checkpoint directory (``spark.checkpoint.dir``), which
also cuts the lineage so a lost executor recomputes from the staged files. Partition
rewrites use ``partitionOverwriteMode=dynamic``: only partitions present in the written
data are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthframe.functions.semantics import differs_blank_equal
from growthframe.operators.common import latest_per_key
from growthframe.session import scratch_path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def staging(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Materialise ``df`` under the shared checkpoint folder and read it back (cuts lineage,
    survives executor loss, and frees the source path for rewriting)."""
    path = scratch_path(spark, f"staging/{label}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _delete_partitions(spark: SparkSession, path: str, col: str, values: Sequence) -> None:
    """Remove the directories of partition values; NULL and escaped values are named as Spark names them."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for v in values:
        _delete(spark, f"{path.rstrip('/')}/{name(col, None if v is None else str(v))}")


def _lost(before: DataFrame, after: DataFrame, col: str) -> list:
    """Partition values of ``before`` that ``after`` has no row of (one value per partition)."""
    b, a = before.select(col).distinct(), after.select(F.col(col).alias("_a")).distinct()
    return [r[0] for r in b.join(a, b[col].eqNullSafe(a["_a"]), "left_anti").collect()]


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CREATE OR REPLACE TABLE (``mode="overwrite"``), optionally partitioned."""
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    # rows of a partition come together first (few files each); a large partition is split
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """CREATE OR REPLACE VIEW as a temporary view (lazy: re-evaluated on each use)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """INSERT INTO ... SELECT (append)."""
    write_table(df, path, partition_by, mode="append")


def insert_overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def delete_where(spark: SparkSession, path: str, cond: Column, partition_col: str,
                 touched: Column | None = None) -> None:
    """DELETE FROM table WHERE cond, rewriting only the partitions that can hold
    matching rows (``touched`` is a predicate on the partition column; all partitions when
    None). A NULL condition keeps the row (``NOT coalesce(cond, false)``)."""
    t = spark.read.parquet(path)
    scope = t if touched is None else t.filter(touched)
    keep = staging(spark, scope.filter(~F.coalesce(cond, F.lit(False))), "delete")
    # partitions that lose every row are absent from the rewrite: their directories go once it
    # is done (a handful of metadata operations on the driver)
    emptied = _lost(scope, keep, partition_col)
    if keep.head(1):
        insert_overwrite_partitions(keep, path, [partition_col])
    _delete_partitions(spark, path, partition_col, emptied)


def overwrite_lookback(df: DataFrame, path: str, date_col: str, days: int, as_of) -> None:
    """Incremental delete-and-insert of the last ``days`` days up to ``as_of``: the
    window's partitions are replaced by the new rows of that window (late data of the
    lookback is picked up), partitions outside the window are untouched."""
    spark = df.sparkSession
    a = F.lit(str(as_of)).cast("date")
    new = df.filter((F.col(date_col) >= F.date_sub(a, days)) & (F.col(date_col) <= a))
    stale = []
    if path_exists(spark, path):
        old = spark.read.parquet(path).filter((F.col(date_col) >= F.date_sub(a, days)) & (F.col(date_col) <= a))
        stale = _lost(old, new, date_col)  # window days that no longer have rows: at most `days` + 1
    insert_overwrite_partitions(new, path, [date_col])
    _delete_partitions(spark, path, date_col, stale)


def edge_safe_window(compute: Callable[[DataFrame], DataFrame], source: DataFrame, read_col: str,
                     out_col: str, days: int, as_of) -> DataFrame:
    """Read ``days + 1`` days so entities crossing midnight are whole, compute, then
    keep only the output rows of the last ``days`` days."""
    a = F.lit(str(as_of)).cast("date")
    inp = source.filter(F.to_date(F.col(read_col)) >= F.date_sub(a, days + 1))
    out = compute(inp)
    return out.filter(F.to_date(F.col(out_col)) >= F.date_sub(a, days))


def upsert(spark: SparkSession, base: DataFrame, delta: DataFrame, keys: Sequence[str],
           order: Sequence[str], target: str) -> DataFrame:
    """MERGE by unique key: the union of base and delta keeps the latest row per key
    (``order``), written to ``target`` (a new location; never the base's own path)."""
    u = base.unionByName(delta, allowMissingColumns=True)
    latest = latest_per_key(u, keys, order)
    latest.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def upsert_partitions(spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str],
                      order: Sequence[str], partition_col: str) -> DataFrame:
    """S11 in place on a partitioned table: the partitions the delta touches, and those that hold an
    older version of its keys (found from the key columns alone), are merged with the delta
    (latest row per key), staged under the checkpoint folder and written back with dynamic
    partition overwrite; partitions left without rows are removed after that. A key may move to
    another partition. Other partitions are not rewritten."""
    base = spark.read.parquet(path)
    held = base.select(*keys, partition_col).join(delta.select(*keys).distinct(), list(keys), "left_semi").select(partition_col)
    touched = delta.select(partition_col).union(held).distinct().select(F.col(partition_col).alias("_p"))
    # join on the partition column: dynamic partition pruning skips untouched directories
    scope = base.join(touched, base[partition_col].eqNullSafe(touched["_p"]), "left_semi")
    merged = latest_per_key(scope.unionByName(delta, allowMissingColumns=True), keys, order)
    staged = staging(spark, merged, "upsert")
    emptied = _lost(scope, staged, partition_col)
    insert_overwrite_partitions(staged, path, [partition_col])
    _delete_partitions(spark, path, partition_col, emptied)
    return spark.read.parquet(path)


def historize(spark: SparkSession, history_path: str, snapshot: DataFrame, keys: Sequence[str],
              tracked: Sequence[str], ts_col: str, as_of) -> int:
    """Append to a history table only the snapshot rows whose tracked columns differ
    from the latest stored version of the key (NULL and '' compare equal, M12). Running it
    twice with the same snapshot appends nothing. Returns the number of appended rows."""
    snap = snapshot.withColumn(ts_col, F.lit(str(as_of)).cast("timestamp_ntz"))
    if path_exists(spark, history_path):
        hist = spark.read.parquet(history_path)
        last = latest_per_key(hist, keys, [ts_col])
        j = snap.alias("s").join(last.alias("h"), list(keys), "left")
        changed = F.lit(False)
        for c in tracked:
            changed = changed | differs_blank_equal(F.col(f"s.{c}"), F.col(f"h.{c}"))
        new_key = F.col(f"h.{ts_col}").isNull()
        out = j.filter(new_key | changed).select(*[F.col(f"s.{c}").alias(c) for c in snap.columns])
    else:
        out = snap
    out = staging(spark, out, "historize")
    n = out.count()
    if n:
        out.write.mode("append").parquet(history_path)
    return n
