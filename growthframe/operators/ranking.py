"""Exact global ranks and NTILE without a single-partition window.

``Window.orderBy(x)`` with no partition moves every row to one task. Here the rows are
range-partitioned on the sort key (sampling picks balanced bounds), sorted inside each
partition, numbered locally with ``monotonically_increasing_id`` (consecutive within a
partition), and shifted by the row counts of the preceding partitions. The only data that
crosses to every task is one count per (partition, group): bounded by the number of
partitions times groups, never by the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.session import checkpoint_dir


def exact_row_number(df: DataFrame, order: Sequence[Column | str], partition_cols: Sequence[str] = (),
                     name: str = "rn", num_partitions: int | None = None, keep_total: bool = False,
                     materialize: bool = True) -> DataFrame:
    """ROW_NUMBER() OVER ([PARTITION BY partition_cols] ORDER BY order), distributed.

    ``order`` must be a total order (add a unique tie-breaker). Ascending only; negate a
    numeric key for descending order."""
    keys = [F.col(c) for c in partition_cols] + [F.col(o) if isinstance(o, str) else o for o in order]
    # sized like any shuffle of the job (spark.sql.shuffle.partitions, set to the data size)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    part = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    part = part.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    if materialize:
        # the numbered rows feed two branches (counts and the final join); a reliable
        # checkpoint in spark.checkpoint.dir computes them once, cuts the lineage (nested
        # rankings do not re-run their inputs) and survives executor loss
        checkpoint_dir(df.sparkSession)
        part = part.checkpoint(eager=True)
    # the group as one struct column, never NULL itself: the group of a NULL key is a group
    gkeys = ["_g"] if partition_cols else []
    if partition_cols:
        part = part.withColumn("_g", F.struct(*partition_cols))
    # a partition holds a contiguous key range, so inside it each group is a contiguous run;
    # the first id of the run anchors the local numbering of that group in that partition
    counts = part.groupBy("_pid", *gkeys).agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*gkeys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) if gkeys else \
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    totals = counts.groupBy(*gkeys).agg(F.sum("_n").alias("_total")) if gkeys else \
        counts.agg(F.sum("_n").alias("_total"))
    if gkeys:
        offsets = offsets.join(totals, gkeys)
    else:
        offsets = offsets.withColumn("_total", totals.scalar())
    offsets = offsets.select("_pid", *gkeys, "_off", "_first", "_total")
    # one row per partition (no groups): bounded by the partition count, broadcast; with
    # groups the table has partitions x groups rows and AQE picks the join from its size
    out = part.join(F.broadcast(offsets) if not gkeys else offsets, ["_pid", *gkeys])
    out = (out.withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_first")) + 1)
           .drop("_pid", "_mid", "_off", "_first", "_g"))
    return out if keep_total else out.drop("_total")


def ntile_from_rank(rank: Column, total: Column, n: int) -> Column:
    """NTILE(n) bucket of a 1-based rank among ``total`` rows: the first ``total % n``
    buckets hold one row more (standard NTILE remainder rule)."""
    q = F.floor(total / n)
    r = total % n
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
        .otherwise(r + F.floor((rank - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("int")


def exact_ntile(df: DataFrame, n: int, order: Sequence[Column | str], partition_cols: Sequence[str] = (),
                name: str = "ntile", num_partitions: int | None = None) -> DataFrame:
    """NTILE(n) OVER ([PARTITION BY ...] ORDER BY order), exact and distributed."""
    r = exact_row_number(df, order, partition_cols, "_rank", num_partitions, keep_total=True)
    return r.withColumn(name, ntile_from_rank(F.col("_rank"), F.col("_total"), n)).drop("_rank", "_total")
