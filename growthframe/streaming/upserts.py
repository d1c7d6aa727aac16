"""Streaming upsert: late and corrected rows merged into a partitioned table, each batch once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthframe.operators.common import latest_per_key
from growthframe.session import checkpoint_dir
from growthframe.sources.sinks import path_exists, upsert_partitions, write_table


def applied_batches(spark: SparkSession, ledger: str) -> DataFrame:
    """``(batch_id, rows)`` of the batches that the table holds."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], "rows long, batch_id long").select("batch_id", "rows")
    return spark.read.schema("rows long, batch_id long").parquet(ledger).select("batch_id", "rows")


def merge_batch(batch: DataFrame, batch_id: int, path: str, ledger: str, keys: Sequence[str], order: Sequence[str], partition_col: str) -> bool:
    """Merge one micro-batch into the table under ``path``; False if the ledger says that it was merged before.

    The latest version of each key stays (``order``): a late correction replaces the row of an earlier batch, also in another
    partition, and an older version that comes late changes nothing. The ledger entry is written last. A batch that is
    interrupted has none and is merged again from its beginning, which leads to the same table: what was merged already
    is an equal or older version of itself."""
    spark = batch.sparkSession
    mark = f"{ledger}/batch_id={batch_id}"
    if path_exists(spark, f"{mark}/_SUCCESS"):
        return False
    delta = latest_per_key(batch, keys, order)
    if path_exists(spark, path):
        upsert_partitions(spark, path, delta, keys, order, partition_col)
    else:
        write_table(delta, path, [partition_col])
    batch.agg(F.count("*").alias("rows")).write.mode("overwrite").parquet(mark)
    return True


def upsert_stream(stream: DataFrame, path: str, name: str, keys: Sequence[str], order: Sequence[str], partition_col: str,
                  available_now: bool = False, after_merge: Callable[[int], None] | None = None):
    """Start a query that merges ``stream`` into the table under ``path`` (`merge_batch`), exactly once.

    Checkpoint and ledger lie under the shared folder by ``name``: after a restart the engine may deliver its last batch again,
    with the same number and the same rows, and the ledger tells whether it was merged. ``after_merge`` is called with the
    batch's number between the merge and the engine's own commit. Repeated keys of a batch count once."""
    base = f"{checkpoint_dir(stream.sparkSession).rstrip('/')}/stream-upsert/{name}"

    def each(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            merge_batch(held, batch_id, path, f"{base}/ledger", keys, order, partition_col)
        finally:
            held.unpersist()
        if after_merge is not None:
            after_merge(batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{base}/checkpoint")
    return (w.trigger(availableNow=True) if available_now else w).start()


def ledger_of(spark: SparkSession, name: str) -> DataFrame:
    """The ledger of the query of that name."""
    return applied_batches(spark, f"{checkpoint_dir(spark).rstrip('/')}/stream-upsert/{name}/ledger")
