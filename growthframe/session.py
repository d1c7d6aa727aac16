"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every growthframe job relies on. AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting handles a hot key (one
# customer / store / source holding a large share of rows) without salting code.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "growthframe", extra: dict | None = None) -> SparkSession:
    """Session with the settings above. ``master`` is set only when given (tests, the bench):
    under spark-submit the submitted master and driver memory stand. ``shuffle_partitions`` should be sized to the
    data (roughly input bytes / 128 MB); AQE coalesces the excess."""
    builder = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if master is not None:
        builder = builder.master(master)
        conf["spark.driver.memory"] = os.environ.get("GF_DRIVER_MEMORY", "16g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if _one_machine(spark):
        checkpoint_dir(spark)
    return spark


def _one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster ``spark.checkpoint.dir`` names a shared, durable folder and is used as
    is; without it this is an error, as a folder of one machine can't be read by the others. Only in a
    local session a private temporary folder is created, and removed at exit."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not _one_machine(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="gf-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of this application under the shared checkpoint folder, for an intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{spark.sparkContext.applicationId}/{name}"


def release_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; frames read from them are void."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "")[:-1])
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read back. Used where
    one expensive derivation feeds several branches of a plan (e.g. sessionized events feeding
    hit-level measures): each branch reads only the columns it needs, the lineage is cut, and a lost
    executor costs nothing but the read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
