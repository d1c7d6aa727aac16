"""Shared helpers of the text operators: table access, shared scratch tables, byte words."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from growthframe.session import scratch_path

#: What separates words everywhere in this subpackage: space and the bytes 0x09 to 0x0D.
SPACES = rb"[\x20\x09-\x0D]"
_SPACE = re.compile(SPACES)
#: Rows and bytes of the batches that tasks take; a batch holds one row at least.
BATCH_ROWS, BATCH_BYTES = 2000, 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_scopes: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """What `saved` writes inside goes to a folder of its own, which is removed at the end: for a result that has been written elsewhere by then."""
    _scopes.append(f"{name}-{uuid.uuid4().hex}")
    folder = scratch_path(spark, "/".join(["llm", *_scopes]))
    try:
        yield
    finally:
        _scopes.pop()
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    It cuts the lineage, survives lost executors, keeps column pruning, and gives the planner true
    sizes, so that Spark's own size check decides on broadcasts of what was written."""
    path = scratch_path(df.sparkSession, "/".join(["llm", *_scopes, f"{name}-{uuid.uuid4().hex}"]))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, of: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` over batches of so few rows that whole texts and what is derived from them stay small in memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(of, schema)


def word_pieces(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists that cover about ``size`` bytes each; no word is cut.

    ``bytes.split`` separates at exactly the bytes of ``SPACES``."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + size, n)
        if end < n:
            m = _SPACE.search(data, end)
            end = m.start() if m else n
        words = data[at:end].split()
        if words:
            yield words
        at = end
