"""Corpus preparation: the stages a training corpus runs through, each written as Parquet and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from growthframe.llm.common import remove, scratch_scope, table
from growthframe.llm.decontaminate import drop_leaks
from growthframe.llm.line_dedup import keep_lines
from growthframe.llm.piece_codec import encode
from growthframe.llm.quality import keep_good
from growthframe.llm.simhash import keep_one
from growthframe.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose perplexity lies in their language's band."""
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later copies of repeated line runs; a document of which no word is left goes. ``n_chars`` follows the text."""
    return keep_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece ids, with their number and whether they decode to the text."""
    return encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", simhash_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("piece_encoding", encoding_stage),
]

#: A language model, approximate search and an encoder are not SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; what the last one returns.

    Rows with NULLs in any column, repeated rows and columns of clashing names pass through each stage as its operator says; an
    empty table gives an empty one. Each stage's rows are written to the shared folder before the next one starts; then what the
    stage wrote for itself, and the rows of the stage before, are removed: one copy of the corpus is held, and its successor."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline/{name}-{uuid.uuid4().hex}")
        with scratch_scope(spark, name):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
