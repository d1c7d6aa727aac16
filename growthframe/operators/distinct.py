"""Exact distinct counts in many scopes from one aggregate: mergeable bitmaps over dense ids.

A set of ids is one bitmap for each 32,768 successive ids, of 4 KiB. Bitmaps of small groups are built once, by the finest keys;
the set of any coarser scope is their union (a bitwise or), so nothing is counted twice and no row is repeated for a scope or period.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthframe.operators.ranking import exact_row_number
from growthframe.session import materialize


def dense_ids(df: DataFrame, key: str, name: str = "dense_id") -> DataFrame:
    """``(key, name)``: the distinct non-NULL keys numbered from 1 without gaps, for keys that aren't dense numbers themselves."""
    return exact_row_number(df.select(key).filter(F.col(key).isNotNull()).distinct(), [key], name=name)


def id_bitmaps(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column], id_col: str) -> DataFrame:
    """``(keys..., _bucket, flags...)``: per group the bitmap of the ids (positive numbers) of the rows on which each flag holds.

    One hash aggregate for all flags; it combines on the map side, so a hot group sends a few bitmaps per task. A row
    without the flag sets no bit."""
    i = F.col(id_col)
    x = df.filter(i.isNotNull()).select(*keys, F.bitmap_bucket_number(i).alias("_bucket"), F.bitmap_bit_position(i).alias("_bit"), *[c.alias(n) for n, c in flags.items()])
    return x.groupBy(*keys, "_bucket").agg(*[F.bitmap_construct_agg(F.when(F.col(n), F.col("_bit"))).alias(n) for n in flags])


def union_counts(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``(keys..., names...)``: the exact numbers of distinct ids in the unions of the bitmaps by coarser (or no) ``keys``."""
    merged = bitmaps.groupBy(*keys, "_bucket").agg(*[F.bitmap_or_agg(n).alias(n) for n in names])
    return merged.groupBy(*keys).agg(*[F.sum(F.bitmap_count(n)).cast("long").alias(n) for n in names])


def distinct_by_scopes(df: DataFrame, scopes: Mapping[str, Sequence[str]], flags: Mapping[str, Column], id_col: str, label: str = "scope") -> DataFrame:
    """Distinct ids per flag in each of ``scopes`` (label -> key columns; columns outside a scope are NULL), all from one pass.

    The bitmaps of the finest keys are written once; a scope reads that table, which has one row per finest group and bucket."""
    columns = list(dict.fromkeys(c for keys in scopes.values() for c in keys))
    bitmaps = materialize(id_bitmaps(df, columns, flags, id_col))
    out = None
    for name, keys in scopes.items():
        one = union_counts(bitmaps, keys, list(flags)).withColumn(label, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.select(label, *columns, *flags)
