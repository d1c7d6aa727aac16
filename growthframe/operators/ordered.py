"""Ordered collection in two levels: sorted pieces of a key, then the pieces in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_pieces(df: DataFrame, keys: Sequence[str], piece: Column, order: Column, value: Column) -> DataFrame:
    """``(keys..., _piece, _values, _n)``: the values of each key and piece in ``order``.

    ``piece`` must not fall while ``order`` rises (a time bucket, a first letter): then the pieces in order are the whole. A key with
    a third of all rows is sorted in as many tasks as it has pieces."""
    x = df.select(*keys, piece.alias("_piece"), F.struct(order.alias("o"), value.alias("v")).alias("_x"))
    g = x.groupBy(*keys, "_piece").agg(F.array_sort(F.collect_list("_x")).alias("_x"))
    return g.select(*keys, "_piece", F.transform("_x", lambda e: e["v"]).alias("_values"), F.size("_x").cast("long").alias("_n"))


def ordered_array(df: DataFrame, keys: Sequence[str], piece: Column, order: Column, value: Column, name: str, distinct: bool = False) -> DataFrame:
    """``(keys..., name, n_<name>)``: all values of a key in ``order`` (ties by value) as one array, NULL values included.

    Only this result holds a key whole: as many elements as ``n_<name>`` says, which is known from the pieces before they are put
    together. With ``distinct`` equal successive values of a piece count once (for an order by the value itself)."""
    p = ordered_pieces(df, keys, piece, order, value)
    if distinct:
        p = p.withColumn("_values", F.array_distinct("_values")).withColumn("_n", F.size("_values").cast("long"))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_piece", "_values"))), lambda e: e["_values"]))
    return p.groupBy(*keys).agg(whole.alias(name), F.sum("_n").alias(f"n_{name}"))


def ordered_text(df: DataFrame, keys: Sequence[str], piece: Column, order: Column, value: Column, sep: str, name: str) -> DataFrame:
    """``(keys..., name, n_<name>, chars_<name>, distinct_<name>)``: the values of a key joined in ``order``, NULL ones left out of the text.

    Pieces are texts already when they meet. ``chars_<name>`` is the length of the text, summed from the pieces; ``distinct_<name>``
    counts different values (NULL is one)."""
    p = ordered_pieces(df, keys, piece, order, value)
    known = F.filter("_values", lambda v: v.isNotNull())
    p = p.select(*keys, "_piece", "_n", F.array_distinct("_values").alias("_set"), F.when(F.size(known) > 0, F.array_join(known, sep)).alias("_text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_piece", "_text"))), lambda e: e["_text"]), sep)
    chars = F.greatest(F.lit(0), F.sum(F.length("_text") + len(sep)) - len(sep))
    return p.groupBy(*keys).agg(whole.alias(name), F.sum("_n").alias(f"n_{name}"), F.coalesce(chars, F.lit(0)).cast("long").alias(f"chars_{name}"),
                                F.size(F.array_distinct(F.flatten(F.collect_list("_set")))).alias(f"distinct_{name}"))
