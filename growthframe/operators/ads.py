"""Advertising consolidation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthframe.functions.semantics import blank_to_null


def hierarchy_reconcile(levels: Sequence[DataFrame], ids: Sequence[str], measures: Sequence[str],
                        date: str = "date_report") -> DataFrame:
    """Stats reported at several levels of one hierarchy (campaign, ad group, ad, ...)
    reconciled into one table whose totals equal the coarsest level.

    ``levels[i]`` carries ``date`` + ``ids[: i + 1]`` + measures. Level 0 is added as is; each
    finer level i is added with its ids (+1) and subtracted at its parent's ids with id i
    NULL (-1), so the part of the parent not explained by children stays on a NULL-id row.
    One ``explode`` per level and ONE aggregate (partial, map-side) over the union."""
    parts = []
    for i, lv in enumerate(levels):
        own = ids[: i + 1]
        full = [F.col(c) if c in own else F.lit(None).cast("string") for c in ids]
        if i == 0:
            sign_rows = F.array(F.struct(F.lit(1).alias("s"), *[x.cast("string").alias(c) for x, c in zip(full, ids)]))
        else:
            parent = [F.col(c).cast("string") if c in ids[:i] else F.lit(None).cast("string") for c in ids]
            sign_rows = F.array(
                F.struct(F.lit(1).alias("s"), *[x.cast("string").alias(c) for x, c in zip(full, ids)]),
                F.struct(F.lit(-1).alias("s"), *[x.alias(c) for x, c in zip(parent, ids)]))
        x = lv.select(date, *measures, F.explode(sign_rows).alias("_k")).select(date, *measures, "_k.*")
        parts.append(x)
    u = reduce(lambda a, b: a.unionByName(b), parts)
    g = u.groupBy(date, *ids).agg(*[F.sum((F.col(m) * F.col("s")).cast("decimal(28,9)")).alias(m) for m in measures])
    # exact sums: what cancels out is 0, whatever the order of addition
    nonzero = reduce(lambda a, b: a | b, [F.col(m) != 0 for m in measures])
    return g.filter(nonzero).withColumns({m: F.col(m).cast(levels[0].schema[m].dataType) for m in measures})


def latest_dim(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current attributes per object: top-1 row per key by ``order`` (aggregate form)."""
    from growthframe.operators.common import latest_per_key
    return latest_per_key(df, keys, order)


def consolidate_platforms(platforms: Sequence[tuple[str, DataFrame]], keys: Sequence[str],
                          measures: Sequence[str], names: DataFrame | None = None, name_key: str | None = None) -> DataFrame:
    """Platform tables already mapped to one schema (keys + measures) stacked with a
    platform column, names joined from a dimension, summed, and rows whose measures are all
    zero or NULL dropped."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
               [df.withColumn("platform", F.lit(p)) for p, df in platforms])
    g = u.groupBy("platform", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    nonempty = reduce(lambda a, b: a | b, [F.coalesce(F.col(m), F.lit(0)) != 0 for m in measures])
    g = g.filter(nonempty)
    if names is not None:
        g = g.join(names, name_key, "left")
    return g


def cross_source_table(sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Several sources with different measures stacked by name; a source's missing
    measures are NULL (``unionByName(allowMissingColumns=True)``)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn("source", F.lit(s)) for s, df in sources])


def json_conversions(df: DataFrame, json_col: str, keys: Sequence[str], measures: dict[str, Sequence[str]]) -> DataFrame:
    """Conditional sums over a JSON list of {action_type, value}: for each measure the
    sum of values whose action type is in its list, stacked as (keys, measure, value)."""
    arr = F.from_json(F.col(json_col), "array<struct<action_type:string,value:string>>")
    x = df.withColumn("_a", arr)
    def total(types: Sequence[str]) -> Column:
        picked = F.filter("_a", lambda e: e["action_type"].isin(list(types)))
        return F.aggregate(picked, F.lit(0.0), lambda acc, e: acc + F.coalesce(e["value"].try_cast("double"),
                                                                                F.lit(0.0)))

    per_row = [total(types).alias(m) for m, types in measures.items()]
    g = x.select(*keys, *per_row).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    st = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures]))
    return g.select(*keys, st.alias("_s")).select(*keys, "_s.*")


def stage_flatten(df: DataFrame, json_col: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Staging projection of JSON blobs: each field = (JSON path, type); strings with
    '' become NULL, numbers convert leniently (NULL when not numeric)."""
    cols: list[Column] = []
    for name, (path, typ) in fields.items():
        raw = F.get_json_object(F.col(json_col), path)
        cols.append((blank_to_null(raw) if typ == "string" else raw.try_cast(typ)).alias(name))
    return df.select("*", *cols)
