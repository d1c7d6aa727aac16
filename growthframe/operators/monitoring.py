"""Monitoring: snapshot differences, data tests, freshness, reconciliation (S13, K112-K114)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthframe.functions.semantics import epoch_seconds


def snapshot_diff(current: DataFrame, earlier: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose multiplicity changed between two snapshots, with the signed delta.

    +1 for the current snapshot, -1 for the earlier one, one aggregate (partial, map-side)."""
    a = current.select(*cols, F.lit(1).alias("_s"))
    b = earlier.select(*cols, F.lit(-1).alias("_s"))
    return (a.unionByName(b).groupBy(*cols).agg(F.sum("_s").cast("long").alias("delta"))
            .filter(F.col("delta") != 0))


def freshness(df: DataFrame, ts: str, as_of, warn_hours: float = 24, error_hours: float = 48) -> DataFrame:
    """K114: age of the newest row at ``as_of`` and a pass / warn / error status."""
    g = df.agg(F.max(ts).alias("max_ts"))
    age = (epoch_seconds(F.lit(as_of).cast("timestamp_ntz")) - epoch_seconds("max_ts")) / 3600.0
    return g.select("max_ts", F.round(age, 3).alias("age_hours"),
                    F.when(age > error_hours, "error").when(age > warn_hours, "warn").otherwise("pass")
                    .alias("status"))


def check(df: DataFrame, rules: Sequence[dict], table: str = "table") -> DataFrame:
    """K113: dbt-style column tests evaluated in ONE aggregate over the table.

    Rule kinds: ``unique`` (column or column list), ``not_null``, ``accepted_values``,
    ``not_accepted_values``. Each yields (table, test, column, failures, severity, status).
    ``relationships`` is :func:`check_relationship` (an anti join)."""
    aggs: list[Column] = []
    meta = []
    for i, r in enumerate(rules):
        kind = r["test"]
        cols = r["column"] if isinstance(r["column"], (list, tuple)) else [r["column"]]
        label = ",".join(cols)
        if kind == "not_null":
            e = F.count_if(F.col(cols[0]).isNull())
        elif kind == "unique":
            key = F.struct(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])
            e = F.count(key) - F.countDistinct(key)  # a combination with a NULL member is a value
        elif kind == "accepted_values":
            e = F.count_if(F.col(cols[0]).isNotNull() & ~F.col(cols[0]).isin(list(r["values"])))
        elif kind == "not_accepted_values":
            e = F.count_if(F.col(cols[0]).isin(list(r["values"])))
        else:
            raise ValueError(kind)
        aggs.append(e.cast("long").alias(f"r{i}"))
        meta.append((kind, label, r.get("severity", "error")))
    row = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(k).alias("test"), F.lit(lbl).alias("column"), F.col(f"r{i}").alias("failures"),
                 F.lit(sev).alias("severity")) for i, (k, lbl, sev) in enumerate(meta)]))
    out = row.select(stacked.alias("t")).select("t.*")
    return out.select(F.lit(table).alias("table_name"), "test", "column", "failures", "severity",
                      F.when(F.col("failures") == 0, "pass").otherwise(
                          F.when(F.col("severity") == "warn", "warn").otherwise("fail")).alias("status"))


def check_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str,
                       table: str = "table", severity: str = "error") -> DataFrame:
    """K113 ``relationships``: child keys (non-NULL) missing from the parent, as a left anti join."""
    missing = child.filter(F.col(col).isNotNull()).select(col).join(
        parent.select(F.col(parent_col).alias(col)).distinct(), col, "left_anti")
    return missing.agg(F.count("*").cast("long").alias("failures")).select(
        F.lit(table).alias("table_name"), F.lit("relationships").alias("test"), F.lit(col).alias("column"),
        "failures", F.lit(severity).alias("severity"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def reconcile(result: DataFrame, source: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """K112: totals per key from the result and from the source side by side, with differences.

    A full outer join on the key (keys present on one side only show up) instead of the
    reference's join on rank positions."""
    r = result.groupBy(*keys).agg(*[F.sum(m).alias(f"result_{m}") for m in measures])
    s = source.groupBy(*keys).agg(*[F.sum(m).alias(f"source_{m}") for m in measures])
    j = r.join(s, list(keys), "full")
    for m in measures:
        j = j.withColumn(f"diff_{m}", F.coalesce(F.col(f"result_{m}"), F.lit(0.0))
                         - F.coalesce(F.col(f"source_{m}"), F.lit(0.0)))
    return j
