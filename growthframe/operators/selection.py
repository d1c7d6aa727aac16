"""Order statistics by distributed selection: histogram, narrow the bracket, repeat (A17, W16, K48, K49, J19, K103).

No row is sorted and none is sent but as a count. A first histogram has bins whose bounds grow by about one percent, so it
has a bounded number of bins per group (about 260,000) whatever the values; running counts over the bins tell in which bin a rank
lies. Rows of these bins alone are counted in 65,536 equal bins each, and rows of the bins found there by distinct
value. Equal values are one count all along, so a value that a third of all rows hold costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.session import materialize

#: Bins per doubling in the first histogram, and equal bins of a bin of it in the second.
COARSE, FINE = 64, 65536
#: Below this estimated size one task may hold a table: a plain window is used, beyond it selection.
ONE_TASK_BYTES = 16 << 20


def _coarse(v: Column) -> Column:
    """A bin that never falls while the value (a double) rises: NULL, -inf, negative, 0, positive, inf, NaN."""
    far = F.lit(float("inf"))
    size = F.floor(F.log2(F.abs(v)) * COARSE) + 1100 * COARSE  # the least double is 2^-1074
    return (F.when(v.isNull(), F.lit(-(1 << 50))).when(F.isnan(v), F.lit(1 << 50)).when(v == far, F.lit(1 << 40)).when(v == -far, F.lit(-(1 << 40)))
            .when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("long") * size)).cast("long")


def _run(df: DataFrame, keys: Sequence[str], order: str, count: str, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(count).over(w), F.lit(0)))


def order_statistics(df: DataFrame, group: Sequence[str], value: Column | str, ranks: Sequence[tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """``(group..., name, value, before, total)``: per group and wanted rank the value that stands there in ascending order (NULL first,
    NaN last), the number of rows before its first occurrence, and the number of rows of the group.

    ``ranks`` = (name, function from the group's number of rows to a rank from 0). Rows of a NULL group are a group."""
    v = F.col(value) if isinstance(value, str) else value
    g = F.struct(*group) if group else F.struct(F.lit(0).alias("all"))
    x = df.select(g.alias("_g"), v.alias("_v"), v.cast("double").alias("_d")).withColumn("_b", _coarse(F.col("_d")))
    one = x.groupBy("_g", "_b").agg(F.count("*").alias("_c"), F.min("_d").alias("_lo"), F.max("_d").alias("_hi"))
    one = _run(one, ["_g"], "_b", "_c", "_before").withColumn("_total", F.sum("_c").over(Window.partitionBy("_g")))
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), f(F.col("_total")).cast("long").alias("rank")) for n, f in ranks]))
    hit = one.withColumn("_t", wanted).filter("_t.rank >= _before AND _t.rank < _before + _c").drop("_c")
    # the second histogram: equal bins between the least and the greatest value of a bin
    y = x.join(hit.select("_g", "_b", "_lo", "_hi").distinct(), ["_g", "_b"])
    y = y.withColumn("_f", F.coalesce(F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("_d") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (FINE - 1))), F.lit(0)))
    two = _run(y.groupBy("_g", "_b", "_f").agg(F.count("*").alias("_c")), ["_g", "_b"], "_f", "_c", "_more")
    hit = hit.select("_g", "_b", "_t", "_before", "_total").join(two, ["_g", "_b"]).withColumn("_before", F.col("_before") + F.col("_more")) \
        .filter("_t.rank >= _before AND _t.rank < _before + _c").drop("_c", "_more")
    # distinct values of what is left
    z = y.join(hit.select("_g", "_b", "_f").distinct(), ["_g", "_b", "_f"], "left_semi")
    three = _run(z.groupBy("_g", "_b", "_f", "_v").agg(F.count("*").alias("_c")), ["_g", "_b", "_f"], "_v", "_c", "_more")
    hit = hit.join(three, ["_g", "_b", "_f"]).withColumn("_before", F.col("_before") + F.col("_more")).filter("_t.rank >= _before AND _t.rank < _before + _c")
    return hit.select(*[F.col(f"_g.{c}").alias(c) for c in group], F.col("_t.name").alias("name"), F.col("_v").alias("value"), F.col("_before").alias("before"), F.col("_total").alias("total"))


def exact_percentile(df: DataFrame, value: str, quantiles: Sequence[float], group: Sequence[str] = (), prefix: str = "p") -> DataFrame:
    """PERCENTILE_CONT(q) per group, exact, by selection: linear between the two ranks around q x (n - 1); NULL values
    don't count. One row per group with columns ``{prefix}{int(q * 100)}`` (e.g. p50)."""
    def at(q: float, up: bool):
        return lambda total: (F.ceil if up else F.floor)((total - 1) * F.lit(float(q)))

    names = [f"{prefix}{int(round(q * 100))}" for q in quantiles]
    ranks = [(f"{n}_{side}", at(q, side == "hi")) for n, q in zip(names, quantiles) for side in ("lo", "hi")]
    found = order_statistics(df.filter(F.col(value).isNotNull()), group, value, ranks)
    g = found.groupBy(*group).agg(F.first("total").alias("_n"), *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n, _ in ranks])
    out = []
    for n, q in zip(names, quantiles):
        pos = (F.col("_n") - 1) * F.lit(float(q))
        out.append((F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * (pos - F.floor(pos))).alias(n))
    return g.select(*group, *out)


def estimated_bytes(df: DataFrame) -> int:
    """The planner's estimate of a table's size (for Parquet it rests on the size of the files)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def exact_ntile(df: DataFrame, n: int, order: Sequence[Column | str], partition_cols: Sequence[str] = (), name: str = "ntile", distributed: bool | None = None) -> DataFrame:
    """NTILE(n) OVER ([PARTITION BY ...] ORDER BY value, tie), exact. ``order`` = (value, unique tie-breaker), numbers, ascending.

    A table that the planner estimates at ``ONE_TASK_BYTES`` or less is numbered by a plain window; a larger one
    (or with ``distributed``) by selection: the last row of each bucket is found as the value at its rank, then as the
    tie-breaker at its rank among the rows of that value; a row's bucket follows from comparing it with these n - 1 rows. The
    table is written once, as it is read several times, and never sorted."""
    if n == 1:  # no bucket ends before the last row
        return df.withColumn(name, F.lit(1))
    value, tie = (F.col(o) if isinstance(o, str) else o for o in order)
    if distributed is None:
        distributed = estimated_bytes(df) > ONE_TASK_BYTES
    if not distributed:
        return df.withColumn(name, F.ntile(n).over(Window.partitionBy(*partition_cols).orderBy(value, tie)).cast("int"))
    cols = df.columns
    x = materialize(df.withColumn("_val", value).withColumn("_tie", tie))

    def last(i: int):  # the last row of bucket i: the first total % n buckets hold one row more
        return lambda total: i * F.floor(total / n) + F.least(F.lit(i), total % n) - 1

    edges = order_statistics(x, partition_cols, "_val", [(str(i), last(i)) for i in range(1, n)])
    edges = edges.withColumn("i", F.col("name").cast("int"))
    rank = F.lit(0)
    for i in range(1, n):
        rank = F.when(F.col("i") == i, last(i)(F.col("total"))).otherwise(rank)
    edges = edges.select(F.struct(*partition_cols, "value").alias("_e") if partition_cols else F.struct("value").alias("_e"), "i", (rank - F.col("before")).alias("rank"))
    edges = materialize(edges)
    # among rows of an edge's value: the tie-breaker at that rank (the same selection, a group per edge)
    same = x.withColumn("_e", F.struct(*partition_cols, F.col("_val").alias("value"))).join(edges, "_e").select("_e", "i", "rank", "_tie")
    ties = order_statistics(same, ["_e", "i", "rank"], "_tie", [(str(0), lambda total: F.col("_g.rank"))])
    limits = ties.select(*[F.col(f"_e.{c}").alias(c) for c in partition_cols], F.struct(F.col("_e.value").alias("v"), F.col("value").alias("t")).alias("edge"))
    limits = limits.groupBy(*partition_cols).agg(F.collect_list("edge").alias("_edges"))
    row = F.struct(F.col("_val").alias("v"), F.col("_tie").alias("t"))
    if partition_cols:
        keyed = limits.select(F.struct(*partition_cols).alias("_k"), "_edges")
        x = x.withColumn("_k", F.struct(*partition_cols)).join(keyed, "_k", "left")
    else:
        x = x.withColumn("_edges", limits.select("_edges").scalar())
    bucket = 1 + F.size(F.filter("_edges", lambda e: row > e))
    return x.select(*cols, bucket.cast("int").alias(name))
