"""Cohort revenue by windows and its projection: several measures at once, by channel, with spend and signups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthframe.functions.semantics import div0

#: What is added up per cohort and rank.
MEASURES = ("cohort_size", "paid_transactions", "gross", "cost", "n_gross", "n_cost")


def month_rank(start: Column, d: Column, windows: int) -> Column:
    """The smallest w from 1 with ``d`` on or before w months after ``start`` (clamped to the month's end); ``windows`` + 1 beyond."""
    guess = F.greatest(F.lit(1), F.ceil(F.months_between(d, start)).cast("int"))
    # months_between counts month ends as whole months: correct the guess by one where it disagrees with the clamped date
    low = F.when((guess > 1) & (d <= F.add_months(start, guess - 1)), guess - 1).when(d > F.add_months(start, guess), guess + 1).otherwise(guess)
    return F.least(low, F.lit(windows + 1))


def window_measures(facts: DataFrame, keys: Sequence[str], entity: str, signup: str, event: str, scope: str, amount: str, windows: int = 12) -> DataFrame:
    """Per cohort (``keys`` and signup day) and window (1 to ``windows`` months after signup, and the lifetime: NULL) the entities
    that had revenue, paid transactions, gross revenue and cost.

    One aggregate over the facts, by entity and month rank; from it one row per cohort with at most ``windows`` + 1 ranks, on which
    all windows of all measures are running sums at once (a triangle, never a row times its windows). An entity counts from
    its first revenue on, so distinct counts are running sums too. Scope ``prestation`` is revenue, ``cost`` is cost; events before
    the signup don't count. Amounts should be decimals: their sums don't depend on the order."""
    x = facts.filter((F.col(event) >= F.col(signup)) & F.col(scope).isin("prestation", "cost"))
    x = x.withColumn("_rank", month_rank(F.col(signup), F.col(event), windows))
    sold, v = F.col(scope) == "prestation", F.col(amount)
    per = x.groupBy(*keys, signup, entity, "_rank").agg(
        F.count_if(sold & (v != 0)).alias("paid_transactions"), F.sum(F.when(sold, v)).alias("gross"), F.sum(F.when(~sold, v)).alias("cost"),
        F.count_if(sold & v.isNotNull()).alias("n_gross"), F.count_if(~sold & v.isNotNull()).alias("n_cost"), F.count_if(sold).alias("_sold"))
    # an entity has windows + 1 rows at most
    first = F.min(F.when(F.col("_sold") > 0, F.col("_rank"))).over(Window.partitionBy(*keys, signup, entity))
    per = per.withColumn("cohort_size", (F.col("_rank") == first).cast("long"))
    ranks = per.groupBy(*keys, signup, "_rank").agg(*[F.sum(m).alias(m) for m in MEASURES])
    tri = ranks.groupBy(*keys, signup).agg(F.collect_list(F.struct("_rank", *MEASURES)).alias("_r"))
    each = F.concat(F.sequence(F.lit(1), F.lit(windows)), F.array(F.lit(None).cast("int")))
    tri = tri.select(*keys, signup, "_r", F.explode(each).alias("window_months"))

    def upto(m: str, kind: str) -> Column:
        return F.expr(f"aggregate(filter(_r, r -> window_months IS NULL OR r._rank <= window_months), cast(0 AS {kind}), (a, r) -> cast(a + coalesce(r.{m}, 0) AS {kind}))").alias(m)

    kinds = {f.name: f.dataType.simpleString() for f in ranks.schema.fields}
    out = tri.select(*keys, signup, "window_months", *[upto(m, kinds[m]) for m in MEASURES])
    # an empty sum is NULL, as in SQL
    return out.select(*keys, signup, "window_months", "cohort_size", "paid_transactions", F.when(F.col("n_gross") > 0, F.col("gross")).alias("gross"),
                      F.when(F.col("n_cost") > 0, F.col("cost")).alias("cost")).filter("cohort_size > 0 OR paid_transactions > 0 OR gross IS NOT NULL OR cost IS NOT NULL")


def revenue_and_spend(measures: DataFrame, spend: DataFrame, signups: DataFrame, keys: Sequence[str], signup: str, as_of, windows: int = 12) -> DataFrame:
    """The measures with advertising spend (``spend``: keys without plans, d, amount) and new signups (``signups``: keys, entity, day) of
    the last month before ``as_of``, which stand under every window. Zero counts and sums as NULL; net revenue needs both gross and
    cost. ``date`` is the signup or spending day."""
    to = F.lit(as_of).cast("date")
    recent = lambda c: F.col(c).between(F.add_months(to, -1), to)
    each = F.explode(F.sequence(F.lit(1), F.lit(windows))).alias("window_months")
    ads = spend.filter(recent("d")).groupBy(*[c for c in keys if c in spend.columns], F.col("d").alias("date")).agg(F.sum("amount").alias("spend")).select("*", each)
    new = signups.groupBy(*keys, F.col(signup).alias("date")).agg(F.countDistinct("entity").alias("new_signups")).filter(recent("date")).select("*", each)
    u = measures.withColumnRenamed(signup, "date").unionByName(ads, allowMissingColumns=True).unionByName(new, allowMissingColumns=True)
    nz = lambda c: F.when(F.sum(c) != 0, F.sum(c)).alias(c)
    g = u.groupBy(*keys, "date", "window_months").agg(nz("spend"), nz("new_signups"), nz("cohort_size"), nz("paid_transactions"), nz("gross"), nz("cost"))
    g = g.filter("coalesce(spend, new_signups, cohort_size, paid_transactions, gross, cost) IS NOT NULL")
    return g.select(*keys, "date", "window_months", "spend", "new_signups", "cohort_size", "paid_transactions", F.col("gross").alias("gross_revenues"), (F.col("gross") - F.col("cost")).alias("net_revenues"))


def project_revenues(rows: DataFrame, keys: Sequence[str], by: Sequence[str], as_of, windows: int = 12) -> DataFrame:
    """What the signups of the last month are worth m months ahead, per future month and ``by`` (source, channel).

    Future month m rests on the cohorts that are m to 2m months old: a band of the (day, window) rows, taken by one
    filter and one aggregate for all months. Per combination of ``keys`` the revenue per head of that band is multiplied by the new
    signups; combinations are added up. Rows with spend or signups are in every band. A band without heads gives NULL, heads without
    revenue 0; results of 0 are NULL, as in the reference."""
    to, m = F.lit(as_of).cast("date"), F.col("window_months")
    band = F.col("date").between(F.add_months(to, -2 * m), F.add_months(to, -m)) | F.col("spend").isNotNull() | F.col("new_signups").isNotNull()
    g = rows.filter(m.isNotNull() & (m <= windows) & band).groupBy(*keys, "window_months").agg(
        *[F.sum(c).alias(c) for c in ("spend", "new_signups", "cohort_size", "gross_revenues", "net_revenues")])
    head = lambda c: div0(F.col(c).cast("double"), F.col("cohort_size").cast("double"))
    g = g.withColumn("_g", F.when(F.col("cohort_size").isNotNull(), head("gross_revenues"))).withColumn("_n", F.when(F.col("cohort_size").isNotNull(), head("net_revenues")))
    r5 = lambda c: F.nullif(F.round(c, 5), F.lit(0.0))
    nz = lambda c: F.when(F.sum(c) != 0, F.sum(c)).alias(c)
    out = g.groupBy(*by, "window_months").agg(nz("spend"), nz("new_signups"), r5(F.sum(F.col("new_signups") * F.col("_g"))).alias("gross_revenues"),
                                              r5(F.sum(F.col("new_signups") * F.col("_n"))).alias("net_revenues"), r5(F.avg("_g")).alias("gross_ltv"), r5(F.avg("_n")).alias("net_ltv"))
    return out.withColumn("month", F.add_months(to, m))
