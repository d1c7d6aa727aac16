"""Acquisition indicators in full: every indicator under every attribution model, by breakdowns that add up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthframe.functions.semantics import least_strict

# Measure -> the date on which it counts. "Creation to accounting" counts on the invoicing date.
ACTUAL_DATE = {
    "leads": "lead", "mqls": "mql", "opportunities": "opportunity", "signups_invoicing": "signup_invoicing", "clients_invoicing": "won_invoicing",
    "clients_creation": "won_creation", "clients_accounting": "won_accounting", "clients_direct_accounting": "won_accounting",
    "clients_invoicing_to_accounting": "won_accounting", "clients_crea_to_accounting": "won_invoicing", "losts": "lost", "reactivations": "reactivation",
}
# Measure -> the dates by which its cohorts are formed.
COHORT_DATES = {
    "leads": ["lead"], "mqls": ["lead", "signup_invoicing", "mql"], "opportunities": ["mql", "opportunity"], "signups_invoicing": ["signup_invoicing"],
    "clients_invoicing": ["lead", "mql", "won_invoicing"], "clients_creation": ["lead", "mql", "opportunity", "won_creation"],
    "clients_accounting": ["lead", "mql", "won_accounting"], "clients_direct_accounting": ["lead", "mql", "won_accounting"],
    "clients_invoicing_to_accounting": ["lead", "signup_invoicing", "mql", "won_accounting"],
    "clients_crea_to_accounting": ["lead", "mql", "won_creation", "won_accounting"], "losts": ["lead", "lost"], "reactivations": ["reactivation"],
}
#: The stages a contact may reach, as columns ``date_<stage>``.
STAGES = ("lead", "mql", "opportunity", "signup_invoicing", "won_invoicing", "won_creation", "won_accounting", "lost")


def _date(stage: str) -> Column:
    if stage == "reactivation":  # the earliest win, known only once all three are
        return least_strict("date_won_invoicing", "date_won_creation", "date_won_accounting")
    return F.col(f"date_{stage}")


def _counts(measure: str) -> Column:
    """Whether a contact counts for a measure at all."""
    accounting = F.col("date_won_accounting")
    later = lambda c: F.col(c).isNull() | (F.col(c) > accounting)
    if measure == "clients_direct_accounting":
        return accounting.isNotNull() & later("date_won_invoicing") & later("date_won_creation")
    if measure == "clients_invoicing_to_accounting":
        return (F.col("date_won_invoicing") <= accounting) & later("date_won_creation")
    if measure == "clients_crea_to_accounting":
        return F.col("date_won_creation") <= accounting
    if measure == "reactivations":
        return F.col("date_lost") < _date("reactivation")
    return F.col(f"date_{ACTUAL_DATE[measure]}").isNotNull()


def linear_shares(touches: DataFrame, contact: str, until: Column | Mapping[str, Column], source: str = "source_name", channel: str = "channel", name: str = "shares") -> DataFrame:
    """Per contact the touches on or before a stage as shares: ``array<struct<source_name, channel, parts, whole>>``, where a
    (source, channel) has ``parts`` of ``whole`` touches. A share is kept as a fraction: shares of a contact add up to one exactly.

    ``until`` may name several stages: then there is one column of shares for each, from the same pass over the touches (NULL
    where the contact has none of that stage)."""
    stages = dict(until) if isinstance(until, Mapping) else {name: until}
    numbered = {f"_n{i}": n for i, n in enumerate(stages)}
    known = F.col(contact).isNotNull() & reduce(lambda a, b: a | b, [F.coalesce(u, F.lit(False)) for u in stages.values()])
    t = touches.filter(known).groupBy(contact, source, channel).agg(*[F.count_if(stages[n]).alias(c) for c, n in numbered.items()])
    part = F.struct(F.col(source).alias("source_name"), F.col(channel).alias("channel"), *numbered)
    t = t.groupBy(contact).agg(F.collect_list(part).alias("_parts"), *[F.sum(c).alias(f"_all{c}") for c in numbered])

    def shares(c: str) -> Column:
        of = F.transform(F.filter("_parts", lambda p: p[c] > 0), lambda p: F.struct(p["source_name"].alias("source_name"), p["channel"].alias("channel"),
                                                                                  p[c].alias("parts"), F.col(f"_all{c}").alias("whole")))
        return F.when(F.col(f"_all{c}") > 0, of)

    return t.select(contact, *[shares(c).alias(n) for c, n in numbered.items()])


def single_share(source: Column, channel: Column) -> Column:
    """The shares of a model that gives everything to one touch (also where there is none)."""
    return F.array(F.struct(source.alias("source_name"), channel.alias("channel"), F.lit(1).cast("long").alias("parts"), F.lit(1).cast("long").alias("whole")))


def _of_model(number: int, m: str) -> Column:
    return F.transform(F.coalesce(F.col(m), F.array().cast(_SHARES)), lambda s: F.struct(F.lit(number).alias("model"), s.alias("s")))


def acquisition_indicators(contacts: DataFrame, models: Sequence[str], breakdowns: Sequence[Sequence[str]]) -> DataFrame:
    """The 31 indicators under each model, by cohort date and date of the event, for each breakdown.

    ``contacts`` has one row per contact with ``date_<stage>`` for every one of ``STAGES``, a column of shares (`linear_shares`,
    `single_share`) named after each model, and the columns of the ``breakdowns`` (``source_name`` and ``channel`` come from
    the model). A contact gives one small struct for each indicator that it counts for, never a row for one that it doesn't, and
    these meet the model's shares: a single pass over the contacts. They are first added up over all columns together,
    as whole numbers per denominator; the breakdowns are ``GROUPING SETS`` over that table, so that each adds up to the
    total. Until the end indicators and models are numbers, and columns that no breakdown has are left out, so that the tables of
    the aggregates are small. ``breakdown`` names the columns of a row's set; columns outside it are NULL. Contacts without a
    cohort date count under a NULL date."""
    pairs = [(m, c) for m, cohorts in COHORT_DATES.items() for c in cohorts]
    entries = [F.when(_counts(m), F.struct(F.lit(i).alias("indicator"), _date(c).alias("date_cohort"), _date(ACTUAL_DATE[m]).alias("date_actual")))
               for i, (m, c) in enumerate(pairs, 1)]
    shares = F.flatten(F.array(*[_of_model(i, m) for i, m in enumerate(models, 1)]))
    wanted = {c for b in breakdowns for c in b}
    attributes = sorted(wanted - {"source_name", "channel"})
    x = contacts.select(*attributes, F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("i"), shares.alias("m"))
    x = x.select(*attributes, "i.*", F.explode("m").alias("m")).select(
        *attributes, "indicator", "date_cohort", "date_actual", "m.model", F.col("m.s.source_name").alias("source_name"), F.col("m.s.channel").alias("channel"),
        F.col("m.s.parts").alias("parts"), F.col("m.s.whole").alias("whole"))
    base = ["indicator", "model", "date_cohort", "date_actual"]
    columns = [*attributes, *[c for c in ("source_name", "channel") if c in wanted]]
    fine = x.groupBy(*base, *columns, "whole").agg(F.sum("parts").alias("parts"))
    sets = [[*base, *b, "whole"] for b in breakdowns]
    g = fine.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in (*base, *columns, "whole")]).agg(
        F.sum("parts").alias("parts"), *[F.grouping(c).alias(f"_out_{c}") for c in columns])
    named = F.concat_ws(", ", *[F.when(F.col(f"_out_{c}") == 0, c) for c in columns])
    g = g.withColumn("breakdown", F.when(reduce(lambda a, b: a & b, [F.col(f"_out_{c}") == 1 for c in columns], F.lit(True)), "total").otherwise(named))
    # fractions of equal denominator are whole numbers; what is left to add has one term for each denominator, in order
    each = F.array_sort(F.collect_list(F.struct("whole", "parts")))
    g = g.groupBy("breakdown", *base, *columns).agg(each.alias("_f"))
    names = {"indicator": [f"{m}_by_{c}_date" for m, c in pairs], "model": models}
    named = [F.element_at(F.array(*[F.lit(n) for n in of]), F.col(k)).alias(k) for k, of in names.items()]
    source = [F.col(c) if c in wanted else F.lit(None).cast("string").alias(c) for c in ("source_name", "channel")]
    value = F.aggregate("_f", F.lit(0.0), lambda a, f: a + f["parts"] / f["whole"])
    return g.select("breakdown", *named, "date_cohort", "date_actual", *attributes, *source, value.alias("value"))


_SHARES = "array<struct<source_name: string, channel: string, parts: bigint, whole: bigint>>"
