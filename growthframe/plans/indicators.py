"""Paired queries for the full indicator matrix.

Stand-ins: a contact = ``user_id * 10 + event_id % 10``; its stages are the first events of a kind (by type, ``value`` and
``k``); a touch = any event, with source and channel by ``k``; gender, age range and legal form by the user.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from growthframe.operators import indicators as IN
from growthframe.plans.registry import paired
from growthframe.sources.tables import load

_CONTACT_SQL = """
WITH e AS (SELECT user_id * 10 + event_id % 10 AS contact, user_id, event_id, ts, CAST(ts AS DATE) AS d, event_type AS t, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
e2 AS (SELECT *, 's' || CAST(k % 4 AS VARCHAR) AS source_name, 'c' || CAST(k % 3 AS VARCHAR) AS channel FROM e),
st AS (SELECT contact, CASE WHEN any_value(user_id) % 3 = 0 THEN NULL ELSE 'g' || CAST(any_value(user_id) % 3 AS VARCHAR) END AS gender, 'a' || CAST(any_value(user_id) % 5 AS VARCHAR) AS age_range,
  MIN(CASE WHEN t = 'signup' THEN d END) AS lead, MIN(CASE WHEN t = 'purchase' THEN d END) AS mql, MIN(CASE WHEN t = 'purchase' AND value > 100 THEN d END) AS opp,
  MIN(CASE WHEN t = 'click' AND k % 5 < 3 THEN d END) AS sign, MIN(CASE WHEN t = 'click' AND k % 2 = 0 THEN d END) AS inv, MIN(CASE WHEN t = 'view' AND k % 3 > 0 THEN d END) AS cre,
  MIN(CASE WHEN t = 'purchase' AND value > 200 THEN d END) AS acc, MIN(CASE WHEN t = 'error' THEN d END) AS lost FROM e GROUP BY 1),
c AS (SELECT *, CASE WHEN inv IS NOT NULL AND cre IS NOT NULL AND acc IS NOT NULL THEN least(inv, cre, acc) END AS rea FROM st)"""

# The 31 indicators written out: name, cohort date, date of the event, condition.
_INDICATORS = [
    ("leads_by_lead_date", "lead", "lead", "lead IS NOT NULL"),
    ("mqls_by_lead_date", "lead", "mql", "mql IS NOT NULL"),
    ("mqls_by_signup_invoicing_date", "sign", "mql", "mql IS NOT NULL"),
    ("mqls_by_mql_date", "mql", "mql", "mql IS NOT NULL"),
    ("opportunities_by_mql_date", "mql", "opp", "opp IS NOT NULL"),
    ("opportunities_by_opportunity_date", "opp", "opp", "opp IS NOT NULL"),
    ("signups_invoicing_by_signup_invoicing_date", "sign", "sign", "sign IS NOT NULL"),
    ("clients_invoicing_by_lead_date", "lead", "inv", "inv IS NOT NULL"),
    ("clients_invoicing_by_mql_date", "mql", "inv", "inv IS NOT NULL"),
    ("clients_invoicing_by_won_invoicing_date", "inv", "inv", "inv IS NOT NULL"),
    ("clients_creation_by_lead_date", "lead", "cre", "cre IS NOT NULL"),
    ("clients_creation_by_mql_date", "mql", "cre", "cre IS NOT NULL"),
    ("clients_creation_by_opportunity_date", "opp", "cre", "cre IS NOT NULL"),
    ("clients_creation_by_won_creation_date", "cre", "cre", "cre IS NOT NULL"),
    ("clients_accounting_by_lead_date", "lead", "acc", "acc IS NOT NULL"),
    ("clients_accounting_by_mql_date", "mql", "acc", "acc IS NOT NULL"),
    ("clients_accounting_by_won_accounting_date", "acc", "acc", "acc IS NOT NULL"),
    ("clients_direct_accounting_by_lead_date", "lead", "acc", "acc IS NOT NULL AND coalesce(inv > acc, true) AND coalesce(cre > acc, true)"),
    ("clients_direct_accounting_by_mql_date", "mql", "acc", "acc IS NOT NULL AND coalesce(inv > acc, true) AND coalesce(cre > acc, true)"),
    ("clients_direct_accounting_by_won_accounting_date", "acc", "acc", "acc IS NOT NULL AND coalesce(inv > acc, true) AND coalesce(cre > acc, true)"),
    ("clients_invoicing_to_accounting_by_lead_date", "lead", "acc", "inv <= acc AND coalesce(cre > acc, true)"),
    ("clients_invoicing_to_accounting_by_signup_invoicing_date", "sign", "acc", "inv <= acc AND coalesce(cre > acc, true)"),
    ("clients_invoicing_to_accounting_by_mql_date", "mql", "acc", "inv <= acc AND coalesce(cre > acc, true)"),
    ("clients_invoicing_to_accounting_by_won_accounting_date", "acc", "acc", "inv <= acc AND coalesce(cre > acc, true)"),
    ("clients_crea_to_accounting_by_lead_date", "lead", "inv", "cre <= acc"),
    ("clients_crea_to_accounting_by_mql_date", "mql", "inv", "cre <= acc"),
    ("clients_crea_to_accounting_by_won_creation_date", "cre", "inv", "cre <= acc"),
    ("clients_crea_to_accounting_by_won_accounting_date", "acc", "inv", "cre <= acc"),
    ("losts_by_lead_date", "lead", "lost", "lost IS NOT NULL"),
    ("losts_by_lost_date", "lost", "lost", "lost IS NOT NULL"),
    ("reactivations_by_reactivation_date", "rea", "rea", "lost < rea"),
]
_MATRIX_SQL = ", ind AS (" + " UNION ALL ".join(f"SELECT contact, '{n}' AS indicator, {a} AS date_cohort, {b} AS date_actual FROM c WHERE {w}" for n, a, b, w in _INDICATORS) + ")"

_STAGES = {"lead": ("signup", None), "mql": ("purchase", None), "opportunity": ("purchase", "value > 100"), "signup_invoicing": ("click", "k % 5 < 3"),
           "won_invoicing": ("click", "k % 2 = 0"), "won_creation": ("view", "k % 3 > 0"), "won_accounting": ("purchase", "value > 200"), "lost": ("error", None)}


def _events(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    e = load(spark, sf, "events").withColumn("k", k)
    return e.select((F.col("user_id") * 10 + F.col("event_id") % 10).alias("contact"), "user_id", "event_id", "ts", F.to_date("ts").alias("d"), "event_type", "value", "k",
                    F.concat(F.lit("s"), (F.col("k") % 4).cast("string")).alias("source_name"), F.concat(F.lit("c"), (F.col("k") % 3).cast("string")).alias("channel"))


def _contacts(e):
    first = [F.min(F.when((F.col("event_type") == t) & (F.expr(more) if more else F.lit(True)), F.col("d"))).alias(f"date_{s}") for s, (t, more) in _STAGES.items()]
    u = F.any_value("user_id")
    return e.groupBy("contact").agg(u.alias("u"), *first).withColumn("gender", F.when(F.col("u") % 3 != 0, F.concat(F.lit("g"), (F.col("u") % 3).cast("string")))) \
        .withColumn("age_range", F.concat(F.lit("a"), (F.col("u") % 5).cast("string"))).drop("u")


_MODELS = ["first_touch", "first_form", "lead_last_touch", "mql_last_touch"]


@paired("k28_indicators_by_model", _CONTACT_SQL + _MATRIX_SQL + """
, pick AS (SELECT c.contact, arg_min(struct_pack(s := source_name, c := channel), (ts, event_id)) AS first_touch,
  arg_min(struct_pack(s := source_name, c := channel), CASE WHEN t = 'signup' THEN (ts, event_id) END) AS first_form,
  arg_max(struct_pack(s := source_name, c := channel), CASE WHEN d <= c.lead THEN (ts, event_id) END) AS lead_last_touch,
  arg_max(struct_pack(s := source_name, c := channel), CASE WHEN d <= c.mql THEN (ts, event_id) END) AS mql_last_touch
  FROM e2 JOIN c USING (contact) GROUP BY 1),
m AS (SELECT ind.*, c.gender, c.age_range, 'first_touch' AS model, p.first_touch.s AS source_name, p.first_touch.c AS channel FROM ind JOIN c USING (contact) JOIN pick p USING (contact)
      UNION ALL SELECT ind.*, c.gender, c.age_range, 'first_form', p.first_form.s, p.first_form.c FROM ind JOIN c USING (contact) JOIN pick p USING (contact)
      UNION ALL SELECT ind.*, c.gender, c.age_range, 'lead_last_touch', p.lead_last_touch.s, p.lead_last_touch.c FROM ind JOIN c USING (contact) JOIN pick p USING (contact)
      UNION ALL SELECT ind.*, c.gender, c.age_range, 'mql_last_touch', p.mql_last_touch.s, p.mql_last_touch.c FROM ind JOIN c USING (contact) JOIN pick p USING (contact))
SELECT 'total' AS breakdown, indicator, model, date_cohort, date_actual, CAST(NULL AS VARCHAR) AS age_range, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS source_name,
  CAST(NULL AS VARCHAR) AS channel, CAST(COUNT(*) AS DOUBLE) AS value FROM m GROUP BY ALL
UNION ALL SELECT 'gender', indicator, model, date_cohort, date_actual, NULL, gender, NULL, NULL, COUNT(*) FROM m GROUP BY ALL
UNION ALL SELECT 'age_range, gender', indicator, model, date_cohort, date_actual, age_range, gender, NULL, NULL, COUNT(*) FROM m GROUP BY ALL
UNION ALL SELECT 'source_name, channel', indicator, model, date_cohort, date_actual, NULL, NULL, source_name, channel, COUNT(*) FROM m GROUP BY ALL
""", covers=("K28", "M27", "J12", "M1"))
def k28_by_model(spark, sf):
    e = _events(spark, sf)
    c = _contacts(e)
    at, touch = F.struct("ts", "event_id"), F.struct("source_name", "channel")
    t = e.join(c.select("contact", "date_lead", "date_mql"), "contact")
    pick = t.groupBy("contact").agg(F.min_by(touch, at).alias("a"), F.min_by(touch, F.when(F.col("event_type") == "signup", at)).alias("b"),
                                    F.max_by(touch, F.when(F.col("d") <= F.col("date_lead"), at)).alias("c"), F.max_by(touch, F.when(F.col("d") <= F.col("date_mql"), at)).alias("d"))
    pick = pick.select("contact", *[IN.single_share(F.col(f"{x}.source_name"), F.col(f"{x}.channel")).alias(m) for x, m in zip("abcd", _MODELS)])
    return IN.acquisition_indicators(c.join(pick, "contact"), _MODELS, [[], ["gender"], ["age_range", "gender"], ["source_name", "channel"]])


@paired("k28_indicators_linear", _CONTACT_SQL + _MATRIX_SQL + """
, touch AS (SELECT 'lead_linear' AS model, e2.contact, e2.source_name, e2.channel, COUNT(*) OVER (PARTITION BY e2.contact) AS n FROM e2 JOIN c USING (contact) WHERE e2.d <= c.lead
            UNION ALL SELECT 'mql_linear', e2.contact, e2.source_name, e2.channel, COUNT(*) OVER (PARTITION BY e2.contact) FROM e2 JOIN c USING (contact) WHERE e2.d <= c.mql),
m AS (SELECT indicator, model, date_cohort, date_actual, channel, CAST(1 AS DECIMAL(38, 15)) / n AS w FROM ind JOIN touch USING (contact))
SELECT 'total' AS breakdown, indicator, model, date_cohort, date_actual, CAST(NULL AS VARCHAR) AS channel, ROUND(SUM(w), 6)::DOUBLE AS value FROM m GROUP BY ALL
UNION ALL SELECT 'channel', indicator, model, date_cohort, date_actual, channel, ROUND(SUM(w), 6)::DOUBLE FROM m GROUP BY ALL
""", covers=("K28", "K24"))
def k28_linear(spark, sf):
    e = _events(spark, sf)
    c = _contacts(e)
    t = e.join(c.select("contact", "date_lead", "date_mql"), "contact")
    shares = IN.linear_shares(t, "contact", {f"{stage}_linear": F.col("d") <= F.col(f"date_{stage}") for stage in ("lead", "mql")})
    c = c.join(shares, "contact", "left")
    out = IN.acquisition_indicators(c, ["lead_linear", "mql_linear"], [[], ["channel"]])
    return out.drop("source_name").withColumn("value", F.round("value", 6))
