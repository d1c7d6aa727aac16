"""Traffic sources, channel grouping, touchpoints and attribution.

Attribution models are computed with per-contact aggregates (``min_by`` / ``max_by``,
combinable map-side) joined back to the touches, instead of one window per model: a contact
with a huge number of touches costs one partial aggregate, not one sorted task per model.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthframe.functions.semantics import least_strict
from growthframe.operators.distinct import id_bitmaps, union_counts

# ----------------------------------------------------------------------------- K7
# Ordered channel-grouping rules, first match wins. Each rule is
# (source condition, medium condition, label). Conditions: None (any), ("eq", v),
# ("in", [...]), ("like", pattern), ("like_any", [...]), ("in_or_like", [...], pattern),
# ("ref",) = a partner referral id is present.
_PAID = ["ads", "cpc", "ppc", "retargeting", "cpm"]
SOURCE_NAME_RULES = [
    (("in", ["partner", "partenariat"]), None, "Partenariat"),
    (("in", ["sponsorship", "parrainage"]), None, "Parrainage"),
    (("ref",), None, "Parrainage"),
    (("like", "%adwords%"), None, "Google Ads"),
    (("eq", "google"), ("in", _PAID + ["paid"]), "Google Ads"),
    (("eq", "google"), ("eq", "organic"), "Google Organic"),
    (("eq", "youtube"), None, "YouTube"),
    (("eq", "linkedin"), ("in_or_like", _PAID, "%paid%"), "Linkedin Ads"),
    (("like", "%linkedin%"), ("eq", "organic"), "Linkedin Organic"),
    (("eq", "tiktok"), ("in", _PAID), "TikTok Ads"),
    (("like", "%tiktok%"), ("in", ["organic", "social"]), "TikTok Organic"),
    (("like", "%paid%"), ("like", "%facebook%"), "Meta Ads"),
    (("like", "%facebook%"), ("like", "%ads%"), "Meta Ads"),
    (("in", ["facebook", "meta", "instagram"]), ("in_or_like", _PAID, "%paid%"), "Meta Ads"),
    (("eq", "facebook"), ("eq", "social"), "Facebook Organic"),
    (("in", ["instagram", "ig"]), ("eq", "social"), "Instagram Organic"),
    (("eq", "bing"), ("in", _PAID + ["paid", ""]), "Bing Ads"),
    (("eq", "bing"), ("eq", "organic"), "Bing Organic"),
    (("eq", "affiliation"), None, "Affiliation"),
    (("like_any", ["%adyen%", "%ogone%", "%getalma%", "%klarna%"]), None, "Payment Service Provider"),
    (("eq", "onsite"), None, "Onsite banner"),
    (("eq", "gmb"), None, "GMB"),
    (("like", "%hillspet%"), None, "Criteo"),
    (("like", "%qwant%"), ("eq", "referral"), "Qwant Search"),
    (("like", "%bing%"), ("eq", "referral"), "Bing Search"),
    (("like", "%google%"), ("eq", "referral"), "Google Search"),
    (("like", "%yahoo%"), ("eq", "referral"), "Yahoo Search"),
    (("like", "%yahoo%"), ("eq", "organic"), "Yahoo Organic"),
    (("like", "%duckduckgo%"), ("eq", "referral"), "Duckduckgo Search"),
    (("like", "%duckduckgo%"), ("eq", "organic"), "Duckduckgo Organic"),
    (("like", "%ecosia%"), ("eq", "referral"), "Ecosia Search"),
    (("like", "%ecosia%"), ("eq", "organic"), "Ecosia Organic"),
    (("like", "%baidu%"), ("eq", "organic"), "Baidu Organic"),
    (("like", "%brave%"), ("eq", "referral"), "Brave Search"),
    (None, ("eq", "organic"), "SEO"),
    (("like", "%twitch%"), ("eq", "social"), "Twitch Organic"),
    (("like", "%twitter%"), ("eq", "social"), "Twitter Organic"),
    (("like", "%reddit%"), ("eq", "social"), "Reddit Organic"),
    (("like", "%tiktok%"), ("eq", "referral"), "Tiktok Organic"),
    (("like", "%meta%"), ("eq", "referral"), "Facebook Organic"),
    (("like", "%facebook%"), ("eq", "referral"), "Facebook Organic"),
    (("like", "%instagram%"), ("eq", "referral"), "Instagram Organic"),
    (("like", "%snapchat%"), ("eq", "referral"), "Snapchat Organic"),
    (("like", "%pinterest%"), ("eq", "referral"), "Pinterest Organic"),
    (("like", "%twitter%"), ("eq", "referral"), "Twitter Organic"),
    (("like", "%linkedin%"), ("eq", "referral"), "Linkedin Organic"),
    (("like", "%chatgpt%"), None, "AI Referrals"),
    (("like", "%perplexity%"), None, "AI Referrals"),
    (None, ("like", "%referral%"), "Referral Websites"),
    (None, ("like", "%webinar%"), "Webinar"),
    (("eq", "direct"), ("eq", "none"), "Direct"),
    (("eq", "(direct)"), ("eq", "(none)"), "Direct"),
    (("like", "%mail%"), None, "Email"),
    (None, ("like", "%mail%"), "Email"),
    (("eq", "hs_automation"), None, "Email"),
]
CHANNEL_RULES = [
    (("in", ["partner", "partenariat"]), None, "Partenariat"),
    (("in", ["sponsorship", "parrainage"]), None, "Parrainage"),
    (("ref",), None, "Parrainage"),
    (("like", "%adwords%"), None, "Paid Search"),
    (("in", ["google", "bing"]), ("in", _PAID + ["paid"]), "Paid Search"),
    (("eq", "google"), ("eq", "organic"), "SEO"),
    (("eq", "youtube"), ("like", "%paid%"), "Paid Social"),
    (("eq", "youtube"), None, "Organic Social"),
    (("in", ["linkedin", "tiktok", "facebook", "meta", "instagram"]), ("in_or_like", _PAID, "%paid%"), "Paid Social"),
    (("like", "%paid%"), ("like", "%facebook%"), "Paid Social"),
    (("like", "%facebook%"), ("like", "%ads%"), "Paid Social"),
    (("like", "%linkedin%"), ("eq", "organic"), "Organic Social"),
    (("like", "%tiktok%"), ("in", ["organic", "social"]), "Organic Social"),
    (("in", ["facebook", "instagram", "ig"]), ("eq", "social"), "Organic Social"),
    (("eq", "bing"), ("eq", "organic"), "SEO"),
    (("eq", "affiliation"), None, "Affiliation"),
    (("like_any", ["%adyen%", "%ogone%", "%getalma%", "%klarna%"]), None, "Payment Service Provider"),
    (("eq", "onsite"), None, "Onsite banner"),
    (("eq", "gmb"), None, "GMB"),
    (("like", "%hillspet%"), None, "Criteo"),
    (("like", "%qwant%"), ("eq", "referral"), "SEO"),
    (("like", "%bing%"), ("eq", "referral"), "SEO"),
    (("like", "%google%"), ("eq", "referral"), "SEO"),
    (("like", "%yahoo%"), ("eq", "referral"), "SEO"),
    (("like", "%yahoo%"), ("eq", "organic"), "SEO"),
    (("like", "%duckduckgo%"), ("eq", "referral"), "SEO"),
    (("like", "%duckduckgo%"), ("eq", "organic"), "SEO"),
    (("like", "%ecosia%"), ("eq", "referral"), "SEO"),
    (("like", "%ecosia%"), ("eq", "organic"), "SEO"),
    (("like", "%baidu%"), ("eq", "organic"), "SEO"),
    (("like", "%brave%"), ("eq", "referral"), "SEO"),
    (None, ("eq", "organic"), "SEO"),
    (("like", "%twitch%"), ("eq", "social"), "Organic Social"),
    (("like", "%twitter%"), ("eq", "social"), "Organic Social"),
    (("like", "%reddit%"), ("eq", "social"), "Organic Social"),
    (("like", "%tiktok%"), ("eq", "referral"), "Organic Social"),
    (("like", "%meta%"), ("eq", "referral"), "Organic Social"),
    (("like", "%facebook%"), ("eq", "referral"), "Organic Social"),
    (("like", "%instagram%"), ("eq", "referral"), "Organic Social"),
    (("like", "%snapchat%"), ("eq", "referral"), "Organic Social"),
    (("like", "%pinterest%"), ("eq", "referral"), "Organic Social"),
    (("like", "%twitter%"), ("eq", "referral"), "Organic Social"),
    (("like", "%linkedin%"), ("eq", "referral"), "Organic Social"),
    (("like", "%chatgpt%"), None, "AI Referrals"),
    (("like", "%perplexity%"), None, "AI Referrals"),
    (None, ("like", "%referral%"), "Referral Websites"),
    (None, ("like", "%webinar%"), "Webinar"),
    (("eq", "direct"), ("eq", "none"), "Direct"),
    (("eq", "(direct)"), ("eq", "(none)"), "Direct"),
    (("like", "%mail%"), None, "Email"),
    (None, ("like", "%mail%"), "Email"),
    (("eq", "hs_automation"), None, "Email"),
]


def _cond(spec, col: Column, ref: Column | None) -> Column:
    if spec is None:
        return F.lit(True)
    op = spec[0]
    if op == "eq":
        return col == F.lit(spec[1])
    if op == "in":
        return col.isin(list(spec[1]))
    if op == "like":
        return col.like(spec[1])
    if op == "like_any":
        return reduce(lambda a, b: a | b, [col.like(p) for p in spec[1]])
    if op == "in_or_like":
        return col.isin(list(spec[1])) | col.like(spec[2])
    if op == "ref":
        return ref.isNotNull() if ref is not None else F.lit(False)
    raise ValueError(op)


def rule_ladder(rules, source: Column, medium: Column, ref: Column | None = None) -> Column:
    """Compile an ordered rule table into one CASE expression (map-only, no join)."""
    out = None
    for s_spec, m_spec, label in rules:
        cond = _cond(s_spec, source, ref) & _cond(m_spec, medium, ref)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def channel_grouping(df: DataFrame, source: str, medium: str, referral_id: str | None = None) -> DataFrame:
    """K7: source name and channel from (utm_source, utm_medium) by two ordered rule ladders."""
    s, m = F.col(source), F.col(medium)
    ref = F.col(referral_id) if referral_id else None
    return df.withColumn("session_source_name", rule_ladder(SOURCE_NAME_RULES, s, m, ref)) \
        .withColumn("session_channel", rule_ladder(CHANNEL_RULES, s, m, ref))


# ----------------------------------------------------------------------------- K6
# Referrer patterns to (source, medium), first match wins.
REFERRER_RULES = [
    ("%chatgpt.com%", "chatgpt.com", "referral"),
    ("%perplexity.ai%", "perplexity.ai", "referral"),
    ("%gemini.google.com", "gemini.google.com", "referral"),
    ("%claude.ai%", "claude.ai", "referral"),
    ("%google.com%", "google", "organic"),
    ("%bing.com%", "bing", "organic"),
    ("%msn.com%", "msn", "organic"),
    ("%yahoo.com%", "yahoo", "organic"),
    ("%qwant.com%", "qwant", "organic"),
    ("%ecosia.com%", "ecosia", "organic"),
    ("%duckduckgo.com%", "duckduckgo", "organic"),
    ("%brave.com%", "brave", "organic"),
    ("%youtube.com%", "youtube", "social"),
    ("%linkedin.com%", "linkedin", "social"),
    ("%facebook.com%", "facebook", "social"),
    ("%instagram.com%", "instagram", "social"),
    ("%t.co%", "twitter", "social"),
]


def classify_referrer(df: DataFrame, referrer: str, utm_source: str, utm_medium: str,
                      click_id: str | None = None) -> DataFrame:
    """K6: (source, medium) of a touch: click id first, then utm, then referrer patterns."""
    r = F.col(referrer)
    src = F.when(F.col(click_id).isNotNull(), "google") if click_id else None
    med = F.when(F.col(click_id).isNotNull(), "cpc") if click_id else None
    src = (src.when(F.col(utm_source).isNotNull(), F.col(utm_source)) if src is not None
           else F.when(F.col(utm_source).isNotNull(), F.col(utm_source)))
    med = (med.when(F.col(utm_source).isNotNull(), F.col(utm_medium)) if med is not None
           else F.when(F.col(utm_source).isNotNull(), F.col(utm_medium)))
    for pat, s, m in REFERRER_RULES:
        src = src.when(r.like(pat), s)
        med = med.when(r.like(pat), m)
    return df.withColumn("source", src).withColumn("medium", med)


# ----------------------------------------------------------------------------- K4, K5

def utm_cascade(df: DataFrame, origins: Sequence[tuple[str, Sequence[str]]], fields: Sequence[str],
                click_id: str | None = None, click_values: dict | None = None) -> DataFrame:
    """K4: pick ALL utm fields from the first origin (in priority order) whose source is set;
    a click id overrides everything with ``click_values`` and blanks the other fields.

    ``origins`` = [(origin label, [column per field])]. One CASE that selects a struct, then
    expanded: fields never mix origins."""
    pick = None
    for label, cols in origins:
        st = F.struct(F.lit(label).alias("utm_origin"), *[F.col(c).alias(f) for c, f in zip(cols, fields)])
        cond = F.col(cols[0]).isNotNull()
        pick = F.when(cond, st) if pick is None else pick.when(cond, st)
    if click_id:
        cv = click_values or {}
        st = F.struct(F.lit("click_id").alias("utm_origin"),
                      *[F.lit(cv.get(f)).cast("string").alias(f) for f in fields])
        pick = F.when(F.col(click_id).isNotNull(), st).otherwise(pick) if pick is not None else st
    return df.withColumn("_u", pick).select("*", *[F.col(f"_u.{f}").alias(f"resolved_{f}") for f in fields],
                                           F.col("_u.utm_origin").alias("utm_origin")).drop("_u")


def decode_click_id(sessions: DataFrame, clicks: DataFrame, click_col: str, order: Sequence[str],
                    dims: Sequence[str]) -> DataFrame:
    """K5: latest click-stat row per click id (``max_by`` aggregate, combinable map-side)
    joined to the sessions. A session with a click id takes its ad dimensions, also where the click
    is not known (NULL); see :func:`override_by_click`."""
    latest = clicks.groupBy(click_col).agg(
        F.max_by(F.struct(*[F.col(d) for d in dims]), F.struct(*[F.col(o) for o in order])).alias("_c"))
    latest = latest.select(click_col, *[F.col(f"_c.{d}").alias(f"click_{d}") for d in dims])
    return sessions.join(latest, click_col, "left")


def override_by_click(click_col: str, click_dim: str, own: str) -> Column:
    """The ad dimension for sessions with a click id (NULL included), else the session's own field."""
    return F.when(F.col(click_col).isNotNull(), F.col(click_dim)).otherwise(F.col(own))


# ----------------------------------------------------------------------------- K8

_HOOKS = "array<struct<n: int, kind: int, v: string>>"


#: Kinds of hooks: the whole value, its beginning, one of its q-grams, nothing at all (rows of wildcards alone).
_WHOLE, _START, _GRAM, _ANY = 0, 1, 2, 3
#: Letters of a q-gram; shorter literal pieces of a pattern are taken whole.
_Q = 3


def _hook(n: int, kind: int, v: Column) -> Column:
    return F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"), v.alias("v"))


def _pattern_hooks(cols: Sequence[str]) -> Column:
    """The hooks on which a mapping row may hang, any of which a matching key has: one for a pattern without wildcards, else one for a
    pattern that only ends in ``%``, else the q-grams of all literal pieces."""
    low = [F.lower(F.col(c)) for c in cols]
    whole = [F.when(~x.rlike(r"[%_\\\\]"), _hook(n, _WHOLE, x)) for n, x in enumerate(low)]
    start = [F.when(x.rlike(r"^[^%_\\\\]+%$"), _hook(n, _START, F.rtrim(x, F.lit("%")))) for n, x in enumerate(low)]
    grams = []
    for n, x in enumerate(low):
        pieces = F.filter(F.split(F.when(~x.contains("\\"), x), "[%_]"), lambda p: p != "")
        size = F.least(F.lit(_Q), F.array_max(F.transform(pieces, lambda p: F.length(p))))
        long = F.filter(pieces, lambda p: F.length(p) >= size)
        each = F.transform(long, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - size + 1), lambda i: _hook(n, _GRAM, F.substring(p, i, size))))
        grams.append(F.coalesce(F.flatten(each), F.array().cast(_HOOKS)))
    one = F.coalesce(*whole, *start)
    found = F.array_distinct(F.concat(*grams))
    return F.when(one.isNotNull(), F.array(one)).when(F.size(found) > 0, found).otherwise(F.array(_hook(0, _ANY, F.lit(""))))


def _key_hooks(keys: Sequence[str], used: Column) -> Column:
    """All hooks of a fact key of the kinds and sizes that occur in the mapping (``used``): not one for each letter."""
    out = [F.array(_hook(0, _ANY, F.lit("")))]
    for n, f in enumerate(keys):
        x, size = F.lower(F.col(f)), F.length(F.lower(F.col(f)))
        starts = F.transform(F.filter(used, lambda u: (u["n"] == n) & (u["kind"] == _START) & (u["size"] <= size)), lambda u: _hook(n, _START, F.substring(x, F.lit(1), u["size"])))
        grams = F.flatten(F.transform(F.filter(used, lambda u: (u["n"] == n) & (u["kind"] == _GRAM) & (u["size"] <= size)),
                                      lambda u: F.transform(F.sequence(F.lit(1), size - u["size"] + 1), lambda i: _hook(n, _GRAM, F.substring(x, i, u["size"])))))
        out.append(F.coalesce(F.concat(F.array(_hook(n, _WHOLE, x)), starts, F.array_distinct(grams)), F.array().cast(_HOOKS)))
    return F.concat(*out)


def map_patterns(facts: DataFrame, mapping: DataFrame, pattern_cols: Sequence[tuple[str, str]],
                 outputs: Sequence[str], sort_col: str = "sort", mode: str = "best",
                 unmapped: str = "Unmapped") -> DataFrame:
    """K8: LIKE mapping table where a NULL pattern is a wildcard.

    ``pattern_cols`` = [(fact column, mapping pattern column)], matched case-insensitively.
    Only the DISTINCT fact keys are matched, through an inverted index over the patterns: a mapping row hangs on
    one hook (a whole value, a beginning, or else the q-gram of its literal pieces that the fewest keys have), and keys and
    rows meet by equality of hooks; LIKE is only checked on what meets. Only rows of wildcards alone meet every
    key. The result is joined back on the keys.

    ``mode="all"`` keeps every matching mapping row (the reference's behaviour, M11);
    ``mode="best"`` keeps the lowest ``sort`` (most specific) match, of equals the lowest outputs."""
    keys = [f for f, _ in pattern_cols]
    patterns = [p for _, p in pattern_cols]
    k = facts.select(*keys).distinct()
    m = mapping.groupBy(*[c for c in mapping.columns if c in {*patterns, *outputs, sort_col}]).agg(F.count("*").alias("_copies"))
    m = m.withColumn("_hooks", _pattern_hooks(patterns))
    used = m.select(F.explode("_hooks").alias("h")).agg(F.collect_set(F.struct("h.n", "h.kind", F.length("h.v").alias("size")))).scalar()
    hooked = k.withColumn("_used", used).select(*keys, F.explode(_key_hooks(keys, F.col("_used"))).alias("_h"))
    # of several q-grams the one that the fewest keys have; one that none has finds nothing, as it should
    many = m.filter(F.size("_hooks") > 1)
    asked = many.select(F.explode("_hooks").alias("_h")).distinct()
    counted = hooked.join(asked, "_h").groupBy("_h").agg(F.count("*").alias("_n"))
    rare = many.select("*", F.explode("_hooks").alias("_h")).join(counted, "_h", "left")
    row = [c for c in m.columns if c != "_hooks"]
    rare = rare.groupBy(F.struct(*row).alias("_row")).agg(F.min_by("_h", F.struct(F.coalesce("_n", F.lit(0)), "_h")).alias("_h")).select("_row.*", "_h")
    m = m.filter(F.size("_hooks") == 1).select(*row, F.col("_hooks")[0].alias("_h")).unionByName(rare)
    a, b = hooked.alias("k"), m.alias("m")
    cond = reduce(lambda x, y: x & y, [F.col(f"m.{p}").isNull() | F.like(F.lower(F.col(f"k.{f}")), F.lower(F.col(f"m.{p}"))) for f, p in pattern_cols])
    matched = a.join(b, (F.col("k._h") == F.col("m._h")) & cond).select(
        *[F.col(f"k.{f}").alias(f) for f in keys], *[F.col(f"m.{o}").alias(o) for o in outputs], F.col(f"m.{sort_col}").alias("_sort"), F.col("m._copies").alias("_copies"))
    if mode == "best":
        best = matched.groupBy(*keys).agg(F.min_by(F.struct(*outputs), F.struct("_sort", *outputs)).alias("_b"))
        matched = best.select(*keys, *[F.col(f"_b.{o}").alias(o) for o in outputs])
    elif mode == "all":  # equal mapping rows match as often as they stand there
        matched = matched.withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_sort", "_copies")
    else:
        raise ValueError(mode)
    # NULL fact keys are legal (a touch without medium): null-safe equality, still an equi-join
    out = facts.join(matched, [facts[k].eqNullSafe(matched[k]) for k in keys], "left")
    for k in keys:
        out = out.drop(matched[k])
    for o in outputs:
        out = out.withColumn(o, F.coalesce(F.col(o), F.lit(unmapped)))
    return out


# ----------------------------------------------------------------------------- K19-K27

def touchpoints(sources: Sequence[tuple[str, DataFrame]], bridge: DataFrame, visitor: str, contact: str) -> DataFrame:
    """Union of typed touch sources, ids prefixed by type, mapped to contacts through a
    many-to-many visitor -> contact bridge; duplicate (contact, touch) pairs removed.

    Each source has columns: visitor, touch_id, touch_ts, utm_source, utm_medium,
    utm_campaign, referrer."""
    parts = [df.withColumn("web_event_type", F.lit(kind))
             .withColumn("touchpoint_id", F.concat(F.lit(kind + "-"), F.col("touch_id").cast("string")))
             .drop("touch_id") for kind, df in sources]
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    b = bridge.select(visitor, contact).distinct()
    return u.join(b, visitor).drop(visitor).distinct()


def ignore_touchpoints(t: DataFrame, ignored: DataFrame, keys: Sequence[str] = ("utm_source", "utm_medium",
                                                                                 "utm_campaign")) -> DataFrame:
    """Drop touches whose (source, medium, campaign) equals an ignored triple; a NULL on
    either side never matches (plain equality in a left anti join)."""
    cond = reduce(lambda a, b: a & b, [t[k] == ignored[k] for k in keys])
    # an equi-join: AQE broadcasts the ignore list when its measured size is small
    return t.join(ignored, cond, "left_anti")


def _pick(order_first: bool, cols: Sequence[str], cond: Column | None, ts: str, tid: str) -> Column:
    key = F.struct(F.col(ts), F.col(tid))
    if cond is not None:
        key = F.when(cond, key)
    val = F.struct(*[F.col(c) for c in cols])
    return (F.min_by if order_first else F.max_by)(val, key)


def first_touch(t: DataFrame, contact: str = "contact_id", ts: str = "touchpoint_timestamp",
                tid: str = "touchpoint_id") -> DataFrame:
    """Earliest touch with a utm source or a referrer; else earliest touch of any kind."""
    cols = [tid, ts, "utm_source", "utm_medium", "utm_campaign"]
    sourced = F.col("utm_source").isNotNull() | F.col("referrer").isNotNull()
    g = t.groupBy(contact).agg(_pick(True, cols, sourced, ts, tid).alias("_s"),
                               F.min(F.when(sourced, F.lit(1))).alias("_has"),
                               _pick(True, cols, None, ts, tid).alias("_a"))
    pick = F.when(F.col("_has").isNotNull(), F.col("_s")).otherwise(F.col("_a"))
    return g.select(contact, *[pick[c].alias(f"first_{c}" if not c.startswith("touchpoint") else
                                             c.replace("touchpoint", "first_touchpoint")) for c in cols])


def first_form(t: DataFrame, contact: str = "contact_id", ts: str = "touchpoint_timestamp",
               tid: str = "touchpoint_id", form_type: str = "form_submission") -> DataFrame:
    """Earliest form-submission touch per contact."""
    cols = [tid, ts, "utm_source", "utm_medium", "utm_campaign"]
    g = t.filter(F.col("web_event_type") == form_type).groupBy(contact).agg(
        _pick(True, cols, None, ts, tid).alias("_f"))
    return g.select(contact, F.col("_f")[tid].alias("first_form_touchpoint_id"),
                    F.col("_f")[ts].alias("first_form_timestamp"),
                    F.col("_f.utm_source").alias("first_form_utm_source"),
                    F.col("_f.utm_campaign").alias("first_form_utm_campaign"))


def last_touch_before(t: DataFrame, stages: DataFrame, stage_col: str, contact: str = "contact_id",
                      ts: str = "touchpoint_timestamp", tid: str = "touchpoint_id") -> DataFrame:
    """Last touch on or before the stage DAY (a touch later on the stage day counts, M20)."""
    j = t.join(stages.select(contact, stage_col), contact)
    j = j.filter(F.to_date(F.col(ts)) <= F.col(stage_col))
    g = j.groupBy(contact).agg(_pick(False, [tid, ts, "utm_source", "utm_medium"], None, ts, tid).alias("_l"))
    p = stage_col.replace("date_", "")
    return g.select(contact, F.col("_l")[tid].alias(f"{p}_last_touchpoint_id"),
                    F.col("_l")[ts].alias(f"{p}_last_touchpoint_timestamp"),
                    F.col("_l.utm_source").alias(f"{p}_last_utm_source"))


def linear_touch(t: DataFrame, stages: DataFrame, stage_col: str, contact: str = "contact_id",
                 ts: str = "touchpoint_timestamp", tid: str = "touchpoint_id", as_array: bool = False) -> DataFrame:
    """Every touch on or before the stage day, weight 1 / number of distinct touches.

    Rows (contact, touch, weight) by default; ``as_array=True`` returns one row per contact
    with ``array<struct>`` sorted by time. The per-contact count is a partial aggregate
    joined back, so the weights never need a whole contact in one task."""
    j = t.join(stages.select(contact, stage_col), contact).filter(F.to_date(F.col(ts)) <= F.col(stage_col))
    n = j.groupBy(contact).agg(F.countDistinct(tid).alias("n_touches"))
    rows = j.select(contact, tid, ts, "utm_source").distinct().join(n, contact) \
        .withColumn("weight", F.lit(1.0) / F.col("n_touches"))
    if not as_array:
        return rows
    return rows.groupBy(contact).agg(
        F.array_sort(F.collect_list(F.struct(ts, tid, "utm_source", "weight"))).alias("touches"),
        F.first("n_touches").alias("n_touches"))


def attribution_flags(t: DataFrame, stages: DataFrame, contact: str = "contact_id",
                      ts: str = "touchpoint_timestamp", tid: str = "touchpoint_id",
                      form_type: str = "form_submission") -> DataFrame:
    """Per touch, booleans for six models: first touch, first form, last touch before
    lead / mql, linear lead / mql. One per-contact aggregate of the winning ids, joined back."""
    j = t.join(stages.select(contact, "date_lead", "date_mql"), contact, "left")
    d = F.to_date(F.col(ts))
    key = F.struct(F.col(ts), F.col(tid))
    winners = j.groupBy(contact).agg(
        F.min_by(tid, key).alias("_first"),
        F.min_by(tid, F.when(F.col("web_event_type") == form_type, key)).alias("_form"),
        F.max_by(tid, F.when(d <= F.col("date_lead"), key)).alias("_lead_last"),
        F.max_by(tid, F.when(d <= F.col("date_mql"), key)).alias("_mql_last"))
    x = j.join(winners, contact)
    return x.select(
        contact, tid, ts, "web_event_type",
        F.coalesce(F.col(tid) == F.col("_first"), F.lit(False)).alias("is_first_touch_attribution_model"),
        F.coalesce(F.col(tid) == F.col("_form"), F.lit(False)).alias("is_first_form_attribution_model"),
        F.coalesce(F.col(tid) == F.col("_lead_last"), F.lit(False)).alias("is_lead_last_touch_attribution_model"),
        F.coalesce(F.col(tid) == F.col("_mql_last"), F.lit(False)).alias("is_mql_last_touch_attribution_model"),
        F.coalesce(d <= F.col("date_lead"), F.lit(False)).alias("is_lead_linear_attribution_model"),
        F.coalesce(d <= F.col("date_mql"), F.lit(False)).alias("is_mql_linear_attribution_model"))


def touch_counts_before(t: DataFrame, stages: DataFrame, contact: str = "contact_id",
                        ts: str = "touchpoint_timestamp", tid: str = "touchpoint_id",
                        form_type: str = "form_submission") -> DataFrame:
    """Touches and forms on or before the earliest conversion; the conversion date is the
    strict LEAST of lead and mql dates (NULL if either is NULL, M1), so such contacts get 0."""
    conv = stages.select(contact, least_strict("date_lead", "date_mql").alias("conversion_date"))
    j = t.join(conv, contact)
    before = F.to_date(F.col(ts)) <= F.col("conversion_date")
    return j.groupBy(contact).agg(
        F.countDistinct(F.when(before, F.col(tid))).alias("touches_before_conversion"),
        F.countDistinct(F.when(before & (F.col("web_event_type") == form_type), F.col(tid)))
        .alias("forms_before_conversion"))


def attributed_events(first: DataFrame, stages: DataFrame, stage_cols: Sequence[str], contact: str = "contact_id",
                      revenue: DataFrame | None = None) -> DataFrame:
    """One row per contact and reached stage (and per revenue line), all carrying the
    contact's attribution columns. Stages are stacked with one explode, not one union each."""
    st = F.explode(F.filter(F.array(*[F.struct(F.lit(c.replace("date_", "")).alias("stage"),
                                                F.col(c).alias("stage_date")) for c in stage_cols]),
                            lambda s: s["stage_date"].isNotNull()))
    rows = stages.select(contact, st.alias("s")).select(contact, "s.stage", "s.stage_date",
                                                        F.lit(None).cast("double").alias("amount"))
    if revenue is not None:
        rows = rows.unionByName(revenue.select(contact, F.lit("revenue").alias("stage"), "stage_date", "amount"))
    return rows.join(first, contact, "left")


def indicator_matrix(events: DataFrame, indicators: Sequence[tuple[str, str, str | None]],
                     models: Sequence[tuple[str, str, str | None]], group_cols: Sequence[str]) -> DataFrame:
    """Rows multiplied by indicator and model, each dated by its indicator, weighted for
    linear models, then aggregated on every breakdown.

    ``indicators`` = (name, date column, value column or None for a count of 1);
    ``models`` = (name, channel column, weight column or None for weight 1). Only non-NULL
    (indicator, date) pairs are exploded, so a contact with no conversion adds no row."""
    ind = F.explode(F.filter(F.array(*[
        F.struct(F.lit(n).alias("indicator"), F.col(d).alias("indicator_date"),
                 (F.col(v) if v else F.lit(1.0)).cast("double").alias("value"))
        for n, d, v in indicators]), lambda s: s["indicator_date"].isNotNull()))
    mod = F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).alias("channel"),
                 (F.col(w) if w else F.lit(1.0)).cast("double").alias("weight")) for n, c, w in models]))
    x = events.select(*group_cols, ind.alias("i"), *[F.col(c) for _, c, _ in models],
                      *[F.col(w) for _, _, w in models if w]).select("*", "i.*").drop("i")
    x = x.select(*group_cols, "indicator", "indicator_date", "value", mod.alias("m")).select("*", "m.*").drop("m")
    return x.groupBy("indicator", "model", "indicator_date", "channel", *group_cols).agg(
        F.sum(F.col("value") * F.col("weight")).alias("attributed_value"))


# ----------------------------------------------------------------------------- K30-K35

def funnel_dates(histories: Sequence[DataFrame], entity: str, date: str, stage_rank: str,
                 stages: Sequence[str]) -> DataFrame:
    """First date each stage is reached; reaching a later stage implies the earlier ones
    (date of stage k = first date of any stage >= k), across several histories."""
    u = reduce(lambda a, b: a.unionByName(b), [h.select(entity, date, stage_rank) for h in histories])
    return u.groupBy(entity).agg(*[F.min(F.when(F.col(stage_rank) >= i + 1, F.col(date))).alias(f"date_{s}")
                                   for i, s in enumerate(stages)])


def stage_conversion_counts(c: DataFrame, periods: Sequence[tuple[str, str, str]], contact: str = "contact_id") -> DataFrame:
    """Per period (label, start, end): contacts entering as lead, and among them those
    still open, lost, won, and converted to mql. ``contact`` is a positive number.

    One scan and one aggregate for all periods and measures: each is the bitmap of its contacts
    (:func:`id_bitmaps`), so the distinct counts neither multiply rows nor read the table again."""
    flags = {}
    for n, (_, start, end) in enumerate(periods):
        lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
        lead_in, by = F.col("date_lead").between(lo, hi), (lambda c, hi=hi: F.coalesce(F.col(c) <= hi, F.lit(False)))
        flags |= {f"leads_{n}": lead_in, f"lead_to_mql_{n}": lead_in & by("date_mql"), f"won_{n}": lead_in & by("date_won"),
                  f"lost_{n}": lead_in & by("date_lost"), f"open_{n}": lead_in & ~by("date_won") & ~by("date_lost")}
    one = union_counts(id_bitmaps(c, [], flags, contact), [], list(flags))
    names = ["leads", "lead_to_mql", "won", "lost", "open"]
    rows = F.array(*[F.struct(*[F.coalesce(f"{m}_{n}", F.lit(0).cast("long")).alias(m) for m in names], F.lit(label).alias("period")) for n, (label, _, _) in enumerate(periods)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


# Forms that make a contact "MQL first".
MQL_FIRST_FORMS = ["Signup creation", "Signup accounting", "contact", "RDV Sales Calendly",
                   "Other Calendly meetings", "Intercom"]


def contact_classification(c: DataFrame) -> DataFrame:
    """Contact type (MQL first / lead first) and treatment type: 'Congel' when lost before
    the strict LEAST of the won dates, else 'Sec' when won within 7 days of the lead, 'Frigo'
    beyond, '-' otherwise."""
    won = F.coalesce(F.col("quote_accepted_date"), F.col("date_first_subscription"))
    ctype = F.coalesce(F.when(F.col("first_conversion_form").isin(MQL_FIRST_FORMS), "MQL First")
                       .otherwise("Lead First"), F.lit("-"))
    treat = (F.when(F.col("date_lost") < least_strict("date_won_invoicing", "quote_accepted_date",
                                                     "date_first_subscription"), "Congel")
             .when(F.datediff(won, F.to_date("date_lead")) <= 7, "Sec")
             .when(F.datediff(won, F.to_date("date_lead")) > 7, "Frigo").otherwise("-"))
    return c.withColumn("contact_type", ctype).withColumn("treatment_type", F.coalesce(treat, F.lit("-")))


def churn_date(subs: DataFrame) -> DataFrame:
    """Annual payers churn at their suspension date; others at the later of last bill and
    suspension (strict GREATEST: NULL if either is missing)."""
    from growthframe.functions.semantics import greatest_strict
    return subs.withColumn("churn_date", F.when(F.col("billing_period") == "annual", F.col("suspension_date"))
                           .otherwise(greatest_strict("last_bill_date", "suspension_date")))


def latest_identity(df: DataFrame, events: DataFrame, key: str, id_col: str, order: Sequence[str],
                    event_id_col: str) -> DataFrame:
    """The last id seen per key (e.g. email) and, on the event side, the resolved contact
    id = that id, else the event's own id."""
    last = df.groupBy(key).agg(F.max_by(F.col(id_col), F.struct(*[F.col(o) for o in order])).alias("latest_id"))
    return events.join(last, key, "left").withColumn("resolved_id", F.coalesce("latest_id", event_id_col))


def form_values(df: DataFrame, json_col: str, names: Sequence[str]) -> DataFrame:
    """A JSON array of {name, value} pairs pivoted to one column per field name; forms
    with an empty or missing array are kept with NULL fields; of a repeated name the first value counts."""
    arr = F.from_json(F.col(json_col), "array<struct<name:string,value:string>>")
    x = df.withColumn("_m", arr)
    return x.select("*", *[F.get(F.filter("_m", _named(n)), F.lit(0))["value"].alias(f"field_{n}") for n in names]).drop("_m")


def _named(name: str):
    return lambda e: e["name"] == name
