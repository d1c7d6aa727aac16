"""Selection, interval joins, opening times, bitmaps, ordered pieces, pattern index and streaming upsert against plain forms."""

import datetime as dt
import math
import random
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from growthframe.operators import state as ST
from growthframe.operators.acquisition import map_patterns
from growthframe.operators.distinct import dense_ids, distinct_by_scopes
from growthframe.operators.indicators import COHORT_DATES
from growthframe.operators.ordered import ordered_array, ordered_text
from growthframe.operators.selection import _coarse, exact_ntile, exact_percentile, order_statistics
from growthframe.session import scratch_path
from tests.conftest import SF_SMALL

ODD = [None, 0.0, -0.0, 1.0, 1.0, 1.0, -1.0, 5e-324, -5e-324, 1e308, -1e308, math.inf, -math.inf, math.nan, 1 + 2**-52, 1.0, 3.5, 1e-300]


def rank(v):
    return (0, 0) if v is None else (2, 0) if math.isnan(v) else (1, v)


def test_coarse_bins_never_fall(spark):
    rng = random.Random(1)
    values = [v for v in ODD if v is not None] + [rng.choice((-1, 1)) * 2.0 ** rng.uniform(-1074, 1023) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", _coarse(F.col("v")).alias("b")).collect()
    rows.sort(key=lambda r: rank(r["v"]))
    assert all(a["b"] <= b["b"] for a, b in zip(rows, rows[1:]))


def test_order_statistics_of_odd_values(spark):
    rows = [(g, v) for g in (None, 1, 2) for v in ODD * (g or 3)]
    df = spark.createDataFrame(rows, "g int, v double")
    ranks = [(str(k), lambda n, k=k: F.lit(k)) for k in range(len(ODD))]
    got = {(r["g"], int(r["name"])): r for r in order_statistics(df, ["g"], "v", ranks).collect()}
    for g in (None, 1, 2):
        values = sorted((v for h, v in rows if h == g), key=rank)
        for k in range(len(ODD)):
            r = got[g, k]
            assert repr(rank(r["value"])) == repr(rank(values[k])) or rank(r["value"]) == rank(values[k])
            assert r["before"] == sum(rank(v) < rank(values[k]) for v in values) and r["total"] == len(values)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.one_of(st.none(), st.floats(-1e6, 1e6), st.just(7.0))), min_size=1, max_size=60), st.floats(0, 1))
def test_percentiles_with_ties_and_nulls(spark, rows, q):
    df = spark.createDataFrame(rows, "g int, v double")
    name = f"p{int(round(q * 100))}"
    ours = {r["g"]: r[name] for r in exact_percentile(df, "v", [q], ["g"]).collect()}
    theirs = {r["g"]: r["x"] for r in df.groupBy("g").agg(F.percentile("v", F.lit(q)).alias("x")).collect() if r["x"] is not None}
    assert ours.keys() == theirs.keys()
    assert all(math.isclose(ours[k], theirs[k], rel_tol=1e-12, abs_tol=1e-9) for k in ours)


def test_percentile_and_ntile_of_one_hot_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, 42.0).otherwise((F.col("id") * 7919 % 1009).cast("double")).alias("v"))
    (r,) = exact_percentile(df, "v", [0.0, 0.5, 0.9, 1.0]).collect()
    (e,) = df.agg(*[F.percentile("v", q).alias(f"p{int(q * 100)}") for q in (0.0, 0.5, 0.9, 1.0)]).collect()
    assert r.asDict() == e.asDict()
    ours = exact_ntile(df, 7, ["v", "id"], name="b", distributed=True).select("id", "b").collect()
    plain = df.withColumn("b", F.ntile(7).over(Window.orderBy("v", "id"))).select("id", "b").collect()
    assert sorted(map(tuple, ours)) == sorted(map(tuple, plain))
    assert sorted(map(tuple, exact_ntile(df, 7, ["v", "id"], name="b").select("id", "b").collect())) == sorted(map(tuple, plain))


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def spans(rng, n):
    out = []
    for k in range(n):
        a = rng.randrange(400)
        out.append((rng.choice((None, 1, 1, 1, 2, 3)), k, day(a), None if rng.random() < 0.2 else day(a + rng.randrange(-3, 120))))
    return out


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(2)
    left, right = spans(rng, 80), spans(rng, 80)
    horizon = day(420)
    lf = spark.createDataFrame(left, "k int, l int, a date, b date")
    rf = spark.createDataFrame([(k, n, a, b) for k, n, a, b in right], "k int, r int, c date, d date")
    expect = []
    for k, n, a, b in left:
        b2 = b or horizon
        hits = [(k, n, m, max(a, c), min(b2, d or horizon)) for j, m, c, d in right
                if k is not None and j == k and a <= b2 and c <= (d or horizon) and a <= (d or horizon) and c <= b2]
        expect += hits or [(k, n, None, None, None)]
    got = ST.overlap_join(lf, rf, ["k"], ["a", "b"], ["c", "d"], horizon).select("k", "l", "r", "overlap_start", "overlap_end").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(expect, key=repr)
    inner = ST.overlap_join(lf, rf, ["k"], ["a", "b"], ["c", "d"], horizon, how="inner", days=7).select("k", "l", "r", "overlap_start", "overlap_end").collect()
    assert sorted(map(tuple, inner), key=repr) == sorted((x for x in expect if x[2] is not None), key=repr)


def test_elementary_segments_equal_days(spark):
    rng = random.Random(3)
    rows = [(k, n % 3, a, b) for k, n, a, b in spans(rng, 60) if k is not None]
    df = spark.createDataFrame(rows, "k int, f int, a date, b date")
    seg = ST.elementary_segments(df, ["k"], "a", "b", {f"f{i}": F.col("f") == i for i in range(3)}, day(420)).collect()
    by_day = {}
    for r in seg:
        for n in range((r["segment_end"] - r["segment_start"]).days + 1):
            key = r["k"], r["segment_start"] + dt.timedelta(days=n)
            assert key not in by_day  # segments don't overlap
            by_day[key] = tuple(r[f"f{i}"] for i in range(3))
    expect = {}
    for k, f, a, b in rows:
        for n in range(((b or day(420)) - a).days + 1):
            expect.setdefault((k, a + dt.timedelta(days=n)), set()).add(f)
    assert by_day == {k: tuple(i in v for i in range(3)) for k, v in expect.items()}


def test_opening_time_does_not_depend_on_the_way(spark):
    """Long intervals: the sum over its days, with a version that changes at noon and days without hours."""
    hours = spark.createDataFrame([("2024-01-01 00:00:00", d, 9 * 3600, 17 * 3600) for d in range(1, 6)] + [("2024-03-06 12:00:00", d, 8 * 3600, 12 * 3600) for d in range(1, 8)],
                                  "valid_from string, iso_weekday int, open_seconds long, close_seconds long").withColumn("valid_from", F.col("valid_from").cast("timestamp_ntz"))
    df = spark.createDataFrame([(1, "2023-12-30 10:00:00", "2024-03-10 09:30:00"), (2, "2024-03-06 11:00:00", "2024-03-06 13:00:00"), (3, "2024-03-09 23:00:00", "2024-03-09 01:00:00"),
                                (4, None, "2024-03-09 01:00:00"), (5, "2024-01-06 08:00:00", "2024-01-07 20:00:00"), (6, "2024-01-02 10:00:00", "2024-01-02 10:00:30")],
                               "id int, a string, b string").select("id", F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    got = {r["id"]: r["business_seconds"] for r in ST.business_seconds(df, "a", "b", hours, version="instant").collect()}
    weekdays = sum(1 for n in range(65) if (dt.date(2024, 1, 1) + dt.timedelta(days=n)).isoweekday() < 6)  # until 5 March
    assert got == {1: weekdays * 8 * 3600 + 3 * 3600 + 3 * 4 * 3600 + int(1.5 * 3600), 2: 3600, 3: 0, 4: 0, 5: 0, 6: 30}
    start = {r["id"]: r["business_seconds"] for r in ST.business_seconds(df, "a", "b", hours, version="start").collect()}
    assert start[2] == 2 * 3600 and start[1] == 0  # hours in force at the start; none before the first version


def test_bitmaps_equal_distinct_counts(spark):
    df = spark.range(20000).select((F.col("id") * 7919 % 100003 + 1).alias("u"), (F.col("id") % 5).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("b"))
    df = df.union(df).union(df.limit(3).withColumn("u", F.lit(None).cast("long")))
    flags = {"all": F.lit(True), "even": F.col("u") % 2 == 0, "none": F.lit(None).cast("boolean")}
    got = distinct_by_scopes(df, {"a, b": ["a", "b"], "b": ["b"], "total": []}, flags, "u").collect()
    for scope, keys in (("a, b", ["a", "b"]), ("b", ["b"]), ("total", [])):
        plain = df.groupBy(*keys).agg(F.countDistinct("u").alias("all"), F.countDistinct(F.when(F.col("u") % 2 == 0, F.col("u"))).alias("even")).collect()
        ours = sorted(([r[k] for k in keys], r["all"], r["even"]) for r in got if r["scope"] == scope) if not keys or "b" not in keys else sorted(
            (([r[k] for k in keys], r["all"], r["even"]) for r in got if r["scope"] == scope), key=repr)
        assert sorted(ours, key=repr) == sorted((([r[k] for k in keys], r["all"], r["even"]) for r in plain), key=repr)
    assert {r["none"] for r in got} == {0}
    ids = dense_ids(df.select((F.col("a") * 10).alias("k")), "k").collect()
    assert sorted(r["dense_id"] for r in ids) == list(range(1, 6))


def test_pieces_in_order_equal_one_array(spark):
    df = spark.range(2000).select((F.col("id") % 4).alias("k"), F.col("id"), (F.col("id") * 7919 % 503).alias("t"), F.when(F.col("id") % 9 > 0, F.concat(F.lit("p"), (F.col("id") % 6).cast("string"))).alias("v"))
    order = F.struct("t", "id")
    got = ordered_array(df, ["k"], F.floor(F.col("t") / 50), order, F.col("v"), "all").collect()
    plain = df.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", "id", "v"))), lambda x: x["v"]).alias("x")).collect()
    assert {r["k"]: (r["all"], r["n_all"]) for r in got} == {r["k"]: (r["x"], len(r["x"])) for r in plain}
    text = ordered_text(df, ["k"], F.floor(F.col("t") / 50), order, F.col("v"), ">", "path").collect()
    for r, p in zip(sorted(text), sorted(plain)):
        want = ">".join(v for v in p["x"] if v is not None)
        assert (r["path"], r["chars_path"], r["n_path"], r["distinct_path"]) == (want, len(want), len(p["x"]), len(set(p["x"])))


def test_pattern_index_keeps_repeats_and_needs_no_nested_loop(spark):
    facts = spark.createDataFrame([(k, s) for k, s in enumerate(["abcdef", "xxabcxx", "ab", "", None, "a%b", "ABC", "zabz"])], "id int, s string")
    m = spark.createDataFrame([("%abc%", "A", 1), ("%abc%", "A", 1), ("%b_d%", "B", 2), ("%z%", "C", 3), ("a%", "D", 4), ("ab", "E", 5), ("%a%b%", "F", 6), ("%qqq%", "G", 7)], "p string, o string, n int")
    got = map_patterns(facts, m, [("s", "p")], ["o"], sort_col="n", mode="all")
    plain = facts.join(m, F.expr("lower(s) LIKE lower(p)"), "left").select("id", F.coalesce("o", F.lit("Unmapped")))
    assert sorted(map(tuple, got.select("id", "o").collect())) == sorted(map(tuple, plain.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_breakdowns_add_up_to_the_total(spark):
    from growthframe.plans import registry

    registry.load_all()
    assert sum(map(len, COHORT_DATES.values())) == 31
    for name, sets in (("k28_indicators_by_model", {"total", "gender", "age_range, gender", "source_name, channel"}), ("k28_indicators_linear", {"total", "channel"})):
        rows = registry.QUERIES[name](spark, SF_SMALL).groupBy("breakdown", "indicator", "model").agg(F.sum("value").alias("v")).collect()
        totals = {(r["indicator"], r["model"]): r["v"] for r in rows if r["breakdown"] == "total"}
        assert {r["breakdown"] for r in rows} == sets and len({i for i, _ in totals}) >= 30
        for r in rows:
            assert r["v"] == pytest.approx(totals[r["indicator"], r["model"]], abs=1e-3)


def test_streaming_upsert_survives_a_restart(spark):
    from growthframe.streaming.upserts import ledger_of, merge_batch, upsert_stream

    name = f"restart-{uuid.uuid4().hex}"
    source, target = scratch_path(spark, f"test/{name}-in"), scratch_path(spark, f"test/{name}-out")
    schema = "id int, version int, d date, v string"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    state = lambda: sorted(map(tuple, spark.read.parquet(target).select("id", "version", "d", "v").collect()))
    run = lambda after=None: upsert_stream(spark.readStream.schema(schema).parquet(source), target, name, ["id"], ["version"], "d", available_now=True, after_merge=after)
    put([(1, 1, day(0), "a"), (2, 1, day(0), "b"), (3, 1, day(1), "c"), (3, 1, day(1), "c")])
    run().awaitTermination()
    assert state() == [(1, 1, day(0), "a"), (2, 1, day(0), "b"), (3, 1, day(1), "c")]
    put([(1, 2, day(5), "corrected"), (2, 0, day(0), "late and old"), (4, 1, day(1), "new")])

    def crash(batch_id):
        raise RuntimeError("lost after the merge")

    with pytest.raises(Exception, match="lost after the merge"):
        run(crash).awaitTermination()
    merged = state()
    assert merged == [(1, 2, day(5), "corrected"), (2, 1, day(0), "b"), (3, 1, day(1), "c"), (4, 1, day(1), "new")]
    files = sorted(r["f"] for r in spark.read.parquet(target).select(F.input_file_name().alias("f")).distinct().collect())
    run().awaitTermination()  # the engine delivers the batch again
    assert state() == merged
    assert files == sorted(r["f"] for r in spark.read.parquet(target).select(F.input_file_name().alias("f")).distinct().collect())
    assert sorted(map(tuple, ledger_of(spark, name).collect())) == [(0, 4), (1, 3)]
    # a batch that was merged but not noted (lost between both) is merged again and changes nothing
    again = spark.createDataFrame([(1, 2, day(5), "corrected"), (4, 1, day(1), "new")], schema)
    assert merge_batch(again, 7, target, scratch_path(spark, f"test/{name}-ledger"), ["id"], ["version"], "d")
    assert state() == merged


def test_intervals_to_days_spread_only_segments(spark):
    rng = random.Random(5)
    rows = [(k, rng.choice((None, True, False)), a, b) for k, _, a, b in spans(rng, 60)] + [(4, None, day(3), day(5)), (4, True, None, day(9)), (None, None, day(1), None)]
    df = spark.createDataFrame(rows, "k int, f boolean, a date, b date")
    got = ST.intervals_to_days(df, ["k"], "a", "b", {"open": F.lit(True), "f": F.col("f")}, F.lit(day(420)))
    expect = {}
    for k, f, a, b in rows:
        for n in range(((b or day(420)) - a).days + 1 if a else 0):
            expect.setdefault((k, a + dt.timedelta(days=n)), []).append(f)
    expect = [(*k, True, True if True in v else False if False in v else None) for k, v in expect.items()]
    assert got.columns == ["k", "d", "open", "f"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expect, key=repr)
    # days of overlapping intervals aren't built one by one and merged: nothing is aggregated after they are spread
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("explode(sequence(segment_start") < plan.find("Aggregate")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_linear_shares_of_all_stages_in_one_pass(spark):
    from growthframe.operators.indicators import linear_shares
    from growthframe.plans import registry

    rng = random.Random(6)
    rows = [(rng.choice((None, 1, 2, 3, 4)), rng.choice((None, "s", "z")), rng.choice("ab"), rng.choice((None, 1, 2, 3))) for _ in range(80)] + [(9, "s", "a", 5)]
    df = spark.createDataFrame(rows, "k int, source_name string, channel string, d int")
    got = linear_shares(df, "k", {"early": F.col("d") <= 1, "late": F.col("d") <= 2})
    expect = {}
    for k in (1, 2, 3, 4):
        expect[k] = []
        for until in (1, 2):
            hits = [(s, c) for j, s, c, d in rows if j == k and d is not None and d <= until]
            expect[k].append(sorted(((s, c, hits.count((s, c)), len(hits)) for s, c in set(hits)), key=repr) or None)
    assert {r["k"]: [x and sorted(map(tuple, x), key=repr) for x in (r["early"], r["late"])] for r in got.collect()} == expect
    one = linear_shares(df, "k", F.col("d") <= 2, name="late")
    assert {r["k"]: sorted(map(tuple, r["late"]), key=repr) for r in one.collect()} == {k: v[1] for k, v in expect.items() if v[1]}
    # touches meet their contacts once and contacts their shares once; sources, in no breakdown, aren't grouped by
    registry.load_all()
    plan = plan_of(registry.QUERIES["k28_indicators_linear"](spark, SF_SMALL))
    assert plan.count("Join ") == 2 and "source_name" not in plan[:plan.find("Join ")].split("Generate")[0]


def test_dense_months_without_a_spine(spark):
    from growthframe.operators.subscriptions import dense_months

    rng = random.Random(8)
    month = lambda n: dt.date(2020 + n // 12, n % 12 + 1, 1)
    rows = [(rng.choice((None, 1, 2, 3)), rng.choice((None, "x", "y")), rng.choice((None, *map(month, range(14)))), rng.choice((None, math.nan, 1.0, 2.0))) for _ in range(70)]
    rows += [(7, "x", month(13), 1.0), (8, "x", None, 1.0), (9, "x", dt.date(2020, 1, 31), 5.0), (9, "x", dt.date(2020, 3, 31), 6.0), (9, "x", dt.date(2020, 4, 1), 7.0)]
    got = dense_months(spark.createDataFrame(rows, "k int, c string, m date, v double"), ["k", "c"], "m", "v", "2021-01-20")
    last = {1: 31, 2: 29, 3: 31, 4: 30, 5: 31, 6: 30, 7: 31, 8: 31, 9: 30, 10: 31, 11: 30, 12: 31}
    expect = []
    for k, c in {r[:2] for r in rows}:
        own = [(m, v) for a, b, m, v in rows if (a, b) == (k, c) and m]
        first = min((m for m, _ in own), default=month(99))
        grid = [month(n).replace(day=min(first.day, last[n % 12 + 1])) for n in range(first.year * 12 + first.month - 1 - 2020 * 12, 13)] if first <= month(12) else []
        for m in (g for g in grid if g <= month(12)):
            hits = [v for x, v in own if x == m and None not in (k, c)] or [0.0]
            expect += [(k, c, m, 0.0 if v is None or math.isnan(v) else v) for v in hits]
    assert got.columns == ["k", "c", "m", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expect, key=repr)
    assert "Join" not in plan_of(got)


def test_new_product_sales_add_up_days_first(spark):
    from growthframe.operators.order_facts import new_product_sales

    rng = random.Random(9)
    rows = [(rng.choice((None, 1, 2, 3)), rng.choice((None, *map(day, range(0, 200, 9)))), rng.choice((None, 1.0, 2.0))) for _ in range(90)] + [(5, None, 1.0)]
    got = new_product_sales(spark.createDataFrame(rows, "p int, d date, q double"), "p", "d", "q")
    first = {p: min((d for x, d, _ in rows if x == p and d), default=None) for p, _, _ in rows}
    expect = []
    for scope in ("new", "all"):
        inside = [(p, d, q) for p, d, q in rows if p and (scope == "all" or d and first[p] <= d < first[p] + dt.timedelta(days=90))]
        for day_ in {d for _, d, _ in inside}:
            quantities = [q for _, d, q in inside if d == day_ and q]
            expect.append((scope, day_, sum(quantities) if quantities else None, len({p for p, d, _ in inside if d == day_})))
    expect += [("created", d, None, list(first.values()).count(d)) for d in set(first.values())]
    assert got.columns == ["scope", "d", "quantity", "products"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expect, key=repr)
    assert "Join" not in plan_of(got) and "distinct" not in plan_of(got).lower()


def test_one_bucket_has_no_edges(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (2, 2)], "g int, v int")
    for groups in ([], ["g"]):
        assert [r["b"] for r in exact_ntile(df, 1, ["v", "g"], groups, name="b", distributed=True).collect()] == [1, 1, 1]
