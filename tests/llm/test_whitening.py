"""Whitening against a dense eigendecomposition and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from growthframe.llm import whitening as W
from growthframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("component", T.StringType()), T.StructField("n", T.StringType())])


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "x", None) for i, v in rows], SCHEMA).repartition(parts)


def brute(rows, many=8):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good], object)
    n, s = len(good), x.sum(0)
    deviation = [sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x]
    y = np.array((x * n - s) / n, float)
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:many], u[:, ::-1][:, :many]
    keep = e > 1e-12 * np.trace(v)
    return [i for i, _ in good], n, deviation, y @ u[:, keep] / np.sqrt(e[keep]), e[keep] / np.trace(v)


def same(got, rows, many=8):
    ids, n, deviation, white, explained = brute(rows, many)
    assert len(got) == white.size
    table = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-8
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        table.setdefault(r["component"], []).append((r["id"], r["deviation"], r["whitened"]))
    for k in range(white.shape[1]):
        ours = sorted(table[k + 1])
        theirs = sorted(zip(ids, deviation, white[:, k]))
        assert [a[:2] for a in ours] == [a[:2] for a in theirs]
        a, b = (np.array([r[2] for r in sorted(x, key=lambda r: r[:2])]) for x in (ours, theirs))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6


def test_rows_equal_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, 0.1, 24).astype(np.float32).tolist()) for i in range(300)]
    odd = [(500, None), (501, [None] * 24), (502, [float("nan")] + [0.0] * 23), (503, [float("inf")] + [0.0] * 23), (504, []), (505, [0.5] * 7)]
    extra = [(1, rows[1][1]), (-7, [0.25] * 24), (-8, [0.25] * 24)]
    same(W.whiten(frame(spark, rows + odd + extra)).collect(), rows + extra)


def test_registered_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op13_whitening"](spark, SF_SMALL)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(got.withColumnRenamed("vec_id", "id").collect(), rows)


def test_ranks_ties_and_empty_tables(spark):
    assert W.whiten(frame(spark, [])).count() == W.whiten(frame(spark, [(1, None)])).count() == 0
    assert W.whiten(frame(spark, [(1, [0.5, 0.25])])).count() == 0  # nothing varies
    assert W.whiten(frame(spark, [(1, [0.5]), (2, [0.5])])).count() == 0
    same(W.whiten(frame(spark, [(1, [0.5]), (2, [0.75]), (3, [0.75])])).collect(), [(1, [0.5]), (2, [0.75]), (3, [0.75])])
    line = [(k, [0.1 * k, 0.2 * k, 0.0]) for k in range(20)]  # close to one direction, one dimension constant
    got = W.whiten(frame(spark, line)).collect()
    assert {r["component"] for r in got} <= {1, 2} and len(got) >= 20
    (first,) = {r["n"] for r in got}
    assert first == 20
    null_id = W.whiten(frame(spark, [(None, [0.5]), (2, [0.75])])).collect()
    assert {r["id"] for r in null_id} == {None, 2}


@pytest.mark.parametrize("spectrum", [np.arange(40, 0, -1.0), np.r_[5.0, 5.0, 5.0, np.ones(20)], np.r_[1e6, 1.0, 1e-3, np.zeros(10)], np.ones(30), 2.0 ** -np.arange(30), np.r_[np.full(12, 3.0), 1.0]])
def test_contours_find_every_pair(spectrum):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))
    v = q * spectrum @ q.T
    v = (v + v.T) / 2
    values, vectors = W.leading_pairs(v, 8)
    expect = np.sort(spectrum[spectrum > 1e-12 * spectrum.sum()])[::-1][:8]
    assert np.allclose(values, expect, rtol=1e-9, atol=1e-12 * spectrum.sum())
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-11 * spectrum.max()


def test_inertia_counts():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((25, 25))
    v = a + a.T
    e = np.linalg.eigvalsh(v)
    shifts = np.linspace(e[0] - 1, e[-1] + 1, 101)
    assert (W.count_above(W.tridiagonal(v), shifts) == [(e > s).sum() for s in shifts]).all()


def test_deviation_is_exact_beyond_doubles():
    fit = W.Fit(10**6, np.array([10**11 + 3, 10**11 - 9]), np.zeros(0), np.zeros((2, 0)), 0.0)
    x = np.array([[100001, 99000], [100000, 100000]])
    assert fit.deviations(x) == [sum((10**6 * int(a) - int(s)) ** 2 for a, s in zip(r, fit.sums)) for r in x]
    assert W.Fit(10**9, np.array([10**14]), np.zeros(0), np.zeros((1, 0)), 0.0).deviations(np.array([[200000]])) == [None]
