"""Whitening against a dense eigensolver and against whole-number arithmetic."""

from fractions import Fraction

import numpy as np
import pytest

from lodestrata.llm import whitening as W


def rows_of(df):
    rows = df.toPandas()
    rows["copy"] = rows.groupby(["vec_id", "component"]).cumcount()
    return rows.sort_values(["vec_id", "copy", "component"], ignore_index=True)


def check(got, ids, vectors, components):
    x = np.floor(np.asarray(vectors, float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    whitened = centred @ axes / np.sqrt(values)
    table = got["whitened"].to_numpy().reshape(n, components)
    order = np.argsort(ids, kind="stable")
    sign = np.sign((table * whitened[order]).sum(axis=0))
    assert np.abs(table - whitened[order] * sign).max() < 1e-8
    assert np.allclose(got["explained"].to_numpy()[:components], values / np.trace(centred.T @ centred / n), rtol=1e-9)
    exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x[order]]
    assert got["deviation"].tolist() == np.repeat(exact, components).tolist()
    assert set(got["n"]) == {n} and got["identity_error"].nunique() == 1
    assert got["identity_error"].iat[0] < 1e-8
    cov = np.cov(table.T, bias=True).reshape(components, components)
    assert np.abs(cov - np.eye(components)).max() < 1e-8


@pytest.mark.parametrize("dims, most", [(40, 32), (6, 6)])
def test_against_a_dense_solver(spark, dims, most):
    rng = np.random.default_rng(dims)
    vectors = rng.normal(size=(150, dims)) * np.linspace(3, 0.2, dims) + 5
    df = spark.createDataFrame([(i, v.tolist(), 2) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n int")
    check(rows_of(W.whiten(df.repartition(4))), np.arange(150), vectors, most)


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    good = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(30, 3)))] + [(77, [0.0, 0.0, 0.0])] * 2
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, float("nan"), 0.0]), (204, [float("-inf"), 0.0, 0.0]),
           (205, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").repartition(3)
    got = rows_of(W.whiten(df))
    check(got, [i for i, _ in good], [v for _, v in good], 3)
    with_null = W.whiten(df.union(spark.createDataFrame([(None, [1.0, 2.0, 3.0])], df.schema))).toPandas()
    assert with_null["vec_id"].isna().sum() == 3 and set(with_null["n"]) == {33}


def test_dimensions_are_fitted_apart_and_flat_ones_have_no_component(spark):
    rows = [(i, [float(i), 2.0]) for i in range(5)] + [(10, [1.0]), (11, [1.0])]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert sorted(got["vec_id"]) == [0, 1, 2, 3, 4] and set(got["component"]) == {1}  # one dimension is constant
    assert np.allclose(sorted(got["whitened"]), np.arange(-2, 3) / np.sqrt(2))
    assert W.whiten(spark.createDataFrame([], "vec_id long, embedding array<double>")).collect() == []


def test_large_values_are_exact(spark):
    at = W.Centre(3, (5, 2 ** 60 + 1))
    x = np.array([[1, 2 ** 58], [2, 2 ** 59], [2, 2 ** 58 + 1]], np.int64)
    mean = [Fraction(s, 3) for s in at.sums]
    exact = [[float(int(c) - m) for c, m in zip(row, mean)] for row in x]
    assert np.allclose(at.centred(x), exact, rtol=1e-15)
    assert at.deviations(x) == [None, None, None]
    small = W.Centre(3, (5, 7))
    y = np.array([[1, 2], [2, 2], [2, 3]], np.int64)
    assert small.deviations(y) == [(3 - 5) ** 2 + (6 - 7) ** 2, 1 + 1, 1 + 4]


def decaying(d):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(d, d)))[0]
    return q * np.exp(-0.4 * np.arange(d)) @ q.T


def clustered(d):
    q = np.linalg.qr(np.random.default_rng(2).normal(size=(d, d)))[0]
    return q * np.repeat([5.0, 2.0, 0.1, 0.0], d // 4) @ q.T


@pytest.mark.parametrize("v", [decaying(48), clustered(48), np.eye(40), np.diag(np.arange(1.0, 50)), np.array([[2.0]]),
                               np.zeros((4, 4))])
def test_eigenpairs(v):
    v = (v + v.T) / 2
    values, vectors = W.leading_eigenpairs(v)
    dense = np.linalg.eigvalsh(v)[::-1]
    dense = dense[dense > 1e-12 * np.trace(v)][:32]
    assert len(values) == len(dense) and np.allclose(values, dense, rtol=1e-9)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-13
    assert np.abs(v @ vectors - vectors * values).max(initial=0) <= 1e-13 * max(np.trace(v), 1e-300)


def test_inertia_counts():
    v = clustered(24)
    form = W.tridiagonal((v + v.T) / 2)
    assert [W.below(form, s) for s in (-1.0, 0.05, 1.0, 3.0, 6.0)] == [0, 6, 12, 18, 24]
