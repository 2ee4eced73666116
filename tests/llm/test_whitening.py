"""Whitening against a dense eigendecomposition and exact integers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from histora.llm import whitening as wh
from histora.llm.queries import QUERIES


def products_of(x, calls=None):
    def products(w):
        if calls is not None:
            calls.append(1)
        u = x @ w
        return float(u @ u), u @ x

    return products


def same_spaces(found, values, x, wanted):
    """The vectors found are singular vectors of x for its largest singular values."""
    _, s, _ = np.linalg.svd(x)
    rank = int((s > 1e-10 * max(s[0], 1e-300)).sum())
    assert len(values) == min(wanted, rank)
    np.testing.assert_allclose(values, s[: len(values)], rtol=1e-10)
    np.testing.assert_allclose(found @ found.T, np.eye(len(found)), atol=1e-10)
    np.testing.assert_allclose((x.T @ (x @ found.T)).T, found * values[:, None] ** 2, atol=1e-8 * s[0] ** 2)


@pytest.mark.parametrize("shape", [(50, 8), (5, 8), (300, 64), (1, 3), (40, 1), (200, 30)])
def test_singular_vectors(shape):
    x = np.random.default_rng(3).standard_normal(shape)
    same_spaces(*wh.golub_kahan(products_of(x), shape[1], 4), x, 4)


def test_equal_singular_values_are_all_found():
    rng = np.random.default_rng(5)
    for values in ([5, 5, 5, 5, 5, 1, 1, 1], [9, 9, 2, 2, 2, 1], [4.0] * 6, [3, 0, 0, 0, 0, 0], [7, 7] + [1e-3] * 90):
        d = len(values)
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        p, _ = np.linalg.qr(rng.standard_normal((d + 3, d)))
        x = p @ np.diag(np.array(values, float)) @ q.T
        same_spaces(*wh.golub_kahan(products_of(x), d, 4), x, 4)


def test_few_passes_where_the_values_fall_fast():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((500, 200)) * 0.5 ** np.arange(200)
    calls = []
    same_spaces(*wh.golub_kahan(products_of(x, calls), 200, 4), x, 4)
    assert len(calls) < 100


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.integers(1, 6), st.integers(0, 3), st.integers(0, 10**6))
def test_small_integer_matrices(n, d, span, seed):
    x = np.random.default_rng(seed).integers(-span, span + 1, (n, d)).astype(float)
    if x.any():
        same_spaces(*wh.golub_kahan(products_of(x), d, 4), x, 4)


def brute(vectors, components=4):
    """(n, deviations, whitened up to sign, explained) by a dense eigendecomposition."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    keep = [i for i in order if values[i] > 1e-9]
    whitened = (np.array(x, float) - mean) @ vectors[:, keep] / np.sqrt(values[keep])
    return n, deviation, whitened, values[keep] / values.sum()


def check(rows, ids, vectors):
    n, deviation, whitened, explained = brute(vectors)
    found = {}
    for r in rows:
        assert r.n == n and r.identity_error < 1e-9
        assert r.deviation == deviation[ids.index(r.vec_id)]
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-10)
        found[r.vec_id, r.component] = r.whitened
    assert set(found) == {(i, c + 1) for i in ids for c in range(len(explained))}
    for c in range(len(explained)):
        got = np.array([found[i, c + 1] for i in ids])
        sign = np.sign(got @ whitened[:, c])
        np.testing.assert_allclose(got * sign, whitened[:, c], atol=1e-8)


def test_embeddings_against_eigendecomposition(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    got = QUERIES["op12_lanczos_whitening"](spark, folder).collect()
    check(got, [r.vec_id for r in rows], [r.embedding for r in rows])


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    good = [[float(c) for c in v] for v in rng.standard_normal((20, 5)).astype(np.float32)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0], [nan] * 5, [inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, i, 0.5) for i, v in enumerate(good + bad)] + [(100, good[0], 1, 0.5), (None, good[1], 1, 0.5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, whitened double")
    got = wh.whitened_components(df).collect()
    assert sum(r.vec_id is None for r in got) == 4 and sum(r.vec_id == 100 for r in got) == 4
    check([r for r in got if r.vec_id is not None and r.vec_id < 20], list(range(20)), good)


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0], [1.0, 2.0]], [None, []]])
def test_without_variance_there_are_no_components(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    assert wh.whitened_components(df).collect() == []


def test_fewer_components_than_asked_for(spark):
    vectors = [[1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [4.0, 0.0, 0.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = wh.whitened_components(df).collect()
    assert {r.component for r in got} == {1} and len(got) == 3
    check(got, [0, 1, 2], vectors)


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 40, -5], [3, 4], [1 << 62, 0]], np.int64)
    n, sums = 10**6, [12345678901234567890, -7]
    want = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert wh.deviations_squared(x, n, sums) == [w if w < 10**38 else None for w in want]
