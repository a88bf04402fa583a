from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewmill.llm import whiten
from reviewmill.llm.queries import LLM_QUERIES

RANDOM = np.random.default_rng(5)


def _spread(values):
    q, _ = np.linalg.qr(RANDOM.normal(size=(len(values), len(values))))
    return (q * values) @ q.T


MATRICES = {
    "plain": _spread(RANDOM.uniform(1, 100, 40)),
    "close": _spread(100 + np.arange(64) * 1e-6),
    "equal": _spread(np.repeat([9.0, 4.0, 1.0], 8)),
    "identity": np.eye(20),
    "diagonal": np.diag([3.0, 1.0, 3.0, 2.0, 3.0, 0.5]),
    "low rank": _spread(np.array([5.0, 4.0, 3.0] + [0.0] * 12)),
    "wilkinson": np.diag(np.abs(np.arange(-10, 11)).astype(float)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1),
    "wide range": _spread(10.0 ** np.arange(-3, 8)),
    "one": np.array([[2.5]]),
    "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
    "zero": np.zeros((4, 4)),
}


@pytest.mark.parametrize("name", MATRICES)
def test_components_of_a_matrix(name):
    a = MATRICES[name]
    a = (a + a.T) / 2
    values, vectors = whiten.leading_components(a, 16)
    true = np.linalg.eigvalsh(a)[::-1][:16]
    true = true[true > 1e-13 * max(true[0], 0)]
    norm = max(1e-300, np.abs(a).max())
    assert len(values) == len(true) and np.abs(values - true).max(initial=0) <= 1e-13 * norm * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) <= 1e-13
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-13 * norm * len(a)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10_000), st.sampled_from([0, 1, 3]))
def test_whole_number_matrices(d, seed, reach):
    x = np.random.default_rng(seed).integers(-reach, reach + 1, (d, d)).astype(float)
    a = x @ x.T
    values, vectors = whiten.leading_components(a, d)
    true = np.linalg.eigvalsh(a)[::-1]
    assert np.abs(values - true[: len(values)]).max(initial=0) <= 1e-11 * max(1, a.max())
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) <= 1e-12
    assert np.abs(a @ vectors - vectors * values).max(initial=0) <= 1e-11 * max(1, a.max())


def test_sturm_counts():
    diagonal, off, _ = whiten.tridiagonal(MATRICES["plain"])
    true = np.linalg.eigvalsh(MATRICES["plain"])
    at = np.linspace(0, 110, 37)
    assert whiten.smaller(diagonal, off, at).tolist() == [(true < value).sum() for value in at]


def _brute(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    mean = fit.mean(axis=0)
    values, components = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    values, components = values[::-1][:k], components[:, ::-1][:, :k]
    sums = fit.sum(axis=0)
    deviations = [sum((len(fit) * int(e) - int(s)) ** 2 for e, s in zip(row, sums)) for row in x]
    return len(fit), deviations, (x - mean) @ components / np.sqrt(values), values


def _checked(spark, rows, vectors, k=16):
    """Rows (vec_id, component, n, deviation, whitened, ...) against numpy, up to the sign of a component."""
    n, deviations, white, values = _brute(vectors, k)
    k = white.shape[1]
    got = np.zeros((len(vectors), k))
    for r in rows:
        assert (r.n, r.deviation) == (n, deviations[r.vec_id])
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.identity_error < 1e-9
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-6
    return values


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    data = sorted(spark.read.parquet(f"{folder}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    assert [r.vec_id for r in data] == list(range(len(data)))
    rows = LLM_QUERIES["op13_whitening"](spark, folder).collect()
    assert len(rows) == 16 * len(data)
    values = _checked(spark, rows, [r.embedding for r in data])
    x = np.floor(64 * np.array([r.embedding for r in data], float))
    trace = np.trace(np.cov(x.T, bias=True))
    for r in rows:
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [list(map(float, row)) for row in RANDOM.normal(size=(30, 5))]
    good = [*base, base[0], base[0], base[0]]  # a repeated vector weighs once
    odd = [None, [nan, 1.0], [1.0, None, 2.0], [inf] * 5, [-inf] * 5]
    rows = [(i, v, "w") for i, v in enumerate([*good, *odd])] + [(None, good[1], "w")]
    df = spark.createDataFrame(rows, "vec_id long, Embedding array<double>, WHITE string").repartition(4)
    fitted = whiten.fit_whitening(df, "Embedding")
    found = whiten.whiten(df, fitted, "Embedding")
    assert found.columns == ["vec_id", "WHITE", "_white"]
    kept = found.collect()
    assert sorted(-1 if r.vec_id is None else r.vec_id for r in kept) == [-1, *range(len(good))]
    n, deviations, white, _ = _brute(good, 16)
    assert fitted.n == n == 30 and fitted.identity_error < 1e-9
    for r in kept:
        i = 1 if r.vec_id is None else r.vec_id
        assert r._white.deviation == deviations[i] and r.WHITE == "w"
        assert np.allclose(np.abs(r._white.whitened), np.abs(white[i]), atol=1e-7)


def test_order_and_partitions_do_not_matter(spark):
    data = [(i, list(map(float, row))) for i, row in enumerate(RANDOM.normal(size=(200, 6)))]
    a = whiten.fit_whitening(spark.createDataFrame(data, "id long, v array<double>").repartition(1), "v")
    b = whiten.fit_whitening(spark.createDataFrame(data[::-1], "id long, v array<double>").repartition(7), "v")
    assert a.sums == b.sums and (a.values == b.values).all() and (a.vectors == b.vectors).all()


@pytest.mark.parametrize(
    "vectors, components",
    [([], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([[]], 0), ([[1.0], [1.0, 3.0], []], 2), ([[0.0, 0.0], [1.0, 1.0]], 1)],
)
def test_small_tables(spark, vectors, components):
    df = spark.createDataFrame(list(enumerate(vectors)), "id long, v array<double>")
    fitted = whiten.fit_whitening(df, "v")
    found = whiten.whiten(df, fitted, "v").collect()
    assert len(found) == len(vectors) and len(fitted.values) == components
    assert all(len(r.white.whitened) == components for r in found)


def test_large_deviations_stay_exact():
    x = np.array([[2**40, 5], [7, -(2**35)]])
    n, sums = 10**9, [2**40 + 7, 5 - 2**35]
    assert whiten._deviations(x, n, sums) == [sum((n * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x]
