"""Whitening: exact sums, eigenvectors of clustered spectra, unit covariance, odd vectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from costpulse.llm import queries, whitening as W

SF = "/root/testdata/sf0.01"
SHAPE = "vec_id long, embedding array<float>, label int, whitened double"


def _spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.arange(1, 41.0), np.r_[np.ones(6), 2 * np.ones(6), np.arange(3, 23.0)],
    np.r_[1 + 1e-9 * np.arange(8), 5 + 1e-13 * np.arange(6), np.arange(10, 20.0)],
    np.r_[np.ones(12), 0, 0, 0, 1e-8, 1e6], np.ones(9), np.array([3.0]),
    np.r_[1 + 1e-5 * np.arange(10), 1 + 1e-7 * np.arange(10)]])
def test_refined_vectors_have_double_precision(values):
    a = _spectrum(values)
    e, x = W.refined(a)
    wide, al = x.astype(np.longdouble), a.astype(np.longdouble)
    scale = np.abs(a).max()
    assert np.abs(al @ wide - wide * e).max() <= 2e-15 * scale
    assert np.abs(wide.T @ wide - np.eye(len(a))).max() <= 1e-15
    assert (np.diff(e) <= 0).all()
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * scale * len(a)
    # a float32 start alone is far from that
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    if len(np.unique(values)) == len(values) > 30:
        assert np.abs(start.T @ start - np.eye(len(a))).max() > 1e-9


def _brute(vectors):
    """n, S, exact covariance of the distinct x vectors."""
    x = sorted({tuple(math.floor(64 * float(c)) + 1000000 for c in v) for v in vectors})
    n, d = len(x), len(x[0])
    s = [sum(v[i] for v in x) for i in range(d)]
    cov = [[sum((v[i] - Fraction(s[i], n)) * (v[j] - Fraction(s[j], n)) for v in x) / n
            for j in range(d)] for i in range(d)]
    return x, n, s, cov


def _checked(rows, vectors, most=16):
    """Compares result rows with brute force; ``vectors``: id -> float32 values."""
    x, n, s, cov = _brute(vectors.values())
    d = len(s)
    v = np.array([[float(c) for c in row] for row in cov])
    k = min(most, d)
    assert len(rows) == k * len(vectors)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    p = np.array([[by[i, c]["whitened"] for c in range(1, k + 1)] for i in vectors])
    xs = np.array([[math.floor(64 * float(c)) + 1000000 for c in u] for u in vectors.values()])
    y = xs - np.array([float(Fraction(t, n)) for t in s])
    e = np.linalg.eigvalsh(v)[::-1]
    basis = np.linalg.lstsq(y, p, rcond=None)[0]          # eigenvectors over their roots
    for c in range(k):
        assert np.allclose(v @ basis[:, c], e[c] * basis[:, c], atol=1e-6 * e[0] * np.abs(basis).max())
        assert np.linalg.norm(basis[:, c]) * math.sqrt(e[c]) == pytest.approx(1, abs=1e-6)
        explained = by[next(iter(vectors)), c + 1]["explained"]
        assert explained == pytest.approx(e[c] / np.trace(v), rel=1e-9)
    first = {tuple(u): row for u, row in zip(xs.tolist(), p)}
    w = np.array([first[u] for u in x])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-9
    for i, u in zip(vectors, xs.tolist()):
        assert by[i, 1]["deviation"] == sum((n * a - b) ** 2 for a, b in zip(u, s))
        assert by[i, 1]["n"] == n and by[i, 1]["identity_error"] < 1e-9


def test_registered_query_equals_brute_force(llm):
    table = llm.read.parquet(f"{SF}/embeddings.parquet").limit(150).collect()
    vectors = {r["vec_id"]: r["embedding"] for r in table}
    rows = W.whitened(llm.createDataFrame(table, llm.read.parquet(f"{SF}/embeddings.parquet").schema)).collect()
    _checked(rows, vectors)
    whole = queries.op12_whitening(llm, SF)
    assert whole.count() == 16 * llm.read.parquet(f"{SF}/embeddings.parquet").count()
    assert whole.agg({"identity_error": "max"}).first()[0] < 1e-9


def test_odd_vectors_copies_and_clashing_columns(llm):
    rng = np.random.default_rng(5)
    good = {i: [float(np.float32(c)) for c in rng.normal(size=3)] for i in range(20)}
    good |= {100 + i: good[0] for i in range(50)}                     # copies
    odd = [(900, None), (901, []), (902, [None, 1.0, 1.0]), (903, [float("nan"), 0.0, 0.0]),
           (904, [float("inf"), 0.0, 0.0]), (905, [1.0, 2.0])]
    df = llm.createDataFrame([(i, v, 1, 0.5) for i, v in [*good.items(), *odd]], SHAPE)
    rows = W.whitened(df).collect()
    assert {r["vec_id"] for r in rows} == set(good)
    _checked(rows, good)
    twice = W.whitened(df.union(df)).collect()
    assert len(twice) == 2 * len(rows) and twice[0]["n"] == rows[0]["n"] == 20
    assert W.whitened(df.limit(0)).count() == 0
    assert W.whitened(df.filter("vec_id >= 100 and vec_id < 150")).count() == 0     # no variance


def test_large_entries_stay_exact(llm):
    values = {1: [2.0 ** 40, 1.0], 2: [-2.0 ** 40, 3.0], 3: [2.0 ** 39, -2.0], 4: [0.0, 0.5]}
    rows = W.whitened(llm.createDataFrame([(i, v, 0, 0.0) for i, v in values.items()], SHAPE)).collect()
    x, n, s, _ = _brute(values.values())
    for r in rows:
        want = sum((n * (math.floor(64 * c) + 1000000) - t) ** 2 for c, t in zip(values[r["vec_id"]], s))
        assert r["deviation"] == (want if want < 1 << 63 else None)
    assert {r["component"] for r in rows} == {1}     # the second's variance is below double precision
    assert W.whole(np.array([1e300, -1e300, 0.1, -0.1])).tolist() == [
        (1 << 63) - 1, -(1 << 63), 1000006, 999993]
