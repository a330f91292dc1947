"""Whitening against plain exact arithmetic, and the eigenvector refinement
on spectra with clusters."""

import math
from fractions import Fraction

import numpy as np
import pytest

from salesmart.llm import whitening as wh
from salesmart.llm.queries import QUERIES
from tests.conftest import SF01


def rotation(rng, n):
    """An orthogonal matrix to extended precision."""
    q = np.linalg.qr(rng.normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ ((np.eye(n) - q.T @ q) / 2)
    return q


@pytest.mark.parametrize("spectrum", [
    [9, 7, 4, 2, 1, 0.5],
    [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5 - 1e-13, 0.1],
    [5, 5, 5, 1, 1, 0],
    [1e6, 1, 1 - 1e-7, 1e-6, 0, 0],
    [2.0] * 6,
    [1 - 1e-10 * k for k in range(24)],
    list(np.linspace(3, 1, 40)),
])
def test_refinement_reaches_double_precision(spectrum):
    rng = np.random.default_rng(len(spectrum))
    q, want = rotation(rng, len(spectrum)), np.array(spectrum, np.longdouble)
    a = (q * want) @ q.T
    a = (a + a.T) / 2
    values, x = wh.refined_eigen(a)
    size = max(abs(want))
    assert np.abs(np.sort(values) - np.sort(want)).max() < 1e-17 * size
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17
    assert np.abs(a @ x - x * values).max() < 1e-17 * size
    assert (np.diff(values.astype(float)) <= 0).all()
    # Vectors of eigenvalues well apart are the ones built in.
    for k, v in enumerate(want):
        if np.sort(np.abs(want - v))[1] > 1e-10 * size:
            assert 1 - abs((x.T @ q[:, k])).max() < 1e-13


def test_float32_alone_would_not_do():
    rng = np.random.default_rng(1)
    q, want = rotation(rng, 12), np.linspace(2, 1, 12).astype(np.longdouble)
    a = (q * want) @ q.T
    x32 = np.linalg.eigh(a.astype(np.float32))[1]
    assert np.abs(a @ x32 - x32 * np.einsum("ij,ij->j", x32, a @ x32)).max() > 1e-9
    assert np.abs(a @ wh.refined_eigen(a)[1] - wh.refined_eigen(a)[1] * wh.refined_eigen(a)[0]).max() < 1e-17


def brute(rows, components=32):
    """{vec_id: (deviation, whitened...)} with exact moments and an ordinary
    eigensolver on them."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    s = [sum(x[k] for _, x in kept) for k in range(d)]
    centred = [[n * x[k] - s[k] for k in range(d)] for _, x in kept]
    cov = np.array([[float(Fraction(sum(c[i] * c[j] for c in centred), n ** 3)) for j in range(d)] for i in range(d)])
    value, vector = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-value) if value[k] > 1e-9 * value.max()][:components]
    y = np.array([[c / n for c in row] for row in centred])
    out = y @ vector[:, order] / np.sqrt(value[order])
    return n, [sum(c * c for c in row) for row in centred], out, value[order] / np.trace(cov), [i for i, _ in kept]


def check(got, rows, tolerance=1e-8):
    n, deviation, want, share, ids = brute(rows)
    k = want.shape[1]
    assert len(got) == len(ids) * k and {r.component for r in got} == set(range(1, k + 1))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    sign = None
    for i, dev, w in zip(ids, deviation, want):
        mine = np.array([by[i][c].whitened for c in range(1, k + 1)])
        if sign is None:
            sign = {c: 0 for c in range(k)}
        for c in range(k):
            if not sign[c] and abs(w[c]) > 1e-6:
                sign[c] = 1 if mine[c] * w[c] > 0 else -1
            assert abs(mine[c] * (sign[c] or 1) - w[c]) < tolerance * max(1, abs(w[c]))
        assert by[i][1].deviation == dev and by[i][1].n == n
    assert all(abs(r.explained - share[r.component - 1]) <= 1e-9 * share[r.component - 1] for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    check(QUERIES["op13_whitening"](spark, SF01).collect(), rows)


SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c") for i, v in rows], SCHEMA).repartition(3)


def test_defined_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(size=6) * [5, 3, 2, 1, 0.5, 0]]) for i in range(200)]
    bad = [(900, None), (901, [1.0, None] + [0.0] * 4), (902, [float("nan")] + [0.0] * 5), (903, [float("inf")] * 6),
           (904, [0.0] * 5 + [float("-inf")])]
    got = wh.whitened(frame(spark, rows + bad)).collect()
    check(got, rows + bad)
    assert max(r.component for r in got) == 5  # the constant dimension has no component
    again = wh.whitened(frame(spark, rows + rows + [(None, rows[0][1])])).collect()
    assert len(again) == 5 * 401 and sum(r.vec_id is None for r in again) == 5
    assert len({round(r.whitened, 9) for r in again if r.vec_id in (0, None) and r.component == 1}) == 1
    for none in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)], [(1, [])]):
        assert wh.whitened(frame(spark, none)).isEmpty()
    with pytest.raises(Exception, match="different lengths"):
        wh.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0])])).collect()


def test_wide_values_stay_exact(spark):
    rows = [(i, [float(v), float(w)]) for i, (v, w) in enumerate([(1e9, 1), (-1e9, 2), (3e8, -5), (0, 0)])]
    got = wh.whitened(frame(spark, rows)).collect()
    n, deviation, want, share, ids = brute(rows)
    assert {r.deviation for r in got} == {None}  # beyond 64 bits
    assert all(abs(r.explained - share[r.component - 1]) < 1e-9 for r in got)
    few = [(i, [float(v), float(w)]) for i, (v, w) in enumerate([(1e6, 1e4), (-1e6, 2e4), (3e5, -5e4), (0, 0)])]
    check(wh.whitened(frame(spark, few)).collect(), few, 1e-6)
