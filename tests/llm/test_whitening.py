"""Whitening against the eigenvectors of the whole covariance, and edge cases."""

import math

import numpy as np
import pytest

from fieldbook.llm import whitening
from fieldbook.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, row string, x string, n string, whitened string"


def plain(vectors):
    """Integers, deviations, eigenvalues and eigenvectors (as rows) by one dense decomposition."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = (n * x - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, deviation, values[::-1], vectors.T[::-1]


def check(found, vectors, k):
    centred, deviation, values, basis = plain([vectors[r.row.vec_id] for r in found])
    n, trace = len(found), values.sum()
    y = np.array([r.whitened for r in found])
    assert y.shape == (n, k)
    assert [r.deviation for r in found] == deviation and {r.n for r in found} == {n}
    np.testing.assert_allclose(found[0].explained, values[:k] / trace, rtol=1e-9)
    assert np.abs(y.T @ y / n - np.eye(k)).max() < 1e-9 and {r.identity_error for r in found}.pop() < 1e-9
    gaps = np.abs(np.subtract.outer(values, values) + np.diag(np.full(len(values), np.inf)))[:k].min(1)
    for c in range(k):
        want = centred @ basis[c] / math.sqrt(values[c])
        same = min(np.abs(want - y[:, c]).max(), np.abs(want + y[:, c]).max())
        assert same < 1e-6 * max(1.0, values[0] / gaps[c] * 1e-3)


def test_whole_table(spark, sf):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    rows = QUERIES["op12_lanczos_whitening"](spark, sf).collect()
    good = {k: v for k, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    assert len(rows) == 32 * len(good)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert by_id.keys() == good.keys() and all(sorted(v) == list(range(1, 33)) for v in by_id.values())
    ids = sorted(good)
    centred, deviation, values, basis = plain([good[i] for i in ids])
    assert [by_id[i][1].deviation for i in ids] == deviation
    for c in range(32):
        want = centred @ basis[c] / math.sqrt(values[c])
        got = np.array([by_id[i][c + 1].whitened for i in ids])
        assert min(np.abs(want - got).max(), np.abs(want + got).max()) < 1e-6
        assert by_id[ids[0]][c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
    assert {r.n for r in rows} == {len(ids)} and {r.identity_error for r in rows}.pop() < 1e-9


def test_incomplete_and_unusual_vectors(store):
    rng = np.random.default_rng(5)
    vectors = {k: [float(np.float32(c)) for c in rng.normal(size=6) * [9, 5, 3, 2, 1, .5]] for k in range(60)}
    vectors[7] = vectors[3]
    rows = [(k, v) for k, v in vectors.items()]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [math.nan] * 6), (103, [math.inf] * 6), (104, []), (105, [1.0, 2.0])]
    made = store([r + (0, "r", "x", "n", "w") for r in rows], VECTORS)
    found = sorted(whitening.whitened(made).collect(), key=lambda r: r.row.vec_id)
    assert [r.row.vec_id for r in found] == sorted(vectors) and {r.row.x for r in found} == {"x"}
    check(found, vectors, 6)
    early = sorted(whitening.whitened(made, components=2, still=1e-12).collect(), key=lambda r: r.row.vec_id)
    check(early, vectors, 2)


def test_few_directions(store):
    rng = np.random.default_rng(6)
    flat = {k: [float(a), float(a), float(b), 1.0, 0.0] for k, (a, b) in enumerate(rng.integers(-9, 9, (40, 2)))}
    found = sorted(whitening.whitened(store([(k, v, 0, "", "", "", "") for k, v in flat.items()], VECTORS)).collect(), key=lambda r: r.row.vec_id)
    check(found, flat, 2)
    # Equal eigenvalues: the four corners spread alike in every direction.
    corners = {k: [float(a), float(b)] for k, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)])}
    found = whitening.whitened(store([(k, v, 0, "", "", "", "") for k, v in corners.items()], VECTORS)).collect()
    y = np.array([r.whitened for r in found])
    assert y.shape == (4, 2) and np.abs(y.T @ y / 4 - np.eye(2)).max() < 1e-9
    alike = whitening.whitened(store([(k, [1.0, 2.0], 0, "", "", "", "") for k in range(3)], VECTORS)).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in alike] == [(3, 0, [], 0.0)] * 3
    assert whitening.whitened(store([], VECTORS, 1)).collect() == []


def test_exact_deviations_of_large_integers():
    x = np.array([[1 << 60, 5], [3, -(1 << 61)]])
    sums = [int(s) for s in x.sum(0)]
    assert whitening.centred(x, 2, sums).tolist() == [[2 * int(a) - s for a, s in zip(r, sums)] for r in x]
