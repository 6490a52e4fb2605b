import math
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm.qdwh import eigen, polar_sign
from millrace.llm.whitening import fit_whitening, op12_whitening, packed, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def random_matrices():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    yield np.zeros((0, 0))
    yield np.array([[3.0]])
    yield np.eye(9) * 2
    yield np.zeros((5, 5))
    yield q @ np.diag([5.0] * 10 + [1.0] * 14) @ q.T
    yield q @ np.diag(10.0 ** -np.arange(24)) @ q.T
    yield q @ np.diag([1.0] + [0.0] * 23) @ q.T
    yield q @ np.diag(1 + 1e-13 * np.arange(24)) @ q.T
    yield q @ np.diag([-3.0, 7.0] + [0.5] * 22) @ q.T
    for d in (2, 5, 64):
        x = rng.standard_normal((3 * d, d))
        yield x.T @ x


@pytest.mark.parametrize("a", list(random_matrices()), ids=lambda a: str(len(a)))
def test_eigenvectors(a):
    values, vectors = eigen(a)
    scale = max(np.abs(a).max(initial=0), 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max(initial=0) < 1e-14
    assert np.abs(a @ vectors - vectors * values).max(initial=0) < 1e-13 * scale
    assert np.abs(np.sort(np.linalg.eigvalsh(a))[::-1] - values).max(initial=0) < 1e-13 * scale * max(len(a), 1)


def test_sign():
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    values = np.array([1e-9, -1e-9, 3, -4, 1e3, -1e3, 1, 1, -1, 2, 5, -6])
    assert np.abs(polar_sign(q @ np.diag(values) @ q.T) - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-3
    assert np.abs(polar_sign(np.diag([2.0, -3.0])) - np.diag([1, -1])).max() < 1e-15


def plainly(rows, components=4):
    """The contract with exact sums and a library's eigenvectors."""
    kept = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-9 * np.trace(covariance)]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        moved = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)])
        for c, k in enumerate(order):
            out.setdefault((i, c + 1), []).append((n, deviation, moved @ vectors[:, k] / np.sqrt(values[k]), values[k] / np.trace(covariance)))
    return out


def compared(found, expected):
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.component), []).append(r)
    assert {k: len(v) for k, v in by.items()} == {k: len(v) for k, v in expected.items()}
    signs = {}
    for (i, c), rows in by.items():
        rows = sorted(rows, key=lambda r: (r.deviation, abs(r.whitened)))
        for r, (n, deviation, whitened, explained) in zip(rows, sorted(expected[i, c], key=lambda e: (e[1], abs(e[2]))), strict=True):
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(explained, rel=1e-10)
            if abs(whitened) > 1e-6:
                assert signs.setdefault(c, r.whitened * whitened > 0) == (r.whitened * whitened > 0)
            assert abs(r.whitened) == pytest.approx(abs(whitened), rel=1e-7, abs=1e-8)
            assert r.identity_error < 1e-9


def test_against_a_library(sample):
    df = sample("embeddings")
    compared(op12_whitening(df).collect(), plainly([(r.vec_id, r.embedding) for r in df.collect()]))


def test_edges(sp):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 5)], 1) for i in range(40)]
    rows += [(1, None, 1), (2, [], 1), (3, [nan] * 5, 1), (4, [0.0, inf, 0.0, 0.0, 0.0], None), (5, [0.1, None, 0.1, 0.1, 0.1], 2)]
    rows += [(None, [0.5, -0.5, 0.25, 0.0, -0.0], None), (7, [0.5, -0.5, 0.25, 0.0, 0.0], 3), rows[0], rows[0], (9, [1.0] * 4, 1)]
    df = sp.createDataFrame(rows, SCHEMA).repartition(3)
    expected = plainly([(i, v) for i, v, _ in rows if v is None or len(v) == 5])
    compared(op12_whitening(df).collect(), expected)
    assert op12_whitening(sp.createDataFrame([], SCHEMA)).collect() == []
    for few in ([(1, None, 1)], [(1, [], 1)], [(1, [0.5, 0.5], 1)], [(1, [0.5], 1), (2, [0.501], 1)]):
        assert op12_whitening(sp.createDataFrame(few, SCHEMA)).collect() == []
    two = [(1, [0.5, 0.0, 7.0], 1), (2, [0.0, 0.5, 7.0], 1)]
    compared(op12_whitening(sp.createDataFrame(two, SCHEMA)).collect(), plainly([(i, v) for i, v, _ in two]))


def test_wide_values(sp):
    """Steps of every width, sums beyond a long."""
    rows = [(1, [1.0, 2.0]), (2, [300.0, -300.0]), (3, [3e4, 300.0]), (4, [1e16, -1e16]), (5, [1e16, 1e16]), (6, [1e300, 0.0])]
    df = sp.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = fit_whitening(df)
    assert model.n == 5 and model.sums == [sum(math.floor(256 * v[k]) for _, v in rows[:5]) for k in (0, 1)]
    found = {r.vec_id: r for r in whiten(df, model).collect()}
    assert set(found) == {1, 2, 3, 4, 5} and all(r.deviation is None for r in found.values())
    small = sp.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    compared(op12_whitening(small).collect(), plainly(rows[:3]))
    assert [len(packed(np.array(v))) for v in ([32767, -32768], [32768, 0], [1 << 31, 0])] == [4, 8, 16]


def test_clashing_names(sp):
    df = sp.createDataFrame([(1, [0.5, 0.0], "w"), (2, [0.0, 0.5], "x")], "vec_id long, embedding array<float>, whitened string")
    found = whiten(df, fit_whitening(df))
    assert found.columns == ["vec_id", "embedding", "whitened", "whitened_", "deviation"]
    assert {(r.whitened, len(r["whitened_"])) for r in found.collect()} == {("w", 1), ("x", 1)}
