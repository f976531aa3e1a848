import math
from fractions import Fraction

import numpy as np
import pytest

from quarterline.llm.whitening import Slice, inertia, isolate, leading, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], schema)


def vectors(n, d, seed):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, d)) @ r.standard_normal((d, d)) * 0.3 + r.standard_normal(d)).astype(np.float32)


def checked(got, rows, components):
    """Against numpy's eigenvectors of the covariance, and whole-number deviations."""
    ids, x = [i for i, _ in rows], [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    y = np.array([[float(Fraction(c * n - s, n)) for c, s in zip(v, sums)] for v in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, d)
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by) == sorted(ids) and all(sorted(c) == list(range(1, k + 1)) for c in by.values())
    w = np.array([[by[i][c].whitened for c in range(1, k + 1)] for i in ids])
    want = y @ q[:, :k] / np.sqrt(e[:k])
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w - want * sign).max() < 1e-8
    assert np.abs(w.T @ w / n - np.eye(k)).max() <= got[0].identity_error + 1e-12 and got[0].identity_error < 1e-9
    for i, v in zip(ids, x):
        assert {r.deviation for r in by[i].values()} == {sum((n * c - s) ** 2 for c, s in zip(v, sums))}
    assert {r.n for r in got} == {n}
    assert np.allclose([by[ids[0]][c].explained for c in range(1, k + 1)], e[:k] / e.sum(), rtol=1e-10)


@pytest.mark.parametrize("n, d, components", [(400, 12, 32), (300, 48, 32), (50, 5, 2)])
def test_equals_eigenvectors_of_the_covariance(spark, n, d, components):
    rows = [(i * 3, [float(c) for c in v]) for i, v in enumerate(vectors(n, d, n))]
    checked(whiten(frame(spark, rows).repartition(5), components).collect(), rows, components)


def test_dropped_rows_ties_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors(60, 4, 9))]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [nan, 1.0, 1.0, 1.0]), (104, [1.0, -inf, 1.0, 1.0]),
           (105, [1.0, 2.0]), (106, [0.0] * 4), (107, rows[3][1])]
    from pyspark.sql import functions as F
    df = frame(spark, rows + odd).withColumns({c: F.lit(1) for c in ("x", "n", "d", "i", "component")})
    checked(whiten(df).collect(), rows + odd[-2:], 32)
    again = whiten(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, whiten(df).collect()))  # exact sums: no order of tasks shows


def test_large_numbers_are_exact(spark):
    rows = [(i, [float(c) * 1e5 for c in v]) for i, v in enumerate(vectors(40, 3, 4))]
    checked(whiten(frame(spark, rows, "vec_id long, embedding array<double>, label int")).collect(),
            rows, 32)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    got = whiten(frame(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 0


def test_null_ids_and_flat_directions(spark):
    rows = [(None, [1.0, 5.0, 2.0]), (1, [2.0, 5.0, 2.0]), (1, [4.0, 5.0, 1.0]), (2, [0.0, 5.0, 9.0])]
    got = whiten(frame(spark, rows)).collect()
    assert sorted({(r.vec_id or 0) for r in got}) == [0, 1, 2] and len(got) == 8  # the flat direction has no component


def test_inertia_slices_and_pairs_of_hard_spectra():
    r = np.random.default_rng(1)
    for k in range(60):
        d = int(r.integers(1, 25))
        u = r.choice([0.0, 1, 1, 1 + 1e-12, 2, 5], d) if k % 3 else r.exponential(1, d)
        q = np.linalg.qr(r.standard_normal((d, d)))[0]
        a = (q * u) @ q.T
        a = (a + a.T) / 2
        for s in r.uniform(-1, 6, 5):
            assert inertia(a, s) == (u > s).sum()
        slices = isolate(a, d)
        assert [s.first for s in slices] == [1, *[s.last + 1 for s in slices[:-1]]] and slices[-1].last == d
        values, vec = leading(a, d)
        assert np.abs(values - np.sort(u)[::-1]).max() < 1e-11
        assert np.abs(vec.T @ vec - np.eye(d)).max() < 1e-11 and np.abs(a @ vec - vec * values).max() < 1e-10


def test_inertia_of_zero_diagonals():
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # a 2 x 2 pivot
    assert inertia(np.zeros((3, 3)), 0.0) == 0 and inertia(np.zeros((3, 3)), -1.0) == 3
    assert isolate(np.zeros((2, 2)), 2)[0] == Slice(*[isolate(np.zeros((2, 2)), 2)[0].low, isolate(np.zeros((2, 2)), 2)[0].high], 1, 2)
