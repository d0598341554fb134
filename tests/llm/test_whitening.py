import math

import numpy as np
import pytest

from quarry.llm import whitening as W

ODD = [(900, None), (901, []), (902, [1.0, None, 0.0]), (903, [1.0, math.nan, 0.0]), (904, [1.0, math.inf, 0.0]),
       (905, [1.0, 2.0]), (906, [1e30, 0.0, 0.0])]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "z", "y") for i, v in rows],
                                 "vec_id long, embedding array<double>, label int, vec string, n string")


def expected(rows, k=32):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    n = len(x)
    total = x.sum(axis=0)
    deviation = ((n * x - total) ** 2).sum(axis=1)
    y = (x * n - total).astype(float) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    keep = np.argsort(-e)[:k]
    keep = keep[e[keep] > 1e-10 * e.max()]
    return n, deviation, e[keep], u[:, keep], y, np.trace(v)


def check(got, rows, k=32, tolerance=1e-8):
    n, deviation, e, u, y, trace = expected(rows, k)
    w = y @ u / np.sqrt(e)
    place = {i: p for p, (i, _) in enumerate(rows)}
    assert len(got) == len(rows) * len(e)
    mine = np.zeros((len(rows), len(e)))
    for r in got:
        p, c = place[r["vec_id"]], r["component"] - 1
        mine[p, c] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[p]
        assert abs(r["explained"] - e[c] / trace) <= 1e-9 * e[c] / trace
        assert r["identity_error"] <= 1e-4
    signs = np.sign((mine * w).sum(axis=0))
    assert np.abs(mine * signs - w).max() < tolerance
    return mine


def test_equals_eigendecomposition(spark):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((48, 48))
    rows = [(i, (rng.standard_normal(48) @ mix + 5).tolist()) for i in range(700)]
    got = W.whiten(table(spark, rows).repartition(7)).collect()
    assert {r["component"] for r in got} == set(range(1, 33))
    mine = check(got, rows)
    assert np.abs(mine.T @ mine / len(rows) - np.eye(32)).max() < 1e-6


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(50)]
    check(W.whiten(table(spark, rows + ODD)).collect(), rows)


def test_null_ids_and_repeated_rows_count(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, 5.0]), (4, [7.0, 1.0])]
    got = W.whiten(table(spark, rows)).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    assert sum(r["vec_id"] is None for r in got) == 2


@pytest.mark.parametrize("rows", [[], ODD[:2], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]])
def test_nothing_to_whiten(spark, rows):
    df = W.whiten(table(spark, rows))
    assert df.collect() == [] and df.columns[:3] == ["vec_id", "component", "n"]


def test_dependent_dimensions(spark):
    """A constant and a repeated dimension have no component of their own."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(a), float(b), 3.0, float(a)]) for i, (a, b) in enumerate(rng.integers(-9, 9, (80, 2)))]
    got = W.whiten(table(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2}
    check(got, rows)


def test_deviation_beyond_a_long(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [5.0, -7.0])]
    got = W.whiten(table(spark, rows)).collect()
    deviation = expected(rows)[1]
    assert {r["vec_id"]: int(r["deviation_digits"]) for r in got if r["deviation"] is None} == \
        {i + 1: d for i, d in enumerate(deviation) if d >= 1 << 63}
    assert any(r["deviation"] is None for r in got)


@pytest.mark.parametrize("values", [[5.0] * 20 + [1.0] * 50, [80 * 0.5 ** i for i in range(40)],
                                    [*range(1, 40), *[7] * 40], [1e6, *[1e-3 * i for i in range(1, 60)]], [3.0, 0.0, 0.0]])
def test_contours_find_every_eigenvalue(values):
    """Clusters, equal eigenvalues and ones of very different size."""
    rng = np.random.default_rng(6)
    size = len(values)
    q, _ = np.linalg.qr(rng.standard_normal((size, size)))
    v = (q * np.array(values)) @ q.T
    v = (v + v.T) / 2
    found, vectors = zip(*(W.contour(v, *part) for part in W.slices(v, 32)), strict=True)
    found, vectors = np.concatenate(found), np.hstack(vectors)
    exact = np.sort([x for x in values if x])[::-1]
    assert len(found) >= min(32, len(exact))
    assert np.abs(found - exact[:len(found)]).max() < 1e-12 * max(values) * size
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12 * max(values) * size


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        W.contour(np.diag([1.0, 2.0, 30.0]), 0.5, 2.5, 3)
