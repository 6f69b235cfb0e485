import math
import random

import numpy as np
import pytest

from maskloom.llm.eigen import bisect, count_below, leading, tridiagonal
from maskloom.llm.vectors import exact_product
from maskloom.llm.whiten import whiten

SCHEMA = "vec_id long, embedding array<float>, label int, n int, component string"


def cases():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 40, 64):
        m = rng.standard_normal((n, n + 3))
        yield f"random{n}", m @ m.T
    yield "zero", np.zeros((5, 5))
    yield "identity", 3.0 * np.eye(20)
    yield "diagonal", np.diag([5.0, 1, 5, 2, 0, 5])
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    yield "cluster", q @ np.diag([9.0] * 5 + [9 - 1e-9] * 3 + [9 - 1e-4] * 2 + [1.0] * 15 + [0.0] * 5) @ q.T
    yield "far", q @ np.diag(10.0 ** -np.arange(30)) @ q.T
    yield "large", 1e12 * (q @ np.diag(np.arange(30.0)) @ q.T)


@pytest.mark.parametrize("name, a", list(cases()), ids=lambda x: x if isinstance(x, str) else "")
def test_leading_eigenpairs(name, a):
    k = min(32, len(a))
    values, vectors = leading(a, k)
    scale = max(np.abs(a).max(), 1e-300)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-13 * len(a) * scale)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * len(a) * scale


def test_sturm_counts():
    rng = np.random.default_rng(4)
    m = rng.standard_normal((25, 25))
    a = m + m.T
    d, e, _ = tridiagonal(a)
    real = np.linalg.eigvalsh(a)
    x = np.linspace(-15, 15, 200)
    assert count_below(d, e**2, x, 1e-300).tolist() == [int((real < v).sum()) for v in x]
    assert np.allclose(bisect(d, e, 25), real[::-1])


def test_exact_products_at_every_width():
    for most in (10, 1 << 25, 1 << 30, 1 << 40):
        rng = random.Random(most)
        a = [[rng.randint(-most, most) for _ in range(5)] for _ in range(4)]
        b = [[rng.randint(-most, most) for _ in range(3)] for _ in range(5)]
        want = [[sum(x * b[k][j] for k, x in enumerate(row)) for j in range(3)] for row in a]
        assert exact_product(np.array(a), np.array(b)).tolist() == want


def check(df, rows, components):
    """Against numpy on the rows as given: exact parts equal, the rest by what defines it."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, total = len(x), x.sum(axis=0)
    centred = (x - total / n).astype(float)
    cov = centred.T @ centred / n
    want = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, int((want > 1e-12 * want[0]).sum()))
    out = df.collect()
    assert len(out) == n * k and {r["n"] for r in out} == {n}
    exact = {}
    for (i, _), row in zip(rows, x):
        far = int(((n * row - total) ** 2).sum())
        exact.setdefault(i, []).append(far if far < 1 << 63 else -1)
    by = {}
    for r in out:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, values in exact.items():
        for c in range(1, k + 1):
            assert sorted(-1 if r["deviation"] is None else r["deviation"] for r in by[i, c]) == sorted(values)
    for c in range(1, k + 1):
        assert all(abs(r["explained"] - want[c - 1] / np.trace(cov)) < 1e-10 for r in out if r["component"] == c)
    assert len({r["identity_error"] for r in out}) == 1 and out[0]["identity_error"] < 1e-9
    if len(exact) == n:
        w = np.array([[by[i, c][0]["whitened"] for c in range(1, k + 1)] for i, _ in rows])
        assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9 and np.abs(w.mean(axis=0)).max() < 1e-9
        # whitened = centred u / sqrt(e), so cov' w gives u back
        u = centred.T @ w / n / np.sqrt(want[:k])
        assert np.abs(cov @ u - u * want[:k]).max() < 1e-9 * want[0]


def random_rows(n, d, seed):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) / d
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(mixed)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("n, d, k", [(300, 40, 32), (50, 3, 32), (20, 64, 32), (200, 8, 2)])
def test_whitening(spark, n, d, k):
    rows = random_rows(n, d, n)
    check(whiten(frame(spark, rows), components=k), rows, k)


def test_odd_rows(spark):
    rows = random_rows(60, 4, 1)
    odd = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0]), (903, [1.0, float("nan"), 2.0, 3.0]),
           (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [1.0, 2.0]), (906, [1.0] * 5)]
    check(whiten(frame(spark, rows + odd), components=4), rows, 4)


def test_repeated_and_hot_rows(spark):
    rows = random_rows(40, 4, 2)
    rows += [rows[3]] * 60 + [(None, rows[0][1]), (None, rows[1][1])]
    check(whiten(frame(spark, rows), components=4), rows, 4)


@pytest.mark.parametrize("size", [2.0**19, 2.0**24])
def test_wide_entries_stay_exact(spark, size):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * size for _ in range(3)]) for i in range(50)]
    check(whiten(frame(spark, rows), components=3), rows, 3)


def test_nothing_to_whiten(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert whiten(frame(spark, [(1, None)])).count() == 0
