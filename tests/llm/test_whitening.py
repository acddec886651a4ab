import math

import numpy as np
import pytest

from tessera.llm import whitening as W


def fit_of(rows, scale=256):
    whole = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows
             if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return whole, sorted({tuple(x) for _, x in whole})


def exact_covariance(fit):
    n, dim = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dim)]
    return n, sums, np.array([[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit) / n**3 for j in range(dim)] for i in range(dim)])


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", "x") for i, v in rows], "vec_id long, embedding array<float>, n string, X string").repartition(3)
    return W.whiten(df, **kw).collect()


def check(spark, rows, k=4):
    got = run(spark, rows, components=k)
    whole, fit = fit_of(rows)
    n, sums, v = exact_covariance(fit)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == len(whole) * min(k, len(sums))
    want = {}
    for i, x in whole:
        away = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = (np.array([(n * a - s) / n for a, s in zip(x, sums)]) @ vectors[:, :k]) / np.sqrt(values[:k])
        for c in range(min(k, len(sums))):
            want.setdefault((i, c + 1), []).append((away, w[c]))
    sign = {}
    for r in got:
        away, w = want[r.vec_id, r.component][0]
        assert r.n == n and r.deviation == away
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
        if abs(w) > 1e-6:
            sign.setdefault(r.component, np.sign(w * r.whitened))
        assert abs(r.whitened - sign.get(r.component, 1) * w) < 1e-7
    return got


@pytest.mark.parametrize("dim", [1, 3, 4, 17])
def test_against_a_dense_decomposition(spark, dim):
    rng = np.random.default_rng(dim)
    mix = rng.normal(size=(dim, dim)) * np.linspace(1, 3, dim)
    rows = [(i, (rng.normal(size=dim) @ mix + 3).tolist()) for i in range(120)]
    check(spark, rows + rows[:50] + [(None, rows[1][1]), (500, None), (501, [None] * dim), (502, [float("nan")] * dim), (503, [float("-inf")] * dim)])


def test_a_vector_in_a_third_of_all_rows_counts_once(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    check(spark, rows + [(100 + i, rows[0][1]) for i in range(40)])


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=3) * [1e6, 1e3, 1.0] + [3e9, 0, 0]).tolist()) for i in range(30)]
    check(spark, rows, k=2)
    with pytest.raises(Exception, match="no long"):
        run(spark, [(1, [1e30])])


def test_no_variance_lengths_and_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [] and run(spark, [(1, [])]) == []
    got = run(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in got if r.vec_id == 1] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]
    line = [(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(10)]  # one direction only
    got = run(spark, line + [(50, [1.0]), (51, [2.0])])
    by = {(r.vec_id, r.component): r for r in got}
    assert by[3, 1].whitened is not None and by[3, 2].whitened is None and by[3, 2].explained == 0 and abs(by[3, 1].explained - 1) < 1e-12
    assert by[50, 1].n == 2 and abs(abs(by[50, 1].whitened) - 1) < 1e-12 and (50, 2) not in by


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 30):
        a = rng.normal(size=(n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in rng.normal(size=8) * 3:
            assert W.eigenvalues_above(a, shift) == int((values > shift).sum())
    assert W.eigenvalues_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("values", [[9, 8, 7, 6, 5, 4, 3], [5, 5, 5, 5, 5, 1, 1], [1e6, 1, 1e-3, 1e-6, 1e-6, 0, 0],
                                    [1 + 1e-9 * i for i in range(7)], [3, 2, 0, 0, 0, 0, 0]])
@pytest.mark.parametrize("k", [1, 4, 7])
def test_contour_finds_every_wanted_pair(spark, values, k):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(7, 7)))[0]
    v = q * values @ q.T
    v = (v + v.T) / 2
    found, u = W.top_components(spark, v, k)
    alive = sorted((x for x in values if x > 1e-13 * max(values)), reverse=True)[:k]
    assert len(found) == len(alive) and np.allclose(found, alive, rtol=1e-8, atol=1e-14 * max(values))
    assert np.allclose(u.T @ u, np.eye(len(found)), atol=1e-10) and np.abs(v @ u - u * found).max() <= 1e-13 * max(values)
