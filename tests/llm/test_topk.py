import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import topk


def brute(rows, k=5):
    ok = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in ok:
        if q % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q and len(a) == len(b))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found[:k])]
    return sorted(out)


def search(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0, **kw).collect())


@pytest.mark.parametrize("dim", [1, 3, 16, 50])
def test_against_brute_force_with_ties(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(i, np.round(rng.normal(size=dim), 1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(120)] + rows[:40]
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows, query_block=3, candidate_block=50) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, [3.0]), (100, []), (6, []), (7, [0.1, 0.1]), (7, [0.1, 0.1])]
    assert search(spark, rows) == brute(rows)
    assert search(spark, []) == [] and search(spark, [(0, [1.0])]) == []


def test_large_components(spark):
    rows = [(0, [260000.0, 1.0]), (1, [260000.0, -260000.0]), (2, [1e30, 1.0]), (3, [-260000.0, 260000.0])]
    assert search(spark, rows) == brute(rows[:2] + rows[3:])  # beyond 2^26 a component takes no part


def test_bounds_never_undercut_the_product():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-300, 300, (40, 37)).astype(float), rng.integers(-300, 300, (40, 37)).astype(float)
    exact = a @ b.T
    for s in topk.LEVELS:
        assert (topk._segments(a, s) @ topk._segments(b, s).T >= exact - 1e-6).all()


def test_every_vector_of_longs_takes_part(spark):
    usual = [(i, [(-1) ** i * 0.01 * i, 1.0, 0.5]) for i in range(51, 80)]
    rows = [(0, [0.5, -1.0, 0.25]), (1, [1e6, 1.0, 0.0]), (2, [-3e9, 0.0, 0.0]), (3, [262144.0, 0.0, 0.0]), *usual]
    assert search(spark, rows) == brute(rows)
    rows = [(50, [2.0 ** 34, 2.0 ** 34, 1.0]), (4, [2.0 ** 34, -2.0 ** 34, 3.0]), (5, [-2.0 ** 34, 2.0 ** 34, 2.0]), *usual]
    assert search(spark, rows) == brute(rows)  # own and partial products beyond a long
    rows = [(0, [2.0 ** 40]), (100, [-1.0]), (1, [-2.0 ** 40]), *[(i, [float(-i)]) for i in range(2, 9)]]
    assert search(spark, rows, k=3) == brute(rows, 3)  # one far below every long, not among the best


@pytest.mark.parametrize("sign", [1, -1])
def test_scores_beyond_a_long_fail(spark, sign):
    with pytest.raises(Exception, match="long"):
        search(spark, [(0, [2.0 ** 40]), (1, [sign * 2.0 ** 40]), (2, [0.5])])
