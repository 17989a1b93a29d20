"""Whitening against exact sums and a full eigendecomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.llm import whitening


@pytest.mark.parametrize("seed", range(5))
def test_counts_against_eigenvalues(seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((12, 12))
    v = a + a.T
    if seed == 4:
        v[np.diag_indices(12)] = 0  # every first pivot is zero
    e = np.linalg.eigvalsh(v)
    for shift in (*((e[1:] + e[:-1]) / 2), e[0] - 1, e[-1] + 1, 0.0):
        assert whitening.above(v, float(shift)) == (e > shift).sum()


@pytest.mark.parametrize("values", [[9, 4, 2, 1, 0.5, 0.1], [5, 5, 5, 1, 1, 1e-3], [3, 3 - 1e-9, 3 - 2e-9, 1, 1, 0], [7, 0, 0, 0, 0, 0], [1, 1, 1, 1, 1, 1], [0] * 6])
def test_leading_pairs(values):
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))[0]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, u = whitening.leading(v, 4)
    want = [x for x in values if x > 0][:4]
    assert len(e) == len(want) and np.allclose(e, want, rtol=1e-12, atol=1e-14)
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)
    assert np.allclose(v @ u, u * e, atol=1e-12)


def random_vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) @ np.diag(np.linspace(0.1, 2, d)) @ np.linalg.qr(rng.standard_normal((d, d)))[0]).astype(np.float32).astype(float).tolist()


def check(spark, rows, components=16):
    """All rows against exact fractions and numpy's eigenvalues."""
    d = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<float>, key string, i int").repartition(3)
    got = whitening.whiten(d, whitening.fit(d, components)).collect()
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in fine), default=0)
    x = [[math.floor(64 * np.float64(np.float32(c))) + 1000000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in fine]
    once = sorted(set(map(tuple, x)))
    n = len(once)
    sums = [sum(c) for c in zip(*once, strict=True)]
    z = np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(r, sums, strict=True)] for r in once]).reshape(n, width)
    v = z.T @ z / max(n, 1)
    e, u = np.linalg.eigh(v) if width else (np.zeros(0), np.zeros((0, 0)))
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-12 * max(e, default=0)).sum()))
    assert len(got) == len(fine) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-10 and abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-10
    for (i, _), own in zip(fine, x, strict=True):
        dev = sum((n * a - s) ** 2 for a, s in zip(own, sums, strict=True))
        mine = by.get((i, dev if dev < 1 << 63 else None), {})
        assert sorted(mine) == list(range(1, k + 1))
        c = np.array([float(Fraction(a) - Fraction(s, n)) for a, s in zip(own, sums, strict=True)])
        for j in range(k):
            want = abs(c @ u[:, j]) / math.sqrt(e[j])
            assert any(abs(abs(r.whitened) - want) < 1e-7 for r in mine[j + 1])
    return got


def test_query(spark, tmp_path):
    vectors = random_vectors(200, 20)
    rows = list(enumerate(vectors)) + [(200 + i, vectors[0]) for i in range(40)] + [(None, vectors[1]), (7, vectors[2])]
    rows += [(900, None), (901, [None] * 20), (902, [math.nan] * 20), (903, [math.inf, *[0.0] * 19]), (904, vectors[5][:9]), (905, [])]
    got = check(spark, rows)
    signs = {r.component: r.whitened for r in got if r.vec_id == 3}
    assert len(signs) == 16
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    again = whitening.op13_whitening(spark, str(tmp_path)).collect()
    assert {r.component: r.whitened for r in again if r.vec_id == 3} == pytest.approx(signs)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, []), (2, None)], [(1, [0.5, 0.25]), (2, [1.5, 0.25]), (3, [1.0, 0.25])]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_dependent_dimensions_and_wide_numbers(spark):
    vectors = [[a, b, a, a] for a, b in random_vectors(60, 2)]
    got = check(spark, list(enumerate(vectors)))
    assert {r.component for r in got} == {1, 2}
    far = [(i, [v[0] * 1e2, v[1], v[2] * 1e4]) for i, v in enumerate(random_vectors(60, 3))]
    check(spark, far)
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<float>")
    assert all(r.deviation is None or r.vec_id == 3 for r in whitening.whiten(huge, whitening.fit(huge)).collect())
    with pytest.raises(ValueError):
        whitening.fit(spark.range(1).select(F.col("id").alias("vec_id"), F.array_repeat(F.lit(1.0), 2000).alias("embedding")))
