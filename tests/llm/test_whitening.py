"""Whitened rows against a dense solution in NumPy."""

import math

import numpy as np
import pytest

from cairnbook.llm import whitening

KIND = "vec_id long, embedding array<float>, n int"


def brute(rows, k=4, scale=256):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.asarray([v for _, v in kept], float)
    fit = np.asarray(sorted({tuple(v) for _, v in kept}), float)
    n, mean = len(fit), fit.mean(axis=0)
    values, directions = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(fit.shape[1], fit.shape[1]))
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    sums = [sum(int(v[d]) for v in {tuple(v) for _, v in kept}) for d in range(fit.shape[1])]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for _, v in kept]
    return [i for i, _ in kept], n, deviation, (x - mean) @ directions / np.sqrt(values), values / np.trace(np.cov(fit.T, bias=True).reshape(fit.shape[1], -1))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)


def spread(n, d, seed):
    rng = np.random.default_rng(seed)
    return [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(n, d)) * np.linspace(3, 0.3, d))]


@pytest.mark.parametrize("n, d, parts", [(300, 6, 3), (2500, 5, 4), (50, 3, 8)])
def test_equals_dense_solution(spark, n, d, parts):
    rows = spread(n, d, n) + [(900_000 + k, spread(n, d, n)[0][1]) for k in range(20)]
    ids, count, deviation, whitened, explained = brute(rows)
    got = {r.vec_id: r for r in whitening.whiten(frame(spark, rows).repartition(parts)).collect()}
    assert sorted(got) == sorted(ids)
    sign = np.sign(np.asarray(got[ids[0]].whitened) * whitened[0])
    for i, dev, w in zip(ids, deviation, whitened):
        r = got[i]
        assert (r.n, r.deviation) == (count, dev)
        assert np.allclose(np.asarray(r.whitened) * sign, w, rtol=1e-8, atol=1e-8) and np.allclose(r.explained, explained, rtol=1e-9)
        assert r.identity_error < 1e-9


def test_odd_vectors(spark):
    rows = spread(40, 4, 2) + [(None, [1.0, 2.0, 3.0, 4.0]), (5, [0.5, 0.5, 0.5, -0.0]), (5, [0.5, 0.5, 0.5, -0.0]), (60, None), (61, []), (62, [1.0, None, 0.0, 0.0]),
                               (63, [float("nan"), 0.0, 0.0, 0.0]), (64, [0.0, 0.0, float("-inf"), 0.0])]
    ids, n, deviation, _, _ = brute(rows)
    told = whitening.by_component(whitening.whiten(frame(spark, rows)))
    assert told.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = told.collect()
    assert sorted(((r.vec_id, r.component) for r in got), key=repr) == sorted(((i, c) for i in ids for c in (1, 2, 3, 4)), key=repr)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation) and {r.n for r in got} == {n}
    # A vector of another length has no place in the covariance.
    assert whitening.whiten(frame(spark, [*rows, (70, [1.0])])).count() == len(ids)


def test_no_variance_no_component(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = [(k, [float(k), 1.0, -2.0 * k]) for k in range(9)]
    got = whitening.whiten(frame(spark, line)).collect()
    assert len(got) == 9 and all(len(r.whitened) == 1 and abs(r.explained[0] - 1) < 1e-12 for r in got)


def test_beyond_a_long(spark):
    rows = [(k, [float(k) * 1e12, 1.0 * k * k]) for k in range(6)] + [(9, [1e30, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.vec_id for r in got} == set(range(6)) and all(r.deviation is None for r in got)
