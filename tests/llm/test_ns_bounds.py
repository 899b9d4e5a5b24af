"""Clusters with retained centroids against plain rounds in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from cairnbook.llm import ns_bounds

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, dims, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    at = [v for _, v in order[:k]]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        own = [min(range(len(at)), key=lambda j: (d2(v, at[j]), j)) for _, v in kept]
        if r < rounds:
            for j in range(len(at)):
                mine = [v for (_, v), o in zip(kept, own) if o == j]
                if mine:
                    at[j] = [sum(c) // len(mine) for c in zip(*mine)]
    dist = [d2(v, at[o]) for (_, v), o in zip(kept, own)]
    inertia = [sum(d for d, o in zip(dist, own) if o == j) for j in range(len(at))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted([(i, o, d, inertia[o], sum(dist), sha[o]) for (i, _), o, d in zip(kept, own, dist)], key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)
    return sorted((tuple(r) for r in ns_bounds.cluster(frame, **options).collect()), key=repr)


def grid(n, dims, seed, spread=2):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-spread, spread + 1, (6, dims))
    return [(k, ((centres[k % 6] + rng.integers(-1, 2, dims)) / 8).tolist()) for k in range(n)]


@pytest.mark.parametrize("n, dims, k, rounds", [(300, 4, 8, 10), (120, 16, 5, 3), (40, 2, 8, 6)])
def test_equals_plain_rounds_with_ties(spark, n, dims, k, rounds):
    rows = grid(n, dims, n)
    assert found(spark, rows, k=k, rounds=rounds, dims=dims) == brute(rows, k, rounds, dims)


def test_odd_vectors_repeated_ids_and_extra_columns(spark):
    rows = grid(60, 3, 9) + [(None, [0.5, 0.5, 0.5]), (None, None), (3, [1.0, 1.0, 1.0]), (3, [1.0, 1.0, 1.0]), (70, [1.0, 2.0]), (71, []), (72, [1.0, None, 2.0]),
                             (73, [float("nan"), 0.0, 0.0]), (74, [float("inf"), 0.0, 0.0]), (75, [-0.0, 1e-30, -1e-30])]
    assert found(spark, rows, k=8, rounds=5, dims=3) == brute(rows, 8, 5, 3)


def test_few_none_and_huge_vectors(spark):
    two = [(1, [0.0, 1.0]), (2, [3.0, -1.0])]
    assert found(spark, two, k=8, rounds=3, dims=2) == brute(two, 8, 3, 2)
    assert found(spark, [], dims=2) == [] and found(spark, [(1, None)], dims=2) == []
    assert found(spark, [*two, (3, [1e30, 0.0])], k=8, rounds=3, dims=2) == brute(two, 8, 3, 2)  # no long holds its distances


def test_bounds_spare_distances_and_never_err():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-40, 40, (400, 8)) + c for c in rng.integers(-900, 900, (12, 8))])
    k = 8
    history = [x[:k].copy()]
    own, high, high_at = np.full(len(x), -1), np.zeros(len(x)), np.zeros(len(x), np.int64)
    low, low_at = np.zeros((len(x), k)), np.zeros((len(x), k), np.int64)
    counts = []
    for r in range(12):
        own, high, high_at, low, low_at, measured = ns_bounds.assign(x, own, high, high_at, low, low_at, np.asarray(history))
        exact = ((x[:, None, :] - history[-1]) ** 2).sum(axis=2)
        assert (own == exact.argmin(axis=1)).all()
        counts.append(measured)
        history.append(np.asarray([x[own == j].sum(axis=0) // max(1, (own == j).sum()) if (own == j).any() else history[-1][j] for j in range(k)]))
    assert counts[0] == k * len(x) and counts[-1] < 0.1 * counts[0]


def test_loosening_goes_by_the_whole_displacement():
    # The centroid goes away and comes back: the sum of drifts is 200, the displacement 0, and nothing is measured again.
    history = np.asarray([[[0], [100]], [[0], [200]], [[0], [100]]])
    x = np.asarray([[1], [2]])
    state = ns_bounds.assign(x, np.full(2, -1), np.zeros(2), np.zeros(2, np.int64), np.zeros((2, 2)), np.zeros((2, 2), np.int64), history[:1])
    assert ns_bounds.assign(x, *state[:5], history)[5] == 0
