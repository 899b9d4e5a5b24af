import numpy as np

from cairnbook.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, dims string"


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((400, 24)).astype(np.float32)
    for k in range(60):
        vectors[300 + k] = vectors[k % 5] + rng.standard_normal(24).astype(np.float32) * 0.15
    vectors[380:390] = vectors[17]
    labels = rng.integers(0, 3, 400)
    labels[300:360] = 1
    labels[:5] = 1
    rows = [(i, v.tolist(), int(c), "x") for i, (v, c) in enumerate(zip(vectors, labels))]
    odd = [(900, None, 1, ""), (901, [0.0] * 24, 1, ""), (902, [float("nan")] + [1.0] * 23, 1, ""), (903, [None] + [1.0] * 23, 1, ""), (904, vectors[0].tolist(), None, ""),
           (905, [float("inf")] + [1.0] * 23, 1, ""), (906, [1.0, 2.0], 1, ""), (907, [], 1, "")]
    got = {r.vec_id: r for r in hnsw.near_duplicates(spark.createDataFrame(rows + odd, SCHEMA)).collect()}
    unit = vectors.astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    component = np.arange(400)
    for _ in range(400):
        least = np.where(linked, component[None, :], 400).min(axis=1)
        component = np.minimum(component, least)
    assert {i: (got[i].n_links, got[i].component_id, got[i].kept) for i in range(400)} == {i: (int(linked[i].sum()), int(component[i]), bool(component[i] == i)) for i in range(400)}
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(900, 908))


def test_audit_measures_recall_against_brute_force():
    vectors = hnsw.unit(np.random.default_rng(1).standard_normal((3000, 32)))
    graph = hnsw.build(vectors)
    width, recall = hnsw.audited_beam(graph, 0.93)
    assert recall >= 0.99
    rng = np.random.default_rng(5)
    found = 0
    for i in range(0, 3000, 50):
        q = hnsw.unit((vectors[i] + 0.05 * rng.standard_normal(32))[None])[0]
        want = set(np.flatnonzero(vectors @ q >= 0.93).tolist())
        found += want == set(graph.within(q, 0.93, width, graph.descend(q, 0)).tolist())
    assert found >= 58


def test_several_shards_and_empty_input(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 64)
    rng = np.random.default_rng(6)
    base = rng.standard_normal((200, 16))
    both = np.concatenate([base, base + 0.02 * rng.standard_normal((200, 16))])
    got = hnsw.near_duplicates(spark.createDataFrame([(i, v.tolist(), 0, "") for i, v in enumerate(both)], SCHEMA)).collect()
    assert sum(r.component_id == r.vec_id % 200 and r.n_links >= 1 for r in got) >= 396
    assert hnsw.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_vectors_that_share_an_id_keep_their_own_links(spark):
    x, y = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, x, 0, ""), (1, y, 1, ""), (2, [1.0, 0.1, 0.0], 0, ""), (3, [0.1, 1.0, 0.0], 1, ""), (5, x, 3, ""), (5, None, 3, ""), (5, x, 3, "")]
    got = sorted(tuple(r) for r in hnsw.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (5, 0, 5, True), (5, 1, 5, True), (5, 1, 5, True)]


def test_links_across_many_shards_equal_brute_force(spark, monkeypatch):
    """A chain of links and a group of near copies over shards of 64 vectors."""
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 64)
    rng = np.random.default_rng(9)
    turn = np.linspace(0, 6, 120)
    chain = np.stack([np.cos(turn), np.sin(turn), np.zeros(120)], axis=1)
    group = np.asarray([0, 0, 1.0]) + 0.01 * rng.standard_normal((150, 3))
    vectors = np.concatenate([chain, group])[rng.permutation(270)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicates(spark.createDataFrame([(i, v.tolist(), 0, "") for i, v in enumerate(vectors)], SCHEMA)).collect()}
    u = hnsw.unit(vectors)
    linked = u @ u.T >= 0.93
    np.fill_diagonal(linked, False)
    component = np.arange(270)
    for _ in range(270):
        component = np.minimum(component, np.where(linked, component[None, :], 270).min(axis=1))
    assert got == {i: (int(linked[i].sum()), int(component[i])) for i in range(270)}
