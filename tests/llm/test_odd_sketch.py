import itertools
import random

import numpy as np

from cairnbook.llm import components, odd_sketch


def brute(rows, size, percent=80):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        sets[doc_id] = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_groups_equal_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for base in range(12):
        words = [word() for _ in range(rng.choice([2, 6, 60, 150]))]
        for copy in range(rng.choice([1, 3, 9])):
            changed = [word() if rng.random() < copy * 0.006 else w for w in words]
            rows.append((len(rows), " ".join(changed) if copy != 1 else "\t".join(changed).upper()))
    shared = [word() for _ in range(50)]
    rows += [(len(rows) + k, " ".join(shared + [word() for _ in range(40)])) for k in range(20)]
    rows += [(500, None), (501, " \n"), (502, "")]
    rng.shuffle(rows)
    got = odd_sketch.near_duplicates(spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, component long"), shingle_words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 4)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_links_between_members_of_a_bucket_are_not_lost(spark):
    """Members that agree with neighbours but not with the first and last of their bucket."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[k * 12:k * 12 + 150])) for k in range(20)]
    got = odd_sketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=5).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 5)


def test_repeated_rows_null_ids_and_empty_input(spark):
    schema = "doc_id long, text string"
    text = " ".join(map(str, range(30)))
    got = odd_sketch.near_duplicates(spark.createDataFrame([(4, text), (4, text), (9, text), (None, text)], schema)).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in got) == [("4", 4, True), ("4", 4, True), ("9", 4, False), ("None", None, True)]
    assert odd_sketch.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    kept = odd_sketch.keep_first(spark.createDataFrame([(4, text, "a"), (4, text, "b"), (9, text, "c"), (None, None, "d")], schema + ", band string"))
    assert sorted((str(r.doc_id)) for r in kept.collect()) == ["4", "None"] and kept.columns == ["doc_id", "text", "band"]


def test_sketch_distance_follows_similarity():
    rng = np.random.default_rng(0)
    base = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    near = np.concatenate([base[:889], rng.integers(0, 1 << 63, 111, dtype=np.uint64)])
    far = np.concatenate([base[:400], rng.integers(0, 1 << 63, 600, dtype=np.uint64)])
    own, one, two = (odd_sketch.odd_sketch(odd_sketch.samples(np.unique(x))) for x in (base, near, far))
    count = lambda a, b: sum(bin(int(x) & (1 << 64) - 1).count("1") for x in a ^ b)
    assert count(own, own) == 0 and count(own, one) <= odd_sketch.SKETCH_MOST < count(own, two)


def test_components_equal_union_find(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (7, 7)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for e in edges for x in e if any(a != b and x in (a, b) for a, b in edges)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_unequal_texts_under_one_id_lose_no_link_and_no_text(spark):
    words = lambda seed: [f"{seed}{k}" for k in range(60)]
    a, b, c = words("a"), words("b"), words("c")
    near = lambda ws: " ".join([*ws[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (7, " ".join(c)), (8, " ".join(c)), (8, "alone " * 3), (9, None), (9, "lone text here and so on")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in odd_sketch.near_duplicates(docs, shingle_words=4).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 9)}
    kept = [(r.doc_id, r.text) for r in odd_sketch.keep_first(docs, shingle_words=4).collect()]
    assert sorted(kept, key=repr) == sorted([rows[0], rows[1], rows[4], rows[6], rows[7], rows[8]], key=repr)


def test_small_graphs_stay_in_one_partition(spark):
    """Rounds over few edges make no exchanges, and the smallest node is found all the same."""
    from cairnbook.llm.components import compact, components

    edges = spark.range(0, 400, 1, 16).selectExpr("id AS a", "CASE WHEN id % 100 = 99 THEN id ELSE id + 1 END AS b")
    found = components(edges)
    assert found.rdd.getNumPartitions() == 1
    assert {r.node: r.component for r in found.collect()} == {i: i // 100 * 100 for i in range(400)}
    assert compact(spark.range(0, 400, 1, 16), 100).rdd.getNumPartitions() == 4
