"""Benchmark passages against brute force over all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from cairnbook.llm import decontamination as dc

DOC, ITEM = "doc_id long, text string", "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        ws = words(text)
        hit, ids = set(), set()
        for item_id, item in items:
            iw = words(item)
            n = min(len(iw), 10)
            if not n:
                continue
            windows = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)}
            for k in range(len(ws) - n + 1):
                if tuple(ws[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    if item_id is not None:
                        ids.add(str(item_id))
        out.append((doc_id, len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    rows = dc.find(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), **options)
    return sorted((tuple(r)[:6] for r in rows.collect()), key=repr)


def sample(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c7", "é", "the", "x", "Ñu"]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, draw(rng.choice([1, 3, 9, 10, 11, 30]))) for k in range(40)] + [(None, draw(12)), (7, draw(14)), (90, ""), (91, None), (92, "?!")]
    docs = [(k, draw(rng.randrange(1, 120))) for k in range(60)]
    long = [t for _, t in items if t and len(words(t)) >= 10]
    docs += [(100 + k, f"{draw(20)}-{long[k % len(long)].upper()}, {draw(5)}") for k in range(30)]
    return docs + [(5, docs[3][1]), (5, docs[4][1]), (None, long[0]), (None, None), (8, ""), (9, "…")], items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_in_one_pass_and_in_many(spark, seed):
    docs, items = sample(seed)
    expected = brute(docs, items)
    assert any(r[2] for r in expected) and any(not r[2] for r in expected)
    assert found(spark, docs, items) == expected
    assert found(spark, docs, items, block_words=40) == expected


def test_tiny_shards_lose_no_match_over_their_edges():
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 3, 400)
    numbers[90:120] = numbers[10:40] = rng.integers(1, 3, 30)
    rows = [(str(k), h) for k, h in enumerate([numbers[10:40].astype(np.uint64), np.asarray([1, 2], np.uint64), rng.integers(1, 3, 15).astype(np.uint64)])]
    items = dc.index_items(rows)
    as_numbers = np.where(np.isin(numbers, items.vocabulary.astype(np.int64)), np.searchsorted(items.vocabulary.astype(np.int64), numbers) + 1, 0) * (numbers > 0)
    whole = lambda: sorted((int(a), int(w)) for f in dc._find(as_numbers, items, 30) for a, w in zip(f[0], f[1]))
    at_once = whole()
    held, dc.SHARD = dc.SHARD, 16
    try:
        assert whole() == at_once and at_once
    finally:
        dc.SHARD = held


def test_suffix_array_is_sorted_to_its_depth():
    rng = np.random.default_rng(5)
    for top in (2, 5, 300):
        words_ = np.concatenate([rng.integers(0, top, 500), np.tile(rng.integers(1, top, 7), 20), np.zeros(1, np.int64)])
        array = dc.suffix_array(words_, 40)
        def suffix(i):
            part = words_[i:i + 40].tolist()
            return part[:part.index(0)] if 0 in part else part
        ordered = [suffix(i) for i in array.tolist()]
        assert ordered == sorted(ordered) and sorted(array.tolist()) == np.flatnonzero(words_).tolist()


def test_longest_matches_and_their_places(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = [(1, "q " + " ".join(f"w{k}" for k in range(4, 25)) + " q"), (2, "nothing of it")]
    rows = {r.doc_id: r for r in dc.find(spark.createDataFrame(docs, DOC), spark.createDataFrame([(3, item)], ITEM)).collect()}
    assert [tuple(m) for m in rows[1].matches] == [(0, 4, 1, 21)] and [tuple(s) for s in rows[1].spans] == [(1, 22)]
    assert rows[1].items == ["3"] and not rows[2].matches


def test_removal_keeps_columns_and_clean_rows(spark):
    item = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, f"so {item}", 5), (2, "clean", 6), (None, None, 7), (1, "clean too", 8)], DOC + ", key int")
    for block_words in (None, 10):
        kept = dc.remove_contaminated(docs, spark.createDataFrame([(1, item), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 z")], ITEM), block_words=block_words)
        assert kept.columns == docs.columns and sorted(r.key for r in kept.collect()) == [6, 7, 8]


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 3)], DOC + ", n_words int").withColumnRenamed("n_words", "spans")
    none = spark.createDataFrame([], ITEM)
    assert [tuple(r)[:4] for r in dc.find(docs, none).collect()] == [(1, 2, 0, 0)]
    assert dc.find(spark.createDataFrame([], DOC), none).count() == 0
    assert dc.find(spark.createDataFrame([], DOC), spark.createDataFrame([(1, "a b")], ITEM)).count() == 0


def test_a_very_long_text_is_read_whole(spark):
    item = "one two three four five six seven eight nine ten eleven"
    text = "two three one " * 500_000 + item + " one" * 200_000 + " " + item
    row = dc.find(spark.createDataFrame([(1, text)], DOC), spark.createDataFrame([(1, item)], ITEM)).first()
    assert (row.n_words, row.n_hit, row.n_items) == (1_700_022, 22, 1)
