import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairnbook.llm import suffix_dedup as s


def plain(rows):
    data = [(d, (t or "").encode()) for d, t in rows]
    counts = {}
    for _, b in data:
        for i in range(len(b) - s.LENGTH + 1):
            counts[b[i:i + s.LENGTH]] = counts.get(b[i:i + s.LENGTH], 0) + 1
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - s.LENGTH + 1):
            if counts[b[i:i + s.LENGTH]] > 1:
                gone[i:i + s.LENGTH] = True
        left = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]) if b else b""
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((str(d), len(b), len(b) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def rows():
    rng = random.Random(12)
    fresh = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passage, other = fresh(700), fresh(399)
    found = [(k, fresh(rng.choice([0, 10, 300, 900])) + passage[k * 7:k * 7 + 380 + 11 * k] + fresh(200)) for k in range(20)]
    found += [(100 + k, other + fresh(50) + other) for k in range(3)]
    found += [(200, "a" * 1500), (201, "b" * 400), (202, "b" * 399), (203, "ab" * 900), (204, fresh(450) * 2)]
    found += [(300, None), (301, ""), (302, found[3][1]), (302, found[3][1]), (303, fresh(399)), (None, found[5][1]), (305, passage)]
    near = fresh(1200)
    return found + [(400 + k, near[:500 + k] + "#" + near[501 + k:]) for k in range(12)]


@pytest.mark.parametrize("hot", [2048, 3])
def test_equals_brute_force(spark, monkeypatch, hot):
    """With a low bound the way for tokens shared by very many places is taken too."""
    monkeypatch.setattr(s, "HOT", hot)
    found = rows()
    docs = spark.createDataFrame([(d, t, b"k") for d, t in found], "doc_id long, text string, key binary")
    got = s.remove_repeats(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain(found)


def test_multikey_quicksort_finds_equal_suffixes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 3, (400, 5)).astype(np.uint64)
    got = sorted(s.multikey_quicksort(400, lambda level, i: keys[i, level], 5).tolist())
    _, where, counts = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
    assert got == np.flatnonzero(counts[where.ravel()] > 1).tolist()
    assert not len(s.multikey_quicksort(0, lambda level, i: np.zeros(0, np.uint64), 5))


def test_text_longer_than_a_chunk(spark, monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abcd") for _ in range(9000))
    found = [(1, text + "x" + text[4000:4600]), (2, "y" * 5 + text[100:800])]
    want = plain(found)
    prints = s._anchors
    whole = np.frombuffer(text.encode(), np.uint8)
    parts = [prints(whole[b:b + 2000])[0] for b in range(0, 9000 - s.LENGTH + 1, 2000 - s.LENGTH + 1)]
    assert set(np.concatenate(parts).tolist()) >= set(prints(whole)[0].tolist())
    got = s.remove_repeats(spark.createDataFrame(found, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_no_documents_and_kept_text(spark):
    assert s.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    a = "q" + "".join(map(str, range(300)))
    got = {r.doc_id: r for r in s.remove_repeats(spark.createDataFrame([(1, a), (2, a[1:] + "zz")], "doc_id long, text string"), with_text=True).collect()}
    assert bytes(got[1].kept) == b"q" and bytes(got[2].kept) == b"zz" and [tuple(x) for x in got[1].spans] == [(1, len(a))]


def plain_passages(rows):
    """n_passage_words of each row: words under 51 consecutive words that another row has too."""
    words = [(t or "").encode().split() for _, t in rows]
    where = {}
    for row, w in enumerate(words):
        for i in range(len(w) - 50):
            where.setdefault(tuple(w[i:i + 51]), set()).add(row)
    out = []
    for (d, _), w in zip(rows, words):
        hit = set()
        for i in range(len(w) - 50):
            if len(where[tuple(w[i:i + 51])]) > 1:
                hit.update(range(i, i + 51))
        out.append((d, len(hit)))
    return sorted(out)


def passage_rows():
    rng = random.Random(7)
    fresh = lambda n: [rng.choice("abcdefghé") + str(rng.randrange(500)) for _ in range(n)]
    passage, edge, own = fresh(70), fresh(50), fresh(60)
    found = [(k, " ".join(fresh(30 * k) + passage[k:k + 51 + k] + fresh(40))) for k in range(12)]
    found += [(20 + k, " ".join(fresh(20) + edge + fresh(20))) for k in range(3)]
    found += [(30, " ".join(own + fresh(5) + own)), (31, " ".join(fresh(9) + passage[:60] + fresh(9) + passage[:60])), (32, "\n\t".join(passage[5:63]))]
    found += [(40, "of " * 300), (41, " ".join(fresh(5) + ["of"] * 80)), (42, "of " * 50), (43, " ".join(["of"] * 50 + fresh(60)))]
    found += [(50, None), (51, ""), (52, "x " * 51), (53, "x " * 51), (54, "y " * 50), (55, "y " * 50), (56, "z " * 400)]
    near = fresh(300)
    return found + [(60 + k, " ".join(near[:9 * k] + ["#"] + near[9 * k + 1:])) for k in range(12)]


@pytest.mark.parametrize("hot", [2048, 3])
def test_passages_equal_brute_force(spark, monkeypatch, hot):
    """Passages of over 50 words that another row has are told, also those too short in bytes to be removed."""
    monkeypatch.setattr(s, "HOT", hot)
    found = passage_rows()
    got = s.remove_repeats(spark.createDataFrame(found, "doc_id long, text string"), with_text=True).collect()
    assert sorted((r.doc_id, r.n_passage_words) for r in got) == plain_passages(found)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain(found)
    row = {r.doc_id: r for r in got}
    assert row[0].n_removed == 0 and row[0].n_passage_words == 51
    texts = dict(found)
    told = [texts[31].encode()[x.start:x.end].split() for x in row[31].passages]
    assert [len(x) for x in told] == [60, 60] and told[0] == told[1] == texts[31].encode().split()[9:69]


def test_words_beyond_a_chunk(monkeypatch):
    """Words and passages are the same however a long text is cut."""
    rng = random.Random(4)
    data = np.frombuffer("  ".join(str(rng.randrange(1000)) * rng.choice([1, 3, 90]) for _ in range(900)).encode(), np.uint8)
    words, start, end = s.word_prints(data)
    prints, anchors = s.passage_prints(words), s._passage_anchors(words)
    assert [bytes(data[a:b]) for a, b in zip(start, end)] == bytes(data).split()
    monkeypatch.setattr(s, "CHUNK", 256)
    assert (s.word_prints(data)[0] == words).all() and (s.passage_prints(words) == prints).all()
    assert set(anchors[0].tolist()) <= set(s._passage_anchors(words)[0].tolist())


@pytest.mark.parametrize("bound", [4_000_000, 0])
def test_groups_of_hot_blocks_do_not_meet_in_a_task(spark, monkeypatch, bound):
    """Rows without a value are marked without a join, and a large group is no key of a shuffle while it can be sent."""
    monkeypatch.setattr(s, "HOT", 10)
    monkeypatch.setattr(s, "BROADCAST_IDS", bound)
    s.ensure_checkpoint_dir(spark)
    values = [None] * 700 + [1] * 500 + [2] * 10 + [3, 4, 4, 5]
    rows = spark.createDataFrame(list(enumerate(values)), "n int, v long").repartition(8).checkpoint()
    marked = s._marked(rows, ["v"], "twice")
    assert sorted((r.n, r.twice) for r in marked.collect()) == [(n, True if v in (1, 2, 4) else None) for n, v in enumerate(values)]
    if bound:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            largest = marked.where("twice is null or v <> 1").withColumn("task", F.spark_partition_id()).groupBy("task", "v").count().agg(F.max("count")).head()[0]
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert largest < 200
