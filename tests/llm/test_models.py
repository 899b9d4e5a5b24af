"""Toxicity, mixing and the pipeline, on the tables."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairnbook.llm import mixing, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_gram_counts_equal_plain_counting(spark):
    texts = [("Abc  abc\n", 1), ("abcabc", 0), (None, 0), ("", 1), ("中文 text", 1)]
    rows = spark.createDataFrame([(k % 2, *r) for k, r in enumerate(texts)], "fold int, text string, toxic int")
    counted = toxicity.gram_counts(rows)
    got = {r.gram: (r.n1, r.n0) for r in counted.groupBy("gram").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).collect()}
    assert {r.gram for r in counted.where("fold = 1").collect()} == set(toxicity.grams(toxicity.symbols("abcabc")).tolist())
    want = {}
    for text, toxic in texts:
        for g in toxicity.grams(toxicity.symbols(text)).tolist():
            pair = want.setdefault(g, [0, 0])
            pair[1 - toxic] += 1
    assert got == {g: tuple(c) for g, c in want.items()}


def test_ratios_equal_the_recursion_written_out(spark):
    texts = [("the bad dog", 1), ("the good dog", 0), ("a good cat", 0), ("bad cat bad", 1)]
    more = [(1, *r) for r in texts] + [(2, "left out", 1)]
    tables = toxicity.fit_ratios(toxicity.gram_counts(spark.createDataFrame(more, "fold int, text string, toxic int")), without=(2,))
    counts = {1: {}, 0: {}}
    for text, toxic in texts:
        for g in toxicity.grams(toxicity.symbols(text)).tolist():
            counts[toxic][g] = counts[toxic].get(g, 0) + 1
    by_order = {5: counts}
    for n in (4, 3, 2, 1):
        by_order[n] = {c: {} for c in (1, 0)}
        for c in (1, 0):
            for g in {g for g, k in by_order[n + 1][c].items() if k}:
                low = g & ((1 << 12 * n) - 1)
                by_order[n][c][low] = by_order[n][c].get(low, 0) + 1
    shared = {}
    for n in (2, 1):
        above = {g for c in (1, 0) for g in (by_order[3][c] if n == 2 else shared[2])}
        shared[n] = {}
        for g in above:
            low = g & ((1 << 12 * n) - 1)
            shared[n][low] = shared[n].get(low, 0) + 1

    def p(g, n, c):
        table = shared[n] if n < 3 else by_order[n][c]
        if n == 1:
            return (table.get(g, 0) + 0.5) / (sum(table.values()) + 0.5 * (len(table) + 1))
        mine = [k for x, k in table.items() if x >> 12 == g >> 12]
        low = p(g & ((1 << 12 * (n - 1)) - 1), n - 1, c)
        return max(table.get(g, 0) - 0.75, 0) / sum(mine) + 0.75 * len(mine) / sum(mine) * low if mine else low

    for text in ("the bad dog", "good bad the cat", "cat"):
        packed = toxicity.grams(toxicity.symbols(text))
        got = tables.ratios(packed)
        want = [np.log(p(g, 5, 1) / p(g, 5, 0)) for g in packed.tolist()]
        assert np.allclose(got, want), text


def test_held_out_accuracy_and_odd_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    held = docs.join(labels, "doc_id").where(toxicity.learn_fold(F.col("doc_id")) == 0).select("doc_id", "text", "toxic")
    got = toxicity.score(held, model).join(held.select("doc_id", "toxic"), "doc_id").collect()
    assert sum((r.score >= 0.5) == (r.toxic == 1) for r in got) >= 0.95 * len(got)
    odd = spark.createDataFrame([(1, None, 0.1), (None, "", 0.2), (3, "x" * 300_000, 0.3), (3, "x", 0.4)], "doc_id long, text string, score double")
    scores = toxicity.score(odd, model).collect()
    assert len(scores) == 4 and all(0 <= r.score <= 1 for r in scores)
    kept = toxicity.keep_ordinary(odd, model)
    assert kept.columns == odd.columns and kept.where("text = ''").count() == 1


def test_rare_runs_count_beyond_the_broadcast_bound(spark, tables):
    docs, labels = tables
    odd = spark.createDataFrame([(None, "twice none"), (None, "twice none"), (None, None), (-1, ""), (-2, " x" * 50), (-2, "a  b"), (-3, "z" * 3000)], "doc_id long, text string")
    some = docs.where("doc_id % 5 = 0").select("doc_id", "text").union(odd).cache()
    small, large = toxicity.fit(docs, labels), toxicity.fit(docs, labels, max_entries=1000)
    rows = lambda model: sorted((str(r.doc_id), r.score) for r in toxicity.score(some, model).collect())
    want, got = rows(small), rows(large)
    assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-6, atol=1e-12)
    kept = lambda model: sorted((str(r.doc_id), r.text or "") for r in toxicity.keep_ordinary(some, model).collect())
    assert kept(large) == kept(small)


def test_tables_of_over_half_a_million_runs_are_sent(spark):
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzäöüßéèçñ  "))
    rng = np.random.default_rng(7)
    docs = spark.createDataFrame([(i, "".join(rng.choice(letters, 8000))) for i in range(100)], "doc_id long, text string")
    counted = toxicity.gram_counts(docs.select(F.lit(1).alias("fold"), "text", (F.col("doc_id") % 2).cast("int").alias("toxic"))).cache()
    sent, joined = toxicity.fit_ratios(counted), toxicity.fit_ratios(counted, max_entries=1000)
    assert isinstance(sent, toxicity.RatioTables) and isinstance(joined, toxicity.JoinedRatios)
    assert len(sent.tables["gram", 5][0]) == counted.select("gram").distinct().count() > toxicity.ONE_PART_RUNS
    keys = counted.select("gram").where("gram % 97 = 0").union(spark.range(5).select("id"))
    rows = joined.ratios(keys).collect()
    assert np.allclose(sent.ratios(np.array([r.gram for r in rows])), [r.ratio for r in rows], rtol=1e-12)


def test_without_labels_the_score_is_flat(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score < 0.01 for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [True, True]
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).collect() == []


def test_rates_meet_targets(spark, tables):
    docs, labels = tables
    rates, domains = mixing.mix(docs, labels)
    got = rates.collect()
    t, p, r = np.asarray([x.tokens * x.rows for x in got], float), np.asarray([x.p for x in got]), np.asarray([x.rate for x in got])
    assert np.allclose(p.sum(axis=1), 1) and (r >= 0).all()
    total = (t * r) @ p
    assert np.allclose(total, t.sum() / len(domains.names), rtol=1e-3)
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def least_squares(p, t, targets, least=0.0):
    """The smallest squared distance, by very many plain projected steps."""
    pace, r = 1 / np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1], np.ones(len(t))
    for _ in range(20_000):
        r = np.maximum(least, r - p @ ((t * r) @ p - targets) * pace)
    return (((t * r) @ p - targets) ** 2).sum()


@pytest.mark.parametrize("p,targets,least", [
    ([[a, 1 - a] for a in (0.9, 0.6, 0.5, 0.2)], [40.0, 0.0], 0.0),
    ([[0.8, 0.1, 0.1], [0.3, 0.4, 0.3], [0.2, 0.3, 0.5], [0.1, 0.8, 0.1]], [50.0, 0.0, 3.0], 0.0),
    ([[0.7, 0.3], [0.4, 0.6], [0.9, 0.1]], [60.0, 5.0], 1.0)])
def test_rates_are_the_least_squares_fit_when_targets_cannot_be_met(spark, p, targets, least):
    p, targets = np.asarray(p), np.asarray(targets)
    t = 10.0 + np.arange(len(p))
    rows = [(i, i, 1, int(t[i]), p[i].tolist()) for i in range(len(p))]
    members = spark.createDataFrame(rows, "doc_id long, text_key long, rows long, tokens long, p array<double>")
    steps = mixing.fit_rates(members, targets, least=least)
    r = np.asarray([x.rate for x in members.withColumn("rate", mixing.rate(steps, least=least)).orderBy("doc_id").collect()])
    assert (r >= least).all() and (((t * r) @ p - targets) ** 2).sum() <= least_squares(p, t, targets, least) * 1.01


def test_a_fit_that_still_moves_is_warned_of(spark):
    members = spark.createDataFrame([(1, 1, 1, 10, [0.9, 0.1]), (2, 2, 1, 10, [0.2, 0.8])], "doc_id long, text_key long, rows long, tokens long, p array<double>")
    with pytest.warns(UserWarning, match="still move"):
        mixing.fit_rates(members, np.asarray([100.0, 3.0]), most_steps=1)


def test_no_text_shrinks_when_totals_grow(spark, tables):
    docs, labels = tables
    rates, domains = mixing.mix(docs, labels, temper=0.7, grow=True)
    got = rates.collect()
    t, p, r = np.asarray([x.tokens * x.rows for x in got], float), np.asarray([x.p for x in got]), np.asarray([x.rate for x in got])
    assert r.min() >= 1
    share, total = (t @ p / t.sum()) ** 0.7, (t * r) @ p
    assert np.allclose(total / total.sum(), share / share.sum(), rtol=0.01)
    assert mixing.draw(docs, rates).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_targets_of_unknown_domains_are_refused_and_all_labelled_ones_modelled(spark, tables):
    with pytest.raises(ValueError, match="xx"):
        mixing.mix(*tables, targets={"en": 1.0, "xx": 1.0})
    rows = [(i, f"w{i} w{i}", f"d{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(mixing.learn(docs, docs.select("doc_id")).names) == 40


def test_drawn_rows_and_odd_input(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", 5), (1, "a b c", "en", 5), (2, None, None, 6), (None, "d e", "de", 7), (4, "f", "en", 8)], "doc_id long, text string, lang string, rate int")
    labels = spark.createDataFrame([(1, 0), (4, 0), (4, 0)], "doc_id long, toxic int")
    rates, _ = mixing.mix(docs, labels, grow=True, temper=0.7)
    drawn = mixing.draw(docs, rates)
    assert drawn.columns == docs.columns
    assert sorted((str(r.doc_id), r.rate) for r in drawn.collect()) == [("1", 5), ("1", 5), ("2", 6), ("4", 8), ("None", 7)]
    twice = mixing.draw(docs, rates.withColumn("rate", F.lit(2.0)))
    assert twice.count() == 10
    nothing, _ = mixing.mix(docs.limit(0), labels)
    assert nothing.collect() == [] and mixing.draw(docs.limit(0), nothing).collect() == []


def test_pipeline_stages_keep_their_promises(spark, tables):
    docs, labels = tables
    at, toxic = docs, {r.doc_id for r in labels.where("toxic = 1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF).cache()
        assert at.columns == docs.columns, name
        ids = [r.doc_id for r in at.select("doc_id").collect()]
        if name == "toxicity":
            # Some toxic labels lie on rows without a word that tells: nothing in their texts shows them.
            words = lambda i: set(re.findall(r"\w+", (texts[i] or "").lower()))
            ordinary = Counter(w for r in labels.where("toxic = 0").collect() if r.doc_id in texts for w in words(r.doc_id))
            tells = {w for w, n in Counter(w for i in toxic for w in words(i)).items() if n >= 8 and ordinary[w] <= 0.1 * n}
            shown = {i for i in toxic if words(i) & tells}
            assert len(shown) >= 0.6 * len(toxic) and len(shown & set(ids)) <= 0.05 * len(shown)
            assert len(toxic & set(ids)) <= 0.25 * len(toxic) and len(ids) >= 0.85 * len(texts)
        if name == "near_dedup":
            kept_texts = [texts[i] for i in ids]
            assert len(set(kept_texts)) == len(kept_texts)
        if name == "mixing":
            assert set(ids) == before
        before = set(ids)
    packed = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == before
