import random
import re

from cairnbook.llm import quality_ledger as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = {}
    for w in windows:
        counts[w] = counts.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measurements_equal_plain_python(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "\n\n", "one", "a b c a b c", "a a a a a", "é\x1cü  #$\n#$\n\x0b#$", "x y z\nx y z\n x y z"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a ", "b ", "c ", "dd\n", "e|", "é\t", "🙂 "]) for _ in range(rng.choice([5, 60, 700]))))
    texts.append(" ".join(str(i % 1000) for i in range(30_000)))
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in q.measure(docs).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_policies_and_ablations_read_the_same_ledger(spark):
    texts = ["w " * 3, " ".join(map(str, range(80))), " ".join(["a b c"] * 40), " ".join(["$ $ $"] + [str(i) for i in range(20)])] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = q.ledger(q.measure(docs)).cache()
    base = {r.doc_id: r.kept for r in q.apply_policy(written, q.POLICIES["base"]).collect()}
    assert base == {0: False, 1: True, 2: False, 3: False, 4: False}
    lenient = {r.doc_id: r.kept for r in q.apply_policy(written, q.Policy("x", ("symbols",), 1)).collect()}
    assert all(lenient.values())
    rows = {r.rule: r for r in q.ablations(written, q.POLICIES["base"]).collect()}
    for rule in ("few_words", "repeated_windows"):
        others = q.Policy("y", tuple(r for r in ("few_words", "repeated_windows") if r != rule))
        kept = q.apply_policy(written, others).where("kept").count()
        assert rows[rule].n_kept_without == kept and rows[rule].n_only == kept - sum(base.values())


def test_plan_is_native_and_one_pass(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = q.ledger(q.measure(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_no_documents(spark):
    assert q.ledger(q.measure(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
