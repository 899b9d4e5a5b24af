import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnbook.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return {"email": [m.span() for m in EMAIL.finditer(text)], "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
            "card": [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
            "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a.@-+1024 ()%_é١"), max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_of_planted_text():
    text = "x 4111 1111-1111 1111, 1.2.3.4.5.6.7.8 a@b.c@d.e +1 (555) 010-9999. 0000255.1.1.256 " + "9" * 5000
    assert pii.base_spans(text) == plain(text)


def test_long_runs_are_linear():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "1." * 500_000, "+" * 500_000, "@" * 500_000):
        pii.base_spans(text)


def test_a_repeat_takes_the_label_of_its_twin():
    """The second token alone is undecided; its twin, which is certain, carries over through the skip edge."""
    weights = np.zeros((1 << pii.FEATURE_BITS, len(pii.LABELS)))
    nodes = pii.Graph([(0, 5), (100, 105)], np.asarray([[0], [1]]), [(0, 1, True)], [False, False])
    weights[0, 1], weights[1, 0] = 6.0, 0.2
    skip = np.where(np.eye(len(pii.LABELS)) > 0, 3.0, 0.0)
    alone = pii.Field(weights, np.zeros_like(skip), np.zeros_like(skip)).marginals(nodes)
    tied = pii.Field(weights, np.zeros_like(skip), skip).marginals(nodes)
    assert alone[1].argmax() == 0 and tied[1].argmax() == 1
    exact = np.exp(weights[0][:, None] + weights[1][None, :] + skip)
    assert np.allclose(tied[1], exact.sum(axis=0) / exact.sum(), atol=1e-3)


def test_repeats_that_patterns_miss_are_added():
    texts = [f"write to bob{k}.smith@mail{k}.example.com today and 12 more from 10.0.0.{k} at 5" for k in range(80)]
    field = pii.train([(g.features, pii._labels_of(g, pii.base_spans(t)), g.edges) for t in texts for g in [pii.graph(t)]])
    text = "see bob1.smith@mail1.example.com or bob1.smith@mail1-example-com please, version 3"
    base = pii.base_spans(text)
    added = pii.added_spans(text, field, base, sure=0.5)
    assert len(base["email"]) == 1
    assert all(not pii._overlaps(s, base["email"]) for k in pii.KINDS for s in added[k])
    assert [text[s:e] for s, e in added["email"]] == ["bob1.smith@mail1-example-com"]


def test_rows_of_all_kinds(spark):
    text = "mail a.b@example.com and again a.b@example.com"
    docs = spark.createDataFrame([(1, text, 46, "k"), (2, None, None, None), (3, "", 0, ""), (3, "", 0, ""), (None, "+49 170 1234567", 15, "")], "doc_id long, text string, n_chars long, kind string")
    field = pii.fit(docs)
    got = sorted(pii.find(docs, field).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.doc_id, r.n_email, r.n_phone) for r in got] == [(1, 2, 0), (2, 0, 0), (3, 0, 0), (3, 0, 0), (None, 0, 1)]
    assert got[1].base_sha256 == empty and got[1].spans == ""
    assert got[0].base_sha256 == hashlib.sha256(b"email:5:20,email:31:46").hexdigest()
    masked = {r.doc_id: r for r in pii.mask(docs, field).collect()}
    assert masked[1].text == "mail [EMAIL] and again [EMAIL]" and masked[1].n_chars == 30 and masked[None].text == "[PHONE]" and masked[2].text is None
    assert pii.find(docs.limit(0), field).collect() == [] and pii.fit(docs.limit(0))
