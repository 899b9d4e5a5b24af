import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cairnbook.llm import packing, tokens


@pytest.fixture(scope="module")
def exact():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return tokens.UnitEncoder(tokens.default_ranks())


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("ab Z9.,'\n\t\xa0 é€🙂$<|>"), max_size=60))
def test_ids_equal_the_tokenizers_library(text, exact, encoder):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == exact.encode(text, add_special_tokens=False).ids


def test_special_strings_are_text(exact, encoder):
    text = "a <|endoftext|> b  c \n d"
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == exact.encode(text, add_special_tokens=False).ids


def test_special_strings_are_tokens_as_in_the_tokenizer_as_loaded(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y  z <|endoftext", " <|endoftext|>  b  <|endoftext|> c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in packing.pieces(docs, with_ids=True).collect()}
    assert got == {k: [*loaded.encode(text, add_special_tokens=False).ids, packing.END_OF_TEXT] for k, text in enumerate(texts)}


def test_first_fit_decreasing_equals_the_plain_search():
    rng = random.Random(4)
    lengths = np.asarray([rng.randint(1, 100) for _ in range(300)])
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    room, want = [], {}
    for i in sorted(range(300), key=lambda i: -lengths[i]):
        k = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
        if k == len(room):
            room.append(100)
        want[i] = (k, 100 - room[k])
        room[k] -= lengths[i]
    assert {i: (int(b), int(o)) for i, (b, o) in enumerate(zip(bins, offsets))} == want


def test_pieces_and_sequences_are_whole(spark, exact):
    rng = random.Random(1)
    texts = {k: " ".join(rng.choice(["the", "ab,", "zürich", "12"]) for _ in range(rng.choice([0, 3, 40, 900]))) for k in range(60)}
    rows = [(k, t, 1) for k, t in texts.items()] + [(100, None, 1), (None, "no id", 1), (7, texts[7], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack_documents(docs, capacity=256, group_pieces=16).collect()
    by_sequence, by_doc = {}, {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    for doc_id, text, _ in rows[:60]:
        ids = np.asarray(exact.encode(text, add_special_tokens=False).ids + [1], "<u4")
        copies = 2 if doc_id == 7 else 1
        assert sum(r.length for r in by_doc[doc_id]) == copies * len(ids)
        for r in by_doc[doc_id]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    assert [(r.start, r.length) for r in by_doc[100]] == [(0, 1)] and len(by_doc[None]) == 1


def test_sequences_hold_their_ids(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    cut = packing.pieces(docs, capacity=64, with_ids=True)
    got = packing.materialize(packing.pack(cut, capacity=64)).collect()
    assert sum(len(r.ids) for r in got) == sum(r.n_tokens for r in got) == sum(r.length for r in cut.collect())


def test_no_documents(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
