import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tesselon.llm import bpe


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(bpe.VOCABULARY)
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=200), st.text("aab 日本ß'é\n\t1.", max_size=200)))
def test_against_public_tokenizer(reference, text):
    assert bpe.encoder().encode(text) == reference.encode(text, add_special_tokens=False).ids


def test_long_runs(reference):
    rnd = random.Random(0)
    for text in ("a" * 30_000, "ab" * 15_000, "".join(rnd.choice("etaoin") for _ in range(30_000)), "<|endoftext|>", "日本語" * 3_000, " " * 5_000 + "x"):
        assert bpe.encoder().encode(text) == reference.encode(text, add_special_tokens=False).ids


def test_rank_queue_order():
    queue, rnd = bpe.RankQueue(), random.Random(3)
    items = [(rnd.randrange(50_000), rnd.randrange(1_000)) for _ in range(2_000)]
    for rank, position in items:
        queue.push(rank, position)
    assert [queue.pop() for _ in items] == sorted(items) and queue.pop() is None


def test_documents(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "Hello world"), (4, "Hello world"), (None, "x"), (5, "z" * 40_000)]
    df = spark.createDataFrame([(*r, "noise", [1]) for r in rows], "doc_id long, text string, id string, ids array<int>")
    got = [(r.doc_id, r.ids) for r in bpe.encode_documents(df, "doc_id", "text").collect()]
    assert len(got) == 7 and got.count((4, bpe.encoder().encode("Hello world"))) == 2
    assert dict(got)[1] == [] and dict(got)[2] == [] and dict(got)[3] != []
    sizes = {r.doc_id: r.n_tokens for r in bpe.count_tokens(df, "doc_id", "text").collect()}
    assert sizes == {k: len(v) for k, v in got}
    assert bpe.encode_documents(df.limit(0), "doc_id", "text").count() == 0
