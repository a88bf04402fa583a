from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewmill.llm import tokens
from reviewmill.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
with open(PATH, "rb") as file:
    MODEL = file.read()
THEIRS = sentencepiece.SentencePieceProcessor(model_file=PATH)
SHORT = tokens.PieceCounter(MODEL, part_chars=7)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" ab▁\n\t<s>é漢")), max_size=60), max_size=5))
def test_cut_texts_count_as_whole_ones(texts):
    assert tokens.count_batches(SHORT, iter(texts), batch_bytes=16) == [len(THEIRS.encode(t)) for t in texts]


@pytest.mark.parametrize("alphabet", [" ", "a", " a", "ab ", "the ion", "x", "▁ ", "漢字", "\n ", "<s></s><unk>", "0123"])
def test_runs(alphabet):
    pick = random.Random(alphabet)
    texts = ["".join(pick.choice(alphabet) for _ in range(n)) for n in (1, 6, 7, 8, 14, 15, 100, 1000)]
    assert tokens.count_batches(SHORT, iter(texts), batch_bytes=50) == [len(THEIRS.encode(t)) for t in texts]


def test_long_texts_are_cut_and_short_ones_share_a_call():
    calls = []

    class Seen(tokens.PieceCounter):
        def lengths(self, texts):
            calls.append(sum(len(t.encode()) for t in texts))
            return super().lengths(texts)

    own = Seen(MODEL, part_chars=1000)
    texts = ["word " * 20_000, *["short text"] * 3000]
    assert tokens.count_batches(own, iter(texts), batch_bytes=4000) == [len(THEIRS.encode(t)) for t in texts]
    assert max(calls) < 4000 + 1100 and len(calls) < 60


def test_a_text_that_the_normaliser_changes_stays_whole():
    class Changed:
        def __getattr__(self, name):
            return getattr(THEIRS, name)

        def normalize(self, text):
            return "other"

    own = tokens.PieceCounter(MODEL, part_chars=5)
    own.library = Changed()
    assert list(own.parts("some words here")) == [("some words here", 0)]


def test_documents(make, odd_texts):
    docs = make(odd_texts).withColumnRenamed("body", "Tokens")
    found = tokens.count_tokens(docs, PATH, limit=100)
    assert found.columns[:-1] == docs.columns
    for r in found.select("doc_id", "Tokens", f"`{found.columns[-1]}`.*").collect():
        text = odd_texts[r.doc_id] or ""
        n = len(THEIRS.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit, r.Tokens) == (len(text.encode()), n, n > 100, "b")
    assert tokens.count_tokens(docs.limit(0), PATH).count() == 0


def test_tokenizer_file(make):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["plain words", "with <|endoftext|> inside", None, "é漢 " * 300]
    theirs = Tokenizer.from_file(path)
    found = tokens.count_tokens(make(texts), path).select("doc_id", "tokens.n_tokens").collect()
    assert dict(found) == {i: len(theirs.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    with pytest.raises(ValueError):
        tokens.counter("ranks.tiktoken", b"")


def test_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = LLM_QUERIES["op11_token_counts"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n = len(THEIRS.encode(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)
