from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewmill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
OURS = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ranks():
    with open(PATH, "rb") as lines:
        first = lines.readline().split()
    assert RANKS[base64.b64decode(first[0])] == int(first[1])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=300))
def test_any_text(text):
    ids = OURS.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert OURS.decode(ids) == text.encode()


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc", "theion", "éèàx", "!?#", " \n\t", "0123", "あいう", "aA1 !<|endoftext|>"])
@pytest.mark.parametrize("length", [1, 63, 64, 65, 129, 1000, 5000])
def test_long_matches(alphabet, length):
    pick = random.Random(length)
    text = "".join(pick.choice(alphabet) for _ in range(length))
    assert OURS.encode(text) == THEIRS.encode_ordinary(text)


def test_joining_is_associative():
    pick = random.Random(2)
    for _ in range(200):
        parts = ["".join(pick.choice("ationhe") for _ in range(pick.randint(0, 90))).encode() for _ in range(3)]
        a, b, c = (OURS.leaf(p) for p in parts)
        whole = OURS.leaf(b"".join(parts))
        assert OURS.join(OURS.join(a, b), c) == OURS.join(a, OURS.join(b, c)) == whole
    assert OURS.join([], a) == OURS.join(a, []) == a


def test_documents(make, odd_texts):
    docs = make(odd_texts)
    found = bpe.encode_documents(docs, PATH, public_tokenizers.PATTERN, ids=True)
    for r in found.collect():
        text = odd_texts[r.doc_id] or ""
        ids = THEIRS.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.body, r.q) == ("b", 2)
    assert bpe.encode_documents(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
