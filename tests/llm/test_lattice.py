from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCORES = {"▁": -1.0, "a": -1.0, "b": -1.2, "ab": -0.7, "▁a": -0.9, "ba": -1.1, "aba": -2.0}


def all_segmentations(word):
    word = "▁" + word
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        places = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        pieces = [word[a:b] for a, b in zip(places, places[1:])]
        score = 0.0
        for piece in pieces:
            if piece in SCORES:
                score += SCORES[piece]
            elif len(piece) == 1:
                score += -3.0 * len(piece.encode())
            else:
                break
        else:
            total += 10**score
    return math.log10(total)


@pytest.mark.parametrize("words", [["a", "ab", "aba", "abab", "b"], ["bab", "x", "éa", "abé", "ab", "ababab"]])
def test_marginal_is_the_sum_of_all_segmentations(words):
    scorer = lattice.Lattice(SCORES, [-3.0] * 256)
    assert [scorer.score(w) for w in words] == pytest.approx([all_segmentations(w) for w in words])


def test_long_words_do_not_underflow():
    assert math.isfinite(lattice.Lattice(SCORES, [-3.0] * 256).score("ab" * 20_000))


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 1


def check(frame, texts, ids):
    rows = Counter()
    tokens = [[*(t or "").encode().lower().split(), None] for t in texts]
    out = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i in ids]
    counts = Counter(w for words, o in zip(tokens, out) if not o for w in words)
    n, v = sum(counts.values()), len(counts)
    for i, words, o in zip(ids, tokens, out):
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        rows[i, o, len(words), sum(counts[w] > 0 for w in words), n, round(base, 5)] += 1
    found = frame.collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == rows
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    return found


def test_documents(make, odd_texts, monkeypatch):
    texts = [*odd_texts, *("The cat sat on the mat " * k for k in range(1, 20))]
    ids = list(range(len(texts)))
    whole = check(lattice.score_texts(make(texts), held_out(), MODEL), texts, ids)
    monkeypatch.setattr(lattice, "BLOCK_WORDS", 3)
    parts = check(lattice.score_texts(make(texts), held_out(), MODEL), texts, ids)
    assert {r.doc_id: r.score for r in parts} == pytest.approx({r.doc_id: r.score for r in whole})


def test_score_follows_the_training_text(make):
    """Held-out text like the training text is likelier than text of other letters."""
    texts = [" ".join(["nation", "station", "relation"][i % 3] for i in range(30)) for _ in range(30)]
    found = lattice.score_texts(make([*texts, "qwrtz " * 30]), F.col("doc_id") >= 25, MODEL).collect()
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[25] > by_id[30]


def test_odd_tables(make):
    docs = make(["a b", "a b", None, ""], ids=[1, 1, None, None])
    check(lattice.score_texts(docs, held_out(), MODEL), ["a b", "a b", None, ""], [1, 1, None, None])
    assert lattice.score_texts(docs.limit(0), held_out(), MODEL).count() == 0
    nothing = lattice.score_texts(make(["x y"]), F.lit(True), MODEL).first()
    assert (nothing.train_tokens, nothing.n_known, nothing.n_tokens) == (0, 0, 3)
