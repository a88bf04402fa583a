from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from reviewmill.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_definition(sizes, weights=(5, 2, 1), total=1.5, most=2.0):
    """Share by weight; what is above a cap is shared again among the others."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, total * sum(sizes.values()), set(names)
    while open_:
        shares = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if shares[s] >= most * sizes[s]}
        if not over:
            target |= shares
            break
        target |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


def corpus(seed, n=600):
    pick = random.Random(seed)
    sources = [pick.choice(["a", "a", "a", "a", "b", "Z", "é", None, "tiny"]) for _ in range(n)]
    texts = [" ".join(["w"] * min(400, int(pick.expovariate(1 / 60)))) for _ in range(n)]
    return [*texts, None, "", "w " * 3000], [*sources, "a", None, "b"]


@pytest.mark.parametrize("seed", range(2))
def test_targets_and_taken_words(make, seed):
    texts, sources = corpus(seed)
    rows = mixing.mix(make(texts, sources=sources)).collect()
    sizes = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    by_source = Counter()
    for i, s in enumerate(sources):
        by_source[s] += sizes[i]
    expected = targets_by_definition(by_source)
    taken = Counter()
    for r in rows:
        m = r.mix
        assert m.size == sizes[r.doc_id] and m.source_size == by_source[r.source]
        assert m.target == pytest.approx(expected[r.source])
        assert m.taken == m.copies * m.size and 0 <= m.taken <= 2 * m.size
        taken[r.source] += m.taken
    longest = {s: max(sizes[i] for i in sizes if sources[i] == s) for s in by_source}
    for s, target in expected.items():
        assert abs(taken[s] - target) <= max(longest[s] / 2, 0.01 * target), s
    assert len(rows) == len(texts)


def test_rates_are_tilted_by_size(make):
    texts, sources = corpus(5, 1500)
    rows = mixing.mix(make(texts, sources=sources), weights=(1, 30, 30), most=2.0).collect()
    down = [r.mix for r in rows if r.source == "Z" or r.mix.target < r.mix.source_size]
    short = [m.copies for m in down if 0 < m.size < 20]
    long = [m.copies for m in down if m.size > 150]
    assert sum(short) / len(short) > sum(long) / len(long)


def test_reruns_agree_and_parts_do_not_matter(make, monkeypatch):
    texts, sources = corpus(1)
    texts += ["same size text"] * 300
    sources += ["a"] * 300
    docs = make(texts, sources=sources)
    one = sorted((r.doc_id, r.mix.taken) for r in mixing.mix(docs).collect())
    assert one == sorted((r.doc_id, r.mix.taken) for r in mixing.mix(docs.repartition(7)).collect())
    monkeypatch.setattr(mixing, "PART_ROWS", 10)
    parted = mixing.mix(docs).collect()
    assert sum(r.mix.taken for r in parted) == pytest.approx(sum(t for _, t in one), rel=0.01)


def test_odd_tables(make, odd_texts):
    docs = make(odd_texts, ids=[None, None, 3, 3, 4, 5, 6, 7, 8, 9, 10])
    assert len(mixing.mix(docs).collect()) == len(odd_texts)
    assert mixing.mix(docs.limit(0)).count() == 0
    wordless = mixing.mix(make([None, "", " "])).collect()
    assert [(r.mix.target, r.mix.taken) for r in wordless] == [(0.0, 0)] * 3


def test_repeated_rows_come_back_whole(make):
    texts, sources = corpus(4)
    docs = make(texts, sources=sources)
    copies = {r.doc_id: r.mix.copies for r in mixing.mix(docs).collect()}
    rows = mixing.repeated(docs)
    assert rows.columns == docs.columns
    assert Counter(r.doc_id for r in rows.collect()) == {k: n for k, n in copies.items() if n}
