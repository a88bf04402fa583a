from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from reviewmill.llm import near


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def by_definition(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    links, root = Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((rows[i][0], rows[find(i)][0], links[i]) for i in range(len(rows)))


def corpus(seed, groups=12, size=14):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(pick.choice([3, 5, 8, 30, 120, 400]))]
        for _ in range(pick.randint(1, size)):
            copy = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 60))):
                copy[pick.randrange(len(copy))] = word()
            if pick.random() < 0.4:
                copy += passage
            texts.append(" ".join(copy))
    texts += texts[:5]
    pick.shuffle(texts)
    return texts


def found(frame):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in frame.collect())


@pytest.mark.parametrize("seed", range(2))
def test_every_link(make, odd_texts, seed):
    texts = [*corpus(seed), *odd_texts]
    assert found(near.chosen_path_join(make(texts))) == by_definition(list(enumerate(texts)))


@pytest.mark.parametrize("dense", [0.3, 5.0, 0.0])
def test_splitting_and_blocks(make, monkeypatch, dense):
    """Buckets of three are large: they are split, or compared in many blocks."""
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "DENSE", dense)
    texts = corpus(7, size=25)
    assert found(near.chosen_path_join(make(texts))) == by_definition(list(enumerate(texts)))


def test_runs_follow_from_the_recall():
    assert near.runs_for(0.99, 0.8) == 3 and near.runs_for(0.999999, 0.8) == 9


def test_odd_ids(make):
    text = " ".join(f"w{i}" for i in range(50))
    docs = make([text, text, text + " more", None, "", "other words"], ids=[5, 5, 2, None, 8, None])
    rows = found(near.chosen_path_join(docs.filter("doc_id is not null")))
    assert rows == [(2, 2, 2), (5, 2, 2), (5, 2, 2), (8, 8, 0)]
    assert near.chosen_path_join(docs).filter("doc_id is null and class_id is null and n_links = 0").count() == 2


def test_one_of_each_class_stays(make):
    texts = corpus(3)
    docs = make(texts)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    classes = by_definition(list(enumerate(texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in classes})
    assert near.keep_one(docs.limit(0)).count() == 0 and near.chosen_path_join(docs.limit(0)).count() == 0


def test_rows_do_not_grow_with_the_square_of_a_group(make, monkeypatch):
    """600 near copies in blocks of 20: what is staged grows with the members, not with members times blocks."""
    monkeypatch.setattr(near, "BLOCK", 20)
    pick = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(600):
        copy = list(base)
        for _ in range(i % 4):
            copy[pick.randrange(len(copy))] = f"x{pick.randrange(500)}"
        texts.append(" ".join(copy))
    staged, real = {}, near.keep

    def counted(frame, label):
        kept = real(frame, label)
        staged[label] = max(staged.get(label, 0), kept.count())
        return kept

    monkeypatch.setattr(near, "keep", counted)
    docs = make(texts)
    assert found(near.chosen_path_join(docs)) == by_definition(list(enumerate(texts)))
    members, runs = staged["members"], near.runs_for(0.999999, 0.8)
    assert members > 300 and staged["requests"] <= runs * members and staged["links"] <= 2 * runs * members


def test_links_of_pairs_of_blocks_add_up():
    import pyarrow as pa

    rows = pa.table({"id": [5, 7, 5, 9], "links": [2, 1, 3, 1], "root": [5, 5, 3, 7]})
    merged = near._merged_links(rows).to_pylist()
    assert {r["id"]: (r["links"], r["root"]) for r in merged} == {5: (5, 3), 7: (1, 3), 9: (1, 3)}


def test_a_row_is_looked_up_by_its_path_once(make, monkeypatch):
    """One join by path for each depth, whose rows double with a group of unlike texts around one line and one of near copies."""
    monkeypatch.setattr(near, "BLOCK", 20)
    real, made = near.keep, {}

    def texts(size):
        pick = random.Random(4)
        line = [f"line{i}" for i in range(12)]
        base = [f"w{i}" for i in range(60)]
        unlike = [" ".join(line + [f"u{pick.randrange(10**6)}" for _ in range(20)]) for _ in range(size)]
        alike = [list(base) for _ in range(size)]
        for copy in alike:
            copy[pick.randrange(60)] = f"x{pick.randrange(10**6)}"
        return unlike + [" ".join(copy) for copy in alike]

    def counted(frame, label):
        joins = len(re.findall(r"Join Inner, \(path#\d+L? = path#\d+L?\)", frame._jdf.queryExecution().optimizedPlan().toString()))
        kept = real(frame, label)
        made.setdefault(size, []).extend([kept.count()] * joins)
        return kept

    monkeypatch.setattr(near, "keep", counted)
    for size in (60, 120):
        rows = texts(size)
        assert found(near.chosen_path_join(make(rows))) == by_definition(list(enumerate(rows)))
    assert len(made[60]) == len(made[120]) == near.DEPTH
    assert made[60][1] > 0 and sum(made[120]) < 3 * sum(made[60])


def test_near_copies_share_few_buckets(make, monkeypatch):
    """Pairs of near copies: a pair that shares all of its smallest tokens is kept by one bucket, not by one for each token."""
    pick = random.Random(9)
    rows = []
    for i in range(60):
        words = [f"w{i}x{j}" for j in range(100)]
        rows += [" ".join(words), " ".join(words[:-1] + [f"y{pick.randrange(10**6)}"])]
    real, kept = near.keep, {}

    def counted(frame, label):
        made = real(frame, label)
        kept[label] = kept.get(label, 0) + made.count()
        return made

    monkeypatch.setattr(near, "keep", counted)
    assert found(near.chosen_path_join(make(rows))) == by_definition(list(enumerate(rows)))
    assert 120 <= kept["shared"] <= 360
