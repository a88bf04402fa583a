"""Counts against their definition; fences by group; rows that come back."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from reviewmill.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_definition(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_counts(make, odd_texts):
    pick = random.Random(3)
    texts = [*odd_texts, *(" ".join(pick.choice(["a", "b", "c#", "d|"]) for _ in range(pick.randint(0, 60))) for _ in range(60))]
    rows = quality.measure(make(texts)).collect()
    assert {r.doc_id: tuple(r.q) for r in rows} == {i: by_definition(t) for i, t in enumerate(texts)}
    assert {(r.body, r.id, r.row, r._w) for r in rows} == {("b", 7, "r", 4)}


def test_fences_adapt_to_language_and_source(make):
    plain = [" ".join(f"word{(i * 7 + j) % 500}" for j in range(80)) for i in range(120)]
    marked = [" ".join(f"word{(i * 5 + j) % 500}#" for j in range(80)) for i in range(120)]
    docs = make([*plain, *marked, marked[0]], sources=["p"] * 120 + ["m"] * 120 + ["p"])
    kept = {r.doc_id: r.kept for r in quality.judge(quality.measure(docs)).select("doc_id", "kept").collect()}
    # What is usual in one source is far out in another.
    assert all(kept[i] for i in range(240)) and not kept[240]


def test_small_groups_take_the_wider_sketch(make):
    texts = [" ".join(f"word{(i * 7 + j) % 500}" for j in range(80)) for i in range(100)]
    docs = make([*texts, "#" + " #".join(texts[0].split())], sources=["big"] * 99 + [None, "tiny"], langs=["en"] * 100 + [None])
    kept = {r.doc_id: r.kept for r in quality.judge(quality.measure(docs)).select("doc_id", "kept").collect()}
    assert kept[99] and not kept[100]


def test_kept_rows_come_back_whole(make, odd_texts):
    good = " ".join(f"word{j}" for j in range(200))
    docs = make([*odd_texts, good, good], ids=[*range(len(odd_texts)), 50, 50])
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns
    assert Counter(kept.filter("doc_id = 50").collect()) == Counter(docs.filter("doc_id = 50").collect())
    assert kept.filter("text is null or text = ''").count() == 0


def test_empty_table(make):
    docs = make(["x"]).limit(0)
    assert quality.keep_quality(docs).count() == 0
    assert quality.judge(quality.measure(docs)).count() == 0


def test_no_python_runs(make):
    plan = quality.keep_quality(make(["x"]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("share, failed", [(40, False), (60, True)])
def test_base_rule_of_repeated_words(make, share, failed):
    words = [f"w{i}" for i in range(100 - share)] + ["a", "b", "c"] * (share // 3)
    row = quality.judge(quality.measure(make([" ".join(words)]))).first()
    assert row.base_failed is failed
