from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import exact


def by_definition(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    return sorted(
        (key, min(groups[t]), len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
        for key, text in rows for t in [re.sub(r"[\x20\x09-\x0D]+", " ", text or "")]
    )


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60_000])
def test_filter_has_no_false_negative(n):
    pick = np.random.default_rng(n)
    keys = np.unique(pick.integers(0, 2**63, n, dtype=np.uint64))
    fuse = exact.build_filter(keys)
    assert exact.maybe_in(keys, fuse).all()
    others = pick.integers(0, 2**63, 20_000, dtype=np.uint64)
    assert exact.maybe_in(others, fuse).mean() < 0.02
    assert len(fuse["slots"]) < 1.5 * n + 9000


def test_groups(make, odd_texts):
    texts = [*odd_texts, "a  b\tc d", "a b c d ", "é", "é", *["copy of  one"] * 50, *["copy of one"] * 30]
    docs = make(texts)
    found = exact.exact_groups(docs, new=exact.first_half(docs)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == by_definition(list(enumerate(texts)))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


@pytest.mark.parametrize("new", ["true", "false", "doc_id % 2 = 0"])
def test_snapshot_and_batch_split_does_not_matter(make, new):
    texts = ["a", "b", "a", "c", "b", "a", None, ""]
    found = exact.exact_groups(make(texts), new=F.expr(new)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == by_definition(list(enumerate(texts)))


def test_repeated_rows_keep_one(make):
    docs = make(["a", "a", "a", "b", None, "", "z"], ids=[1, 1, 2, 2, None, None, 9])
    found = exact.exact_groups(docs, new=exact.first_half(docs)).collect()
    assert len(found) == 7 and sum(r.kept for r in found) == 4
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == ["", "a", "b", "z"]
    assert {r.doc_id for r in kept.filter("text = 'a'").collect()} == {1}


def test_empty_table(make):
    docs = make(["x"]).limit(0)
    assert exact.exact_groups(docs, new=exact.first_half(docs)).count() == 0
    assert exact.keep_first(docs).count() == 0
