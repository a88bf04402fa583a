"""Answers that are paid for once."""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections import Counter

import pytest

from reviewmill.operators import answers
from reviewmill.plans import enrich


def counting_scorer(folder, fails=lambda call, texts: False):
    """A scorer that leaves a file per successful call and fails when told so."""
    os.makedirs(folder, exist_ok=True)

    def make_scorer():
        calls = [0]

        def score(texts):
            calls[0] += 1
            if fails(calls[0], texts):
                raise ConnectionError("busy")
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                json.dump(texts, out)
            return [(json.dumps({"sentiment": text.upper()}), len(text)) for text in texts]

        return score

    return make_scorer


def paid(folder):
    return Counter(text for name in os.listdir(folder) for text in json.load(open(f"{folder}/{name}")))


def reviews(spark, n, repeats=2):
    rows = [(i, f"text {i % n}") for i in range(n * repeats)] + [(-1, None)]
    return spark.createDataFrame(rows, "i long, review_text string").repartition(5)


@pytest.mark.parametrize("per_call", [1, 7])
def test_every_tenth_call_fails_and_nothing_is_paid_twice(spark, tmp_path, per_call):
    folder, store = str(tmp_path / "calls"), str(tmp_path / "store")
    scorer = counting_scorer(folder, lambda call, _: call % 10 == 0)
    found = answers.score_stored(
        reviews(spark, 150), store, scorer, texts_per_call=per_call, tasks=3, backoff=0.0, texts_per_round=40
    )
    rows = {r.i: (r.review_insight, r.tokens) for r in found.collect()}
    assert len(rows) == 301 and rows[-1] == (None, None)
    assert all(rows[i] == (json.dumps({"sentiment": f"TEXT {i % 150}"}), len(f"text {i % 150}")) for i in range(300))
    assert paid(folder) == Counter({f"text {i}": 1 for i in range(150)})
    if per_call == 1:  # with seven texts a call no task comes to a tenth call in a round
        assert answers.read_answers(spark, store).agg({"attempts": "max"}).first()[0] == 2


def test_a_rerun_pays_only_for_what_is_missing(spark, tmp_path):
    folder, store = str(tmp_path / "calls"), str(tmp_path / "store")
    refuses = counting_scorer(folder, lambda _, texts: any(t.endswith("3") for t in texts))
    rows = reviews(spark, 40)
    with pytest.raises(answers.UnansweredTexts, match="4 texts"):
        answers.score_stored(rows, store, refuses, tasks=4, attempts=2, backoff=0.0)
    partly = answers.score_stored(rows, store, refuses, tasks=4, attempts=1, partial=True)
    assert partly.where("review_insight is null and review_text is not null").count() == 8
    assert answers.fill_answers(rows, store, counting_scorer(folder), tasks=4) == 0
    assert answers.fill_answers(rows, store, counting_scorer(folder), tasks=4) == 0
    assert paid(folder) == Counter({f"text {i}": 1 for i in range(40)})


def test_a_job_that_dies_keeps_the_rounds_before(spark, tmp_path):
    folder, store = str(tmp_path / "calls"), str(tmp_path / "store")
    good = counting_scorer(folder)

    def wrong():
        score, calls = good(), [0]

        def one_short(texts):  # not a failed call but a broken scorer: it must stop the job
            calls[0] += 1
            return score(texts)[1:] if "text 17" in texts else score(texts)

        return one_short

    rows = reviews(spark, 60)
    with pytest.raises(Exception, match="one result per text"):
        answers.fill_answers(rows, store, wrong, tasks=2, texts_per_round=10)
    kept = answers.read_answers(spark, store).count() if os.path.exists(store) else 0
    before = paid(folder)
    assert answers.fill_answers(rows, store, good, tasks=2, texts_per_round=10) == 0
    again = paid(folder)
    assert answers.read_answers(spark, store).count() == 60
    assert sum(again.values()) - sum(before.values()) == 60 - kept


def test_call_limit_needs_tasks(spark, tmp_path):
    with pytest.raises(ValueError, match="number of tasks"):
        answers.fill_answers(reviews(spark, 2), str(tmp_path / "s"), counting_scorer(str(tmp_path / "c")), calls_per_minute=10)


def test_no_texts(spark, tmp_path):
    rows = spark.createDataFrame([(1, None)], "i long, review_text string")
    found = answers.score_stored(rows, str(tmp_path / "s"), counting_scorer(str(tmp_path / "c")))
    assert [tuple(r) for r in found.select("i", "review_insight", "tokens").collect()] == [(1, None, None)]


def test_daily_job_with_a_store(spark, tmp_path):
    folder, gold = str(tmp_path / "calls"), str(tmp_path / "gold")
    day = dt.date(2024, 1, 5)
    month = dt.date(2024, 1, 1)
    rows = [(f"a{i}", f"text {i % 6}", day if i % 2 else dt.date(2024, 1, 6), month) for i in range(24)]
    spark.createDataFrame(rows, "asin string, review_text string, date date, year_month date").write.parquet(gold)
    for _ in range(2):
        n = enrich.enrich_day(
            spark, gold, str(tmp_path / "t"), counting_scorer(folder, lambda call, _: call == 2), day,
            calls_per_minute=None, tasks=2, answers=str(tmp_path / "store"), backoff=0.0,
        )
        assert n == 12
    table = spark.read.parquet(str(tmp_path / "t"))
    assert {r.sentiment for r in table.collect()} == {"TEXT 1", "TEXT 3", "TEXT 5"}
    assert paid(folder) == Counter({"text 1": 1, "text 3": 1, "text 5": 1})
