from __future__ import annotations

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import scoring
from reviewmill.plans import enrich
from reviewmill.sources.writers import overwrite_table

DAY, OTHER = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
GOLD_DDL = "asin string, review_text string, date date, year_month date"


def gold_rows():
    month = dt.date(2024, 1, 1)
    return [
        ("a", "good", DAY, month), ("a", "good", DAY, month), ("b", "so so", DAY, month),
        ("c", None, DAY, month), ("d", "later", OTHER, month),
    ]


def make_scorer():
    def scorer(texts):
        answers = {
            "good": '{"sentiment":"Positive","actionable":"Buy more now","keywords":"a, b, c","response":"Thanks"}',
            "so so": "Sorry, as a model I cannot",
        }
        return [(answers.get(t), 10 + len(t)) for t in texts]

    return scorer


def test_answers_are_parsed(spark, ansi):
    rows = spark.createDataFrame([("good",), ("so so",), ("?",), (None,)], "review_text string")
    found = {r.review_text: r for r in enrich.score_reviews(rows, make_scorer).collect()}
    assert tuple(found["good"])[2:] == ("Positive", "Buy more now", "a, b, c", "Thanks")
    for text in ("so so", "?", None):
        assert tuple(found[text])[2:] == (None, None, None, None)
    assert {t: r.tokens for t, r in found.items()} == {"good": 14, "so so": 15, "?": 11, None: None}


def test_token_total(spark):
    rows = spark.createDataFrame([("good",), ("so so",), (None,)], "review_text string")
    scored = scoring.score_texts(rows, make_scorer)
    assert scoring.token_total(scored).first().total_tokens == 29
    assert scoring.token_total(scored.limit(0)).first().total_tokens == 0


def test_scorer_is_built_once_per_task_and_called_per_group(spark):
    def make_counting():
        import uuid

        name, calls = uuid.uuid4().hex, []

        def scorer(texts):
            calls.append(len(texts))
            return [(f"{name}:{len(calls)}:{len(texts)}", 1) for _ in texts]

        return scorer

    rows = spark.range(100).select(F.col("id").cast("string").alias("review_text"))
    found = scoring.score_texts(rows, make_counting, texts_per_call=10, tasks=4).collect()
    assert len({r.review_insight.split(":")[0] for r in found}) <= 4
    assert max(int(r.review_insight.split(":")[2]) for r in found) == 10
    assert len(found) == 100


def test_wrong_number_of_answers_stops_the_job(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "review_text string").coalesce(1)
    with pytest.raises(Exception, match="one result per text"):
        scoring.score_texts(rows, lambda: lambda texts: [("x", 1)], texts_per_call=2).collect()


def test_call_limit_is_shared_by_all_tasks(spark):
    assert scoring.seconds_between_calls(3500, 1) == pytest.approx(60 / 3500)
    assert scoring.seconds_between_calls(3500, 100) == pytest.approx(6000 / 3500)
    with pytest.raises(ValueError):
        scoring.score_texts(spark.range(1), make_scorer, calls_per_minute=10)

    def make_clock():
        import time

        return lambda texts: [(repr(time.time()), 1) for _ in texts]

    rows = spark.range(24).select(F.col("id").cast("string").alias("review_text"))
    timed = scoring.score_texts(rows, make_clock, calls_per_minute=1200, tasks=2).collect()
    times = sorted(float(r.review_insight) for r in timed)
    # 24 calls at 20 a second: at least (24 - 2) / 20 seconds, however many tasks run.
    assert times[-1] - times[0] >= 0.95 * (24 - 2) / 20


def test_enrich_day(spark, tmp_path):
    gold, table = str(tmp_path / "gold"), str(tmp_path / "enriched")
    overwrite_table(spark.createDataFrame(gold_rows(), GOLD_DDL), gold, "year_month")
    for _ in range(2):
        assert enrich.enrich_day(spark, gold, table, make_scorer, DAY, publish_as="enriched_days") == 2
        assert enrich.enrich_day(spark, gold, table, make_scorer, OTHER, publish_as="enriched_days") == 1
    assert enrich.enrich_day(spark, gold, table, make_scorer, dt.date(2024, 1, 17)) == 0
    for found in (spark.read.parquet(table), spark.table("enriched_days")):
        assert sorted((r.asin, r.sentiment or "", r.date) for r in found.collect()) == [
            ("a", "Positive", DAY), ("b", "", DAY), ("d", "", OTHER),
        ]


def test_backfill_leaves_enriched_days(spark, tmp_path):
    gold, table = str(tmp_path / "gold"), str(tmp_path / "enriched")
    overwrite_table(spark.createDataFrame(gold_rows(), GOLD_DDL), gold, "year_month")

    def label(name):
        return lambda rows: enrich.classify_reviews(rows, lambda: lambda texts: [name] * len(texts))

    only = spark.read.parquet(gold).where(F.col("date") == F.lit(DAY))
    overwrite_table(label("FIRST")(only), table, "date")
    for name in ("SECOND", "THIRD"):
        enrich.backfill(spark, gold, table, label(name))
        found = spark.read.parquet(table)
        assert {(r.date, r.sentiment) for r in found.where("review_text IS NOT NULL").collect()} == {
            (DAY, "First"), (OTHER, "Second"),
        }
    assert found.count() == 5
    enrich.backfill(spark, gold, str(tmp_path / "new"), label("ALL"), first_run=True)
    assert spark.read.parquet(str(tmp_path / "new")).count() == 5


def test_classified_rows_have_all_answer_columns(spark):
    rows = spark.createDataFrame([("good",), ("so so",), (None,)], "review_text string")
    found = enrich.classify_reviews(rows, lambda: lambda texts: ["POSITIVE"] * len(texts))
    assert dict(found.dtypes) == dict.fromkeys(
        ["review_text", "sentiment", "actionable", "keywords", "response"], "string"
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(
        [("good", "Positive", None, "good", None), ("so so", "Positive", None, None, None), (None, None, None, None, None)],
        key=str,
    )


def test_rule_sentiment(spark, ansi):
    texts = ["Good, GREAT stuff", "bad", "good and bad", "goodness", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    label = scoring.rule_sentiment(F.col("t"), ["good", "great"], ["bad"])
    found = {r.t: r.s for r in rows.select("t", label.alias("s")).collect()}
    assert found == dict(zip(texts, ["Positive", "Negative", "Neutral", "Neutral", "Neutral", None]))


def test_scorer_tasks_do_not_import_this_package(tmp_path):
    """A driver that is started elsewhere can score: the task function travels by value."""
    script = f"""
import sys
sys.path.insert(0, {str(__file__).rsplit("/tests/", 1)[0]!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from reviewmill.operators import scoring
rows = spark.createDataFrame([("x",)], "review_text string")
print("ANSWER", scoring.score_texts(rows, lambda: lambda t: [("y", 2)] * len(t)).first().review_insight)
print("LABEL", scoring.classify_texts(rows, lambda: lambda t: ["Z"] * len(t)).first().sentiment)
"""
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "ANSWER y" in run.stdout and "LABEL Z" in run.stdout, run.stderr[-2000:]


def test_backfill_does_not_shuffle_gold_and_scores_null_dates_once(spark, tmp_path):
    gold, table = str(tmp_path / "gold"), str(tmp_path / "enriched")
    rows = spark.createDataFrame([(1, DAY, "good"), (2, OTHER, "bad"), (3, None, "good")], "n int, date date, review_text string")
    rows.write.parquet(gold)
    label = lambda frame: enrich.label_by_rule(frame, ["good"], ["bad"])
    enrich.backfill(spark, gold, table, label, first_run=True)
    left = enrich.not_yet_enriched(spark.read.parquet(gold), spark.read.parquet(table))
    assert left.count() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        left = enrich.not_yet_enriched(spark.read.parquet(gold), spark.read.parquet(table))
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labels_once_per_text(spark, ansi):
    rows = spark.createDataFrame([(1, "good"), (2, "bad bad"), (3, None), (4, "good"), (5, "")], "i int, review_text string")
    seen = []

    def label(texts):
        seen.append(texts.count())
        return enrich.label_by_rule(texts, ["good"], ["bad"])

    once = enrich.label_once(rows, label)
    plain = enrich.label_by_rule(rows, ["good"], ["bad"])
    assert seen == [3] and once.columns == plain.columns
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_reviews_without_text_are_not_joined(spark, tmp_path):
    """They would all meet in the task of the null digest."""
    text = F.when(F.col("id") % 40 == 0, F.concat(F.lit("text "), "id"))
    spark.range(4000).select("id", text.alias("review_text")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    marked = enrich.label_once(rows, lambda texts: texts.withColumn("sentiment", F.lit("Neutral")))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("isnotnull(review_text") == 2 and plan.count("isnull(review_text") == 1
    assert marked.count() == 4000 and marked.where("sentiment is not null").count() == 100
