"""Enrichment of gold reviews with sentiment, advice, keywords and a response."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.dates import default_run_date
from reviewmill.functions.text import one_word, word_count
from reviewmill.operators.answers import score_stored
from reviewmill.operators.columns import typed_null
from reviewmill.operators.dedupe import distinct_rows
from reviewmill.operators.filters import on_day
from reviewmill.operators.scoring import (
    Classifier,
    Scorer,
    classify_texts,
    parse_answer,
    rule_sentiment,
    score_texts,
)
from reviewmill.sources.writers import overwrite_partitions, publish_day, replace_day

# Fixed value: call limit of the scoring service.
CALLS_PER_MINUTE = 3500
# Tasks that share the limit: at the limit each waits about a second between calls.
SCORING_TASKS = 64


def reviews_to_score(gold: DataFrame, day: dt.date) -> DataFrame:
    """Distinct reviews of one day that have a text."""
    return distinct_rows(on_day(gold, day).where(F.col("review_text").isNotNull()))


def score_reviews(reviews: DataFrame, make_scorer: Callable[[], Scorer], **limits) -> DataFrame:
    """Reviews with the four fields of the scorer's answer and the tokens it took."""
    return parse_answer(score_texts(reviews, make_scorer, **limits))


def enrich_day(
    spark: SparkSession,
    gold: str,
    table: str,
    make_scorer: Callable[[], Scorer],
    day: dt.date | None = None,
    publish_as: str | None = None,
    calls_per_minute: float | None = CALLS_PER_MINUTE,
    tasks: int = SCORING_TASKS,
    answers: str | None = None,
    **limits,
) -> int:
    """Daily job: score one day's reviews, replace that day in the table, publish that day.

    The scorer runs once: the table is read back for everything after it. One day is small in
    bytes but slow to score, so it is spread over ``tasks`` tasks, which share the call limit; None
    lifts the limit. With ``answers``, a store of answers by text, failed calls are tried again, equal
    texts are scored once, and a rerun pays only for what the store lacks. Returns the row count.
    """
    day = day or default_run_date()
    limits |= {"calls_per_minute": calls_per_minute, "tasks": tasks}
    reviews = reviews_to_score(spark.read.parquet(gold), day)
    if answers:
        scored = parse_answer(score_stored(reviews, answers, make_scorer, **limits))
    else:
        scored = score_reviews(reviews, make_scorer, **limits)
    rows = replace_day(scored, table, day)
    if publish_as:
        publish_day(spark.read.parquet(table), publish_as, day)
    return rows


def with_placeholders(labelled: DataFrame) -> DataFrame:
    """The answer columns a classifier does not give; a one-word review is its own keyword."""
    words = word_count(F.col("review_text"))
    return labelled.select(
        "*",
        typed_null("actionable"),
        one_word(F.col("review_text"), words).alias("keywords"),
        typed_null("response"),
    )


def classify_reviews(reviews: DataFrame, make_classifier: Callable[[], Classifier]) -> DataFrame:
    """Reviews labelled by a local classifier."""
    return with_placeholders(classify_texts(reviews, make_classifier))


def label_by_rule(
    reviews: DataFrame, positive: Sequence[str], negative: Sequence[str]
) -> DataFrame:
    """Reviews labelled by word lists, all in the JVM: needs no model and no network."""
    sentiment = rule_sentiment(F.col("review_text"), positive, negative)
    return with_placeholders(reviews.withColumn("sentiment", sentiment))


def label_once(
    reviews: DataFrame, label: Callable[[DataFrame], DataFrame], text: str = "review_text"
) -> DataFrame:
    """Labels worked out once per distinct text and joined back by its digest, for feeds whose texts repeat.

    ``label`` adds its columns to a frame of texts. Where the texts are not needed any more, only digests are shuffled
    on the reviews' side. Reviews without a text have no label and take no part in the join, where they would all
    meet in one task.
    """
    keyed = reviews.where(F.col(text).isNotNull()).withColumn("_digest", F.sha2(F.col(text), 256))
    labels = label(keyed.groupBy("_digest").agg(F.first(text).alias(text))).drop(text)
    labelled = keyed.join(labels, "_digest", "left").drop("_digest")
    none = {f.name: F.lit(None).cast(f.dataType) for f in labels.schema if f.name != "_digest"}
    return labelled.unionByName(reviews.where(F.col(text).isNull()).withColumns(none))


def not_yet_enriched(gold: DataFrame, enriched: DataFrame) -> DataFrame:
    """Gold rows of the dates that the enriched table lacks; rows without a date are a date of their own.

    There is one narrow row per day of the calendar, so the days are broadcast and gold is not shuffled.
    """
    days = F.broadcast(enriched.select(F.col("date").alias("_day")).distinct())
    return gold.join(days, F.col("date").eqNullSafe(F.col("_day")), "left_anti")


def backfill(
    spark: SparkSession,
    gold: str,
    table: str,
    label: Callable[[DataFrame], DataFrame],
    first_run: bool = False,
) -> None:
    """Historic job: label all dates that are not in the table; days already there stay."""
    rows = spark.read.parquet(gold)
    if not first_run:
        rows = not_yet_enriched(rows, spark.read.parquet(table))
    overwrite_partitions(label(rows), table, "date")
