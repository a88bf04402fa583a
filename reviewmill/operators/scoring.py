"""Labels for review text: an injected scorer in Python, or rules in the JVM."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.nested import json_struct
from reviewmill.operators.columns import lift_struct
from reviewmill.schemas import ANSWER

# A scorer takes the texts of one call and returns (answer, tokens used) for each of them.
Scorer = Callable[[Sequence[str]], Sequence[tuple[str, int]]]
Classifier = Callable[[Sequence[str]], Sequence[str]]


def seconds_between_calls(calls_per_minute: float, tasks: int) -> float:
    """Pause per task that keeps all tasks together within the limit."""
    return 60.0 * tasks / calls_per_minute


def score_texts(
    dataframe: DataFrame,
    make_scorer: Callable[[], Scorer],
    *,
    text: str = "review_text",
    answer: str = "review_insight",
    tokens: str = "tokens",
    texts_per_call: int = 1,
    calls_per_minute: float | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Add the scorer's answer and its token count for each text.

    The scorer is built once per task. Only the text column goes to Python, in Arrow
    batches. With a call limit the rows are spread over ``tasks`` tasks and each of them
    waits long enough between calls for all to stay within the limit. Null texts are not sent.
    """
    pause = 0.0
    if calls_per_minute is not None:
        if not tasks:
            raise ValueError("a call limit needs the number of tasks that share it")
        pause = seconds_between_calls(calls_per_minute, tasks)
    if tasks:
        dataframe = dataframe.repartition(tasks)

    # Nested, so that it travels by value and tasks need not import this package.
    def score_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        last_call = None
        for batch in batches:
            # Plain lists: a missing text or answer must reach Spark as null.
            answers: list = [None] * len(batch)
            used: list = [None] * len(batch)
            at = [i for i, missing in enumerate(batch.isna()) if not missing]
            for start in range(0, len(at), texts_per_call):
                chosen = at[start : start + texts_per_call]
                if pause and last_call is not None:
                    time.sleep(max(0.0, last_call + pause - time.monotonic()))
                last_call = time.monotonic()
                results = scorer([batch.iloc[i] for i in chosen])
                if len(results) != len(chosen):
                    raise ValueError("the scorer must return one result per text")
                for i, (said, cost) in zip(chosen, results):
                    answers[i], used[i] = said, cost
            yield pd.DataFrame(
                {"answer": pd.Series(answers, dtype="object"), "tokens": pd.Series(used, dtype="Int64")}
            )

    # A model's answer may change from call to call, so Spark must not repeat it.
    score = F.pandas_udf(score_batches, "answer string, tokens bigint").asNondeterministic()
    scored = dataframe.withColumn("_scored", score(F.col(text)))
    return scored.withColumns(
        {answer: F.col("_scored.answer"), tokens: F.col("_scored.tokens")}
    ).drop("_scored")


def classify_texts(
    dataframe: DataFrame,
    make_classifier: Callable[[], Classifier],
    *,
    text: str = "review_text",
    label: str = "sentiment",
) -> DataFrame:
    """Add a classifier's label, capitalised. The classifier is loaded once per task."""

    def classify_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classifier = make_classifier()
        for batch in batches:
            labels: list = [None] * len(batch)
            at = [i for i, missing in enumerate(batch.isna()) if not missing]
            if at:
                found = classifier([batch.iloc[i] for i in at])
                if len(found) != len(at):
                    raise ValueError("the classifier must return one label per text")
                for i, one in zip(at, found):
                    labels[i] = one.capitalize()
            yield pd.Series(labels, dtype="object")

    classify = F.pandas_udf(classify_batches, "string").asNondeterministic()
    return dataframe.withColumn(label, classify(F.col(text)))


def parse_answer(dataframe: DataFrame, answer: str = "review_insight") -> DataFrame:
    """The answer's four fields as columns; an answer that is not JSON gives nulls."""
    parsed = dataframe.withColumn("_parsed", json_struct(F.col(answer), ANSWER))
    return lift_struct(parsed, "_parsed", drop=[answer])


def token_total(dataframe: DataFrame, tokens: str = "tokens") -> DataFrame:
    return dataframe.agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("total_tokens"))


def rule_sentiment(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """Sentiment by which word list has more distinct words in the text; a tie is neutral.

    The text is split once, and only the listed words that it holds go on.
    """
    words = F.split(F.lower(text), r"[^\p{L}]+")
    listed = F.array(*(F.lit(word) for word in dict.fromkeys([*positive, *negative])))

    def weight(word: Column) -> Column:
        return word.isin(*positive).cast("int") - word.isin(*negative).cast("int")

    lead = F.aggregate(
        F.array_intersect(words, listed), F.lit(0), lambda total, word: total + weight(word)
    )

    def label(by: Column) -> Column:
        return F.when(by > 0, "Positive").when(by < 0, "Negative").when(by == 0, "Neutral")

    # A one-element array, so that the lead is worked out once for all three tests.
    return F.get(F.transform(F.array(lead), label), F.lit(0))
