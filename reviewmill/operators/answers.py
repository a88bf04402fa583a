"""Answers that are paid for once: a store by text digest, filled in rounds, with retries.

Texts are scored once each, however many rows hold them. A call that fails is tried again after a growing pause; a text
whose call keeps failing stays without an answer and stops nothing else. After every round the new answers are in the store, so a
job that fails loses one round at most, and a rerun asks for the missing texts only.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators.scoring import Scorer, seconds_between_calls
from reviewmill.sources.storage import Store

SCHEMA = "digest string, answer string, tokens bigint, attempts int"
#: Texts scored between two writes to the store.
TEXTS_PER_ROUND = 100_000


class UnansweredTexts(RuntimeError):
    """Texts whose calls failed every time; the answers of all others are in the store."""


def read_answers(spark: SparkSession, store: str) -> DataFrame:
    """One row per text digest that has an answer."""
    if not Store(spark, store).exists(store):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(store).dropDuplicates(["digest"])


def _missing(rows: DataFrame, store: str, text: str) -> DataFrame:
    texts = rows.where(F.col(text).isNotNull()).select(F.sha2(F.col(text), 256).alias("digest"), F.col(text).alias("text"))
    return texts.dropDuplicates(["digest"]).join(read_answers(rows.sparkSession, store).select("digest"), "digest", "left_anti")


def _ask(
    texts: DataFrame,
    make_scorer: Callable[[], Scorer],
    texts_per_call: int,
    pause: float,
    attempts: int,
    backoff: float,
) -> DataFrame:
    # Nested, so that it travels by value and tasks need not import this package.
    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, last_call = make_scorer(), None
        for frame in frames:
            for start in range(0, len(frame), texts_per_call):
                part = frame.iloc[start : start + texts_per_call]
                for attempt in range(1, attempts + 1):
                    if pause and last_call is not None:
                        time.sleep(max(0.0, last_call + pause - time.monotonic()))
                    last_call = time.monotonic()
                    try:
                        results = scorer(part["text"].tolist())
                    except Exception:
                        if attempt < attempts:
                            time.sleep(backoff * 2 ** (attempt - 1))
                        continue
                    if len(results) != len(part):
                        raise ValueError("the scorer must return one result per text")
                    said, cost = zip(*results)
                    yield pd.DataFrame(
                        {
                            "digest": part["digest"].to_numpy(),
                            "answer": pd.Series(said, dtype="object"),
                            "tokens": pd.Series(cost, dtype="Int64"),
                            "attempts": attempt,
                        }
                    )
                    break

    return texts.select("digest", "text").mapInPandas(ask, SCHEMA)


def fill_answers(
    rows: DataFrame,
    store: str,
    make_scorer: Callable[[], Scorer],
    *,
    text: str = "review_text",
    texts_per_call: int = 1,
    calls_per_minute: float | None = None,
    tasks: int | None = None,
    attempts: int = 4,
    backoff: float = 1.0,
    texts_per_round: int = TEXTS_PER_ROUND,
) -> int:
    """Score the texts that the store lacks and return how many are still without an answer."""
    pause = 0.0
    if calls_per_minute is not None:
        if not tasks:
            raise ValueError("a call limit needs the number of tasks that share it")
        pause = seconds_between_calls(calls_per_minute, tasks)
    rounds = -(-_missing(rows, store, text).count() // texts_per_round)
    for number in range(rounds):
        # By digest, so that the rounds share no text and do not depend on what is missing.
        share = F.pmod(F.xxhash64("digest"), F.lit(rounds)) == number
        asked = _missing(rows, store, text).where(share)
        dealt = asked.repartition(tasks, "digest") if tasks else asked
        _ask(dealt, make_scorer, texts_per_call, pause, attempts, backoff).write.mode("append").parquet(store)
    return _missing(rows, store, text).count() if rounds else 0


def with_answers(
    rows: DataFrame, store: str, *, text: str = "review_text", answer: str = "review_insight", tokens: str = "tokens"
) -> DataFrame:
    """The rows with the stored answer to their text and the tokens that it took; null without one."""
    found = read_answers(rows.sparkSession, store).select(
        F.col("digest").alias("_digest"), F.col("answer").alias(answer), F.col("tokens").alias(tokens)
    )
    return rows.withColumn("_digest", F.sha2(F.col(text), 256)).join(found, "_digest", "left").drop("_digest")


def score_stored(
    rows: DataFrame, store: str, make_scorer: Callable[[], Scorer], *, text: str = "review_text", partial: bool = False, **how
) -> DataFrame:
    """Fill the store for these rows and add the answers; raises if some are missing, unless ``partial``."""
    missing = fill_answers(rows, store, make_scorer, text=text, **how)
    if missing and not partial:
        raise UnansweredTexts(f"{missing} texts have no answer yet")
    return with_answers(rows, store, text=text)
