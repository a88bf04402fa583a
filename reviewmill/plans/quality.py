"""The data-quality report of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.dates import month_start, year_start
from reviewmill.functions.rating import keyword_sentiment
from reviewmill.functions.text import one_word, word_count
from reviewmill.operators.counts import value_frequency
from reviewmill.operators.profile import missing_tests


def quality_profile(
    dataframe: DataFrame,
    value_columns: Sequence[str] = (),
    *,
    day: str | None = None,
    keys: Sequence[str] = (),
    text: str | None = None,
    rating: str | None = None,
) -> DataFrame:
    """The report as (section, column_name, value, amount), in one scan and one count.

    Sections: ``rows``; ``missing``, the share of missing values per text or array column; ``value``, rows per
    value of the given columns; ``month`` and ``year``, rows per month and year of ``day``; ``key``, groups,
    largest group and skew of each candidate key; ``keyword``, rows per keyword, rating and sentiment.
    Every row becomes one short row per figure, which combine before the shuffle.
    """

    def entry(section: str, column: str | None, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(column).cast("string").alias("column_name"),
            value.cast("string").alias("value"),
        )

    entries = [entry("rows", None, F.lit(None))]
    for name, kind, missing in missing_tests(dataframe):
        entries.append(entry(f"missing {kind}", name, F.when(missing, "missing").otherwise("there")))
    entries += [entry("value", name, F.col(f"`{name}`")) for name in value_columns]
    if day:
        entries += [entry("month", day, month_start(F.col(day))), entry("year", day, year_start(F.col(day)))]
    entries += [entry("key", name, F.col(f"`{name}`")) for name in keys]
    if text and rating:
        keyword = one_word(F.col(text), word_count(F.col(text)))
        said = F.array(keyword, F.col(rating).cast("string"), keyword_sentiment(keyword, F.col(rating)))
        entries.append(entry("keyword", text, F.array_join(said, "|", "")))
    counted = dataframe.select(F.inline(F.array(*entries))).groupBy("section", "column_name", "value").agg(
        F.count("*").alias("n")
    )
    pooled = F.col("section").startswith("missing") | (F.col("section") == "key")
    sums = counted.groupBy("section", "column_name", F.when(~pooled, F.col("value")).alias("value")).agg(
        F.sum("n").cast("double").alias("n"),
        F.coalesce(F.sum(F.when(F.col("value") == "missing", F.col("n"))), F.lit(0)).alias("absent"),
        F.count("*").cast("double").alias("groups"),
        F.max("n").cast("double").alias("largest"),
    )

    def figure(value: Column, amount: Column) -> Column:
        return F.struct(value.cast("string").alias("value"), amount.cast("double").alias("amount"))

    missing = F.array(figure(F.element_at(F.split("section", " ", 2), 2), F.col("absent") / F.col("n")))
    key = F.array(
        figure(F.lit("groups"), F.col("groups")),
        figure(F.lit("largest_group"), F.col("largest")),
        figure(F.lit("skew"), F.col("largest") * F.col("groups") / F.col("n")),
    )
    figures = (
        F.when(F.col("section").startswith("missing"), missing)
        .when(F.col("section") == "key", key)
        .otherwise(F.array(figure(F.col("value"), F.col("n"))))
    )
    section = F.element_at(F.split("section", " "), 1).alias("section")
    return sums.select(section, "column_name", F.inline(figures))


def keyword_report(reviews: DataFrame, text: str = "review_text", rating: str = "overall") -> DataFrame:
    """Count per keyword, rating and the sentiment the two imply."""
    keyword = one_word(F.col(text), word_count(F.col(text)))
    labelled = reviews.select(keyword.alias("keyword"), F.col(rating).alias("overall")).withColumn(
        "sentiment", keyword_sentiment(F.col("keyword"), F.col("overall"))
    )
    return value_frequency(labelled, "keyword", "overall", "sentiment")
