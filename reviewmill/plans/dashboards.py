"""Data of the product dashboard and the brand and reviewer dashboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.operators.dedupe import top_per_key
from reviewmill.sources.writers import overwrite_partitions, replace_day

#: Keywords that a product's sketch follows; its counts are exact while a product has fewer than three quarters of it.
KEYWORDS_TRACKED = 1024


def product_dashboard(enriched: DataFrame, key: str = "asin") -> DataFrame:
    """Reviews, mean rating and sentiment mix per product."""

    def share(label: str):
        return F.avg(F.when(F.col("sentiment") == label, 1.0).otherwise(0.0))

    return enriched.groupBy(key).agg(
        F.count("*").alias("reviews"),
        F.avg("overall").alias("mean_rating"),
        share("Positive").alias("positive_share"),
        share("Neutral").alias("neutral_share"),
        share("Negative").alias("negative_share"),
    )


def product_keywords(enriched: DataFrame, k: int, key: str = "asin") -> DataFrame:
    """The k keywords named most often per product, ties by keyword."""
    counted = _keywords(enriched, key).groupBy(key, "keyword").agg(F.count("*").alias("n"))
    return top_per_key(counted, [key], [F.desc("n"), F.col("keyword")], k)


def _keywords(enriched: DataFrame, *keys: str) -> DataFrame:
    words = enriched.select(*keys, F.explode(F.split(F.lower("keywords"), ",")).alias("keyword"))
    return words.withColumn("keyword", F.regexp_replace("keyword", r"^\s+|\s+$", "")).where("keyword <> ''")


def product_days(enriched: DataFrame, key: str = "asin", day: str = "date") -> DataFrame:
    """One row per day and product: sums from which the dashboard of any days follows."""

    def labelled(label: str):
        return F.count_if(F.col("sentiment") == label)

    return enriched.groupBy(day, key).agg(
        F.count("*").alias("reviews"),
        F.sum("overall").cast("double").alias("rating_sum"),
        F.count("overall").alias("ratings"),
        labelled("Positive").alias("positive"),
        labelled("Neutral").alias("neutral"),
        labelled("Negative").alias("negative"),
    )


def keyword_days(enriched: DataFrame, key: str = "asin", day: str = "date", tracked: int = KEYWORDS_TRACKED) -> DataFrame:
    """One row per day and product with a mergeable sketch of its most frequent keywords."""
    sketch = F.expr(f"approx_top_k_accumulate(keyword, {int(tracked)})")
    return _keywords(enriched, day, key).groupBy(day, key).agg(sketch.alias("sketch"))


def product_totals(days: DataFrame, key: str = "asin") -> DataFrame:
    """The product dashboard, rolled up from daily sums."""

    def share(label: str):
        return (F.sum(label) / F.sum("reviews")).alias(f"{label}_share")

    return days.groupBy(key).agg(
        F.sum("reviews").alias("reviews"),
        F.try_divide(F.sum("rating_sum"), F.sum("ratings")).alias("mean_rating"),
        share("positive"),
        share("neutral"),
        share("negative"),
    )


def keyword_totals(days: DataFrame, k: int, key: str = "asin") -> DataFrame:
    """The k most frequent keywords per product, from daily sketches; ties by keyword among those the sketch returns."""
    merged = days.groupBy(key).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {KEYWORDS_TRACKED}), {KEYWORDS_TRACKED})").alias("top"))
    counted = merged.select(key, F.inline("top")).select(key, F.col("item").alias("keyword"), F.col("count").alias("n"))
    return top_per_key(counted, [key], [F.desc("n"), F.col("keyword")], k)


def write_dashboard_days(enriched: DataFrame, folder: str, key: str = "asin", day: str = "date") -> None:
    """First load, or days worked out anew: both partial tables, the days of the rows replaced."""
    overwrite_partitions(product_days(enriched, key, day), f"{folder}/products", day)
    overwrite_partitions(keyword_days(enriched, key, day), f"{folder}/keywords", day)


def add_dashboard_day(
    spark: SparkSession,
    enriched: str,
    folder: str,
    day: dt.date,
    key: str = "asin",
    by: str = "date",
    schema: StructType | None = None,
) -> int:
    """Daily job: read one day of the enriched table and replace it in both partial tables; returns its products.

    With the table's schema no file of another day is opened, not even to learn the columns.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(enriched).where(F.col(by) == F.lit(day))
    replace_day(keyword_days(rows, key, by), f"{folder}/keywords", day, by)
    return replace_day(product_days(rows, key, by), f"{folder}/products", day, by)


def brand_outliers(gold: DataFrame) -> DataFrame:
    """Per brand and reviewer, side by side: how the ratings lie to the brand's average and to the reviewer's own.

    ``against_brand`` is the share of ratings above the brand's average less that below; ``against_own`` the same for the
    reviewer's own average. Their difference says whether it is the brand that the reviewer singles out.
    """

    def lean(column: str):
        text = F.col(f"{column}_deviation_text")
        return F.avg(F.when(text == "better", 1.0).when(text == "worse", -1.0).otherwise(0.0))

    rows = gold.where(F.col("brand").isNotNull() & F.col("reviewer_id").isNotNull())
    sides = rows.groupBy("brand", "reviewer_id").agg(
        F.count("*").alias("reviews"), lean("brand").alias("against_brand"), lean("reviewer").alias("against_own")
    )
    return sides.withColumn("singled_out", F.col("against_brand") - F.col("against_own"))


def reviewer_outliers(gold: DataFrame) -> DataFrame:
    """Per reviewer: how often the rating is off the reviewer's own and the brand's average."""

    def share(column: str, label: str):
        return F.avg(F.when(F.col(f"{column}_deviation_text") == label, 1.0).otherwise(0.0)).alias(
            f"{label}_than_{column}"
        )

    return (
        gold.where(F.col("reviewer_id").isNotNull())
        .groupBy("reviewer_id")
        .agg(
            F.count("*").alias("reviews"),
            share("brand", "better"),
            share("brand", "worse"),
            share("reviewer", "better"),
            share("reviewer", "worse"),
        )
    )
