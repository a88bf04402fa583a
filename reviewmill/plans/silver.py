"""Silver tables: cleaned values, one row per product, distinct reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType, StructField, StructType

from reviewmill.functions.dates import long_date
from reviewmill.functions.nested import (
    best_rank,
    first_item,
    first_or_unknown,
    image_links,
    json_struct,
    rank_entries,
    rank_summary,
    without,
)
from reviewmill.functions.text import (
    EMPTY_OBJECT,
    clean_category,
    clean_title,
    decode_entities,
    null_if,
    one_word,
    price_to_float,
    word_count,
)
from reviewmill.operators.columns import lift_struct
from reviewmill.operators.dedupe import distinct_rows, latest_per_key, once_and_several
from reviewmill.schemas import EVENT_BODY
from reviewmill.sources.readers import read_table
from reviewmill.sources.writers import overwrite_table

# Event body fields and their names in the tables.
EVENT_NAMES = {
    "reviewText": "review_text",
    "reviewerID": "reviewer_id",
    "reviewerName": "reviewer_name",
}

# Fields of a review that are cleaned, or too long to be compared first.
CLEANED = ("image", "reviewer_name", "review_text")


def clean_metadata(products: DataFrame) -> DataFrame:
    """Clean each product field; ``date`` is a date already or long-form text."""
    column = F.col
    ranked = products.withColumn("rank", rank_entries(column("rank")))
    return ranked.withColumns(
        {
            "higher_rank": rank_summary(column("rank")),
            "best_rank": best_rank(column("rank")),
            "main_cat": clean_category(column("main_cat")),
            "first_category": first_or_unknown(column("category")),
            "details": null_if(column("details"), EMPTY_OBJECT),
            "feature": without(column("feature"), ""),
            "fit": null_if(column("fit"), ""),
            "description": first_item(column("description")),
            "price": price_to_float(column("price")),
            "title": clean_title(column("title")),
        }
    )


def silver_metadata(
    bronze: DataFrame, tiebreak: Sequence[str | Column] = (), key: str = "asin"
) -> DataFrame:
    """The latest row per product, cleaned.

    Rows are chosen before they are cleaned, so older versions cost no parsing. One row
    per key leaves nothing for a later distinct to remove.
    """
    dated = bronze.drop("parsed_date").withColumn("date", long_date(F.col("date")))
    return clean_metadata(latest_per_key(dated, key, "date", tiebreak))


def clean_fields(reviews: DataFrame) -> DataFrame:
    """Image list and reviewer name, as both feeds need them."""
    return reviews.withColumns(
        {
            "image": image_links(F.col("image")),
            "reviewer_name": decode_entities(F.col("reviewer_name")),
        }
    )


def with_words(reviews: DataFrame) -> DataFrame:
    """Word count of the text, and the keyword of a one-word review."""
    counted = reviews.withColumn("review_word_count", word_count(F.col("review_text")))
    return counted.withColumn(
        "keyword", one_word(F.col("review_text"), F.col("review_word_count"))
    )


def silver_reviews(bronze: DataFrame) -> DataFrame:
    """Distinct reviews, cleaned.

    Rows are compared once their fields are clean, but only those that share all short fields which cleaning leaves as
    they are: the texts of the others are not shuffled. Word count and keyword follow from the
    text, so they are added after that: each distinct text is split once, and no key is wider for it.
    """
    named = bronze.withColumnsRenamed({"unix_review_time_date": "date"})
    plain = (BooleanType, DateType, IntegralType, StringType)
    fixed = [f.name for f in named.schema if isinstance(f.dataType, plain) and f.name not in CLEANED]
    once, several = once_and_several(named, fixed)
    if several is None:
        return with_words(clean_fields(once))
    distinct = distinct_rows(clean_fields(several))
    return with_words(distinct if once is None else clean_fields(once).unionByName(distinct))


def silver_events(bronze: DataFrame) -> DataFrame:
    """Parsed and cleaned review events; works on a table and on a stream."""
    body = StructType([*EVENT_BODY.fields, StructField("unixReviewTime", StringType())])
    parsed = lift_struct(
        bronze.withColumn("parsed_body", json_struct(F.col("body"), body)), "parsed_body", ["body"]
    )
    # Some producers send the review time under its camel-case name.
    timed = parsed.withColumn(
        "unix_review_time", F.coalesce("unix_review_time", "unixReviewTime")
    ).drop("unixReviewTime")
    return with_words(clean_fields(timed.withColumnsRenamed(EVENT_NAMES)))


def write_silver_metadata(
    spark: SparkSession, bronze: str, table: str, tiebreak: Sequence[str | Column] = ()
) -> None:
    """Silver job: the latest row per product of the bronze table, partitioned by ``year``."""
    overwrite_table(silver_metadata(read_table(spark, bronze), tiebreak), table, "year")


def write_silver_reviews(spark: SparkSession, bronze: str, table: str) -> None:
    """Silver job: the distinct cleaned reviews of the bronze table, partitioned by ``year_month`` like that.

    A task reads whole months or parts of them, so it writes them without a shuffle.
    """
    overwrite_table(silver_reviews(read_table(spark, bronze)), table, "year_month", spread=False)
