"""Gold reviews: both review feeds with their product and how each rating compares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.dates import month_start
from reviewmill.operators.dedupe import distinct_rows
from reviewmill.operators.norms import (
    attach_product,
    average_over_products,
    average_through_product,
    group_average,
    product_totals,
    with_average,
    with_deviation,
)
from reviewmill.operators.sets import union_feeds
from reviewmill.operators.skew import HOT_ROWS, hot_keys, left_join_by_size
from reviewmill.schemas import GOLD_COLUMNS, GOLD_METADATA_COLUMNS, REVIEWS
from reviewmill.session import DROP_SHUFFLES, keep, settings_for, size_shuffles
from reviewmill.sources.writers import overwrite_table, publish_table

#: Rows that are dealt by one of the keys of a join stay where they are.
BY_PRODUCT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def compare_reviews(
    reviews: DataFrame,
    metadata: DataFrame,
    *,
    unique_products: bool = False,
    hot_rows: int = HOT_ROWS,
    reviewer_last: bool = False,
    one_shuffle: bool = False,
) -> DataFrame:
    """Reviews with product columns, and better / worse / normal against brand and reviewer.

    Averages are over the joined rows: they count every review, copies included, once per product row. The result is distinct rows, and
    every added column depends on the review and its product alone, so copies are removed before
    the joins: product columns are never part of the distinct. Brand averages
    ride on the product side, which leaves the wide reviews two joins, by reviewer and by product.
    The averages are kept as narrow tables: each is read for its sizes, which tell the hot
    keys and choose the plan, and then joined. Each average gives way to its label before the next shuffle. ``unique_products``
    says that the metadata has one row per product, as silver has. ``reviewer_last`` joins the product first, which is for few
    product columns: rows end dealt by reviewer, and a grouping by reviewer shuffles them no more. ``one_shuffle`` moves the wide
    rows once, by product: each reviewer's average goes to the products that the reviewer has reviewed, in narrow rows. Run it under
    ``BY_PRODUCT``, else there is a second shuffle; with hot products it is not done.
    """
    with settings_for(reviews.sparkSession, DROP_SHUFFLES):
        totals = keep(product_totals(reviews), "product-totals")
    reviewer_average = (
        group_average(reviews, "reviewer_id", "overall", "overall_reviewer")
        if unique_products
        else average_over_products(reviews, metadata, "reviewer_id", "overall_reviewer")
    )
    with settings_for(reviews.sparkSession, DROP_SHUFFLES):
        by_reviewer = keep(reviewer_average, "reviewer-average")
        by_brand = keep(average_through_product(totals, metadata), "brand-average")

    products = metadata.withColumnsRenamed(
        {c: f"{c}_met" for c in metadata.columns if c != "asin" and c in reviews.columns}
    )
    if not unique_products:
        products = distinct_rows(products)
    products = with_average(products, by_brand, "brand", "overall_brand", hot_rows)

    hot_reviewers = hot_keys(by_reviewer, "reviewer_id", hot_rows=hot_rows)
    hot_products = hot_keys(totals, "asin", hot_rows=hot_rows)

    def with_reviewer(rows: DataFrame) -> DataFrame:
        placed = left_join_by_size(rows, by_reviewer.drop("rows"), "reviewer_id", hot_reviewers)
        return with_deviation(placed, "overall_reviewer", "reviewer_deviation").drop("overall_reviewer", "reviewer_deviation")

    def with_product(rows: DataFrame) -> DataFrame:
        placed = attach_product(rows, products, hot=hot_products)
        return with_deviation(placed, "overall_brand", "brand_deviation").drop("overall_brand", "brand_deviation")

    named = ["asin", "reviewer_id", *(c for c in reviews.columns if c not in ("asin", "reviewer_id"))]
    named += [c for c in products.columns if c not in ("asin", "overall_brand")]
    if one_shuffle and hot_products is None:
        # Dealt by a hash of the product that is null for none. Reviewers and products then join within the same deal.
        place = F.xxhash64("asin").alias("_place")
        pairs = reviews.select(place, "reviewer_id").distinct()
        averages = left_join_by_size(pairs, by_reviewer.drop("rows"), "reviewer_id", hot_reviewers)
        rows = distinct_rows(reviews.select("*", place).repartition("_place"))
        rows = rows.join(averages, ["_place", "reviewer_id"], "left")
        rows = with_deviation(rows, "overall_reviewer", "reviewer_deviation")
        rows = rows.join(products.select("*", place), ["_place", "asin"], "left")
        judged = with_deviation(rows, "overall_brand", "brand_deviation")
        judged = judged.select(*named, "brand_deviation_text", "reviewer_deviation_text")
        return judged.withColumn("year_month", month_start(F.col("date")))
    if (hot_products if reviewer_last else hot_reviewers) is None:
        # No key of the first join is large, nor any group of copies: one shuffle by it serves both
        # the distinct and the join. Else the distinct first combines copies on the map side.
        reviews = reviews.repartition("asin" if reviewer_last else "reviewer_id")
    rows = distinct_rows(reviews)
    judged = with_reviewer(with_product(rows)) if reviewer_last else with_product(with_reviewer(rows))
    judged = judged.select(*named, "brand_deviation_text", "reviewer_deviation_text")
    return judged.withColumn("year_month", month_start(F.col("date")))


def streamed_reviews(silver_events: DataFrame) -> DataFrame:
    """Silver events as reviews: their partition day is the review date."""
    return silver_events.withColumn("date", F.to_date("date_utc"))


def gold_reviews(
    batch: DataFrame,
    events: DataFrame,
    metadata: DataFrame,
    *,
    unique_products: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The gold table from the three silver tables."""
    reviews = union_feeds(REVIEWS, batch, streamed_reviews(events))
    products = metadata.select(*GOLD_METADATA_COLUMNS)
    compared = compare_reviews(
        reviews, products, unique_products=unique_products, hot_rows=hot_rows, one_shuffle=True
    )
    return compared.select(*GOLD_COLUMNS)


def write_gold(
    spark: SparkSession, batch: str, events: str, metadata: str, table: str, hot_rows: int = HOT_ROWS
) -> None:
    """Gold job: read silver, overwrite the gold table, partitioned by month.

    Shuffles start with as many partitions as the input's size asks for. A reviewer, product
    or brand with more than ``hot_rows`` rows (or 1 / 100,000 of all, where that is more) is spread over many tasks. Rows are
    written where they are joined, without a shuffle by month.
    """
    size_shuffles(spark, batch, events, metadata)
    read = spark.read.parquet
    rows = gold_reviews(read(batch), read(events), read(metadata), hot_rows=hot_rows)
    with settings_for(spark, BY_PRODUCT):
        overwrite_table(rows, table, "year_month", spread=False)


def publish_gold(spark: SparkSession, table: str, name: str, **options) -> None:
    """Publish the gold table under a catalog name."""
    publish_table(spark.read.parquet(table), name, **options)
