"""Group averages, and how far each rating is from them.

The averages are joined back rather than taken over a window: a window would give
rows without a brand an average of their own, and would pull a hot brand into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.rating import deviation, deviation_label
from reviewmill.operators.skew import HOT_ROWS, hot_keys, left_join_by_size


def attach_product(
    reviews: DataFrame, metadata: DataFrame, key: str = "asin", hot: DataFrame | None = None
) -> DataFrame:
    """Left join of product columns; reviews of unknown products stay.

    No hint: Spark broadcasts the products when they measure small. ``hot`` comes from ``hot_keys``.
    """
    return left_join_by_size(reviews, metadata, key, hot)


def group_average(dataframe: DataFrame, key: str, rating: str, name: str) -> DataFrame:
    """Average rating and rows per key. The null key has a row too, but it never joins."""
    return dataframe.groupBy(key).agg(F.avg(rating).alias(name), F.count("*").alias("rows"))


def average_over_products(
    reviews: DataFrame,
    metadata: DataFrame,
    group: str,
    name: str,
    *,
    key: str = "asin",
    rating: str = "overall",
) -> DataFrame:
    """Average rating and rows per group over reviews joined to products that may have several rows.

    A review counts once per row of its product, and once if it has none. Only narrow totals are
    joined. ``rows`` counts the reviews.
    """
    repeated = metadata.groupBy(key).agg(F.count("*").alias("_times"))
    totals = reviews.groupBy(group, key).agg(
        F.sum(rating).alias("_sum"), F.count(rating).alias("_n"), F.count("*").alias("rows")
    )
    times = F.coalesce("_times", F.lit(1))
    return (
        totals.join(repeated, key, "left")
        .groupBy(group)
        .agg(
            F.try_divide(F.sum(F.col("_sum") * times), F.sum(F.col("_n") * times)).alias(name),
            F.sum("rows").alias("rows"),
        )
    )


def product_totals(reviews: DataFrame, key: str = "asin", rating: str = "overall") -> DataFrame:
    """Sum and number of ratings, and rows, per product."""
    return reviews.groupBy(key).agg(
        F.sum(rating).alias("rating_sum"),
        F.count(rating).alias("ratings"),
        F.count("*").alias("rows"),
    )


def average_through_product(
    totals: DataFrame,
    metadata: DataFrame,
    *,
    key: str = "asin",
    group: str = "brand",
    name: str = "overall_brand",
) -> DataFrame:
    """Average rating per product attribute, the same as over the joined rows.

    It starts from ``product_totals``, so the join sees one narrow row per product and no
    review text moves. ``rows`` counts the products of the attribute, ``reviews`` their reviews.
    """
    return (
        metadata.select(key, group)
        .join(totals, key, "left")
        .groupBy(group)
        .agg(
            F.try_divide(F.sum("rating_sum"), F.sum("ratings")).alias(name),
            F.count("*").alias("rows"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("reviews"),
        )
    )


def with_average(
    dataframe: DataFrame, averages: DataFrame, key: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join a group's average back to its rows; a null key matches nothing.

    Hot groups are salted by the ``rows`` that come with the averages. The averages are
    looked at before they are joined, so give a table, not a plan that would run twice.
    """
    hot = hot_keys(averages, key, hot_rows=hot_rows)
    return left_join_by_size(dataframe, averages.select(key, name), key, hot)


def with_deviation(
    dataframe: DataFrame, average: str, name: str, rating: str = "overall"
) -> DataFrame:
    """Add ``<name>`` (rating minus average) and ``<name>_text`` (better, worse, normal)."""
    difference = deviation(F.col(rating), F.col(average))
    return dataframe.withColumns({name: difference, f"{name}_text": deviation_label(difference)})
