"""The test tables in the shape of the feeds.

Reviews come from ``lineitem`` joined to ``orders`` (and ``documents`` for their text),
products from ``part``, review events from ``events``. Each frame has its DuckDB twin in
``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rating():
    """Whole ratings 1 to 5, so that sums and averages are exact."""
    return (F.col("l_quantity") - 1) % 5 + 1


def unix_seconds(moment: str):
    """Seconds since 1970 of a zone-free timestamp, whatever the session time zone is."""
    at = F.col(moment)
    days = F.unix_date(F.to_date(at)).cast("bigint")
    return days * 86400 + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-column reviews."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    # Every seventh line of an order names a product that does not exist.
    reviewed = F.when(F.col("l_linenumber") % 7 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        reviewed.alias("asin"),
        F.col("o_custkey").alias("reviewer_id"),
        rating().alias("overall"),
        F.to_date("l_shipdate").alias("date"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of all parts."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asin"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("main_cat"),
    )


def bronze_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full bronze reviews, with raw image lists and entities in the names."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_linestatus", "l_shipdate"
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        texts, F.col("l_orderkey") == F.col("doc_id"), "left"
    )
    part, line = F.col("l_partkey").cast("string"), F.col("l_linenumber")
    return joined.select(
        part.alias("asin"),
        F.when(line % 4 == 0, F.concat(F.lit('["88","u'), part, F.lit('"]')))
        .when(line % 4 == 1, '["88"]')
        .when(line == 2, "[]")
        .when(line == 3, "not json")
        .alias("image"),
        rating().alias("overall"),
        F.col("text").alias("review_text"),
        F.col("o_custkey").cast("string").alias("reviewer_id"),
        F.concat(F.lit("Ann &amp; &quot;"), F.col("o_custkey"), F.lit("&quot;")).alias(
            "reviewer_name"
        ),
        F.col("o_orderpriority").alias("summary"),
        (F.col("l_linestatus") == "F").alias("verified"),
        F.when(line > 3, line.cast("string")).alias("vote"),
        F.to_date("l_shipdate").alias("unix_review_time_date"),
        F.date_format("l_shipdate", "yyyy-MM").alias("year_month"),
    )


def bronze_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty product rows, two per product; ``similar_item`` holds a unique row name."""
    key, size = F.col("p_partkey"), F.col("p_size")
    nothing = F.array().cast("array<string>")
    day = F.date_add(F.lit("2010-01-01").cast("date"), (key % 2000).cast("int"))
    price = F.concat(F.lit("$"), F.col("p_retailprice").cast("string"))
    entry = F.concat(
        (key % 9 + 1).cast("string"),
        F.lit(","),
        F.lpad((size * 7).cast("string"), 3, "0"),
        F.lit(" in "),
        F.col("p_type"),
    )
    ranks = F.concat(
        F.lit('[">#'), entry, F.lit(' (","'), size.cast("string"), F.lit(" in "),
        F.col("p_brand"), F.lit('","none"]'),
    )
    return table(spark, sf_dir, "part").select(
        F.floor(key / 2).cast("string").alias("asin"),
        F.lpad(key.cast("string"), 12, "0").alias("similar_item"),
        F.array((key + 1).cast("string"), (key + 2).cast("string")).alias("also_buy"),
        F.when(size <= 45, F.col("p_brand")).alias("brand"),
        F.when(size % 3 == 0, F.array("p_type", "p_brand"))
        .when(size % 3 == 1, nothing)
        .alias("category"),
        F.when((size % 4).isin(0, 3), F.date_format(day, "MMMM d, yyyy"))
        .when(size % 4 == 1, "Foo")
        .alias("date"),
        F.when(size % 5 == 0, nothing)
        .when(size % 5 < 4, F.array("p_name", "p_type"))
        .alias("description"),
        F.when(size % 2 == 0, "{}").otherwise('{"k": 1}').alias("details"),
        F.when(size % 3 == 0, F.array(F.lit(""), F.col("p_type")))
        .when(size % 3 == 1, F.array(F.lit("")))
        .alias("feature"),
        F.when(size % 2 == 0, "").otherwise(F.col("p_type")).alias("fit"),
        F.array(F.concat(F.lit("i"), key.cast("string"))).alias("image"),
        F.when(
            size % 3 == 0,
            F.concat(
                F.lit('<img src="/x.png" alt="'), F.col("p_type"), F.lit(" &amp; "),
                F.lower("p_brand"), F.lit('"/>'),
            ),
        )
        .when(size % 3 == 1, F.lower("p_name"))
        .alias("main_cat"),
        F.when(size % 4 < 2, price)
        .when(size % 4 == 2, F.concat(price, F.lit(" - $30.00")))
        .otherwise("")
        .alias("price"),
        F.when(size % 5 < 3, ranks).when(size % 5 == 3, "not json").alias("rank"),
        F.when(size % 5 == 0, F.concat(F.lit("<span>"), F.col("p_name")))
        .when(size % 5 == 1, "")
        .when(size % 5 == 2, F.concat(F.col("p_name"), F.lit('" />')))
        .otherwise(F.concat(F.col("p_name"), F.lit(" &amp; "), F.col("p_type")))
        .alias("title"),
    )


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one batch of envelopes."""
    return envelopes(table(spark, sf_dir, "events"))


def envelopes(events: DataFrame) -> DataFrame:
    """Events as the envelopes of the review event feed; works on a stream too."""
    number, name = F.col("event_id"), F.col("event_type")
    body = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("asin"),
            F.when(number % 5 == 0, F.concat(F.lit('["88","e'), number, F.lit('"]')))
            .when(number % 5 == 1, '["88"]')
            .when(number % 5 == 2, "not json")
            .alias("image"),
            (number % 5 + 1).cast("double").alias("overall"),
            F.when(number % 3 == 0, name)
            .when(number % 3 == 1, F.concat(name, F.lit(" "), F.col("props")))
            .alias("reviewText"),
            (number % 400).cast("string").alias("reviewerID"),
            F.concat(F.lit("Bo &amp; &quot;"), name, F.lit("&quot;")).alias("reviewerName"),
            name.alias("summary"),
            F.when(number % 2 == 0, number).alias("unix_review_time"),
            F.when(number % 2 == 1, number).alias("unixReviewTime"),
            (number % 2 == 0).alias("verified"),
            F.when(number % 7 == 0, number % 11).alias("vote"),
        )
    )
    return events.select(
        F.when(number % 50 == 0, "not json").otherwise(body).cast("binary").alias("body"),
        number.cast("string").alias("offset"),
        number.alias("sequenceNumber"),
        F.col("ts").alias("enqueuedTime"),
    )
