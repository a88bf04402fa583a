"""One query per operator or data product, over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracles as sql
from checks import standins as data
from checks.registry import query
from reviewmill.functions import dates, nested, rating, text
from reviewmill.functions.names import snake_label
from reviewmill.operators import answers, columns, counts, dedupe, filters, norms, profile, scoring
from reviewmill.operators import sets, skew
from reviewmill.plans import bronze, dashboards, enrich, gold, quality, silver
from reviewmill.schemas import GOLD_COLUMNS, RAW_REVIEWS, REVIEWS
from reviewmill.session import DROP_SHUFFLES, keep, scratch_path, settings_for
from reviewmill.sources import eventlog, fileindex, layout, ledger, positions, readers, storage, writers
from reviewmill.streaming import jobs, quarantine

DAY = dt.date(2024, 1, 15)
POSITIVE_WORDS = ("the", "and", "der", "que")
NEGATIVE_WORDS = ("of", "with", "nicht", "les")


def in_order(rows: DataFrame, name: str = "place") -> DataFrame:
    """The rows with their place in the order they come in, for small ordered results."""
    counted = rows.rdd.zipWithIndex().map(lambda pair: (*pair[0], pair[1] + 1))
    return rows.sparkSession.createDataFrame(counted, rows.schema.add(name, "long"))


def joined_text(column: str, by: str = ","):
    return F.array_join(F.col(column), by).alias(column)


# --- Gold: joins, averages, deviations -------------------------------------------------


def compared_reviews(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    """Gold reviews; the feed is a table, as three steps read it."""
    rows = keep(data.reviews(spark, sf_dir), "reviews")
    return gold.compare_reviews(rows, data.products(spark, sf_dir), unique_products=True, **how)


GOLD_REVIEWS_SQL = (
    f"""WITH {sql.JOINED}
SELECT DISTINCT j.asin, j.reviewer_id, j.overall, j.date, j.brand, j.main_cat,
  {sql.label("j.overall", "b.overall_brand")} AS brand_deviation_text,
  {sql.label("j.overall", "v.overall_reviewer")} AS reviewer_deviation_text,
  date_trunc('month', j.date)::DATE AS year_month
FROM j LEFT JOIN b ON j.brand = b.brand LEFT JOIN v ON j.reviewer_id = v.reviewer_id"""
)


@query(GOLD_REVIEWS_SQL)
def gold_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_reviews(spark, sf_dir)


@query(
    f"""WITH {sql.JOINED_REPEATED}
SELECT DISTINCT j.asin, j.reviewer_id, j.overall, j.date, j.brand, j.main_cat,
  {sql.label("j.overall", "b.overall_brand")} AS brand_deviation_text,
  {sql.label("j.overall", "v.overall_reviewer")} AS reviewer_deviation_text,
  date_trunc('month', j.date)::DATE AS year_month
FROM j LEFT JOIN b ON j.brand = b.brand LEFT JOIN v ON j.reviewer_id = v.reviewer_id"""
)
def gold_reviews_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third product has a second row of another kind: averages are over the joined rows."""
    products = data.products(spark, sf_dir)
    second = products.where("asin % 3 = 0").withColumn("main_cat", F.lower("main_cat"))
    return gold.compare_reviews(data.reviews(spark, sf_dir), products.unionByName(second))


@query(GOLD_REVIEWS_SQL)
def gold_reviews_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a limit so low that most reviewers, products and brands count as hot."""
    rows, products = data.reviews(spark, sf_dir), data.products(spark, sf_dir)
    return gold.compare_reviews(rows, products, unique_products=True, hot_rows=25)


@query(
    f"""WITH {sql.GOLD}
SELECT asin, array_to_string(image, ',') AS image, overall, review_text, reviewer_id, reviewer_name,
  summary, verified, vote, date, array_to_string(also_buy, ',') AS also_buy, brand, first_category,
  description, array_to_string(image_met, ',') AS image_met, main_cat,
  CAST(price AS DOUBLE) AS price, higher_rank, rank_cat, title, brand_deviation_text,
  reviewer_deviation_text, year_month
FROM g"""
)
def gold_reviews_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 22 gold columns, each layer written as a table and read by the next."""
    base = scratch_path(spark, "gold")
    events = data.event_feed(spark, sf_dir)
    writers.overwrite_table(
        silver.silver_reviews(data.bronze_reviews(spark, sf_dir)), f"{base}/reviews", "year_month", spread=False
    )
    writers.overwrite_table(
        silver.silver_events(bronze.bronze_events(events)), f"{base}/events", "date_utc"
    )
    writers.overwrite_table(
        silver.silver_metadata(data.bronze_metadata(spark, sf_dir), ["similar_item"]),
        f"{base}/metadata",
    )
    gold.write_gold(
        spark, f"{base}/reviews", f"{base}/events", f"{base}/metadata", f"{base}/gold"
    )
    rows = readers.read_table(spark, f"{base}/gold").select(*GOLD_COLUMNS)
    return rows.withColumns(
        {
            "image": F.array_join("image", ","),
            "also_buy": F.array_join("also_buy", ","),
            "image_met": F.array_join("image_met", ","),
            "price": F.col("price").cast("double"),
            "rank_cat": F.col("higher_rank.cat"),
            "higher_rank": F.col("higher_rank.higher_rank"),
        }
    )


@query(
    f"""WITH {sql.JOINED}
SELECT brand, overall_brand FROM b WHERE brand IS NOT NULL"""
)
def brand_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = norms.product_totals(data.reviews(spark, sf_dir))
    averages = norms.average_through_product(totals, data.products(spark, sf_dir))
    return averages.where("reviews > 0").select("brand", "overall_brand")


@query(f"WITH {sql.JOINED} SELECT reviewer_id, overall_reviewer FROM v")
def reviewer_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.reviews(spark, sf_dir)
    return norms.group_average(rows, "reviewer_id", "overall", "overall_reviewer").drop("rows")


@query(f"WITH {sql.JOINED} SELECT asin, reviewer_id, overall, date, brand, main_cat FROM j")
def reviews_with_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.reviews(spark, sf_dir)
    sizes = keep(norms.product_totals(rows).select("asin", "rows"), "product-sizes")
    return norms.attach_product(
        rows, data.products(spark, sf_dir), hot=skew.hot_keys(sizes, "asin")
    )


@query(
    f"""WITH {sql.JOINED}
SELECT j.asin, j.reviewer_id, j.overall, j.brand, overall - overall_brand AS brand_deviation,
  {sql.label("overall", "overall_brand")} AS brand_deviation_text
FROM j LEFT JOIN b ON j.brand = b.brand"""
)
def brand_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, products = data.reviews(spark, sf_dir), data.products(spark, sf_dir)
    totals = keep(norms.product_totals(rows), "product-totals")
    averages = keep(norms.average_through_product(totals, products), "brand-average")
    branded = norms.with_average(products, averages, "brand", "overall_brand")
    placed = norms.attach_product(rows, branded, hot=skew.hot_keys(totals, "asin"))
    judged = norms.with_deviation(placed, "overall_brand", "brand_deviation")
    return judged.drop("date", "main_cat", "overall_brand")


@query(
    f"""WITH {sql.JOINED}
SELECT r.asin, r.reviewer_id, r.overall, overall - overall_reviewer AS reviewer_deviation,
  {sql.label("overall", "overall_reviewer")} AS reviewer_deviation_text
FROM r LEFT JOIN v USING (reviewer_id)"""
)
def reviewer_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.reviews(spark, sf_dir)
    averages = keep(
        norms.group_average(rows, "reviewer_id", "overall", "overall_reviewer"), "reviewer-average"
    )
    placed = norms.with_average(rows, averages, "reviewer_id", "overall_reviewer")
    judged = norms.with_deviation(placed, "overall_reviewer", "reviewer_deviation")
    return judged.drop("date", "overall_reviewer")


@query(
    f"""WITH {sql.SILVER_REVIEWS}, {sql.SILVER_EVENTS}
SELECT asin, overall, reviewer_id, verified, vote, date FROM sr
UNION ALL
SELECT asin, try_cast(overall AS DOUBLE), reviewer_id, try_cast(verified AS BOOLEAN), vote,
       CAST(date_utc AS DATE) FROM se"""
)
def union_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = silver.silver_reviews(data.bronze_reviews(spark, sf_dir))
    events = bronze.bronze_events(data.event_feed(spark, sf_dir))
    feeds = sets.union_feeds(REVIEWS, batch, gold.streamed_reviews(silver.silver_events(events)))
    return feeds.select("asin", "overall", "reviewer_id", "verified", "vote", "date")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def union_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions put back together; duplicates stay."""
    lines = data.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )
    returned = F.col("l_returnflag") == "R"
    return sets.union_all(lines.where(returned), lines.where(~returned))


# --- Silver tables -----------------------------------------------------------------------


@query(
    f"""WITH {sql.SILVER_METADATA}
SELECT asin, similar_item, array_to_string(also_buy, ',') AS also_buy, brand, date, first_category,
  description, details, array_to_string(feature, ',') AS feature, fit,
  array_to_string(image, ',') AS image, main_cat, CAST(price AS DOUBLE) AS price,
  array_to_string(rank_numbers, '|') AS rank_numbers, higher_rank, rank_cat, best_rank, title
FROM sm"""
)
def silver_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.silver_metadata(data.bronze_metadata(spark, sf_dir), ["similar_item"])
    return rows.select(
        "asin", "similar_item", joined_text("also_buy"), "brand", "date", "first_category",
        "description", "details", joined_text("feature"), "fit", joined_text("image"), "main_cat",
        F.col("price").cast("double").alias("price"),
        F.array_join("rank.number", "|").alias("rank_numbers"),
        F.col("higher_rank.higher_rank").alias("higher_rank"),
        F.col("higher_rank.cat").alias("rank_cat"), "best_rank", "title",
    )


@query(
    f"""WITH {sql.SILVER_REVIEWS}
SELECT asin, array_to_string(image, ',') AS image, overall, review_text, reviewer_id, reviewer_name,
  summary, verified, vote, date, year_month, CAST(review_word_count AS BIGINT) AS review_word_count,
  keyword FROM sr"""
)
def silver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.silver_reviews(data.bronze_reviews(spark, sf_dir))
    return rows.withColumns(
        {
            "image": F.array_join("image", ","),
            "review_word_count": F.col("review_word_count").cast("bigint"),
        }
    )


@query(
    f"""WITH {sql.SILVER_METADATA}
SELECT asin, similar_item, brand, title, strftime(date, '%Y') AS year FROM sm"""
)
def silver_metadata_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job: from the bronze table to the silver table by year."""
    base = scratch_path(spark, "silver-metadata")
    rows = bronze.bronze_metadata(data.bronze_metadata(spark, sf_dir))
    writers.overwrite_table(rows, f"{base}/bronze", "year")
    silver.write_silver_metadata(spark, f"{base}/bronze", f"{base}/silver", ["similar_item"])
    rows = readers.read_table(spark, f"{base}/silver")
    return rows.select("asin", "similar_item", "brand", "title", F.col("year").cast("string").alias("year"))


@query(
    f"""WITH {sql.SILVER_REVIEWS}
SELECT asin, overall, review_text, reviewer_id, reviewer_name, summary, verified, vote, date, year_month,
  keyword FROM sr"""
)
def silver_reviews_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job: from the bronze table to the silver table by month."""
    base = scratch_path(spark, "silver-reviews")
    writers.overwrite_table(data.bronze_reviews(spark, sf_dir), f"{base}/bronze", "year_month", spread=False)
    silver.write_silver_reviews(spark, f"{base}/bronze", f"{base}/silver")
    return readers.read_table(spark, f"{base}/silver").drop("image", "review_word_count")


@query(GOLD_REVIEWS_SQL)
def published_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table under a name of the catalog."""
    path = scratch_path(spark, "published-gold")
    writers.overwrite_table(gold_reviews(spark, sf_dir), f"{path}/gold", "year_month")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    gold.publish_gold(spark, f"{path}/gold", name, path=f"{path}/named")
    return spark.table(name)


@query(
    """SELECT 'events' AS event_source, max(event_id) AS sequence_number, max(event_id) AS max_offset,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS enqueued_time FROM events"""
)
def daily_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled job twice: after the early days, then from the stored day on."""
    base = scratch_path(spark, "daily-position")
    events = bronze.bronze_events(data.event_feed(spark, sf_dir))
    early = F.col("enqueuedTime") < F.lit(DAY)
    for rows in (events.where(early), events.where(~early)):
        writers.append_table(rows, f"{base}/bronze", "date_utc")
        jobs.save_daily_position(spark, f"{base}/bronze", f"{base}/positions", "events")
    return positions.latest_positions(spark, f"{base}/positions").drop("last_modification")


@query(
    """SELECT 'events' AS event_source, max(event_id) AS sequence_number, max(event_id) AS max_offset,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS enqueued_time FROM events"""
)
def observed_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same position from what the bronze writes of two runs have seen, without reading bronze."""
    base = scratch_path(spark, "observed-position")
    events = data.table(spark, sf_dir, "events")
    late = F.col("ts") >= F.lit(DAY)
    for rows in (events.where(~late), events.where(late)):
        rows.write.mode("append").parquet(f"{base}/events")
        envelopes = data.envelopes(readers.stream_table(spark, f"{base}/events", events.schema))
        jobs.run_bronze_with_position(
            spark, envelopes, f"{base}/bronze", f"{base}/checks", f"{base}/positions", "events"
        )
    return positions.latest_positions(spark, f"{base}/positions").drop("last_modification")


def flat_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("sequenceNumber").alias("sequence_number"),
        F.col("offset").alias("offset_number"),
        F.col("date_utc").cast("string").alias("date_utc"),
        "asin", joined_text("image"), "overall", "review_text", "reviewer_id", "reviewer_name",
        "summary", "unix_review_time", "verified", "vote",
        F.col("review_word_count").cast("bigint").alias("review_word_count"), "keyword",
    )


@query(f"WITH {sql.SILVER_EVENTS} {sql.SILVER_EVENTS_SELECT}")
def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.event_feed(spark, sf_dir)
    return flat_events(silver.silver_events(bronze.bronze_events(events)))


@query(f"WITH {sql.SILVER_EVENTS} {sql.SILVER_EVENTS_SELECT}")
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both streams end to end: events to bronze, bronze to silver, silver read back."""
    base = scratch_path(spark, "stream-clean")
    schema = data.table(spark, sf_dir, "events").schema
    # The pattern matches one file as well as a folder of files.
    events = data.envelopes(readers.stream_table(spark, f"{sf_dir}/events.parque[t]", schema))
    jobs.run_to_end(
        lambda: jobs.stream_bronze_events(events, f"{base}/bronze", f"{base}/checkpoints/bronze")
    )
    stored = bronze.bronze_events(data.event_feed(spark, sf_dir)).schema
    jobs.run_to_end(
        lambda: jobs.stream_silver_events(
            spark, f"{base}/bronze", stored, f"{base}/silver", f"{base}/checkpoints/silver"
        )
    )
    return flat_events(spark.read.parquet(f"{base}/silver"))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_utc, octet_length(encode(props)) AS body_bytes
FROM events"""
)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream stopped and started again with new files in between: each event once."""
    base = scratch_path(spark, "stream-restart")
    events = data.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(DAY)
    for rows in (events.where(early), events.where(~early)):
        rows.write.mode("append").parquet(f"{base}/raw")
        stream = readers.stream_table(spark, f"{base}/raw", events.schema, 1)
        envelopes = stream.select(
            F.col("props").cast("binary").alias("body"),
            F.col("event_id").cast("string").alias("offset"),
            F.col("ts").alias("enqueuedTime"),
        )
        jobs.run_to_end(
            lambda rows=envelopes: jobs.stream_bronze_events(rows, f"{base}/bronze", f"{base}/checkpoint")
        )
    return spark.read.parquet(f"{base}/bronze").select(
        F.col("offset").alias("event_id"),
        F.col("date_utc").cast("string").alias("date_utc"),
        F.octet_length("body").cast("bigint").alias("body_bytes"),
    )


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS enqueued FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')"""
)
def resume_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run stores its position; the second reads from there, that time included."""
    path = scratch_path(spark, "positions")
    events = data.event_feed(spark, sf_dir)
    first = bronze.bronze_events(events.where(F.col("enqueuedTime") < F.lit(DAY)))
    positions.save_position(first, path, "events")
    start = readers.start_position(positions.stored_position(spark, path, "events"))
    return readers.from_position(events, start).select(
        F.col("sequenceNumber").alias("event_id"),
        F.date_format("enqueuedTime", dates.INSTANT).alias("enqueued"),
    )


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS enqueued FROM events
WHERE ts >= TIMESTAMP '2024-01-15 06:00:00'"""
)
def resume_from_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A start given by hand without a fraction, over the table as a stream into bronze."""
    base = scratch_path(spark, "resume-seconds")
    schema = data.table(spark, sf_dir, "events").schema
    events = data.envelopes(readers.stream_table(spark, f"{sf_dir}/events.parque[t]", schema))
    start = readers.start_position(None, "2024-01-15T06:00:00Z")
    jobs.run_to_end(
        lambda: jobs.stream_bronze_events(events, f"{base}/bronze", f"{base}/checks", position=start)
    )
    return spark.read.parquet(f"{base}/bronze").select(
        F.col("sequenceNumber").alias("event_id"),
        F.date_format("enqueuedTime", dates.INSTANT).alias("enqueued"),
    )


EVENT_LOG_SQL = """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_utc,
  octet_length(encode(props))::BIGINT AS body_bytes FROM events"""


def logged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.table(spark, sf_dir, "events")
    return events.select(F.col("props").alias("body"), F.col("event_id").alias("sequenceNumber"), F.col("ts").alias("enqueuedTime"))


def from_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        F.col("sequenceNumber").alias("event_id"),
        F.col("date_utc").cast("string").alias("date_utc"),
        F.octet_length("body").cast("bigint").alias("body_bytes"),
    )


@query(EVENT_LOG_SQL)
def event_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without a broker, streamed into bronze; the second run reads what was appended after the first."""
    base = scratch_path(spark, "event-source")
    events = logged_events(spark, sf_dir)
    late = F.col("enqueuedTime") >= F.lit(DAY)
    for part in (events.where(~late), events.where(late)):
        eventlog.append_events(part, f"{base}/log", partitions=3, segment_rows=20_000)
        jobs.run_to_end(
            lambda: jobs.stream_bronze_events(eventlog.read_log(spark, f"{base}/log"), f"{base}/bronze", f"{base}/checks")
        )
    return from_log(spark, f"{base}/bronze")


@query(f"{EVENT_LOG_SQL} WHERE ts >= TIMESTAMP '2024-01-15 06:00:00'")
def event_source_from_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log from a start time on: segments that end before it are passed over, the rest is filtered."""
    base = scratch_path(spark, "event-time")
    eventlog.append_events(logged_events(spark, sf_dir), f"{base}/log", segment_rows=5_000)
    start = "2024-01-15T06:00:00Z"
    events = eventlog.read_log(spark, f"{base}/log", startingPosition=start)
    jobs.run_to_end(lambda: jobs.stream_bronze_events(events, f"{base}/bronze", f"{base}/checks", position=start))
    return from_log(spark, f"{base}/bronze")


@query(f"{EVENT_LOG_SQL} WHERE ts >= TIMESTAMP '2024-01-15 06:00:00'")
def position_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read from a position by its index of times; files written after the index was made are read too."""
    path = scratch_path(spark, "position-pruned")
    events = logged_events(spark, sf_dir).withColumn("date_utc", dates.day_text(F.col("enqueuedTime")))
    late = F.col("enqueuedTime") >= F.lit(DAY + dt.timedelta(days=3))
    writers.append_table(events.where(~late), path, "date_utc")
    fileindex.index_files(spark, path, events.schema)
    writers.append_table(events.where(late), path, "date_utc")
    found = fileindex.read_from(spark, path, events.schema, "2024-01-15T06:00:00Z")
    return found.select(
        F.col("sequenceNumber").alias("event_id"), "date_utc", F.octet_length("body").cast("bigint").alias("body_bytes")
    )


@query("SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'not json' END AS reason FROM events")
def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream in two tables: clean events, and bodies that do not parse, with their positions."""
    base = scratch_path(spark, "quarantined")
    schema = data.table(spark, sf_dir, "events").schema
    envelopes = data.envelopes(readers.stream_table(spark, f"{sf_dir}/events.parque[t]", schema))
    jobs.run_to_end(
        lambda: quarantine.stream_split_events(
            bronze.bronze_events(envelopes), f"{base}/clean", f"{base}/bad", f"{base}/checks"
        )
    )
    event = F.col("sequenceNumber").alias("event_id")
    clean = spark.read.parquet(f"{base}/clean").select(event, F.lit(None).cast("string").alias("reason"))
    return clean.unionByName(spark.read.parquet(f"{base}/bad").select(event, "reason"))


@query(
    """SELECT event_type AS event_source, max(event_id) AS sequence_number,
  max(event_id) AS max_offset, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS enqueued_time
FROM events GROUP BY event_type"""
)
def position_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-water mark per source."""
    marks = counts.high_water_mark(
        data.table(spark, sf_dir, "events"),
        sequence="event_id", offset="event_id", moment="ts", by="event_type",
    )
    return marks.withColumnsRenamed({"event_type": "event_source"}).withColumn(
        "enqueued_time", F.date_format("enqueued_time", dates.INSTANT)
    )


@query(
    """SELECT max(event_id) AS sequence_number, max(event_id) AS max_offset,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS enqueued_time FROM events"""
)
def position_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = bronze.bronze_events(data.event_feed(spark, sf_dir))
    return counts.high_water_mark(events).withColumn(
        "enqueued_time", F.date_format("enqueued_time", dates.INSTANT)
    )


# --- Deduplication -----------------------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE AS o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY orders.o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate")
    )
    return dedupe.latest_per_key(orders, "o_custkey", "o_orderdate", ["o_orderkey"])


@query("SELECT DISTINCT lang, text FROM documents")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.distinct_rows(data.table(spark, sf_dir, "documents"), ["lang", "text"])


# --- Counts and profiles -----------------------------------------------------------------


@query(
    """SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS place
FROM part GROUP BY p_brand"""
)
def value_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_order(counts.value_frequency(data.table(spark, sf_dir, "part"), "p_brand"))


@query(
    """SELECT l_partkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_partkey) AS place
FROM lineitem GROUP BY l_partkey ORDER BY place LIMIT 10"""
)
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_order(counts.value_frequency(data.table(spark, sf_dir, "lineitem"), "l_partkey", top=10))


@query(
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_returnflag, l_linestatus, l_linenumber"""
)
def count_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = data.table(spark, sf_dir, "lineitem")
    return counts.count_by(lines, "l_returnflag", "l_linestatus", "l_linenumber")


@query(
    """SELECT 'lineitem' AS name, count(*) AS n FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'part', count(*) FROM part"""
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.union_all(
        *(
            counts.row_count(data.table(spark, sf_dir, name)).select(F.lit(name).alias("name"), "n")
            for name in ("lineitem", "events", "documents", "part")
        )
    )


@query(
    """WITH h AS (SELECT ts::DATE AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events
GROUP BY 1, 2) SELECT *, row_number() OVER (ORDER BY date, hour) AS place FROM h"""
)
def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_order(counts.count_by_hour(data.table(spark, sf_dir, "events"), "ts"))


@query(
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS moment, count(*) AS n FROM events
GROUP BY ts ORDER BY ts DESC"""
)
def events_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_time = counts.count_by_time(data.table(spark, sf_dir, "events"), "ts")
    return by_time.select(F.date_format("ts", dates.INSTANT).alias("moment"), "n")


@query(
    """SELECT event_id, ts::DATE AS date, CAST(hour(ts) AS INTEGER) AS hour,
  CAST(minute(ts) AS INTEGER) AS minute FROM events"""
)
def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.table(spark, sf_dir, "events").select("event_id", "ts")
    return counts.time_parts(events, "ts").drop("ts")


@query("SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY 1")
def counts_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_by_month(data.table(spark, sf_dir, "orders"), "o_orderdate")


@query("SELECT date_trunc('year', o_orderdate)::DATE AS year, count(*) AS n FROM orders GROUP BY 1")
def counts_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_by_year(data.table(spark, sf_dir, "orders"), "o_orderdate")


def _missing_sql() -> str:
    lists = ["also_buy", "category", "description", "feature", "image"]
    texts = ["asin", "brand", "date", "details", "fit", "main_cat", "price", "rank", "similar_item",
             "title"]

    def row(column: str, kind: str, missing: str) -> str:
        source = "raw_date" if column == "date" else column
        return (
            f"SELECT '{column}' AS column_name, '{kind}' AS data_type, "
            f"avg(CASE WHEN {missing.format(c=source)} THEN 1.0::DOUBLE ELSE 0.0 END) AS missing_share, "
            f"avg(CASE WHEN {source} IS NULL THEN 1.0::DOUBLE ELSE 0.0 END) AS null_share FROM bm"
        )

    empty, missing = "len({c}) = 0", "{c} IS NULL OR {c} IN ('{{}}', '')"
    rows = [row(c, "array<string>", empty) for c in lists]
    return " UNION ALL ".join(rows + [row(c, "string", missing) for c in texts])


@query(
    f"""WITH {sql.BRONZE_METADATA}, s AS ({_missing_sql()})
SELECT *, row_number() OVER (ORDER BY missing_share DESC, column_name) AS place FROM s"""
)
def missing_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_order(profile.missing_share(data.bronze_metadata(spark, sf_dir)))


def _partition_sql() -> str:
    keys = {
        "customer": "o_custkey",
        "month": "date_trunc('month', o_orderdate)",
        "year": "date_trunc('year', o_orderdate)",
        "priority": "o_orderpriority",
    }
    parts = [
        f"SELECT '{name}' AS column_name, count(*) AS groups, max(n) AS largest_group, "
        f"avg(n) AS mean_group, max(n) / avg(n) AS skew "
        f"FROM (SELECT {key}, count(*) AS n FROM orders GROUP BY 1)"
        for name, key in keys.items()
    ]
    return " UNION ALL ".join(parts)


@query(_partition_sql())
def partition_key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    return profile.partition_key_profile(
        data.table(spark, sf_dir, "orders"),
        {
            "customer": F.col("o_custkey"),
            "month": dates.month_start(day),
            "year": dates.year_start(day),
            "priority": F.col("o_orderpriority"),
        },
    )


SKETCHED = ("l_returnflag", "l_linestatus", "l_linenumber", "l_discount")


@query(
    " UNION ALL ".join(
        f"""SELECT '{key}' AS column_name, count(*) AS groups, max(n)::BIGINT AS largest_group, avg(n) AS mean_group,
  max(n) / avg(n) AS skew FROM (SELECT {key}, count(*) AS n FROM lineitem GROUP BY 1)"""
        for key in SKETCHED
    )
)
def partition_key_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate keys from sketches, exact for keys of few values; errors for many are tested apart."""
    lines = data.table(spark, sf_dir, "lineitem")
    found = profile.partition_key_sketch(lines, {key: F.col(key) for key in SKETCHED})
    return found.drop("groups_error", "largest_error")


def _report_sql() -> str:
    one = "CAST(count(*) AS DOUBLE)"
    parts = [f"SELECT 'rows' AS section, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS value, {one} AS amount FROM br"]
    texts = ("asin", "image", "review_text", "reviewer_id", "reviewer_name", "summary", "vote", "year_month")
    for name in texts:
        source = {"image": "raw_image", "reviewer_name": "raw_name"}.get(name, name)
        parts.append(
            f"SELECT 'missing', '{name}', 'string', avg(CASE WHEN {source} IS NULL OR {source} IN ('{{}}', '') "
            "THEN 1.0::DOUBLE ELSE 0.0 END) FROM br"
        )
    parts.append(f"SELECT 'value', 'summary', summary, {one} FROM br GROUP BY summary")
    for name in ("month", "year"):
        parts.append(
            f"SELECT '{name}', 'unix_review_time_date', CAST(date_trunc('{name}', date)::DATE AS VARCHAR), {one} "
            "FROM br GROUP BY 3"
        )
    for name, amount in (("groups", "count(*)"), ("largest_group", "max(n)"), ("skew", "max(n) * count(*) / sum(n)")):
        parts.append(
            f"SELECT 'key', 'reviewer_id', '{name}', CAST({amount} AS DOUBLE) "
            "FROM (SELECT reviewer_id, count(*) AS n FROM br GROUP BY 1)"
        )
    return f"WITH {sql.SILVER_REVIEWS} " + " UNION ALL ".join(parts)


@query(_report_sql())
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months, years and a candidate key besides missing shares and values, in one scan."""
    return quality.quality_profile(
        data.bronze_reviews(spark, sf_dir), ["summary"], day="unix_review_time_date", keys=["reviewer_id"]
    )


@query(
    """SELECT 'rows' AS section, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS VARCHAR) AS value,
  CAST(count(*) AS DOUBLE) AS amount FROM documents
UNION ALL SELECT 'missing', 'text', 'string',
  avg(CASE WHEN text IS NULL OR text IN ('{}', '') THEN 1.0::DOUBLE ELSE 0.0 END) FROM documents
UNION ALL SELECT 'missing', 'lang', 'string',
  avg(CASE WHEN lang IS NULL OR lang IN ('{}', '') THEN 1.0::DOUBLE ELSE 0.0 END) FROM documents
UNION ALL SELECT 'missing', 'source', 'string',
  avg(CASE WHEN source IS NULL OR source IN ('{}', '') THEN 1.0::DOUBLE ELSE 0.0 END) FROM documents
UNION ALL SELECT 'value', 'lang', lang, CAST(count(*) AS DOUBLE) FROM documents GROUP BY lang
UNION ALL SELECT 'value', 'source', source, CAST(count(*) AS DOUBLE) FROM documents GROUP BY source"""
)
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_profile(data.table(spark, sf_dir, "documents"), ["lang", "source"])


@query(
    """WITH k AS (SELECT CASE WHEN p_size % 2 = 0 THEN p_type END AS keyword,
  CAST(p_size % 6 AS DOUBLE) AS overall FROM part)
SELECT keyword, overall, CASE WHEN keyword IS NOT NULL AND overall IN (4, 5) THEN 'positive'
  WHEN keyword IS NOT NULL AND overall IN (0, 1, 2) THEN 'negative' END AS sentiment, count(*) AS n
FROM k GROUP BY ALL"""
)
def keyword_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    said = data.table(spark, sf_dir, "part").select(
        F.when(size % 2 == 0, F.col("p_type")).otherwise(F.col("p_name")).alias("review_text"),
        (size % 6).cast("double").alias("overall"),
    )
    return quality.keyword_report(said)


@query(
    """SELECT CASE WHEN l_quantity IN (4, 5) THEN 'positive' WHEN l_quantity IN (0, 1, 2) THEN 'negative'
  END AS sentiment, count(*) AS n FROM lineitem GROUP BY 1"""
)
def rating_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = rating.keyword_sentiment(F.col("l_returnflag"), F.col("l_quantity"))
    lines = data.table(spark, sf_dir, "lineitem").select(label.alias("sentiment"))
    return counts.count_by(lines, "sentiment")


# --- Names, text, dates, nested values ------------------------------------------------------

_SNAKE = """trim(translate(replace(regexp_replace(regexp_replace(lower(regexp_replace(value,
  '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), '\\s+', '_', 'g'),
  '[^a-zA-Z0-9áéíóúÁÉÍÓÚâêîôÂÊÎÔãõÃÕçÇ_]+', '_', 'g'), '__', '_'), 'áéíóúâêîôãõç', 'aeiouaeioaoc'), '_')"""


@query(
    f"""SELECT value, {_SNAKE} AS label FROM (
  SELECT p_name AS value FROM part UNION ALL SELECT p_brand FROM part
  UNION ALL SELECT c_name FROM customer
  UNION ALL SELECT url FROM pages UNION ALL SELECT text FROM conversations)"""
)
def snake_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = (
        ("part", "p_name"), ("part", "p_brand"), ("customer", "c_name"), ("pages", "url"),
        ("conversations", "text"),
    )
    values = sets.union_all(
        *(data.table(spark, sf_dir, t).select(F.col(c).alias("value")) for t, c in sources)
    )
    return values.select("value", snake_label(F.col("value")).alias("label"))


@query(
    """SELECT p_partkey AS part_key, p_name AS full_name, p_brand AS descricao,
  p_retailprice AS retail_price FROM part"""
)
def snake_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = data.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("PartKey"),
        F.col("p_name").alias(" Full  Name!"),
        F.col("p_brand").alias("Descrição"),
        F.col("p_retailprice").alias("retail-Price"),
    )
    return columns.get_formatted_column_names(part)


@query("SELECT page_id, true AS from_pages FROM pages")
def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row carries the file it came from."""
    pages = columns.add_file_source_column(data.table(spark, sf_dir, "pages").select("page_id"))
    return pages.select("page_id", F.contains("file_source", F.lit("pages")).alias("from_pages"))


@query(f"""SELECT page_id, {sql.decoded("html")} AS html FROM pages""")
def entity_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = data.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.decode_entities(F.col("html")).alias("html"))


_TITLE = "regexp_extract(html, '<title>([^<]*)', 1)"


@query(
    f"""WITH t AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN {_TITLE} WHEN 1 THEN html WHEN 2 THEN ''
  ELSE {_TITLE} || '" />' END AS title FROM pages)
SELECT page_id, replace(replace(CASE WHEN title = '' OR starts_with(title, '<') THEN NULL
  ELSE title END, '" />', ''), '&amp;', '&') AS title FROM t"""
)
def clean_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract("html", "<title>([^<]*)", 1)
    kind = F.col("page_id") % 4
    titles = data.table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(kind == 0, found)
        .when(kind == 1, F.col("html"))
        .when(kind == 2, "")
        .otherwise(F.concat(found, F.lit('" />')))
        .alias("title"),
    )
    return titles.select("page_id", text.clean_title(F.col("title")).alias("title"))


@query(
    f"""WITH t AS (SELECT page_id, CASE page_id % 2 WHEN 0
  THEN '<img src="/c.png" alt="' || {_TITLE} || '"/>' ELSE {_TITLE} END AS raw FROM pages),
x AS (SELECT page_id, replace(CASE WHEN contains(raw, 'img src=')
  THEN regexp_extract(raw, 'alt=["'']([^"'']*)', 1) ELSE raw END, '&amp;', '&') AS c FROM t)
SELECT page_id, {sql.capitalised("c")} AS category FROM x"""
)
def attr_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract("html", "<title>([^<]*)", 1)
    image = F.concat(F.lit('<img src="/c.png" alt="'), found, F.lit('"/>'))
    raw = F.when(F.col("page_id") % 2 == 0, image).otherwise(found)
    return data.table(spark, sf_dir, "pages").select(
        "page_id", text.clean_category(raw).alias("category")
    )


@query(
    """WITH t AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '$' || p_retailprice
  WHEN 1 THEN '$' || p_retailprice || ' - $30.00' WHEN 2 THEN '' ELSE 'USD ' || p_size END AS raw
  FROM part)
SELECT p_partkey, CAST(try_cast(regexp_replace(raw, '[^0-9.]', '', 'g') AS FLOAT) AS DOUBLE) AS price
FROM t"""
)
def price_to_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    price = F.concat(F.lit("$"), F.col("p_retailprice").cast("string"))
    raw = (
        F.when(size % 4 == 0, price)
        .when(size % 4 == 1, F.concat(price, F.lit(" - $30.00")))
        .when(size % 4 == 2, "")
        .otherwise(F.concat(F.lit("USD "), size.cast("string")))
    )
    return data.table(spark, sf_dir, "part").select(
        "p_partkey", text.price_to_float(raw).cast("double").alias("price")
    )


@query(
    f"""SELECT doc_id, CAST({sql.word_count("text")} AS BIGINT) AS words,
  CASE WHEN {sql.word_count("text")} = 1 THEN text END AS keyword FROM documents"""
)
def word_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = data.table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = documents.withColumn("words", text.word_count(F.col("text")))
    return counted.select(
        "doc_id",
        F.col("words").cast("bigint").alias("words"),
        text.one_word(F.col("text"), F.col("words")).alias("keyword"),
    )


@query("SELECT event_id, ts::DATE AS seen_date FROM events")
def unix_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.table(spark, sf_dir, "events").select(
        "event_id", data.unix_seconds("ts").alias("seen")
    )
    return dates.unix_to_date(events, "seen").drop("seen")


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS day_year_month,
  strftime(o_orderdate, '%Y') AS day_year FROM orders"""
)
def year_month_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = data.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("day")
    )
    return dates.extract_year(dates.extract_year_month(orders, "day"), "day").drop("day")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS parsed_date
FROM orders"""
)
def long_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form text with one- and two-digit days, and text that is no date."""
    kind = F.col("o_orderkey") % 3
    raw = (
        F.when(kind == 0, F.date_format("o_orderdate", "MMMM d, yyyy"))
        .when(kind == 1, F.date_format("o_orderdate", "MMMM dd, yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy MMMM"))
    )
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("date"))
    return dates.extract_date_from_string(orders, "date").drop("date")


@query(
    """SELECT event_id, CASE WHEN event_id % 4 > 0 THEN epoch_us(ts) END AS micros FROM events"""
)
def instant_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("event_id") % 4 > 0, F.date_format("ts", dates.INSTANT)).otherwise("soon")
    events = data.table(spark, sf_dir, "events")
    return events.select("event_id", F.unix_micros(dates.instant(written)).alias("micros"))


@query(
    """SELECT event_id, props AS body, event_id AS offset_number, strftime(ts, '%Y-%m-%d') AS date_utc
FROM events"""
)
def binary_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes to text, text offset to a number, UTC day, and the day back to a date."""
    events = data.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("props").cast("binary").alias("body"),
        F.col("event_id").cast("string").alias("offset"),
        F.col("ts").alias("enqueuedTime"),
    )
    return bronze.bronze_events(events).select(
        "event_id", "body", F.col("offset").alias("offset_number"), "date_utc"
    )


@query(
    """SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k_text
FROM events"""
)
def lift_json_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = data.table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    parsed = events.withColumn("body", nested.json_struct(F.col("props"), "k string"))
    return columns.lift_struct(parsed, "body", ["props"]).withColumnsRenamed({"k": "k_text"})


@query(
    f"""WITH {sql.SILVER_EVENTS}
SELECT event_id, array_to_string({sql.image_links("raw_image")}, '|') AS image,
  CAST(len({sql.image_links("raw_image")}) AS BIGINT) AS images FROM be"""
)
def json_list_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    raw = (
        F.when(number % 5 == 0, F.concat(F.lit('["88","e'), number, F.lit('"]')))
        .when(number % 5 == 1, '["88"]')
        .when(number % 5 == 2, "not json")
    )
    links = data.table(spark, sf_dir, "events").select(
        "event_id", nested.image_links(raw).alias("links")
    )
    # An array's size is null here only because the null is kept, in either ANSI mode.
    size = F.when(F.col("links").isNotNull(), F.size("links"))
    return links.select(
        "event_id", F.array_join("links", "|").alias("image"), size.cast("bigint").alias("images")
    )


@query(
    f"""WITH {sql.BRONZE_METADATA}
SELECT similar_item, array_to_string({sql._NUMBERS}, '|') AS numbers,
  array_to_string({sql._CATEGORIES}, '|') AS categories, list_min({sql._NUMBERS}) AS higher_rank,
  coalesce(array_to_string({sql._CATEGORIES}, ', '), '') AS cat,
  list_min(list_transform({sql._NUMBERS}, lambda x: try_cast(replace(x, ',', '') AS BIGINT))) AS best_rank
FROM bm"""
)
def rank_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = data.bronze_metadata(spark, sf_dir).select(
        "similar_item", nested.rank_entries(F.col("rank")).alias("rank")
    )
    return ranked.select(
        "similar_item",
        F.array_join("rank.number", "|").alias("numbers"),
        F.array_join("rank.cat", "|").alias("categories"),
        nested.rank_summary(F.col("rank")).alias("summary"),
        nested.best_rank(F.col("rank")).alias("best_rank"),
    ).select("similar_item", "numbers", "categories", "summary.*", "best_rank")


@query(
    f"""WITH {sql.BRONZE_METADATA}
SELECT similar_item, coalesce(category[1], 'Unknown') AS first_category, description[1] AS description
FROM bm"""
)
def first_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.bronze_metadata(spark, sf_dir).select(
        "similar_item",
        nested.first_or_unknown(F.col("category")).alias("first_category"),
        nested.first_item(F.col("description")).alias("description"),
    )


# --- Filters -----------------------------------------------------------------------------


@query(
    """SELECT event_id, user_id, props FROM events
WHERE ts::DATE = DATE '2024-01-15' AND props IS NOT NULL"""
)
def day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One processing day: month first, then day, then texts that are there."""
    day = F.to_date("ts")
    events = data.table(spark, sf_dir, "events").withColumns(
        {"date": day, "year_month": dates.month_start(day)}
    )
    chosen = filters.on_day(events, DAY).where(F.col("props").isNotNull())
    return chosen.select("event_id", "user_id", "props")


@query(
    """SELECT strftime(o_orderdate, '%Y') AS year, count(*) AS n FROM orders
WHERE year(o_orderdate) >= 1997 GROUP BY 1"""
)
def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year kept as text, compared as a number."""
    orders = data.table(spark, sf_dir, "orders").select(
        dates.year_text(F.col("o_orderdate")).alias("year")
    )
    return counts.count_by(filters.from_year(orders, 1997), "year")


@query("SELECT l_partkey, l_quantity, count(*) AS n FROM lineitem WHERE l_partkey = 7 GROUP BY 1, 2")
def key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of one product."""
    lines = data.table(spark, sf_dir, "lineitem").where(F.col("l_partkey") == 7)
    return counts.count_by(lines, "l_partkey", "l_quantity")


# --- Sinks and layout -----------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def compact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many small files, compacted: the same rows."""
    base = scratch_path(spark, "compact")
    orders = data.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    orders.repartition(16).write.parquet(f"{base}/small")
    return layout.compact(spark, f"{base}/small", f"{base}/compacted", files=2)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def clustered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "cluster")
    orders = data.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    writers.append_table(orders, f"{base}/plain")
    return layout.cluster(spark, f"{base}/plain", f"{base}/clustered", "o_custkey", files=4)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate::DATE AS o_orderdate, o_orderpriority FROM orders")
def curve_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders along a curve over a number, a date and a text."""
    base = scratch_path(spark, "curve")
    orders = data.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"
    )
    writers.append_table(orders, f"{base}/plain")
    keys = ["o_custkey", "o_orderdate", "o_orderpriority"]
    return layout.cluster_by_curve(spark, f"{base}/plain", f"{base}/clustered", keys, files=16)


@query("SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS date FROM events")
def replaced_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day replaced by a wrong version and then by the right one: the table is whole again."""
    path = scratch_path(spark, "replace")
    events = data.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("date")
    )
    writers.overwrite_table(events, path, "date")
    day = filters.on_day(events, DAY, month_column=None)
    writers.replace_day(day.withColumn("event_type", F.lit("wrong")), path, DAY)
    writers.replace_day(day, path, DAY)
    table = readers.read_table(spark, path)
    return table.withColumn("date", F.col("date").cast("string"))


@query("SELECT p_partkey, p_brand, p_size FROM part")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A named table, created and then appended to."""
    path = scratch_path(spark, "published")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    part = data.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    small = F.col("p_size") <= 25
    writers.publish_table(part.where(small), name, path=path)
    writers.publish_table(part.where(~small), name, mode="append")
    return spark.table(name)


@query(
    """SELECT p_partkey, p_brand, CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice
FROM part"""
)
def grown_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later append brings a column that the first one lacks."""
    path = scratch_path(spark, "grown")
    part = data.table(spark, sf_dir, "part")
    writers.append_table(part.where("p_size <= 25").select("p_partkey", "p_brand"), path)
    writers.append_table(
        part.where("p_size > 25").select("p_partkey", "p_brand", "p_retailprice"), path
    )
    return readers.read_table(spark, path, merge_schema=True)


@query("SELECT p_partkey, p_brand, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size_text FROM part")
def compact_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition values with leading zeros stay the text they are."""
    base = scratch_path(spark, "compact-partitioned")
    part = data.table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size_text")
    )
    for odd in (0, 1):
        writers.append_table(part.where(F.col("p_partkey") % 2 == odd), f"{base}/small", "size_text")
    return layout.compact(spark, f"{base}/small", f"{base}/compacted", by="size_text")


@query(
    """SELECT event_id, value, ts::DATE AS date FROM events
WHERE ts::DATE = DATE '2024-01-14' OR ts::DATE = DATE '2024-01-15' AND event_id % 2 = 0"""
)
def published_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days published one after the other, the second again with fewer rows; the day is the feature."""
    path = scratch_path(spark, "published-day")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    events = data.table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("date"))
    writers.publish_day(events, name, DAY - dt.timedelta(days=1), path=path)
    writers.publish_day(events, name, DAY)
    writers.publish_day(events.where("event_id % 2 = 0"), name, DAY)
    return spark.table(name)


@query(
    """WITH f AS (SELECT p_brand, (row_number() OVER (ORDER BY p_partkey) - 1) // 64 AS file FROM part)
SELECT CAST(count(DISTINCT file) AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS n,
  CAST(least(64, count(*)) AS BIGINT) AS largest FROM f"""
)
def rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record limit per file cuts one task's rows into whole files."""
    path = scratch_path(spark, "rows-per-file")
    part = data.table(spark, sf_dir, "part").coalesce(1)
    writers.append_table(part, path, max_records=64)
    by_file = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n"))
    return by_file.agg(F.count("*").alias("files"), F.sum("n").alias("n"), F.max("n").alias("largest"))


@query("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON folders read in one scan, their common schema inferred."""
    base = scratch_path(spark, "json")
    part = data.table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_retailprice", (F.col("p_size") % 3).alias("folder")
    )
    part.write.partitionBy("folder").json(base)
    return readers.read_json(spark, readers.list_folders(spark, base))


@query(
    f"""WITH {sql.BRONZE_METADATA}
SELECT asin, similar_item, array_to_string(also_buy, ',') AS also_buy, CAST(NULL AS VARCHAR) AS also_view,
  brand, array_to_string(category, ',') AS category, raw_date AS date,
  array_to_string(description, ',') AS description, details, array_to_string(feature, ',') AS feature, fit,
  array_to_string(image, ',') AS image, main_cat, price, rank, CAST(NULL AS VARCHAR) AS tech1,
  CAST(NULL AS VARCHAR) AS tech2, title, try_strptime(raw_date, '%B %d, %Y')::DATE AS parsed_date,
  true AS has_file, strftime(try_strptime(raw_date, '%B %d, %Y'), '%Y') AS year FROM bm"""
)
def bronze_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as JSON folders, loaded in batches of folders into the bronze table."""
    base = scratch_path(spark, "bronze-metadata")
    raw = data.bronze_metadata(spark, sf_dir)
    raw.withColumn("part", F.expr("pmod(xxhash64(similar_item), 5)")).write.partitionBy(
        "part"
    ).json(f"{base}/raw")
    folders = readers.list_folders(spark, f"{base}/raw")
    bronze.load_bronze_metadata(spark, folders, f"{base}/bronze", per_write=2)
    table = readers.read_table(spark, f"{base}/bronze")
    lists = ("also_buy", "also_view", "category", "description", "feature", "image")
    return table.withColumns(
        {
            **{name: F.array_join(name, ",") for name in lists},
            "year": F.col("year").cast("string"),
            "has_file": F.col("file_source").contains(f"{base}/raw"),
        }
    ).drop("file_source")


BRONZE_REVIEWS_SQL = f"""WITH {sql.SILVER_REVIEWS}
SELECT asin, raw_image AS image, overall, review_text, reviewer_id, raw_name AS reviewer_name, summary,
  verified, vote, epoch(date::TIMESTAMP)::BIGINT AS unix_review_time, date AS unix_review_time_date,
  true AS has_file, year_month"""


def raw_reviews(spark: SparkSession, sf_dir: str, *extra) -> DataFrame:
    """Reviews with the names of the raw feed."""
    return data.bronze_reviews(spark, sf_dir).select(
        "asin", "image", "overall", "summary", "verified", "vote",
        F.col("review_text").alias("reviewText"),
        F.col("reviewer_id").alias("reviewerID"),
        F.col("reviewer_name").alias("reviewerName"),
        (F.unix_date("unix_review_time_date").cast("bigint") * 86400).alias("unixReviewTime"),
        *extra,
    )


def write_raw(raw: DataFrame, folder: str, **narrow: str) -> None:
    """Three folders of compressed JSON. Each task holds a file of each folder open, so that no wide row is sorted by its folder.
    The first has the ``narrow`` columns in those types, and is written by itself then."""
    rows = raw.withColumn("part", F.expr("pmod(xxhash64(asin), 3)"))
    first = {name: F.col(name).cast(kind) for name, kind in narrow.items()}
    passes = [rows.where("part = 0").withColumns(first), rows.where("part > 0")] if first else [rows]
    with settings_for(raw.sparkSession, {**DROP_SHUFFLES, **writers.OPEN_FILES}):
        for some in passes:
            some.write.mode("append").partitionBy("part").option("compression", "gzip").json(folder)
    for number in range(3):  # also one without rows
        store = storage.Store(raw.sparkSession, f"{folder}/part={number}")
        store.files.mkdirs(store.root)


def loaded_reviews(spark: SparkSession, sf_dir: str, label: str, schema=None, extra=()) -> DataFrame:
    """Reviews as JSON folders with their raw names, loaded into the bronze table."""
    base = scratch_path(spark, label)
    write_raw(raw_reviews(spark, sf_dir, *extra), f"{base}/raw")
    folders = readers.list_folders(spark, f"{base}/raw")
    bronze.load_bronze_reviews(spark, folders, f"{base}/bronze", schema=schema)
    rows = readers.read_table(spark, f"{base}/bronze")
    return rows.withColumn("has_file", F.col("file_source").contains(f"{base}/raw")).drop("file_source")


@query(f"{BRONZE_REVIEWS_SQL}, CAST(NULL AS VARCHAR) AS style FROM br")
def bronze_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a declared schema: its fields and no others, an absent one null."""
    return loaded_reviews(spark, sf_dir, "bronze-reviews", RAW_REVIEWS)


@query(f"{BRONZE_REVIEWS_SQL}, overall * 2 AS stars_of_ten FROM br")
def bronze_reviews_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a schema every raw field is kept, also one that nobody has declared."""
    extra = [(F.col("overall") * 2).alias("starsOfTen")]
    return loaded_reviews(spark, sf_dir, "bronze-inferred", extra=extra)


@query(f"{BRONZE_REVIEWS_SQL}, overall * 2 AS stars_of_ten FROM br")
def bronze_reviews_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that disagree on types, loaded by two runs: votes and stars start as whole numbers, and widen."""
    base = scratch_path(spark, "bronze-moved")
    raw = raw_reviews(spark, sf_dir, (F.col("overall") * 2).alias("starsOfTen"))
    write_raw(raw, f"{base}/raw", vote="long", starsOfTen="long")
    folders = readers.list_folders(spark, f"{base}/raw")
    bronze.load_bronze_reviews(spark, folders[:1], f"{base}/bronze")
    bronze.load_bronze_reviews(spark, folders, f"{base}/bronze", per_write=1)
    rows = readers.read_table(spark, f"{base}/bronze")
    return rows.withColumn("has_file", F.col("file_source").contains(f"{base}/raw")).drop("file_source")


@query(
    """SELECT p_partkey, p_size::DOUBLE + CASE WHEN p_size > 25 THEN 0.5 ELSE 0 END AS size_number,
  CASE WHEN p_size > 25 THEN 'size ' ELSE '' END || p_size AS size_text,
  CASE WHEN p_size > 25 THEN p_retailprice END AS p_retailprice, p_brand FROM part"""
)
def grown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers, to which a later append adds fractions in one column and text in another."""
    path = scratch_path(spark, "grown-types")
    part, size = data.table(spark, sf_dir, "part"), F.col("p_size").cast("long")
    first = part.where("p_size <= 25").select(
        "p_partkey", size.alias("size_number"), size.alias("size_text"), "p_brand"
    )
    later = part.where("p_size > 25").select(
        "p_partkey", (size + F.lit(0.5).cast("double")).alias("size_number"),
        F.concat(F.lit("size "), F.col("p_size")).alias("size_text"), "p_retailprice", "p_brand",
    )
    for rows in (first, later):
        ledger.grow_table(rows, path, "p_brand")
    return readers.read_table(spark, path)


@query(
    f"""WITH {sql.BRONZE_METADATA} SELECT asin, similar_item, price,
  strftime(try_strptime(raw_date, '%B %d, %Y'), '%Y') AS year FROM bm"""
)
def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that stops after its second write, and is started again over all folders."""
    base = scratch_path(spark, "resumed-load")
    raw = data.bronze_metadata(spark, sf_dir).withColumn("part", F.expr("pmod(xxhash64(similar_item), 5)"))
    raw.write.partitionBy("part").json(f"{base}/raw")
    folders = readers.list_folders(spark, f"{base}/raw")

    def stop(done: int, _: int) -> None:
        if done == 2:
            raise InterruptedError

    try:
        bronze.load_bronze_metadata(spark, folders, f"{base}/bronze", per_write=1, progress=stop)
    except InterruptedError:
        bronze.load_bronze_metadata(spark, folders, f"{base}/bronze", per_write=2)
    rows = readers.read_table(spark, f"{base}/bronze")
    return rows.select("asin", "similar_item", "price", F.col("year").cast("string").alias("year"))


# --- Enrichment and dashboards ------------------------------------------------------------


# Nested functions travel to the tasks by value, so these need not import this module.
def length_scorer():
    """A scorer that depends on the text's length alone, so that SQL can check it."""

    def make_scorer():
        import json

        labels = ("Neutral", "Positive", "Negative")

        def answer(text):
            if len(text) % 7 == 0:
                return "no answer"
            return json.dumps({"sentiment": labels[len(text) % 3], "keywords": str(len(text))})

        return lambda texts: [(answer(text), len(text)) for text in texts]

    return make_scorer


def length_classifier():
    def make_classifier():
        return lambda texts: ["POSITIVE" if len(text) % 2 else "NEGATIVE" for text in texts]

    return make_classifier


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = data.table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.col("text").alias("review_text"))


def _rule_sql(text_column: str) -> str:
    def hits(words: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{w}'" for w in words)
        return f"len(list_intersect(regexp_split_to_array(lower({text_column}), '[^\\p{{L}}]+'), [{listed}]))"

    lead = f"{hits(POSITIVE_WORDS)} - {hits(NEGATIVE_WORDS)}"
    return (
        f"CASE WHEN {text_column} IS NULL THEN NULL WHEN {lead} > 0 THEN 'Positive' "
        f"WHEN {lead} < 0 THEN 'Negative' ELSE 'Neutral' END"
    )


@query(
    f"""SELECT doc_id, {_rule_sql("text")} AS sentiment, CAST(NULL AS VARCHAR) AS actionable,
  CASE WHEN {sql.word_count("text")} = 1 THEN text END AS keywords, CAST(NULL AS VARCHAR) AS response
FROM documents"""
)
def enrich_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_texts(spark, sf_dir)
    return enrich.label_by_rule(rows, POSITIVE_WORDS, NEGATIVE_WORDS).drop("review_text")


@query(
    """SELECT doc_id, CASE WHEN length(text) % 7 > 0 THEN
    CASE length(text) % 3 WHEN 0 THEN 'Neutral' WHEN 1 THEN 'Positive' ELSE 'Negative' END
  END AS sentiment, CAST(NULL AS VARCHAR) AS actionable,
  CASE WHEN length(text) % 7 > 0 THEN CAST(length(text) AS VARCHAR) END AS keywords,
  CAST(NULL AS VARCHAR) AS response, length(text) AS tokens FROM documents"""
)
def enrich_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An injected scorer; one in seven of its answers is not JSON."""
    scored = enrich.score_reviews(
        review_texts(spark, sf_dir), length_scorer(), texts_per_call=16
    )
    return scored.drop("review_text")


def failing_scorer():
    """The scorer above, whose tenth call in every task fails, and every tenth after it."""

    def make_scorer():
        score, calls = make_length_scorer(), [0]

        def sometimes(texts):
            calls[0] += 1
            if calls[0] % 10 == 0:
                raise ConnectionError("busy")
            return score(texts)

        return sometimes

    make_length_scorer = length_scorer()
    return make_scorer


@query(
    """SELECT doc_id, CASE WHEN length(text) % 7 > 0 THEN
    CASE length(text) % 3 WHEN 0 THEN 'Neutral' WHEN 1 THEN 'Positive' ELSE 'Negative' END
  END AS sentiment, length(text) AS tokens FROM documents"""
)
def enrich_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer that fails on every tenth call: first without a second try, then again for what is missing."""
    store = scratch_path(spark, "answers")
    rows, how = review_texts(spark, sf_dir), {"texts_per_call": 8, "tasks": 4, "backoff": 0.0}
    answers.fill_answers(rows, store, failing_scorer(), attempts=1, **how)
    scored = answers.score_stored(rows, store, failing_scorer(), attempts=3, **how)
    return scoring.parse_answer(scored).select("doc_id", "sentiment", "tokens")


@query("SELECT sum(length(text))::BIGINT AS total_tokens FROM documents")
def token_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.score_texts(
        review_texts(spark, sf_dir), length_scorer(), texts_per_call=16
    )
    return scoring.token_total(scored)


@query(
    f"""SELECT doc_id, CASE length(text) % 2 WHEN 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
  CAST(NULL AS VARCHAR) AS actionable,
  CASE WHEN {sql.word_count("text")} = 1 THEN text END AS keywords,
  CAST(NULL AS VARCHAR) AS response FROM documents"""
)
def historic_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_texts(spark, sf_dir)
    return enrich.classify_reviews(rows, length_classifier()).drop("review_text")


@query(
    """SELECT event_id, props AS said, 'Neutral' AS sentiment, ANSWERED AS keywords, date FROM (
  SELECT event_id, props, ts::DATE AS date,
    CASE WHEN length(props) % 7 > 0 THEN CAST(length(props) AS VARCHAR) END AS ANSWERED FROM events)
WHERE date = DATE '2024-01-15'""".replace(
        "'Neutral' AS sentiment",
        """CASE WHEN length(props) % 7 > 0 THEN CASE length(props) % 3 WHEN 0 THEN 'Neutral'
    WHEN 1 THEN 'Positive' ELSE 'Negative' END END AS sentiment""",
    )
)
def enrich_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job over a monthly gold table: one date is the feature, not a sample."""
    base = scratch_path(spark, "enrich-daily")
    day = F.to_date("ts")
    reviews = data.table(spark, sf_dir, "events").select(
        "event_id", F.col("props").alias("review_text"), day.alias("date"),
        dates.month_start(day).alias("year_month"),
    )
    writers.overwrite_table(reviews, f"{base}/gold", "year_month")
    enrich.enrich_day(
        spark, f"{base}/gold", f"{base}/enriched", length_scorer(), DAY, texts_per_call=16,
        calls_per_minute=None, tasks=8,
    )
    return readers.read_table(spark, f"{base}/enriched").select(
        "event_id", F.col("review_text").alias("said"), "sentiment", "keywords", "date"
    )


@query(
    """SELECT event_id, ts::DATE AS date, CASE
  WHEN ts::DATE <> DATE '2024-01-15' THEN
    CASE length(props) % 2 WHEN 1 THEN 'Positive' ELSE 'Negative' END
  WHEN length(props) % 7 > 0 THEN
    CASE length(props) % 3 WHEN 0 THEN 'Neutral' WHEN 1 THEN 'Positive' ELSE 'Negative' END
  END AS sentiment FROM events"""
)
def historic_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day enriched by the daily job, then all other days by the classifier."""
    base = scratch_path(spark, "backfill")
    day = F.to_date("ts")
    reviews = data.table(spark, sf_dir, "events").select(
        "event_id", F.col("props").alias("review_text"), day.alias("date"),
        dates.month_start(day).alias("year_month"),
    )
    writers.overwrite_table(reviews, f"{base}/gold", "year_month")
    enrich.enrich_day(
        spark, f"{base}/gold", f"{base}/enriched", length_scorer(), DAY, texts_per_call=16,
        calls_per_minute=None, tasks=8,
    )
    enrich.backfill(
        spark, f"{base}/gold", f"{base}/enriched",
        lambda rows: enrich.classify_reviews(rows, length_classifier()),
    )
    return readers.read_table(spark, f"{base}/enriched").select("event_id", "date", "sentiment")


@query(
    f"""WITH {sql.REVIEWS.replace(sql.REVIEWED, "l_partkey").replace("l_shipdate::DATE AS date", "l_shipdate::DATE AS date, text")
        .replace("JOIN orders ON l_orderkey = o_orderkey",
                 "JOIN orders ON l_orderkey = o_orderkey LEFT JOIN documents ON l_orderkey = doc_id")},
s AS (SELECT asin, overall, {_rule_sql("text")} AS sentiment FROM r)
SELECT CAST(asin AS VARCHAR) AS asin, count(*) AS reviews, avg(overall) AS mean_rating,
  avg(CASE WHEN sentiment = 'Positive' THEN 1.0::DOUBLE ELSE 0.0 END) AS positive_share,
  avg(CASE WHEN sentiment = 'Neutral' THEN 1.0::DOUBLE ELSE 0.0 END) AS neutral_share,
  avg(CASE WHEN sentiment = 'Negative' THEN 1.0::DOUBLE ELSE 0.0 END) AS negative_share
FROM s GROUP BY asin"""
)
def product_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.bronze_reviews(spark, sf_dir).select("asin", "overall", "review_text")
    # The lines of an order share its text.
    labelled = enrich.label_once(rows, lambda texts: enrich.label_by_rule(texts, POSITIVE_WORDS, NEGATIVE_WORDS))
    return dashboards.product_dashboard(labelled)


def dated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled reviews with one keyword each, by the month they are from."""
    rows = data.bronze_reviews(spark, sf_dir).select(
        "asin", "overall", F.col("summary").alias("keywords"),
        F.when(F.col("vote").isNull(), "Neutral").when(F.col("verified"), "Positive").otherwise("Negative").alias("sentiment"),
        dates.month_start(F.col("unix_review_time_date")).alias("date"),
    )
    return rows


def rolled_days(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Both partial tables: all days but the last in one load, which then comes as the daily job's."""
    base = scratch_path(spark, label)
    rows = keep(dated_labels(spark, sf_dir), f"{label}-rows")
    last = rows.agg(F.max("date")).first()[0]
    writers.overwrite_table(rows, f"{base}/enriched", "date")
    dashboards.write_dashboard_days(rows.where(F.col("date") < F.lit(last)), f"{base}/days")
    dashboards.add_dashboard_day(spark, f"{base}/enriched", f"{base}/days", last)
    return f"{base}/days"


DATED_LABELS = """WITH s AS (SELECT CAST(l_partkey AS VARCHAR) AS asin, (l_quantity - 1) % 5 + 1 AS overall,
  lower(o_orderpriority) AS keyword,
  CASE WHEN l_linenumber <= 3 THEN 'Neutral' WHEN l_linestatus = 'F' THEN 'Positive' ELSE 'Negative' END AS sentiment
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(
    f"""{DATED_LABELS} SELECT asin, count(*) AS reviews, avg(overall) AS mean_rating,
  avg(CASE WHEN sentiment = 'Positive' THEN 1.0::DOUBLE ELSE 0.0 END) AS positive_share,
  avg(CASE WHEN sentiment = 'Neutral' THEN 1.0::DOUBLE ELSE 0.0 END) AS neutral_share,
  avg(CASE WHEN sentiment = 'Negative' THEN 1.0::DOUBLE ELSE 0.0 END) AS negative_share FROM s GROUP BY asin"""
)
def product_dashboard_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dashboard rolled up from daily sums."""
    return dashboards.product_totals(spark.read.parquet(f"{rolled_days(spark, sf_dir, 'product-days')}/products"))


@query(
    f"""{DATED_LABELS}, c AS (SELECT asin, keyword, count(*) AS n FROM s GROUP BY ALL)
SELECT asin, keyword, n, CAST(row_number() OVER (PARTITION BY asin ORDER BY n DESC, keyword) AS INTEGER) AS place
FROM c QUALIFY row_number() OVER (PARTITION BY asin ORDER BY n DESC, keyword) <= 3"""
)
def product_keyword_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent keywords per product from daily sketches, exact for so few keywords."""
    days = spark.read.parquet(f"{rolled_days(spark, sf_dir, 'keyword-days')}/keywords")
    return dashboards.keyword_totals(days, 3)


@query(
    f"""WITH {sql.JOINED},
g AS (SELECT DISTINCT j.*, {sql.label("overall", "overall_brand")} AS bt,
        {sql.label("overall", "overall_reviewer")} AS rt
      FROM j LEFT JOIN b ON j.brand = b.brand LEFT JOIN v ON j.reviewer_id = v.reviewer_id),
o AS (SELECT brand, reviewer_id, count(*) AS reviews,
  avg(CASE bt WHEN 'better' THEN 1.0::DOUBLE WHEN 'worse' THEN -1.0 ELSE 0.0 END) AS against_brand,
  avg(CASE rt WHEN 'better' THEN 1.0::DOUBLE WHEN 'worse' THEN -1.0 ELSE 0.0 END) AS against_own
FROM g WHERE brand IS NOT NULL AND reviewer_id IS NOT NULL GROUP BY ALL)
SELECT *, against_brand - against_own AS singled_out FROM o"""
)
def brand_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewers beside each brand they rated."""
    return dashboards.brand_outliers(compared_reviews(spark, sf_dir, reviewer_last=True))


@query(
    """WITH w AS (SELECT p_brand AS asin, unnest(string_split(p_name, ' ')) AS keyword FROM part),
c AS (SELECT asin, keyword, count(*) AS n FROM w GROUP BY ALL)
SELECT asin, keyword, n, CAST(row_number() OVER (PARTITION BY asin ORDER BY n DESC, keyword) AS INTEGER)
  AS place FROM c QUALIFY row_number() OVER (PARTITION BY asin ORDER BY n DESC, keyword) <= 3"""
)
def product_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = data.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("asin"), F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit(" ,  ")), F.lit(" ")).alias("keywords")
    )
    return dashboards.product_keywords(listed, 3)


@query(
    f"""WITH {sql.JOINED},
g AS (SELECT DISTINCT j.*, {sql.label("overall", "overall_brand")} AS bt,
        {sql.label("overall", "overall_reviewer")} AS rt
      FROM j LEFT JOIN b ON j.brand = b.brand LEFT JOIN v ON j.reviewer_id = v.reviewer_id)
SELECT reviewer_id, count(*) AS reviews,
  avg(CASE WHEN bt = 'better' THEN 1.0::DOUBLE ELSE 0.0 END) AS better_than_brand,
  avg(CASE WHEN bt = 'worse' THEN 1.0::DOUBLE ELSE 0.0 END) AS worse_than_brand,
  avg(CASE WHEN rt = 'better' THEN 1.0::DOUBLE ELSE 0.0 END) AS better_than_reviewer,
  avg(CASE WHEN rt = 'worse' THEN 1.0::DOUBLE ELSE 0.0 END) AS worse_than_reviewer
FROM g GROUP BY reviewer_id"""
)
def reviewer_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.reviewer_outliers(compared_reviews(spark, sf_dir, reviewer_last=True))
