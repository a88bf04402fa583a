from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewmill.functions.rating import POSITIVE
from reviewmill.operators import columns, counts, dedupe, filters, profile, sets
from reviewmill.plans import dashboards, quality


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# --- latest row per key, distinct rows ---------------------------------------------------


def test_latest_row_dates_beat_nulls_and_ties_are_settled(spark, ansi):
    rows = [
        ("a", None, 1), ("a", dt.date(2020, 1, 1), 2), ("a", dt.date(2020, 1, 1), 3),
        ("b", None, 4), ("b", None, 5), (None, dt.date(2020, 1, 1), 6), (None, dt.date(2021, 1, 1), 7),
    ]
    frame = spark.createDataFrame(rows, "asin string, date date, n int")
    kept = dedupe.latest_per_key(frame, "asin", "date", ["n"])
    assert sorted(r.n for r in kept.collect()) == [3, 5, 7]
    assert kept.columns == frame.columns


def test_latest_row_without_tiebreak_is_stable(spark):
    rows = [("a", None, [str(i)]) for i in range(50)]
    schema = "asin string, date date, tags array<string>"
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, schema).repartition(5)
        picks.add(tuple(dedupe.latest_per_key(frame, "asin", "date").first().tags))
    assert len(picks) == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("asin"), F.col("id").alias("n"))
    plan = plan_of(dedupe.latest_per_key(frame, "asin", "n", ["n"]))
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_distinct_combines_before_the_shuffle(spark):
    frame = spark.range(1000).select(F.lit("a").alias("text"), F.array(F.lit("x")).alias("tags"))
    distinct = dedupe.distinct_rows(frame)
    assert "HashAggregate" in plan_of(distinct).split("Exchange")[1]
    assert distinct.count() == 1


def test_top_per_key(spark):
    frame = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "x", 1)], "k string, v string, n int")
    top = dedupe.top_per_key(frame, ["k"], [F.desc("n"), F.col("v")], 2)
    assert sorted(tuple(r) for r in top.collect()) == [("a", "x", 3, 1), ("a", "y", 3, 2), ("b", "x", 1, 1)]


# --- counts ------------------------------------------------------------------------------


def test_value_frequency_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in counts.value_frequency(frame, "v").collect()] == [
        ("c", 2), (None, 1), ("a", 1), ("b", 1),
    ]
    assert [tuple(r) for r in counts.value_frequency(frame, "v", top=1).collect()] == [("c", 2)]


def test_top_values_need_no_full_sort(spark):
    frame = spark.range(100).select((F.col("id") % 7).alias("v"))
    assert "TakeOrderedAndProject" in plan_of(counts.value_frequency(frame, "v", top=3))


def test_marks_are_independent_maxima(spark):
    frame = spark.createDataFrame(
        [(1, 9, dt.datetime(2024, 1, 1)), (5, 2, dt.datetime(2023, 1, 1)), (None, None, None)],
        "sequenceNumber bigint, offset bigint, enqueuedTime timestamp",
    )
    row = counts.high_water_mark(frame).first()
    assert (row.sequence_number, row.max_offset, row.enqueued_time) == (5, 9, dt.datetime(2024, 1, 1))


# --- profiles -----------------------------------------------------------------------------


def test_missing_share(spark, ansi):
    frame = spark.createDataFrame(
        [("x", [], 1), ("", ["a"], None), ("{}", None, 2), (None, [None], 3)],
        "words string, tags array<string>, n int",
    )
    found = [tuple(r) for r in profile.missing_share(frame).collect()]
    assert found == [("words", "string", 0.75, 0.25), ("tags", "array<string>", 0.25, 0.25)]


def test_missing_share_is_one_pass(spark, tmp_path):
    spark.createDataFrame([("x", "y", ["z"])], "a string, b string, c array<string>").write.parquet(
        str(tmp_path / "t")
    )
    frame = profile.missing_share(spark.read.parquet(str(tmp_path / "t")))
    assert plan_of(frame).count("FileScan") == 1


def test_missing_share_needs_a_column(spark):
    with pytest.raises(ValueError):
        profile.missing_share(spark.range(3))


def test_partition_keys(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 4)], "k string, n int")
    found = profile.partition_key_profile(frame, {"k": F.col("k"), "n": F.col("n")})
    assert sorted(tuple(r) for r in found.collect()) == [("k", 3, 3, 5 / 3, 3 / (5 / 3)), ("n", 4, 2, 1.25, 1.6)]
    assert plan_of(found).split("Initial Plan")[0].count("Scan ExistingRDD") == 1


def test_quality_profile(spark):
    frame = spark.createDataFrame([("x", "p"), ("", "p")], "a string, b string")
    found = [tuple(r) for r in quality.quality_profile(frame, ["b"]).collect()]
    assert sorted(found, key=str) == sorted(
        [("rows", None, None, 2.0), ("missing", "a", "string", 0.5), ("missing", "b", "string", 0.0), ("value", "b", "p", 2.0)],
        key=str,
    )
    assert profile.column_overview(frame) == [("a", "string"), ("b", "string")]


# --- filters, columns, sets ---------------------------------------------------------------


def test_partition_filters_prune(spark, tmp_path):
    rows = [(i, dt.date(2020, 1 + i % 3, 1 + i % 20), str(2015 + i % 5)) for i in range(60)]
    frame = spark.createDataFrame(rows, "n int, date date, year string").withColumn(
        "year_month", F.trunc("date", "month")
    )
    frame.write.partitionBy("year_month").parquet(str(tmp_path / "m"))
    day = dt.date(2020, 2, 17)
    found = filters.on_day(spark.read.parquet(str(tmp_path / "m")), day)
    assert sorted(r.n for r in found.collect()) == sorted(r[0] for r in rows if r[1] == day)
    scan = next(line for line in plan_of(found).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(year_month" in scan and "EqualTo(date,2020-02-17)" in scan
    assert {r.year for r in filters.from_year(frame, 2017).collect()} == {"2017", "2018", "2019"}


def test_day_late_in_the_month(spark):
    """The month key holds for every day, not for days 1 to 9 alone."""
    day = dt.date(2020, 2, 29)
    frame = spark.createDataFrame([(day, day.replace(day=1))], "date date, year_month date")
    assert filters.on_day(frame, day).count() == 1


def test_lift_struct(spark):
    frame = spark.createDataFrame([(1, "b", (2, "y"))], "id int, body string, parsed struct<n int, t string>")
    lifted = columns.lift_struct(frame, "parsed", ["body"])
    assert lifted.columns == ["id", "n", "t"] and tuple(lifted.first()) == (1, 2, "y")


def test_union_keeps_duplicates_and_fills_columns(spark):
    one = spark.createDataFrame([(1,), (1,)], "a int")
    two = spark.createDataFrame([("x", 1)], "b string, a int")
    found = sorted((tuple(r) for r in sets.union_all(one, two, allow_missing=True).collect()), key=str)
    assert found == [(1, "x"), (1, None), (1, None)]
    with pytest.raises(AnalysisException):
        sets.union_all(one, two)


def test_feeds_need_their_columns(spark):
    schema = StructType().add("overall", "double").add("vote", "string")
    feed = spark.createDataFrame([(5.0, "2")], "Overal double, vote string")
    with pytest.raises(ValueError, match="overall"):
        sets.union_feeds(schema, feed)
    assert sets.union_feeds(schema, feed, optional=["overall"]).collect() == [Row(overall=None, vote="2")]


def test_quality_sections_in_one_scan(spark, tmp_path):
    rows = [("good", 5.0, dt.date(2024, 1, 3)), ("good", 1.0, dt.date(2024, 2, 3)), ("two words", 3.0, None)]
    spark.createDataFrame(rows, "text string, overall double, day date").write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    report = quality.quality_profile(frame, day="day", keys=["overall"], text="text", rating="overall")
    found = {(r.section, r.value): r.amount for r in report.collect()}
    assert found["rows", None] == 3 and found["month", "2024-01-01"] == 1 and found["year", "2024-01-01"] == 2
    assert found["key", "groups"] == 3 and found["key", "skew"] == 1
    # A keyword, its rating and the sentiment they imply; empty where there is none.
    assert found["keyword", f"good|5.0|{POSITIVE}"] == 1 and found["keyword", "|3.0|"] == 1
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1


def test_keywords_are_trimmed(spark):
    named = spark.createDataFrame([("a", " screen"), ("a", "screen , battery")], "asin string, keywords string")
    found = {r.keyword: r.n for r in dashboards.product_keywords(named, 5).collect()}
    assert found == {"screen": 2, "battery": 1}


# --- dashboards -----------------------------------------------------------------------------


def test_dashboards(spark):
    enriched = spark.createDataFrame(
        [("p", 5.0, "Positive", "Fast, cheap"), ("p", 1.0, "Negative", "fast"), ("p", 3.0, None, None)],
        "asin string, overall double, sentiment string, keywords string",
    )
    row = dashboards.product_dashboard(enriched).first()
    assert (row.reviews, row.mean_rating) == (3, 3.0)
    assert (row.positive_share, row.neutral_share, row.negative_share) == (1 / 3, 0.0, 1 / 3)
    found = dashboards.product_keywords(enriched, 5).select("keyword", "n", "place").collect()
    assert sorted(tuple(r) for r in found) == [("cheap", 1, 2), ("fast", 2, 1)]

    gold = spark.createDataFrame(
        [("u", "better", "worse"), ("u", "normal", "worse"), (None, "better", "better")],
        "reviewer_id string, brand_deviation_text string, reviewer_deviation_text string",
    )
    assert [tuple(r) for r in dashboards.reviewer_outliers(gold).collect()] == [("u", 2, 0.5, 0.0, 0.0, 1.0)]
