"""Clustering along a curve, profiles from sketches, dashboards by day, positions from writes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import profile
from reviewmill.plans import dashboards
from reviewmill.sources import layout, positions
from reviewmill.streaming import jobs


def spans(table, key):
    """Smallest and largest value of a key in each file."""
    rows = table.groupBy(F.input_file_name()).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return [(r.low, r.high) for r in rows.collect()]


def opened(found, low, high):
    return sum(a <= high and b >= low for a, b in found if a is not None)


@pytest.fixture(scope="module")
def two_keys(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("curve") / "plain")
    pick = random.Random(1)
    # One key even, one bunched near zero with a long tail.
    rows = [(i, pick.random(), int(pick.paretovariate(0.7)), f"user{pick.randrange(10**6):06d}") for i in range(20_000)]
    spark.createDataFrame(rows, "i long, x double, y long, name string").repartition(8).write.parquet(path)
    return path


def test_filters_on_either_key_skip_most_files(spark, two_keys, tmp_path):
    curve = layout.cluster_by_curve(spark, two_keys, str(tmp_path / "curve"), ["x", "y"], files=64)
    sorted_ = layout.cluster(spark, two_keys, str(tmp_path / "sorted"), "x", files=64)
    high = curve.approxQuantile("y", [0.5, 0.52], 0.001)
    for found in (spans(curve, "x"), spans(curve, "y")):
        assert 50 <= len(found) <= 64
    assert opened(spans(curve, "x"), 0.5, 0.52) <= 16
    assert opened(spans(curve, "y"), *high) <= 32
    # The one-key sort skips as well on its own key, and not at all on the other.
    assert opened(spans(sorted_, "x"), 0.5, 0.52) <= 3
    assert opened(spans(sorted_, "y"), *high) == len(spans(sorted_, "y"))


@pytest.mark.parametrize("keys", [["x"], ["name", "y"], ["x", "y", "name"]])
def test_rows_stay_as_they_are(spark, two_keys, tmp_path, ansi, keys):
    found = layout.cluster_by_curve(spark, two_keys, str(tmp_path / "c"), keys, files=8, bits=5)
    before = spark.read.parquet(two_keys)
    assert found.columns == before.columns and found.exceptAll(before).isEmpty() and before.exceptAll(found).isEmpty()


def test_curve_over_nulls_ties_and_other_kinds(spark, tmp_path, ansi):
    path, day = str(tmp_path / "t"), dt.date(2020, 1, 1)
    rows = [(i, None if i % 3 else day + dt.timedelta(days=i), dt.datetime(2020, 1, 1), i % 2 == 0, None, "é" * i) for i in range(60)]
    spark.createDataFrame(rows, "i int, d date, t timestamp, b boolean, n long, s string").write.parquet(path)
    found = layout.cluster_by_curve(spark, path, str(tmp_path / "c"), ["d", "t", "b", "n", "s"], files=3, bits=4)
    assert sorted(r.i for r in found.collect()) == list(range(60))
    with pytest.raises(ValueError, match="62 bits"):
        layout.cluster_by_curve(spark, path, str(tmp_path / "x"), ["i", "d"], files=3, bits=32)
    spark.createDataFrame([([1],)], "a array<int>").write.parquet(str(tmp_path / "a"))
    with pytest.raises(ValueError, match="cannot be a key"):
        layout.cluster_by_curve(spark, str(tmp_path / "a"), str(tmp_path / "y"), ["a"], files=1)


def test_curve_interleaves_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a long, b long")
    found = rows.select("a", "b", layout.curve_place([F.col("a"), F.col("b")], 2).alias("at")).collect()
    assert {(r.a, r.b): r["at"] for r in found} == {
        (a, b): (a >> 1) * 8 + (b >> 1) * 4 + (a & 1) * 2 + (b & 1) for a in range(4) for b in range(4)
    }


def test_sketched_profile_stays_in_its_error(spark, ansi):
    # 60,000 keys, of which one has a tenth of the rows; another column of few values, with nulls.
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 10 == 0, -1).otherwise(F.col("id") % 60_000).alias("many"),
        F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("string")).alias("few"),
    )
    keys = {"many": F.col("many"), "few": F.col("few")}
    exact = {r.column_name: r for r in profile.partition_key_profile(rows, keys).collect()}
    found = {r.column_name: r for r in profile.partition_key_sketch(rows, keys, values=1024).collect()}
    for name, error in (("many", 4), ("few", 0)):
        e, f = exact[name], found[name]
        assert abs(f.groups / e.groups - 1) <= error * f.groups_error
        assert abs(f.largest_group - e.largest_group) <= f.largest_error
    assert found["few"].skew == exact["few"].skew and found["few"].largest_error == 0 < found["many"].largest_error


def test_sketches_shuffle_a_row_a_task(spark):
    rows = spark.range(100_000).repartition(5).select(F.col("id").alias("k"))
    plan = profile.partition_key_sketch(rows, {"k": F.col("k")})._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.split("RoundRobin")[0] and "SinglePartition" in plan
    empty = profile.partition_key_sketch(rows.limit(0), {"k": F.col("k")})
    assert empty.count() == 0


LABELS = "asin string, overall double, sentiment string, keywords string, date date"


def labelled(spark, day, n, seed):
    pick = random.Random(seed)
    rows = [
        (f"p{pick.randrange(5)}", pick.choice([1.0, 2.0, 5.0, None]), pick.choice(["Positive", "Neutral", "Negative", None]),
         pick.choice([None, "", "Good", "good, Bad ,", "bad,late"]), day)
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, LABELS)


def test_days_roll_up_to_the_dashboards(spark, tmp_path, ansi):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    path, folder = str(tmp_path / "enriched"), str(tmp_path / "days")
    for i, day in enumerate(days):
        labelled(spark, day, 40 + i, i).write.mode("append").partitionBy("date").parquet(path)
    enriched = spark.read.parquet(path)
    dashboards.write_dashboard_days(enriched.where(F.col("date") < days[2]), folder)
    for _ in range(2):  # a rerun replaces the day
        assert dashboards.add_dashboard_day(spark, path, folder, days[2]) == 5
    whole = {r.asin: r for r in dashboards.product_dashboard(enriched).collect()}
    for r in dashboards.product_totals(spark.read.parquet(f"{folder}/products")).collect():
        w = whole[r.asin]
        assert (r.reviews, r.mean_rating) == (w.reviews, w.mean_rating)
        # An unlabelled review is in no share's count, on either side.
        assert r.positive_share == w.positive_share and r.negative_share == w.negative_share
    keywords = spark.read.parquet(f"{folder}/keywords")
    assert sorted(map(tuple, dashboards.keyword_totals(keywords, 2).collect())) == sorted(
        map(tuple, dashboards.product_keywords(enriched, 2).collect())
    )
    two = keywords.where(F.col("date") < days[2])
    assert sorted(map(tuple, dashboards.keyword_totals(two, 2).collect())) == sorted(
        map(tuple, dashboards.product_keywords(enriched.where(F.col("date") < days[2]), 2).collect())
    )


def test_a_new_day_reads_one_day(spark, tmp_path):
    path, folder = str(tmp_path / "enriched"), str(tmp_path / "days")
    for d in (1, 2):
        labelled(spark, dt.date(2024, 1, d), 20, d).write.mode("append").partitionBy("date").parquet(path)
    for file in (tmp_path / "enriched" / "date=2024-01-01").glob("*.parquet"):
        file.write_bytes(b"spoiled")  # whoever opens the other day fails
    for crc in (tmp_path / "enriched" / "date=2024-01-01").glob(".*.crc"):
        crc.unlink()
    schema = labelled(spark, None, 0, 0).schema
    assert dashboards.add_dashboard_day(spark, path, folder, dt.date(2024, 1, 2), schema=schema) > 0


def test_brand_outliers(spark, ansi):
    rows = [("b", "r", "better", "better")] * 2 + [("b", "r", "worse", "normal"), ("c", "r", "worse", "better"), (None, "r", "better", "better"), ("c", None, "worse", "worse")]
    gold = spark.createDataFrame(rows, "brand string, reviewer_id string, brand_deviation_text string, reviewer_deviation_text string")
    found = {(r.brand, r.reviewer_id): (r.reviews, round(r.against_brand, 6), round(r.against_own, 6), round(r.singled_out, 6)) for r in dashboards.brand_outliers(gold).collect()}
    assert found == {("b", "r"): (3, 0.333333, 0.666667, -0.333333), ("c", "r"): (1, -1.0, 1.0, -2.0)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_positions_come_from_the_writes(spark, tmp_path, zone):
    schema = "body binary, offset string, sequenceNumber long, enqueuedTime timestamp_ntz"
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        base = str(tmp_path)
        for run, moments in enumerate([[3, 9, 5], [], [4]]):  # the last run has an older event only
            rows = [(b"{}", str(100 * run + h), 100 * run + h, dt.datetime(2024, 1, 1, h)) for h in moments]
            spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/in")
            events = spark.readStream.schema(schema).parquet(f"{base}/in")
            assert jobs.run_bronze_with_position(spark, events, f"{base}/bronze", f"{base}/checks", f"{base}/positions", "hub")
            assert positions.stored_position(spark, f"{base}/positions", "hub") == "2024-01-01 09:00:00.000000"
        row = positions.latest_positions(spark, f"{base}/positions").first()
        assert (row.max_offset, row.sequence_number) == (204, 204)
        assert spark.read.parquet(f"{base}/bronze").count() == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
