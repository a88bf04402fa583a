"""Readers, writers, layout and positions on real files."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from checks import queries
from reviewmill.operators import dedupe
from reviewmill.plans import bronze, silver
from reviewmill.schemas import METADATA, POSITIONS, RAW_REVIEWS
from reviewmill.session import build_session, keep, scratch_path, shuffle_partitions, size_shuffles
from reviewmill.sources import layout, positions, readers, writers
from reviewmill.streaming import jobs


def data_files(path):
    return [
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    ]


def days(spark, rows):
    return spark.createDataFrame(rows, "n int, date date")


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def stored(spark, path):
    return sorted((r.n, r.date) for r in spark.read.parquet(path).collect())


def json_folders(spark, root, count, rows=2):
    frame = spark.range(count * rows).select(
        F.concat(F.lit("p"), F.col("id")).alias("asin"),
        F.lit("July 1, 2014").alias("date"),
        F.lit("x").alias("extra"),
        F.format_string("part%03d", F.col("id") % count).alias("folder"),
    )
    frame.repartition(4, "folder").write.partitionBy("folder").json(root)
    return readers.list_folders(frame.sparkSession, root)


def test_json_with_declared_schema(spark, tmp_path, ansi):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text('{"asin":"a","unknown":1,"also_buy":["x"]}\nnot json\n{"price":5}\n')
    found = readers.read_json(spark, str(path), METADATA)
    assert found.schema == METADATA
    assert sorted((r.asin or "", r.also_buy or [], r.price or "") for r in found.collect()) == [
        ("", [], ""), ("", [], "5"), ("a", ["x"], ""),
    ]


def test_json_with_inferred_schema(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text('{"asin":"a","overall":5}\n')
    (path / "b.json").write_text('{"asin":"b","overall":4.5,"vote":"2"}\n')
    found = readers.read_json(spark, str(path))
    assert dict(found.dtypes) == {"asin": "string", "overall": "double", "vote": "string"}


def test_folders_in_order_and_from_the_nth(spark, tmp_path):
    folders = json_folders(spark, str(tmp_path / "raw"), 3)
    assert [f[-7:] for f in folders] == ["part000", "part001", "part002"]
    assert readers.list_folders(spark, str(tmp_path / "raw"), start=2) == folders[2:]
    one_scan = readers.read_json(spark, folders, METADATA)
    united = None
    for folder in folders:
        part = readers.read_json(spark, folder, METADATA)
        united = part if united is None else united.union(part)
    assert sorted(r.asin for r in one_scan.collect()) == sorted(r.asin for r in united.collect())


def test_every_folder_is_loaded_in_batches(spark, tmp_path):
    """250 folders, 100 per write: the last short batch is written too."""
    folders = json_folders(spark, str(tmp_path / "raw"), 250, rows=1)
    seen = []
    loaded = bronze.load_bronze_metadata(
        spark, folders, str(tmp_path / "bronze"), per_write=100, progress=lambda done, _: seen.append(done)
    )
    table = spark.read.parquet(str(tmp_path / "bronze"))
    assert (loaded, table.count(), seen) == (250, 250, [100, 200, 250])
    assert {r.year for r in table.select("year").collect()} == {2014}


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(days(spark, [(1, D1), (2, D2)]), path, "date")
    writers.append_table(days(spark, [(3, D2)]), path, "date")
    assert stored(spark, path) == [(1, D1), (2, D2), (3, D2)]
    writers.overwrite_table(days(spark, [(9, D3)]), path, "date")
    assert stored(spark, path) == [(9, D3)]


def test_records_per_file(spark, tmp_path):
    writers.append_table(spark.range(100).repartition(1), str(tmp_path / "t"), max_records=30)
    assert len(data_files(tmp_path / "t")) >= 4


def test_hot_partition_is_split_and_small_ones_are_not(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        frame = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 5)).alias("day"),
            F.sha2(F.col("id").cast("string"), 512).alias("text"),
        )
        writers.overwrite_table(frame, str(tmp_path / "t"), "day")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(data_files(tmp_path / "t" / "day=hot")) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_replace_day_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(days(spark, [(1, D1), (2, D2), (3, D3)]), path, "date")
    for _ in range(2):
        assert writers.replace_day(days(spark, [(7, D2), (8, D2)]), path, D2) == 2
        assert stored(spark, path) == [(1, D1), (3, D3), (7, D2), (8, D2)]


@pytest.mark.parametrize("stranger", [D3, None])
def test_replace_day_refuses_other_days(spark, tmp_path, stranger):
    path = str(tmp_path / "t")
    writers.overwrite_table(days(spark, [(1, D1), (2, D2)]), path, "date")
    with pytest.raises(ValueError, match="1 rows are not of date = 2024-01-02"):
        writers.replace_day(days(spark, [(7, D2), (8, stranger)]), path, D2)
    assert stored(spark, path) == [(1, D1), (2, D2)]


def test_replace_day_without_rows_empties_it(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_table(days(spark, [(1, D1), (2, D2)]), path, "date")
    assert writers.replace_day(days(spark, []), path, D2) == 0
    assert stored(spark, path) == [(1, D1)]
    assert writers.replace_day(days(spark, [(5, D2)]), path, D2) == 1
    assert stored(spark, path) == [(1, D1), (5, D2)]


def test_publish(spark, tmp_path):
    writers.publish_table(days(spark, [(1, D1)]), "published_reviews")
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        writers.publish_table(days(spark, [(1, D1)]), "published_reviews")
    writers.publish_table(days(spark, [(2, D2)]), "published_reviews", mode="append")
    assert spark.table("published_reviews").count() == 2


def test_publish_day_never_doubles_a_day(spark):
    rows = days(spark, [(1, D1), (2, D2)])
    for day in (D1, D2, D2):
        writers.publish_day(rows, "published_days", day)
    writers.publish_day(days(spark, [(9, D1)]), "published_days", D1)
    assert sorted((r.n, r.date) for r in spark.table("published_days").collect()) == [(2, D2), (9, D1)]
    writers.publish_day(days(spark, []), "published_days", D1)
    assert [(r.n, r.date) for r in spark.table("published_days").collect()] == [(2, D2)]


def test_schema_growth(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(spark.createDataFrame([(1,)], "a int"), path)
    writers.append_table(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    found = readers.read_table(spark, path, merge_schema=True)
    assert sorted((tuple(r) for r in found.select("a", "b").collect()), key=str) == [(1, None), (2, "x")]


def test_compact(spark, tmp_path):
    spark.range(0, 1000, 1, 20).withColumn("k", F.col("id") % 3).write.parquet(str(tmp_path / "small"))
    found = layout.compact(spark, str(tmp_path / "small"), str(tmp_path / "few"), files=2)
    assert len(data_files(tmp_path / "small")) == 20 and len(data_files(tmp_path / "few")) == 2
    assert sorted(r.id for r in found.collect()) == list(range(1000))


def test_compact_partitioned(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 20).withColumn("k", F.col("id") % 3)
    frame.write.partitionBy("k").parquet(str(tmp_path / "small"))
    found = layout.compact(spark, str(tmp_path / "small"), str(tmp_path / "few"), by="k")
    assert len(data_files(tmp_path / "few")) < len(data_files(tmp_path / "small")) == 60
    assert sorted((r.id, r.k) for r in found.collect()) == [(i, str(i % 3)) for i in range(1000)]


def test_cluster_gives_ranges_and_splits_a_hot_key(spark, tmp_path):
    key = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000)
    spark.range(0, 6000, 1, 4).withColumn("asin", key).write.parquet(str(tmp_path / "plain"))
    found = layout.cluster(spark, str(tmp_path / "plain"), str(tmp_path / "sorted"), "asin", files=6)
    ranges = sorted(
        tuple(r)
        for r in found.groupBy(F.input_file_name().alias("f"))
        .agg(F.min("asin").alias("low"), F.max("asin").alias("high"), F.count("*").alias("n"))
        .select("low", "high", "n")
        .collect()
    )
    assert len(ranges) == 6
    # Files meet at most in the hot key, and no file holds the whole hot third.
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert max(r[2] for r in ranges) < 2000
    assert found.columns == ["id", "asin"]


def test_positions(spark, tmp_path):
    path = str(tmp_path / "positions")
    events = spark.createDataFrame(
        [(1, 10, dt.datetime(2024, 1, 1, 5, 0, 0, 250000)), (2, 9, dt.datetime(2024, 1, 1, 4))],
        "sequenceNumber bigint, offset bigint, enqueuedTime timestamp",
    )
    positions.save_position(events.limit(0), path, "hub")
    assert positions.stored_position(spark, path, "hub") is None
    positions.save_position(events.where("offset = 9"), path, "hub")
    positions.save_position(events, path, "hub")
    positions.save_position(events.where("offset = 9"), path, "other")
    assert positions.stored_position(spark, path, "hub") == "2024-01-01 05:00:00.250000"
    assert positions.stored_position(spark, path, "other") == "2024-01-01 04:00:00.000000"
    latest = positions.latest_positions(spark, path)
    assert latest.schema == POSITIONS and latest.count() == 2


def test_start_position():
    assert readers.start_position("s") == "s"
    assert readers.start_position("s", " m ") == "m"
    assert readers.start_position("s", "  ") == "s"
    assert readers.start_position("s", "m", from_beginning=True) is None
    assert readers.start_position(None) is None


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_from_position_reads_the_boundary_again(spark, ansi, kind):
    events = spark.sql(
        f"SELECT * FROM VALUES (1, cast('2024-01-01 00:00:00.5' AS {kind})), "
        f"(2, cast('2024-01-02 00:00:00' AS {kind})), (3, cast('2024-01-03 00:00:00' AS {kind})) AS t(n, enqueuedTime)"
    )
    found = readers.from_position(events, "2024-01-02 00:00:00.000000")
    assert sorted(r.n for r in found.collect()) == [2, 3]
    assert readers.from_position(events, None).count() == 3


def test_kafka_options():
    plain = readers.kafka_options("host:1", "reviews", "readers")
    assert plain == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "reviews", "kafka.group.id": "readers",
        "startingOffsets": "earliest",
    }
    timed = readers.kafka_options("host:1", "reviews", "readers", "2023-07-30 00:00:21.274000")
    assert timed["startingTimestamp"] == "1690675221274" and "startingOffsets" not in timed


def test_kafka_messages_as_envelopes(spark):
    messages = spark.createDataFrame(
        [(bytearray(b"{}"), 7, dt.datetime(2024, 1, 1))], "value binary, offset bigint, timestamp timestamp"
    )
    row = bronze.bronze_events(readers.kafka_envelope(messages)).first()
    assert (row.body, row.offset, row.sequenceNumber, row.date_utc) == ("{}", 7, 7, "2024-01-01")


def test_bronze_reviews(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text('{"asin":"a","reviewerID":"r","unixReviewTime":1577836800,"overall":5.0,"verified":true}\n')
    assert bronze.load_bronze_reviews(spark, [str(path)], str(tmp_path / "declared"), schema=RAW_REVIEWS) == 1
    assert bronze.load_bronze_reviews(spark, [str(path)], str(tmp_path / "inferred")) == 1
    for table in ("declared", "inferred"):
        row = spark.read.parquet(str(tmp_path / table)).first()
        assert (row.asin, row.reviewer_id, row.unix_review_time_date) == ("a", "r", dt.date(2020, 1, 1))
        assert row.file_source.endswith("a.json") and str(row.year_month).startswith("2020-01")


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(base) and one != two


def test_kept_frames_are_tables(spark):
    kept = keep(spark.range(10).withColumn("v", F.rand()), "kept")
    assert "FileScan" in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.collect() == kept.collect()


def test_session_settings(spark):
    assert build_session(settings={}).conf.get("spark.sql.session.timeZone") == "UTC"
    assert shuffle_partitions(10) == 200
    assert shuffle_partitions(100 * 1024**4) == 819_200


@pytest.mark.parametrize(
    "start", ["2023-12-31", "2023-12-31 00:00:00", "2023-12-31T00:00:00Z", "2023-12-31 00:00:00.000000"]
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_any_written_start_reads_all_events(spark, start, kind):
    events = spark.sql(f"SELECT {kind}'2024-01-01 00:00:00' AS enqueuedTime UNION ALL SELECT {kind}'2024-01-02 00:00:00'")
    assert readers.from_position(events, start).count() == 2
    with pytest.raises(ValueError):
        readers.from_position(events, "yesterday")


def test_positions_are_utc_in_any_session_zone(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        events = spark.sql(
            "SELECT 1L AS sequenceNumber, 1L AS offset, timestamp'2024-01-01 12:00:00Z' AS enqueuedTime "
            "UNION ALL SELECT 2L, 2L, timestamp'2024-01-01 14:00:00Z'"
        )
        path = str(tmp_path / "positions")
        assert positions.stored_position(spark, path, "hub") is None
        positions.save_position(events.where("offset = 1"), path, "hub")
        stored = positions.stored_position(spark, path, "hub")
        assert stored == "2024-01-01 12:00:00.000000"
        assert readers.from_position(events, stored).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_published_columns_are_not_dropped(spark):
    day = dt.date(2024, 1, 1)
    with_tables = spark.createDataFrame([(1, day)], "n int, date date")
    writers.publish_day(with_tables, "published_strict", day)
    with pytest.raises(ValueError, match="extra"):
        writers.publish_day(with_tables.withColumn("extra", F.lit(1)), "published_strict", day)
    spark.sql("DROP TABLE published_strict")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    unset = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: unset[key])
    assert scratch_path(spark, "x").startswith("file:/tmp/warehouse/")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(spark, "x")


def test_compaction_keeps_partition_text(spark, tmp_path):
    rows = spark.createDataFrame([(1, "007"), (2, "1e3"), (3, "10")], "n int, k string")
    rows.write.partitionBy("k").parquet(str(tmp_path / "many"))
    found = layout.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"), by="k")
    assert sorted((r.n, r.k) for r in found.collect()) == [(1, "007"), (2, "1e3"), (3, "10")]
    assert sorted(p.name for p in (tmp_path / "few").glob("k=*")) == ["k=007", "k=10", "k=1e3"]


def test_raw_fields_nobody_declared_are_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"asin":"a","unixReviewTime":1577836800,"starsOfTen":9}\n')
    bronze.load_bronze_reviews(spark, [str(tmp_path / "in")], str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first().stars_of_ten == 9


def test_daily_position_prunes_days(spark, tmp_path):
    rows = [(i, i, dt.datetime(2024, 1, 1 + i, 12), f"2024-01-0{1 + i}") for i in range(4)]
    events = spark.createDataFrame(rows, "sequenceNumber long, offset long, enqueuedTime timestamp_ntz, date_utc string")
    bronze_path, path = str(tmp_path / "bronze"), str(tmp_path / "positions")
    events.where("offset < 2").write.partitionBy("date_utc").parquet(bronze_path)
    jobs.save_daily_position(spark, bronze_path, path, "hub")
    events.where("offset >= 2").write.mode("append").partitionBy("date_utc").parquet(bronze_path)
    jobs.save_daily_position(spark, bronze_path, path, "hub")
    assert positions.stored_position(spark, path, "hub") == "2024-01-04 12:00:00.000000"


def test_shuffles_follow_the_input(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    try:
        assert size_shuffles(spark, str(tmp_path / "t")) == 200
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "200"
    finally:
        if before is None:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_silver_compares_only_rows_that_share_their_short_fields(spark, ansi):
    ddl = "asin string, image string, overall double, review_text string, reviewer_id string, reviewer_name string, unix_review_time_date date"
    rows = [
        ("a", '["88"]', 1.0, "x y", "r", "A &amp; B", None),
        ("a", "[]", 1.0, "x y", "r", "A & B", None),  # the same once it is clean
        ("a", "[]", 2.0, "x y", "r", "A & B", None),
        (None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None),
    ]
    found = silver.silver_reviews(spark.createDataFrame(rows + [("b", None, 1.0, "z", "q", "C", None)], ddl))
    assert sorted((str(r.asin), str(r.overall), str(r.review_word_count)) for r in found.collect()) == [
        ("None", "None", "None"), ("a", "1.0", "2"), ("a", "2.0", "2"), ("b", "1.0", "1"),
    ]
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    alone = spark.createDataFrame([(str(i), None, 1.0, "text", "r", "n", None) for i in range(50)], ddl)
    assert "Exchange" not in plan(silver.silver_reviews(alone)) and silver.silver_reviews(alone).count() == 50


@pytest.mark.parametrize("most", [0, 1, 100])
def test_once_and_several(spark, most):
    rows = spark.createDataFrame([(i % 7, None if i % 7 else "t") for i in range(7)] + [(1, "u"), (2, None), (None, "v"), (None, "w")], "k int, t string")
    once, several = dedupe.once_and_several(rows, ["k"], most)
    if most < 3:  # three values of k are repeated
        assert once is None and several.count() == 11
    else:
        assert sorted(r.k for r in once.collect()) == [0, 3, 4, 5, 6] and several.count() == 6


def test_raw_feed_is_compressed_and_written_by_folder(spark, tmp_path):
    raw = spark.range(300).select(F.col("id").cast("string").alias("asin"), F.lit("7").alias("vote"))
    queries.write_raw(raw, str(tmp_path / "raw"), vote="long")
    folders = readers.list_folders(spark, str(tmp_path / "raw"))
    names = [n for f in folders for n in os.listdir(f.removeprefix("file:")) if n.startswith("part-")]
    assert len(folders) == 3 and names and all(n.endswith(".json.gz") for n in names)
    assert [readers.read_json(spark, f).schema["vote"].dataType.simpleString() for f in folders] == ["bigint", "string", "string"]
    assert sum(readers.read_json(spark, f).count() for f in folders) == 300


def test_tables_are_written_with_zstd(spark, tmp_path):
    writers.append_table(days(spark, [(1, None)]), str(tmp_path / "t"))
    assert all(name.endswith(".zstd.parquet") for name in data_files(tmp_path / "t")) and data_files(tmp_path / "t")


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_tables_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    frame = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 3).cast("string").alias("day"))
    writers.overwrite_table(frame, str(tmp_path / "t"), "day")
    for _ in range(50):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_rows_are_written_where_they_are(spark, tmp_path):
    """Each of four tasks writes its rows of all days, also where there are more days than files may be open."""
    frame = spark.range(0, 3000, 1, 4).select("id", (F.col("id") % 300).cast("string").alias("day"))
    before = shuffle_files(spark)
    writers.overwrite_table(frame, str(tmp_path / "t"), "day", spread=False)
    assert not shuffle_files(spark) - before
    assert len(data_files(tmp_path / "t" / "day=7")) == 4
    found = spark.read.schema("id long, day string").parquet(str(tmp_path / "t"))
    assert sorted((r.id, r.day) for r in found.collect()) == [(i, str(i % 300)) for i in range(3000)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_review_tables_are_written_without_a_shuffle(spark, tmp_path):
    """Four raw files of two months make four files a month in bronze, and as many in silver."""
    for number in range(4):
        lines = [f'{{"asin": "{number}{i}", "reviewText": "t {i}", "unixReviewTime": {i % 2 * 5_000_000}}}' for i in range(10)]
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{number}.json").write_text("\n".join(lines))
    bronze_path, silver_path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    before = shuffle_files(spark)
    assert bronze.load_bronze_reviews(spark, [str(tmp_path / "raw")], bronze_path, schema=RAW_REVIEWS) == 1
    assert [len(data_files(tmp_path / "bronze" / f"year_month={m}")) for m in ("1970-01", "1970-02")] == [4, 4]
    rows = readers.read_table(spark, bronze_path).withColumn("reviewer_name", F.lit("n"))
    writers.overwrite_table(rows, f"{bronze_path}-named", "year_month", spread=False)
    silver.write_silver_reviews(spark, f"{bronze_path}-named", silver_path)
    assert [len(data_files(tmp_path / "silver" / f"year_month={m}")) for m in ("1970-01", "1970-02")] == [4, 4]
    assert sorted(r.asin for r in spark.read.parquet(silver_path).collect()) == sorted(r.asin for r in rows.collect())
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_raw_feed_is_worked_out_once(spark, tmp_path):
    """One job for all folders, and one more where the first has types of its own."""
    raw = spark.range(300).select(F.col("id").cast("string").alias("asin"), F.lit("7").alias("vote"))
    for number, (narrow, jobs_) in enumerate([({}, 1), ({"vote": "long"}, 2)]):
        spark.sparkContext.setJobGroup(f"raw-{number}", "raw")
        try:
            queries.write_raw(raw, str(tmp_path / f"raw{number}"), **narrow)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"raw-{number}")) == jobs_
        folders = readers.list_folders(spark, str(tmp_path / f"raw{number}"))
        assert sorted(int(r.asin) for r in readers.read_json(spark, folders).collect()) == list(range(300))
