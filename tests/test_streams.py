from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewmill.plans.bronze import bronze_events
from reviewmill.plans.silver import silver_events
from reviewmill.schemas import EVENT_ENVELOPE
from reviewmill.sources.positions import stored_position
from reviewmill.sources.readers import stream_table
from reviewmill.streaming import jobs


def envelopes(spark, numbers):
    rows = [
        (
            bytearray(
                (
                    "not json"
                    if n % 10 == 9
                    else f'{{"asin":"a{n}","reviewText":"good","image":"[\\"88\\",\\"u{n}\\"]",'
                    f'"overall":{n % 5},"verified":true,"reviewerName":"A &amp; B","unixReviewTime":{n}}}'
                ).encode()
            ),
            str(n) if n % 7 else "x",
            n,
            dt.datetime(2024, 1, 1) + dt.timedelta(hours=n),
        )
        for n in numbers
    ]
    return spark.createDataFrame(rows, EVENT_ENVELOPE)


def add(spark, folder, numbers):
    envelopes(spark, numbers).coalesce(1).write.mode("append").parquet(folder)


class Feed:
    def __init__(self, spark, base):
        self.spark, self.raw = spark, f"{base}/raw"
        self.bronze, self.silver, self.checks = f"{base}/bronze", f"{base}/silver", f"{base}/checks"

    def run(self, files=1, position=None, suffix=""):
        stream = stream_table(self.spark, self.raw, EVENT_ENVELOPE, files)
        writer = jobs.stream_bronze_events(
            stream, self.bronze, self.checks + suffix + "/bronze", position=position
        )
        assert jobs.run_until_done(writer)

    def run_silver(self, files=1):
        schema = bronze_events(self.spark.createDataFrame([], EVENT_ENVELOPE)).schema
        assert jobs.run_until_done(
            jobs.stream_silver_events(
                self.spark, self.bronze, schema, self.silver, self.checks + "/silver", files_per_trigger=files
            )
        )

    def numbers(self, table):
        return sorted(r.sequenceNumber for r in self.spark.read.parquet(table).collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def plain(frame):
    names = sorted(frame.columns)
    rows = frame.select(*(F.col(n).cast("string") for n in names)).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_streams_equal_batch(feed, ansi):
    add(feed.spark, feed.raw, range(30))
    add(feed.spark, feed.raw, range(30, 60))
    feed.run()
    feed.run_silver()
    batch = bronze_events(feed.spark.read.parquet(feed.raw))
    assert plain(feed.spark.read.parquet(feed.bronze)) == plain(batch)
    assert plain(feed.spark.read.parquet(feed.silver)) == plain(silver_events(batch))


def test_silver_fields(spark, ansi):
    found = {r.sequenceNumber: r for r in silver_events(bronze_events(envelopes(spark, range(10)))).collect()}
    assert (found[1].asin, found[1].image, found[1].reviewer_name) == ("a1", ["u1"], "A & B")
    assert (found[1].overall, found[1].verified, found[1].unix_review_time) == ("1", "true", "1")
    assert (found[1].review_word_count, found[1].keyword, found[1].date_utc) == (1, "good", "2024-01-01")
    assert (found[9].asin, found[9].image, found[9].review_word_count) == (None, None, None)
    assert (found[7].offset, found[8].offset) == (None, 8)


def test_restart_loads_new_files_once(feed):
    add(feed.spark, feed.raw, range(10))
    feed.run()
    feed.run()
    add(feed.spark, feed.raw, range(10, 15))
    feed.run()
    assert feed.numbers(feed.bronze) == list(range(15))


def test_file_limit_cuts_micro_batches(feed):
    for start in range(0, 40, 10):
        add(feed.spark, feed.raw, range(start, start + 10))
    stream = stream_table(feed.spark, feed.raw, EVENT_ENVELOPE, 1)
    query = jobs.stream_bronze_events(stream, feed.bronze, feed.checks).start()
    query.awaitTermination(120)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert feed.numbers(feed.bronze) == list(range(40))


def test_interval_trigger_and_time_limit(feed):
    """A stream with an interval never ends by itself: it is stopped, and goes on next time."""
    add(feed.spark, feed.raw, range(5))
    stream = stream_table(feed.spark, feed.raw, EVENT_ENVELOPE)
    writer = jobs.stream_bronze_events(stream, feed.bronze, feed.checks, interval="1 second")
    assert jobs.run_until_done(writer, seconds=15) is False
    assert feed.numbers(feed.bronze) == list(range(5))
    assert not feed.spark.streams.active
    add(feed.spark, feed.raw, range(5, 8))
    stream = stream_table(feed.spark, feed.raw, EVENT_ENVELOPE)
    assert jobs.run_until_done(jobs.stream_bronze_events(stream, feed.bronze, feed.checks))
    assert feed.numbers(feed.bronze) == list(range(8))


def test_resume_from_stored_position(feed, tmp_path):
    """A new checkpoint starts at the stored time and reads the events of that time again."""
    add(feed.spark, feed.raw, range(10))
    feed.run()
    path = str(tmp_path / "positions")
    jobs.save_daily_position(feed.spark, feed.bronze, path, "hub")
    position = stored_position(feed.spark, path, "hub")
    assert position == "2024-01-01 09:00:00.000000"
    add(feed.spark, feed.raw, range(10, 20))
    feed.bronze = f"{tmp_path}/bronze-2"
    feed.run(position=position, suffix="-2")
    assert feed.numbers(feed.bronze) == list(range(9, 20))
