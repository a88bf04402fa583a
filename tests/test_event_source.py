"""The event log as a source, the index of times, and the stream in two tables."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from reviewmill.plans.bronze import bronze_events
from reviewmill.sources import eventlog, fileindex
from reviewmill.sources.storage import Store
from reviewmill.streaming import jobs, quarantine

START = dt.datetime(2024, 1, 1)


def events(spark, numbers, body="x"):
    rows = [(f"{body}{n}".encode(), n, START + dt.timedelta(minutes=n)) for n in numbers]
    return spark.createDataFrame(rows, "body binary, sequenceNumber long, enqueuedTime timestamp_ntz")


def numbers(frame):
    return sorted(r.sequenceNumber for r in frame.select("sequenceNumber").collect())


def segments(root):
    return [os.path.join(top, n) for top, _, names in os.walk(root) for n in sorted(names) if eventlog.SEGMENT.fullmatch(n)]


def spoil(files):
    """Files that cannot be read: whoever opens one fails."""
    for path in files:
        with open(path, "wb") as out:
            out.write(b"spoiled")


def to_bronze(spark, root, base, **options):
    jobs.run_to_end(lambda: jobs.stream_bronze_events(eventlog.read_log(spark, root, **options), f"{base}/bronze", f"{base}/checks"))
    return spark.read.parquet(f"{base}/bronze")


def test_offsets_go_on_and_name_their_events(spark, tmp_path):
    root = str(tmp_path / "log")
    assert eventlog.append_events(events(spark, range(50)), root, partitions=3, segment_rows=7) == 50
    assert eventlog.append_events(events(spark, range(50, 90)), root, partitions=3, segment_rows=7) == 40
    log = eventlog.Log(root)
    for own in log.segments().values():
        assert [s.first for s in own[1:]] == [s.end for s in own[:-1]] and all(s.rows <= 7 for s in own)
    rows = eventlog.read_log(spark, root, stream=False).collect()
    assert sorted(r.sequenceNumber for r in rows) == list(range(90))
    assert len({(r.partition, r.offset) for r in rows}) == 90
    assert {r.body.decode(): r.sequenceNumber for r in rows} == {f"x{n}": n for n in range(90)}
    by_offset = sorted((r.partition, int(r.offset), r.sequenceNumber) for r in rows)
    assert by_offset == sorted(by_offset, key=lambda r: (r[0], r[2]))
    at = {r.sequenceNumber: r.enqueuedTime.replace(tzinfo=None) for r in rows}
    assert at[3] == START + dt.timedelta(minutes=3)


def test_a_restart_reads_no_event_twice(spark, tmp_path):
    root, base = str(tmp_path / "log"), str(tmp_path)
    for first in (0, 40, 70):
        eventlog.append_events(events(spark, range(first, first + 40)), root, partitions=2, segment_rows=9)
        to_bronze(spark, root, base)
    expected = sorted([*range(40), *range(40, 80), *range(70, 110)])  # the producer sent ten events twice, and both stay
    assert numbers(spark.read.parquet(f"{base}/bronze")) == expected
    assert numbers(to_bronze(spark, root, base)) == expected
    # What was read before is not opened again.
    spoil(segments(root))
    eventlog.append_events(events(spark, [500]), root, partitions=2)
    assert numbers(to_bronze(spark, root, base))[-1] == 500


def test_a_batch_that_failed_is_read_again_alike(spark, tmp_path):
    root, seen = str(tmp_path / "log"), []
    eventlog.append_events(events(spark, range(30)), root, partitions=2, segment_rows=4)

    def put(rows, batch):
        seen.append((batch, sorted((r.partition, r.offset, r.sequenceNumber) for r in rows.collect())))
        if len(seen) == 1:
            raise InterruptedError

    def writer():
        stream = eventlog.read_log(spark, root).writeStream.foreachBatch(put)
        return stream.option("checkpointLocation", str(tmp_path / "checks")).trigger(availableNow=True)

    with pytest.raises(Exception):
        jobs.run_until_done(writer())
    eventlog.append_events(events(spark, range(30, 35)), root, partitions=2)
    assert jobs.run_until_done(writer())
    assert seen[0] == seen[1] and len(seen[0][1]) == 30
    assert jobs.run_until_done(writer())
    assert sorted(r[2] for _, rows in seen[2:] for r in rows) == list(range(30, 35))


def test_start_times_open_no_earlier_segment(spark, tmp_path):
    root = str(tmp_path / "log")
    eventlog.append_events(events(spark, range(100)), root, partitions=2, segment_rows=10)
    start = START + dt.timedelta(minutes=60)
    log = eventlog.Log(root)
    kept = {s.path for own in log.segments().values() for s in own if s.end > log.since(60 * 60_000_000 + int(START.replace(tzinfo=dt.timezone.utc).timestamp()) * 10**6)[str(s.partition)]}
    early = [f for f in segments(root) if f not in kept]
    assert len(early) >= 4
    spoil(early)
    stream = to_bronze(spark, root, str(tmp_path), startingPosition=start.isoformat())
    found = numbers(stream)
    assert set(range(60, 100)) <= set(found) and min(found) >= 40
    batch = eventlog.read_log(spark, root, stream=False, startingPosition="2024-01-01T01:00:00Z")
    assert numbers(batch) == found
    with pytest.raises(Exception):
        numbers(eventlog.read_log(spark, root, stream=False))


def test_positions_of_a_group_and_by_offset(spark, tmp_path):
    root = str(tmp_path / "log")
    eventlog.append_events(events(spark, range(20)), root, partitions=1, segment_rows=6)
    to_bronze(spark, root, str(tmp_path / "a"), group="silver")
    eventlog.append_events(events(spark, range(20, 25)), root, partitions=1)
    to_bronze(spark, root, str(tmp_path / "a"), group="silver")
    stored = eventlog.Log(root).position("silver")
    assert stored in ({"0": 20}, {"0": 25})  # the last commit comes with the next batch
    again = to_bronze(spark, root, str(tmp_path / "b"), group="silver", startingPosition="group")
    assert numbers(again) == list(range(stored["0"], 25)) if stored["0"] < 25 else again.count() == 0
    assert numbers(eventlog.read_log(spark, root, stream=False, startingOffsets='{"0": 22}')) == [22, 23, 24]
    assert eventlog.read_log(spark, root, stream=False, startingPosition="latest").count() == 0
    with pytest.raises(Exception, match="ends before the position"):
        eventlog.read_log(spark, root, stream=False, startingOffsets='{"0": 99}').count()


def test_an_append_that_stops_leaves_the_log(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "log")
    eventlog.append_events(events(spark, range(5)), root, partitions=1)

    def stop(self, source, target):
        raise InterruptedError

    monkeypatch.setattr(Store, "move", stop)
    with pytest.raises(InterruptedError):
        eventlog.append_events(events(spark, range(5, 9)), root, partitions=1)
    monkeypatch.undo()
    assert numbers(eventlog.read_log(spark, root, stream=False)) == list(range(5))
    eventlog.append_events(events(spark, range(5, 9)), root, partitions=1)
    assert numbers(eventlog.read_log(spark, root, stream=False)) == list(range(9))


def test_an_empty_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    root = str(tmp_path / "log")
    assert eventlog.read_log(spark, root, stream=False).count() == 0
    assert eventlog.append_events(events(spark, [1]).limit(0), root) == 0


# --- Index of times -----------------------------------------------------------------------


def test_files_before_the_position_are_not_opened(spark, tmp_path, ansi):
    path = str(tmp_path / "t")
    days = events(spark, range(0, 1440 * 4, 60)).withColumn("day", F.concat(F.lit("d +%"), F.dayofmonth("enqueuedTime")))
    days.coalesce(1).write.partitionBy("day").parquet(path)  # one task: files share their names
    assert fileindex.index_files(spark, path, days.schema) == 4
    assert fileindex.index_files(spark, path, days.schema) == 0
    late = events(spark, [1440 * 9]).withColumn("day", F.lit("d9"))
    late.write.mode("append").partitionBy("day").parquet(path)  # not indexed
    spoil([str(f) for f in (tmp_path / "t").glob("day=*[12]/*.parquet")])
    found = fileindex.read_from(spark, path, days.schema, "2024-01-03T12:00:00Z")
    assert numbers(found) == [n for n in range(0, 1440 * 4, 60) if n >= 1440 * 2.5] + [1440 * 9]
    assert len(found.inputFiles()) == 3
    assert fileindex.index_files(spark, path, days.schema) == 1
    assert len(fileindex.read_from(spark, path, days.schema, "2024-01-06T00:00:00Z").inputFiles()) == 1
    assert fileindex.read_from(spark, path, days.schema, "2025-01-01T00:00:00Z").count() == 0
    with pytest.raises(Exception):
        numbers(fileindex.read_from(spark, path, days.schema, None))


def test_index_of_rows_without_a_time(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "n long, enqueuedTime timestamp"
    spark.createDataFrame([(1, None)], schema).coalesce(1).write.parquet(path)
    spark.createDataFrame([(2, START)], schema).coalesce(1).write.mode("append").parquet(path)
    schema = spark.createDataFrame([], schema).schema
    assert fileindex.index_files(spark, path, schema) == 2
    assert [r.n for r in fileindex.read_from(spark, path, schema, "2024-01-01T00:00:00Z").collect()] == [2]


# --- One stream in two tables -------------------------------------------------------------

BODIES = [
    ('{"asin":"a","overall":5}', None), ("not json", "not json"), ("", "no body"), (None, "no body"), ("[1]", "not an object"),
    ("3", "not an object"), ('{"asin":null}', "no asin"), ('{"overall":1}', "no asin"), ('{"asin":" "}', "no asin"),
    ('{"asin":7}', None), ('{"asin":"a"', "not json"),
]


def test_reasons(spark, ansi):
    rows = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "i int, body string")
    found = rows.select("i", quarantine.body_fault(F.col("body")).alias("reason")).collect()
    assert {r.i: r.reason for r in found} == {i: reason for i, (_, reason) in enumerate(BODIES)}


def test_both_sides_add_up_also_after_a_restart(spark, tmp_path, monkeypatch):
    root, base = str(tmp_path / "log"), str(tmp_path)

    def append(first):
        bodies = [(None if b is None else b.encode(), first + i, START + dt.timedelta(hours=9 * i)) for i, (b, _) in enumerate(BODIES)]
        rows = spark.createDataFrame(bodies, "body binary, sequenceNumber long, enqueuedTime timestamp_ntz")
        eventlog.append_events(rows, root, partitions=2)

    def run():
        stream = bronze_events(eventlog.read_log(spark, root))
        return jobs.run_until_done(quarantine.stream_split_events(stream, f"{base}/good", f"{base}/bad", f"{base}/checks"))

    append(0)
    real, calls = quarantine.split_events, []

    def broken(rows, required):
        good, bad = real(rows, required)
        calls.append(1)
        # The first time the clean rows are written and the others are not.
        return (good, bad) if len(calls) > 1 else (good, bad.withColumn("reason", F.raise_error(F.lit("stop")).cast("string")))

    monkeypatch.setattr(quarantine, "split_events", broken)
    with pytest.raises(Exception):
        run()
    assert spark.read.parquet(f"{base}/good").count() == 2
    assert run()
    append(100)
    assert run()
    good, bad = spark.read.parquet(f"{base}/good"), spark.read.parquet(f"{base}/bad")
    expected = {first + i: reason for first in (0, 100) for i, (_, reason) in enumerate(BODIES)}
    assert numbers(good) == sorted(n for n, reason in expected.items() if reason is None)
    assert sorted((r.sequenceNumber, r.reason) for r in bad.collect()) == sorted((n, r) for n, r in expected.items() if r)
    assert {"partition", "offset", "enqueuedTime", "date_utc", "batch"} <= set(bad.columns)


def test_tasks_need_not_import_this_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from __spark_entry__ import queries
for name in ("event_source_from_time", "enrich_resumed"):
    print(name, queries()[name](spark, "/root/testdata/sf0.001").count())
print("DONE")
"""
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "DONE" in run.stdout, run.stderr[-2000:]
